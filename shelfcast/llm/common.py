"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from shelfcast.session import scratch_path

#: The white space that separates words: space, tab and \n \v \f \r.
SPACE = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back.

    The written table cuts the lineage: whoever reads it later does not
    depend on the executors that made it.
    """
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``key``, such that adaptive execution
    can split a hot key.

    A side that comes out of an aggregation by the key brings its partitioning
    along and could not be split.  Joined by an expression of the key, both
    sides get an exchange for this join alone.
    """
    kind = left.schema[key].dataType.simpleString()
    part = F.hex(key) if kind == "binary" else F.col(key).cast("decimal(20,0)") if kind in ("bigint", "int") else F.concat(F.lit("="), F.col(key))
    return left.withColumn("_on", part).join(right.withColumn("_on", part).drop(key), "_on", how).drop("_on")


def by_batch(df: DataFrame, func: Callable[[pa.RecordBatch], dict[str, list]], schema: str) -> DataFrame:
    """``func`` turns a batch of rows into the columns of ``schema``.

    Batches come from Spark's partitions and hold at most the rows and bytes
    of Spark's Arrow settings, so memory does not follow the partition.
    """
    fields: StructType = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(fields)
        for batch in batches:
            out = func(batch)
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, fields)


def slices(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` of about ``size`` bytes of text each; a
    longer row is one by itself."""
    start, held = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()):
        if held and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def merge(symbols: list, rank: dict) -> list:
    """Byte-pair merging: again and again join the neighbours whose union has
    the lowest rank, the leftmost of equals.

    For long input a heap of candidate pairs over a linked list makes it
    O(n log n), so that a text of one very long word does not stall a task.
    """
    n = len(symbols)
    if n <= 64:
        return _merge_short(list(symbols), rank)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        both = symbols[i] + symbols[i + 1]
        if (r := rank.get(both)) is not None:
            heap.append((r, i, both))
    heapq.heapify(heap)
    symbols = [*symbols, None]
    while heap:
        _, i, both = heapq.heappop(heap)
        if symbols[i] is None or (j := after[i]) >= n or symbols[i] + symbols[j] != both:
            continue  # one of the two has changed since
        symbols[i], symbols[j] = both, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            joined = both + symbols[k]
            if (r := rank.get(joined)) is not None:
                heapq.heappush(heap, (r, i, joined))
        if (h := before[i]) >= 0:
            joined = symbols[h] + both
            if (r := rank.get(joined)) is not None:
                heapq.heappush(heap, (r, h, joined))
    return [s for s in symbols if s is not None]


def _merge_short(symbols: list, rank: dict) -> list:
    """``merge`` by a list of the neighbours' ranks, quicker for few symbols."""
    never = float("inf")
    ranks = [rank.get(a + b, never) for a, b in zip(symbols, symbols[1:])]
    while ranks and (lowest := min(ranks)) != never:
        i = ranks.index(lowest)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        del ranks[i]
        if i:
            ranks[i - 1] = rank.get(symbols[i - 1] + symbols[i], never)
        if i < len(ranks):
            ranks[i] = rank.get(symbols[i] + symbols[i + 1], never)
    return symbols
