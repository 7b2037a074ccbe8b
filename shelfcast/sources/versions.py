"""Published outputs: an output is a folder of versions, and a write never
touches what is there (S13-S15).

``publish`` writes to a fresh folder below the output's own (in ``_versions``,
which Spark does not list), and only when that write has succeeded adds a small
numbered record naming the folders that make
up the output; the record with the highest number is the current version.  So

* a forced write that dies half-way leaves the last good table as it was, for
  readers too: what has no record is no part of the output;
* a folder that somebody else filled is never replaced.  Without ``force`` it
  counts as existing; with ``force`` our version lies beside its files, which
  stay;
* a version may keep folders of the one before and add one (``append``): tables
  that grow are carried forward without being rewritten;
* two jobs that publish at once cannot both win: the second finds the record
  there.

Readers go through ``read_table`` or ``location``, which also read plain
folders.  The newest ``KEEP`` versions stay, older folders of ours are deleted.

A part may have a ledger: the input files (path, length, time) that it was
made from, as a hidden Parquet folder, so that a later run knows what is new.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources import fs

KEEP = 2
LEDGER = "_ledger"
HOME = "_versions"
LEDGER_SCHEMA = "path string, length bigint, modified timestamp"
_RECORD = re.compile(r"_version-(\d{6,})\.json")
_PART = re.compile(r"v(\d{6,})-[0-9a-f]{8}")


@dataclass(frozen=True)
class Version:
    """``parts``: full paths of the folders that make up the output; ``notes``:
    what the writer wants to know again."""

    number: int
    parts: tuple[str, ...]
    notes: dict = field(default_factory=dict)


def _records(spark: SparkSession, path: str) -> dict[int, str]:
    base = path.rstrip("/")
    if not fs.is_folder(spark, base):
        return {}
    return {int(m[1]): f"{base}/{name}" for name in fs.names_in(spark, base) if (m := _RECORD.fullmatch(name))}


def _read_record(spark: SparkSession, path: str, number: int, record: str) -> Version:
    said = json.loads(fs.read_text(spark, record))
    return Version(number, tuple(f"{path.rstrip('/')}/{p}" for p in said["parts"]), said["notes"])


def current(spark: SparkSession, path: str) -> Version | None:
    """The current version, or None where nothing has been published."""
    records = _records(spark, path)
    return _read_record(spark, path, max(records), records[max(records)]) if records else None


def published_at(spark: SparkSession, path: str) -> int:
    """When the current version was published, in milliseconds; 0 if never."""
    records = _records(spark, path)
    return fs.modified_at(spark, records[max(records)]) if records else 0


def is_taken(spark: SparkSession, path: str) -> bool:
    """Whether an output is there, published or put there by somebody else.  A
    folder that holds nothing but unfinished versions of ours is free."""
    if not fs.path_exists(spark, path):
        return False
    if not fs.is_folder(spark, path) or _records(spark, path):
        return True
    return any(n != HOME for n in fs.names_in(spark, path)) or not fs.path_exists(spark, f"{path.rstrip('/')}/{HOME}")


def location(spark: SparkSession, path: str) -> str:
    """The folder to read: the only part of the current version, or ``path``
    itself where nothing has been published."""
    now = current(spark, path)
    if now is None:
        return path
    if len(now.parts) != 1:
        raise ValueError(f"{path} is made of {len(now.parts)} folders, read it with read_table")
    return now.parts[0]


def version_folder(path: str, part: str) -> str:
    """The folder that a part, or a folder within it, was written as."""
    home = f"{path.rstrip('/')}/{HOME}"
    return f"{home}/{part.removeprefix(home + '/').split('/')[0]}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet output, whether published or a plain folder."""
    now = current(spark, path)
    return spark.read.parquet(*(now.parts if now else [path]))


class Draft:
    """A version in the making: fill ``folder``, then ``publish``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        if fs.path_exists(spark, self.path) and not fs.is_folder(spark, self.path):
            raise FileExistsError(f"{self.path} is a file")
        self.before = current(spark, self.path)
        known = [0, *_records(spark, self.path)] + [int(m[1]) for n in fs.names_in(spark, f"{self.path}/{HOME}") if (m := _PART.fullmatch(n))]
        self.number = max(known) + 1
        self.name = f"{HOME}/v{self.number:06d}-{uuid.uuid4().hex[:8]}"
        self.folder = f"{self.path}/{self.name}"

    def publish(self, notes: dict | None = None, keep_parts: list[str] | None = None) -> Version:
        """Make the folder, behind ``keep_parts`` of the version before, the output."""
        now = current(self.spark, self.path)
        if (now.number if now else 0) != (self.before.number if self.before else 0):
            raise FileExistsError(f"{self.path} was published by another job meanwhile")
        parts = [*(p.removeprefix(f"{self.path}/") for p in keep_parts or []), self.name]
        fs.write_text_once(self.spark, f"{self.path}/_version-{self.number:06d}.json", json.dumps({"parts": parts, "notes": notes or {}}))
        self._drop_old()
        return Version(self.number, tuple(f"{self.path}/{p}" for p in parts), notes or {})

    def _drop_old(self) -> None:
        records = _records(self.spark, self.path)
        kept = sorted(records)[-KEEP:]
        home = f"{self.path}/{HOME}"
        used = {p.removeprefix(f"{home}/").split("/")[0] for n in kept for p in _read_record(self.spark, self.path, n, records[n]).parts}
        for n, record in records.items():
            if n not in kept:
                fs.delete(self.spark, record)
        for name in fs.names_in(self.spark, home):
            # an unfinished folder as new as what is kept may be another job's
            if (m := _PART.fullmatch(name)) and name not in used and int(m[1]) < kept[0]:
                fs.delete(self.spark, f"{home}/{name}")


def publish(
    spark: SparkSession,
    path: str,
    write: Callable[[str], None],
    policy: str = "skip",
    force: bool = False,
    notes: dict | None = None,
) -> str:
    """``write(folder)`` as the next version of ``path``.

    An output that is there stays, unless ``force``: status ``exists`` for the
    policy ``skip``, ``FileExistsError`` for ``fail``.  Else the status is ``ok``.
    """
    if policy not in ("skip", "fail"):
        raise ValueError(f"unknown policy {policy!r}")
    if not force and is_taken(spark, path):
        if policy == "fail":
            raise FileExistsError(f"{path} is there already; pass force=True to publish a new version")
        return "exists"
    draft = Draft(spark, path)
    write(draft.folder)
    draft.publish(notes)
    return "ok"


# --- what an output was made from ------------------------------------------------


def data_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """``path, length, modified`` of the data files of an output, published or
    plain or a stream's; contents are not read."""
    now = current(spark, path)
    listed = None
    for folder in now.parts if now else [path]:
        one = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
        one = one.select("path", "length", F.col("modificationTime").alias("modified"))
        listed = one if listed is None else listed.unionByName(one)
    return listed


def ledger(spark: SparkSession, version: Version | None) -> DataFrame:
    """The input files of all parts of a version."""
    folders = [f"{p}/{LEDGER}" for p in (version.parts if version else ())]
    folders = [f for f in folders if fs.path_exists(spark, f)]
    return spark.read.schema(LEDGER_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], LEDGER_SCHEMA)


@dataclass(frozen=True)
class Increment:
    """What an output lacks of its input: ``kind`` is ``none``, ``new`` (only
    ``files`` are new) or ``all`` (it has to be made again)."""

    kind: str
    files: DataFrame
    before: Version | None


def increment(spark: SparkSession, source: str, target: str, notes: dict | None = None) -> Increment:
    """Compare a target's ledger with the files of its source.

    A file that was changed or that went away since, and other ``notes`` (the
    arguments that the target was made with), make all of it new.
    """
    before, files = current(spark, target), data_files(spark, source)
    if before is None or {k: v for k, v in before.notes.items() if k in (notes or {})} != (notes or {}):
        return Increment("all", files, before)
    known, same = ledger(spark, before), ["path", "length", "modified"]
    if not known.join(files, same, "left_anti").isEmpty():
        return Increment("all", files, before)
    new = files.join(known, same, "left_anti")
    return Increment("none" if new.isEmpty() else "new", new, before)


def write_ledger(files: DataFrame, folder: str) -> None:
    files.write.parquet(f"{folder}/{LEDGER}")
