"""WARC archives with a two-level capture index.

``write`` stores one record per page.  Records of equal payloads are
deduplicated: the one with the largest page id is a ``response`` with the
whole payload, the others are ``revisit`` records that name it.  Each task
writes archives of its own, every record a gzip member, below the given
folder; the file's name is new for every attempt, so that a repeated task
disturbs nothing, and only files named by the stored captures belong to the
archive.

The index has two levels.  Captures are sorted by their key, the URL with its
host reversed (``org,example,www)/path``) and the page id, over all tasks by
range; each task's sorted lines are cut into blocks of ``BLOCK`` lines,
compressed and appended to one file, and a sparse directory keeps each block's
first key, offset and length.  A lookup picks the file whose range holds a key
by binary search, then the block in the file's directory, reads the block by
range and finds the line by binary search, then reads the record by range.

The driver holds one line per index file.  Files are reached through
pyarrow's file systems, so local, HDFS and object stores work alike.

A null payload counts as empty, a null URL as the empty one; rows with the
same URL or page id are captures of their own (the copy number tells rows with
equal keys apart).  Rows that repeat the largest page id of a payload are
responses like it, and a null page id is smaller than all others.  An empty table
gives an empty archive.  Other columns are ignored.  A payload must fit in a
task's memory, as its row does.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import split_join, stored

BLOCK = 512
FILE_BYTES = 256 << 20
CAPTURE = "key string, id long, copy long, file string, at long, size long"
RESULT = "id long, copy long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path)) if re.match(r"\w+:", path) else (pafs.LocalFileSystem(), path)


class Files:
    """Ranges of files; the last few files that were read stay open."""

    OPEN = 4

    def __init__(self):
        self.held: dict[str, pa.NativeFile] = {}

    def read(self, path: str, at: int, size: int) -> bytes:
        file = self.held.pop(path, None)
        if file is None:
            fs, place = _open(path)
            file = fs.open_input_file(place)
            if len(self.held) == self.OPEN:
                self.held.pop(next(iter(self.held))).close()
        self.held[path] = file  # the last one read is the last to go
        file.seek(at)
        return file.read(size)

    def close(self) -> None:
        while self.held:
            self.held.popitem()[1].close()


def read_range(path: str, at: int, size: int) -> bytes:
    """One range of a file."""
    files = Files()
    try:
        return files.read(path, at, size)
    finally:
        files.close()


def url_key(url: str) -> str:
    """The URL with its host in reverse order, without scheme, ``www``, user
    or default port."""
    m = re.match(r"(?s)(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)(.*)", url)
    host, rest = m.groups() if m else ("", url)
    host = host.rpartition("@")[2].lower()
    name, _, port = host.partition(":")
    name = name.removeprefix("www.")
    return ",".join(reversed(name.split("."))) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (rest or "/")


def _key(url: str, id_: int | None, copy: int) -> str:
    """Sorts as (URL key, id, copy); without the separators of index lines."""
    url = url_key(url).replace("%", "%25").replace(" ", "%20").replace("\n", "%0A").replace("\r", "%0D")
    return f"{url} {-1 if id_ is None else id_ + (1 << 63):020d} {copy:020d}"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(url: str, id_: int | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, a gzip member of its own.  A revisit has no payload but
    its digest and length."""
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(id_)),
            ("WARC-Target-URI", re.sub(r"[\r\n]", " ", url)), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("WARC-Payload-Digest", f"sha1:{digest(payload)}"), ("WARC-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Refers-To", name(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + (b"" if revisit else payload)
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(http)))]
    return gzip.compress(b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + http + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header and payload of a record."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", smallest: int = 0) -> DataFrame:
    """Write the archives below ``folder``; the captures: key, id, copy, file,
    offset and size of every record.  Payloads of fewer than ``smallest``
    bytes are never deduplicated."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    # one count per task and digest is shuffled, so a very common payload is no large group
    equal = rows.where(F.octet_length("payload") >= smallest).groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("first"))
    marked = split_join(rows, equal.where("n > 1").drop("n").withColumn("dup", F.lit(True)), "sha", "left").withColumn("revisit", F.col("dup").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")))
    marked = marked.select(F.monotonically_increasing_id().alias("copy"), "id", "url", "payload", "first", "revisit")
    arrow = pa.schema([("key", pa.string()), ("id", pa.int64()), ("copy", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _open(folder)
        fs.create_dir(top, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                lines = []
                for r in batch.to_pylist():
                    if out is None or at > FILE_BYTES:
                        if out:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{top}/{name}", compression=None)
                    member = record(r["url"], r["id"], r["payload"], r["first"], r["revisit"])
                    out.write(member)
                    lines.append({"key": _key(r["url"], r["id"], r["copy"]), "id": r["id"], "copy": r["copy"], "file": name, "at": at, "size": len(member)})
                    at += len(member)
                yield pa.RecordBatch.from_pylist(lines, schema=arrow)
        finally:
            if out:
                out.close()

    return stored(marked.mapInArrow(archive, CAPTURE), "warc-captures")


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the index below ``folder``; one row per index file: its first
    key, name, and where its directory lies."""
    arrow = pa.schema([("first", pa.string()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64())])

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = _open(folder)
        fs.create_dir(top, recursive=True)
        out, directory, lines, at = None, [], [], 0
        name = f"{uuid.uuid4().hex}.cdx"

        def flush() -> None:
            nonlocal at
            block = zlib.compress("\n".join(lines).encode())
            out.write(block)
            directory.append([lines[0].rpartition(" {")[0], at, len(block)])
            at += len(block)
            lines.clear()

        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    out = fs.open_output_stream(f"{top}/{name}", compression=None)
                lines.append(f"{r['key']} " + json.dumps({"file": r["file"], "at": r["at"], "size": r["size"]}))
                if len(lines) == BLOCK:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        last = zlib.compress(json.dumps(directory).encode())
        out.write(last)
        out.close()
        yield pa.RecordBatch.from_pylist([{"first": directory[0][0], "file": name, "at": at, "size": len(last)}], schema=arrow)

    ordered = captures.repartitionByRange("key").sortWithinPartitions("key")
    return stored(ordered.mapInArrow(shard, "first string, file string, at long, size long"), "warc-index")


class Index:
    """Lookups in one task: the files' first keys, one directory and one block at a time."""

    def __init__(self, shards: list[tuple[str, str, int, int]], index_folder: str, archive_folder: str):
        self.shards, self.index_folder, self.archive_folder = sorted(shards), index_folder, archive_folder
        self.firsts = [s[0] for s in self.shards]
        self.files = Files()
        self.file = self.block = None

    def find(self, key: str) -> dict | None:
        """The line of a key: file, offset and size of its record."""
        n = bisect.bisect_right(self.firsts, key) - 1
        if n < 0:
            return None
        if self.file != n:
            _, name, at, size = self.shards[n]
            self.file, self.block = n, None
            self.directory = json.loads(zlib.decompress(self.files.read(f"{self.index_folder}/{name}", at, size)))
            self.starts = [d[0] for d in self.directory]
        b = bisect.bisect_right(self.starts, key) - 1
        if b < 0:
            return None
        if self.block != b:
            _, at, size = self.directory[b]
            lines = zlib.decompress(self.files.read(f"{self.index_folder}/{self.shards[n][1]}", at, size)).decode().split("\n")
            self.block, self.lines = b, [x.rpartition(" {")[::2] for x in lines]
        i = bisect.bisect_left(self.lines, key, key=lambda x: x[0])
        return json.loads("{" + self.lines[i][1]) if i < len(self.lines) and self.lines[i][0] == key else None

    def get(self, key: str) -> tuple[dict[str, str], bytes] | None:
        """Header and payload of the record of a key."""
        line = self.find(key)
        return line and parse(self.files.read(f"{self.archive_folder}/{line['file']}", line["at"], line["size"]))


def look_up(keys: DataFrame, shards: DataFrame, index_folder: str, archive_folder: str) -> DataFrame:
    """The records of ``keys`` (key, id, copy), read back through the index:
    payload length and digest, type, and the page a revisit refers to."""
    spark: SparkSession = keys.sparkSession
    # one row per index file, of which there are as many as shuffle partitions
    files = spark.sparkContext.broadcast([tuple(r) for r in shards.select("first", "file", "at", "size").collect()])
    arrow = pa.schema([("id", pa.int64()), ("copy", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(files.value, index_folder, archive_folder)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                found = index.get(r["key"])
                if found is None:
                    raise LookupError(f"no capture of {r['key']}")
                head, payload = found
                sha, revisit = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"] == "revisit"
                if not revisit and (digest(payload) != sha or len(payload) != int(head["WARC-Payload-Length"])):
                    raise ValueError(f"damaged record of {r['key']}")
                page = head.get("WARC-Refers-To", "<urn:page:null>")[len("<urn:page:") : -1]
                out.append({"id": r["id"], "copy": r["copy"], "payload_bytes": int(head["WARC-Payload-Length"]), "payload_digest": sha,
                            "record_type": head["WARC-Type"], "refers_to": None if page == "null" else int(page)})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        index.files.close()

    # sorted keys, so that a task reads each directory and block once; the number of tasks is
    # fixed, as a key is few bytes here but stands for a whole record to read
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return keys.select("key", "id", "copy").repartitionByRange(tasks, "key").sortWithinPartitions("key").mapInArrow(read, RESULT)
