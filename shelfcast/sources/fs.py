"""Small files and listings through the Hadoop FileSystem of a path (local,
HDFS, object stores); data never passes through here."""

from __future__ import annotations

from pyspark.sql import SparkSession


def fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, hpath = fs_and_path(spark, path)
    return bool(fs.exists(hpath)) and bool(fs.getFileStatus(hpath).isDirectory())


def modified_at(spark: SparkSession, path: str) -> int:
    """Milliseconds of the last change, 0 for a path that is not there."""
    fs, hpath = fs_and_path(spark, path)
    return int(fs.getFileStatus(hpath).getModificationTime()) if fs.exists(hpath) else 0


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies directly in a folder."""
    fs, hpath = fs_and_path(spark, folder)
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(hpath)) if fs.exists(hpath) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = fs_and_path(spark, path)
    stream = fs.open(hpath)
    try:
        return str(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is whole or not there; one that is there is an error."""
    import uuid

    fs, hpath = fs_and_path(spark, path)
    folder, _, name = path.rpartition("/")
    _, draft = fs_and_path(spark, f"{folder}/_{name.lstrip('_')}.{uuid.uuid4().hex[:8]}")
    stream = fs.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(hpath) or not fs.rename(draft, hpath):
        fs.delete(draft, False)
        raise FileExistsError(f"{path} was written by another job meanwhile")


def delete(spark: SparkSession, path: str) -> None:
    fs, hpath = fs_and_path(spark, path)
    fs.delete(hpath, True)


def qualified(spark: SparkSession, path: str) -> str:
    """Fully qualified form of ``path`` (``file:/...``, ``hdfs://...``)."""
    fs, hpath = fs_and_path(spark, path)
    return str(fs.makeQualified(hpath).toString())
