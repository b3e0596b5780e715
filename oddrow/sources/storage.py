"""Hadoop file-system look-ups and the folder shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from oddrow.errors import ArtifactWriteError, ConfigurationError

HEAD_BYTES = 1 << 16
GLOB_CHARACTERS = "\\{}[]*?"


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    """True if ``path``, taken literally, exists; malformed paths do not."""
    try:
        fs, target = _open(spark, path)
        return bool(fs.exists(target))
    except Py4JJavaError:
        return False


def holds_files(spark: SparkSession, path: str, suffix: str) -> bool:
    """True if some file at or below ``path`` has a name that ends in ``suffix``."""
    if not exists(spark, path):
        return False
    fs, target = _open(spark, path)
    found = fs.listFiles(target, True)
    while found.hasNext():
        if found.next().getPath().getName().endswith(suffix):
            return True
    return False


def finished(spark: SparkSession, base: str, part: str) -> list[str]:
    """Names of the folders below ``base`` whose table ``part`` (itself if empty) was written to
    its end."""
    inner = f"{part}/_SUCCESS" if part else "_SUCCESS"
    fs, target = _open(spark, f"{escape_glob(base)}/*/{inner}")
    marks = [mark.getPath().getParent() for mark in fs.globStatus(target) or []]
    return sorted((m.getParent() if part else m).getName() for m in marks)


def make_folder(spark: SparkSession, path: str) -> None:
    try:
        fs, target = _open(spark, path)
        made = fs.mkdirs(target)
    except Py4JJavaError as exc:
        raise ArtifactWriteError(f"cannot create '{path}': {exc.java_exception}") from exc
    if not made:
        raise ArtifactWriteError(f"cannot create '{path}'")


def write_bytes(spark: SparkSession, path: str, data: bytes) -> str:
    """Write a small file and return its full address."""
    fs, target = _open(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    return fs.makeQualified(target).toString()


def first_line(spark: SparkSession, path: str, at_once: int = HEAD_BYTES) -> bytes:
    """The first line of a file that holds anything, from its head alone; compressed files are
    decompressed by Hadoop's codec for their name."""
    fs, target = _open(spark, path)
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory
    codec = codecs(spark._jsc.hadoopConfiguration()).getCodec(target)
    stream = fs.open(target)
    try:
        source = stream if codec is None else codec.createInputStream(stream)
        held = b""
        while True:
            more = bytes(source.readNBytes(at_once))
            held = (held + more).lstrip(b"\r\n")
            line, end, _ = held.replace(b"\r", b"\n").partition(b"\n")
            if end or not more:
                return line
    finally:
        stream.close()


def escape_glob(path: str) -> str:
    """Make Spark read ``path`` literally even if it holds glob characters."""
    return "".join("\\" + c if c in GLOB_CHARACTERS else c for c in path)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all executors must reach.

    Where it is unset, a local master gets a folder of its own; a cluster is refused.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or "cluster" in context.master:
            raise ConfigurationError(
                "set 'spark.checkpoint.dir' to a folder that all executors can reach"
            )
        folder = tempfile.mkdtemp(prefix="oddrow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


class Scratch:
    """Intermediate tables of one job, written under the shared folder."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self.path = f"{shared_folder(spark)}/oddrow-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and read it back, so later jobs neither recompute nor lose it."""
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        fs, target = _open(self._spark, self.path)
        fs.delete(target, True)
