"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    """Columns of one of the given tables; only Spark's reader opens the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: lost executors recompute from files, and what is used
    twice is computed once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staged:
    """A table written once to the shared folder; :meth:`discard` deletes its files when nothing reads them any more."""

    def __init__(self, df: DataFrame, name: str):
        self.path = scratch_path(df.sparkSession, name)
        df.write.option("compression", "zstd").parquet(self.path)
        self.rows = df.sparkSession.read.schema(df.schema).parquet(self.path)

    def discard(self) -> None:
        sc = self.rows.sparkSession.sparkContext
        folder = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def text_or_empty(name: str = "text"):
    """The column as a string; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def file_uri(path: str) -> str:
    """``file:/x`` or ``/x`` as the ``file:///x`` that Arrow's file systems take."""
    if path.startswith("file:") and not path.startswith("file://"):
        return "file://" + path[5:]
    return path if "://" in path else "file://" + path


def new_file(folder: str, suffix: str):
    """Open a file under a name no other task attempt uses: ``(uri, stream)``.

    A file counts only when the manifest row with its name is committed, so
    retried or speculative attempts never mix."""
    uri = f"{file_uri(folder).rstrip('/')}/{uuid.uuid4().hex}{suffix}"
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return uri, system.open_output_stream(path, compression=None)


def open_file(uri: str) -> pa.NativeFile:
    """Random-access reading of a file in the shared store."""
    system, path = fs.FileSystem.from_uri(file_uri(uri))
    return system.open_input_file(path)


def text_batches(texts, max_bytes: int = 1 << 20):
    """Cut a list of texts into slices ``(first, encoded)`` of about ``max_bytes``."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass")
        if held and size + len(b) > max_bytes:
            yield first, held
            first, held, size = i, [], 0
        held.append(b)
        size += len(b)
    if held:
        yield first, held


def binary_array(chunks: list[bytes]) -> pa.Array:
    return pa.array(chunks, pa.binary())
