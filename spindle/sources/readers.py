"""Sources (SRC-01..SRC-13).

Readers declare their schema wherever the data has one; inference is
offered (SRC-01) but costs an extra scan of the input and should not run in
production jobs.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the input when it arrives in fewer partitions than the
    cluster has cores (e.g. one large file with a single row group, which no
    scan can split).  On a well-partitioned input - any 100 TB table - this
    is a no-op and adds no exchange.  Column pruning and pushed filters still
    reach the scan below the repartition."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        n = df.rdd.getNumPartitions()
    except Exception:  # no RDD API (e.g. a Spark Connect session): leave as is
        return df
    return df.repartition(want) if n < want else df


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_input: bool = False) -> DataFrame:
    """One of the driver's parquet tables.  ``spread_input`` is for queries
    whose per-row work is CPU-heavy (regex over whole texts, JSON): measured,
    it pays there and costs aggregation-only queries an extra exchange per
    scan, so it is off by default (see :func:`spread`)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if spread_input else df


def load_table(spark: SparkSession, name_or_path: str, fmt: str | None = None,
               options: dict | None = None) -> DataFrame:
    """SRC-05: a table by catalog name, or a path in any file format; JDBC
    and other connectors go through ``fmt`` + ``options``."""
    if fmt is None:
        try:
            is_table = "/" not in name_or_path and spark.catalog.tableExists(name_or_path)
        except Exception:  # not a valid table identifier: treat it as a path
            is_table = False
        if is_table:
            return spark.read.table(name_or_path)
        fmt = "parquet"
    reader = spark.read.format(fmt).options(**(options or {}))
    return reader.load(name_or_path) if fmt != "jdbc" else reader.load()


def register_view(df: DataFrame, name: str) -> DataFrame:
    """SRC-06."""
    df.createOrReplaceTempView(name)
    return df


def run_sql(spark: SparkSession, text: str, **views: DataFrame) -> DataFrame:
    """SRC-07: SQL text over the given (or already registered) views."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: StructType | str | None = None,
             header: bool = True, infer: bool = False, **options) -> DataFrame:
    """SRC-01 / SRC-02: CSV with a header; a declared schema (default) or
    inference (an extra scan).  Column names may hold spaces and ``?``."""
    reader = spark.read.option("header", header).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str | Sequence[str], line_sep: str | None = None) -> DataFrame:
    """SRC-03: one row per line (``value``); a final newline does not add an
    empty row."""
    opts = {"lineSep": line_sep} if line_sep else {}
    return spark.read.options(**opts).text(path)


def read_whole_texts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC-04: one row per file with the whole file as ``value`` plus its
    path.  (``wholetext`` must be the keyword: the option is overridden.)"""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), "value"))


#: Scan partitions that one task reads one after another, where there are more than the cores can take at once.
SCANS_A_TASK = 64


def read_binary_files(spark: SparkSession, path: str, glob: str | None = None,
                      recursive: bool = True, with_content: bool = True) -> DataFrame:
    """SRC-10: ``path, modificationTime, length, content``.  Drop ``content``
    early (``with_content=False``) when only names and sizes are needed: the
    scan then skips reading the bytes.

    Spark counts 4 MB for opening a file, so a scan partition holds 32 small
    files at most; up to ``SCANS_A_TASK`` of them are read by one task, with four
    tasks a core at least."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path)
    try:
        scans, least = df.rdd.getNumPartitions(), 4 * spark.sparkContext.defaultParallelism
        df = df.coalesce(max(least, -(-scans // SCANS_A_TASK))) if scans > least else df
    except Exception:  # no RDD API (e.g. a Spark Connect session): leave as is
        pass
    return df if with_content else df.drop("content")


def stack_batches(frames: Sequence[DataFrame]) -> DataFrame:
    """SRC-11 / SET-01: union-all by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def metrics_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """SRC-12: a DataFrame from a handful of driver-side metric rows (never
    for data)."""
    return spark.createDataFrame(list(rows), schema)


def load_model(path: str):
    """SRC-13."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
