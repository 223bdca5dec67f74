"""Text aggregates (AGG-05, AGG-06, SCL-09 per object).

Counting words per line needs no explode: a word never spans a newline, so
words-per-line averaged over all lines is total words / total lines, and
both are per-text sums that aggregate partially before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_line_count, text_file_line_count, word_count


def words_per_line(df: DataFrame, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """AGG-06: mean words per line (empty lines count as 0 words); null for
    no lines at all (a mean over nothing)."""
    per_text = df.select(*by, text_file_line_count(text).cast("bigint").alias("_l"),
                         word_count(text).cast("bigint").alias("_w"))
    g = per_text.groupBy(*by) if by else per_text.groupBy()
    return g.agg(F.sum("_l").alias("n_lines"), F.sum("_w").alias("n_words"),
                 F.try_divide(F.sum("_w"), F.sum("_l")).alias("avg_words_per_line"))


def line_counts(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """SCL-09 and AGG-05 side by side, per text."""
    return df.select(*keep, split_line_count(text).cast("bigint").alias("lines_split"),
                     text_file_line_count(text).cast("bigint").alias("lines_text"))


def line_lengths_from_files(lines: DataFrame) -> DataFrame:
    """STR-09 / SRC-09: line count per input file, from ``read.text`` rows
    (``_metadata.file_path`` names the file)."""
    return (lines.select(F.col("_metadata.file_path").alias("path"))
            .groupBy("path").agg(F.count(F.lit(1)).alias("n_lines")))
