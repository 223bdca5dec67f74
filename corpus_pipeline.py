"""A training-data pipeline of five operators, stage by stage over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result
is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.bayes_join import one_of_each
from spindle.llm.bpe import encode_and_decode
from spindle.llm.cdc import remove_repeats
from spindle.llm.common import staged, table
from spindle.llm.mixing import mixture
from spindle.llm.ordinal import score_documents
from spindle.llm.queries import quality_model, vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier selects."""
    return score_documents(docs, quality_model(spark, sf_dir)).filter("selected").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones: that of smallest ``doc_id``."""
    return one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in a document before are cut; documents left without a word go."""
    cut = remove_repeats(docs)
    changed = F.col("removed_bytes") > 0
    rows = cut.filter(~(changed & (F.trim(F.regexp_replace("kept_text", r"\s+", " ")) == "")))
    rows = rows.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: documents repeated whole and in part."""
    return mixture(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they decode to."""
    return encode_and_decode(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", select_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", tokenize),
]

#: SQL can't state the classifier's or the tokenizer's rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents", COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
