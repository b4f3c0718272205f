"""Training-data pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept and returns a DataFrame, which is written as Parquet and read again.  All
stages but the last return the columns of ``documents``.  NULL values, empty
texts, repeated rows, empty tables and extra columns are treated as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.linedup import drop_common_blocks
from rivulet.llm.mixing import mix
from rivulet.llm.packing import pack
from rivulet.llm.quality import keep_good
from rivulet.llm.simhash import drop_near_duplicates
from rivulet.session import configure, scratch_path

#: No SQL: compressed sizes, patience alignment and XXH64 fingerprints have no SQL form; tests use brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks that an earlier document holds go; so does a document that loses all of its words."""
    cut = drop_common_blocks(spark, docs, deleted="__deleted", partners="__partners")
    left = cut.where((F.size("__deleted") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        changed = F.when(F.size("__deleted") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        left = left.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_duplicates(spark, docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; nothing is repeated after the duplicates were taken out."""
    return mix(spark, docs, max_epochs=1, leaf_out="__leaf_name", tokens_out="__n_tokens", epoch_out="__epoch_number") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The batch and place of each document."""
    return pack(spark, docs)


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("simhash near-dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last stage's rows."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
