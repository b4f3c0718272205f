"""Raw file scans: multi-line JSON, header CSV (all strings), day partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multiline: bool = True) -> DataFrame:
    """JSON documents (arrays or objects spanning lines).  Pass ``schema`` to
    skip inference (the default for production; inference is opt-in)."""
    r = spark.read.option("multiline", multiline)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV; without a schema every column is a string (no inference pass)."""
    r = spark.read.option("header", True).option("inferSchema", False)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def arrival_order() -> Column:
    """Place of a landed row among all deliveries: the ingestion date, then the time and name
    of its file, then its line (block and row in it).  To be taken where the files are read."""
    return F.struct(F.col("ingestion_date"), F.col("_metadata.file_modification_time").alias("file_time"),
                    F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def read_bronze(spark: SparkSession, base: str, dataset: str, ingestion_date: str, fmt: str,
                schema: T.StructType | str | None = None, keep_partition: bool = False,
                source_file: str | None = None, arrival: str | None = None) -> DataFrame:
    """One day of a landed dataset; ``source_file`` names a column for the path of each row's file,
    ``arrival`` one that orders rows by when they were landed (see :func:`arrival_order`).

    Reads the dataset root and filters on the ``ingestion_date`` partition
    column, so only that day's folder is listed and read (partition pruning);
    the column is dropped unless asked for, as a glob on the day folder would.
    """
    root = f"{base}/bronze/{dataset}"
    if fmt == "json":
        df = read_json(spark, root, schema)
    else:
        df = read_csv(spark, root, schema)
    marks = {source_file: F.col("_metadata.file_path")} if source_file else {}
    if arrival:
        marks[arrival] = arrival_order()
    df = df.select("*", *[c.alias(name) for name, c in marks.items()])
    df = df.filter(F.col("ingestion_date") == F.lit(ingestion_date).cast("date"))
    return df if keep_partition else df.drop("ingestion_date")
