"""Catalog tables over Parquet in the shared folder: create-or-replace, seeding, DDL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import shared_dir


def ensure_namespace(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{shared_dir(spark)}/warehouse/{db}.db'")


def unique_table_name(spark: SparkSession, db: str, name: str) -> str:
    ensure_namespace(spark, db)
    return f"{db}.{name}_{uuid.uuid4().hex[:8]}"


def table_location(spark: SparkSession, name: str) -> str:
    db, tbl = name.split(".", 1)
    return f"{shared_dir(spark)}/warehouse/{db}.db/{tbl}"


def write_table(df: DataFrame, name: str) -> None:
    """Create or replace a Parquet table (full overwrite; a rerun replaces it)."""
    spark = df.sparkSession
    if "." in name:
        ensure_namespace(spark, name.split(".", 1)[0])
    df.write.mode("overwrite").format("parquet").option("path", table_location(spark, name)).saveAsTable(name)


def ensure_table(spark: SparkSession, name: str, ddl: str, partition_by: list[str] | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS with an optional derived-date partition column."""
    ensure_namespace(spark, name.split(".", 1)[0])
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{part} "
              f"LOCATION '{table_location(spark, name)}'")


def ensure_seeded(spark: SparkSession, name: str, seed: DataFrame) -> bool:
    """Create ``name`` from ``seed`` when it does not exist; returns True when it created it."""
    if spark.catalog.tableExists(name):
        return False
    write_table(seed, name)
    return True


def add_column(spark: SparkSession, name: str, column: str, dtype: str) -> None:
    """Add a nullable column without rewriting data files (old files read it as NULL)."""
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({column} {dtype})")


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], spread: int = 8,
                      max_records_per_file: int = 5_000_000) -> None:
    """Partitioned layout (days, months, ...).  Rows of one partition value are
    spread over ``spread`` writer tasks so a hot day does not land in one task."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(spread))
    (df.repartition(*[F.col(c) for c in partition_cols], salt)
       .write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(*partition_cols).parquet(path))


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """Bucketed table: later joins and aggregations on ``key`` need no shuffle."""
    spark = df.sparkSession
    ensure_namespace(spark, name.split(".", 1)[0])
    (df.write.mode("overwrite").format("parquet").option("path", table_location(spark, name))
       .bucketBy(buckets, key).sortBy(key).saveAsTable(name))


def upsert_table(df: DataFrame, name: str, key: str, order: list[str] | None = None) -> None:
    """Silver "upsert" mode: rows of ``df`` replace rows with the same key, other rows stay.

    Of rows of ``df`` that share a key the last one by ``order`` counts (then by
    all columns).  The merged table is written to a new folder, and one catalog
    change points the table there: readers see the old or the new content.
    """
    from rivulet.operators.silver import keep_last
    from rivulet.session import scratch_path

    spark = df.sparkSession
    last = keep_last(df, [key], [F.col(c).desc_nulls_last() for c in order or []])
    if spark.catalog.tableExists(name):
        old = spark.table(name).select(*df.columns)
        last = old.join(last.select(key), key, "left_anti").select(*df.columns).unionByName(last)
    else:
        ensure_namespace(spark, name.split(".", 1)[0])
    folder = scratch_path(spark, name.replace(".", "-"))
    last.write.parquet(folder)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=folder, source="parquet")
