"""Compaction of many small files by bytes: a plain job over a partitioned Parquet folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rivulet.session import scratch_path

MB = 1024 * 1024


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, folder, bytes) of the data files below ``path``; listed by Spark, no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return found.select(F.col("path").alias("file"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"),
                        F.col("length").alias("bytes"))


def size_profile(files: DataFrame) -> DataFrame:
    """Files, total, mean, smallest and largest bytes per folder."""
    return files.groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.avg("bytes").alias("mean_bytes"),
                                       F.min("bytes").alias("smallest_bytes"), F.max("bytes").alias("largest_bytes"))


def pack_files(files: DataFrame, target_bytes: int = 256 * MB, small_bytes: int = 128 * MB) -> DataFrame:
    """(file, folder, bytes, bin) of the folders that hold at least two small files.

    A folder's small files fill bins in order of name: a file belongs to the bin
    in which its first byte falls, so a bin holds at most ``target_bytes`` plus
    one small file.  A file that is not small keeps a bin of its own (a negative number).
    """
    order = Window.partitionBy("folder", "small").orderBy("file")
    before = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes")
    marked = files.withColumn("small", F.col("bytes") < small_bytes)
    crowded = marked.groupBy("folder").agg(F.count_if("small").alias("n")).where("n > 1").select("folder")
    return marked.join(crowded, "folder", "left_semi").select(
        "file", "folder", "bytes", F.when(F.col("small"), F.floor(before / target_bytes)).otherwise(-F.row_number().over(order)).alias("bin"))


def compact_files(spark: SparkSession, path: str, partition_by: list[str], target_bytes: int = 256 * MB,
                  small_bytes: int = 128 * MB) -> int:
    """Rewrite the partition folders of ``path`` that hold two or more small files, one file per bin; returns the number of bins.

    Folders without them are neither read nor written.  The new files are written
    next to the table first and the folders overwritten from there, so a run that
    stops can be repeated.  A bin is one writer's work: its bytes are bounded.
    """
    packed = pack_files(list_files(spark, path), target_bytes, small_bytes)
    number = F.row_number().over(Window.orderBy("folder", "bin")) - 1  # one row per bin, not per file
    bins = scratch_path(spark, "file-bins")
    packed.join(packed.select("folder", "bin").distinct().withColumn("at", number), ["folder", "bin"]) \
        .select("file", F.col("at").cast("int").alias("at")).write.parquet(bins)
    plan = spark.read.parquet(bins)
    n = (plan.agg(F.max("at")).first()[0] or 0) + 1 if plan.take(1) else 0
    if not n:
        return 0
    rows = spark.read.parquet(path)
    names = rows.columns
    # a bin is one task and so one file; partition values come from the table's layout
    staged = scratch_path(spark, "compacted")
    rows.select("*", F.col("_metadata.file_path").alias("file")).join(plan, "file").select(*names, "at") \
        .write.parquet(staged)
    spark.read.parquet(staged).repartitionById(n, "at").select(*names) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    return n
