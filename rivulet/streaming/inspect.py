"""What a stopped or running stream keeps: its state by operator, store and partition, read from the checkpoint."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUMMARY = ("operator_id long, operator_name string, store string, batch_id long, partition_id int, rows long, keys long, "
           "first_expiry timestamp, last_expiry timestamp")


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per stateful operator and store of the query: id, name, store, partitions, first and last batch kept."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId")


def state_rows(spark: SparkSession, checkpoint: str, operator_id: int = 0, store: str | None = None,
               batch_id: int | None = None) -> DataFrame:
    """(key, value, partition_id) of one operator's state, after its newest batch or ``batch_id``."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    if store:
        reader = reader.option("storeName", store)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def _expiry(value: T.DataType):
    """The time at which a state row goes, where its value says so."""
    names = value.names if isinstance(value, T.StructType) else []
    if "expiresAtMicros" in names:
        return F.timestamp_micros("value.expiresAtMicros")
    return F.lit(None).cast("timestamp")


def state_summary(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows, keys and expiry times of the state, per operator, store and partition (partitions without rows are left out).

    The operators and stores of one query are few and listed on the driver; their
    rows are read and counted on the executors.
    """
    parts = []
    for op in state_operators(spark, checkpoint).distinct().collect():
        rows = state_rows(spark, checkpoint, op.operatorId, op.stateStoreName)
        at = _expiry(rows.schema["value"].dataType)
        parts.append(rows.groupBy("partition_id").agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("key").alias("keys"), F.min(at).alias("first_expiry"),
            F.max(at).alias("last_expiry")).select(
            F.lit(op.operatorId).cast("long").alias("operator_id"), F.lit(op.operatorName).alias("operator_name"),
            F.lit(op.stateStoreName).alias("store"), F.lit(op.maxBatchId).cast("long").alias("batch_id"),
            F.col("partition_id").cast("int").alias("partition_id"), "rows", "keys", "first_expiry", "last_expiry"))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], SUMMARY)
