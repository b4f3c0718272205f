"""Change-log scans.

The log is a folder of Parquet files with the columns of a broker record
(``partition int, offset long, timestamp, key binary, value binary``) laid out
by ``batch_id=<n>/``; ``read_change_batch`` is the bounded scan and
``read_change_stream`` the streaming one.  When a Kafka data source is on the
class path the same functions read a topic instead.

``events_change_log`` turns the driver's ``events`` table into such a log
(role map: key = user_id, op from event_type, ts_ms = event time floored to
the hour, partition = user_id % 4, offset = event_id, amount = value,
status = event_type, customer_id = props.k).
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.frames import add_frame
from rivulet.operators.cdc import envelope_schema, row_image_schema
from rivulet.session import content_token, published, shuffles_removed
from rivulet.sources.tables import table

LOG_SCHEMA = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("batch_id", T.LongType()),
])

# Row image of the captured orders table as it travels in the payload.
ORDER_IMAGE = row_image_schema({
    "order_id": "long", "customer_id": "long", "amount": "double", "status": "string",
    "currency": "string", "order_ts": "string", "created_at": "string", "updated_at": "string",
})
ORDER_ENVELOPE = envelope_schema(ORDER_IMAGE)

# Event type -> change operation (role map of the events table).
OP_BY_EVENT = {"signup": "c", "purchase": "r", "error": "d"}
DEFAULT_OP = "u"
SCHEMA_ID = 1
LOG_LAYOUT_VERSION = "3"
#: Writer tasks for each batch and broker partition, and offsets that stay together.
WRITERS_PER_PARTITION = 4
OFFSETS_PER_RUN = 100_000
HOUR_MS = 3_600_000
PARTITIONS = 4
DAYS_PER_BATCH = 3


def _op(event_type):
    expr = None
    for k, v in OP_BY_EVENT.items():
        expr = F.when(event_type == k, F.lit(v)) if expr is None else expr.when(event_type == k, F.lit(v))
    return expr.otherwise(F.lit(DEFAULT_OP))


def events_changes(events: DataFrame) -> DataFrame:
    """Flat change rows from the events table (before envelope encoding)."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("user_id").alias("order_id"),
        _op(F.col("event_type")).alias("op"),
        (F.floor(F.unix_millis(ts) / HOUR_MS) * HOUR_MS).cast("long").alias("ts_ms"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        ts.alias("event_time"),
        F.get_json_object("props", "$.k").cast("long").alias("customer_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("status"),
        F.when(F.col("user_id") % 2 == 0, F.lit("EUR")).otherwise(F.lit("USD")).alias("currency"),
        F.floor(F.unix_date(F.to_date(ts)) / DAYS_PER_BATCH).cast("long").alias("batch_id"),
    )


def envelope_records(changes: DataFrame) -> DataFrame:
    """Flat change rows -> broker records with a framed JSON envelope."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    image = F.struct(
        F.col("order_id"), F.col("customer_id"), F.col("amount"), F.col("status"), F.col("currency"),
        F.date_format("event_time", iso).alias("order_ts"),
        F.date_format(F.timestamp_millis(F.col("ts_ms")), iso).alias("created_at"),
        F.date_format("event_time", iso).alias("updated_at"))
    envelope = F.struct(
        F.col("op"), F.col("ts_ms"),
        F.when(F.col("op").isin("u", "d"), image).alias("before"),
        F.when(F.col("op") != "d", image).alias("after"),
        F.struct(F.col("ts_ms"), F.lit("erp").alias("db"), F.lit("orders").alias("table")).alias("source"),
        F.struct(F.concat(F.lit("tx-"), F.col("batch_id").cast("string")).alias("id")).alias("transaction"))
    return changes.select(
        F.col("partition"), F.col("offset"), F.col("event_time").alias("timestamp"),
        F.encode(F.col("order_id").cast("string"), "UTF-8").alias("key"),
        add_frame(F.encode(F.to_json(envelope), "UTF-8"), SCHEMA_ID).alias("value"),
        F.col("batch_id"))


def write_change_log(df_records: DataFrame, path: str, spread: int = WRITERS_PER_PARTITION) -> str:
    """Write records by batch into a new folder; the rows of a (batch, broker
    partition) are dealt over ``spread`` writer tasks by offset range, so that
    each file stays a run of offsets and no task writes a quarter of a batch."""
    run = F.floor(F.col("offset") / OFFSETS_PER_RUN) % spread
    (df_records.withColumn("_run", run).repartition("batch_id", "partition", "_run")
        .sortWithinPartitions("batch_id", "partition", "offset").drop("_run")
        .write.partitionBy("batch_id").parquet(path))
    return path


def events_change_log(spark: SparkSession, sf_dir: str) -> str:
    """The events change log, written once for the events as they are now."""
    token = content_token(spark, LOG_LAYOUT_VERSION, path=f"{sf_dir.rstrip('/')}/events.parquet")

    def build(folder: str) -> None:
        with shuffles_removed(spark):
            write_change_log(envelope_records(events_changes(table(spark, sf_dir, "events"))), folder)

    return published(spark, f"changelog-{token}", build)


def read_change_batch(spark: SparkSession, path: str, start: dict | str = "earliest",
                      end: dict | str = "latest") -> DataFrame:
    """Bounded scan of a change log.

    ``start``/``end`` are ``earliest``/``latest`` or ``{partition: offset}``
    (inclusive start, exclusive end, as broker offsets are).  The offset
    predicates are pushed into the Parquet scan.
    """
    return _between(spark.read.schema(LOG_SCHEMA).parquet(path), start, end)


def _between(log: DataFrame, start: dict | str, end: dict | str) -> DataFrame:
    """Records from ``start`` (inclusive) to ``end`` (exclusive), by partition; partitions not named are left out."""
    for bound, inside in ((start, lambda o: F.col("offset") >= o), (end, lambda o: F.col("offset") < o)):
        if isinstance(bound, dict):
            log = log.filter(reduce(lambda x, y: x | y, [(F.col("partition") == p) & inside(o) for p, o in bound.items()],
                                    F.lit(False)))
    return log


def kafka_options(kafka: dict, start: dict | str = "earliest", end: dict | str | None = None,
                  fail_on_data_loss: bool = True) -> dict[str, str]:
    """Options of a topic read: committed records only, headers for a bounded read
    (one with ``end``); offsets are ``earliest``/``latest`` or ``{partition: offset}``.  ``kafka`` has the last word."""
    def place(x):
        return x if isinstance(x, str) else json.dumps({kafka["subscribe"]: {str(p): o for p, o in x.items()}})

    options = {"kafka.isolation.level": "read_committed", "startingOffsets": place(start),
               "failOnDataLoss": str(fail_on_data_loss).lower()}
    if end is not None:
        options |= {"endingOffsets": place(end), "includeHeaders": "true"}
    return options | kafka


def read_change_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                       kafka: dict | None = None, start: dict | str = "earliest",
                       fail_on_data_loss: bool = True) -> DataFrame:
    """Streaming scan: Kafka when configured and available, else the log folder.

    ``start`` is ``earliest`` or ``{partition: offset}`` (inclusive); with
    ``fail_on_data_loss=False`` records or files that are gone are skipped
    instead of stopping the query.
    """
    if kafka:
        return spark.readStream.format("kafka").options(**kafka_options(kafka, start, fail_on_data_loss=fail_on_data_loss)).load()
    reader = spark.readStream.schema(LOG_SCHEMA).option("pathGlobFilter", "*.parquet") \
        .option("ignoreMissingFiles", str(not fail_on_data_loss).lower())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _between(reader.parquet(path), start, "latest")


def read_kafka_batch(spark: SparkSession, kafka: dict, start: dict | str = "earliest", end: dict | str = "latest") -> DataFrame:
    """Bounded read of a topic with its headers (needs the Kafka data source on the class path)."""
    return spark.read.format("kafka").options(**kafka_options(kafka, start, end)).load()
