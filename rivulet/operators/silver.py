"""Silver layer: typing, masking, normalising and de-duplicating raw data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.functions.masks import mask_prefix
from rivulet.functions.text import snake_case


def norm(c: Column) -> Column:
    """Normalised code value: trimmed and upper case."""
    return F.upper(F.trim(c))


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order`` (give it descending columns for
    "keep last"), then every remaining column ascending as a full tie-break so
    the survivor never depends on partitioning.

    ``row_number() = 1`` plans as a partial WindowGroupLimit before the shuffle.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def silver_customers(raw: DataFrame, arrival: str = "ingestion_date") -> DataFrame:
    """Masked copies of email and phone next to the raw ones; one row per customer, the latest by
    ``created_at`` and ``arrival`` (a column that orders deliveries) where the raw rows have them."""
    latest = [F.col(c).desc_nulls_last() for c in ("created_at", arrival) if c in raw.columns]
    masked = (raw.withColumn("email_masked", mask_prefix(F.col("email")))
                 .withColumn("phone_masked", mask_prefix(F.col("phone"))))
    return keep_last(masked, ["customer_id"], latest)


def typed_items(raw: DataFrame, id_type: str = "long", keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw string order items -> typed; a bad number becomes NULL (try_cast), never an error.
    ``id_type="string"`` keeps business keys such as ``O001`` as they are; ``keep`` carries further columns."""
    q = F.col("quantity").try_cast("decimal(12,2)")
    p = F.col("unit_price").try_cast("decimal(12,2)")
    return raw.select(F.col("order_id").try_cast(id_type).alias("order_id"),
                      F.col("product_id").try_cast(id_type).alias("product_id"),
                      q.alias("quantity"), p.alias("unit_price"),
                      (q * p).cast("decimal(18,4)").alias("line_total"), *keep)


def typed_orders(raw: DataFrame, statuses: list[str] | None = None, id_type: str = "long", keep: tuple[str, ...] = ()) -> DataFrame:
    ts = F.try_to_timestamp(F.col("order_timestamp"))
    st = norm(F.col("status"))
    out = raw.select(F.col("order_id").try_cast(id_type).alias("order_id"),
                     F.col("customer_id").try_cast(id_type).alias("customer_id"),
                     ts.alias("order_timestamp"), st.alias("status"),
                     F.to_date(ts).alias("order_date"), *keep)
    if statuses is not None:
        out = out.withColumn("status", F.when(F.col("status").isin(statuses), F.col("status")))
    return out


def add_cdc_audit_columns(changes: DataFrame, batch_id: str | Column, source_system: str) -> DataFrame:
    """Audit columns of normalised changes: operation, place in the log, event time,
    load time, batch id and source system (the operation and order columns become one set of names)."""
    bid = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    return (changes.withColumn("cdc_op", F.col("op"))
                   .withColumn("cdc_position", F.concat_ws(":", F.col("partition").cast("string"), F.col("offset").cast("string")))
                   .withColumn("event_ts", F.timestamp_millis("ts_ms"))
                   .withColumn("ingestion_ts", F.current_timestamp())
                   .withColumn("batch_id", bid).withColumn("source_system", F.lit(source_system))
                   .drop("op", "partition", "offset", "ts_ms"))


def standardize_names(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """snake_case every column name, then apply the rename map (documented -> coded names)."""
    mapping = {c: snake_case(c) for c in df.columns}
    out = df.withColumnsRenamed({k: v for k, v in mapping.items() if k != v})
    if rename:
        out = out.withColumnsRenamed({k: v for k, v in rename.items() if k in out.columns})
    return out


def add_audit_columns(df: DataFrame, batch_id: str | Column, source_system: str,
                      ingestion_date: Column | None = None) -> DataFrame:
    """Audit columns of a raw read: load time, ingestion date, source file (from
    the file source's ``_metadata``), batch id and source system."""
    bid = F.lit(batch_id) if isinstance(batch_id, str) else batch_id
    out = df.select("*", F.col("_metadata.file_path").alias("source_file"))
    return (out.withColumn("ingestion_timestamp", F.current_timestamp())
               .withColumn("ingestion_date", ingestion_date if ingestion_date is not None
                           else (F.col("ingestion_date") if "ingestion_date" in df.columns
                                 else F.current_date()))
               .withColumn("batch_id", bid)
               .withColumn("source_system", F.lit(source_system)))
