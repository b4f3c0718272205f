"""Change-data-capture operators: decode, normalise, collapse, merge, SCD.

All of them are DataFrame -> DataFrame and run the same inside a streaming
``foreachBatch`` callback and in a batch backfill.

Total order of changes: ``(ts_ms, partition, offset)``; across micro-batches
the batch id comes first (a later batch always wins, as in the reference's
MERGE per batch).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.frames import strip_frame, strip_frame_lenient

ORDER_COLS = ("ts_ms", "partition", "offset")


@dataclass(frozen=True)
class TableConfig:
    """What one captured table looks like after normalisation.

    ``key``: primary key (cast to long); ``columns``: non-key target columns and
    their types, taken from the ``after`` image; ``ts_col``: name of the
    second-precision event time column added to the target.
    """

    name: str
    key: str
    columns: dict = field(default_factory=dict)
    ts_col: str | None = "ts"

    @property
    def target_columns(self) -> list[str]:
        cols = [self.key, *self.columns]
        if self.ts_col:
            cols.append(self.ts_col)
        return cols


# The orders stream target of the reference (order_id, customer_id, amount, status, ts).
ORDERS = TableConfig("orders", "order_id",
                     {"customer_id": "long", "amount": "decimal(12,2)", "status": "string"})


_SIMPLE_TYPES = {"long": T.LongType(), "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
                 "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(),
                 "date": T.DateType(), "binary": T.BinaryType()}


def parse_type(name: str) -> T.DataType:
    """Type name as used in table configs (``long``, ``decimal(12,2)``, ...) -> DataType."""
    name = name.strip().lower()
    if name.startswith("decimal(") and name.endswith(")"):
        p, s = name[8:-1].split(",")
        return T.DecimalType(int(p), int(s))
    return _SIMPLE_TYPES[name]


def row_image_schema(fields: dict) -> T.StructType:
    return T.StructType([T.StructField(n, parse_type(t), True) for n, t in fields.items()])


def envelope_schema(image: T.StructType) -> T.StructType:
    """Change event envelope: op, ts_ms, before/after images, source, transaction."""
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("before", image),
        T.StructField("after", image),
        T.StructField("source", T.StructType([
            T.StructField("ts_ms", T.LongType()),
            T.StructField("db", T.StringType()),
            T.StructField("table", T.StringType()),
        ])),
        T.StructField("transaction", T.StructType([T.StructField("id", T.StringType())])),
    ])


# ---------------------------------------------------------------- decoding

def decode(log: DataFrame, schema: T.StructType, mode: str = "FAILFAST", lenient_frame: bool = False) -> DataFrame:
    """Log records -> ``r`` (the decoded envelope) plus partition/offset/timestamp.

    FAILFAST stops the query on an undecodable record, as the reference does;
    use :func:`split_dead_letters` to route bad records instead.  The envelope
    comes out of a generator, so that later filters on it do not parse it again.
    """
    strip = strip_frame_lenient if lenient_frame else strip_frame
    payload = strip(F.col("value")).cast("string")
    extra = [c for c in ("batch_id",) if c in log.columns]
    return log.select(F.explode(F.array(F.from_json(payload, schema, {"mode": mode}))).alias("r"),
                      "partition", "offset", "timestamp", *extra)


def split_dead_letters(log: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """PERMISSIVE decode; records whose payload is missing, not an object, or
    lacks ``op`` go to the dead-letter side with a cause.  No record is lost.
    """
    with_corrupt = T.StructType(schema.fields + [T.StructField("_corrupt", T.StringType())])
    payload = strip_frame(F.col("value")).cast("string")
    parsed = log.select("*", payload.alias("_payload")).withColumn(
        "r", F.from_json(F.col("_payload"), with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    cause = (F.when(F.col("value").isNull(), F.lit("NULL_VALUE"))
              .when(F.col("_payload").isNull(), F.lit("SHORT_FRAME"))
              .when(F.col("r").isNull() | F.col("r._corrupt").isNotNull(), F.lit("UNPARSEABLE"))
              .when(F.col("r.op").isNull(), F.lit("NOT_A_CHANGE")))
    tagged = parsed.withColumn("dead_cause", cause)
    good = (tagged.filter(F.col("dead_cause").isNull())
                  .select(F.col("r").dropFields("_corrupt").alias("r"), "partition", "offset", "timestamp"))
    dead = tagged.filter(F.col("dead_cause").isNotNull()).select(
        "partition", "offset", "timestamp", F.col("dead_cause").alias("cause"),
        F.col("_payload").alias("raw_payload"))
    return good, dead


# ---------------------------------------------------------------- normalise

def normalize(decoded: DataFrame, cfg: TableConfig, soft_delete: bool = False,
              with_event_ts: bool = False) -> DataFrame:
    """Envelope -> one flat change row: op, order columns, key, typed columns, ts.

    Key = coalesce(after.key, before.key); other columns come from ``after``
    only (a delete carries NULLs) unless ``soft_delete`` keeps the ``before``
    image for deletes.  Rows without a key are dropped.
    """
    def image(c: str) -> Column:
        if soft_delete:
            return F.coalesce(F.col(f"r.after.{c}"), F.col(f"r.before.{c}"))
        return F.col(f"r.after.{c}")

    cols = [F.col("r.op").alias("op"), F.col("r.ts_ms").cast("long").alias("ts_ms"),
            F.col("partition"), F.col("offset"),
            F.coalesce(F.col(f"r.after.{cfg.key}"), F.col(f"r.before.{cfg.key}")).cast("long").alias(cfg.key)]
    cols += [image(c).cast(t).alias(c) for c, t in cfg.columns.items()]
    if cfg.ts_col:
        cols.append(F.timestamp_seconds(F.floor(F.col("r.ts_ms") / 1000)).alias(cfg.ts_col))
    if with_event_ts:
        # millisecond event time next to the second-precision ``ts`` the target keeps
        cols.append(F.timestamp_millis(F.col("r.ts_ms")).alias("event_ts"))
    extra = [F.col("batch_id")] if "batch_id" in decoded.columns else []
    return decoded.select(*cols, *extra).where(F.col(cfg.key).isNotNull())


# ---------------------------------------------------------------- collapse

def collapse(changes: DataFrame, cfg: TableConfig, order: tuple[str, ...] = ORDER_COLS) -> DataFrame:
    """Keep the last change per key by ``order`` descending.

    ``row_number() = 1`` is planned by Spark as a partial WindowGroupLimit
    before the shuffle plus a final one after it, so a hot key is cut to one
    row per map task before anything moves.
    """
    w = Window.partitionBy(cfg.key).orderBy(*[F.col(c).desc() for c in order])
    return changes.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# ---------------------------------------------------------------- merge

def merge(target: DataFrame, changes: DataFrame, cfg: TableConfig, soft_delete: bool = False,
          guard: bool = False) -> DataFrame:
    """MERGE of collapsed changes (one row per key) into a target state.

    matched & op='d'   -> delete (``soft_delete``: keep with is_deleted = true)
    matched            -> update every non-key column (NULL overwrites)
    not matched & op<>'d' -> insert;  NULL op: matched -> update, else ignored.

    Plain mode is a left join + an anti join: the target is only streamed past
    the change keys (a broadcast when the change set is small, as a micro-batch
    is).  ``soft_delete`` and ``guard`` (apply a change only when it is newer,
    by those of ``ts_ms, partition, offset`` that the target keeps, than the
    row it replaces) use one full outer join on the key.
    """
    key = cfg.key
    cols = [c for c in cfg.target_columns if c != key]
    if not soft_delete and not guard:
        return _merge_plain(target, changes, key, cols)
    marks = [c for c in ORDER_COLS if c in target.columns] if guard else []
    t = target.select(key, *cols, *marks,
                      *([F.col("is_deleted")] if soft_delete and "is_deleted" in target.columns else []))
    s_cols = [key, "op", *cols, *marks]
    s = changes.select(*s_cols)
    ts_ = t.select([F.col(c).alias(f"t_{c}") for c in t.columns])
    ss = s.select([F.col(c).alias(f"s_{c}") for c in s.columns])
    j = ts_.join(ss, ts_[f"t_{key}"] == ss[f"s_{key}"], "full_outer")
    matched = F.col(f"t_{key}").isNotNull()
    has_change = F.col(f"s_{key}").isNotNull()
    op = F.col("s_op")
    if marks:
        newer = F.col(f"t_{marks[0]}").isNull() | (F.struct(*[F.col(f"s_{c}") for c in marks])
                                                   > F.struct(*[F.col(f"t_{c}") for c in marks]))
        has_change = has_change & (~matched | newer)
    is_delete = F.coalesce(op == "d", F.lit(False))
    take_source = has_change & (matched | F.coalesce(op != "d", F.lit(False)))
    if soft_delete:
        keep = ~has_change | take_source | is_delete
        deleted = (F.when(has_change, is_delete)
                    .otherwise(F.coalesce(F.col("t_is_deleted"), F.lit(False)) if "t_is_deleted" in j.columns
                               else F.lit(False)))
        out = j.filter(keep).select(
            F.coalesce(F.col(f"s_{key}"), F.col(f"t_{key}")).alias(key),
            *[F.when(has_change, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in cols],
            deleted.alias("is_deleted"))
        return out
    keep = (~has_change & matched) | (take_source & ~is_delete)
    out = j.filter(keep).select(
        F.when(has_change, F.col(f"s_{key}")).otherwise(F.col(f"t_{key}")).alias(key),
        *[F.when(has_change, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in cols],
        *[F.when(has_change, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c) for c in marks])
    return out


def _merge_plain(target: DataFrame, changes: DataFrame, key: str, cols: list[str]) -> DataFrame:
    # one left join streams the target past the change keys (a broadcast when
    # the change set is small), one anti join finds the inserts; nothing runs here
    s = changes.select(F.col(key).alias("_k"), "op", *[F.col(c).alias(f"_s_{c}") for c in cols])
    met = F.col("_k").isNotNull()
    kept = target.select(key, *cols).join(s, F.col(key) == F.col("_k"), "left") \
        .filter(~met | F.coalesce(F.col("op") != "d", F.lit(True))) \
        .select(key, *[F.when(met, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) for c in cols])
    inserts = changes.filter(F.coalesce(F.col("op") != "d", F.lit(False))).select(key, *cols) \
        .join(target.select(key), key, "left_anti")
    return kept.unionByName(inserts.select(key, *cols))


def resnapshot(source: DataFrame, cfg: TableConfig, snapshot_ts_ms: int, predicate: Column | None = None,
               order_col: str | None = None) -> DataFrame:
    """Re-read a bounded slice of the source table as ``op='r'`` change rows
    (an incremental snapshot) stamped ``snapshot_ts_ms``, ready to be unioned
    with the live changes and collapsed: a later live change of a key wins."""
    df = source if predicate is None else source.filter(predicate)
    cols = [F.col(c).cast(t).alias(c) for c, t in cfg.columns.items()]
    return df.select(F.lit("r").alias("op"), F.lit(snapshot_ts_ms).cast("long").alias("ts_ms"),
                     F.lit(-1).alias("partition"), F.col(order_col or cfg.key).cast("long").alias("offset"),
                     F.col(cfg.key).cast("long").alias(cfg.key), *cols)


def apply_changes(target: DataFrame, changes: DataFrame, cfg: TableConfig, **kw) -> DataFrame:
    """Collapse a raw batch of changes and merge it (one micro-batch of D7)."""
    return merge(target, collapse(changes, cfg), cfg, **kw)


# ---------------------------------------------------------------- de-duplication

def dedup(changes: DataFrame, cfg: TableConfig, by: tuple[str, ...] = ("ts_ms", "op")) -> DataFrame:
    """One row per (key, source ts, op): the first delivered copy (lowest
    partition, offset) survives.  A grouped min over a struct: partial
    aggregation runs map-side, so replays of a hot key are cut before the shuffle.
    """
    keep = [c for c in changes.columns if c not in (cfg.key, *by)]
    first = F.min(F.struct(*[F.col(c) for c in ("partition", "offset")],
                           *[F.col(c) for c in keep if c not in ("partition", "offset")])).alias("_m")
    g = changes.groupBy(cfg.key, *by).agg(first)
    return g.select(cfg.key, *by, *[F.col(f"_m.{c}").alias(c) for c in keep])


# ---------------------------------------------------------------- flattened view (D8)

def flatten(decoded: DataFrame, image_cols: list[str], key: str) -> DataFrame:
    """Analyst view: op, is_snapshot, source fields, tx id and the chosen image
    (after for c/r/u, before otherwise)."""
    use_after = F.col("r.op").isin("c", "r", "u")
    cols = [F.col("r.op").alias("op"), (F.col("r.op") == F.lit("r")).alias("is_snapshot"),
            F.col("r.source.ts_ms").alias("source_ts_ms"), F.col("r.source.db").alias("src_db"),
            F.col("r.source.table").alias("src_table"), F.col("r.transaction.id").alias("tx_id")]
    cols += [F.when(use_after, F.col(f"r.after.{c}")).otherwise(F.col(f"r.before.{c}")).alias(c)
             for c in [key, *image_cols]]
    return decoded.select(*cols, "partition", "offset")


# ---------------------------------------------------------------- SCD type 2

DAY_MS = 86_400_000


def scd2_history(changes: DataFrame, cfg: TableConfig, value_cols: list[str] | None = None,
                 order: tuple[str, ...] = ORDER_COLS, chunk_ms: int = DAY_MS) -> DataFrame:
    """Versions per key: consecutive identical images are one version;
    ``valid_from`` = ts of the change, ``valid_to`` = ts of the next kept change
    (a delete closes the open version and opens none), ``is_current`` for the
    open version of a live key.

    The previous / next change of a key come from :mod:`rivulet.operators.sequence`,
    whose windows are cut into ``chunk_ms`` event-time chunks, so a key with a
    very long history is not one task.  No job runs before the result is asked.
    """
    from rivulet.operators.sequence import shift, time_chunk
    key, ts = cfg.key, cfg.ts_col
    vals = value_cols or list(cfg.columns)
    chunk = time_chunk(F.col("ts_ms"), chunk_ms)
    base = changes.select(key, "op", *order, ts, *vals)
    step = shift(base, key, list(order), F.struct(F.struct(*[F.col(c) for c in vals]).alias("img"),
                                                   F.col("op").alias("op")), "_prev", chunk)
    img = F.struct(*[F.col(c) for c in vals])
    changed = (F.coalesce(F.col("op") == "d", F.lit(False)) | F.col("_prev").isNull()
               | F.coalesce(F.col("_prev.op") == "d", F.lit(False))
               | ~img.eqNullSafe(F.col("_prev.img")))
    kept = step.filter(changed).drop("_prev")
    versions = (shift(kept, key, list(order), F.col(ts), "valid_to", chunk, forward=True)
                .filter(~F.coalesce(F.col("op") == "d", F.lit(False))))
    return versions.select(key, *vals, F.col(ts).alias("valid_from"), "valid_to",
                           F.col("valid_to").isNull().alias("is_current"), *[c for c in order if c != "ts_ms"])


def as_of_lookup(facts: DataFrame, versions: DataFrame, key: str, fact_ts: str,
                 value_cols: list[str], tie_break: list[str] | None = None, chunk_ms: int = DAY_MS) -> DataFrame:
    """Attach to each fact the dimension version valid at its time
    (``valid_from <= ts < valid_to``; open versions have ``valid_to`` NULL).

    Written as a union + "last version so far" scan instead of a range join,
    so no (fact, version) pair is ever materialised; the scan is chunked by
    event time (see :mod:`rivulet.operators.sequence`) so a hot key is spread
    over many tasks.
    """
    from rivulet.operators.sequence import last_non_null, time_chunk
    tb = tie_break or []
    v = versions.select(F.col(key), F.col("valid_from").alias("_t"), F.lit(0).alias("_kind"),
                        F.struct(*[F.col(c) for c in tb]).alias("_tb"),
                        F.struct(*[F.col(c) for c in value_cols], F.col("valid_to")).alias("_v"))
    fcols = [c for c in facts.columns]
    f = facts.select(F.col(key), F.col(fact_ts).cast("timestamp").alias("_t"), F.lit(1).alias("_kind"),
                     F.lit(None).cast(v.schema["_tb"].dataType).alias("_tb"),
                     F.lit(None).cast(v.schema["_v"].dataType).alias("_v"), F.struct(*fcols).alias("_f"))
    v = v.withColumn("_f", F.lit(None).cast(f.schema["_f"].dataType))
    both = v.unionByName(f)
    chunk = time_chunk(F.unix_millis(F.col("_t")), chunk_ms)
    u = last_non_null(both, key, ["_t", "_kind", "_tb"], "_v", "_cur", chunk).filter(F.col("_kind") == 1)
    valid = F.col("_cur").isNotNull() & (F.col("_cur.valid_to").isNull() | (F.col("_t") < F.col("_cur.valid_to")))
    return u.select(*[F.col(f"_f.{c}").alias(c) for c in fcols],
                    *[F.when(valid, F.col(f"_cur.{c}")).alias(c) for c in value_cols])
