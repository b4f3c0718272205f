"""Data-quality rules, the one-pass router and verdict helpers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``violated`` is a Column that is true when a row breaks the rule
    (write it NULL-aware: a NULL result means "not violated")."""

    code: str
    severity: str  # "error" rejects the row, "warning" keeps it
    violated: Column
    message: str


def tag(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``_violations``: array of (code, severity, message) for the rules a row breaks."""
    hits = [F.when(F.coalesce(r.violated, F.lit(False)),
                   F.struct(F.lit(r.code).alias("code"), F.lit(r.severity).alias("severity"),
                            F.lit(r.message).alias("message"))) for r in rules]
    return df.withColumn("_violations", F.array_compact(F.array(*hits)))


def rejected() -> Column:
    """True for a tagged row that breaks a rule of severity "error"."""
    return F.exists("_violations", lambda v: v["severity"] == "error")


def split(tagged: DataFrame, table: str, record_id: Column, batch_id: str, source_file: Column | None = None,
          payload: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Tagged rows -> valid rows, and one error row per broken rule.

    Bad rows never fail the run; a row with only warnings stays valid.
    ``payload`` names the columns of the stored original (default: all).
    """
    cols = payload or [c for c in tagged.columns if c != "_violations"]
    file = source_file if source_file is not None else F.lit(None)
    errors = (tagged.filter(F.size("_violations") > 0)
              .select(F.lit(table).alias("source_table"), file.cast("string").alias("source_file"),
                      record_id.cast("string").alias("record_id"), F.explode("_violations").alias("v"),
                      F.to_json(F.struct(*[F.col(c) for c in cols])).alias("raw_payload"))
              .select("source_table", "source_file", "record_id", F.col("v.code").alias("error_code"),
                      F.col("v.severity").alias("severity"), F.col("v.message").alias("error_message"), "raw_payload",
                      F.current_timestamp().alias("created_at"), F.lit(batch_id).alias("batch_id")))
    return tagged.filter(~rejected()).drop("_violations"), errors


def route(df: DataFrame, rules: list[Rule], table: str, record_id: Column, batch_id: str,
          source_file: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """One-pass router: tag, then split.  Both outputs come from the same plan
    (write the tagged rows first when both are written)."""
    return split(tag(df, rules), table, record_id, batch_id, source_file)


def suite(tagged: DataFrame, name: str, threshold: float) -> DataFrame:
    """Verdict of one dataset: rows, rejected rows, their ratio, and whether it is within the threshold."""
    counts = tagged.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(rejected(), 1)).alias("rejected"))
    ratio = F.col("rejected") / F.col("rows")
    return counts.select(F.lit(name).alias("suite"), "rows", "rejected", F.round(ratio, 6).alias("reject_ratio"),
                         F.lit(threshold).alias("threshold"), (ratio <= threshold).alias("passed"))


def gate(verdicts: DataFrame, passed_col: str = "passed") -> None:
    """Raise before anything downstream is written when a check failed.

    Only the verdict rows (one per check) reach the driver.
    """
    failed = verdicts.filter(~F.coalesce(F.col(passed_col), F.lit(False))).collect()
    if failed:
        raise RuntimeError(f"quality gate failed: {[r.asDict() for r in failed]}")


def observe_job(tagged: DataFrame, name: str, key_cols: list[str]):
    """Attach job counters (rows read, rejected, NULL keys) to tagged rows without an extra
    pass: whatever action writes them fills the counters in.  Returns (df, Observation)."""
    from functools import reduce

    from pyspark.sql import Observation
    obs = Observation(name)
    null_key = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in key_cols])
    return tagged.observe(obs, F.count(F.lit(1)).alias("read"), F.count(F.when(rejected(), 1)).alias("rejected"),
                          F.count(F.when(null_key, 1)).alias("null_keys")), obs
