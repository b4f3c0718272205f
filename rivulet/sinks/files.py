"""Raw landing and small exports."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.context import DailyRun


def write_json_arrays(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write files that each hold one multi-line JSON array (what an external
    producer lands).  A task streams its rows out one line at a time, so the
    multi-line JSON reader parses every file whole and no task holds its rows."""
    records = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))

    def lines(batches):  # local, so that it travels to the executors by value
        held = None
        for batch in batches:
            out = []
            for record in batch["value"]:
                out.append("[" if held is None else held + ",")
                held = record
            if out:
                yield pd.DataFrame({"value": out})
        if held is not None:
            yield pd.DataFrame({"value": [held, "]"]})

    records.mapInPandas(lines, "value string").write.mode(mode).text(path)


def store_json_records(df: DataFrame, path: str, key: str) -> str:
    """One JSON object per record under ``<path>/<key>=<value>/``, written in parallel."""
    record = F.to_json(F.struct(*df.columns)).alias("value")
    df.select(key, record).write.mode("overwrite").partitionBy(key).text(path)
    return path


def land_raw(df: DataFrame, base: str, dataset: str, ctx: DailyRun, fmt: str = "csv") -> str:
    """Land a dataset under ``bronze/<dataset>/ingestion_date=<day>/``.

    The day folder is overwritten, so re-running a day replaces it (idempotent).
    """
    path = f"{base}/bronze/{dataset}/ingestion_date={ctx.ingestion_date}"
    if fmt == "json":
        write_json_arrays(df, path)
    else:
        df.write.mode("overwrite").option("header", True).csv(path)
    return path


def export_json(df: DataFrame, path: str) -> str:
    """Small single-file JSON export (for results already reduced to a few rows)."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def export_sample(df: DataFrame, n: int, path: str, order_by: list[str]) -> str:
    """Deterministic bounded sample: first ``n`` rows by ``order_by`` into one Parquet file."""
    df.orderBy(*order_by).limit(n).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def preview(df: DataFrame, n: int = 10) -> tuple[str, list]:
    """Schema string and the first ``n`` rows (only ``n`` rows reach the driver)."""
    return df.schema.simpleString(), df.limit(n).collect()
