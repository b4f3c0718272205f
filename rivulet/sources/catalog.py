"""Catalog scans and name-or-path loading (schema discovery: :mod:`rivulet.sources.discovery`)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def load_table(spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Table by catalog name, else by path; one clear error when neither works."""
    cause = None
    try:
        if spark.catalog.tableExists(name):
            return spark.table(name)
        said = [f"{name}: not in the catalog"]
    except AnalysisException as e:  # an unknown catalog or namespace
        cause, said = e, [f"{name}: {e}"]
    if path:
        try:
            return spark.read.format(fmt).load(path)
        except AnalysisException as e:
            cause = e
            said.append(f"{path}: {e}")
    raise RuntimeError("could not load the table by name or by path: " + "; ".join(said)) from cause


def list_namespaces(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, db: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(db)]
