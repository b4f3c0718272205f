"""JDBC scans and writes (need the database's driver jar on the class path)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, props: dict, partition_column: str | None = None,
              lower: int | None = None, upper: int | None = None, partitions: int = 8) -> DataFrame:
    """Table scan over JDBC.  With ``partition_column`` and bounds the read is
    split into ``partitions`` parallel range queries instead of one connection."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in props.items():
        r = r.option(k, v)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
               .option("upperBound", upper).option("numPartitions", partitions))
    return r.load()


def table_exists(spark: SparkSession, url: str, table: str, props: dict) -> bool:
    """Whether the database has ``table``, asked of its metadata."""
    jvm = spark.sparkContext._jvm
    options = jvm.java.util.Properties()
    for k, v in props.items():
        options.setProperty(k, str(v))
    if "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    connection = jvm.java.sql.DriverManager.getConnection(url, options)
    try:
        schema, _, plain = table.rpartition(".")
        found = connection.getMetaData().getTables(None, schema or None, plain, None)
        return bool(found.next())
    finally:
        connection.close()


def write_jdbc(df: DataFrame, url: str, table: str, props: dict, mode: str = "append",
               create_if_missing: bool = True, batch_size: int = 10_000) -> str:
    """Write over JDBC and return the mode used.  An append to a table that is
    not there creates it when ``create_if_missing`` is set; any failure of a
    write is raised, and an existing table is never replaced by an append."""
    if mode == "append" and not create_if_missing and not table_exists(df.sparkSession, url, table, props):
        raise LookupError(f"no table {table}")
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_size, **props).mode(mode).save()
    return mode


def export_mart(df: DataFrame, target: str, url: str | None = None, props: dict | None = None,
                partition_by: list[str] | None = None) -> None:
    """Mart export: to a warehouse table over JDBC when ``url`` is given, else
    as partitioned Parquet under ``target``."""
    if url:
        write_jdbc(df, url, target, props or {}, mode="overwrite")
    else:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(target)
