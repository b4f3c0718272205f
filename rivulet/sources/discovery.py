"""Schemas found in raw files, and how they differ from the expected ones.

Every value of every file is classified and counted on the executors; only the
counts, one row per column and class, are combined to the least common type.
Columns may come and go between the files of a dataset, and each CSV file has
its own header.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Classes of text values, first match first; NULL and empty values have none.
_TEXT = (("bigint", r"^[+-]?[0-9]{1,18}$"), ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
         ("boolean", r"^(?i)(true|false)$"))
_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIMESTAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"


def text_class(value: Column) -> Column:
    """The narrowest type that reads a text value: bigint, double, boolean, date, timestamp or string; NULL if it is empty."""
    out = F.when(value.isNull() | (value == ""), F.lit(None))
    for name, pattern in _TEXT:
        out = out.when(value.rlike(pattern), F.lit(name))
    out = out.when(value.rlike(_DATE) & value.try_cast("date").isNotNull(), F.lit("date"))
    return out.when(value.rlike(_TIMESTAMP) & value.try_cast("timestamp").isNotNull(), F.lit("timestamp")).otherwise(F.lit("string"))


def variant_class(value: Column) -> Column:
    """The type of a JSON value: bigint, double, boolean, string, array or struct; NULL for null."""
    kind = F.lower(F.regexp_extract(F.schema_of_variant(value), r"^[A-Za-z]+", 0))
    return F.when(kind == "void", F.lit(None)).when(kind.isin("decimal", "float", "double"), F.lit("double")) \
        .when(kind == "object", F.lit("struct")).otherwise(kind)


def common_type(classes: Column) -> Column:
    """Least common type of an array of distinct classes: whole numbers widen to
    double, dates to timestamps, anything else that differs to string; void if there is none."""
    only = lambda *names: F.size(F.array_except(classes, F.array(*map(F.lit, names)))) == 0
    return F.when(F.size(classes) == 0, F.lit("void")).when(F.size(classes) == 1, F.get(classes, 0)) \
        .when(only("bigint", "double"), F.lit("double")).when(only("date", "timestamp"), F.lit("timestamp")) \
        .otherwise(F.lit("string"))


def _typed(counts: DataFrame) -> DataFrame:
    """(column, class, n) -> (column, type)."""
    return counts.groupBy("column").agg(F.collect_set(F.when(F.col("n") > 0, F.col("class"))).alias("classes")) \
        .select("column", common_type(F.col("classes")).alias("type"))


def discover_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """(column, type) of a folder of CSV files, each with its own header line and its own columns.

    Values are counted per file and position, together with the header's own
    cells; the header, the first line of a file, is then looked up per file (one
    row each) to name the positions, and its cells are taken off the counts.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at")).where("value <> ''")
    # a text in the buffer of min_by alone makes Spark sort every line by its file; beside a
    # collection (here of one number) the aggregate hashes: one line per file and task is held
    headers = lines.where("start = 0").groupBy("file") \
        .agg(F.min_by("value", "at").alias("header"), F.collect_set("start").alias("starts")).where("size(starts) > 0").drop("starts")
    width = headers.agg(F.max(F.size(F.split("header", F.lit("\\Q" + sep + "\\E"))))).first()[0] or 1
    generic = ", ".join(f"c{i} string" for i in range(width))

    def cells(text: str) -> Column:
        row = F.from_csv(F.col(text), generic, {"sep": sep})
        return F.array(*[row[f"c{i}"] for i in range(width)])

    counts = lines.select("file", F.posexplode(cells("value")).alias("pos", "v")) \
        .groupBy("file", "pos", text_class(F.col("v")).alias("class")).agg(F.count("*").alias("n"))
    named = headers.select("file", F.posexplode(cells("header")).alias("pos", "column")).where("column IS NOT NULL")
    own = named.select("file", "pos", text_class(F.col("column")).alias("class"), F.lit(-1).cast("long").alias("n"))
    per_column = counts.unionByName(own).groupBy("file", "pos", "class").agg(F.sum("n").alias("n")).join(named, ["file", "pos"])
    return _typed(per_column.groupBy("column", "class").agg(F.sum("n").alias("n")))


def discover_json(spark: SparkSession, path: str) -> DataFrame:
    """(column, type) of a folder of JSON files: one object per line, or arrays with one object per line."""
    line = F.regexp_replace(F.trim("value"), r"^[\[,]+\s*|\s*[,\]]+$", "")
    objects = spark.read.text(path).select(F.try_parse_json(line).alias("v")).where("v IS NOT NULL")
    fields = objects.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).select("key", F.col("value").alias("item"))
    return _typed(fields.groupBy(F.col("key").alias("column"), variant_class(F.col("item")).alias("class"))
                  .agg(F.count("*").alias("n")))


def drift(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(dataset, column, change, expected, found): columns ``added`` or ``missing``, or whose type ``type_changed``.

    Both sides are (dataset, column, type); a column that holds no value at all
    (void) fits every type.
    """
    both = found.withColumnRenamed("type", "found").join(expected.withColumnRenamed("type", "expected"), ["dataset", "column"], "full")
    change = F.when(F.col("expected").isNull(), "added").when(F.col("found").isNull(), "missing") \
        .when((F.col("found") != F.col("expected")) & (F.col("found") != "void"), "type_changed")
    return both.select("dataset", "column", change.alias("change"), "expected", "found").where("change IS NOT NULL")
