"""Value schemas of the change log: lookup by subject, per schema id."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.frames import frame_schema_id, strip_frame


def normalize_schema_text(text: str) -> str:
    """Schema text as served by a registry may be JSON encoded twice; return plain JSON."""
    try:
        value = json.loads(text)
    except json.JSONDecodeError:
        return text
    return json.dumps(json.loads(value)) if isinstance(value, str) else json.dumps(value)


def value_schema(registry: dict | str, topic: str, version: str = "latest") -> T.StructType:
    """Schema of subject ``<topic>-value``.

    ``registry`` is a dict ``{subject: {version: schema_json}}`` or a folder, on
    any storage that Spark reads, holding ``<subject>.json`` files with that
    content.  The schema JSON is a Spark ``StructType`` JSON document.
    """
    subject = f"{topic}-value"
    if isinstance(registry, str):
        spark = SparkSession.active()
        text = spark.read.text(f"{registry.rstrip('/')}/{subject}.json", wholetext=True).first()[0]
        registry = {subject: json.loads(text)}
    versions = registry[subject]
    if version == "latest":
        version = max(versions, key=lambda v: int(v))
    return T.StructType.fromJson(json.loads(normalize_schema_text(versions[str(version)])))


def avro_available(spark: SparkSession) -> bool:
    """Whether Spark's Avro module is on the class path."""
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst", False,
                                           spark._jvm.java.lang.Thread.currentThread().getContextClassLoader())
        return True
    except Py4JJavaError:
        return False


def decode_avro(log: DataFrame, schema_text: str, mode: str = "FAILFAST") -> DataFrame:
    """Framed Avro records -> ``r`` (the decoded value) with partition, offset and timestamp; needs Spark's Avro module."""
    if not avro_available(log.sparkSession):
        raise RuntimeError("Avro payloads need the spark-avro module on the class path")
    from pyspark.sql.avro.functions import from_avro

    value = from_avro(strip_frame(F.col("value")), normalize_schema_text(schema_text), {"mode": mode})
    return log.select(value.alias("r"), "partition", "offset", "timestamp")


#: Types that a value of the named type widens to.
_WIDER = {"int": ("bigint", "float", "double", "decimal"), "bigint": ("double", "decimal"), "float": ("double",),
          "decimal": ("decimal", "double"), "date": ("timestamp",), "string": ("binary",), "binary": ("string",)}


def _kind(t: T.DataType) -> str:
    return t.simpleString().split("(")[0]


def widens(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of ``found`` has a place in ``wanted``."""
    if found == wanted:
        return True
    if _kind(wanted) not in _WIDER.get(_kind(found), ()):
        return False
    if isinstance(wanted, T.DecimalType):
        digits = {"int": (10, 0), "bigint": (19, 0)}.get(_kind(found)) or (found.precision, found.scale)
        return wanted.scale >= digits[1] and wanted.precision - wanted.scale >= digits[0] - digits[1]
    return True


@dataclass(frozen=True)
class ReaderSchema:
    """What a reader wants: its fields, ``defaults`` for those that a writer may
    lack, and ``aliases`` (older names) under which a writer may hold a field."""

    fields: T.StructType
    defaults: dict = field(default_factory=dict)
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def name_in(self, writer: T.StructType, name: str) -> str | None:
        """The name under which ``writer`` holds the reader's field, None if it doesn't."""
        return next((n for n in (name, *self.aliases.get(name, ())) if n in writer.names), None)


def unreadable(writer: T.StructType, reader: ReaderSchema) -> list[str]:
    """Why ``reader`` can't read what ``writer`` wrote; empty if it can."""
    said = []
    for f in reader.fields:
        name = reader.name_in(writer, f.name)
        if name is None and f.name not in reader.defaults:
            said.append(f"{f.name}: not written and without a default")
        elif name is not None and not widens(writer[name].dataType, f.dataType):
            said.append(f"{f.name}: {writer[name].dataType.simpleString()} doesn't widen to {f.dataType.simpleString()}")
    return said


def incompatible(old: ReaderSchema, new: ReaderSchema, mode: str = "backward") -> list[str]:
    """Why ``new`` may not follow ``old``: ``backward`` asks that new readers read
    old records, ``forward`` that old readers read new ones, ``full`` both."""
    if mode not in ("backward", "forward", "full"):
        raise ValueError(f"unknown compatibility mode {mode!r}")
    return (unreadable(old.fields, new) if mode != "forward" else []) + (unreadable(new.fields, old) if mode != "backward" else [])


def decode_versions(log: DataFrame, writers: dict[int, T.StructType], reader: ReaderSchema) -> DataFrame:
    """Decode records of many writer schemas into the reader's fields, in one pass.

    Every payload is parsed once, into all names that any writer uses; a reader's
    field is then what the record's own writer (the frame's schema id) calls it,
    widened to the reader's type, or the reader's default where that writer has
    no such field.  A NULL that was written stays NULL.  A record of an unknown
    id stops the query; writers that the reader can't read are refused up front.
    """
    for sid, writer in writers.items():
        if said := unreadable(writer, reader):
            raise ValueError(f"schema {sid} can't be read: {'; '.join(said)}")
    names = sorted({n for f in reader.fields for w in writers.values() if (n := reader.name_in(w, f.name))})
    # one type per name: writers that hold it may differ, the reader's type takes all of them
    wanted = {reader.name_in(w, f.name): f.dataType for f in reader.fields for w in writers.values()}
    sid = frame_schema_id(F.col("value"))
    parsed = F.from_json(strip_frame(F.col("value")).cast("string"), T.StructType([T.StructField(n, wanted[n]) for n in names]))
    rows = log.select(parsed.alias("r"), sid.alias("schema_id"), "partition", "offset", "timestamp")
    out = []
    for f in reader.fields:
        value = F.lit(None).cast(f.dataType)
        for name in {reader.name_in(w, f.name) for w in writers.values()}:
            ids = [i for i, w in writers.items() if reader.name_in(w, f.name) == name]
            here = F.lit(reader.defaults.get(f.name)) if name is None else F.col(f"r.{name}")
            value = F.when(F.col("schema_id").isin(ids), here.cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    unknown = F.raise_error(F.concat(F.lit("no writer schema for id "), F.coalesce(F.col("schema_id").cast("string"), F.lit("NULL"))))
    known = F.when(F.col("schema_id").isin(list(writers)), F.col("schema_id")).otherwise(unknown.cast("long"))
    return rows.select(*out, known.alias("schema_id"), "partition", "offset", "timestamp")


def decode_by_schema_id(log: DataFrame, schemas: dict[int, T.StructType]) -> DataFrame:
    """Decode every record with the schema its frame names into the union of all
    fields (NULL where a writer has none), in one pass."""
    fields: dict[str, T.DataType] = {}
    for schema in schemas.values():
        for f in schema:
            if f.name not in fields or widens(fields[f.name], f.dataType):
                fields[f.name] = f.dataType
    reader = ReaderSchema(T.StructType([T.StructField(n, t) for n, t in fields.items()]), dict.fromkeys(fields))
    known = log.filter(frame_schema_id(F.col("value")).isin(list(schemas)))
    return decode_versions(known, schemas, reader).drop("schema_id")
