"""Writer and reader schemas: aliases, defaults, widening, refusals, unknown ids."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.frames import add_frame
from rivulet.operators.cdc import row_image_schema as schema
from rivulet.session import scratch_path
from rivulet.sources import schemas as S


def log(spark, rows):
    df = spark.createDataFrame([(i, json.dumps(r) if r is not None else None, sid) for i, (sid, r) in enumerate(rows)],
                               "offset long, payload string, sid int")
    value = F.lit(None).cast("binary")
    for sid in {s for s, _ in rows}:
        value = F.when(F.col("sid") == sid, add_frame(F.encode("payload", "UTF-8"), sid)).otherwise(value)
    return df.select(F.lit(0).alias("partition"), "offset", F.lit(None).cast("timestamp").alias("timestamp"), value.alias("value"))


OLD = schema({"id": "int", "amount": "decimal(8,2)", "note": "string"})
MID = schema({"id": "long", "total": "double", "note": "string"})
NEW = schema({"id": "long", "total": "double", "currency": "string"})
READER = S.ReaderSchema(schema({"id": "long", "total": "double", "currency": "string"}), {"currency": "EUR"}, {"total": ("amount",)})


def test_three_generations_in_one_pass(spark):
    rows = [(1, {"id": 1, "amount": 2.5, "note": "x"}), (2, {"id": 2 ** 40, "total": 1.0}),
            (3, {"id": 3, "total": 4.0, "currency": "USD"}), (3, {"id": 4, "total": None, "currency": None}),
            # a name that another generation gave up is not this writer's field
            (2, {"id": 5, "amount": 9.0, "currency": "GBP"})]
    out = S.decode_versions(log(spark, rows), {1: OLD, 2: MID, 3: NEW}, READER)
    assert sorted(tuple(r) for r in out.select("id", "total", "currency", "schema_id").collect()) == [
        (1, 2.5, "EUR", 1), (3, 4.0, "USD", 3), (4, None, None, 3), (5, None, "EUR", 2), (2 ** 40, 1.0, "EUR", 2)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == plan.count("from_json(") and "Union" not in plan


def test_unknown_id_stops(spark):
    with pytest.raises(Exception, match="no writer schema for id 7"):
        S.decode_versions(log(spark, [(7, {"id": 1})]), {1: OLD}, READER).collect()


def test_compatibility():
    old = S.ReaderSchema(OLD)
    assert S.unreadable(OLD, READER) == []
    assert S.incompatible(old, READER) == []
    assert S.incompatible(old, S.ReaderSchema(NEW, {"currency": "EUR"})) == ["total: not written and without a default"]
    assert S.incompatible(old, READER, "forward") == [
        "id: bigint doesn't widen to int", "amount: not written and without a default", "note: not written and without a default"]
    assert len(S.incompatible(old, READER, "full")) == 3
    with pytest.raises(ValueError):
        S.incompatible(old, READER, "sideways")
    with pytest.raises(ValueError, match="schema 1 can't be read"):
        S.decode_versions(None, {1: OLD}, S.ReaderSchema(schema({"other": "string"})))


@pytest.mark.parametrize("found, wanted, ok", [
    ("int", "long", True), ("long", "int", False), ("int", "decimal(10,0)", True), ("int", "decimal(9,0)", False),
    ("decimal(8,2)", "decimal(9,3)", True), ("decimal(8,2)", "decimal(8,3)", False), ("decimal(8,2)", "double", True),
    ("date", "timestamp", True), ("string", "long", False), ("string", "binary", True)])
def test_widening(found, wanted, ok):
    a, b = (schema({"x": t})["x"].dataType for t in (found, wanted))
    assert S.widens(a, b) is ok


def test_decode_by_schema_id_keeps_all_fields(spark):
    out = S.decode_by_schema_id(log(spark, [(1, {"id": 1, "amount": 2.5, "note": "x"}), (3, {"id": 2, "total": 4.0}), (9, {"id": 3})]),
                                {1: OLD, 3: NEW})
    rows = {r["id"]: (r["note"], r["total"], r["currency"]) for r in out.collect()}
    assert rows == {1: ("x", None, None), 2: (None, 4.0, None)}
    assert out.schema["id"].dataType == T.LongType()


def test_schema_from_a_registry_folder(spark):
    folder = scratch_path(spark, "registry")
    content = json.dumps({"1": MID.json(), "10": json.dumps(NEW.json())})
    staged = scratch_path(spark, "staged")
    spark.createDataFrame([(content,)], "value string").coalesce(1).write.text(staged)
    from rivulet.session import _file_system, file_statuses
    fs, target = _file_system(spark, f"{folder}/t-value.json")
    fs.mkdirs(target.getParent())
    assert fs.rename(_file_system(spark, file_statuses(spark, staged)[0][0])[1], target)
    assert S.value_schema(folder, "t") == NEW and S.value_schema(folder, "t", "1") == MID


def test_avro_says_what_is_missing(spark):
    rows = log(spark, [(1, {"id": 1})])
    if S.avro_available(spark):
        assert S.decode_avro(rows, '{"type": "record", "name": "x", "fields": []}', "PERMISSIVE").columns[0] == "r"
    else:
        with pytest.raises(RuntimeError, match="spark-avro"):
            S.decode_avro(rows, "{}")
