"""Schema discovery: files of one dataset with different headers, least common types, drift."""

import json

from rivulet.sources import discovery as D
from rivulet.session import scratch_path


def write_lines(spark, path, *files):
    for lines in files:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def types(found):
    return {r["column"]: r["type"] for r in found.collect()}


def test_csv_files_with_their_own_headers(spark):
    path = scratch_path(spark, "csv")
    write_lines(spark, path,
                ["id,price,day,flag,note", "1,2,2024-01-31,true,\"a, b\"", "2,2.5,2024-02-30,FALSE,", "-3,.5e3,2024-02-01,true,x"],
                ["note,id,extra,at,none", "x,007,9,2024-01-01T10:00:00Z,", "y,12345678901234567890,8,2024-01-01 10:00:00.5,"],
                ["at,day", "2024-01-01,2024-03-01"])
    assert types(D.discover_csv(spark, path)) == {
        "id": "double",           # the long number has no place in a bigint
        "price": "double", "day": "string",  # 30 February is no date
        "flag": "boolean", "note": "string", "extra": "bigint", "at": "timestamp", "none": "void"}


def test_a_header_alone_and_names_like_values(spark):
    path = scratch_path(spark, "csv")
    write_lines(spark, path, ["2024,true,name"], ["2024,true,name", "5,false,7"])
    assert types(D.discover_csv(spark, path)) == {"2024": "bigint", "true": "boolean", "name": "bigint"}


def test_headers_are_found_without_sorting_the_lines(spark):
    path = scratch_path(spark, "csv")
    write_lines(spark, path, ["id,price", "1,2.5"], ["price,id,x", "3,2,"])
    found = D.discover_csv(spark, path)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    assert types(found) == {"id": "bigint", "price": "double", "x": "void"}


def test_json_lines_and_arrays(spark):
    path = scratch_path(spark, "json")
    rows = [{"a": 1, "b": 1.5, "c": "2024-01-01", "d": None, "e": [1], "f": {"x": 1}, "g": True},
            {"a": 2, "b": 3, "c": "x", "e": [], "f": {}, "g": "yes"}]
    write_lines(spark, path, [json.dumps(r) for r in rows], ["[" + json.dumps(rows[0]) + ",", json.dumps({"h": 1}), "]"])
    assert types(D.discover_json(spark, path)) == {"a": "bigint", "b": "double", "c": "string", "d": "void", "e": "array",
                                                   "f": "struct", "g": "string", "h": "bigint"}


def test_drift_names_every_kind(spark):
    found = spark.createDataFrame([("t", "a", "bigint"), ("t", "b", "string"), ("t", "n", "void"), ("t", "new", "date")],
                                  "dataset string, column string, type string")
    expected = spark.createDataFrame([("t", "a", "bigint"), ("t", "b", "double"), ("t", "n", "date"), ("t", "old", "date")],
                                     "dataset string, column string, type string")
    assert sorted(map(tuple, D.drift(found, expected).collect())) == [
        ("t", "b", "type_changed", "double", "string"), ("t", "new", "added", None, "date"),
        ("t", "old", "missing", "date", None)]
