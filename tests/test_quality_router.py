"""Router: valid + rejected = read; one error row per broken rule; gate raises."""

import pytest
from pyspark.sql import functions as F

from rivulet.operators import quality as Q


def test_route_partitions_rows(spark):
    df = spark.createDataFrame([(1, 5.0, "a@b.co"), (2, -1.0, "bad"), (None, -3.0, "c@d.io"), (4, 2.0, None)],
                               "id long, qty double, email string")
    rules = [Q.Rule("KEY", "error", F.col("id").isNull(), "key"),
             Q.Rule("QTY", "error", F.col("qty") <= 0, "qty"),
             Q.Rule("EMAIL", "warning", ~F.coalesce(F.col("email").rlike("@"), F.lit(False)), "email")]
    valid, errors = Q.route(df, rules, "t", F.col("id"), "b1")
    assert valid.count() == 2                              # id 1 and 4 (4 only has a warning)
    rejected = errors.filter("severity = 'error'").select("record_id").distinct().count()
    assert valid.count() + rejected == df.count()
    codes = sorted((r["record_id"] or "", r["error_code"]) for r in errors.collect())
    assert codes == [("", "KEY"), ("", "QTY"), ("2", "EMAIL"), ("2", "QTY"), ("4", "EMAIL")]
    assert errors.filter("raw_payload IS NULL").count() == 0


def test_gate(spark):
    ok = spark.createDataFrame([("a", True)], "suite string, passed boolean")
    Q.gate(ok)
    with pytest.raises(RuntimeError):
        Q.gate(spark.createDataFrame([("a", True), ("b", False)], "suite string, passed boolean"))
