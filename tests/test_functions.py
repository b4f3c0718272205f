"""Column functions: masks, text, frames, hashing."""

from pyspark.sql import functions as F

from rivulet.functions import (add_frame, first_words, frame_schema_id, mask_email, mask_phone, mask_prefix,
                               snake_case, strip_frame, strip_frame_lenient, surrogate_key, word_count)


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


def test_prefix_mask(spark):
    assert one(spark, mask_prefix(F.col("x")), "ana@example.com") == "an***"
    assert one(spark, mask_prefix(F.col("x")), "+15550001") == "+1***"
    assert one(spark, mask_prefix(F.col("x")), None) is None


def test_documented_masks(spark):
    assert one(spark, mask_email(F.col("x")), "jane@example.com") == "j***@example.com"
    assert one(spark, mask_phone(F.col("x")), "+50212345234") == "+502*****234"


def test_first_words_and_count(spark):
    text = "  one two\tthree\n four  "
    assert one(spark, first_words(F.col("x"), 2), text) == "one two"
    assert one(spark, word_count(F.col("x")), text) == 4
    assert one(spark, word_count(F.col("x")), "   ") == 0


def test_snake_case():
    assert snake_case("Order Date") == "order_date"
    assert snake_case("orderDate") == "order_date"
    assert snake_case("ORDER STATUS") == "order_status"


def test_frames(spark):
    rows = [(None,), (bytearray(b""),), (bytearray(b"\x00\x00\x00\x00\x07"),), (bytearray(b"\x00\x00\x00\x00\x07{"),)]
    df = spark.createDataFrame(rows, "v binary")
    out = df.select(strip_frame(F.col("v")).alias("s"), strip_frame_lenient(F.col("v")).alias("l"),
                    frame_schema_id(F.col("v")).alias("id")).collect()
    assert out[0]["s"] is None and out[0]["l"] is None
    assert out[1]["s"] is None and bytes(out[1]["l"]) == b""          # notebook rule keeps short values
    assert out[2]["s"] is None and bytes(out[2]["l"]) == b"" and out[2]["id"] == 7
    assert bytes(out[3]["s"]) == b"{" and bytes(out[3]["l"]) == b"{"
    framed = spark.range(1).select(add_frame(F.encode(F.lit("{}"), "UTF-8"), 258).alias("v"))
    r = framed.select(frame_schema_id(F.col("v")).alias("id"), strip_frame(F.col("v")).cast("string").alias("p")).first()
    assert r["id"] == 258 and r["p"] == "{}"


def test_surrogate_key_is_stable(spark):
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    k1 = df.select(surrogate_key(F.col("a").cast("string"), F.col("b").cast("string"))).first()[0]
    import hashlib
    assert k1 == hashlib.sha256(b"1~2").hexdigest()


def test_surrogate_key_tells_null_parts_apart(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), ("a", ""), (None, None)], "a string, b string")
    assert rows.select(surrogate_key("a", "b").alias("k")).distinct().count() == 4
