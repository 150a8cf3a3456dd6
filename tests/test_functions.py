"""Column functions on literal samples (FIXTURES part 1)."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import codec, columns as C, dates as D, jsonfn as J


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0]["r"]


def test_is_numeric(spark):
    cases = {"123": True, "": False, "3.5": False, "-1": False, "\u0661\u0662": True, "12\n": False, None: False}
    for v, want in cases.items():
        assert one(spark, C.is_numeric("x"), v) is want, v


def test_java_split_drops_trailing_empty(spark):
    assert one(spark, C.java_split("x", ","), "1,2,,") == ["1", "2"]
    assert one(spark, C.java_split("x", ","), "1,,3") == ["1", "", "3"]
    assert one(spark, C.java_split("x", ","), ",,") == []


def test_md5_without_leading_zeros(spark):
    assert one(spark, codec.md5_hex("x"), "1111111") == "7fa8282ad93047a4d6fe6111c93b308a"
    # md5('3') starts with 'ec', md5('abc') with '90'; a zero-led digest keeps no leading zero
    assert not one(spark, codec.md5_hex("x"), "jk8ssl").startswith("0")


def test_hex_round_trip_and_guards(spark):
    assert one(spark, codec.hex_encode(F.col("x").cast("binary")), "JK") == "4a4b"
    assert one(spark, codec.hex_decode("x"), " 4a4B ") == b"JK"
    assert one(spark, codec.hex_decode("x"), "abc") is None
    assert one(spark, codec.hex_decode("x"), "zz") is None
    assert one(spark, codec.hex_decode("x"), "") == b""


def test_encrypt_and_gzip_round_trip(spark):
    key = "0123456789abcdef"
    df = spark.createDataFrame([("hello",), ("",), ("\u00fcber",)], "x string")
    back = df.select(codec.decrypt_column(codec.encrypt_column("x", key), key).alias("y")).collect()
    assert [r.y for r in back] == ["hello", "", "\u00fcber"]
    z = df.select(codec.gunzip_column(codec.gzip_column("x")).alias("y")).collect()
    assert [r.y for r in z] == ["hello", "", "\u00fcber"]
    assert one(spark, codec.gunzip_column("x"), None) == ""


def test_parse_time_and_days(spark):
    ts = one(spark, F.unix_seconds(D.parse_time("x")), "[11/May/2015:03:51:37 +0800]")
    assert ts == int(dt.datetime(2015, 5, 10, 19, 51, 37, tzinfo=dt.timezone.utc).timestamp())
    assert one(spark, D.parse_time("x"), "garbage") is None
    assert one(spark, D.format_day(F.to_timestamp_ntz(F.col("x")), D.DAY_SLASH), "2024-02-29 10:00:00") == "2024/02/29"
    got = one(spark, D.plus_days(F.to_timestamp_ntz(F.col("x")), -1), "2024-03-01 10:30:00")
    assert got == dt.datetime(2024, 2, 29, 10, 30)


def test_trunc4_and_flag(spark):
    assert one(spark, C.trunc4(F.col("x")), 3.14159, "x double") == 3.1415
    assert one(spark, C.trunc4(F.col("x")), -2.71828, "x double") == -2.7182
    assert one(spark, C.case_flag("x"), 0.51, "x double") == 1
    assert one(spark, C.case_flag("x"), 0.5, "x double") == 0


def test_clean_transaction_and_unique_tokens(spark):
    assert one(spark, C.clean_transaction("x"), "(a:1,b:22,c:3)") == "a b c:3"
    assert one(spark, C.tokens_unique("x"), "a b c") is True
    assert one(spark, C.tokens_unique("x"), "a b a") is False


def test_json_rows_distinct(spark):
    df = spark.createDataFrame([(1, '[{"k": 1}, {"k": 1}, {"j": "x"}]', 5), (2, '{"k": 2}', 6)],
                               "id long, js string, t long")
    out = J.json_array_rows(df, "js", "t", keep=("id",)).collect()
    assert sorted((r.id, r.key, r.value) for r in out) == [(1, "j", "x"), (1, "k", "1")]
    assert one(spark, J.to_json_text(F.col("x")), None) == ''
    assert one(spark, J.struct_to_json_text(F.when(F.col("x").isNotNull(), F.struct("x"))), None) == ''


def test_error_filter(spark):
    df = spark.createDataFrame([("a", "ok"), ("b", "BindException only"), ("c", "some Error here"),
                                ("d", "java.io.IOException")], "f string, c string")
    out = sorted(r.report for r in C.error_filter(df, "f", "c").collect())
    assert out == ["c:\nsome Error here", "d:\njava.io.IOException"]


def test_json_typed_rows(spark):
    from tessera.functions import jsonfn as J
    rows = [(1, '[{"a":1,"b":"x"},{"b":"x","a":1.0},{"a":"1"},{"a":1e0,"b":"x"},{"n":null,"t":true,"l":[1,{"z":2}],"o":{"k":"v"}},5,"s",null,[],{}]'),
            (2, '{"a":1}'), (3, "bad ["), (4, None), (5, "[]"), (6, '[{"big":12345678901234567890.5,"neg":-0.0}]')]
    df = spark.createDataFrame(rows, "id int, j string")
    got = J.json_typed_rows(df.withColumn("key", F.lit("clash")), "j", "id").collect()
    want = [(1, "a", "number", 1.0, None, None), (1, "b", "string", None, None, "x"), (1, "a", "string", None, None, "1"),
            (1, "n", "null", None, None, None), (1, "t", "boolean", None, True, None), (1, "l", "array", None, None, '[1,{"z":2}]'),
            (1, "o", "object", None, None, '{"k":"v"}'), (6, "big", "number", 12345678901234567890.5, None, None), (6, "neg", "number", 0.0, None, None)]
    assert sorted(((r.access_time, r.key, r.kind, r.number, r.flag, r.text) for r in got), key=str) == sorted(want, key=str)
