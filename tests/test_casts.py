"""Hand-worked cases for the lenient casts and tolerant parsers."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions import casts as C
from adlake.operators import unify as U


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_cast_string_trims_all_whitespace(spark):
    out = _one(spark, [("\t x \n",), ("   ",), (None,)], "s string", C.cast_string(F.col("s")))
    assert out == ["x", None, None]


def test_cast_int_vs_tolerant_int(spark):
    rows = [("12.7",), ("12",), ("",), ("abc",), (" 7 ",), ("12.0",), ("1e3",), ("\t+5\n",)]
    st = T.StringType()
    assert _one(spark, rows, "s string", C.cast_int(F.col("s"), st)) == [None, 12, None, None, 7, None, None, 5]
    assert _one(spark, rows, "s string", C.tolerant_int(F.col("s"))) == [12, 12, None, None, 7, 12, 1000, 5]


def test_cast_int_truncates_numbers(spark):
    assert _one(spark, [(12.7,), (-3.9,)], "d double", C.cast_int(F.col("d"), T.DoubleType())) == [12, -3]


def test_cast_float_rejects_java_suffixes(spark):
    out = _one(spark, [("1.0d",), ("1e3",), (" 2.5 ",), ("x",)], "s string", C.cast_float(F.col("s"), T.StringType()))
    assert out == [None, 1000.0, 2.5, None]


def test_cast_timestamp_offsets_converge(spark):
    rows = [("2024-01-15T10:00:00-0800",), ("2024-01-15T18:00:00Z",), ("bad",)]
    out = _one(spark, rows, "s string", C.cast_timestamp(F.col("s"), T.StringType()))
    assert out == [dt.datetime(2024, 1, 15, 18, 0), dt.datetime(2024, 1, 15, 18, 0), None]


def test_extracted_at_keeps_micros(spark):
    df = spark.createDataFrame([("1778269109.0876858",)], "_dlt_load_id string")
    us = df.select(F.unix_micros(U.extracted_at(df))).first()[0]
    assert us == 1778269109087685


def test_source_id_null_part_is_null(spark):
    df = spark.createDataFrame([("a1", dt.date(2024, 1, 15)), ("a1", None)], "ad_id string, date_start date")
    assert [r[0] for r in df.select(U.source_id(["ad_id", "date_start"])).collect()] == ["a1|2024-01-15", None]


def test_change_hash_known_value(spark):
    df = spark.createDataFrame([("a",)], "sid string").withColumn("t", F.timestamp_micros(F.lit(1)))
    assert df.select(U.change_hash(F.col("sid"), F.col("t"))).first()[0] == "0d72252d6dbedc0f4a006ab90e559402"


def test_payload_keeps_nulls_and_micros(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string").withColumn(
        "t", F.lit("2024-01-15 10:00:00.123456").cast("timestamp"))
    js = df.select(U.payload_json(["a", "b", "t"])).first()[0]
    assert '"b":null' in js and ".123456Z" in js


def test_cast_json_struct_and_text(spark):
    df = spark.createDataFrame([('{"b": 1, "a": 2}',)], "s string").withColumn("st", F.struct(F.lit(1).alias("x")))
    out = df.select(C.cast_json(F.col("s"), T.StringType()), C.cast_json(F.col("st"), df.schema["st"].dataType)).first()
    assert out[1] == '{"x":1}'
    assert out[0] in ('{"a":2,"b":1}', '{"b":1,"a":2}')
