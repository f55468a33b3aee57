"""Landed pages, multi-id payloads, errors, redaction, job status."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators import pages as PG


def test_multi_id_keeps_objects_only(spark):
    body = '{"1":{"id":"1"},"2":{"error":{}},"3":[1],"4":"x"}'
    kept, dropped = PG.explode_multi_id(spark.createDataFrame([(body,)], "body string"), "body")
    assert [r["object_key"] for r in kept.collect()] == ["1"]
    assert dropped.count() == 3


def test_pages_skip_empty(spark):
    rows = [('{"data":[{"a":1},{"a":2}]}',), ('{"data":[]}',), ("{}",)]
    schema = T.StructType([T.StructField("a", T.LongType())])
    out = PG.explode_pages(spark.createDataFrame(rows, "body string"), "body", schema)
    assert sorted(r["a"] for r in out.collect()) == [1, 2]


def test_error_summary_cases(spark):
    rows = [('{"error":{"message":"m","code":190,"x":1}}',), ("nope",), ("{}",)]
    out = [r[0] for r in spark.createDataFrame(rows, "b string").select(PG.error_summary(F.col("b"))).collect()]
    assert out == ["message=m | code=190", "<unparseable>", "<no error block>"]


def test_redact_url(spark):
    u = "https://g/x?ids=1&access_token=abc&f=2"
    out = spark.createDataFrame([(u,)], "u string").select(PG.redact_url(F.col("u"))).first()[0]
    assert out == "https://g/x?ids=1&access_token=***&f=2"


def test_job_status_classes(spark):
    rows = [('{"async_status": "Job Completed"}',), ('{"async_status": "Job Skipped"}',),
            ('{"async_status": "Job Running", "async_percent_completion": "40.5"}',)]
    out = spark.createDataFrame(rows, "p string").select(*PG.job_status(F.col("p"))).collect()
    assert [(r["is_success"], r["is_failure"], r["is_terminal"]) for r in out] == [
        (True, False, True), (False, True, True), (False, False, False)]
    assert out[2]["async_percent_completion"] == 40
