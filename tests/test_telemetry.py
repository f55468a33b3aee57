"""Rate-limit telemetry: levels, worst bucket, rollup and its fold property."""

from pyspark.sql import functions as F

from adlake.operators import telemetry as TM
from adlake.plans import proxies as P

SCHEMA = "run_id string, seq long, app_usage string, account_usage string, business_usage string"


def test_levels(spark):
    df = spark.createDataFrame([(49.9,), (50.0,), (80.0,), (100.0,), (None,)], "v double")
    assert [r[0] for r in df.select(TM.pressure_level(F.col("v"))).collect()] == [None, "info", "warning", "error", None]


def test_worst_bucket_first_on_ties(spark):
    b = ('{"b1": [{"type": "t0", "estimated_time_to_regain_access": 0, "call_count": 99}, '
         '{"type": "t1", "estimated_time_to_regain_access": 5, "call_count": 10}]}')
    b2 = '{"b2": [{"type": "t2", "estimated_time_to_regain_access": 5, "call_count": 10}]}'
    df = spark.createDataFrame([("r", 1, None, None, b), ("r", 2, None, None, b2)], SCHEMA)
    w = TM.rollup(df).first()
    assert w["worst_buc_type"] == "t1" and w["throttled_during_run"]


def test_counts_ignore_missing_headers(spark):
    df = spark.createDataFrame([("r", 1, '{"call_count": 10}', None, None), ("r", 2, None, None, None)], SCHEMA)
    r = TM.rollup(df).first()
    assert r["responses_seen"] == 2 and r["responses_with_rate_limit_headers"] == 1
    assert r["max_app_call_count_pct"] == 10.0


def test_rollup_fold_equals_whole(spark, sf_small):
    resp = P.responses(spark, sf_small)
    whole = sorted(tuple(r) for r in TM.rollup(resp).collect())
    halves = TM.rollup(resp.where("seq % 2 = 0").unionByName(resp.where("seq % 2 = 1")))
    assert whole == sorted(tuple(r) for r in halves.collect())
