"""Unify: safe select, dedupe, union order, idempotence, plan shape."""

import datetime as dt

from pyspark.sql import functions as F

from adlake.operators import unify as U
from adlake.plans import proxies as P
from adlake.specs import ColSpec

LOADED = dt.datetime(2024, 2, 1)
SPEC = [ColSpec("id", "ad_id", "STRING"), ColSpec("spend", "spend", "FLOAT64"), ColSpec("status", "status", "STRING")]


def test_missing_column_is_typed_null(spark):
    a = spark.createDataFrame([("t1", "1", "2.5", "ON")], "client string, id string, spend string, status string")
    b = spark.createDataFrame([("t2", "2", 3.5)], "client string, id string, spend double")
    u = U.cast_tenant_frames([a, b], SPEC, False, tie_col=None)
    assert dict(u.dtypes)["spend"] == "double"
    rows = {r["ad_id"]: r for r in u.collect()}
    assert rows["2"]["status"] is None and rows["2"]["spend"] == 3.5


def test_latest_extraction_wins_nulls_last(spark):
    df = spark.createDataFrame(
        [("t", "1", "1.0", "r1"), ("t", "1", "5.0", "r2"), ("t", "1", None, "r3")],
        "client string, id string, _dlt_load_id string, _dlt_id string")
    out = U.unify_parent(df, "x", LOADED, specs=[ColSpec("id", "ad_id", "STRING")], natural_key=["ad_id"]).collect()
    assert len(out) == 1 and out[0]["_record_created_at"] == dt.datetime(1970, 1, 1, 0, 0, 5)


def test_union_order_does_not_matter(spark, sf_small):
    e = P.extracts(spark, sf_small)
    a, b = e.where(F.col("client") < "003"), e.where(F.col("client") >= "003")
    x = U.unify_parent([a, b], "ads_insights", LOADED).orderBy("tenant_skey", "source_id").collect()
    y = U.unify_parent([b, a], "ads_insights", LOADED).orderBy("tenant_skey", "source_id").collect()
    assert x == y


def test_payload_round_trips(spark, sf_small):
    o = U.unify_parent(P.extracts(spark, sf_small), "ads_insights", LOADED)
    r = o.select(F.get_json_object("payload", "$.ad_id").alias("ad"),
                 F.split("source_id", r"\|").getItem(0).alias("sid_ad")).where("ad <> sid_ad")
    assert r.count() == 0


def test_unify_plan_single_shuffle_and_partial_limit(spark, sf_small):
    o = U.unify_parent(P.extracts(spark, sf_small), "ads_insights", LOADED)
    plan = o._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert "WindowGroupLimit" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
