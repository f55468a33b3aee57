"""Queries: streaming pointer sync, late restatement, streaming telemetry.

Each lands its proxy rows in several appends (the restatement: overlapping
loads with changed values), runs an AvailableNow stream after each landing
(restarts on one checkpoint), and returns the final state; the oracle is the
batch answer over all rows (stream = batch)."""

from __future__ import annotations

from pyspark.sql import functions as F

import adlake.plans.catalog_assets  # noqa: F401  (registers the batch oracles reused below)
import adlake.plans.catalog_telemetry  # noqa: F401
from adlake.plans import proxies as P
from adlake.plans.catalog_unify import _CAST_CTE, _typed
from adlake.plans.registry import ORACLE, query
from adlake.session import scratch_dir
from adlake.specs import INSIGHTS_STEADY_STATE_DAYS
from adlake.streaming import streams as ST


@query("stream_pointer_sync", sql=ORACLE["pointer_upsert"])
def q_stream_pointer_sync(spark, d):
    m = P.manifest(spark, d)
    parts = [F.col("date") == "2024-03-01", F.col("date") == "2024-03-02", F.col("date") == "2024-03-03"]
    root = scratch_dir(spark, "pointers")
    landing, ckpt, state = f"{root}/landing", f"{root}/_checkpoint", f"{root}/state"
    for cond in parts:
        m.where(cond).write.mode("append").parquet(landing)
        ST.pointer_sync(spark, landing, m.schema, state, ckpt)
    return ST.read_pointers(spark, state)


# Loads of ten days each; every load ends five days after the one before, and
# restates the last seven days of its own tenant with changed spend.  Tenant
# 000 lags four days behind the others in every load.
_LOADS = ((1, "2024-01-08"), (2, "2024-01-13"), (3, "2024-01-18"), (4, "2024-01-23"), (5, "2024-01-28"), (6, "2024-02-02"))
_LAG_TENANT, _LAG_DAYS, _LOAD_DAYS = "000", 4, 10


@query("late_restatement", sql=f"""
WITH {_CAST_CTE},
loads(load_no, bound) AS (VALUES {", ".join(f"({n}, DATE '{b}')" for n, b in _LOADS)}),
landed AS (
  SELECT c.tenant_skey, c.ad_id, c.date_start, c.extracted_at, c.tie, l.load_no, c.spend + l.load_no AS spend
  FROM casted c JOIN loads l
    ON c.date_start <= l.bound - CASE WHEN c.client_uid = '{_LAG_TENANT}' THEN {_LAG_DAYS} ELSE 0 END
   AND c.date_start > l.bound - CASE WHEN c.client_uid = '{_LAG_TENANT}' THEN {_LAG_DAYS} ELSE 0 END - {_LOAD_DAYS}),
newest AS (SELECT tenant_skey, load_no, max(date_start) AS m FROM landed GROUP BY ALL),
kept AS (SELECT l.* FROM landed l JOIN newest n ON l.tenant_skey = n.tenant_skey AND l.load_no = n.load_no
         WHERE l.date_start BETWEEN n.m - {INSIGHTS_STEADY_STATE_DAYS - 1} AND n.m)
SELECT tenant_skey, ad_id, date_start, load_no, round(spend, 2) AS spend, extracted_at, tie AS _dlt_id FROM kept
QUALIFY row_number() OVER (PARTITION BY tenant_skey, ad_id, date_start
                           ORDER BY load_no DESC, extracted_at DESC NULLS LAST, tie DESC) = 1
""")
def q_late_restatement(spark, d):
    t = _typed(spark, d)
    order = [F.col("load_no").desc(), F.col("extracted_at").desc_nulls_last(), F.col("_tie").desc()]
    keys = ["tenant_skey", "ad_id", "date_start"]
    root = scratch_dir(spark, "restate")
    landing, ckpt, state = f"{root}/landing", f"{root}/_checkpoint", f"{root}/state"
    for n, bound in _LOADS:
        end = F.date_sub(F.lit(bound).cast("date"), F.when(F.col("client_uid") == _LAG_TENANT, _LAG_DAYS).otherwise(0))
        load = (t.where((F.col("date_start") <= end) & (F.col("date_start") > F.date_sub(end, _LOAD_DAYS)))
                 .withColumn("load_no", F.lit(n)).withColumn("spend", F.col("spend") + n))
        load.write.mode("append").parquet(landing)
        ST.restatement(spark, landing, load.schema, state, ckpt, keys, order, "date_start",
                       INSIGHTS_STEADY_STATE_DAYS, ["tenant_skey", "load_no"])
    out = ST.read_restated(spark, state, keys, "date_start")
    return out.select(*keys, "load_no", F.round("spend", 2).alias("spend"), "extracted_at", F.col("_tie").alias("_dlt_id"))


@query("stream_ratelimit", sql=ORACLE["ratelimit_rollup"])
def q_stream_ratelimit(spark, d):
    r = P.responses(spark, d)
    parts = [F.col("seq") % 3 == 0, F.col("seq") % 3 == 1, F.col("seq") % 3 == 2]
    root = scratch_dir(spark, "telemetry")
    landing, ckpt, state = f"{root}/landing", f"{root}/_checkpoint", f"{root}/state"
    for cond in parts:
        r.where(cond).write.mode("append").parquet(landing)
        ST.ratelimit_stream(spark, landing, r.schema, state, ckpt)
    return ST.read_telemetry(spark, state)
