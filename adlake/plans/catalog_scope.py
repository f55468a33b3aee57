"""Queries: id scopes, scoped listings, id batches, date-window planning."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adlake.operators import scope as SC
from adlake.plans import proxies as P
from adlake.plans.catalog_unify import _CAST_CTE, _typed
from adlake.plans.registry import query
from adlake.session import scratch_dir
from adlake.sources import lake as L
from adlake.specs import DATE_PRESETS, INSIGHTS_STEADY_STATE_DAYS

_I = f"i AS ({P.INSIGHTS_SQL})"


@query("scope_ids", sql=f"""
WITH {_I}
SELECT DISTINCT * FROM (
  SELECT 'ad' AS id_kind, ad_id AS object_id FROM i WHERE ad_id IS NOT NULL AND ad_id <> ''
  UNION ALL SELECT 'adset', adset_id FROM i WHERE adset_id IS NOT NULL AND adset_id <> ''
  UNION ALL SELECT 'campaign', campaign_id FROM i WHERE campaign_id IS NOT NULL AND campaign_id <> '')
""")
def q_scope_ids(spark, d):
    return SC.scope_ids(P.insights(spark, d))


@query("scope_sizes", sql=f"""
WITH {_I}
SELECT 'ad' AS id_kind, CAST(count(DISTINCT ad_id) AS BIGINT) AS n_ids FROM i
UNION ALL SELECT 'adset', CAST(count(DISTINCT adset_id) AS BIGINT) FROM i
UNION ALL SELECT 'campaign', CAST(count(DISTINCT campaign_id) AS BIGINT) FROM i
""")
def q_scope_sizes(spark, d):
    return SC.scope_sizes(SC.scope_ids(P.insights(spark, d)))


@query("creative_ids", sql=f"""
WITH a AS ({P.ADS_SQL})
SELECT DISTINCT creative_id FROM a WHERE creative_id IS NOT NULL AND creative_id <> ''
""")
def q_creative_ids(spark, d):
    return SC.creative_ids(P.ads(spark, d))


@query("scope_semi_join", sql=f"""
WITH {_I}, a AS ({P.ADS_SQL})
SELECT 'ad' AS listing, CAST(p_partkey AS VARCHAR) AS id FROM part
WHERE CAST(p_partkey AS VARCHAR) IN (SELECT ad_id FROM i)
UNION ALL
SELECT 'adset', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE CAST(s_suppkey AS VARCHAR) IN (SELECT adset_id FROM i)
""")
def q_scope_semi_join(spark, d):
    scope = SC.scope_ids(P.insights(spark, d))
    ads = P.ads(spark, d).select("id")
    sets = P.table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("id"))
    a = SC.restrict(ads, scope.where(F.col("id_kind") == "ad")).select(F.lit("ad").alias("listing"), "id")
    s = SC.restrict(sets, scope.where(F.col("id_kind") == "adset")).select(F.lit("adset").alias("listing"), "id")
    return a.unionByName(s)


@query("creative_scope", sql=f"""
WITH {_I}, a AS ({P.ADS_SQL}), cl AS ({P.CREATIVE_LISTING_SQL}),
scoped_ads AS (SELECT * FROM a WHERE id IN (SELECT ad_id FROM i)),
cids AS (SELECT DISTINCT creative_id FROM scoped_ads WHERE creative_id IS NOT NULL AND creative_id <> '')
SELECT id, lang, source FROM cl WHERE id IN (SELECT creative_id FROM cids)
""")
def q_creative_scope(spark, d):
    scope = SC.scope_ids(P.insights(spark, d)).where(F.col("id_kind") == "ad")
    ads = SC.restrict(P.ads(spark, d), scope)
    cids = SC.creative_ids(ads)
    cl = P.creative_listing(spark, d)
    return cl.join(cids, cl["id"] == cids["creative_id"], "left_semi")


@query("id_batches", sql="""
WITH ids AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS id FROM customer),
pos AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos FROM ids)
SELECT CAST(pos // 50 AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n_ids,
       string_agg(id, ',' ORDER BY pos) AS ids
FROM pos GROUP BY 1
""")
def q_id_batches(spark, d):
    ids = P.table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    return SC.id_batches(ids, "id")


# ---- history window / chunks: coverage per supplier from lineitem, with
# conditional min/max so tenants land in different resolver branches.
TODAY = dt.date(2001, 9, 1)
TARGET_MIN = dt.date(1996, 1, 1)
INITIAL_DAYS = 1125


def _coverage(spark, d):
    li = P.table(spark, d, "lineitem")
    ship = F.to_date(F.col("l_shipdate").cast("timestamp"))
    return li.groupBy(F.col("l_suppkey").cast("string").alias("client")).agg(
        F.min(F.when(F.col("l_quantity") >= 49, ship)).alias("coverage_min"),
        F.max(F.when((F.col("l_discount") >= 0.09) & (F.col("l_returnflag") == "R"), ship)).alias("coverage_max"))


_COVERAGE_SQL = """
cov AS (SELECT CAST(l_suppkey AS VARCHAR) AS client,
               min(CASE WHEN l_quantity >= 49 THEN CAST(l_shipdate AS DATE) END) AS coverage_min,
               max(CASE WHEN l_discount >= 0.09 AND l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END) AS coverage_max
        FROM lineitem GROUP BY 1)"""
_GAP = f"date_diff('day', coverage_max, DATE '{TODAY}')"
_DAYS_SQL = f"""CASE WHEN coverage_min IS NULL OR coverage_max IS NULL THEN {INITIAL_DAYS}
     WHEN coverage_min > DATE '{TARGET_MIN}' THEN least(date_diff('day', DATE '{TARGET_MIN}', DATE '{TODAY}'), {INITIAL_DAYS})
     WHEN {_GAP} > 90 THEN {INITIAL_DAYS}
     WHEN {_GAP} > {INSIGHTS_STEADY_STATE_DAYS} THEN {_GAP} + {INSIGHTS_STEADY_STATE_DAYS}
     ELSE {INSIGHTS_STEADY_STATE_DAYS} END"""
_BRANCH_SQL = f"""CASE WHEN coverage_min IS NULL OR coverage_max IS NULL THEN 'first_run'
     WHEN coverage_min > DATE '{TARGET_MIN}' THEN 'deepen' WHEN {_GAP} > 90 THEN 'stale'
     WHEN {_GAP} > {INSIGHTS_STEADY_STATE_DAYS} THEN 'catch_up' ELSE 'steady' END"""


def _history(spark, d):
    cov = _coverage(spark, d)
    args = (F.col("coverage_min"), F.col("coverage_max"), F.lit(TODAY), F.lit(TARGET_MIN))
    return cov.select("client", "coverage_min", "coverage_max",
                      SC.branch_name(*args).alias("branch"),
                      SC.resolve_history_days(*args, F.lit(INITIAL_DAYS)).cast("int").alias("history_days"))


@query("history_window", sql=f"""
WITH {_COVERAGE_SQL}
SELECT client, coverage_min, coverage_max, {_BRANCH_SQL} AS branch, CAST({_DAYS_SQL} AS INTEGER) AS history_days
FROM cov
""")
def q_history_window(spark, d):
    return _history(spark, d)


@query("insights_chunks", sql=f"""
WITH {_COVERAGE_SQL},
plan AS (SELECT client, CAST({_DAYS_SQL} AS INTEGER) AS n FROM cov),
idx AS (SELECT client, n, unnest(range(0, CAST(ceil(n / 7.0) AS BIGINT))) AS chunk_idx FROM plan WHERE n > 0)
SELECT client, CAST(chunk_idx AS INTEGER) AS chunk_idx,
       greatest(DATE '{TODAY}' - CAST(chunk_idx * 7 + 6 AS INTEGER), DATE '{TODAY}' - CAST(n - 1 AS INTEGER)) AS since,
       DATE '{TODAY}' - CAST(chunk_idx * 7 AS INTEGER) AS until
FROM idx
""")
def q_insights_chunks(spark, d):
    return SC.insights_chunks(_history(spark, d), TODAY).select("client", "chunk_idx", "since", "until")


_ENV_SQL = "CASE c_custkey % 6 WHEN 0 THEN 'dev' WHEN 1 THEN ' Staging ' WHEN 2 THEN 'PROD' WHEN 3 THEN 'qa' WHEN 4 THEN ' ' END"
_OVR_SQL = "CASE c_custkey % 4 WHEN 0 THEN '30' WHEN 1 THEN '-5' WHEN 2 THEN 'abc' END"


@query("initial_load_days", sql=f"""
WITH t AS (SELECT c_custkey, {_ENV_SQL} AS env, {_OVR_SQL} AS override_raw FROM customer),
r AS (SELECT c_custkey, env, override_raw,
             coalesce(CASE coalesce(nullif(lower(trim(env)), ''), 'dev') WHEN 'dev' THEN 7 WHEN 'staging' THEN 365 WHEN 'prod' THEN 1125 END, 1125) AS initial_days,
             CASE WHEN TRY_CAST(override_raw AS INTEGER) > 0 THEN TRY_CAST(override_raw AS INTEGER) END AS override_days
      FROM t)
SELECT *, coalesce(override_days, initial_days) AS effective_days FROM r
""")
def q_initial_load_days(spark, d):
    n = P.table(spark, d, "customer").select("c_custkey", F.expr(_ENV_SQL).alias("env"), F.expr(_OVR_SQL).alias("override_raw"))
    r = n.select("*", SC.initial_load_days(F.col("env")).alias("initial_days"),
                 SC.history_override(F.col("override_raw")).alias("override_days"))
    return r.withColumn("effective_days", F.coalesce("override_days", "initial_days"))


_PRESETS_SQL = "(VALUES " + ", ".join(f"('{p}')" for p in DATE_PRESETS) + ") p(preset)"


@query("date_presets", sql=f"""
WITH {_CAST_CTE},
tenants AS (SELECT client_uid AS client, max(date_start) AS today FROM casted GROUP BY 1),
w AS (SELECT client, preset, today, regexp_extract(preset, '^last_(\\d+)d$', 1) AS n FROM tenants, {_PRESETS_SQL})
SELECT client, preset,
  CASE WHEN preset = 'today' THEN today WHEN preset = 'yesterday' THEN today - 1
       WHEN n <> '' THEN today - CAST(n AS INTEGER)
       WHEN preset = 'this_month' THEN CAST(date_trunc('month', today) AS DATE)
       WHEN preset = 'last_month' THEN CAST(date_trunc('month', today) - INTERVAL 1 MONTH AS DATE)
       WHEN preset = 'maximum' THEN today - 1124 END AS since,
  CASE WHEN preset IN ('today', 'this_month', 'maximum') THEN today WHEN preset = 'yesterday' THEN today - 1
       WHEN n <> '' THEN today - 1
       WHEN preset = 'last_month' THEN CAST(date_trunc('month', today) AS DATE) - 1 END AS until
FROM w
""")
def q_date_presets(spark, d):
    t = _typed(spark, d).groupBy(F.col("client_uid").alias("client")).agg(F.max("date_start").alias("today"))
    w = t.withColumn("preset", F.explode(F.array(*[F.lit(p) for p in DATE_PRESETS])))
    since, until = SC.preset_window(F.col("preset"), F.col("today"))
    return w.select("client", "preset", since.alias("since"), until.alias("until"))


WINDOW_TODAY = dt.date(2024, 1, 30)


@query("window_filter", sql=f"""
WITH {_CAST_CTE}
SELECT client_uid, date_start, CAST(count(*) AS BIGINT) AS n_rows FROM casted
WHERE date_start BETWEEN DATE '{WINDOW_TODAY}' - 6 AND DATE '{WINDOW_TODAY}' GROUP BY ALL
""")
def q_window_filter(spark, d):
    w = SC.rolling_window(_typed(spark, d), "date_start", WINDOW_TODAY, 7)
    return w.groupBy("client_uid", "date_start").agg(F.count(F.lit(1)).alias("n_rows"))


@query("tenant_windows", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL}), roster AS ({P.ROSTER_SQL}),
w AS (SELECT DISTINCT client_slug, DATE '{WINDOW_TODAY}' - 3 * CAST(CAST(client_slug AS INTEGER) AS INTEGER) AS until FROM roster)
SELECT client, date_start AS date, CAST(count(*) AS BIGINT) AS n_rows FROM extracts JOIN w ON client = client_slug
WHERE CAST(date_start AS DATE) BETWEEN until - 6 AND until GROUP BY ALL
""")
def q_tenant_windows(spark, d):
    """Every tenant's own last seven days of the raw lake (the windows end on
    differing days); folders are picked at run time."""
    root = scratch_dir(spark, "windows")
    L.write_raw(P.extracts(spark, d), root, "ads_insights", date_col="date_start")
    until = F.date_sub(F.lit(WINDOW_TODAY), 3 * F.col("client_slug").cast("int"))
    windows = P.roster(spark, d).select("client_slug").distinct().select(F.col("client_slug").alias("client"), F.date_sub(until, 6).alias("since"), until.alias("until"))
    rows = SC.tenant_windows(L.read_raw(spark, root, "ads_insights"), windows)
    return rows.groupBy("client", "date").agg(F.count(F.lit(1)).alias("n_rows"))


@query("ad_creative_bridge", sql=f"""
WITH {_I}, a AS ({P.ADS_SQL}), cl AS ({P.CREATIVE_LISTING_SQL}),
per_ad AS (SELECT ad_id, count(*) AS n_rows, sum(spend) AS spend FROM i GROUP BY ad_id)
SELECT a.creative_id, cl.lang, CAST(sum(per_ad.n_rows) AS BIGINT) AS n_rows, round(sum(per_ad.spend), 2) AS spend,
       CAST(count(*) AS BIGINT) AS n_ads
FROM per_ad JOIN a ON per_ad.ad_id = a.id JOIN cl ON a.creative_id = cl.id
GROUP BY ALL
""")
def q_ad_creative_bridge(spark, d):
    from adlake.operators.entities import ad_creative_bridge
    return ad_creative_bridge(P.insights(spark, d), P.ads(spark, d), P.creative_listing(spark, d))
