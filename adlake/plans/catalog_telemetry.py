"""Queries: rate-limit header parsing, rollup, worst bucket, levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.functions import casts as C
from adlake.functions import jsonvals as J
from adlake.operators import telemetry as TM
from adlake.operators import unify as U
from adlake.operators.joins import sized_broadcast
from adlake.plans import proxies as P
from adlake.plans import sqlgen as S
from adlake.plans.registry import query

_R = f"r AS ({P.RESPONSES_SQL})"


def _obj(col):
    return f"coalesce(CASE WHEN json_valid({col}) THEN json_type({col}) = 'OBJECT' END, false)"


def _jfloat(col, path):
    s = S.strip_ws(f"json_extract_string({col}, '{path}')")
    return (f"(CASE json_type({col}, '{path}') WHEN 'BIGINT' THEN CAST(json_extract_string({col}, '{path}') AS DOUBLE) "
            f"WHEN 'UBIGINT' THEN CAST(json_extract_string({col}, '{path}') AS DOUBLE) "
            f"WHEN 'DOUBLE' THEN CAST(json_extract_string({col}, '{path}') AS DOUBLE) "
            f"WHEN 'VARCHAR' THEN CASE WHEN regexp_matches({s}, '{S.NUMERIC_RE}') THEN TRY_CAST({s} AS DOUBLE) END END)")


def _jint(col, path):
    return (f"(CASE json_type({col}, '{path}') WHEN 'BIGINT' THEN CAST(json_extract_string({col}, '{path}') AS BIGINT) "
            f"ELSE TRY_CAST(trunc({_jfloat(col, path)}) AS BIGINT) END)")


def _jstr(col, path):
    return f"(CASE WHEN json_type({col}, '{path}') = 'VARCHAR' THEN nullif(json_extract_string({col}, '{path}'), '') END)"


_H = f"""
h AS (
  SELECT run_id, seq, {_obj('app_usage')} AS has_app, {_obj('account_usage')} AS has_account,
         CASE WHEN {_obj('app_usage')} THEN {_jfloat('app_usage', '$.call_count')} END AS app_call_count,
         CASE WHEN {_obj('app_usage')} THEN {_jfloat('app_usage', '$.total_cputime')} END AS app_total_cputime,
         CASE WHEN {_obj('app_usage')} THEN {_jfloat('app_usage', '$.total_time')} END AS app_total_time,
         CASE WHEN {_obj('account_usage')} THEN {_jfloat('account_usage', '$.acc_id_util_pct')} END AS acc_id_util_pct,
         CASE WHEN {_obj('account_usage')} THEN {_jint('account_usage', '$.reset_time_duration')} END AS reset_time_duration,
         CASE WHEN {_obj('account_usage')} THEN {_jstr('account_usage', '$.ads_api_access_tier')} END AS ads_api_access_tier
  FROM r)"""
_B = f"""
bk AS (SELECT run_id, seq, business_usage AS bu, unnest(json_keys(business_usage)) AS business_id,
              unnest(range(CAST(len(json_keys(business_usage)) AS BIGINT))) AS biz_pos
       FROM r WHERE {_obj('business_usage')}),
bl AS (SELECT run_id, seq, business_id, biz_pos, json_extract(bu, '$."' || business_id || '"') AS lst FROM bk),
be AS (SELECT run_id, seq, business_id, biz_pos, lst, unnest(range(CAST(json_array_length(lst) AS BIGINT))) AS pos
       FROM bl WHERE json_type(lst) = 'ARRAY'),
bv AS (SELECT run_id, seq, business_id, biz_pos, pos, CAST(json_extract(lst, '$[' || pos || ']') AS VARCHAR) AS v FROM be),
b AS (SELECT run_id, seq, biz_pos, pos, business_id, {_jstr('v', '$.type')} AS type,
             {_jfloat('v', '$.call_count')} AS call_count, {_jfloat('v', '$.total_cputime')} AS total_cputime,
             {_jfloat('v', '$.total_time')} AS total_time, {_jint('v', '$.estimated_time_to_regain_access')} AS eta
      FROM bv WHERE json_type(v) = 'OBJECT'),
bw AS (SELECT *, coalesce(eta, 0) AS eta0,
              greatest(coalesce(call_count, 0), coalesce(total_cputime, 0), coalesce(total_time, 0)) AS pressure FROM b),
worst AS (SELECT run_id, type AS worst_buc_type, business_id AS worst_buc_business_id,
                 eta0 AS worst_buc_eta, pressure AS worst_buc_pressure FROM bw
          QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY (eta0 > 0) DESC, eta0 DESC, pressure DESC,
                                     seq, biz_pos, pos) = 1)"""


@query("ratelimit_parse", sql=f"""
WITH {_R}, {_H}, {_B}, nb AS (SELECT run_id, seq, count(*) AS n FROM b GROUP BY ALL)
SELECT h.run_id, h.seq, app_call_count, app_total_cputime, app_total_time, acc_id_util_pct,
       reset_time_duration, ads_api_access_tier, CAST(coalesce(nb.n, 0) AS BIGINT) AS n_buckets
FROM h LEFT JOIN nb ON h.run_id = nb.run_id AND h.seq = nb.seq
""")
def q_ratelimit_parse(spark, d):
    r = P.responses(spark, d)
    h = TM.parse_headers(r)
    return h.select("run_id", "seq", "app_call_count", "app_total_cputime", "app_total_time", "acc_id_util_pct",
                    "reset_time_duration", "ads_api_access_tier",
                    TM.business_object_count(F.col("business_usage")).cast("bigint").alias("n_buckets"))


@query("ratelimit_buckets", sql=f"WITH {_R}, {_B} SELECT * FROM b")
def q_ratelimit_buckets(spark, d):
    return TM.business_buckets(P.responses(spark, d))


@query("ratelimit_worst", sql=f"WITH {_R}, {_B} SELECT * FROM worst")
def q_ratelimit_worst(spark, d):
    return TM.worst_buckets(TM.business_buckets(P.responses(spark, d)))


@query("ratelimit_rollup", sql=f"""
WITH {_R}, {_H}, {_B},
nb AS (SELECT run_id, seq, count(*) AS n FROM b GROUP BY ALL),
agg_h AS (
  SELECT h.run_id, max(app_call_count) AS max_app_call_count_pct, max(app_total_cputime) AS max_app_cputime_pct,
         max(app_total_time) AS max_app_total_time_pct, max(acc_id_util_pct) AS max_acc_util_pct,
         min(reset_time_duration) AS min_acc_reset_seconds,
         arg_max(ads_api_access_tier, h.seq) FILTER (WHERE ads_api_access_tier IS NOT NULL) AS ads_api_access_tier,
         coalesce(bool_or(app_call_count >= 100 OR app_total_cputime >= 100 OR app_total_time >= 100
                          OR acc_id_util_pct >= 100), false) AS thr_h,
         CAST(count(*) AS BIGINT) AS responses_seen,
         CAST(count(*) FILTER (WHERE has_app OR has_account OR coalesce(nb.n, 0) > 0) AS BIGINT)
           AS responses_with_rate_limit_headers
  FROM h LEFT JOIN nb ON h.run_id = nb.run_id AND h.seq = nb.seq GROUP BY h.run_id),
agg_b AS (
  SELECT run_id, max(call_count) AS max_buc_call_count_pct, max(total_cputime) AS max_buc_cputime_pct,
         max(total_time) AS max_buc_total_time_pct, max(eta) AS max_buc_eta_minutes,
         bool_or(call_count >= 100 OR total_cputime >= 100 OR total_time >= 100 OR coalesce(eta, 0) > 0) AS thr_b
  FROM b GROUP BY run_id)
SELECT a.run_id, max_app_call_count_pct, max_app_cputime_pct, max_app_total_time_pct, max_acc_util_pct,
       min_acc_reset_seconds, ads_api_access_tier, max_buc_call_count_pct, max_buc_cputime_pct,
       max_buc_total_time_pct, max_buc_eta_minutes, w.worst_buc_type, w.worst_buc_business_id,
       thr_h OR coalesce(thr_b, false) AS throttled_during_run, responses_seen, responses_with_rate_limit_headers
FROM agg_h a LEFT JOIN agg_b ON a.run_id = agg_b.run_id LEFT JOIN worst w ON a.run_id = w.run_id
""")
def q_ratelimit_rollup(spark, d):
    return TM.rollup(P.responses(spark, d))


# A run's identity: its tenant, the tenant's org and account, and when it started.
_IDENTITY = ("org_uid", "client_uid", "account_id", "started_at")


@query("ratelimit_run_row", sql=f"""
WITH {_R}, {_H}, {_B}, roster AS ({P.ROSTER_SQL}),
org_map AS (SELECT client_slug, min(org_slug) AS org, min(ad_account_id) AS account FROM roster GROUP BY client_slug),
nb AS (SELECT run_id, seq, count(*) AS n FROM b GROUP BY ALL),
agg_b AS (SELECT run_id, max(call_count) AS max_buc_call_count_pct, max(eta) AS max_buc_eta_minutes FROM b GROUP BY run_id)
SELECT a.run_id, coalesce(o.org, '{U.DEFAULT_ORG}') AS org_uid, left(a.run_id, 3) AS client_uid, o.account AS account_id,
       TIMESTAMP '2024-02-01 00:00:00' + to_hours(CAST(right(a.run_id, 1) AS INTEGER)) AS started_at,
       a.max_acc_util_pct, agg_b.max_buc_call_count_pct, agg_b.max_buc_eta_minutes, a.responses_seen, a.responses_with_rate_limit_headers
FROM (SELECT h.run_id, max(acc_id_util_pct) AS max_acc_util_pct, CAST(count(*) AS BIGINT) AS responses_seen,
             CAST(count(*) FILTER (WHERE has_app OR has_account OR coalesce(nb.n, 0) > 0) AS BIGINT) AS responses_with_rate_limit_headers
      FROM h LEFT JOIN nb ON h.run_id = nb.run_id AND h.seq = nb.seq GROUP BY h.run_id) a
LEFT JOIN agg_b ON a.run_id = agg_b.run_id LEFT JOIN org_map o ON left(a.run_id, 3) = o.client_slug
""")
def q_ratelimit_run_row(spark, d):
    """Telemetry rows with the identity of their runs: org, client, account, start."""
    roster = P.roster(spark, d).groupBy("client_slug").agg(F.min("org_slug").alias("org"), F.min("ad_account_id").alias("account_id"))
    r = P.responses(spark, d).withColumn("client_uid", F.left("run_id", F.lit(3)))
    start = F.lit("2024-02-01 00:00:00").cast("timestamp") + F.make_interval(hours=F.right("run_id", F.lit(1)).cast("int"))
    r = r.join(sized_broadcast(roster, 100_000), r["client_uid"] == roster["client_slug"], "left")
    r = r.withColumn("org_uid", F.coalesce("org", F.lit(U.DEFAULT_ORG))).withColumn("started_at", start)
    return TM.rollup(r, identity=_IDENTITY).select(
        "run_id", *_IDENTITY, "max_acc_util_pct", "max_buc_call_count_pct", "max_buc_eta_minutes", "responses_seen", "responses_with_rate_limit_headers")


@query("pressure_level", sql=f"""
WITH {_R}, {_H}
SELECT run_id, seq, acc_id_util_pct,
       CASE WHEN acc_id_util_pct >= 100 THEN 'error' WHEN acc_id_util_pct >= 80 THEN 'warning'
            WHEN acc_id_util_pct >= 50 THEN 'info' END AS level,
       coalesce(ads_api_access_tier = 'development_access', false) AS low_tier
FROM h
""")
def q_pressure_level(spark, d):
    h = TM.parse_headers(P.responses(spark, d))
    return h.select("run_id", "seq", "acc_id_util_pct", TM.pressure_level(F.col("acc_id_util_pct")).alias("level"),
                    TM.low_tier(F.col("ads_api_access_tier")).alias("low_tier"))


@query("tolerant_numeric", sql=f"""
WITH {_R}
SELECT seq,
       CASE WHEN {_obj('app_usage')} THEN {_jfloat('app_usage', '$.total_cputime')} END AS cputime_float,
       CASE WHEN {_obj('app_usage')} THEN {_jint('app_usage', '$.total_cputime')} END AS cputime_int,
       coalesce(CASE WHEN {_obj('app_usage')} THEN {_jint('app_usage', '$.total_cputime')} END, 0) AS cputime_int_or_zero,
       CASE WHEN {_obj('account_usage')} THEN {_jstr('account_usage', '$.ads_api_access_tier')} END AS tier,
       CASE WHEN json_extract_string(props, '$.k') IS NOT NULL THEN
         (CASE WHEN regexp_matches({P.dec2_sql('value')}, '{S.NUMERIC_RE}') THEN TRY_CAST(trunc(CAST({P.dec2_sql('value')} AS DOUBLE)) AS BIGINT) END) END AS value_int
FROM r JOIN events e ON r.seq = e.event_id
""")
def q_tolerant_numeric(spark, d):
    r = P.responses(spark, d)
    ev = P.table(spark, d, "events").select(F.col("event_id").alias("seq"), "value")
    a, c = J.parse(F.col("app_usage")), J.parse(F.col("account_usage"))
    a_ok, c_ok = J.is_object(a), J.is_object(c)
    return r.join(ev, "seq").select(
        "seq",
        F.when(a_ok, J.jfloat(a, "$.total_cputime")).alias("cputime_float"),
        F.when(a_ok, J.jint(a, "$.total_cputime")).alias("cputime_int"),
        F.coalesce(F.when(a_ok, J.jint(a, "$.total_cputime")), F.lit(0).cast("bigint")).alias("cputime_int_or_zero"),
        F.when(c_ok, J.jstr(c, "$.ads_api_access_tier")).alias("tier"),
        C.tolerant_int(P.dec2(F.col("value"))).alias("value_int"))
