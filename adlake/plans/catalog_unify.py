"""Queries: casts, tenant tags, dedupe, unify_parent / unify_child."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adlake.operators import unify as U
from adlake.plans import proxies as P
from adlake.plans import sqlgen as S
from adlake.plans.registry import query
from adlake.specs import PARENT_KEYS, PARENT_SPECS

# Pinned load time (never the clock) so both engines agree.
LOADED_AT = dt.datetime(2024, 2, 1, 0, 0, 0)
INSIGHTS = PARENT_SPECS["ads_insights"]
INSIGHT_ALIASES = [s.alias for s in INSIGHTS]

_CAST_CTE = f"""
extracts AS ({P.EXTRACTS_SQL}),
roster AS ({P.ROSTER_SQL}),
org_map AS (SELECT client_slug, min(org_slug) AS org FROM roster GROUP BY client_slug),
casted AS (
  SELECT
    {S.spec_select(INSIGHTS, P.EXTRACTS_COLUMNS, 'e')},
    {S.extracted_at_sql('e._dlt_load_id')} AS extracted_at,
    e._dlt_id AS tie,
    coalesce(o.org, '{U.DEFAULT_ORG}') AS org_uid,
    e.client AS client_uid,
    coalesce(o.org, '{U.DEFAULT_ORG}') || '__' || e.client AS tenant_skey
  FROM extracts e LEFT JOIN org_map o ON e.client = o.client_slug
),
latest AS (
  SELECT * FROM casted
  QUALIFY row_number() OVER (PARTITION BY tenant_skey, ad_id, date_start
                             ORDER BY extracted_at DESC NULLS LAST, tie DESC) = 1
)"""


def _unified(spark, d):
    return U.unify_parent(P.extracts(spark, d), "ads_insights", LOADED_AT, roster=P.roster(spark, d))


@query("unify_parent", sql=f"""
WITH {_CAST_CTE}
SELECT tenant_skey, org_uid, client_uid,
       {S.source_id_sql(['ad_id', 'date_start'])} AS source_id,
       {S.change_hash_sql(S.source_id_sql(['ad_id', 'date_start']), 'extracted_at')} AS source_schema_hash,
       {S.payload_sql(INSIGHT_ALIASES)} AS payload,
       extracted_at AS _record_created_at,
       extracted_at AS _record_updated_at,
       TIMESTAMP '{LOADED_AT:%Y-%m-%d %H:%M:%S}' AS _loaded_at
FROM latest
""")
def q_unify_parent(spark, d):
    return _unified(spark, d)


# ------------------------------------------------------------------ casts
from adlake.functions import casts as C  # noqa: E402
from adlake.operators import frames as FR  # noqa: E402


@query("cast_string", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL})
SELECT _dlt_id, {S.cast_sql('ad_name', 'STRING')} AS ad_name,
       {S.cast_sql('quality_ranking', 'STRING')} AS quality_ranking
FROM extracts
""")
def q_cast_string(spark, d):
    e = P.extracts(spark, d)
    return e.select("_dlt_id", C.cast_string(F.col("ad_name")).alias("ad_name"),
                    C.cast_string(F.col("quality_ranking")).alias("quality_ranking"))


@query("cast_int", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL})
SELECT _dlt_id, {S.cast_sql('clicks', 'INT64')} AS clicks,
       {S.cast_sql('unique_clicks', 'INT64')} AS unique_clicks,
       {S.cast_sql('impressions', 'INT64')} AS impressions,
       {S.cast_sql('TRY_CAST(spend AS DOUBLE) * 3', 'INT64', src_is_text=False)} AS spend_x3
FROM extracts
""")
def q_cast_int(spark, d):
    e = P.extracts(spark, d)
    return e.select("_dlt_id", C.cast_int(F.col("clicks"), e.schema["clicks"].dataType).alias("clicks"),
                    C.cast_int(F.col("unique_clicks"), e.schema["unique_clicks"].dataType).alias("unique_clicks"),
                    C.cast_int(F.col("impressions"), e.schema["impressions"].dataType).alias("impressions"),
                    C.cast_int(F.col("spend").try_cast("double") * 3, None).alias("spend_x3"))


@query("cast_float", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL})
SELECT _dlt_id, {S.cast_sql('spend', 'FLOAT64')} AS spend, {S.cast_sql('ctr', 'FLOAT64')} AS ctr,
       {S.cast_sql('cpm', 'FLOAT64')} AS cpm, {S.cast_sql('frequency', 'FLOAT64')} AS frequency,
       {S.cast_sql('clicks', 'FLOAT64')} AS clicks
FROM extracts
""")
def q_cast_float(spark, d):
    e = P.extracts(spark, d)
    st = e.schema["spend"].dataType
    return e.select("_dlt_id", *[C.cast_float(F.col(c), st).alias(c)
                                 for c in ("spend", "ctr", "cpm", "frequency", "clicks")])


def _date_text(e):
    return F.when(F.col("_dlt_id").endswith("3"), F.lit("2024-13-45")).otherwise(F.col("date_start"))


@query("cast_date", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL})
SELECT _dlt_id, TRY_CAST(CASE WHEN ends_with(_dlt_id, '3') THEN '2024-13-45' ELSE date_start END AS DATE) AS date_start
FROM extracts
""")
def q_cast_date(spark, d):
    e = P.extracts(spark, d)
    return e.select("_dlt_id", C.cast_date(_date_text(e)).alias("date_start"))


@query("cast_timestamp", sql="""
SELECT event_id,
       CAST(TRY_CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
            CASE event_id % 4 WHEN 0 THEN '-0800' WHEN 1 THEN '+05:30' WHEN 2 THEN 'Z' ELSE '' END
            AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP) AS ts_from_text,
       ts AS ts_typed
FROM events
""")
def q_cast_timestamp(spark, d):
    ev = P.table(spark, d, "events")
    text = F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"),
                    F.expr("CASE event_id % 4 WHEN 0 THEN '-0800' WHEN 1 THEN '+05:30' WHEN 2 THEN 'Z' ELSE '' END"))
    return ev.select("event_id", C.cast_timestamp(text, ev.schema["props"].dataType).alias("ts_from_text"),
                     C.cast_timestamp(F.col("ts"), ev.schema["ts"].dataType).alias("ts_typed"))


@query("cast_json", sql="""
SELECT event_id,
       CASE WHEN json_valid(props) THEN CAST(json(props) AS VARCHAR) ELSE props END AS props_json,
       CAST(to_json(struct_pack(event_type := event_type, value := value)) AS VARCHAR) AS struct_json
FROM events
""")
def q_cast_json(spark, d):
    ev = P.table(spark, d, "events")
    st = ev.select("event_id", "props", F.struct("event_type", "value").alias("s"))
    return st.select("event_id", C.cast_json(F.col("props"), st.schema["props"].dataType).alias("props_json"),
                     C.cast_json(F.col("s"), st.schema["s"].dataType).alias("struct_json"))


@query("extracted_at", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL})
SELECT _dlt_id, _dlt_load_id, {S.extracted_at_sql('_dlt_load_id')} AS extracted_at FROM extracts
""")
def q_extracted_at(spark, d):
    e = P.extracts(spark, d)
    return e.select("_dlt_id", "_dlt_load_id", U.extracted_at(e).alias("extracted_at"))


@query("tenant_tag", sql=f"""
WITH {_CAST_CTE}
SELECT tenant_skey, org_uid, client_uid, CAST(count(*) AS BIGINT) AS n_rows
FROM casted GROUP BY ALL
""")
def q_tenant_tag(spark, d):
    t = U.tenant_tag(P.extracts(spark, d), P.roster(spark, d))
    return t.groupBy("tenant_skey", "org_uid", "client_uid").agg(F.count(F.lit(1)).alias("n_rows"))


@query("tenant_roster", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL}), roster AS ({P.ROSTER_SQL}),
tenants AS (SELECT DISTINCT client FROM extracts)
SELECT t.client AS client_slug, coalesce(r.org_slug, '{U.DEFAULT_ORG}') AS org_slug,
       r.ad_account_id, r.client_slug IS NOT NULL AS in_roster
FROM tenants t LEFT JOIN roster r ON t.client = r.client_slug
""")
def q_tenant_roster(spark, d):
    from adlake.operators.joins import sized_broadcast
    tenants = P.extracts(spark, d).select("client").distinct()
    r = P.roster(spark, d)
    j = tenants.join(sized_broadcast(r, 100_000), tenants["client"] == r["client_slug"], "left")
    return j.select(F.col("client").alias("client_slug"),
                    F.coalesce("org_slug", F.lit(U.DEFAULT_ORG)).alias("org_slug"), "ad_account_id",
                    F.col("client_slug").isNotNull().alias("in_roster"))


def _typed(spark, d):
    """Insights extracts cast with the spec and tenant-tagged (no dedupe)."""
    e = P.extracts(spark, d)
    df = U.cast_tenant_frames(e, INSIGHTS, True)
    return U.tenant_tag(df, P.roster(spark, d))


@query("typed_insights", sql=f"""
WITH {_CAST_CTE}
SELECT tenant_skey, {", ".join(INSIGHT_ALIASES)} FROM casted
""")
def q_typed_insights(spark, d):
    return _typed(spark, d).select("tenant_skey", *INSIGHT_ALIASES)


@query("source_id", sql=f"""
WITH {_CAST_CTE}
SELECT tie AS _dlt_id, {S.source_id_sql(['ad_id', 'date_start'])} AS source_id,
       {S.source_id_sql(['adset_id'])} AS adset_source_id
FROM casted
""")
def q_source_id(spark, d):
    t = _typed(spark, d)
    return t.select(F.col("_tie").alias("_dlt_id"), U.source_id(["ad_id", "date_start"]).alias("source_id"),
                    U.source_id(["adset_id"]).alias("adset_source_id"))


@query("payload_json", sql=f"""
WITH {_CAST_CTE}
SELECT tie AS _dlt_id, {S.payload_sql(INSIGHT_ALIASES)} AS payload FROM casted
""")
def q_payload_json(spark, d):
    return _typed(spark, d).select(F.col("_tie").alias("_dlt_id"), U.payload_json(INSIGHT_ALIASES).alias("payload"))


@query("change_hash", sql=f"""
WITH {_CAST_CTE}
SELECT tie AS _dlt_id,
       {S.change_hash_sql(S.source_id_sql(['ad_id', 'date_start']), 'extracted_at')} AS source_schema_hash
FROM casted
""")
def q_change_hash(spark, d):
    t = _typed(spark, d)
    return t.select(F.col("_tie").alias("_dlt_id"),
                    U.change_hash(U.source_id(["ad_id", "date_start"]), F.col("extracted_at")).alias("source_schema_hash"))


@query("dedupe_latest", sql=f"""
WITH {_CAST_CTE}
SELECT tenant_skey, ad_id, date_start, extracted_at, tie AS _dlt_id FROM latest
""")
def q_dedupe_latest(spark, d):
    t = _typed(spark, d)
    out = U.dedupe_latest(t, ["tenant_skey", "ad_id", "date_start"],
                          [F.col("extracted_at").desc_nulls_last(), F.col("_tie").desc()])
    return out.select("tenant_skey", "ad_id", "date_start", "extracted_at", F.col("_tie").alias("_dlt_id"))


@query("payload_extract", sql=f"""
WITH {_CAST_CTE}, ods AS (
  SELECT tenant_skey, {S.source_id_sql(['ad_id', 'date_start'])} AS source_id,
         {S.payload_sql(INSIGHT_ALIASES)} AS payload FROM latest)
SELECT tenant_skey, source_id, payload->>'ad_name' AS ad_name, payload->>'spend' AS spend,
       payload->>'clicks' AS clicks, payload->>'date_start' AS date_start,
       payload->>'quality_ranking' AS quality_ranking
FROM ods
""")
def q_payload_extract(spark, d):
    o = _unified(spark, d)
    return o.select("tenant_skey", "source_id",
                    *[U.payload_field(F.col("payload"), f).alias(f)
                      for f in ("ad_name", "spend", "clicks", "date_start", "quality_ranking")])


@query("unify_metrics", sql=f"""
WITH {_CAST_CTE}
SELECT 'ads_insights' AS entity, CAST(count(DISTINCT client_uid) AS BIGINT) AS n_tenants,
       CAST(count(*) AS BIGINT) AS n_rows FROM latest
""")
def q_unify_metrics(spark, d):
    o = _unified(spark, d)
    return o.agg(F.count_distinct("client_uid").alias("n_tenants"), F.count(F.lit(1)).alias("n_rows")) \
            .select(F.lit("ads_insights").alias("entity"), "n_tenants", "n_rows")


@query("grain_check", sql=f"""
WITH {_CAST_CTE}
SELECT tenant_skey, ad_id, date_start, CAST(count(*) AS BIGINT) AS n_rows
FROM casted GROUP BY ALL HAVING count(*) > 1
""")
def q_grain_check(spark, d):
    return FR.grain_violations(_typed(spark, d), ["tenant_skey", "ad_id", "date_start"])


@query("preview", sql=f"""
WITH {_CAST_CTE}
SELECT tenant_skey, {S.source_id_sql(['ad_id', 'date_start'])} AS source_id,
       extracted_at AS _record_created_at
FROM latest ORDER BY tenant_skey, source_id LIMIT 20
""")
def q_preview(spark, d):
    o = _unified(spark, d)
    return o.orderBy("tenant_skey", "source_id").limit(20).select("tenant_skey", "source_id", "_record_created_at")


# Base / delta split for the merge: loads up to the 20th vs. from the 15th
# (an overlap of six days is restated by the delta).
_BASE_END, _DELTA_START = "2024-01-20", "2024-01-15"


def _base_delta(spark, d):
    t = _typed(spark, d)
    return (t.where(F.col("date_start") <= F.lit(_BASE_END).cast("date")),
            t.where(F.col("date_start") >= F.lit(_DELTA_START).cast("date")))


_MERGE_ORDER = "extracted_at DESC NULLS LAST, tie DESC"


@query("merge_upsert", sql=f"""
WITH {_CAST_CTE},
both_sides AS (
  SELECT * FROM casted WHERE date_start <= DATE '{_BASE_END}'
  UNION ALL SELECT * FROM casted WHERE date_start >= DATE '{_DELTA_START}')
SELECT tenant_skey, ad_id, date_start, extracted_at, tie AS _dlt_id FROM both_sides
QUALIFY row_number() OVER (PARTITION BY tenant_skey, ad_id, date_start ORDER BY {_MERGE_ORDER}) = 1
""")
def q_merge_upsert(spark, d):
    base, delta = _base_delta(spark, d)
    m = FR.upsert(base, delta, ["tenant_skey", "ad_id", "date_start"],
                  [F.col("extracted_at").desc_nulls_last(), F.col("_tie").desc()])
    return m.select("tenant_skey", "ad_id", "date_start", "extracted_at", F.col("_tie").alias("_dlt_id"))


@query("incremental_lag", sql=f"""
WITH {_CAST_CTE},
delta AS (SELECT * FROM casted WHERE date_start >= DATE '{_DELTA_START}'),
cursors AS (SELECT tenant_skey, max(date_start) AS c FROM casted WHERE date_start <= DATE '{_BASE_END}' GROUP BY 1),
lagged AS (SELECT d.* FROM delta d LEFT JOIN cursors k ON d.tenant_skey = k.tenant_skey
           WHERE k.c IS NULL OR d.date_start >= k.c - 3),
both_sides AS (
  SELECT * FROM casted WHERE date_start <= DATE '{_BASE_END}' UNION ALL SELECT * FROM lagged)
SELECT tenant_skey, ad_id, date_start, extracted_at, tie AS _dlt_id FROM both_sides
QUALIFY row_number() OVER (PARTITION BY tenant_skey, ad_id, date_start ORDER BY {_MERGE_ORDER}) = 1
""")
def q_incremental_lag(spark, d):
    base, delta = _base_delta(spark, d)
    m = FR.upsert(base, FR.lag_window(delta, base, "date_start", 3, ["tenant_skey"]), ["tenant_skey", "ad_id", "date_start"],
                  [F.col("extracted_at").desc_nulls_last(), F.col("_tie").desc()])
    return m.select("tenant_skey", "ad_id", "date_start", "extracted_at", F.col("_tie").alias("_dlt_id"))


@query("guards", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL}), roster AS ({P.ROSTER_SQL}),
counts AS (SELECT client, count(*) AS n FROM extracts GROUP BY client)
SELECT coalesce(r.client_slug, c.client) AS client_slug, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows,
       CASE WHEN r.client_slug IS NULL THEN 'unknown_tenant' WHEN coalesce(c.n, 0) = 0 THEN 'skip' ELSE 'run' END AS action
FROM roster r FULL OUTER JOIN counts c ON r.client_slug = c.client
""")
def q_guards(spark, d):
    # Roster tenants '003'/'004' land rows; unknown slugs are reported.
    r = P.roster(spark, d)
    return FR.tenant_actions(r, P.extracts(spark, d).select("client"))


def _parent_query(entity: str, name: str):
    """Raw loads of one parent entity through cast, tag, dedupe, payload and hash."""
    spec, keys = PARENT_SPECS[entity], list(PARENT_KEYS[entity])
    raw, columns = P.entity_sql(entity)

    @query(name, sql=f"""
WITH raw AS ({raw}), roster AS ({P.ROSTER_SQL}),
org_map AS (SELECT client_slug, min(org_slug) AS org FROM roster GROUP BY client_slug),
casted AS (
  SELECT {S.spec_select(spec, columns, 'e')}, {S.extracted_at_sql('e._dlt_load_id')} AS _ext, e._dlt_id AS tie,
         coalesce(o.org, '{U.DEFAULT_ORG}') AS org_uid, e.client AS client_uid,
         coalesce(o.org, '{U.DEFAULT_ORG}') || '__' || e.client AS tenant_skey
  FROM raw e LEFT JOIN org_map o ON e.client = o.client_slug),
latest AS (SELECT * FROM casted
  QUALIFY row_number() OVER (PARTITION BY tenant_skey, {", ".join(keys)} ORDER BY _ext DESC NULLS LAST, tie DESC) = 1)
SELECT tenant_skey, org_uid, client_uid, {S.source_id_sql(keys)} AS source_id,
       {S.change_hash_sql(S.source_id_sql(keys), '_ext')} AS source_schema_hash, _ext AS _record_created_at, tie AS _dlt_id,
       {", ".join(s.alias for s in spec if s.alias not in keys)}
FROM latest
""")
    def q(spark, d):
        rows = P.entity_raw(spark, d, entity)
        out = U.unify_parent(rows, entity, LOADED_AT, roster=P.roster(spark, d), row_id="_dlt_id")
        # The payload is read back field by field with the spec's types.
        types = ", ".join(f"{s.alias} {_SPARK_TYPES[s.cast]}" for s in spec)
        body = F.from_json("payload", types)
        return (out.where("tenant_skey IS NOT NULL AND source_id IS NOT NULL")
                   .select("tenant_skey", "org_uid", "client_uid", "source_id", "source_schema_hash", "_record_created_at", "_dlt_id",
                           *[body[s.alias].alias(s.alias) for s in spec if s.alias not in keys]))
    q.__name__ = f"q_{name}"


_SPARK_TYPES = {"STRING": "string", "INT64": "bigint", "FLOAT64": "double", "DATE": "date", "TIMESTAMP": "timestamp", "JSON_STRING": "string"}
for _entity, _name in (("ads", "unify_ads"), ("ad_sets", "unify_ad_sets"), ("ad_creatives", "unify_ad_creatives"),
                       ("ad_creatives_asset_feed", "unify_asset_feed"), ("campaigns", "unify_campaigns")):
    _parent_query(_entity, _name)
