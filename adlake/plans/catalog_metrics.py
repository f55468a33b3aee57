"""Queries: metric rollups, facts and dimensions, declared entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from adlake.operators import entities as EN
from adlake.operators import metrics as M
from adlake.operators import normalize as N
from adlake.plans import proxies as P
from adlake.plans.catalog_unify import _CAST_CTE, _typed
from adlake.plans.registry import query

_I = f"i AS ({P.INSIGHTS_SQL})"


def _ratios_sql():
    """Sums and ratios across days: distinct users (reach) don't add up over days."""
    return (f"round(sum(spend), 2) AS spend, CAST(sum(impressions) AS BIGINT) AS impressions, "
            f"CAST(sum(clicks) AS BIGINT) AS clicks, CAST(NULL AS BIGINT) AS reach, "
            f"round(sum(spend) / nullif(sum(clicks), 0), 6) AS cpc, "
            f"round(1000.0 * sum(spend) / nullif(sum(impressions), 0), 6) AS cpm, "
            f"round(100.0 * sum(clicks) / nullif(sum(impressions), 0), 6) AS ctr, "
            f"CAST(NULL AS DOUBLE) AS frequency")


def _rounded(df):
    return (df.withColumn("spend", F.round("spend", 2))
              .withColumn("cpc", F.round("cpc", 6)).withColumn("cpm", F.round("cpm", 6))
              .withColumn("ctr", F.round("ctr", 6)).withColumn("frequency", F.round("frequency", 6)))


@query("metric_rollup", sql=f"""
WITH {_I}
SELECT client, campaign_id, CAST(grouping_id(client, campaign_id) AS BIGINT) AS grouping_level, {_ratios_sql()}
FROM i GROUP BY ROLLUP (client, campaign_id)
""")
def q_metric_rollup(spark, d):
    return _rounded(M.aggregate(P.insights(spark, d), ["client", "campaign_id"], mode="rollup"))


@query("spend_ctr_by_dim", sql=f"""
WITH {_I}
SELECT device_platform, {_ratios_sql()} FROM i GROUP BY device_platform
""")
def q_spend_ctr_by_dim(spark, d):
    return _rounded(M.aggregate(P.insights(spark, d), ["device_platform"]))


@query("fact_ad_performance", sql=f"""
WITH {_CAST_CTE}
SELECT tenant_skey, ad_id, date_start, round(spend, 2) AS spend, impressions, clicks, reach,
       round(spend / nullif(clicks, 0), 6) AS cpc, round(1000.0 * spend / nullif(impressions, 0), 6) AS cpm,
       round(100.0 * clicks / nullif(impressions, 0), 6) AS ctr, round(impressions / nullif(reach, 0), 6) AS frequency
FROM latest
""")
def q_fact_ad_performance(spark, d):
    """One row per (tenant, ad, day): of repeated loads only the latest counts."""
    from adlake.operators import unify as U

    latest = U.dedupe_latest(_typed(spark, d), ["tenant_skey", "ad_id", "date_start"],
                             [F.col("extracted_at").desc_nulls_last(), F.col("_tie").desc()])
    return _rounded(M.aggregate(latest, ["tenant_skey", "ad_id", "date_start"]))


_DIMS = {"Ad": ("ad_id", ("adset_id", "campaign_id", "account_id")), "AdSet": ("adset_id", ("campaign_id", "account_id")),
         "Campaign": ("campaign_id", ("account_id",)), "AdAccount": ("account_id", ())}


def _dim_sql(kind):
    key, own = _DIMS[kind]
    cols = ", ".join(f"{a if a in own else 'NULL'}::VARCHAR AS {a}" for a in ("adset_id", "campaign_id", "account_id"))
    return f"""SELECT '{kind}' AS kind, client, {key} AS id, {cols},
       min(date_start) OVER (PARTITION BY client, {key}) AS first_seen,
       max(date_start) OVER (PARTITION BY client, {key}) AS last_seen
FROM i WHERE {key} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY client, {key} ORDER BY date_start DESC, row_id DESC) = 1"""


@query("thin_dims", sql=f"WITH {_I} " + " UNION ALL ".join(f"SELECT * FROM ({_dim_sql(k)})" for k in _DIMS))
def q_thin_dims(spark, d):
    return EN.thin_dimensions(P.insights(spark, d), "client", _DIMS, "date_start", "row_id")


@query("scd2_dim", sql=f"""
WITH {_CAST_CTE},
one AS (SELECT tenant_skey, ad_id, objective, extracted_at FROM casted WHERE extracted_at IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY tenant_skey, ad_id, extracted_at ORDER BY tie DESC) = 1),
v AS (SELECT *, lag(objective) OVER w AS prev, row_number() OVER w AS n
      FROM one WINDOW w AS (PARTITION BY tenant_skey, ad_id ORDER BY extracted_at)),
ch AS (SELECT * FROM v WHERE n = 1 OR prev IS DISTINCT FROM objective)
SELECT sha256(tenant_skey || '|' || ad_id || '|' || CAST(epoch_us(extracted_at) AS VARCHAR)) AS dim_skey, tenant_skey, ad_id,
       objective, extracted_at AS valid_from, lead(extracted_at) OVER w AS valid_to, lead(extracted_at) OVER w IS NULL AS is_current
FROM ch WINDOW w AS (PARTITION BY tenant_skey, ad_id ORDER BY extracted_at)
""")
def q_scd2_dim(spark, d):
    t = _typed(spark, d).where(F.col("extracted_at").isNotNull())
    return EN.scd2(t, ["tenant_skey", "ad_id"], ["objective"], "extracted_at", "_tie")


# Concepts and the source tables that back them (declared semantic model).
CONCEPTS = [
    ("AdPerformance", "ads_insights"),
    ("ConversionEvent", "ads_insights__actions"),
    ("ConversionEvent", "ads_insights__action_values"),
    ("ConversionEvent", "ads_insights__video_play_actions"),
    ("AttributedROAS", "ads_insights__purchase_roas"),
    ("AttributedROAS", "ads_insights__website_purchase_roas"),
    ("VideoEngagement", "ads_insights__video_p25_watched_actions"),
    ("Ad", "ads_insights"), ("AdSet", "ads_insights"), ("Campaign", "ads_insights"), ("AdAccount", "ads_insights"),
]
_CONCEPTS_SQL = "(VALUES " + ", ".join(f"('{c}', '{t}')" for c, t in CONCEPTS) + ") cat(concept, source_table)"


@query("concept_coverage", sql=f"""
WITH present AS (
  SELECT 'ads_insights' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM lineitem
  UNION ALL SELECT 'ads_insights__actions', CAST(sum(l_linenumber % 4) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'ads_insights__action_values', CAST(sum(l_orderkey % 3) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'ads_insights__video_p25_watched_actions', CAST(sum(l_linenumber % 2) AS BIGINT) FROM lineitem
  {" ".join(f"UNION ALL SELECT 'ads_insights__{n}', CAST(sum({length}) AS BIGINT) FROM lineitem" for n, (_, _, length) in P.ONE_ELEMENT_LISTS.items())})
SELECT concept, source_table, p.n_rows, p.table_name IS NULL AS missing
FROM {_CONCEPTS_SQL} LEFT JOIN present p ON cat.source_table = p.table_name
""")
def q_concept_coverage(spark, d):
    rows, _ = N.tagged_rows(P.nested(spark, d), "ads_insights", 2)  # all tables' rows from one scan
    present = rows.groupBy(F.col("_table").alias("table_name")).agg(F.count(F.lit(1)).alias("n_rows"))
    cat = spark.createDataFrame(CONCEPTS, "concept string, source_table string")
    j = F.broadcast(cat).join(present, cat["source_table"] == present["table_name"], "left")  # catalogue: fixed size
    return j.select("concept", "source_table", "n_rows", F.col("table_name").isNull().alias("missing"))


@query("creative_variants", sql=f"""
WITH {P.ASSET_FEED_SQL}
SELECT creative_id, variant_kind, CAST(unnest(range(len(l))) AS INTEGER) AS position, unnest(l) AS value FROM lists
""")
def q_creative_variants(spark, d):
    return EN.creative_variants(P.asset_feed(spark, d), "asset_feed_spec", P.FEED_KINDS)


@query("product_refs", sql="""
SELECT CAST(doc_id // 3 AS VARCHAR) AS creative_id, 'onsite_destination' AS ref_kind,
       source || ':' || CAST(doc_id AS VARCHAR) AS product_id FROM documents
UNION ALL
SELECT CAST(doc_id // 3 AS VARCHAR), 'retailer_item_id', 'q' || CAST(quality AS VARCHAR) || '-' || CAST(doc_id AS VARCHAR)
FROM labels
""")
def q_product_refs(spark, d):
    docs = P.table(spark, d, "documents").select(
        F.expr("cast(doc_id div 3 as string)").alias("creative_id"),
        F.concat(F.col("source"), F.lit(":"), F.col("doc_id").cast("string")).alias("product_id"))
    lab = P.table(spark, d, "labels").select(
        F.expr("cast(doc_id div 3 as string)").alias("creative_id"),
        F.concat(F.lit("q"), F.col("quality").cast("string"), F.lit("-"), F.col("doc_id").cast("string")).alias("product_id"))
    return EN.tag_union({"onsite_destination": docs, "retailer_item_id": lab}, "ref_kind")


def _flag_sql(i):
    return f"CASE (n_chars + {i}) % 3 WHEN 0 THEN 'OPT_IN' WHEN 1 THEN 'OPT_OUT' END"


@query("feature_flags", sql=" UNION ALL ".join(f"""
SELECT CAST(doc_id AS VARCHAR) AS creative_id, '{n}' AS feature_name, {_flag_sql(i)} AS enroll_status FROM documents"""
                                              for i, n in enumerate(P.FEATURES)))
def q_feature_flags(spark, d):
    """Status leaves of the nested features spec: flattened, then unpivoted."""
    flat = N.flatten_struct(P.asset_feed(spark, d).select("creative_id", "degrees_of_freedom_spec"))
    prefix, suffix = "degrees_of_freedom_spec__creative_features_spec__", "__enroll_status"
    names = {c: c[len(prefix):-len(suffix)] for c in flat.columns if c.startswith(prefix)}
    wide = flat.select("creative_id", *[F.col(c).alias(n) for c, n in names.items()])
    return EN.unpivot_flags(wide, ["creative_id"], list(names.values()))
