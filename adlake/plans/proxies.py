"""Proxy adapters: shape the driver's tables like the marketing lake.

The driver tables hold no ad data, so each adapter is a plain projection
(Spark side) with an SQL twin (oracle side).  Operators never see the proxy;
they receive DataFrames with the raw column names they expect.  Metric
columns are text so the lenient casts do real work.  No adapter samples or
caps rows, and ids come from the tables' own ids, so rows and keys grow with
the source (``video_sources`` leaves out private videos: that is the feature).
Tenants are few, as in the lake.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_TENANTS = 7  # tenants are assigned by user/customer id modulo this


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dec2(c: Column) -> Column:
    """Text of a 2-decimal amount ('12.30'), via DECIMAL (no formatter)."""
    return c.cast("decimal(18,2)").cast("string")


def dec2_sql(e: str) -> str:
    return f"CAST(CAST({e} AS DECIMAL(18,2)) AS VARCHAR)"


def _ts(c: str) -> Column:
    return F.col(c).cast("timestamp")


# ---------------------------------------------------------------- extracts
# Raw ads_insights rows landed per tenant: one row per event, so several
# loads per (ad, day) -> real duplicates for the latest-row dedupe.

def extracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    tenant = F.lpad((F.col("user_id") % N_TENANTS).cast("string"), 3, "0")
    day = F.date_format(_ts("ts"), "yyyy-MM-dd")
    us = F.unix_micros(_ts("ts"))
    load_id = F.concat(F.expr("unix_micros(cast(ts as timestamp)) div 1000000").cast("string"),
                       F.lit("."), F.lpad((us % 1000000).cast("string"), 6, "0"))
    return ev.select(
        tenant.alias("client"),
        F.col("user_id").cast("string").alias("ad_id"),
        F.concat(F.lit(" ad "), F.col("user_id").cast("string"), F.lit("\t")).alias("ad_name"),
        (F.col("user_id") % 17).cast("string").alias("adset_id"),
        F.col("event_type").alias("campaign_id"),
        F.concat(F.lit("act_"), tenant).alias("account_id"),
        F.upper("event_type").alias("objective"),
        day.alias("date_start"),
        day.alias("date_stop"),
        F.floor(F.col("value") * 10).cast("string").alias("impressions"),
        F.floor(F.col("value") * 7).cast("string").alias("reach"),
        F.when(F.col("event_type") == "error", F.lit("n/a"))
         .otherwise((F.floor("value") % 50).cast("string")).alias("clicks"),
        F.when(F.col("event_id") % 11 == 0, F.lit("12.7"))
         .otherwise((F.floor("value") % 20).cast("string")).alias("unique_clicks"),
        dec2(F.col("value")).alias("spend"),
        F.concat(F.lit("0."), F.lpad(k, 2, "0")).alias("ctr"),
        F.concat(k, F.lit(".5")).alias("cpm"),
        F.when(k.cast("int") % 5 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("1."), (F.col("user_id") % 10).cast("string"))).alias("frequency"),
        F.when(k.cast("int") % 3 == 0, F.lit("ABOVE_AVERAGE"))
         .when(k.cast("int") % 3 == 1, F.lit(" AVERAGE "))
         .otherwise(F.lit("")).alias("quality_ranking"),
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
         .otherwise(load_id).alias("_dlt_load_id"),
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("_dlt_id"),
    )


EXTRACTS_SQL = f"""
SELECT
    lpad(CAST(user_id % {N_TENANTS} AS VARCHAR), 3, '0') AS client,
    CAST(user_id AS VARCHAR) AS ad_id,
    ' ad ' || CAST(user_id AS VARCHAR) || chr(9) AS ad_name,
    CAST(user_id % 17 AS VARCHAR) AS adset_id,
    event_type AS campaign_id,
    'act_' || lpad(CAST(user_id % {N_TENANTS} AS VARCHAR), 3, '0') AS account_id,
    upper(event_type) AS objective,
    strftime(ts, '%Y-%m-%d') AS date_start,
    strftime(ts, '%Y-%m-%d') AS date_stop,
    CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) AS impressions,
    CAST(CAST(floor(value * 7) AS BIGINT) AS VARCHAR) AS reach,
    CASE WHEN event_type = 'error' THEN 'n/a'
         ELSE CAST(CAST(floor(value) AS BIGINT) % 50 AS VARCHAR) END AS clicks,
    CASE WHEN event_id % 11 = 0 THEN '12.7'
         ELSE CAST(CAST(floor(value) AS BIGINT) % 20 AS VARCHAR) END AS unique_clicks,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS spend,
    '0.' || lpad(json_extract_string(props, '$.k'), 2, '0') AS ctr,
    json_extract_string(props, '$.k') || '.5' AS cpm,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 = 0 THEN ''
         ELSE '1.' || CAST(user_id % 10 AS VARCHAR) END AS frequency,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 0 THEN 'ABOVE_AVERAGE'
         WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 = 1 THEN ' AVERAGE '
         ELSE '' END AS quality_ranking,
    CASE WHEN event_id % 97 = 0 THEN NULL
         ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) || '.' || lpad(CAST(epoch_us(ts) % 1000000 AS VARCHAR), 6, '0')
    END AS _dlt_load_id,
    'r' || CAST(event_id AS VARCHAR) AS _dlt_id
FROM events
"""
EXTRACTS_COLUMNS = {"client", "ad_id", "ad_name", "adset_id", "campaign_id", "account_id", "objective",
                    "date_start", "date_stop", "impressions", "reach", "clicks", "unique_clicks", "spend",
                    "ctr", "cpm", "frequency", "quality_ranking", "_dlt_load_id", "_dlt_id"}


# ---------------------------------------------------------------- roster
# Tenant roster (client_slug, org_slug, ad_account_id) from region: tenants
# whose slug has no region fall back to the default org.

def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    slug = F.lpad(F.col("r_regionkey").cast("string"), 3, "0")
    return r.select(slug.alias("client_slug"), F.lower("r_name").alias("org_slug"),
                    F.concat(F.lit("act_"), slug).alias("ad_account_id"))


ROSTER_SQL = """
SELECT lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS client_slug,
       lower(r_name) AS org_slug,
       'act_' || lpad(CAST(r_regionkey AS VARCHAR), 3, '0') AS ad_account_id
FROM region
"""


# ---------------------------------------------------------------- drifted
# Two tenants of one "campaigns" entity whose files disagree: customers carry
# a numeric budget and a status; suppliers carry the budget as text and no
# status column at all.

def drifted_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.lit("cust").alias("client"), F.col("c_custkey").alias("id"),
                    F.col("c_nationkey").alias("account_id"), F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("status"), F.col("c_acctbal").alias("daily_budget"),
                    F.concat(F.col("c_name"), F.lit("#")).alias("internal_note"))


def drifted_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.lit("supp").alias("client"), F.col("s_suppkey").alias("id"),
                    F.col("s_nationkey").alias("account_id"), F.col("s_name").alias("name"),
                    dec2(F.col("s_acctbal")).alias("daily_budget"))


DRIFTED_CUSTOMER_SQL = """
SELECT 'cust' AS client, c_custkey AS id, c_nationkey AS account_id, c_name AS name,
       c_mktsegment AS status, c_acctbal AS daily_budget, c_name || '#' AS internal_note
FROM customer"""
DRIFTED_SUPPLIER_SQL = """
SELECT 'supp' AS client, s_suppkey AS id, s_nationkey AS account_id, s_name AS name,
       CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS daily_budget
FROM supplier"""


# ---------------------------------------------------------------- nested
# Nested insight rows (as a report page yields them) from lineitem: one row
# per line, with action / action_value / video lists of 0-3 elements whose
# length follows the line number, and struct columns to flatten.

def _f2(c: str) -> Column:
    return F.col(f"_t_{c}")  # text of a 2-decimal column, computed once per row


def _action(kind: str, value: Column, target: Column, windows: bool = True) -> Column:
    fields = [F.lit(kind).alias("action_type"), target.alias("action_target_id"),
              F.lit("web").alias("action_destination"), value.alias("value")]
    if windows:
        fields += [_f2("l_discount").alias("1d_view"), _f2("l_tax").alias("1d_click"),
                   F.lit(None).cast("string").alias("7d_view"),
                   F.col("_t_l_linenumber").alias("7d_click")]
    return F.struct(*fields)


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    li = li.select("*", *[dec2(F.col(c)).alias(f"_t_{c}") for c in
                          ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
                   F.col("l_linenumber").cast("string").alias("_t_l_linenumber"),
                   (F.col("l_partkey") % 5).cast("string").alias("_t_target"))
    target = F.col("_t_target")
    actions = F.slice(F.array(
        _action("purchase", _f2("l_quantity"), target),
        _action("add_to_cart", F.col("_t_l_linenumber"), target),
        _action("view", _f2("l_extendedprice"), target)), 1, F.col("l_linenumber") % 4)
    values = F.slice(F.array(
        _action("purchase", _f2("l_extendedprice"), target),
        _action("view", _f2("l_tax"), target),
        _action("lead", _f2("l_discount"), target)), 1, (F.col("l_orderkey") % 3).cast("int"))
    video = F.slice(F.array(F.struct(F.lit("video_view").alias("action_type"),
                                     _f2("l_quantity").alias("value"))), 1, F.col("l_linenumber") % 2)

    def one(kind: str, value: Column, length: Column) -> Column:
        return F.slice(F.array(F.struct(F.lit(kind).alias("action_type"), value.alias("value"))), 1, length.cast("int"))

    ship = F.col("l_shipdate").cast("timestamp")
    return li.select(
        F.concat(F.lit("li"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("_dlt_id"),
        F.lpad((F.col("l_suppkey") % N_TENANTS).cast("string"), 3, "0").alias("client"),
        F.col("l_partkey").cast("string").alias("ad_id"),
        F.date_format(F.trunc(ship, "year"), "yyyy-MM-dd").alias("date_start"),
        _f2("l_extendedprice").alias("spend"),
        F.col("_t_l_linenumber").alias("clicks"),
        F.concat(F.unix_seconds(ship).cast("string"), F.lit("."),
                 F.lpad(F.col("l_linenumber").cast("string"), 6, "0")).alias("_dlt_load_id"),
        F.struct(F.col("l_returnflag").alias("flag"),
                 F.struct(F.col("l_linestatus").alias("status")).alias("line")).alias("meta"),
        actions.alias("actions"), values.alias("action_values"),
        video.alias("video_p25_watched_actions"),
        one("video_view", _f2("l_discount"), F.col("l_linenumber") % 2).alias("video_p50_watched_actions"),
        one("video_view", _f2("l_tax"), F.col("l_orderkey") % 2).alias("video_p75_watched_actions"),
        one("video_view", F.col("_t_l_linenumber"), F.col("l_partkey") % 2).alias("video_p100_watched_actions"),
        one("video_view", F.col("_t_l_linenumber"), F.col("l_suppkey") % 2).alias("video_play_actions"),
        one("omni_purchase", _f2("l_tax"), F.col("l_linenumber") % 2).alias("purchase_roas"),
        one("offsite_conversion", _f2("l_discount"), F.col("l_orderkey") % 2).alias("website_purchase_roas"),
    )


NESTED_PARENT_SQL = f"""
SELECT 'li' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS _dlt_id,
       lpad(CAST(l_suppkey % {N_TENANTS} AS VARCHAR), 3, '0') AS client,
       CAST(l_partkey AS VARCHAR) AS ad_id,
       strftime(date_trunc('year', l_shipdate), '%Y-%m-%d') AS date_start,
       CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS spend,
       CAST(l_linenumber AS VARCHAR) AS clicks,
       CAST(epoch(l_shipdate)::BIGINT AS VARCHAR) || '.' || lpad(CAST(l_linenumber AS VARCHAR), 6, '0') AS _dlt_load_id,
       l_returnflag AS meta__flag, l_linestatus AS meta__line__status,
       l_linenumber, l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem"""


def _child_sql(rows: list[tuple[str, str, int, str]], windows: bool, path: str) -> str:
    """Child rows of one list, written without lists: element i exists when
    the length expression exceeds i."""
    parts = []
    for kind, value, idx, length in rows:
        w = ("CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) AS _1d_view, CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR) AS _1d_click, "
             "CAST(NULL AS VARCHAR) AS _7d_view, CAST(l_linenumber AS VARCHAR) AS _7d_click"
             if windows else "")
        tgt = ("CAST(l_partkey % 5 AS VARCHAR) AS action_target_id, 'web' AS action_destination, "
               if windows or kind != 'video_view' else "")
        parts.append(f"""SELECT md5(_dlt_id || '|{path}|{idx}') AS _dlt_id, _dlt_id AS _dlt_parent_id,
            CAST({idx} AS BIGINT) AS _dlt_list_idx, client, '{kind}' AS action_type, {tgt}{value} AS value{', ' + w if w else ''}
            FROM parent WHERE {length} > {idx}""")
    return " UNION ALL ".join(parts)


ACTIONS_SQL = _child_sql([
    ("purchase", "CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)", 0, "l_linenumber % 4"),
    ("add_to_cart", "CAST(l_linenumber AS VARCHAR)", 1, "l_linenumber % 4"),
    ("view", "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)", 2, "l_linenumber % 4")], True, "ads_insights__actions")
ACTION_VALUES_SQL = _child_sql([
    ("purchase", "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)", 0, "l_orderkey % 3"),
    ("view", "CAST(CAST(l_tax AS DECIMAL(18,2)) AS VARCHAR)", 1, "l_orderkey % 3"),
    ("lead", "CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR)", 2, "l_orderkey % 3")], True, "ads_insights__action_values")
VIDEO_SQL = _child_sql([("video_view", "CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR)", 0, "l_linenumber % 2")], False,
                       "ads_insights__video_p25_watched_actions")
_DEC = "CAST(CAST({} AS DECIMAL(18,2)) AS VARCHAR)".format
#: One-element lists: table, (action type, value, length).
ONE_ELEMENT_LISTS = {
    "video_p50_watched_actions": ("video_view", _DEC("l_discount"), "l_linenumber % 2"),
    "video_p75_watched_actions": ("video_view", _DEC("l_tax"), "l_orderkey % 2"),
    "video_p100_watched_actions": ("video_view", "CAST(l_linenumber AS VARCHAR)", "l_partkey % 2"),
    "video_play_actions": ("video_view", "CAST(l_linenumber AS VARCHAR)", "l_suppkey % 2"),
    "purchase_roas": ("omni_purchase", _DEC("l_tax"), "l_linenumber % 2"),
    "website_purchase_roas": ("offsite_conversion", _DEC("l_discount"), "l_orderkey % 2"),
}


def one_element_sql(name: str) -> str:
    kind, value, length = ONE_ELEMENT_LISTS[name]
    return f"""SELECT md5(_dlt_id || '|ads_insights__{name}|0') AS _dlt_id, _dlt_id AS _dlt_parent_id,
        CAST(0 AS BIGINT) AS _dlt_list_idx, client, '{kind}' AS action_type, {value} AS value
        FROM parent WHERE {length} > 0"""


# ---------------------------------------------------------------- creatives
# ODS ad_creatives rows (tenant, source_id, JSON payload) from documents:
# the image URL is the page with the same id (none past the last page), the
# thumbnail is missing for every third doc, German docs carry a video id and
# every 50th payload is empty.

_KIND_BY_LANG = "CASE lang WHEN 'en' THEN 'image' WHEN 'de' THEN 'thumbnail' WHEN 'fr' THEN 'video' ELSE 'image' END"


def creatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    j = docs.join(pages, docs["doc_id"] == pages["page_id"], "left")
    cid = F.col("doc_id").cast("string")
    payload = F.to_json(F.struct(
        cid.alias("creative_id"),
        F.concat(F.lit("creative "), cid, F.lit(" "), F.col("lang")).alias("creative_name"),
        F.col("url").alias("image_url"),
        F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.concat(F.col("url"), F.lit("?thumb=1"))).alias("thumbnail_url"),
        F.when(F.col("lang") == "de", F.concat(F.lit("v"), cid)).alias("video_id"),
        F.upper(F.col("source")).alias("cta_type"),
        F.col("lang").alias("media_type")), {"ignoreNullFields": "false"})
    return j.select(
        F.concat(F.lit("org_"), F.col("lang"), F.lit("__"), F.col("source")).alias("tenant_skey"),
        F.concat(F.lit("org_"), F.col("lang")).alias("org_uid"),
        F.col("source").alias("client_uid"), cid.alias("source_id"),
        F.when(F.col("doc_id") % 50 == 0, F.lit("")).otherwise(payload).alias("payload"),
        # response content type the download would see (proxy)
        F.expr("CASE doc_id % 4 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png; charset=binary' "
               "WHEN 2 THEN NULL ELSE ' video/mp4 ' END").alias("content_type"))


CREATIVES_SQL = """
SELECT 'org_' || d.lang || '__' || d.source AS tenant_skey, 'org_' || d.lang AS org_uid,
       d.source AS client_uid, CAST(d.doc_id AS VARCHAR) AS source_id,
       CASE WHEN d.doc_id % 50 = 0 THEN '' ELSE CAST(to_json(struct_pack(
         creative_id := CAST(d.doc_id AS VARCHAR),
         creative_name := 'creative ' || CAST(d.doc_id AS VARCHAR) || ' ' || d.lang,
         image_url := p.url,
         thumbnail_url := CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE p.url || '?thumb=1' END,
         video_id := CASE WHEN d.lang = 'de' THEN 'v' || CAST(d.doc_id AS VARCHAR) END,
         cta_type := upper(d.source), media_type := d.lang)) AS VARCHAR) END AS payload,
       CASE d.doc_id % 4 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/png; charset=binary'
            WHEN 2 THEN NULL ELSE ' video/mp4 ' END AS content_type,
       d.doc_id, d.lang, d.source, p.url
FROM documents d LEFT JOIN pages p ON d.doc_id = p.page_id"""


# Video id -> downloadable source, resolved for docs whose length is not a
# multiple of five (the rest are "private" and dropped).
def video_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.where((F.col("lang") == "de") & (F.col("n_chars") % 5 != 0)).select(
        F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("video_id"),
        F.concat(F.lit("https://video.example.com/"), F.col("doc_id").cast("string"), F.lit(".mp4")).alias("source"))


VIDEO_SOURCES_SQL = """
SELECT 'v' || CAST(doc_id AS VARCHAR) AS video_id,
       'https://video.example.com/' || CAST(doc_id AS VARCHAR) || '.mp4' AS source
FROM documents WHERE lang = 'de' AND n_chars % 5 <> 0"""


# ---------------------------------------------------------------- manifest
# Asset manifest rows from documents: three runs (dates) by doc id, kind by
# language, bytes/digest of the text, every fourth row a skipped existing
# object (empty digest).

def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    run = (F.col("doc_id") % 3 + 1).cast("string")
    kind = F.expr(_KIND_BY_LANG)
    skipped = F.col("doc_id") % 4 == 0
    return d.select(
        F.expr("cast(doc_id div 4 as string)").alias("creative_id"),
        F.col("source").alias("client_uid"), F.concat(F.lit("org_"), F.col("lang")).alias("org_uid"),
        kind.alias("asset_kind"),
        F.concat(F.lit("lake://assets/client="), F.col("source"), F.lit("/asset_kind="), kind, F.lit("/"),
                 F.col("doc_id").cast("string"), F.lit(".bin")).alias("gcs_uri"),
        F.concat(F.lit("https://cdn.example.com/"), F.col("doc_id").cast("string")).alias("original_url"),
        F.expr("CASE lang WHEN 'fr' THEN 'video/mp4' WHEN 'de' THEN 'image/png' ELSE 'image/jpeg' END").alias("content_type"),
        F.octet_length("text").cast("bigint").alias("byte_size"),
        F.when(skipped, F.lit("")).otherwise(F.sha2("text", 256)).alias("sha256"),
        F.when(F.col("lang") == "fr", F.concat(F.lit("v"), F.col("doc_id").cast("string"))).alias("video_id"),
        F.timestamp_seconds(F.lit(1709251200) + F.col("doc_id") * 37).alias("downloaded_at"),
        skipped.alias("skipped_existing"),
        F.concat(F.lit("2024-03-0"), run).alias("date"),
        F.concat(F.lit("2024030"), run, F.lit("T0"), (F.col("doc_id") % 2).cast("string"), F.lit("0000Z")).alias("run_ts"))


MANIFEST_SQL = f"""
SELECT CAST(doc_id // 4 AS VARCHAR) AS creative_id, source AS client_uid, 'org_' || lang AS org_uid,
       {_KIND_BY_LANG} AS asset_kind,
       'lake://assets/client=' || source || '/asset_kind=' || ({_KIND_BY_LANG}) || '/' || CAST(doc_id AS VARCHAR) || '.bin' AS gcs_uri,
       'https://cdn.example.com/' || CAST(doc_id AS VARCHAR) AS original_url,
       CASE lang WHEN 'fr' THEN 'video/mp4' WHEN 'de' THEN 'image/png' ELSE 'image/jpeg' END AS content_type,
       CAST(octet_length(encode(text)) AS BIGINT) AS byte_size,
       CASE WHEN doc_id % 4 = 0 THEN '' ELSE sha256(text) END AS sha256,
       CASE WHEN lang = 'fr' THEN 'v' || CAST(doc_id AS VARCHAR) END AS video_id,
       make_timestamp(CAST((1709251200 + doc_id * 37) AS BIGINT) * 1000000) AS downloaded_at,
       doc_id % 4 = 0 AS skipped_existing,
       '2024-03-0' || CAST(doc_id % 3 + 1 AS VARCHAR) AS date,
       '2024030' || CAST(doc_id % 3 + 1 AS VARCHAR) || 'T0' || CAST(doc_id % 2 AS VARCHAR) || '0000Z' AS run_ts
FROM documents"""


# ---------------------------------------------------------------- narratives
# Creative versions with link / template / video branches (mutually
# exclusive by language); three documents are versions of one creative, the
# newest wins.  Headline: the first line of the text, body: the rest.

def narratives(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    head = F.substring_index("text", "\n", 1)
    body = F.expr("substring(text, length(substring_index(text, '\\n', 1)) + 2)")
    link = F.concat(F.lit("https://shop.example.com/"), F.col("source"))
    return d.select(
        F.expr("cast(doc_id div 3 as string)").alias("creative_id"), F.col("doc_id").alias("version"),
        F.when(F.col("lang") == "en", F.struct(head.alias("name"), body.alias("message"),
                                               F.col("source").alias("description"), link.alias("link"))).alias("link_data"),
        F.when(F.col("lang") == "de", F.struct(head.alias("name"), body.alias("message"),
                                               F.lit(None).cast("string").alias("description"), link.alias("link"))).alias("template_data"),
        F.when(F.col("lang") == "fr", F.struct(head.alias("title"), body.alias("message"),
                                               F.col("source").alias("link_description"),
                                               link.alias("call_to_action_link"))).alias("video_data"))


NARRATIVES_SQL = """
SELECT CAST(doc_id // 3 AS VARCHAR) AS creative_id, doc_id AS version, lang,
       CASE WHEN lang IN ('en', 'de', 'fr') THEN split_part(text, chr(10), 1) END AS headline,
       CASE WHEN lang IN ('en', 'de', 'fr') THEN substr(text, length(split_part(text, chr(10), 1)) + 2) END AS body,
       CASE WHEN lang IN ('en', 'fr') THEN source END AS description,
       CASE WHEN lang IN ('en', 'de', 'fr') THEN 'https://shop.example.com/' || source END AS destination_url
FROM documents"""


# ---------------------------------------------------------------- insights
# Typed ad-level daily insights from the star schema: ad = part, adset =
# supplier, campaign = brand, account = nation, client = region, platform
# from the line status.  Dimension sides are size-checked before broadcast;
# the customer's side is joined to the orders first, so that the far more
# numerous lines are shuffled for one join with it, not for two.

def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adlake.operators.joins import sized_broadcast
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = sized_broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), 10_000)
    r = sized_broadcast(table(spark, sf_dir, "region").select("r_regionkey", "r_name"), 10_000)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    o = (o.join(c, F.col("o_custkey") == c["c_custkey"])
          .join(n, F.col("c_nationkey") == n["n_nationkey"])
          .join(r, F.col("n_regionkey") == r["r_regionkey"])
          .select("o_orderkey", "n_name", "r_name"))
    j = (li.join(o, li["l_orderkey"] == o["o_orderkey"])
           .join(p, li["l_partkey"] == p["p_partkey"]))
    imp = (F.col("l_quantity") * 100).cast("bigint")
    return j.select(
        F.lower("r_name").alias("client"),
        F.col("l_partkey").cast("string").alias("ad_id"),
        F.col("l_suppkey").cast("string").alias("adset_id"),
        F.col("p_brand").alias("campaign_id"),
        F.col("n_name").alias("account_id"),
        F.to_date(F.col("l_shipdate").cast("timestamp")).alias("date_start"),
        F.when(F.col("l_linestatus") == "O", F.lit("mobile_app")).otherwise(F.lit("desktop")).alias("device_platform"),
        imp.alias("impressions"), (imp / 2 + 1).cast("bigint").alias("reach"),
        F.col("l_linenumber").cast("bigint").alias("clicks"),
        F.col("l_extendedprice").alias("spend"),
        F.concat(F.lit("li"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("row_id"))


INSIGHTS_SQL = """
SELECT lower(r.r_name) AS client, CAST(l.l_partkey AS VARCHAR) AS ad_id, CAST(l.l_suppkey AS VARCHAR) AS adset_id,
       p.p_brand AS campaign_id, n.n_name AS account_id, CAST(l.l_shipdate AS DATE) AS date_start,
       CASE WHEN l.l_linestatus = 'O' THEN 'mobile_app' ELSE 'desktop' END AS device_platform,
       CAST(l.l_quantity * 100 AS BIGINT) AS impressions,
       CAST(CAST(l.l_quantity * 100 AS BIGINT) // 2 + 1 AS BIGINT) AS reach,
       CAST(l.l_linenumber AS BIGINT) AS clicks, l.l_extendedprice AS spend,
       'li' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS row_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
JOIN part p ON l.l_partkey = p.p_partkey"""


# Ads listing (one per part) whose creative reference is missing, empty or set.
def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    creative = (F.when(F.col("p_size") % 7 == 0, F.lit(None))
                 .when(F.col("p_size") % 7 == 1, F.struct(F.lit("").alias("id")))
                 .otherwise(F.struct(F.concat(F.lit("cr"), F.col("p_partkey").cast("string")).alias("id"))))
    return p.select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
                    creative.alias("creative"))


ADS_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name,
       CASE WHEN p_size % 7 = 0 THEN NULL WHEN p_size % 7 = 1 THEN ''
            ELSE 'cr' || CAST(p_partkey AS VARCHAR) END AS creative_id
FROM part"""


# Creatives listing: one per document, id 'cr<doc_id>'.
def creative_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.concat(F.lit("cr"), F.col("doc_id").cast("string")).alias("id"),
                    F.col("lang"), F.col("source"))


CREATIVE_LISTING_SQL = "SELECT 'cr' || CAST(doc_id AS VARCHAR) AS id, lang, source FROM documents"


# ---------------------------------------------------------------- bodies
# Landed response bodies (JSON text) built per row from conversations and
# events: report pages (0-2 rows, some without data, some malformed),
# multi-id maps (objects, error members, junk), job-status payloads and
# error bodies.

def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations")
    cid, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    item1 = F.concat(F.lit('{"conv_id": '), cid, F.lit(', "turn": '), turn, F.lit(', "role": "'), F.col("role"),
                     F.lit('"}'))
    item2 = F.concat(F.lit('{"conv_id": '), cid, F.lit(', "turn": '), (F.col("turn") + 1000).cast("string"),
                     F.lit(', "role": "echo"}'))
    body = (F.when(F.col("conv_id") % 7 == 0, F.lit("not json"))
             .when(F.col("conv_id") % 5 == 0, F.lit("{}"))
             .when(F.col("turn") % 3 == 0, F.lit('{"data": []}'))
             .when(F.col("turn") % 3 == 1, F.concat(F.lit('{"data": ['), item1, F.lit("]}")))
             .otherwise(F.concat(F.lit('{"data": ['), item1, F.lit(", "), item2,
                                 F.lit('], "paging": {"next": "https://example.com/next"}}'))))
    return cv.select(F.concat(cid, F.lit("-"), turn).alias("page_key"), body.alias("body"))


PAGE_ROWS_SQL = """
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS page_key, conv_id, turn, role FROM conversations
WHERE conv_id % 7 <> 0 AND conv_id % 5 <> 0 AND turn % 3 IN (1, 2)
UNION ALL
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR), conv_id, turn + 1000, 'echo' FROM conversations
WHERE conv_id % 7 <> 0 AND conv_id % 5 <> 0 AND turn % 3 = 2"""


def multi_id_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations")
    k = F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string"))
    obj = F.concat(_q(k), F.lit(': {"id": '), _q(k), F.lit(', "role": '), _q(F.col("role")), F.lit("}"))
    err = F.when(F.col("turn") % 2 == 0, F.concat(F.lit(", "), _q(F.concat(k, F.lit("e"))),
                                                  F.lit(': {"error": {"code": 100}}'))).otherwise(F.lit(""))
    junk = F.when(F.col("turn") % 3 == 0, F.concat(F.lit(", "), _q(F.concat(k, F.lit("j"))), F.lit(": [1, 2]"))) \
            .otherwise(F.lit(""))
    s = F.concat(F.lit(", "), _q(F.concat(k, F.lit("s"))), F.lit(': "x"'))
    return cv.select(k.alias("body_key"), F.concat(F.lit("{"), obj, err, junk, s, F.lit("}")).alias("body"))


MULTI_ID_KEPT_SQL = """
SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS object_key,
       CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id, role
FROM conversations"""

_STATUS_BY_TYPE = ("CASE event_type WHEN 'click' THEN 'Job Completed' WHEN 'view' THEN 'Job Running' "
                   "WHEN 'error' THEN 'Job Failed' WHEN 'signup' THEN 'Job Skipped' ELSE 'Job Started' END")


def status_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    pct = (F.when(F.col("event_id") % 4 == 0, F.floor("value").cast("string"))
            .when(F.col("event_id") % 4 == 1, dec2(F.col("value")))
            .when(F.col("event_id") % 4 == 2, _q(F.floor("value").cast("string")))
            .otherwise(F.lit("true")))
    title = (F.when(F.col("event_id") % 3 == 0, F.lit('""'))
              .when(F.col("event_id") % 3 == 1, _q(F.concat(F.lit("Title "), k)))
              .otherwise(F.lit("7")))
    code = F.when(F.col("event_type") == "error", F.concat(F.lit(', "error_code": '), k)).otherwise(F.lit(""))
    rid = F.when(F.col("event_id") % 10 == 0, F.lit("")).otherwise(
        F.concat(F.lit(', "report_run_id": "rr'), F.col("event_id").cast("string"), F.lit('"')))
    body = F.concat(F.lit('{"async_status": '), _q(F.expr(_STATUS_BY_TYPE)), F.lit(', "async_percent_completion": '),
                    pct, F.lit(', "error_user_title": '), title, code, rid, F.lit("}"))
    return ev.select("event_id", body.alias("body"))


STATUS_SQL = f"""
SELECT event_id, {_STATUS_BY_TYPE} AS async_status,
       CAST(CASE event_id % 4 WHEN 0 THEN floor(value) WHEN 1 THEN trunc(CAST(CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE))
            WHEN 2 THEN floor(value) ELSE 0 END AS BIGINT) AS async_percent_completion,
       CASE WHEN event_type = 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS error_code,
       CAST(NULL AS BIGINT) AS error_subcode,
       CASE event_id % 3 WHEN 1 THEN 'Title ' || json_extract_string(props, '$.k') END AS error_user_title,
       CAST(NULL AS VARCHAR) AS error_user_msg,
       event_type = 'click' AS is_success, event_type IN ('error', 'signup') AS is_failure,
       event_type IN ('click', 'error', 'signup') AS is_terminal,
       CASE WHEN event_id % 10 <> 0 THEN 'rr' || CAST(event_id AS VARCHAR) END AS report_run_id
FROM events"""


def error_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    b3 = F.concat(F.lit('{"error": {"message": "m'), k, F.lit('", "code": '), k, F.lit(', "x": 1}}'))
    b4 = F.concat(F.lit('{"error": {"type": "OAuthException", "code": 190, "error_subcode": 463, "fbtrace_id": "t'),
                  F.col("event_id").cast("string"),
                  F.lit('", "is_transient": true, "error_user_msg": null, "message": "bad"}}'))
    body = (F.when(F.col("event_id") % 5 == 0, F.lit("nope")).when(F.col("event_id") % 5 == 1, F.lit("{}"))
             .when(F.col("event_id") % 5 == 2, F.lit('{"error": "x"}')).when(F.col("event_id") % 5 == 3, b3)
             .otherwise(b4))
    return ev.select("event_id", body.alias("body"))


ERROR_BODIES_SQL = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'nope' WHEN 1 THEN '{}' WHEN 2 THEN '{"error": "x"}'
  WHEN 3 THEN '{"error": {"message": "m' || json_extract_string(props, '$.k') || '", "code": ' || json_extract_string(props, '$.k') || ', "x": 1}}'
  ELSE '{"error": {"type": "OAuthException", "code": 190, "error_subcode": 463, "fbtrace_id": "t' || CAST(event_id AS VARCHAR) ||
       '", "is_transient": true, "error_user_msg": null, "message": "bad"}}' END AS body
FROM events"""


# ---------------------------------------------------------------- responses
# API responses with rate-limit headers, from events: run = tenant + user
# bucket, seq = event id; headers absent, malformed, or JSON whose numbers
# are sometimes text, with lists holding junk elements.

def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    ki = k.cast("int")
    app = (F.when(F.col("event_type") == "signup", F.lit(None).cast("string"))
            .when(F.col("event_type") == "error", F.lit("{bad json"))
            .otherwise(F.concat(F.lit('{"call_count": '), k, F.lit(', "total_cputime": "'), dec2(F.col("value")),
                                F.lit('", "total_time": '), (F.floor("value") % 130).cast("string"), F.lit("}"))))
    tier = F.expr("CASE CAST(get_json_object(props, '$.k') AS INT) % 3 WHEN 0 THEN 'standard_access' "
                  "WHEN 1 THEN 'development_access' ELSE '' END")
    acc = F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit('{"acc_id_util_pct": '), dec2(F.col("value")), F.lit(', "reset_time_duration": '),
                 (ki * 10).cast("string"), F.lit(', "ads_api_access_tier": "'), tier, F.lit('"}')))
    eta = F.when(ki > 90, ki - 90).otherwise(F.lit(0))
    biz = F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(
        F.lit('{"biz'), (F.col("user_id") % 5).cast("string"),
        F.lit('": [{"type": "ads_management", "call_count": '), ki.cast("string"),
        F.lit(', "total_cputime": '), (F.floor("value") % 60).cast("string"),
        F.lit(', "total_time": "'), (ki % 50).cast("string"),
        F.lit('", "estimated_time_to_regain_access": '), eta.cast("string"),
        F.lit('}, 5, {"type": "ads_insights", "call_count": '), dec2(F.col("value")),
        F.lit('}], "biz9": "notalist"}')))
    run = F.concat(F.lpad((F.col("user_id") % N_TENANTS).cast("string"), 3, "0"), F.lit("-r"),
                   (F.col("user_id") % 3).cast("string"))
    return ev.select(run.alias("run_id"), F.col("event_id").alias("seq"), app.alias("app_usage"),
                     acc.alias("account_usage"), biz.alias("business_usage"))


RESPONSES_SQL = f"""
SELECT lpad(CAST(user_id % {N_TENANTS} AS VARCHAR), 3, '0') || '-r' || CAST(user_id % 3 AS VARCHAR) AS run_id,
       event_id AS seq,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'error' THEN '{{bad json'
            ELSE '{{"call_count": ' || json_extract_string(props, '$.k') || ', "total_cputime": "' || {dec2_sql('value')}
                 || '", "total_time": ' || CAST(CAST(floor(value) AS BIGINT) % 130 AS VARCHAR) || '}}' END AS app_usage,
       CASE WHEN event_id % 3 = 0 THEN NULL
            ELSE '{{"acc_id_util_pct": ' || {dec2_sql('value')} || ', "reset_time_duration": '
                 || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) * 10 AS VARCHAR)
                 || ', "ads_api_access_tier": "'
                 || CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 WHEN 0 THEN 'standard_access'
                         WHEN 1 THEN 'development_access' ELSE '' END || '"}}' END AS account_usage,
       CASE WHEN event_id % 4 = 0 THEN NULL
            ELSE '{{"biz' || CAST(user_id % 5 AS VARCHAR) || '": [{{"type": "ads_management", "call_count": '
                 || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR)
                 || ', "total_cputime": ' || CAST(CAST(floor(value) AS BIGINT) % 60 AS VARCHAR)
                 || ', "total_time": "' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 50 AS VARCHAR)
                 || '", "estimated_time_to_regain_access": '
                 || CAST(CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) > 90
                              THEN CAST(json_extract_string(props, '$.k') AS INTEGER) - 90 ELSE 0 END AS VARCHAR)
                 || '}}, 5, {{"type": "ads_insights", "call_count": ' || {dec2_sql('value')}
                 || '}}], "biz9": "notalist"}}' END AS business_usage
FROM events"""


# parent rows + action children as one CTE list (for queries that need both)
NESTED_CTE_SQL = f"parent AS ({NESTED_PARENT_SQL}), nested_actions AS ({ACTIONS_SQL})"


# ---------------------------------------------------------------- entities
# Raw loads of the four other parents, several per natural key; every column
# of the spec is text, made by rule from its name and the row.

ENTITY_BASE = {  # table, key, row number, day of the load
    "ads": ("lineitem", "l_partkey", "l_orderkey * 8 + l_linenumber", "l_shipdate"),
    "ad_sets": ("lineitem", "l_suppkey", "l_orderkey * 8 + l_linenumber", "l_shipdate"),
    "campaigns": ("orders", "o_custkey", "o_orderkey", "o_orderdate"),
    "ad_creatives": ("documents", "doc_id // 3", "doc_id", None),
    "ad_creatives_asset_feed": ("documents", "doc_id // 2", "doc_id", None),
}


def _entity_columns(entity: str, key: str, row: str, natural: str, engine: str) -> list[tuple[str, str]]:
    """(source column, SQL text of its raw value): the same in both engines but for types and JSON."""
    from adlake.specs import PARENT_SPECS

    text = "STRING" if engine == "spark" else "VARCHAR"
    out = []
    for i, c in enumerate(PARENT_SPECS[entity]):
        if c.alias == natural:
            e = f"CAST({key} AS {text})"
        elif c.cast == "INT64":
            e = f"CASE WHEN ({row}) % 5 = {i % 5} THEN 'n/a' ELSE CAST(({row}) % 90 + {i} AS {text}) END"
        elif c.cast == "FLOAT64":
            e = f"CASE WHEN ({row}) % 7 = {i % 7} THEN '' ELSE CAST(({row}) % 900 + {i} AS {text}) || '.25' END"
        elif c.cast in ("DATE", "TIMESTAMP"):
            e = f"CASE WHEN ({row}) % 11 = {i % 11} THEN 'soon' ELSE '2024-01-' || lpad(CAST(({row}) % 28 + 1 AS {text}), 2, '0') || ' 10:00:0' || CAST(({row}) % 10 AS {text}) END"
        elif c.cast == "JSON_STRING":
            e = f"CASE WHEN ({row}) % 3 = 0 THEN NULL ELSE '{{\"k\":' || CAST(({row}) % 50 AS {text}) || '}}' END"
        else:
            e = f"CASE WHEN ({row}) % 13 = {i % 13} THEN ' ' ELSE ' {c.source} ' || CAST(({row}) % {17 + i} AS {text}) END"
        out.append((c.source, e))
    return out


def _entity_parts(entity: str, engine: str) -> tuple[str, list[tuple[str, str]]]:
    from adlake.specs import PARENT_KEYS

    name, key, row, day = ENTITY_BASE[entity]
    natural = PARENT_KEYS[entity][0]
    text, div = ("STRING", "div") if engine == "spark" else ("VARCHAR", "//")
    key = key.replace("//", div)
    seconds = f"1700000000 + ({row}) % 90000" if day is None else (f"unix_seconds(CAST({day} AS TIMESTAMP))" if engine == "spark" else f"CAST(epoch({day}) AS BIGINT)")
    columns = [
        ("client", f"lpad(CAST(({key}) % {N_TENANTS} AS {text}), 3, '0')"),
        *_entity_columns(entity, key, row, natural, engine),
        ("_dlt_load_id", f"CAST({seconds} AS {text}) || '.' || lpad(CAST(({row}) % 1000 AS {text}), 6, '0')"),
        ("_dlt_id", f"'e' || lpad(CAST({row} AS {text}), 12, '0')"),
    ]
    return name, columns


def entity_raw(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    name, columns = _entity_parts(entity, "spark")
    return table(spark, sf_dir, name).select(*[F.expr(e).alias(c) for c, e in columns])


def entity_sql(entity: str) -> tuple[str, set[str]]:
    """(SQL of the raw rows, their columns)."""
    name, columns = _entity_parts(entity, "duckdb")
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns)} FROM {name}", {c for c, _ in columns}


# ---------------------------------------------------------------- asset feed
# Nested asset feed specs of creatives, from documents: every line of the text
# is a body; the other lists have 0-3 elements.

FEED_KINDS = ("bodies", "titles", "descriptions", "images", "videos", "link_urls", "call_to_action_types", "ad_formats")


def asset_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    none = "cast(array() as array<string>)"
    lists = {
        "bodies": r"split(text, '\n')",
        "titles": "array(concat(source, ' title'), lang)",
        "descriptions": f"if(lang = 'en', array(source), {none})",
        "images": "array(concat('img', cast(doc_id as string)))",
        "videos": f"if(lang = 'de', array(concat('v', cast(doc_id as string))), {none})",
        "link_urls": "array(concat('https://shop.example.com/', source))",
        "call_to_action_types": "slice(array('SHOP_NOW', 'LEARN_MORE'), 1, cast(doc_id % 3 as int))",
        "ad_formats": "if(doc_id % 2 = 0, array('SINGLE_IMAGE'), cast(null as array<string>))",
    }
    # Flags of the creative's enhancements, one struct for each feature.
    flags = F.struct(*[F.struct(F.expr(f"CASE (n_chars + {i}) % 3 WHEN 0 THEN 'OPT_IN' WHEN 1 THEN 'OPT_OUT' END").alias("enroll_status")).alias(n) for i, n in enumerate(FEATURES)])
    return d.select(F.col("doc_id").cast("string").alias("creative_id"), F.struct(*[F.expr(e).alias(k) for k, e in lists.items()]).alias("asset_feed_spec"), F.struct(flags.alias("creative_features_spec")).alias("degrees_of_freedom_spec"))


ASSET_FEED_SQL = """
lists AS (
  SELECT CAST(doc_id AS VARCHAR) AS creative_id, 'bodies' AS variant_kind, string_split(text, chr(10)) AS l FROM documents
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'titles', [source || ' title', lang] FROM documents
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'descriptions', [source] FROM documents WHERE lang = 'en'
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'images', ['img' || CAST(doc_id AS VARCHAR)] FROM documents
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'videos', ['v' || CAST(doc_id AS VARCHAR)] FROM documents WHERE lang = 'de'
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'link_urls', ['https://shop.example.com/' || source] FROM documents
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'call_to_action_types', ['SHOP_NOW', 'LEARN_MORE'][1:CAST(doc_id % 3 AS INTEGER)] FROM documents WHERE doc_id % 3 > 0
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'ad_formats', ['SINGLE_IMAGE'] FROM documents WHERE doc_id % 2 = 0)"""

#: Names of the enhancement flags that the nested proxy carries.
FEATURES = ("image_brightness_and_contrast", "image_touchups", "text_optimizations", "inline_comment",
            "product_extensions", "site_extensions", "standard_enhancements", "video_auto_crop")
