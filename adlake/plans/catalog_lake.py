"""Queries: Hive lake round trips, drift-safe reads, allow-lists, ODS writes."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions.casts import storage_type
from adlake.operators import frames as FR
from adlake.operators import normalize as N
from adlake.operators import unify as U
from adlake.plans import proxies as P
from adlake.plans import sqlgen as S
from adlake.plans.catalog_unify import INSIGHT_ALIASES, LOADED_AT, _CAST_CTE, _base_delta
from adlake.plans.jobs import unify_lake
from adlake.plans.registry import ORACLE, query
from adlake.session import scratch_dir
from adlake.sources import lake as L
from adlake.sources.snapshots import SnapshotTable
from adlake.specs import CHILD_SPECS, FIELD_LISTS, KNOWN_ENTITIES, PARENT_KEYS, PARENT_SPECS

CAMPAIGNS = PARENT_SPECS["campaigns"]


def _land_raw(spark, d, name="raw"):
    """Write the insights extracts to a fresh raw lake, one date partition
    per day; returns the lake root."""
    root = scratch_dir(spark, name)
    L.write_raw(P.extracts(spark, d), root, "ads_insights", date_col="date_start")
    return root


_UNIFY_SQL = f"""
WITH {_CAST_CTE}
SELECT tenant_skey, org_uid, client_uid,
       {S.source_id_sql(['ad_id', 'date_start'])} AS source_id,
       {S.change_hash_sql(S.source_id_sql(['ad_id', 'date_start']), 'extracted_at')} AS source_schema_hash,
       {S.payload_sql(INSIGHT_ALIASES)} AS payload
FROM latest
"""
_ODS_COLS = ["tenant_skey", "org_uid", "client_uid", "source_id", "source_schema_hash", "payload"]


@query("raw_write", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL})
SELECT 'ads_api' AS source, client, 'ads_insights' AS entity, date_start AS date, _dlt_id, ad_id, spend, _dlt_load_id FROM extracts
""")
def q_raw_write(spark, d):
    """Written below the level of their source, read back with all four keys."""
    root = scratch_dir(spark, "raw")
    L.write_raw(P.extracts(spark, d), root, "ads_insights", date_col="date_start", source="ads_api")
    return spark.read.option("basePath", root).parquet(L.source_root(root, "ads_api")).select(
        "source", "client", "entity", "date", "_dlt_id", "ad_id", "spend", "_dlt_load_id")


@query("raw_file_list", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL})
SELECT client, 'ads_insights' AS entity, string_agg(DISTINCT date_start, ',' ORDER BY date_start) AS days, true AS in_order FROM extracts GROUP BY client
""")
def q_raw_file_list(spark, d):
    """The sorted file list of each (client, entity), told by the days in its
    order; ``in_order``: places run from 1 without a gap, as paths ascend."""
    files = L.file_list(spark, _land_raw(spark, d), "ads_insights")
    by_day = files.groupBy("client", "entity", "date").agg(F.min("position").alias("first"), F.max("position").alias("last"), F.count(F.lit(1)).alias("n"))
    days = F.sort_array(F.collect_list(F.struct("first", "date", "last", "n")))
    per = by_day.groupBy("client", "entity").agg(days.alias("l"))
    gapless = F.forall(F.sequence(F.lit(0), F.size("l") - 1), lambda i: (F.get("l", i)["first"] == F.when(i == 0, 1).otherwise(F.get("l", i - 1)["last"] + 1)) &
                       (F.get("l", i)["last"] - F.get("l", i)["first"] + 1 == F.get("l", i)["n"]))
    return per.select("client", "entity", F.array_join(F.col("l.date"), ",").alias("days"), gapless.alias("in_order"))


# Drift within tenants: tenant 000 lands numbers until the 9th and text after,
# tenant 001 lands no objective before the 15th; the others land text.
_DRIFT_SQL = f"""SELECT * REPLACE (CASE WHEN client = '001' AND date_start < '2024-01-15' THEN NULL ELSE objective END AS objective)
FROM ({P.EXTRACTS_SQL})"""


@query("raw_hive_scan", sql=_UNIFY_SQL.replace(P.EXTRACTS_SQL, _DRIFT_SQL))
def q_raw_hive_scan(spark, d):
    """Drifted lake, read as frames of agreeing files, cast by the spec, unified."""
    root = scratch_dir(spark, "raw-drift")
    e = P.extracts(spark, d)
    numbers = (F.col("client") == "000") & (F.col("date_start") < "2024-01-10")
    early = (F.col("client") == "001") & (F.col("date_start") < "2024-01-15")
    typed = (e.where(numbers).withColumn("spend", F.col("spend").cast("double"))
              .withColumn("impressions", F.col("impressions").cast("bigint")))
    L.write_raw(typed, root, "ads_insights", date_col="date_start")
    L.write_raw(e.where(early).drop("objective"), root, "ads_insights", date_col="date_start")
    L.write_raw(e.where(~numbers & ~early), root, "ads_insights", date_col="date_start")
    frames = L.read_raw_groups(spark, root, "ads_insights")
    return U.unify_parent(frames, "ads_insights", LOADED_AT, roster=P.roster(spark, d)).select(*_ODS_COLS)


@query("hive_key_parse", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL})
SELECT client, 'ads_insights' AS entity, date_start AS date, CAST(count(*) AS BIGINT) AS n_rows
FROM extracts GROUP BY ALL
""")
def q_hive_key_parse(spark, d):
    root = _land_raw(spark, d)
    raw = spark.read.parquet(root)  # any layout: keys parsed from the file path
    k = L.path_keys(F.col("_metadata.file_path"))
    return (raw.select(k["client"].alias("client"), k["entity"].alias("entity"), k["date"].alias("date"))
               .groupBy("client", "entity", "date").agg(F.count(F.lit(1)).alias("n_rows")))


@query("entity_allowlist", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL}), campaigns AS ({P.entity_sql("campaigns")[0]})
SELECT 'ads_insights' AS entity, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(ad_name) AS BIGINT) AS n_ad_names, CAST(0 AS BIGINT) AS n_budgets FROM extracts
UNION ALL
SELECT 'campaigns', CAST(count(*) AS BIGINT), CAST(0 AS BIGINT), CAST(count(lifetime_budget) AS BIGINT) FROM campaigns
""")
def q_entity_allowlist(spark, d):
    """Two known entities with columns of their own; a load-state table and an
    unknown entity land next to them."""
    root = _land_raw(spark, d)
    L.write_raw(P.entity_raw(spark, d, "campaigns").withColumn("date", F.lit("2024-02-01")), root, "campaigns")
    state = P.extracts(spark, d).select("client", "date_start", F.col("_dlt_load_id").alias("state"))
    L.write_raw(state, root, "_dlt_pipeline_state", date_col="date_start")
    L.write_raw(state, root, "unknown_feed", date_col="date_start")
    raw = L.read_raw(spark, root, None, KNOWN_ENTITIES)
    return raw.groupBy("entity").agg(F.count(F.lit(1)).alias("n_rows"), F.count("ad_name").alias("n_ad_names"), F.count("lifetime_budget").alias("n_budgets"))


@query("raw_inventory", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL}),
one AS (SELECT client, 'ads_insights' AS entity, CAST(count(DISTINCT date_start) AS BIGINT) AS n_dates, min(date_start) AS first_date,
               max(date_start) AS last_date, CAST(count(*) AS BIGINT) AS n_rows
        FROM extracts GROUP BY client)
SELECT *, CAST(sum(n_dates) OVER () AS BIGINT) AS n_partitions, CAST(count(DISTINCT client) OVER () AS BIGINT) AS n_clients,
       CAST(count(DISTINCT entity) OVER () AS BIGINT) AS n_entities
FROM one
""")
def q_raw_inventory(spark, d):
    """The files of each (client, entity): their days and rows, and the three
    discovery totals (partitions, clients, entities) beside."""
    root = _land_raw(spark, d)
    raw = L.read_raw(spark, root, "ads_insights").select("*", F.col("_metadata.file_path").alias("_path"))
    files = raw.groupBy("_path").agg(F.count(F.lit(1)).alias("rows")).withColumn("keys", L.path_keys(F.col("_path")))
    files = files.select("_path", "rows", *[F.col("keys")[k].alias(k) for k in ("client", "entity", "date")])
    per = files.groupBy("client", "entity").agg(
        F.count_distinct("date").alias("n_dates"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum("rows").alias("n_rows"))
    return per.select("*", per.agg(F.sum("n_dates")).scalar().alias("n_partitions"),
                      per.agg(F.count_distinct("client")).scalar().alias("n_clients"),
                      per.agg(F.count_distinct("entity")).scalar().alias("n_entities"))


def _write_ods(spark, d):
    root = scratch_dir(spark, "ods")
    o = U.unify_parent(P.extracts(spark, d), "ads_insights", LOADED_AT, roster=P.roster(spark, d))
    L.write_ods(o, root, "ads_insights")
    return root


@query("ods_write", sql=_UNIFY_SQL)
def q_ods_write(spark, d):
    root = _write_ods(spark, d)
    return L.read_ods(spark, root, "ads_insights").select(*_ODS_COLS)


@query("ods_scan", sql=f"""
WITH {_CAST_CTE}
SELECT client_uid, CAST(count(*) AS BIGINT) AS n_rows, count(DISTINCT ad_id) AS n_ads FROM latest GROUP BY ALL
""")
def q_ods_scan(spark, d):
    root = _write_ods(spark, d)
    ods = L.read_ods(spark, root, "ads_insights")
    return ods.groupBy("client_uid").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(U.payload_field(F.col("payload"), "ad_id")).alias("n_ads"))


@query("write_replace", sql=f"""
WITH extracts AS ({P.EXTRACTS_SQL})
SELECT date_start AS date, CASE WHEN date_start >= '2024-01-25' THEN 'v2' ELSE 'v1' END AS version,
       CAST(count(*) AS BIGINT) AS n_rows
FROM extracts GROUP BY ALL
""")
def q_write_replace(spark, d):
    """Full replace, then a dynamic overwrite of the last days only."""
    root = scratch_dir(spark, "replace")
    e = P.extracts(spark, d).select("_dlt_id", F.col("date_start").alias("date"))
    L.write_partitioned(e.withColumn("version", F.lit("v0")), root, ["date"], mode="overwrite")
    L.write_partitioned(e.withColumn("version", F.lit("v1")), root, ["date"], mode="overwrite")
    L.write_replace_window(e.where(F.col("date") >= "2024-01-25").withColumn("version", F.lit("v2")),
                           root, ["date"])
    return spark.read.parquet(root).groupBy("date", "version").agg(F.count(F.lit(1)).alias("n_rows"))


@query("merge_snapshot", sql=ORACLE["merge_upsert"])
def q_merge_snapshot(spark, d):
    """The merge of ``merge_upsert`` on a stored table: the delta rewrites the
    files of its days that may hold its keys, all others stay as they are."""
    root = scratch_dir(spark, "merge")
    keys = ["tenant_skey", "ad_id", "date_start"]
    order = [F.col("extracted_at").desc_nulls_last(), F.col("_tie").desc()]
    table = SnapshotTable(spark, f"{root}/table", keys, [F.date_format("date_start", "yyyy-MM-dd")])
    for n, side in zip(("base", "delta"), _base_delta(spark, d), strict=True):
        side.write.parquet(f"{root}/{n}")
        table.merge(spark.read.parquet(f"{root}/{n}"), lambda base, delta: FR.upsert(delta.limit(0) if base is None else base, delta, keys, order))
    return table.read().select(*keys, "extracted_at", F.col("_tie").alias("_dlt_id"))


@query("sink_roundtrip", sql="""
SELECT CAST(c_custkey AS BIGINT) AS id, c_name AS msg FROM customer
""")
def q_sink_roundtrip(spark, d):
    root = scratch_dir(spark, "ping")
    rows = P.table(spark, d, "customer").select(F.col("c_custkey").cast("bigint").alias("id"), F.col("c_name").alias("msg"))
    rows.write.mode("overwrite").parquet(root)
    return spark.read.parquet(root)


# ------------------------------------------------------------------ drift / allow-lists

def _campaign_sql(src_sql, present, text_cols):
    cols = []
    for s in CAMPAIGNS:
        if s.source in present:
            cols.append(f"{S.cast_sql(s.source, s.cast, src_is_text=s.source in text_cols)} AS {s.alias}")
        else:
            cols.append(f"CAST(NULL AS {S.SQL_TYPES[s.cast]}) AS {s.alias}")
    return f"SELECT client, {', '.join(cols)} FROM ({src_sql})"


_SUPP_PRESENT = {"id", "account_id", "name", "daily_budget"}
_CUST_PRESENT = _SUPP_PRESENT | {"status"}


@query("safe_select", sql=_campaign_sql(P.DRIFTED_SUPPLIER_SQL, _SUPP_PRESENT, {"daily_budget", "name"}))
def q_safe_select(spark, d):
    return U.apply_spec(P.drifted_supplier(spark, d), CAMPAIGNS, keep=["client"])


@query("tenant_union", sql=_campaign_sql(P.DRIFTED_SUPPLIER_SQL, _SUPP_PRESENT, {"daily_budget", "name"})
       + " UNION ALL " + _campaign_sql(P.DRIFTED_CUSTOMER_SQL, _CUST_PRESENT, {"name", "status"}))
def q_tenant_union(spark, d):
    frames = [P.drifted_supplier(spark, d), P.drifted_customer(spark, d)]
    return U.cast_tenant_frames(frames, CAMPAIGNS, False, tie_col=None).drop("_tie")


@query("field_allowlist", sql=f"""
SELECT id, account_id, name, status, daily_budget FROM ({P.DRIFTED_CUSTOMER_SQL})
""")
def q_field_allowlist(spark, d):
    return FR.field_allowlist(P.drifted_customer(spark, d), FIELD_LISTS["campaigns"])


def _listed(entity: str) -> list[str]:
    """The allow-listed fields that the raw rows of an entity have."""
    there = P.entity_sql(entity)[1] if entity in P.ENTITY_BASE else P.EXTRACTS_COLUMNS
    return [f for f in FIELD_LISTS[entity] if f in there]


@query("field_allowlists", sql=f"WITH extracts AS ({P.EXTRACTS_SQL})\n" + "\nUNION ALL ".join(
    f"SELECT '{e}' AS entity, '{','.join(_listed(e))}' AS fields, CAST(count(*) AS BIGINT) AS n_rows, "
    f"{S.row_digest_sql([('_dlt_id', 'STRING'), *((f, 'STRING') for f in _listed(e))])} AS digest "
    f"FROM ({P.entity_sql(e)[0] if e in P.ENTITY_BASE else 'SELECT * FROM extracts'})" for e in FIELD_LISTS))
def q_field_allowlists(spark, d):
    """All six entities through their allow-lists: the fields kept, in list
    order, and a digest of their values."""
    out = None
    for e, fields in FIELD_LISTS.items():
        raw = P.entity_raw(spark, d, e) if e in P.ENTITY_BASE else P.extracts(spark, d)
        kept = FR.field_allowlist(raw, ["_dlt_id", *fields])
        digest = S.row_digest([(F.col(c), "STRING") for c in kept.columns])
        one = kept.agg(F.count(F.lit(1)).alias("n_rows"), digest.alias("digest")).select(
            F.lit(e).alias("entity"), F.lit(",".join(kept.columns[1:])).alias("fields"), "n_rows", "digest")
        out = one if out is None else out.unionByName(one)
    return out


@query("normalize_names", sql="""
SELECT l_orderkey AS l_orderkey, l_linenumber AS line_no, l_quantity AS _1d_view, l_discount AS _7d_click,
       l_returnflag AS action_type, l_linestatus AS action_destination
FROM lineitem
""")
def q_normalize_names(spark, d):
    li = P.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("L_OrderKey"), F.col("l_linenumber").alias("Line No"),
        F.col("l_quantity").alias("1d_view"), F.col("l_discount").alias("7d_click"),
        F.col("l_returnflag").alias("Action Type"), F.col("l_linestatus").alias("action-destination"))
    return FR.normalize_names(li)


@query("row_counts", sql=f"""
WITH {_CAST_CTE}
SELECT 'raw_ads_insights' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM extracts
UNION ALL SELECT 'ods_ads_insights', CAST(count(*) AS BIGINT) FROM latest
UNION ALL SELECT 'roster', CAST(count(*) AS BIGINT) FROM roster
""")
def q_row_counts(spark, d):
    return FR.row_counts({
        "raw_ads_insights": P.extracts(spark, d),
        "ods_ads_insights": U.unify_parent(P.extracts(spark, d), "ads_insights", LOADED_AT,
                                           roster=P.roster(spark, d)),
        "roster": P.roster(spark, d),
    })


@query("views", sql=f"""
WITH {_CAST_CTE}
SELECT client_uid, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT ad_id) AS BIGINT) AS n_ads
FROM latest GROUP BY client_uid
""")
def q_views(spark, d):
    o = U.unify_parent(P.extracts(spark, d), "ads_insights", LOADED_AT, roster=P.roster(spark, d))
    o.createOrReplaceTempView("ods_ads_insights")
    return spark.sql("""
        SELECT client_uid, count(*) AS n_rows,
               count(DISTINCT get_json_object(payload, '$.ad_id')) AS n_ads
        FROM ods_ads_insights GROUP BY client_uid""")


# ------------------------------------------------------------------ the whole lake

_NESTED_COLS = {"_dlt_id", "ad_id", "date_start", "spend", "clicks"}
_CHILD_COLS = {"_dlt_id", "_dlt_parent_id", "_dlt_list_idx", "action_type", "action_target_id", "action_destination", "value", "_1d_view", "_1d_click",
               "_7d_view", "_7d_click"}
_VIDEO_COLS = {"_dlt_id", "_dlt_parent_id", "_dlt_list_idx", "action_type", "value"}


def _child_rows_sql(child: str) -> str:
    name = child.split("__", 1)[1]
    return {"actions": P.ACTIONS_SQL, "action_values": P.ACTION_VALUES_SQL, "video_p25_watched_actions": P.VIDEO_SQL}.get(name) or P.one_element_sql(name)


def _lake_sql() -> str:
    """Every entity's tenants, rows, orphans and digest, from the raw rows."""
    orgs = f"coalesce(o.org, '{U.DEFAULT_ORG}')"
    ctes = [f"parent AS ({P.NESTED_PARENT_SQL})", f"extracts AS ({P.EXTRACTS_SQL})", f"roster AS ({P.ROSTER_SQL})",
            "org_map AS (SELECT client_slug, min(org_slug) AS org FROM roster GROUP BY client_slug)"]
    tables = []
    for i, (entity, spec) in enumerate(PARENT_SPECS.items()):
        keys = PARENT_KEYS[entity]
        sources = [(f"(SELECT * FROM ({P.entity_sql(entity)[0]}))", P.entity_sql(entity)[1])] if entity in P.ENTITY_BASE else [("extracts", P.EXTRACTS_COLUMNS), ("parent", _NESTED_COLS)]
        ctes.append(f"raw{i} AS (" + " UNION ALL ".join(
            f"SELECT client, _dlt_load_id, _dlt_id AS tie, {S.spec_select(spec, set(present), 'e')} FROM {src} e" for src, present in sources) + ")")
        ctes.append(f"""ods{i} AS (
  SELECT *, {S.extracted_at_sql('_dlt_load_id')} AS _ext, {orgs} || '__' || client AS tenant_skey FROM raw{i} LEFT JOIN org_map o ON client = o.client_slug
  QUALIFY row_number() OVER (PARTITION BY {orgs}, client, {", ".join(keys)} ORDER BY _ext DESC NULLS LAST, tie DESC) = 1)""")
        sid = S.source_id_sql(keys)
        digest = S.row_digest_sql([("tenant_skey", "STRING"), (sid, "STRING"), (S.change_hash_sql(sid, "_ext"), "STRING"), *((c.alias, c.cast) for c in spec)])
        tables.append(f"SELECT '{entity}' AS entity, 'parent' AS kind, CAST(count(DISTINCT client) AS BIGINT) AS n_tenants, CAST(count(*) AS BIGINT) AS n_rows, "
                      f"CAST(NULL AS BIGINT) AS n_orphans, {digest} AS digest FROM ods{i}")
        if entity == "ads_insights":
            ctes.append(f"surviving AS (SELECT DISTINCT parent_dlt_id AS id FROM ods{i})")
    for i, (child, spec) in enumerate(CHILD_SPECS.items()):
        present = _VIDEO_COLS if "video" in child else _CHILD_COLS
        ctes.append(f"child{i} AS (SELECT c.*, {orgs} || '__' || c.client AS tenant_skey, s.id IS NULL AS is_orphan FROM "
                    f"(SELECT client, {S.spec_select(spec, present, 'a')} FROM ({_child_rows_sql(child)}) a) c "
                    f"LEFT JOIN org_map o ON c.client = o.client_slug LEFT JOIN surviving s ON c.parent_dlt_id = s.id)")
        digest = S.row_digest_sql([("tenant_skey", "STRING"), *((c.alias, c.cast) for c in spec)])
        tables.append(f"SELECT '{child}', 'child', CAST(count(DISTINCT client) AS BIGINT), CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE is_orphan) AS BIGINT), {digest} FROM child{i}")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(tables)


def _ods_digest(spark, root, entity):
    """Digest of an ODS table's rows; a parent's payload is read back field by field."""
    rows = L.read_ods(spark, root, entity)
    if entity in CHILD_SPECS:
        return rows.agg(S.row_digest([(F.col("tenant_skey"), "STRING"), *((F.col(c.alias), c.cast) for c in CHILD_SPECS[entity])]).alias("digest"))
    spec = PARENT_SPECS[entity]
    rows = rows.withColumn("body", F.from_json("payload", T.StructType([T.StructField(c.alias, storage_type(c.cast)) for c in spec])))
    return rows.agg(S.row_digest([*((F.col(c), "STRING") for c in ("tenant_skey", "source_id", "source_schema_hash")), *((F.col("body")[c.alias], c.cast) for c in spec)]).alias("digest"))


@query("unify_lake", sql=_lake_sql())
def q_unify_lake(spark, d):
    """All twelve entities landed as a raw lake (insights from two feeds, their
    children by one read of the nested rows), then unified into a fresh ODS
    root, parents before children; each table's digest beside its metrics."""
    root = scratch_dir(spark, "lake")
    raw, ods, day = f"{root}/raw", f"{root}/ods", F.lit("2024-02-01")
    L.write_raw(P.extracts(spark, d), raw, "ads_insights", date_col="date_start")
    tables = N.normalize_to(P.nested(spark, d), f"{root}/nested", "ads_insights", 2, carry=("client",))
    L.write_raw(tables["ads_insights"], raw, "ads_insights", date_col="date_start")
    for child in CHILD_SPECS:
        L.write_raw(tables[child].withColumn("date", day), raw, child, few=True)
    for entity in P.ENTITY_BASE:
        L.write_raw(P.entity_raw(spark, d, entity).withColumn("date", day), raw, entity, few=True)
    L.drop(spark, f"{root}/nested")  # landed: the lake holds these rows now
    metrics = unify_lake(spark, raw, ods, LOADED_AT, roster=P.roster(spark, d))
    digests = None
    for entity in KNOWN_ENTITIES:
        one = _ods_digest(spark, ods, entity).select(F.lit(entity).alias("entity"), "digest")
        digests = one if digests is None else digests.unionByName(one)
    return metrics.join(digests, "entity")
