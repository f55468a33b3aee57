"""Queries: asset specs, keys, skip-existing, manifest and its reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adlake.operators import assets as A
from adlake.operators import unify as U
from adlake.plans import proxies as P
from adlake.plans.registry import query
from adlake.session import scratch_dir
from adlake.sources import lake as L

_C = f"c AS ({P.CREATIVES_SQL})"
_SPECS_SQL = """
specs AS (
  SELECT source_id AS creative_id, client_uid, org_uid, 'image' AS asset_kind, url AS source_url,
         CAST(NULL AS VARCHAR) AS video_id, content_type, doc_id
  FROM c WHERE doc_id % 50 <> 0 AND url IS NOT NULL AND url <> ''
  UNION ALL
  SELECT source_id, client_uid, org_uid, 'thumbnail', url || '?thumb=1', NULL, content_type, doc_id
  FROM c WHERE doc_id % 50 <> 0 AND doc_id % 3 <> 0 AND url IS NOT NULL
  UNION ALL
  SELECT source_id, client_uid, org_uid, 'video', '', 'v' || CAST(doc_id AS VARCHAR), content_type, doc_id
  FROM c WHERE doc_id % 50 <> 0 AND lang = 'de')"""
_RESOLVED_SQL = f"""
vs AS ({P.VIDEO_SOURCES_SQL}),
resolved AS (
  SELECT * FROM specs WHERE asset_kind <> 'video'
  UNION ALL
  SELECT s.creative_id, s.client_uid, s.org_uid, s.asset_kind, vs.source, s.video_id, s.content_type, s.doc_id
  FROM specs s JOIN vs ON s.video_id = vs.video_id WHERE s.asset_kind = 'video')"""


def _ext_sql(ct: str | None) -> str:
    path = "regexp_extract(source_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
    last = f"regexp_extract({path}, '[^/]*$', 0)"
    by_url = f"CASE WHEN contains({last}, '.') THEN '.' || regexp_extract({last}, '\\.([^.]*)$', 1) END"
    if ct is None:
        return f"coalesce({by_url}, '.bin')"
    by_type = (f"CASE lower(trim(split_part({ct}, ';', 1))) WHEN 'image/jpeg' THEN '.jpg' "
               f"WHEN 'image/png' THEN '.png' WHEN 'video/mp4' THEN '.mp4' END")
    return f"coalesce({by_type}, {by_url}, '.bin')"


def _key_sql(ct: str | None) -> str:
    stem = "CASE WHEN asset_kind = 'video' AND video_id IS NOT NULL AND video_id <> '' THEN video_id ELSE creative_id END"
    return f"'assets/client=' || client_uid || '/asset_kind=' || asset_kind || '/' || {stem} || {_ext_sql(ct)}"


def _specs(spark, d):
    return A.asset_specs(P.creatives(spark, d), carry=("content_type",))


def _resolved(spark, d):
    return A.resolve_videos(_specs(spark, d), P.video_sources(spark, d))


@query("asset_specs", sql=f"""
WITH {_C}, {_SPECS_SQL}
SELECT creative_id, client_uid, org_uid, asset_kind, source_url, video_id FROM specs
""")
def q_asset_specs(spark, d):
    return A.asset_specs(P.creatives(spark, d))


@query("specs_by_kind", sql=f"""
WITH {_C}, {_SPECS_SQL},
kinds AS (SELECT * FROM (VALUES ('image'), ('thumbnail'), ('video')) t(asset_kind))
SELECT k.asset_kind, CAST(count(s.asset_kind) AS BIGINT) AS n_specs
FROM kinds k LEFT JOIN specs s ON k.asset_kind = s.asset_kind GROUP BY k.asset_kind
""")
def q_specs_by_kind(spark, d):
    return A.specs_by_kind(A.asset_specs(P.creatives(spark, d)))


@query("video_resolution", sql=f"""
WITH {_C}, {_SPECS_SQL}, {_RESOLVED_SQL}
SELECT creative_id, asset_kind, video_id, source_url FROM resolved
""")
def q_video_resolution(spark, d):
    return _resolved(spark, d).select("creative_id", "asset_kind", "video_id", "source_url")


@query("object_key", sql=f"""
WITH {_C}, {_SPECS_SQL}, {_RESOLVED_SQL}
SELECT creative_id, asset_kind, {_key_sql(None)} AS tentative_key, {_key_sql('content_type')} AS object_key,
       trim(split_part(content_type, ';', 1)) AS clean_type
FROM resolved
""")
def q_object_key(spark, d):
    k = A.with_keys(_resolved(spark, d))
    return k.select("creative_id", "asset_kind", "tentative_key", "object_key",
                    A.clean_content_type(F.col("content_type")).alias("clean_type"))


_FETCH_TS = dt.datetime(2024, 3, 5, 12, 0, 0)


@query("skip_existing", sql=f"""
WITH {_C}, {_SPECS_SQL}, {_RESOLVED_SQL},
keyed AS (SELECT *, {_key_sql(None)} AS tentative_key, {_key_sql('content_type')} AS object_key FROM resolved),
listing AS (SELECT k.tentative_key AS lkey, d.n_chars % 5 AS size FROM keyed k JOIN documents d ON k.doc_id = d.doc_id
            WHERE k.asset_kind = 'image' AND k.doc_id % 3 = 0)
SELECT k.creative_id, k.asset_kind,
       CASE WHEN l.size > 0 THEN l.lkey ELSE k.object_key END AS object_key,
       coalesce(l.size > 0, false) AS skipped_existing,
       CAST(CASE WHEN l.size > 0 THEN l.size ELSE octet_length(encode(d.text)) END AS BIGINT) AS byte_size,
       CASE WHEN l.size > 0 THEN '' ELSE sha256(d.text) END AS sha256
FROM keyed k LEFT JOIN listing l ON k.tentative_key = l.lkey AND l.size > 0
JOIN documents d ON k.doc_id = d.doc_id
""")
def q_skip_existing(spark, d):
    keyed = A.with_keys(_resolved(spark, d))
    docs = P.table(spark, d, "documents")
    # Objects already in storage: the image of every third document (size
    # from the text length, some empty), keyed like a previous run keyed them.
    pages = P.table(spark, d, "pages").select("page_id", "url")
    stored = docs.where(F.col("doc_id") % 3 == 0).join(pages, docs["doc_id"] == pages["page_id"])
    listing = stored.select(
        A.object_key(F.col("source"), F.lit("image"), F.col("doc_id").cast("string"), F.lit(None).cast("string"),
                     F.col("url"), None).alias("object_key"),
        (F.col("n_chars") % 5).alias("size"), F.lit("image/jpeg").alias("content_type"),
        F.lit(_FETCH_TS).alias("updated"))
    fetched = docs.select(F.col("doc_id").cast("string").alias("creative_id"), F.col("text").alias("content"))
    rows = A.fetch_or_skip(keyed, listing, fetched, ["creative_id"], F.lit(_FETCH_TS))
    return rows.select("creative_id", "asset_kind", "object_key", "skipped_existing", "byte_size", "sha256")


@query("asset_digest", sql="""
SELECT doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS byte_size, sha256(text) AS sha256 FROM documents
""")
def q_asset_digest(spark, d):
    size, sha = A.digest(F.col("text"))
    return P.table(spark, d, "documents").select("doc_id", size.alias("byte_size"), sha.alias("sha256"))


# Every page an object of its own under its id, as a line of text.
def _store_pages(spark, d):
    root = scratch_dir(spark, "objects")
    objects = P.table(spark, d, "pages").select("page_id", F.coalesce("html", F.lit("")).alias("value"))
    A.store_objects(objects, root, "page_id")
    return root


def _page_id():
    return F.regexp_extract("path", "page_id=([0-9]+)[./]", 1).cast("bigint").alias("page_id")


@query("binary_scan", sql="""
SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) + 1 AS BIGINT) AS byte_size, sha256(coalesce(html, '') || chr(10)) AS sha256 FROM pages
""")
def q_binary_scan(spark, d):
    """Stored objects read as bytes: size and digest of each."""
    return A.scan_assets(spark, _store_pages(spark, d), "*.txt").select(_page_id(), "byte_size", "sha256")


@query("binary_sizes", sql="""
SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) + 1 AS BIGINT) AS byte_size FROM pages
""")
def q_binary_sizes(spark, d):
    """Stored objects listed with their sizes, none opened."""
    return A.list_assets(spark, _store_pages(spark, d), "*.txt").select(_page_id(), "byte_size")


_M = f"m AS ({P.MANIFEST_SQL})"


def _manifest(spark, d):
    return P.manifest(spark, d)


@query("manifest_write", sql=f"""
WITH {_M}
SELECT CASE WHEN CAST(creative_id AS BIGINT) % 2 = 0 THEN '2024-03-06' ELSE '2024-03-07' END AS date,
       CASE WHEN CAST(creative_id AS BIGINT) % 2 = 0 THEN '20240306T101500Z' ELSE '20240307T231000Z' END AS run_ts,
       CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(byte_size) AS BIGINT) AS total_bytes
FROM m GROUP BY ALL
""")
def q_manifest_write(spark, d):
    root = scratch_dir(spark, "manifest")
    m = _manifest(spark, d).drop("date", "run_ts")
    even = F.col("creative_id").cast("bigint") % 2 == 0
    A.write_manifest(m.where(even), root, dt.datetime(2024, 3, 6, 10, 15, 0))
    A.write_manifest(m.where(~even), root, dt.datetime(2024, 3, 7, 23, 10, 0))
    return (A.read_manifest(spark, root).groupBy("date", "run_ts")
             .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("byte_size").alias("total_bytes")))


def _written_manifest(spark, d):
    root = scratch_dir(spark, "manifest")
    L.write_partitioned(_manifest(spark, d), root, ["date"])
    return A.read_manifest(spark, root)


@query("manifest_scan", sql=f"WITH {_M} SELECT * FROM m")
def q_manifest_scan(spark, d):
    return _written_manifest(spark, d)


@query("describe", sql=f"""
WITH {_M}
SELECT column_name AS col_name,
       CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'BOOLEAN' THEN 'boolean'
                        WHEN 'TIMESTAMP' THEN 'timestamp' ELSE lower(column_type) END AS data_type
FROM (DESCRIBE SELECT * EXCLUDE (date), date FROM m)
""")
def q_describe(spark, d):
    # The schema is that of the lake's table; no rows are written or read for it.
    m = _manifest(spark, d)
    m.select(*[c for c in m.columns if c != "date"], "date").createOrReplaceTempView("manifest")
    return spark.sql("DESCRIBE manifest").select("col_name", "data_type")


@query("manifest_summary", sql=f"""
WITH {_M}
SELECT CAST(count(*) AS BIGINT) AS n_asset_rows, CAST(count(DISTINCT creative_id) AS BIGINT) AS n_creatives,
       CAST(count(DISTINCT client_uid) AS BIGINT) AS n_clients,
       round(sum(byte_size) / 1024.0 / 1024.0, 1) AS total_mb,
       min(downloaded_at) AS first_download, max(downloaded_at) AS last_download
FROM m
""")
def q_manifest_summary(spark, d):
    return A.manifest_summary(_manifest(spark, d))


@query("manifest_by_client_kind", sql=f"""
WITH {_M}
SELECT client_uid, asset_kind, CAST(count(*) AS BIGINT) AS n_assets,
       round(sum(byte_size) / 1024.0 / 1024.0, 2) AS mb, round(avg(byte_size) / 1024.0, 1) AS avg_kb
FROM m GROUP BY 1, 2 ORDER BY 1, 2
""")
def q_manifest_by_client_kind(spark, d):
    return A.manifest_by_client_kind(_manifest(spark, d))


@query("manifest_top10", sql=f"""
WITH {_M}
SELECT client_uid, asset_kind, creative_id, content_type, byte_size, sha256, downloaded_at, gcs_uri
FROM m ORDER BY byte_size DESC NULLS LAST, client_uid, creative_id, asset_kind, gcs_uri LIMIT 10
""")
def q_manifest_top10(spark, d):
    return A.manifest_top(_manifest(spark, d), 10)


@query("creative_assets", sql=f"""
WITH {_C}, {_M},
parsed_creatives AS (
  SELECT client_uid, source_id AS creative_id,
         CASE WHEN payload <> '' THEN payload->>'creative_name' END AS creative_name,
         CASE WHEN payload <> '' THEN payload->>'media_type' END AS media_type,
         CASE WHEN payload <> '' THEN payload->>'cta_type' END AS cta_type
  FROM c)
SELECT c.client_uid, c.creative_id, substring(c.creative_name, 1, 60) AS creative_name, c.media_type, c.cta_type,
       CAST(count(m.asset_kind) AS BIGINT) AS n_assets,
       string_agg(m.asset_kind, ', ' ORDER BY m.asset_kind) AS kinds_present,
       CAST(sum(m.byte_size) AS BIGINT) AS total_bytes
FROM parsed_creatives c LEFT JOIN m ON m.client_uid = c.client_uid AND m.creative_id = c.creative_id
GROUP BY 1, 2, 3, 4, 5
ORDER BY n_assets DESC, total_bytes DESC NULLS LAST, c.client_uid, c.creative_id LIMIT 15
""")
def q_creative_assets(spark, d):
    return A.creative_assets(P.creatives(spark, d), _manifest(spark, d), 15)


@query("manifest_latest", sql=f"""
WITH {_M}
SELECT * FROM m WHERE (date, run_ts) = (SELECT max((date, run_ts)) FROM m)
""")
def q_manifest_latest(spark, d):
    return A.manifest_latest(_manifest(spark, d))


@query("pointer_upsert", sql=f"""
WITH {_M},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY client_uid, creative_id, asset_kind
                               ORDER BY date DESC, run_ts DESC, gcs_uri DESC) AS rn,
         last_value(nullif(sha256, '') IGNORE NULLS) OVER (
             PARTITION BY client_uid, creative_id, asset_kind ORDER BY date, run_ts, gcs_uri
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_sha
  FROM m)
SELECT client_uid, creative_id, asset_kind, org_uid, gcs_uri, original_url, content_type, byte_size,
       video_id, downloaded_at, skipped_existing, date, run_ts, coalesce(last_sha, '') AS sha256
FROM ranked WHERE rn = 1
""")
def q_pointer_upsert(spark, d):
    return A.pointer_state(_manifest(spark, d))


@query("asset_run_metrics", sql=f"""
WITH {_M}
SELECT date, run_ts, CAST(count(*) AS BIGINT) AS n_manifested,
       CAST(count(*) FILTER (WHERE NOT skipped_existing) AS BIGINT) AS n_new,
       CAST(count(*) FILTER (WHERE skipped_existing) AS BIGINT) AS n_skipped,
       round(sum(byte_size) / 1024.0 / 1024.0, 1) AS total_mb
FROM m GROUP BY ALL
""")
def q_asset_run_metrics(spark, d):
    m = _manifest(spark, d)
    return m.groupBy("date", "run_ts").agg(
        F.count(F.lit(1)).alias("n_manifested"),
        F.count_if(~F.col("skipped_existing")).alias("n_new"),
        F.count_if(F.col("skipped_existing")).alias("n_skipped"),
        F.round(F.sum("byte_size") / F.lit(A.MB), 1).alias("total_mb"))


@query("narrative_coalesce", sql=f"""
WITH n AS ({P.NARRATIVES_SQL})
SELECT creative_id, version, headline, body, description, destination_url FROM n
""")
def q_narrative_coalesce(spark, d):
    n = P.narratives(spark, d)
    return n.select("creative_id", "version", *A.narrative(F.col("link_data"), F.col("template_data"),
                                                           F.col("video_data")))


@query("dim_creative", sql=f"""
WITH n AS ({P.NARRATIVES_SQL})
SELECT sha256(creative_id) AS creative_skey, creative_id, version, headline, body, description, destination_url
FROM n QUALIFY row_number() OVER (PARTITION BY creative_id ORDER BY version DESC) = 1
""")
def q_dim_creative(spark, d):
    n = P.narratives(spark, d)
    latest = U.dedupe_latest(n, ["creative_id"], [F.col("version").desc()])
    return latest.select(F.sha2("creative_id", 256).alias("creative_skey"), "creative_id", "version",
                         *A.narrative(F.col("link_data"), F.col("template_data"), F.col("video_data")))
