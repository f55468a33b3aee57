"""Queries: report pages, multi-id payloads, job status, errors, redaction."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions import jsonvals as J
from adlake.operators import pages as PG
from adlake.plans import proxies as P
from adlake.plans.registry import query
from adlake.specs import ERROR_KEYS

_ROW = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType())])


@query("explode_pages", sql=P.PAGE_ROWS_SQL)
def q_explode_pages(spark, d):
    return PG.explode_pages(P.page_bodies(spark, d), "body", _ROW, carry=("page_key",))


@query("explode_multi_id", sql=P.MULTI_ID_KEPT_SQL)
def q_explode_multi_id(spark, d):
    kept, _ = PG.explode_multi_id(P.multi_id_bodies(spark, d), "body")
    return kept.select("object_key", J.jstr(F.col("item"), "$.id").alias("id"),
                       J.jstr(F.col("item"), "$.role").alias("role"))


@query("multi_id_drops", sql="""
SELECT reason, CAST(sum(n) AS BIGINT) AS n_dropped FROM (
  SELECT 'error' AS reason, count(*) FILTER (WHERE turn % 2 = 0) AS n FROM conversations
  UNION ALL SELECT 'not_object', count(*) FILTER (WHERE turn % 3 = 0) + count(*) FROM conversations)
GROUP BY reason
""")
def q_multi_id_drops(spark, d):
    _, dropped = PG.explode_multi_id(P.multi_id_bodies(spark, d), "body")
    return dropped.groupBy("reason").agg(F.count(F.lit(1)).alias("n_dropped"))


@query("job_status", sql=P.STATUS_SQL)
def q_job_status(spark, d):
    b = P.status_bodies(spark, d)
    return b.select("event_id", *PG.job_status(F.col("body")), PG.report_run_id(F.col("body")).alias("report_run_id"))


def _render_sql(path: str) -> str:
    return (f"CASE json_type(body, '{path}') WHEN 'VARCHAR' THEN json_extract_string(body, '{path}') "
            f"WHEN 'BOOLEAN' THEN CASE WHEN json_extract_string(body, '{path}') = 'true' THEN 'True' ELSE 'False' END "
            f"WHEN 'NULL' THEN 'None' ELSE CAST(json_extract(body, '{path}') AS VARCHAR) END")


_PARTS = ", ".join(f"CASE WHEN json_exists(body, '$.error.{k}') THEN '{k}=' || ({_render_sql('$.error.' + k)}) END"
                   for k in ERROR_KEYS)


@query("error_summary", sql=f"""
WITH b AS ({P.ERROR_BODIES_SQL})
SELECT event_id,
  CASE WHEN NOT json_valid(body) THEN '<unparseable>'
       WHEN coalesce(json_type(body, '$.error'), '') <> 'OBJECT' THEN '<no error block>'
       ELSE concat_ws(' | ', {_PARTS}) END AS summary
FROM b
""")
def q_error_summary(spark, d):
    b = P.error_bodies(spark, d)
    return b.select("event_id", PG.error_summary(F.col("body")).alias("summary"))


def _token_url(c):
    return F.concat(c, F.when(c.contains("?"), F.lit("&")).otherwise(F.lit("?")),
                    F.lit("access_token=tok"), F.col("page_id").cast("string"), F.lit("&fields=id"))


@query("redact_url", sql="""
WITH u AS (SELECT page_id, url || CASE WHEN contains(url, '?') THEN '&' ELSE '?' END ||
                  'access_token=tok' || CAST(page_id AS VARCHAR) || '&fields=id' AS url FROM pages)
SELECT page_id, regexp_replace(url, '([?&](?:access_token)=)[^&#]*', '\\1***', 'g') AS redacted,
       contains(regexp_replace(url, '([?&](?:access_token)=)[^&#]*', '\\1***', 'g'), 'tok') AS leaked
FROM u
""")
def q_redact_url(spark, d):
    p = P.table(spark, d, "pages")
    r = PG.redact_url(_token_url(F.col("url")))
    return p.select("page_id", r.alias("redacted"), r.contains("tok").alias("leaked"))


@query("shape_fingerprint", sql="""
WITH t AS (SELECT DISTINCT event_type FROM events),
m AS (SELECT event_type, '{"action_attribution_windows": "1d_view,7d_view,1d_click,7d_click", '
          || '"action_breakdowns": "action_type,action_target_id,action_destination", "api_version": "v25.0", '
          || '"fields": ["ad_id", "date_start", "' || event_type || '", "spend"], "time_increment": "1"}' AS material FROM t)
SELECT event_type, material, sha256(material) AS fingerprint FROM m
""")
def q_shape_fingerprint(spark, d):
    t = P.table(spark, d, "events").select("event_type").distinct()
    m = PG.shape_material(F.array(F.lit("ad_id"), F.lit("date_start"), F.col("event_type"), F.lit("spend")))
    return t.select("event_type", m.alias("material"), F.sha2(m, 256).alias("fingerprint"))
