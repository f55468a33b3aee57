"""Landed API payloads: report pages, multi-id maps, job status, error
summaries, URL redaction and query-shape fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions import jsonvals as J
from adlake.specs import (ACTION_BREAKDOWNS, API_VERSION, ATTRIBUTION_WINDOWS, ERROR_KEYS, ERROR_NO_BLOCK,
                          ERROR_UNPARSEABLE, TERMINAL_FAILURE, TERMINAL_SUCCESS, TIME_INCREMENT)


def explode_pages(df: DataFrame, body_col: str, row_schema: T.StructType, carry: Sequence[str] = ()) -> DataFrame:
    """One row per element of each page's ``data`` list; empty pages, pages
    without ``data`` and malformed bodies yield nothing."""
    env = T.StructType([T.StructField("data", T.ArrayType(row_schema)),
                        T.StructField("paging", T.StructType([T.StructField("next", T.StringType())]))])
    p = F.from_json(F.col(body_col), env)
    return df.select(*carry, F.explode(p["data"]).alias("row")).select(*carry, "row.*")


def explode_multi_id(df: DataFrame, body_col: str, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Multi-id payload ``{id: object | {"error":...} | junk}`` -> (objects,
    dropped).  Objects keep their key and the member as VARIANT; dropped
    members carry the reason."""
    m = F.from_json(F.col(body_col), T.MapType(T.StringType(), T.StringType()))
    ex = df.select(*carry, F.posexplode(m).alias("pos", "object_key", "_raw")) \
           .withColumn("item", J.parse(F.col("_raw"))).drop("_raw")
    obj = J.is_object(F.col("item"))
    err = J.exists(F.col("item"), "$.error")
    kept = ex.where(obj & ~err)
    dropped = ex.where(~obj | err).withColumn(
        "reason", F.when(~obj, F.lit("not_object")).otherwise(F.lit("error")))
    return kept, dropped


def job_status(payload: Column) -> list[Column]:
    """Report-run status fields with tolerant casts, plus its class."""
    v = J.parse(payload)
    status = F.coalesce(J.jstr(v, "$.async_status"), F.lit(""))
    return [
        status.alias("async_status"),
        F.coalesce(J.jint(v, "$.async_percent_completion"), F.lit(0).cast("bigint")).alias("async_percent_completion"),
        J.jint(v, "$.error_code").alias("error_code"),
        J.jint(v, "$.error_subcode").alias("error_subcode"),
        J.jstr(v, "$.error_user_title").alias("error_user_title"),
        J.jstr(v, "$.error_user_msg").alias("error_user_msg"),
        status.isin(*TERMINAL_SUCCESS).alias("is_success"),
        status.isin(*TERMINAL_FAILURE).alias("is_failure"),
        status.isin(*TERMINAL_SUCCESS, *TERMINAL_FAILURE).alias("is_terminal"),
    ]


def report_run_id(payload: Column) -> Column:
    """The report run id as text; NULL when missing/empty (an error row)."""
    v = J.parse(payload)
    t = J.jtype(v, "$.report_run_id")
    txt = F.when(t == "STRING", F.variant_get(v, "$.report_run_id", "string")) \
           .when(t.isNotNull() & (t != "VOID") & (t != "BOOLEAN"), F.to_json(F.variant_get(v, "$.report_run_id", "variant")))
    return F.nullif(txt, F.lit(""))


def error_summary(body: Column, keys: Sequence[str] = ERROR_KEYS) -> Column:
    """``k=v | k=v`` for the known error keys present, in key order; fixed
    texts for a body that is not JSON or has no error object."""
    v = J.parse(body)
    parts = [F.when(J.exists(v, f"$.error.{k}"), F.concat(F.lit(f"{k}="), J.render(v, f"$.error.{k}")))
             for k in keys]
    return (F.when(v.isNull(), F.lit(ERROR_UNPARSEABLE))
             .when(~J.is_object(v, "$.error"), F.lit(ERROR_NO_BLOCK))
             .otherwise(F.concat_ws(" | ", *parts)))


def redact_url(url: Column, params: Sequence[str] = ("access_token",)) -> Column:
    """Replace the values of the named query parameters with '***'."""
    names = "|".join(params)
    return F.regexp_replace(url, rf"([?&](?:{names})=)[^&#]*", "$1***")


def shape_material(fields: Column, api_version: str = API_VERSION) -> Column:
    """Sorted-key JSON text identifying a report query shape (a fields array
    plus the fixed breakdown/window/increment settings)."""
    # Each name as JSON text, by the JSON writer (which escapes it).
    flist = F.concat(F.lit("["), F.array_join(F.transform(fields, lambda f: F.regexp_replace(F.to_json(F.array(f)), r"^\[|\]$", "")), ", "),
                     F.lit("]"))
    return F.concat(
        F.lit(f'{{"action_attribution_windows": "{ATTRIBUTION_WINDOWS}", '
              f'"action_breakdowns": "{ACTION_BREAKDOWNS}", "api_version": "{api_version}", "fields": '),
        flist, F.lit(f', "time_increment": "{TIME_INCREMENT}"}}'))
