"""Rate-limit telemetry from response headers.

Input: one row per response ``(run_id, seq, app_usage, account_usage,
business_usage)`` with the three usage headers as JSON text.  Parsing is
per row (narrow); response rows and bucket rows are unioned into one signal
stream and the per-run rollup is a single aggregate whose buffers are all
mergeable (max/min/max_by/bool_or/count): responses of one run may be spread
over any number of tasks, a hot run is combined map-side, and the same
expression runs as a streaming aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions import jsonvals as J
from adlake.specs import LOW_ACCESS_TIER, PRESSURE_ERROR, PRESSURE_INFO, PRESSURE_WARNING


_PARSED = ("_app", "_account")


def parsed(resp: DataFrame, app: str = "app_usage", account: str = "account_usage") -> DataFrame:
    """``resp`` and the members of its two flat headers (NULL when the header
    is absent, malformed or not an object), each header parsed and walked
    once: the optimizer doesn't inline these columns into every field."""
    return resp.select("*", J.record(J.parse(F.col(app)), ["call_count", "total_cputime", "total_time"]).alias("_app"),
                       J.record(J.parse(F.col(account)), ["acc_id_util_pct", "reset_time_duration"], ["ads_api_access_tier"]).alias("_account"))


def _flat_fields(a: Column, c: Column) -> list[Column]:
    return [
        a.isNotNull().alias("has_app"), c.isNotNull().alias("has_account"),
        J.number_of(a["call_count"]).alias("app_call_count"),
        J.number_of(a["total_cputime"]).alias("app_total_cputime"),
        J.number_of(a["total_time"]).alias("app_total_time"),
        J.number_of(c["acc_id_util_pct"]).alias("acc_id_util_pct"),
        J.integer_of(c["reset_time_duration"]).alias("reset_time_duration"),
        J.text_of(c["ads_api_access_tier"]).alias("ads_api_access_tier")]


def parse_headers(resp: DataFrame, app: str = "app_usage", account: str = "account_usage") -> DataFrame:
    """App and account usage fields (NULL struct when the header is absent,
    malformed or not an object)."""
    return parsed(resp, app, account).select("*", *_flat_fields(*map(F.col, _PARSED))).drop(*_PARSED)


_BUCKET = "struct<call_count:string, total_cputime:string, total_time:string, estimated_time_to_regain_access:string, type:variant>"
_PIECE = f"struct<biz_pos:bigint,pos:bigint,business_id:string,body:{_BUCKET}>"


def bucket_list(col: Column) -> Column:
    """Per-business usage header -> array of its bucket objects, in header
    order; one parse of the text and one walk of each object.  Members that
    are no lists and buckets that are no objects are skipped."""
    lists = F.map_entries(F.from_json(col, "map<string,variant>"))
    none = F.array().cast("array<variant>")
    every = F.flatten(F.transform(lists, lambda e, i: F.transform(
        F.coalesce(F.try_variant_get(e["value"], "$", "array<variant>"), none),
        lambda x, j: F.struct(i.cast("bigint").alias("biz_pos"), j.cast("bigint").alias("pos"), e["key"].alias("business_id"),
                              F.try_variant_get(x, "$", _BUCKET).alias("body")))))
    return F.filter(F.coalesce(every, F.array().cast(f"array<{_PIECE}>")), lambda p: p["body"].isNotNull())


def _bucket_fields(b: Column) -> list[Column]:
    return [J.text_of(b["type"]).alias("type"), *[J.number_of(b[n]).alias(n) for n in ("call_count", "total_cputime", "total_time")],
            J.integer_of(b["estimated_time_to_regain_access"]).alias("eta")]


def business_buckets(resp: DataFrame, col: str = "business_usage", keys: Sequence[str] = ("run_id", "seq")) -> DataFrame:
    """Per-business usage header -> one row per bucket object, in header
    order (business position, bucket position)."""
    b = resp.select(*keys, F.inline(bucket_list(F.col(col))))
    return b.select(*keys, "biz_pos", "pos", "business_id", *_bucket_fields(F.col("body")))


def bucket_pressure(df: DataFrame) -> Column:
    """Max of the three percentages, NULL as 0."""
    return F.greatest(*[F.coalesce(F.col(c), F.lit(0.0)) for c in ("call_count", "total_cputime", "total_time")])


def pressure_level(value: Column) -> Column:
    return (F.when(value >= PRESSURE_ERROR, F.lit("error"))
             .when(value >= PRESSURE_WARNING, F.lit("warning"))
             .when(value >= PRESSURE_INFO, F.lit("info")))


def low_tier(tier: Column) -> Column:
    return F.coalesce(tier == F.lit(LOW_ACCESS_TIER), F.lit(False))


def worst_buckets(buckets: DataFrame, run_key: str = "run_id") -> DataFrame:
    """Per run: the worst bucket by (eta > 0, eta, pressure), first seen on
    ties (lowest seq, then header position)."""
    eta = F.coalesce(F.col("eta"), F.lit(0).cast("bigint"))
    rank = F.struct((eta > 0).cast("int").alias("a"), eta.alias("e"), bucket_pressure(buckets).alias("p"),
                    (-F.col("seq")).alias("s"), (-F.col("biz_pos")).alias("b"), (-F.col("pos")).alias("i"))
    return buckets.groupBy(run_key).agg(
        F.max_by(F.struct("type", "business_id", eta.alias("eta"), bucket_pressure(buckets).alias("pressure")),
                 rank).alias("w")).select(run_key, F.col("w.type").alias("worst_buc_type"),
                                          F.col("w.business_id").alias("worst_buc_business_id"),
                                          F.col("w.eta").alias("worst_buc_eta"),
                                          F.col("w.pressure").alias("worst_buc_pressure"))


def business_object_count(col: Column) -> Column:
    """Number of bucket objects in a per-business header (narrow, per row)."""
    return F.size(bucket_list(col))


_H_FIELDS = ("app_call_count", "app_total_cputime", "app_total_time", "acc_id_util_pct", "reset_time_duration",
             "ads_api_access_tier")


def signals(resp: DataFrame, run_key: str = "run_id", business: str = "business_usage", keep: Sequence[str] = ()) -> DataFrame:
    """One row per response (header fields) plus one row per bucket, in one
    schema; fields of the other kind are NULL.  One pass, and one parse of
    each header: a response explodes into itself and its buckets.  Works on
    streams too; ``keep`` columns go along."""
    own = [run_key, *keep, "seq"]
    h = parsed(resp).select(*own, *_PARSED, bucket_list(F.col(business)).alias("_buckets"))
    h = h.select(*own, "_buckets", *_flat_fields(*map(F.col, _PARSED)))
    saw = (F.col("has_app") | F.col("has_account") | (F.size("_buckets") > 0)).alias("saw_header")
    e = h.select(*own, *_H_FIELDS, saw, F.explode(F.concat(F.array(F.lit(None).cast(_PIECE)), F.col("_buckets"))).alias("_p"))
    is_response = F.col("_p").isNull()
    return e.select(
        *own, *[F.when(is_response, F.col(c)).alias(c) for c in (*_H_FIELDS, "saw_header")],
        is_response.cast("int").alias("is_response"),
        F.col("_p.business_id").alias("business_id"), *_bucket_fields(F.col("_p.body")),
        F.col("_p.biz_pos").alias("biz_pos"), F.col("_p.pos").alias("pos"))


_MAXIMA = {"app_call_count": "max_app_call_count_pct", "app_total_cputime": "max_app_cputime_pct", "app_total_time": "max_app_total_time_pct",
           "acc_id_util_pct": "max_acc_util_pct", "call_count": "max_buc_call_count_pct", "total_cputime": "max_buc_cputime_pct",
           "total_time": "max_buc_total_time_pct", "eta": "max_buc_eta_minutes"}


def partial_rollup(sig: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mergeable telemetry of ``signals`` by ``keys``: maxima, minimum, flags
    and counts, and as (order, value) pairs the last tier and worst bucket."""
    thr = F.lit(PRESSURE_ERROR)
    tier = F.col("ads_api_access_tier")
    eta = F.coalesce(F.col("eta"), F.lit(0).cast("bigint"))
    is_bucket = F.col("is_response") == 0
    worst = F.when(is_bucket, F.struct(
        (eta > 0).cast("int").alias("a"), eta.alias("e"),
        F.greatest(*[F.coalesce(F.col(c), F.lit(0.0)) for c in ("call_count", "total_cputime", "total_time")]).alias("p"),
        (-F.col("seq")).alias("s"), (-F.col("biz_pos")).alias("b"), (-F.col("pos")).alias("i"), "type", "business_id"))
    throttled = ((F.col("app_call_count") >= thr) | (F.col("app_total_cputime") >= thr) |
                 (F.col("app_total_time") >= thr) | (F.col("acc_id_util_pct") >= thr) |
                 (F.col("call_count") >= thr) | (F.col("total_cputime") >= thr) | (F.col("total_time") >= thr) |
                 (is_bucket & (eta > 0)))
    return sig.groupBy(*keys).agg(
        *[F.max(c).alias(name) for c, name in _MAXIMA.items()],
        F.min("reset_time_duration").alias("min_acc_reset_seconds"),
        F.max(F.when(tier.isNotNull(), F.struct("seq", tier.alias("tier")))).alias("_tier"),
        F.max(worst).alias("_worst"),
        F.coalesce(F.bool_or(throttled), F.lit(False)).alias("throttled_during_run"),
        F.sum("is_response").cast("bigint").alias("responses_seen"),
        F.count_if(F.coalesce(F.col("saw_header"), F.lit(False))).alias("responses_with_rate_limit_headers"))


def merged_rollup(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partials of ``partial_rollup`` merged by ``keys`` (partials again)."""
    most = [*_MAXIMA.values(), "_tier", "_worst"]
    return partials.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in most], F.min("min_acc_reset_seconds").alias("min_acc_reset_seconds"),
        F.bool_or("throttled_during_run").alias("throttled_during_run"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("responses_seen", "responses_with_rate_limit_headers")])


def finished_rollup(partials: DataFrame, run_key: str = "run_id", identity: Sequence[str] = ()) -> DataFrame:
    """The telemetry rows of partials, one for each run already."""
    return partials.select(
        run_key, *identity, "max_app_call_count_pct", "max_app_cputime_pct", "max_app_total_time_pct", "max_acc_util_pct",
        "min_acc_reset_seconds", F.col("_tier.tier").alias("ads_api_access_tier"), "max_buc_call_count_pct", "max_buc_cputime_pct",
        "max_buc_total_time_pct", "max_buc_eta_minutes",
        F.col("_worst.type").alias("worst_buc_type"), F.col("_worst.business_id").alias("worst_buc_business_id"),
        "throttled_during_run", "responses_seen", "responses_with_rate_limit_headers")


def rollup_signals(sig: DataFrame, run_key: str = "run_id", identity: Sequence[str] = ()) -> DataFrame:
    """The per-run telemetry row from ``signals`` in one aggregate.  Every
    buffer is order-free, so responses of a run may come in any order and
    from any number of tasks.  ``identity``: columns that are the same for
    all of a run's responses (org, client, account)."""
    return finished_rollup(partial_rollup(sig, [run_key, *identity]), run_key, identity)


def rollup(resp: DataFrame, run_key: str = "run_id", business: str = "business_usage", identity: Sequence[str] = ()) -> DataFrame:
    """One telemetry row per run: maxima (NULLs ignored), min reset, last
    non-empty tier, worst bucket (first seen on ties), throttled flag and
    response counters — a single partial/final aggregate over ``signals``."""
    return rollup_signals(signals(resp, run_key, business, identity), run_key, identity)
