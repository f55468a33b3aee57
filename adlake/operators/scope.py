"""Id scopes, scoped listings, id batches and date-window planning.

Scopes stay DataFrames (distinct one-column sides of semi joins), never
driver-side tuples.  Global id numbering (for fixed-size batches) avoids a
single-task window: ids are range-partitioned and sorted, the lineage is cut
with ``checkpoint()`` (shared checkpoint dir) so partition ids are stable,
and each row's position is its partition's offset plus its index inside the
partition (offsets: one small row per partition).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.casts import strip_ws
from adlake.operators.joins import sized_broadcast
from adlake.session import checkpoint_root
from adlake.specs import (GRAPH_IDS_BATCH_SIZE, INITIAL_LOAD_DAYS_BY_ENV, INITIAL_LOAD_DAYS_DEFAULT,
                          INSIGHTS_CATCHUP_THRESHOLD_DAYS, INSIGHTS_CHUNK_DAYS, INSIGHTS_STEADY_STATE_DAYS)


def _valid_id(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def scope_ids(insights: DataFrame, cols: Mapping[str, str] = None) -> DataFrame:
    """Distinct non-empty ids per kind, long form (id_kind, object_id)."""
    cols = cols or {"ad": "ad_id", "adset": "adset_id", "campaign": "campaign_id"}
    stacked = insights.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("id_kind"), F.col(c).cast("string").alias("object_id")) for k, c in cols.items()
    ])).alias("s")).select("s.*")
    return stacked.where(_valid_id(F.col("object_id"))).distinct()


def scope_sizes(scope: DataFrame) -> DataFrame:
    """Ids per kind (a kind with no ids is absent; empty scope = no rows)."""
    return scope.groupBy("id_kind").agg(F.count(F.lit(1)).alias("n_ids"))


def creative_ids(ads: DataFrame, creative_col: str = "creative") -> DataFrame:
    """Distinct creative ids referenced by ads: the reference must be an
    object with a non-empty string id."""
    cid = F.col(creative_col).getField("id")
    return ads.where(F.col(creative_col).isNotNull() & _valid_id(cid)).select(cid.alias("creative_id")).distinct()


def restrict(listing: DataFrame, ids: DataFrame, listing_key: str = "id", id_col: str = "object_id") -> DataFrame:
    """Listing rows whose id was seen (left semi join)."""
    return listing.join(ids, listing[listing_key] == ids[id_col], "left_semi")


def dense_positions(ids: DataFrame, col: str) -> DataFrame:
    """Distinct ``col`` values with their 0-based position in sort order."""
    spark = ids.sparkSession
    checkpoint_root(spark)  # make sure the shared checkpoint dir is set
    ranged = (ids.select(col).where(F.col(col).isNotNull()).distinct()
                 .repartitionByRange(col).sortWithinPartitions(col)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mono", F.monotonically_increasing_id()))
    # Persist first so the reliable checkpoint writes the computed blocks
    # instead of recomputing the distinct/range sort a second time.
    from pyspark import StorageLevel
    cached = ranged.persist(StorageLevel.DISK_ONLY)
    ranged = cached.checkpoint(eager=True)
    cached.unpersist()
    # Offsets: one row per partition, summed up by a window over that table.
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n"))
                     .select("_pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off")))
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    j = ranged.join(sized_broadcast(offsets), "_pid")
    return j.select(col, (F.col("_off") + local).cast("bigint").alias("pos"))


def id_batches(ids: DataFrame, col: str, size: int = GRAPH_IDS_BATCH_SIZE) -> DataFrame:
    """Sorted distinct non-empty ids in batches of ``size``: one row per
    batch with its ids joined by ',' (a batch holds at most ``size`` ids)."""
    pos = dense_positions(ids.where(_valid_id(F.col(col))), col)
    b = pos.withColumn("batch_no", F.floor(F.col("pos") / size).cast("bigint"))
    return b.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_ids"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", col))), lambda s: s[col]),
                     ",").alias("ids"))


# ------------------------------------------------------------ date windows

def insights_chunks(plan: DataFrame, today: Column | dt.date, days_col: str = "history_days",
                    chunk_days: int = INSIGHTS_CHUNK_DAYS) -> DataFrame:
    """Split each row's window of ``history_days`` ending today into inclusive
    chunks of at most ``chunk_days`` days, newest first (chunk_idx 0); the
    oldest chunk is truncated; no rows for n <= 0."""
    t = today if isinstance(today, Column) else F.lit(today).cast("date")
    n = F.col(days_col)
    p = plan.where(n > 0).withColumn(
        "chunk_idx", F.explode(F.sequence(F.lit(0), (F.ceil(n / F.lit(chunk_days)) - 1).cast("int"))))
    until = F.date_sub(t, F.col("chunk_idx") * chunk_days)
    since = F.greatest(F.date_sub(until, chunk_days - 1), F.date_sub(t, n - 1))
    return p.withColumn("since", since).withColumn("until", until)


def resolve_history_days(coverage_min: Column, coverage_max: Column, today: Column, target_min: Column,
                         initial_days: Column, steady: int = INSIGHTS_STEADY_STATE_DAYS,
                         threshold: int = INSIGHTS_CATCHUP_THRESHOLD_DAYS) -> Column:
    """First run -> initial; still short of the target depth -> widen toward
    it (capped at initial); stale past the threshold -> initial; behind ->
    gap + steady; caught up -> steady."""
    branch = branch_name(coverage_min, coverage_max, today, target_min, steady, threshold)
    return (F.when(branch == "deepen", F.least(F.datediff(today, target_min), initial_days))
             .when(branch == "catch_up", F.datediff(today, coverage_max) + steady)
             .when(branch == "steady", F.lit(steady))
             .otherwise(initial_days))


def branch_name(coverage_min: Column, coverage_max: Column, today: Column, target_min: Column,
                steady: int = INSIGHTS_STEADY_STATE_DAYS, threshold: int = INSIGHTS_CATCHUP_THRESHOLD_DAYS) -> Column:
    gap = F.datediff(today, coverage_max)
    return (F.when(coverage_min.isNull() | coverage_max.isNull(), "first_run")
             .when(coverage_min > target_min, "deepen")
             .when(gap > threshold, "stale")
             .when(gap > steady, "catch_up")
             .otherwise("steady"))


def initial_load_days(env: Column) -> Column:
    """Initial window by environment tier (trimmed, lower-cased); a missing
    (NULL or empty) tier is ``dev``, an unknown name gets the largest window."""
    m = F.create_map(*[F.lit(x) for kv in INITIAL_LOAD_DAYS_BY_ENV.items() for x in kv])
    tier = F.coalesce(F.nullif(F.lower(strip_ws(env)), F.lit("")), F.lit("dev"))
    return F.coalesce(F.element_at(m, tier), F.lit(INITIAL_LOAD_DAYS_DEFAULT))


def history_override(raw: Column) -> Column:
    """A positive integer override, else NULL."""
    s = strip_ws(raw)
    n = F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("int"))
    return F.when(n > 0, n)


def preset_window(preset: Column, today: Column, maximum_days: int = INITIAL_LOAD_DAYS_DEFAULT) -> tuple[Column, Column]:
    """(since, until) of a named report preset; ``last_Nd`` ends yesterday."""
    yesterday = F.date_sub(today, 1)
    month = F.trunc(today, "month")
    last_n = F.regexp_extract(preset, r"^last_(\d+)d$", 1)
    since = (F.when(preset == "today", today)
              .when(preset == "yesterday", yesterday)
              .when(last_n != "", F.date_sub(today, last_n.try_cast("int")))
              .when(preset == "this_month", month)
              .when(preset == "last_month", F.add_months(month, -1))
              .when(preset == "maximum", F.date_sub(today, maximum_days - 1)))
    until = (F.when(preset.isin("today", "this_month", "maximum"), today)
              .when(preset == "yesterday", yesterday)
              .when(last_n != "", yesterday)
              .when(preset == "last_month", F.date_sub(month, 1)))
    return since, until


def rolling_window(df: DataFrame, date_col: str, today: Column | dt.date, days: int,
                   partition_col: str | None = None) -> DataFrame:
    """Rows with ``date_col`` in [today - (days-1), today].  ``partition_col``
    names the lake's text partition (yyyy-mm-dd) of the same day: it is
    filtered first, so only the window's folders are read."""
    t = today if isinstance(today, Column) else F.lit(today).cast("date")
    if partition_col is not None:
        df = df.where(F.col(partition_col).between(F.date_sub(t, days - 1).cast("string"), t.cast("string")))
    return df.where(F.col(date_col).between(F.date_sub(t, days - 1), t))


def tenant_windows(lake: DataFrame, windows: DataFrame, client_col: str = "client", day_col: str = "date", max_windows: int = 100_000) -> DataFrame:
    """Rows of ``lake`` (partitioned by tenant and day) in their own tenant's
    window; ``windows``: (client, since, until).  The windows' days are joined
    on the partition columns, so at run time only the folders of each
    tenant's own days are read."""
    days = windows.where(F.col("since") <= F.col("until")).select(F.col("client").alias("_c"), "since", "until", F.explode(F.sequence("since", "until")).alias("_d"))
    days = days.where(F.col("_d").between(F.col("since"), F.col("until"))).select("_c", F.col("_d").cast("string").alias("_d")).distinct()
    days = sized_broadcast(days, 1_000 * max_windows)
    return lake.join(days, (F.col(client_col) == F.col("_c")) & (F.col(day_col) == F.col("_d"))).drop("_c", "_d")
