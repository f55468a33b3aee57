"""Declared semantic entities and the joins/unions that build them.

ConversionEvent, AttributedROAS, CreativeVariant, CreativeProductRef,
CreativeFeatureFlag, thin dimensions, SCD2 dimension, top-k reports.
Joins between two large sides pre-aggregate each side to the join key first
(map-side partial aggregation), so a hot key is one row per task before the
shuffle and the join reuses the aggregation's hash partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.operators.frames import null_safe_join
from adlake.session import checkpoint_root


def child_parent_join(children: DataFrame, parents: DataFrame, how: str = "inner") -> DataFrame:
    """Children -> their parent row on ``parent_dlt_id``."""
    return children.join(parents, "parent_dlt_id", how)


def keep_children(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Children whose parent survived the parent dedupe (left semi)."""
    return children.join(parents.select("parent_dlt_id"), "parent_dlt_id", "left_semi")


def orphan_children(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Children of superseded parent loads (left anti)."""
    return children.join(parents.select("parent_dlt_id"), "parent_dlt_id", "left_anti")


def mark_orphans(children: DataFrame, parents: DataFrame) -> DataFrame:
    """All children with ``kept`` = parent survived (one left join)."""
    ids = parents.select("parent_dlt_id", F.lit(True).alias("_kept")).dropDuplicates(["parent_dlt_id"])
    return (children.join(ids, "parent_dlt_id", "left")
                    .withColumn("kept", F.coalesce("_kept", F.lit(False))).drop("_kept"))


def _at_parent_grain(children: DataFrame, parents: DataFrame, keys: Sequence[str], aggs: Sequence[Column],
                     by: Sequence[str]) -> DataFrame:
    """Children summed per parent first, then joined to the parent's keys."""
    per_parent = children.groupBy("parent_dlt_id", *by).agg(*aggs)
    return per_parent.join(parents.select("parent_dlt_id", *keys), "parent_dlt_id")


def conversion_event(actions: DataFrame, values: DataFrame, plays: DataFrame, parents: DataFrame,
                     keys: Sequence[str]) -> DataFrame:
    """Action counts, action values and video plays per (``keys``, action
    type); a type that only one side has is kept with NULLs for the others.

    ``parents`` are the surviving insight rows (deduped) with ``keys`` (ad,
    day, platform); children of superseded parents drop out.  The three sides
    are one tagged union and one aggregate, not outer joins."""
    return conversion_event_of(tag_union({"n": actions, "v": values, "p": plays}, "_side"), parents, keys)


def conversion_event_of(sides: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``conversion_event`` of children that are one table already: ``_side``
    says whether a row is an action count (n), a value (v) or a play (p).
    In buckets of the parent id, only the last sums by ``keys`` shuffle."""
    sums = [F.sum(F.when(F.col("_side") == s, F.col("value"))).alias(c)
            for s, c in (("n", "action_count"), ("v", "action_value"), ("p", "video_plays"))]
    j = _at_parent_grain(sides.select("parent_dlt_id", "action_type", "value", "_side"), parents, keys, sums, ["action_type"])
    return j.groupBy(*keys, "action_type").agg(
        *[F.sum(c).alias(c) for c in ("action_count", "action_value", "video_plays")])


def tag_union(frames: Mapping[str, DataFrame], tag_col: str) -> DataFrame:
    """Union same-shaped tables, tagging each row with its source name."""
    out = None
    for name, df in frames.items():
        t = df.withColumn(tag_col, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def _by_keys(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    """``aggs`` of ``df`` by ``keys``, named for ``null_safe_join``."""
    return df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(*aggs)


def _beside_spend(amounts: DataFrame, parents: DataFrame, keys: Sequence[str], by: Sequence[str], spend_col: str) -> DataFrame:
    """Sums of ``_v`` of ``amounts`` per (``keys``, ``by``), with ``spend`` and
    ``n_parents``: those of all parents of the group, each once, whether or
    not they have amounts.  One tagged aggregate and a sum over its few rows
    of a group, no join; a NULL key is a group like others."""
    types = {f.name: f.dataType for f in amounts.schema.fields}
    a = amounts.select(*keys, *by, "_v", F.lit(None).cast("double").alias("_s"), F.lit(0).cast("long").alias("_p"), F.lit(False).alias("_own"))
    s = parents.select(*keys, *[F.lit(None).cast(types[b]).alias(b) for b in by], F.lit(None).cast("double").alias("_v"),
                       F.col(spend_col).cast("double").alias("_s"), F.lit(1).cast("long").alias("_p"), F.lit(True).alias("_own"))
    sums = a.unionByName(s).groupBy(*keys, *by, "_own").agg(*[F.sum(c).alias(c) for c in ("_v", "_s", "_p")])
    group = Window.partitionBy(*keys)
    sums = sums.withColumn("spend", F.sum("_s").over(group)).withColumn("n_parents", F.sum("_p").over(group))
    # As an inner join: amounts without a parent group can't be, they come from parents.
    return sums.where(~F.col("_own")).drop("_s", "_p", "_own")


def attributed_roas(roas: DataFrame, parents: DataFrame, keys: Sequence[str], by_type: bool = True,
                    spend_col: str = "spend") -> DataFrame:
    """Return on spend per (``keys``, roas kind[, action type]).

    A ROAS child holds a ratio, so it is weighted by its parent's spend, never
    summed.  The spend of a group is that of all its parents, each once,
    whether or not they have a ROAS row; a NULL key is a group like others.
    ``parents`` are deduped."""
    by = ["roas_kind", "action_type"] if by_type else ["roas_kind"]
    ratio = roas.groupBy("parent_dlt_id", *by).agg(F.sum("value").alias("_ratio"))
    amount = ratio.join(parents.select("parent_dlt_id", *keys, F.col(spend_col).alias("_spend")), "parent_dlt_id").withColumn("_v", F.col("_ratio") * F.col("_spend"))
    return _beside_spend(amount, parents, keys, by, spend_col).select(
        *keys, *by, (F.col("_v") / F.nullif(F.col("spend"), F.lit(0.0))).alias("roas"), "spend", "n_parents")


def cost_per_action(actions: DataFrame, parents: DataFrame, keys: Sequence[str], spend_col: str = "spend") -> DataFrame:
    """CPA per (``keys``, action type): all spend of the group, once, over the
    sum of the actions; a NULL key is a group like others."""
    j = _at_parent_grain(actions, parents, keys, [F.sum("value").alias("_v")], ["action_type"])
    return _beside_spend(j, parents, keys, ["action_type"], spend_col).select(
        *keys, "action_type", F.col("_v").alias("actions"), "spend", (F.col("spend") / F.nullif(F.col("_v"), F.lit(0.0))).alias("cpa"))


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows by ``order`` (TakeOrderedAndProject: per-task top-k,
    then a k-row merge; never a global sort)."""
    return df.orderBy(*order).limit(k)


def unpivot_flags(df: DataFrame, ids: Sequence[str], cols: Sequence[str],
                  name_col: str = "feature_name", value_col: str = "enroll_status") -> DataFrame:
    """Wide status columns -> long rows; NULL statuses are kept."""
    return df.unpivot(list(ids), list(cols), name_col, value_col)


def thin_dimensions(facts: DataFrame, tenant: str, kinds: Mapping[str, tuple[str, Sequence[str]]], order_col: str,
                    tie_col: str) -> DataFrame:
    """Latest attributes per (kind, tenant, id) from denormalised facts.

    ``kinds`` maps a kind to its id column and its attributes.  All attributes
    of an id come from one row, the latest by (``order_col``, ``tie_col``): a
    max_by over one struct, in one partial aggregate over all kinds."""
    attrs = list(dict.fromkeys(a for _, own in kinds.values() for a in own))
    rows = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("id"),
                              *[(F.col(a) if a in own else F.lit(None)).cast("string").alias(a) for a in attrs])
                     for kind, (key, own) in kinds.items()])
    long = facts.select(tenant, order_col, tie_col, F.explode(rows).alias("d")).where("d.id is not null")
    return (long.groupBy("d.kind", tenant, "d.id")
                .agg(F.max_by(F.struct(*[F.col(f"d.{a}").alias(a) for a in attrs]), F.struct(order_col, tie_col)).alias("_last"),
                     F.min(order_col).alias("first_seen"), F.max(order_col).alias("last_seen"))
                .select("kind", tenant, "id", *[F.col(f"_last.{a}").alias(a) for a in attrs], "first_seen", "last_seen"))


def scd2(versions: DataFrame, keys: Sequence[str], attrs: Sequence[str], ts_col: str, tie_col: str) -> DataFrame:
    """Type-2 history: one row per change of ``attrs`` per ``keys`` (tenant and
    id), valid from the change time until the next change (NULL = current).

    One version per time (the largest ``tie_col``), by partial aggregation.
    Versions are dealt into ranges of (keys, time), so a hot key spreads over
    many tasks; changes are found inside each range.  One edge row for each
    (key, range) then says what a range starts and ends with: a window over
    these few rows tells which range's first version is no change, and when
    the next change after a range comes."""
    spark = versions.sparkSession
    checkpoint_root(spark)
    own = F.struct(*[F.col(a) for a in attrs])
    v = versions.groupBy(*keys, ts_col).agg(F.max_by(own, F.col(tie_col)).alias("_a"))
    v = v.select(*keys, ts_col, F.col("_a"), F.md5(F.to_json("_a")).alias("_h"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The checkpoint fixes the ranges, which are drawn from a sample.
    v = v.repartitionByRange(n, *keys, ts_col).withColumn("_part", F.spark_partition_id()).checkpoint()

    inside = Window.partitionBy(*keys, "_part").orderBy(ts_col)
    ch = v.withColumn("_start", F.row_number().over(inside) == 1).withColumn("_prev", F.lag("_h").over(inside))
    ch = ch.where(F.col("_start") | ~F.col("_prev").eqNullSafe(F.col("_h"))).drop("_prev")
    ch = ch.withColumn("_next", F.lead(ts_col).over(inside))

    edges = _by_keys(ch, [*keys, "_part"],
                     F.min(ts_col).alias("_first"), F.min_by("_h", ts_col).alias("_first_h"), F.max_by("_h", ts_col).alias("_last_h"),
                     F.min(F.when(~F.col("_start"), F.col(ts_col))).alias("_second"))
    along = Window.partitionBy(*[f"_k_{k}" for k in keys]).orderBy("_k__part")
    edges = edges.withColumn("_changed", (F.row_number().over(along) == 1) | ~F.lag("_last_h").over(along).eqNullSafe(F.col("_first_h")))
    change = F.when(F.col("_changed"), F.col("_first")).otherwise(F.col("_second"))
    edges = edges.withColumn("_change", change).withColumn("_later", F.min("_change").over(along.rowsBetween(1, Window.unboundedFollowing)))
    edges = edges.select(*[f"_k_{k}" for k in (*keys, "_part")], "_changed", "_later")

    ch = null_safe_join(ch, edges, [*keys, "_part"], "inner").where(~F.col("_start") | F.col("_changed"))
    until = F.coalesce("_next", "_later")
    return ch.select(
        F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.unix_micros(F.col(ts_col)).cast("string")), 256)
         .alias("dim_skey"),
        *keys, *[F.col(f"_a.{a}").alias(a) for a in attrs], F.col(ts_col).alias("valid_from"),
        until.alias("valid_to"), until.isNull().alias("is_current"))


def creative_variants(creatives: DataFrame, spec_col: str, kinds: Sequence[str], id_col: str = "creative_id") -> DataFrame:
    """(id, variant_kind, position, value) of every element of the named lists
    of a nested asset feed spec, in one scan (a list stays in its row's task)."""
    lists = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{spec_col}.{k}").alias("items")) for k in kinds])
    one = creatives.select(id_col, F.explode(lists).alias("l"))
    return one.select(id_col, F.col("l.kind").alias("variant_kind"), F.posexplode("l.items").alias("position", "value"))


def ad_creative_bridge(insights: DataFrame, ads: DataFrame, creatives: DataFrame) -> DataFrame:
    """Performance per creative via ad -> creative: insights are summed per
    ad first (partial aggregate), then joined twice."""
    per_ad = insights.groupBy("ad_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("spend").alias("spend"))
    a = ads.select(F.col("id").alias("ad_id"), F.col("creative.id").alias("creative_id"))
    c = creatives.select(F.col("id").alias("creative_id"), "lang")
    j = per_ad.join(a, "ad_id").join(c, "creative_id")
    return j.groupBy("creative_id", "lang").agg(
        F.sum("n_rows").alias("n_rows"), F.round(F.sum("spend"), 2).alias("spend"),
        F.count(F.lit(1)).alias("n_ads"))
