"""Metric spec: additive measures are summed, ratio measures are always
recomputed from the summed numerator and denominator (never summed or
averaged), at any grouping, including ROLLUP/CUBE levels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str               # "sum" | "ratio"
    column: str = ""        # for sums
    num: str = ""           # for ratios: names of summed measures
    den: str = ""
    scale: float = 1.0
    additive_over_days: bool = True


# Standard ad measures: cpc = spend/clicks, cpm = 1000*spend/impressions,
# ctr = 100*clicks/impressions, frequency = impressions/reach.
AD_MEASURES = (
    Measure("impressions", "sum", "impressions"),
    Measure("reach", "sum", "reach", additive_over_days=False),
    Measure("clicks", "sum", "clicks"),
    Measure("spend", "sum", "spend"),
    Measure("cpc", "ratio", num="spend", den="clicks"),
    Measure("cpm", "ratio", num="spend", den="impressions", scale=1000.0),
    Measure("ctr", "ratio", num="clicks", den="impressions", scale=100.0),
    Measure("frequency", "ratio", num="impressions", den="reach"),
)


def _ratio(num: Column, den: Column, scale: float) -> Column:
    return F.lit(scale) * num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def aggregate(df: DataFrame, dims: Sequence[str], measures: Sequence[Measure] = AD_MEASURES,
              mode: str = "group", day_col: str = "date_start") -> DataFrame:
    """Sum the additive measures per group (``mode``: group | rollup | cube),
    then derive every ratio from the sums.  Rollup/cube rows carry
    ``grouping_level`` (grouping_id).  Across days a measure that is not
    additive over days (distinct users) is NULL, and so are its ratios."""
    over_days = mode != "group" or day_col not in dims
    hidden = set(non_additive(measures)) if over_days else set()
    sums = [m for m in measures if m.kind == "sum"]
    aggs = [(F.lit(None).cast("bigint") if m.name in hidden else F.sum(m.column)).alias(m.name) for m in sums]
    if mode == "group":
        g = df.groupBy(*dims).agg(*aggs)
    elif mode in ("rollup", "cube"):
        gd = df.rollup(*dims) if mode == "rollup" else df.cube(*dims)
        g = gd.agg(*aggs, F.grouping_id().cast("bigint").alias("grouping_level"))
    else:
        raise ValueError(mode)
    for m in measures:
        if m.kind == "ratio":
            g = g.withColumn(m.name, _ratio(F.col(m.num), F.col(m.den), m.scale))
    return g


def non_additive(measures: Sequence[Measure] = AD_MEASURES) -> list[str]:
    """Measures that must not be summed across days (distinct-user counts)."""
    return [m.name for m in measures if not m.additive_over_days]
