"""Generic DataFrame operators: allow-lists, name normalising, upserts,
grain checks, row counts and driver-side guards."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class MissingTableError(RuntimeError):
    """An upstream table or path that a step requires does not exist."""


def field_allowlist(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Keep the allow-listed fields that are present, in allow-list order."""
    present = set(df.columns)
    return df.select(*[F.col(f"`{f}`") for f in fields if f in present])


def normalize_name(name: str) -> str:
    """Wire name -> column name: lower case, non-word runs -> '_', and a
    leading digit gets a '_' prefix ('1d_view' -> '_1d_view')."""
    n = re.sub(r"\W+", "_", name.strip().lower()).rstrip("_") or "_"
    return f"_{n}" if n[0].isdigit() else n


def normalize_names(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(normalize_name(c)) for c in df.columns])


def upsert(base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Merge on a primary key: the union of both sides, first row per key by
    ``order`` wins (one shuffle on the key; partial limit before it)."""
    both = base.unionByName(delta, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(*order)
    return both.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _per_tenant(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """``df`` with the aggregate ``value`` of its rows' keys as ``_v`` (NULL keys match)."""
    agg = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(value.alias("_v"))
    return agg


def null_safe_join(df: DataFrame, agg: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``df`` joined to ``agg`` on ``keys`` (there named ``_k_<key>``); NULL keys match."""
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(agg[f"_k_{k}"])
        cond = c if cond is None else cond & c
    out = df.join(agg, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_k_{k}" for k in keys])


def lag_window(delta: DataFrame, state: DataFrame, date_col: str, lag_days: int,
               tenant_cols: Sequence[str]) -> DataFrame:
    """Rows of ``delta`` that an incremental merge takes: those from the stored
    cursor less ``lag_days`` on.  The cursor is each tenant's newest stored
    date, so a tenant that lags behind the others loses nothing; all rows of a
    tenant without stored rows are taken."""
    cursor = _per_tenant(state, tenant_cols, F.max(date_col))
    j = null_safe_join(delta, cursor, tenant_cols, "left")
    return j.where(F.col("_v").isNull() | (F.col(date_col) >= F.date_sub(F.col("_v"), lag_days))).drop("_v")


def load_window(df: DataFrame, date_col: str, days: int, load_cols: Sequence[str]) -> DataFrame:
    """Rows in the last ``days`` days of their own load: ``[newest - (days -
    1), newest]``, where newest is the load's newest date (``load_cols`` name
    the tenant and the load)."""
    newest = _per_tenant(df, load_cols, F.max(date_col))
    j = null_safe_join(df, newest, load_cols, "inner")
    return j.where(F.col(date_col).between(F.date_sub(F.col("_v"), days - 1), F.col("_v"))).drop("_v")


def grain_violations(df: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Keys that occur more than once at the declared grain."""
    return df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named table with its row count (one aggregate per table,
    unioned)."""
    out = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


def tenant_actions(roster: DataFrame, counts: DataFrame, client_col: str = "client") -> DataFrame:
    """Per roster tenant: rows landed and whether the run proceeds or skips
    (a tenant with zero rows is skipped, not failed)."""
    c = counts.groupBy(client_col).agg(F.count(F.lit(1)).alias("n_rows"))
    j = roster.join(c, roster["client_slug"] == c[client_col], "full_outer")
    n = F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint")
    return j.select(F.coalesce("client_slug", client_col).alias("client_slug"),
                    n.alias("n_rows"),
                    F.when(F.col("client_slug").isNull(), F.lit("unknown_tenant"))
                     .when(n == 0, F.lit("skip")).otherwise(F.lit("run")).alias("action"))
