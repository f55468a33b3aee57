"""Unify raw multi-tenant extracts into ODS parent and child tables.

Plan per entity: per-schema-group casts (narrow) -> unionByName -> one
shuffle on (tenant, natural key) for the latest-row dedupe -> narrow
source-id / payload / hash projection.  The dedupe is ``row_number() == 1``
which Catalyst turns into a partial WindowGroupLimit before the exchange, so
a hot key collapses to one row per map task before it is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.casts import cast_to, storage_type
from adlake.operators.joins import sized_broadcast
from adlake.specs import CHILD_SPECS, EXTRACTED_AT_FALLBACK_MICROS, PARENT_KEYS, PARENT_SPECS, ColSpec

DEFAULT_ORG = "default_org"
PAYLOAD_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "dateFormat": "yyyy-MM-dd",
}
ODS_PARENT_COLUMNS = ["tenant_skey", "org_uid", "client_uid", "source_id", "source_schema_hash",
                      "payload", "_record_created_at", "_record_updated_at", "_loaded_at"]


def _frames(raw: DataFrame | Iterable[DataFrame]) -> list[DataFrame]:
    return [raw] if isinstance(raw, DataFrame) else list(raw)


def apply_spec(df: DataFrame, specs: Sequence[ColSpec], keep: Sequence[str] = ()) -> DataFrame:
    """Spec-driven safe select: cast+alias each present source column, a typed
    NULL for an absent one, so every tenant yields the same schema."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols: list[Column] = []
    for s in specs:
        if s.source in types:
            cols.append(cast_to(F.col(f"`{s.source}`"), s.cast, types[s.source]).alias(s.alias))
        else:
            cols.append(F.lit(None).cast(storage_type(s.cast)).alias(s.alias))
    return df.select(*cols, *[F.col(k) for k in keep])


def extracted_at(df: DataFrame, run_ts: dt.datetime | None = None) -> Column:
    """Extraction time from the load id (epoch seconds as text, µs kept);
    without a load id, the run time truncated to the second."""
    if "_dlt_load_id" in df.columns:
        micros = (F.col("_dlt_load_id").try_cast("double") * F.lit(1_000_000)).try_cast("bigint")
        return F.timestamp_micros(micros)
    run_ts = (run_ts or dt.datetime.now(dt.timezone.utc)).replace(microsecond=0)
    return F.lit(run_ts).cast("timestamp")


def tenant_tag(df: DataFrame, roster: DataFrame | None = None, default_org: str = DEFAULT_ORG,
               client_col: str = "client") -> DataFrame:
    """Add org_uid, client_uid, tenant_skey.  The org comes from a tenant
    roster (client_slug, org_slug) when given, else ``default_org``."""
    if roster is not None:
        org_map = (roster.groupBy("client_slug").agg(F.min("org_slug").alias("_org")))
        df = df.join(sized_broadcast(org_map, max_rows=100_000),
                     df[client_col] == org_map["client_slug"], "left").drop("client_slug")
        org = F.coalesce(F.col("_org"), F.lit(default_org))
    else:
        org = F.lit(default_org)
    out = (df.withColumn("org_uid", org)
             .withColumn("client_uid", F.col(client_col))
             .withColumn("tenant_skey", F.concat(F.col("org_uid"), F.lit("__"), F.col("client_uid"))))
    return out.drop("_org") if roster is not None else out


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per key: the first by ``order`` (NULL keys group together)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def source_id(keys: Sequence[str]) -> Column:
    """Single key as text, composite keys joined by '|'; any NULL part -> NULL."""
    parts = [F.col(k).cast("string") for k in keys]
    if len(parts) == 1:
        return parts[0]
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, F.lit("|"), p)
    return out


def payload_json(aliases: Sequence[str]) -> Column:
    """JSON object of the cast columns in spec order, NULL fields kept, µs."""
    return F.to_json(F.struct(*[F.col(a) for a in aliases]), PAYLOAD_OPTIONS)


def change_hash(sid: Column, ts: Column) -> Column:
    """md5 hex of ``source_id|epoch_micros`` (NULL time hashes as 0)."""
    micros = F.coalesce(F.unix_micros(ts), F.lit(EXTRACTED_AT_FALLBACK_MICROS).cast("bigint"))
    return F.md5(F.concat(sid, F.lit("|"), micros.cast("string")))


def cast_tenant_frames(raw: DataFrame | Iterable[DataFrame], specs: Sequence[ColSpec],
                       with_extracted: bool, run_ts: dt.datetime | None = None,
                       client_col: str = "client", tie_col: str | None = "_dlt_id") -> DataFrame:
    """Cast every schema group with the spec, then union by name."""
    out = None
    for f in _frames(raw):
        keep = [client_col]
        if with_extracted:
            f = f.withColumn("extracted_at", extracted_at(f, run_ts))
            keep.append("extracted_at")
        if tie_col and tie_col in f.columns:
            f = f.withColumn("_tie", F.col(tie_col).cast("string"))
        else:
            f = f.withColumn("_tie", F.lit(None).cast("string"))
        keep.append("_tie")
        casted = apply_spec(f, specs, keep)
        out = casted if out is None else out.unionByName(casted, allowMissingColumns=True)
    if out is None:
        raise ValueError("no input frames")
    return out


def unify_parent(raw: DataFrame | Iterable[DataFrame], entity: str, loaded_at: dt.datetime,
                 roster: DataFrame | None = None, default_org: str = DEFAULT_ORG,
                 run_ts: dt.datetime | None = None, client_col: str = "client",
                 specs: Sequence[ColSpec] | None = None,
                 natural_key: Sequence[str] | None = None, row_id: str | None = None) -> DataFrame:
    """Raw tenant extracts of one parent entity -> ODS rows (one per tenant and
    natural key, latest extraction wins; ties broken by the raw row id, which
    comes out too as the column that ``row_id`` names)."""
    specs = specs or PARENT_SPECS[entity]
    keys = list(natural_key or PARENT_KEYS[entity])
    aliases = [s.alias for s in specs]
    df = cast_tenant_frames(raw, specs, True, run_ts, client_col)
    df = tenant_tag(df, roster, default_org, client_col)
    # Total order for equal extraction times: raw row id, else a row hash.
    df = df.withColumn("_row", F.col("_tie")).withColumn("_tie", F.coalesce(F.col("_tie"), F.xxhash64(*aliases).cast("string")))
    df = dedupe_latest(df, ["tenant_skey", *keys],
                       [F.col("extracted_at").desc_nulls_last(), F.col("_tie").desc()])
    sid = source_id(keys)
    return df.select(
        "tenant_skey", "org_uid", "client_uid",
        sid.alias("source_id"),
        change_hash(sid, F.col("extracted_at")).alias("source_schema_hash"),
        payload_json(aliases).alias("payload"),
        F.col("extracted_at").alias("_record_created_at"),
        F.col("extracted_at").alias("_record_updated_at"),
        F.lit(loaded_at).cast("timestamp").alias("_loaded_at"),
        *([F.col("_row").alias(row_id)] if row_id else []),
    )


def unify_child(raw: DataFrame | Iterable[DataFrame], entity: str, loaded_at: dt.datetime,
                roster: DataFrame | None = None, default_org: str = DEFAULT_ORG,
                client_col: str = "client", specs: Sequence[ColSpec] | None = None) -> DataFrame:
    """Raw child rows -> cast spec columns + tenant tags + ``_loaded_at``.
    No dedupe (see ``orphan_children`` for superseded parents)."""
    specs = specs or CHILD_SPECS[entity]
    df = cast_tenant_frames(raw, specs, False, client_col=client_col, tie_col=None).drop("_tie")
    df = tenant_tag(df, roster, default_org, client_col)
    return df.select(*[s.alias for s in specs], "org_uid", "client_uid", "tenant_skey",
                     F.lit(loaded_at).cast("timestamp").alias("_loaded_at"))


def payload_field(payload: Column, field: str) -> Column:
    """``payload->>'field'`` as text."""
    return F.get_json_object(payload, f"$.{field}")
