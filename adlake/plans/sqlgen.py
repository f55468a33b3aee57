"""DuckDB SQL text for the oracle side: the same lenient casts and payload
rules as ``adlake.functions.casts`` / ``adlake.operators.unify``, written
as SQL so each query can be checked against an independent engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlake.specs import ColSpec

SQL_TYPES = {"STRING": "VARCHAR", "INT64": "BIGINT", "FLOAT64": "DOUBLE", "DATE": "DATE",
             "TIMESTAMP": "TIMESTAMP", "JSON_STRING": "VARCHAR"}
NUMERIC_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip_ws(e: str) -> str:
    return f"regexp_replace(CAST({e} AS VARCHAR), '^\\s+|\\s+$', '', 'g')"


def cast_sql(e: str, cast: str, src_is_text: bool = True) -> str:
    if cast == "STRING":
        return f"nullif({strip_ws(e)}, '')"
    if cast == "INT64":
        if src_is_text:
            s = strip_ws(e)
            return f"(CASE WHEN regexp_full_match({s}, '[+-]?\\d+') THEN TRY_CAST({s} AS BIGINT) END)"
        return f"TRY_CAST(trunc({e}) AS BIGINT)"
    if cast == "FLOAT64":
        if src_is_text:
            s = strip_ws(e)
            return f"(CASE WHEN regexp_matches({s}, '{NUMERIC_RE}') THEN TRY_CAST({s} AS DOUBLE) END)"
        return f"TRY_CAST({e} AS DOUBLE)"
    if cast == "DATE":
        return f"TRY_CAST({e} AS DATE)"
    if cast == "TIMESTAMP":
        return f"TRY_CAST({e} AS TIMESTAMP)"
    if cast == "JSON_STRING":
        return f"CAST({e} AS VARCHAR)"
    raise ValueError(cast)


def spec_select(specs: Sequence[ColSpec], present: set[str], src_alias: str = "") -> str:
    pre = f"{src_alias}." if src_alias else ""
    out = []
    for s in specs:
        if s.source in present:
            out.append(f"{cast_sql(pre + s.source, s.cast)} AS {s.alias}")
        else:
            out.append(f"CAST(NULL AS {SQL_TYPES[s.cast]}) AS {s.alias}")
    return ",\n    ".join(out)


def payload_sql(aliases: Sequence[str]) -> str:
    return "CAST(to_json(struct_pack(" + ", ".join(f"{a} := {a}" for a in aliases) + ")) AS VARCHAR)"


def source_id_sql(keys: Sequence[str]) -> str:
    return " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)


def change_hash_sql(sid: str, ts: str) -> str:
    return f"md5({sid} || '|' || CAST(coalesce(epoch_us({ts}), 0) AS VARCHAR))"


def extracted_at_sql(load_id: str) -> str:
    return f"make_timestamp(CAST(trunc(TRY_CAST({load_id} AS DOUBLE) * 1000000) AS BIGINT))"


# ------------------------------------------------------------------ row digests
# An order-free digest of a table in both engines: the exclusive or of 60 bits
# of each row's md5, over a text of its columns that both write alike.

def row_digest_sql(columns: Sequence[tuple[str, str]]) -> str:
    """``columns``: (SQL expression, cast type)."""
    text = {"INT64": "CAST({} AS VARCHAR)", "FLOAT64": "CAST(CAST({} AS DECIMAL(38,6)) AS VARCHAR)", "DATE": "CAST({} AS VARCHAR)",
            "TIMESTAMP": "CAST(epoch_us({}) AS VARCHAR)"}
    cells = ", ".join(f"coalesce({text.get(cast, '{}').format(e)}, '~')" for e, cast in columns)
    return f"bit_xor(CAST('0x' || substr(md5(concat_ws('|', {cells})), 1, 15) AS BIGINT))"


def row_digest(columns: Sequence[tuple[Column, str]]) -> Column:
    """The same as a Spark aggregate."""
    text = {"INT64": lambda c: c.cast("string"), "FLOAT64": lambda c: c.cast("decimal(38,6)").cast("string"), "DATE": lambda c: c.cast("string"),
            "TIMESTAMP": lambda c: F.unix_micros(c).cast("string")}
    cells = [F.coalesce(text.get(cast, lambda c: c)(c), F.lit("~")) for c, cast in columns]
    return F.bit_xor(F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 15), 16, 10).cast("bigint"))
