"""Type-aware access to loosely typed JSON values (via VARIANT).

A JSON value may be a number, numeric text, a boolean, NULL or an object;
the tolerant readers accept numbers and numeric text, reject booleans and
everything else, exactly by the JSON type of the value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlake.functions.casts import tolerant_float, tolerant_int

def parse(text: Column) -> Column:
    """JSON text -> VARIANT; malformed or empty text -> NULL."""
    return F.try_parse_json(F.nullif(text, F.lit("")))


def jtype(v: Column, path: str) -> Column:
    """Variant type name of the value at ``path`` (NULL when absent,
    'VOID' for a JSON null)."""
    return F.schema_of_variant(F.variant_get(v, path, "variant"))


def exists(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "variant").isNotNull()


def is_object(v: Column, path: str = "$") -> Column:
    return F.coalesce(jtype(v, path).startswith("OBJECT"), F.lit(False))


def _text(v: Column, path: str) -> Column:
    """The value as text.  Only a number or a numeric text reads as a number:
    true, false, objects and lists have a text that does not."""
    return F.try_variant_get(v, path, "string")


def jfloat(v: Column, path: str) -> Column:
    return number_of(_text(v, path))


def jint(v: Column, path: str) -> Column:
    """Integer, or a fractional number / numeric text truncated toward zero."""
    return integer_of(_text(v, path))


def jstr(v: Column, path: str) -> Column:
    """Non-empty JSON string, else NULL (numbers are not strings)."""
    return F.when(jtype(v, path) == "STRING", F.nullif(F.variant_get(v, path, "string"), F.lit("")))


def record(v: Column, numbers: Sequence[str], texts: Sequence[str] = ()) -> Column:
    """The named members of a JSON object in one walk, for ``number_of``,
    ``integer_of`` and ``text_of``; NULL if the value is no object."""
    return F.try_variant_get(v, "$", "struct<" + ", ".join([*(f"{n}:string" for n in numbers), *(f"{t}:variant" for t in texts)]) + ">")


def number_of(member: Column) -> Column:
    return tolerant_float(member)


def integer_of(member: Column) -> Column:
    return F.coalesce(member.try_cast("bigint"), tolerant_int(member))


def text_of(member: Column) -> Column:
    return jstr(member, "$")


def render(v: Column, path: str) -> Column:
    """Display text of a JSON value: strings as is, true/false as
    True/False, null as None, other values as compact JSON."""
    t = jtype(v, path)
    sub = F.variant_get(v, path, "variant")
    return (F.when(t == "STRING", F.variant_get(v, path, "string"))
             .when(t == "BOOLEAN", F.when(F.variant_get(v, path, "boolean"), F.lit("True")).otherwise(F.lit("False")))
             .when(t == "VOID", F.lit("None"))
             .when(t.isNotNull(), F.to_json(sub)))
