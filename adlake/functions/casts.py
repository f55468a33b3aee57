"""Column builders for the lenient casts of the ODS layer and tolerant parsers.

All are plain ``Column -> Column`` functions over built-in expressions, so
they stay inside whole-stage codegen.  Casts that depend on the input type
take the ``DataType`` of the source column (known at plan-build time).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text that a lenient numeric parse accepts: optional sign, digits with an
# optional fraction (or a bare fraction), optional exponent; inf/nan words.
NUMERIC_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^(?i)[+-]?(inf|infinity|nan)$"

# Cast target -> storage type.  Unknown targets are a plan-time error.
SPARK_TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "FLOAT64": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "JSON_STRING": T.StringType(),
}


def storage_type(cast_to: str) -> T.DataType:
    try:
        return SPARK_TYPES[cast_to]
    except KeyError:
        raise ValueError(f"unknown cast target: {cast_to}") from None


_WS_CHARS = " \t\n\r\f\x0b"  # the \s class of java.util.regex


def strip_ws(c: Column) -> Column:
    """Trim all leading/trailing whitespace (plain ``trim`` only strips
    spaces); a character-set trim, no regex."""
    return F.trim(c, F.lit(_WS_CHARS))


def cast_string(c: Column, dtype: T.DataType | None = None) -> Column:
    """STRING: text form, edge whitespace removed, '' -> NULL."""
    return F.nullif(strip_ws(c.cast("string")), F.lit(""))


def cast_int(c: Column, dtype: T.DataType | None = None) -> Column:
    """INT64, lenient: integer text or any number; bad text -> NULL.

    Fractional text ('12.7', '12.0') is rejected, fractional numbers are
    truncated (12.7 -> 12)."""
    if isinstance(dtype, T.StringType):
        # Spark's own text -> bigint parse accepts only [+-]digits, so no
        # regex guard is needed ('12.7', '12.0', '1e3', '1_000' -> NULL).
        return strip_ws(c).try_cast("bigint")
    return c.try_cast("bigint")


def cast_float(c: Column, dtype: T.DataType | None = None) -> Column:
    """FLOAT64, lenient: numeric text or any number; bad text -> NULL."""
    if isinstance(dtype, T.StringType):
        s = strip_ws(c)
        return F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))
    if isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("double")
    return c.try_cast("double")


def cast_date(c: Column, dtype: T.DataType | None = None) -> Column:
    return c.try_cast("date")


def cast_timestamp(c: Column, dtype: T.DataType | None = None) -> Column:
    """TIMESTAMP (µs, UTC session): text with or without offset and typed
    timestamps converge; bad text -> NULL."""
    if isinstance(dtype, T.StringType):
        return strip_ws(c).try_cast("timestamp")
    return c.try_cast("timestamp")


def cast_json(c: Column, dtype: T.DataType | None = None) -> Column:
    """JSON_STRING: structs/arrays/maps are serialised; JSON text is
    re-encoded canonically; text that is not JSON is kept as is."""
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(c)
    s = c.cast("string")
    return F.coalesce(F.to_json(F.try_parse_json(s)), s)


CASTS = {
    "STRING": cast_string,
    "INT64": cast_int,
    "FLOAT64": cast_float,
    "DATE": cast_date,
    "TIMESTAMP": cast_timestamp,
    "JSON_STRING": cast_json,
}


def cast_to(c: Column, cast: str, dtype: T.DataType | None = None) -> Column:
    if cast not in CASTS:
        raise ValueError(f"unknown cast target: {cast}")
    return CASTS[cast](c, dtype)


# --------------------------------------------------------------------------
# Tolerant parsers for loosely typed JSON values (numbers or numeric text).
# Unlike cast_int, tolerant_int accepts '12.7' and truncates it to 12.
# --------------------------------------------------------------------------

def tolerant_float(c: Column) -> Column:
    """bool/NULL/'' -> NULL; number or trimmed numeric text -> double."""
    s = strip_ws(c.cast("string"))
    return F.when(s.rlike(NUMERIC_TEXT), s.try_cast("double"))


def tolerant_int(c: Column) -> Column:
    """As tolerant_float, then truncated toward zero."""
    return tolerant_float(c).try_cast("bigint")


def int_or_zero(c: Column) -> Column:
    return F.coalesce(tolerant_int(c), F.lit(0).cast("bigint"))


def str_or_none(c: Column) -> Column:
    """Non-empty text or NULL."""
    return F.nullif(c.cast("string"), F.lit(""))
