"""Nested rows -> parent table + keyed child tables.

The schema walk runs on the driver (it only reads ``df.schema``); the data
work is narrow per-row projections and ``posexplode`` on the executors, so a
long list in one row never leaves its task.  Child rows get deterministic
ids ``md5(parent_id|path|idx)``, the parent id and the list index.  Lists
deeper than the nesting cap are kept as JSON text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators.frames import normalize_name
from adlake.session import exists, open_writers

ID, PARENT_ID, LIST_IDX = "_dlt_id", "_dlt_parent_id", "_dlt_list_idx"


def _q(name: str) -> str:
    return f"`{name}`"


def flat_columns(schema: T.StructType, prefix: Column | None = None, name_prefix: str = "",
                 keep_arrays: bool = True) -> list[tuple[str, Column, T.DataType]]:
    """(output name, column, type) for every leaf of nested structs, named
    ``a__b``; arrays are returned as leaves."""
    out = []
    for f in schema.fields:
        c = prefix[f.name] if prefix is not None else F.col(_q(f.name))
        name = f"{name_prefix}{normalize_name(f.name)}"
        if isinstance(f.dataType, T.StructType):
            out.extend(flat_columns(f.dataType, c, f"{name}__", keep_arrays))
        else:
            out.append((name, c, f.dataType))
    return out


def flatten_struct(df: DataFrame) -> DataFrame:
    """Struct fields become ``a__b`` columns (recursively)."""
    return df.select(*[c.alias(n) for n, c, _ in flat_columns(df.schema)])


def _is_list(t: T.DataType, depth: int, max_nesting: int) -> bool:
    return isinstance(t, T.ArrayType) and depth < max_nesting


def _leaves(columns: Sequence[tuple[str, Column, T.DataType]], depth: int, max_nesting: int):
    """Scalar columns of flat ``columns``, and the list columns to explode;
    lists at or beyond the cap become JSON text."""
    scalars, lists = [], []
    for n, c, t in columns:
        if _is_list(t, depth, max_nesting):
            lists.append((n, c, t))
        elif isinstance(t, (T.ArrayType, T.MapType)):
            scalars.append(F.to_json(c).alias(n))
        else:
            scalars.append(c.alias(n))
    return scalars, lists


def _split(df: DataFrame, depth: int, max_nesting: int):
    return _leaves(flat_columns(df.schema), depth, max_nesting)


def explode_children(parent: DataFrame, list_col: Column, path: str, parent_id: str = ID,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per list element: element fields (or ``value`` for scalars),
    ``_dlt_id``, ``_dlt_parent_id``, ``_dlt_list_idx``; empty and NULL lists
    yield no rows."""
    ex = parent.select(F.col(parent_id).alias(PARENT_ID), *[F.col(c) for c in carry],
                       F.posexplode(list_col).alias("_pos", "_elem"))
    child_id = F.md5(F.concat_ws("|", F.col(PARENT_ID), F.lit(path), F.col("_pos").cast("string")))
    elem_t = ex.schema["_elem"].dataType
    if isinstance(elem_t, T.StructType):
        fields = [F.col("_elem").getField(f.name).alias(f.name) for f in elem_t.fields]
    else:
        fields = [F.col("_elem").alias("value")]
    return ex.select(child_id.alias(ID), F.col(PARENT_ID), F.col("_pos").cast("bigint").alias(LIST_IDX),
                     *[F.col(c) for c in carry], *fields)


def normalize_nested(df: DataFrame, table: str, max_nesting: int = 2,
                     carry: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Nested DataFrame -> {table: parent, table__list: child, ...}.

    ``df`` must carry a row id ``_dlt_id``.  ``carry`` columns (e.g. the
    tenant) are copied onto every child table."""
    out: dict[str, DataFrame] = {}

    def walk(frame: DataFrame, name: str, depth: int):
        scalars, lists = _split(frame.drop(*carry) if depth else frame, depth, max_nesting)
        base = frame.select(*scalars, *[F.col(c) for c in carry if depth and c in frame.columns])
        out[name] = base
        for n, c, _ in lists:
            child = explode_children(frame.select(F.col(ID), *[F.col(x) for x in carry], c.alias("_list")),
                                     F.col("_list"), f"{name}__{n}", ID, carry)
            walk(child, f"{name}__{n}", depth + 1)

    walk(df, table, 0)
    return out


def shared_columns(schemas: dict[str, T.StructType]) -> dict[str, dict[str, str]]:
    """{table: {column: its name in the rows of all tables}}: equal names of
    equal types share a column, so that a row has few to leave empty."""
    held: dict[str, list[T.DataType]] = {}
    out: dict[str, dict[str, str]] = {}
    for table, schema in schemas.items():
        out[table] = {}
        for f in schema.fields:
            kinds = held.setdefault(f.name, [])
            if f.dataType not in kinds:
                kinds.append(f.dataType)
            out[table][f.name] = f"_c{kinds.index(f.dataType)}_{f.name}"
    return out


def tagged_rows(df: DataFrame, table: str, max_nesting: int = 2, carry: tuple[str, ...] = ()) -> tuple[DataFrame, dict[str, T.StructType]]:
    """All rows of all tables of ``normalize_nested`` as one stream, from one
    read of ``df``: ``_table`` and the columns of all tables, of which a row
    fills those of its own (``shared_columns`` names them).  Also the tables'
    schemas, by name.
    """
    schemas = {name: frame.schema for name, frame in normalize_nested(df, table, max_nesting, carry).items()}
    shared = shared_columns(schemas)
    types = {own[f.name]: f.dataType for n, own in shared.items() for f in schemas[n].fields}
    kind = T.ArrayType(T.StructType([T.StructField("_table", T.StringType())] + [T.StructField(c, t) for c, t in types.items()]))

    def tagged(name: str, *row: Column) -> Column:
        # Columns come in the order of the table's schema.
        mine = dict(zip((shared[name][f.name] for f in schemas[name].fields), row, strict=True))
        return F.struct(F.lit(name).alias("_table"), *[mine.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()])

    def whole(rows: Column) -> Column:
        return F.coalesce(rows.cast(kind), F.array().cast(kind))

    def children(name: str, lists: Sequence[tuple[str, Column, T.DataType]], parent: Column, depth: int) -> list[Column]:
        """For each list column its rows, and those of the lists within it."""
        out = []
        for n, c, t in lists:
            path = f"{name}__{n}"

            def row_id(i: Column) -> Column:
                return F.md5(F.concat_ws("|", parent, F.lit(path), i.cast("string")))

            def leaves(e: Column) -> list[tuple[str, Column, T.DataType]]:
                return flat_columns(t.elementType, e) if isinstance(t.elementType, T.StructType) else [("value", e, t.elementType)]

            def row(e: Column, i: Column) -> Column:
                scalars, _ = _leaves(leaves(e), depth + 1, max_nesting)
                return tagged(path, row_id(i), parent, i.cast("bigint"), *scalars, *[F.col(x) for x in carry])

            out.append(whole(F.transform(c, row)))
            if any(_is_list(x, depth + 1, max_nesting) for _, _, x in leaves(F.lit(None))):
                def below(e: Column, i: Column) -> Column:
                    _, lists = _leaves(leaves(e), depth + 1, max_nesting)
                    return F.concat(*children(path, lists, row_id(i), depth + 1))

                out.append(whole(F.flatten(F.transform(c, below))))
        return out

    scalars, lists = _split(df, 0, max_nesting)
    rows = F.concat(F.array(tagged(table, *scalars)).cast(kind), *children(table, lists, F.col(ID), 0))
    return df.select(F.inline(rows)), schemas


def normalize_to(df: DataFrame, root: str, table: str, max_nesting: int = 2, carry: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The tables of ``normalize_nested``, written under ``root`` by one job
    that reads ``df`` once: every task writes its own rows of each table, no
    shuffle and no sort, as it keeps a writer open for each table (of small
    row groups, so that they fit in memory together).  Each frame reads its
    own table's files and columns only."""
    spark = df.sparkSession
    rows, schemas = tagged_rows(df, table, max_nesting, carry)
    with open_writers(spark, len(schemas)):
        (rows.write.partitionBy("_table").option("maxRecordsPerFile", 5_000_000).option("compression", "zstd")
             .option("parquet.block.size", 16 << 20).parquet(root))
    out = {}
    for name, columns in shared_columns(schemas).items():
        path, own = f"{root}/_table={name}", T.StructType([T.StructField(columns[f.name], f.dataType) for f in schemas[name].fields])
        frame = spark.read.schema(own).parquet(path) if exists(spark, path) else spark.createDataFrame([], own)
        out[name] = frame.select(*[F.col(_q(c)).alias(n) for n, c in columns.items()])
    return out
