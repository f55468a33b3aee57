"""Hive-layout lake readers and writers.

Layout (raw):  <root>/client=<slug>/entity=<table>/date=<yyyy-mm-dd>/part-*.parquet
Layout (ODS):  <root>/entity=<table>/part-*.parquet   (no client, no date)

Partition values are read as text (type inference off), so ``client=007``
stays "007" and dates arrive as text.  Column types may drift between files
(text in one, timestamp in another, columns that come later); a mixed read
fails in Spark, so ``read_raw_groups`` reads one frame per set of files whose
schemas agree, for the caller to cast and union.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators.frames import MissingTableError
from adlake.session import open_writers
from adlake.specs import KNOWN_ENTITIES

#: Partitions that a task of a raw write keeps open; rows of more are sorted.
OPEN_WRITERS = 16

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_dirs(spark: SparkSession, pattern: str) -> list[str]:
    """Directories matching a glob (listing only; no data read)."""
    p, fs = _fs(spark, pattern)
    st = fs.globStatus(p)
    return sorted(s.getPath().toString() for s in (st or []) if s.isDirectory())


def drop(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder that this job wrote and no longer reads."""
    p, fs = _fs(spark, folder)
    fs.delete(p, True)


def source_root(root: str, source: str) -> str:
    """The raw lake of one source, below the lake of all."""
    return f"{root}/source={source}"


def file_list(spark: SparkSession, root: str, entity: str | None = None) -> DataFrame:
    """Every raw file with its keys, size and place in the sorted list of its
    (client, entity).  From the listing alone: no file is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", root).load(f"{root}/client=*/entity={entity or '*'}")
    k = path_keys(F.col("path"))
    files = found.select("path", F.col("length").alias("bytes"), *[k[x].alias(x) for x in ("client", "entity", "date")])
    return files.withColumn("position", F.row_number().over(Window.partitionBy("client", "entity").orderBy("path")))


def write_raw(df: DataFrame, root: str, entity: str, load_id: str | Column | None = None,
              date_col: str = "date", client_col: str = "client", mode: str = "append", source: str | None = None,
              few: bool = False) -> None:
    """Append raw rows under client=/entity=/date=, below source= if one is
    named (then ``source_root`` is the root to read from); rows carry the load
    id.  ``few`` says that there are few partitions (one day of all tenants):
    then every task writes its rows to a file of each, and none is shuffled."""
    root = root if source is None else source_root(root, source)
    out = df.withColumn("entity", F.lit(entity))
    if load_id is not None and "_dlt_load_id" not in df.columns:
        out = out.withColumn("_dlt_load_id", load_id if isinstance(load_id, Column) else F.lit(load_id))
    if client_col != "client":
        out = out.withColumnRenamed(client_col, "client")
    if date_col != "date":
        out = out.withColumn("date", F.col(date_col).cast("string"))
    # Rebalance (not repartition) by the partition columns: rows of a
    # partition are clustered into few files, and AQE splits a hot
    # tenant-day into advisory-size pieces instead of funnelling it into one
    # task (and coalesces the many small ones).
    out = out if few else out.hint("rebalance", "client", "entity", "date")
    with open_writers(out.sparkSession, OPEN_WRITERS):
        (out.write.mode(mode).option("maxRecordsPerFile", 5_000_000).option("compression", "zstd")
            .option("parquet.block.size", 16 << 20).partitionBy("client", "entity", "date").parquet(root))


def read_raw(spark: SparkSession, root: str, entity: str | None = None,
             entities: Sequence[str] | None = KNOWN_ENTITIES) -> DataFrame:
    """Read the raw lake (all tenants).  ``client``, ``entity`` and ``date``
    come from the path.  One entity's files must agree; several are read
    each by itself, with all of their columns (``one_frame``).  The
    allow-list is part of the paths: folders of unknown entities (load state
    tables) are neither listed nor is their schema looked at."""
    if entity is not None:
        if not list_dirs(spark, f"{root}/client=*/entity={entity}"):
            raise MissingTableError(f"no raw partitions for {entity} under {root}")
        return spark.read.option("basePath", root).parquet(f"{root}/client=*/entity={entity}")
    wanted = list(entities) if entities else sorted({p.rsplit("entity=", 1)[1] for p in list_dirs(spark, f"{root}/client=*/entity=*")})
    there = [e for e in wanted if list_dirs(spark, f"{root}/client=*/entity={e}")]
    if not there:
        raise MissingTableError(f"no raw partitions for {wanted} under {root}")
    return one_frame([f for e in there for f in read_raw_groups(spark, root, e)])


def _files(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(p)
                  if s.isFile() and s.getPath().getName().endswith(".parquet"))


#: Where a Parquet footer keeps the schema that Spark wrote.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
#: Types a column may widen to without text (each to the ones after it).
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def footers(spark: SparkSession, folders: Sequence[str]) -> list[tuple[str, str, str | None]]:
    """(folder, file, schema as JSON) of every Parquet file in ``folders``, by
    one job whose tasks list folders and read footers, no data.  Where tasks
    can't open a folder or a footer has no Spark schema, the schema is None
    (and the file empty, if it was not listed)."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as afs
        from pyarrow import parquet as pq

        for batch in batches:
            out: list[tuple[str, str, str | None]] = []
            for folder in batch.column(0).to_pylist():
                try:
                    if folder.startswith("file:"):
                        store, at = afs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
                    else:
                        store, at = afs.FileSystem.from_uri(quote(folder, safe=":/@"))
                    files = sorted(x.base_name for x in store.get_file_info(afs.FileSelector(at)) if x.base_name.endswith(".parquet"))
                    for name in files:
                        with store.open_input_file(f"{at}/{name}") as f:
                            found = (pq.ParquetFile(f).schema_arrow.metadata or {}).get(_SPARK_SCHEMA)
                        out.append((folder, name, found and found.decode()))
                except (OSError, ValueError, pa.ArrowException):
                    out.append((folder, "", None))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in range(3)], names=["folder", "file", "schema"])

    n = min(len(folders), 8 * spark.sparkContext.defaultParallelism)
    listed = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(n)
    return sorted(tuple(r) for r in listed.mapInArrow(read, "folder string, file string, schema string").collect())


def _merged(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """Both schemas' columns, or None if a column's types differ."""
    types = {f.name: f.dataType for f in a.fields}
    if any(types.get(f.name, f.dataType) != f.dataType for f in b.fields):
        return None
    return T.StructType(a.fields + [f for f in b.fields if f.name not in types])


def agreeing(schemas: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Schemas (JSON) dealt into groups without conflicts, in the order given,
    each with its merged schema.  There are as many groups at most as
    schemas, whatever the number of files."""
    groups: list[tuple[T.StructType, list[str]]] = []
    for text in dict.fromkeys(schemas):
        own = T.StructType.fromJson(json.loads(text))
        for i, (have, members) in enumerate(groups):
            if (both := _merged(have, own)) is not None:
                groups[i] = (both, [*members, text])
                break
        else:
            groups.append((own, [text]))
    return groups


def read_raw_groups(spark: SparkSession, root: str, entity: str) -> list[DataFrame]:
    """Frames that together hold every file of ``entity``, each of files whose
    schemas agree: a column that appears later, in any tenant or on any day,
    is kept (NULL before), and a column whose type changes splits the files.

    One job maps the footers of all files; the few distinct schemas are dealt
    into groups, and each group is read with its merged schema, so planning a
    read looks at no file again and no merge is tried that may fail."""
    days = list_dirs(spark, f"{root}/client=*/entity={entity}/date=*")
    if not days:
        raise MissingTableError(f"no raw partitions for entity={entity} under {root}")
    found = footers(spark, days)
    if not found:
        raise MissingTableError(f"no files for entity={entity} under {root}")
    if any(schema is None for *_, schema in found):
        return _probed(spark, root, days)
    of: dict[str, set[str]] = {}
    for folder, _, schema in found:
        of.setdefault(folder, set()).add(schema)
    keys = [T.StructField(k, T.StringType()) for k in ("client", "entity", "date")]
    frames = []
    for merged, members in agreeing([schema for *_, schema in found]):
        # A folder of one group is read as a folder, a mixed one by its files.
        paths = sorted({folder if of[folder] <= set(members) else f"{folder}/{file}" for folder, file, schema in found if schema in members})
        own = T.StructType([f for f in merged.fields if f.name not in ("client", "entity", "date")] + keys)
        frames.append(spark.read.option("basePath", root).schema(own).parquet(*paths))
    return frames


def _probed(spark: SparkSession, root: str, days: list[str]) -> list[DataFrame]:
    """As ``read_raw_groups``, where tasks can't read footers: Spark merges
    them over all folders at once, and only where schemas conflict are the
    folders halved and tried again, down to single files."""
    def merged(paths: list[str]) -> DataFrame | None:
        try:
            return spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*paths)
        except (PySparkException, Py4JJavaError) as e:
            if "CANNOT_MERGE" not in str(e):
                raise
            return None

    def apart(paths: list[str]) -> list[tuple[DataFrame, list[str]]]:
        df = merged(paths)
        if df is not None:
            return [(df, paths)]
        if len(paths) == 1:
            return apart(_files(spark, paths[0]))
        half = len(paths) // 2
        return apart(paths[:half]) + apart(paths[half:])

    # Neighbouring groups may agree again: join them as long as their schemas merge.
    groups: list[tuple[DataFrame, list[str]]] = []
    for df, paths in apart(days):
        for i, (_, have) in enumerate(groups):
            both = merged(have + paths)
            if both is not None:
                groups[i] = (both, have + paths)
                break
        else:
            groups.append((df, paths))
    return [df for df, _ in groups]


def _common(types: Sequence[T.DataType]) -> T.DataType:
    """The type that all of ``types`` widen to: the widest number, else text."""
    names = {t.simpleString() for t in types}
    if len(names) == 1:
        return types[0]
    if names <= set(_NUMBERS):
        return max(types, key=lambda t: _NUMBERS.index(t.simpleString()))
    return T.StringType()


def one_frame(frames: Sequence[DataFrame]) -> DataFrame:
    """Frames of drifting schemas as one: columns by name, NULL where a frame
    has none, at the type that all of a column's types widen to."""
    types: dict[str, list[T.DataType]] = {}
    for f in frames:
        for x in f.schema.fields:
            types.setdefault(x.name, []).append(x.dataType)
    wide = {n: _common(t) for n, t in types.items()}
    out = None
    for f in frames:
        f = f.select(*[F.col(f"`{c}`").cast(wide[c]).alias(c) for c in f.columns])
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def write_ods(df: DataFrame, root: str, entity: str, target_file_rows: int = 5_000_000) -> str:
    """Replace one ODS entity wholesale (no client/date partition).  The new
    table is written aside and swapped in by renames when it is whole; a
    failed write leaves the old one as it was."""
    spark = df.sparkSession
    path = f"{root}/entity={entity}"
    aside = f"{root}/_staging/{entity}-{uuid.uuid4().hex[:12]}"
    df.write.option("maxRecordsPerFile", target_file_rows).option("compression", "zstd").parquet(f"{aside}/new")
    final, fs = _fs(spark, path)
    new, old = _fs(spark, f"{aside}/new")[0], _fs(spark, f"{aside}/old")[0]
    had = fs.exists(final)
    if had and not fs.rename(final, old):
        raise RuntimeError(f"could not set the old {path} aside")
    if not fs.rename(new, final):
        if had:
            fs.rename(old, final)
        raise RuntimeError(f"could not put the new {path} in place")
    fs.delete(_fs(spark, aside)[0], True)
    return path


def read_ods(spark: SparkSession, root: str, entity: str) -> DataFrame:
    path = f"{root}/entity={entity}"
    from adlake.session import exists
    if not exists(spark, path):
        raise MissingTableError(f"ODS entity not found: {path}")
    return spark.read.parquet(path)


def write_replace_window(df: DataFrame, root: str, partition_cols: Sequence[str]) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    (df.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).parquet(root))


def write_partitioned(df: DataFrame, root: str, partition_cols: Sequence[str], mode: str = "append") -> None:
    """Hive-partitioned write, rebalanced by the partition columns (AQE
    splits skewed partitions, coalesces small ones)."""
    (df.hint("rebalance", *partition_cols).write.mode(mode).option("maxRecordsPerFile", 5_000_000)
       .partitionBy(*partition_cols).parquet(root))


def path_keys(path: Column) -> Column:
    """``key=value`` path segments of a file path as a map<string,string>."""
    segs = F.filter(F.split(path, "/"), lambda s: s.contains("="))
    return F.map_from_entries(F.transform(
        segs, lambda s: F.struct(F.substring_index(s, "=", 1).alias("key"),
                                 F.regexp_extract(s, "^[^=]+=(.*)$", 1).alias("value"))))
