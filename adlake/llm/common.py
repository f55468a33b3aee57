"""Helpers shared by the corpus operators: staged tables, batch slicing,
byte hashing and connected components.

Lineage is cut by tables written to the shared folder named in
``spark.checkpoint.dir`` (never ``localCheckpoint``), so a lost executor costs
a re-read, not a recomputation of the whole job.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import scratch_dir

U64 = np.uint64
#: Bytes of text that one NumPy pass works on; a longer document is a pass of its own.
PASS_BYTES = 1 << 20
#: The word separators of the corpus contracts: space, tab .. carriage return.
SPACES = " \t\n\x0b\x0c\r"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint dir, read it back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._staged_at = path  # the frame alone knows its folder: none is kept alive by a list of all
    return back


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables.  Only for those whose readers have all been
    written themselves: nothing may have to read them again."""
    for df in frames:
        path = df.__dict__.pop("_staged_at", None)
        if path is not None:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Shuffle files of jobs that have ended go now: Spark's cleaner removes
    them when the driver collects its garbage, which it may long not do."""
    gc.collect()  # frames of ours hold the JVM's
    spark.sparkContext._jvm.System.gc()


def marked_by(rows: DataFrame, ids: DataFrame, id_col: str = "__id") -> DataFrame:
    """``rows`` without most of those whose id is not in ``ids``: none with one
    of the ids is lost, about one in eight of the others stays.

    Ids are hashed to at least eight bits each; the set bits, by words of 64,
    are sent to every task.  At most 2**20 words are (8 MB of bits), so from
    eight million ids on fewer and fewer rows go, down to none; the exact join
    is to follow in any case.
    """
    n = ids.count()
    words = 1 << max(4, min(20, (8 * n // 64).bit_length()))
    bit = F.pmod(F.xxhash64(F.col(id_col)), F.lit(64 * words))
    word, place = F.shiftright(bit, 6).cast("int"), F.pmod(bit, F.lit(64)).cast("int")
    mask = ids.select(word.alias("__word"), place.alias("__place")).groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, __place)")).alias("__mask"))
    held = rows.withColumn("__word", word).withColumn("__place", place).join(F.broadcast(mask), "__word")
    return held.where(F.expr("shiftright(__mask, __place) & 1L = 1")).select(*rows.columns)


def partitions(spark: SparkSession) -> int:
    """The shuffle width that the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply and xor-shift)."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def key64(data: bytes) -> int:
    """A signed 64-bit digest of ``data``."""
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def passes(sizes: np.ndarray, limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to about ``limit`` at most
    (a single larger item is a range of its own)."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if len(sizes) > start:
        yield start, len(sizes)


def texts_as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string or binary column; a null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [b"" if x is None else x for x in column.to_pylist()]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 40) -> DataFrame:
    """(node, root), staged: the smallest node that each node of ``edges`` reaches.

    Alternating large-star and small-star rounds: every round is two
    aggregations by node, each edge set is written to the shared folder, and
    rounds end when the edges no longer change (checked by a sum of hashes,
    one row).  A hub is split by partial aggregation; no component is ever
    gathered in one task.
    """
    spark = edges.sparkSession
    e = stage(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), "cc-edges")

    def mark(x: DataFrame):
        r = x.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return r["n"], r["h"]

    before = mark(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        low2 = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low2, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low2.select("a", F.col("m").alias("b")))
        last, e = e, stage(small.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
        unstage(last)
        after = mark(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not converge")
    roots = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    ends = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct().join(roots, "node", "left_anti")
    found = stage(roots.unionByName(ends).distinct(), "cc-roots")
    unstage(e)
    return found




def unpack(blobs: list[bytes], dtype) -> np.ndarray:
    """The arrays packed in ``blobs``, end to end."""
    return np.frombuffer(b"".join(blobs), dtype)


def arrow(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))
