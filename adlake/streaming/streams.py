"""Structured Streaming versions of the pointer sync, the late-attribution
restatement and the rate-limit telemetry.

All three keep their state in a ``SnapshotTable``: a micro-batch rewrites the
files that may hold its keys (pointers by client, restated insights by day,
telemetry by a bucket of the run), readers see one whole version, and old
versions are cleaned up.  A replayed batch merges the same rows again, so it
converges to the same state.  Checkpoints go to the shared checkpoint folder;
sources are file streams with a fixed schema (no inference per batch).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators.assets import pointer_state
from adlake.operators.frames import load_window, null_safe_join, upsert
from adlake.operators.telemetry import finished_rollup, merged_rollup, partial_rollup, signals
from adlake.sources.snapshots import SnapshotTable

def _run_available_now(stream: DataFrame, batch_fn: Callable[[DataFrame, int], None], checkpoint: str,
                       output_mode: str = "append") -> None:
    q = (stream.writeStream.foreachBatch(batch_fn).outputMode(output_mode)
               .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _merge_batches(stream: DataFrame, table: SnapshotTable, checkpoint: str, delta_of: Callable[[DataFrame], DataFrame],
                   combine: Callable[[DataFrame | None, DataFrame], DataFrame]) -> None:
    """Merge what each micro-batch says into ``table``; empty ones change nothing."""
    def batch(df: DataFrame, batch_id: int) -> None:
        delta = delta_of(df).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not delta.isEmpty():
                table.merge(delta, combine)
        finally:
            delta.unpersist()

    _run_available_now(stream, batch, checkpoint)


POINTER_KEYS = ("client_uid", "creative_id", "asset_kind")


def pointer_table(spark: SparkSession, state_root: str, keys: Sequence[str] = POINTER_KEYS, client_col: str = "client_uid", pieces: int = 4) -> SnapshotTable:
    """Pointers by client, each client in ``pieces`` by hash of its keys."""
    return SnapshotTable(spark, state_root, keys, [client_col, F.pmod(F.xxhash64(*keys), F.lit(pieces))])


def pointer_sync(spark: SparkSession, manifest_dir: str, schema: T.StructType, state_root: str,
                 checkpoint: str, keys: Sequence[str] = POINTER_KEYS, client_col: str = "client_uid") -> None:
    """New manifest files -> pointer state upsert (newest row per asset, last
    non-empty digest carried).  A batch that touches one creative rewrites the
    files that may hold it, not its client's others."""
    src = spark.readStream.schema(schema).parquet(manifest_dir)

    def combine(base: DataFrame | None, delta: DataFrame) -> DataFrame:
        return pointer_state(delta if base is None else base.unionByName(delta.select(*base.columns)), keys)

    _merge_batches(src, pointer_table(spark, state_root, keys, client_col), checkpoint, lambda df: df, combine)


def read_pointers(spark: SparkSession, state_root: str) -> DataFrame:
    return pointer_table(spark, state_root).read()


def restated_table(spark: SparkSession, state_root: str, keys: Sequence[str], date_col: str) -> SnapshotTable:
    """Restated rows by day; within a day files are sorted by key."""
    return SnapshotTable(spark, state_root, keys, [F.date_format(F.col(date_col), "yyyy-MM-dd")])


def restatement(spark: SparkSession, landing_dir: str, schema: T.StructType, state_root: str,
                checkpoint: str, keys: Sequence[str], order: Sequence[Column], date_col: str,
                days: int, load_cols: Sequence[str]) -> None:
    """Each load restates its last ``days`` days, counted from the newest day
    of that (tenant, load), so a lagging tenant restates its own window: rows
    there are merged on ``keys`` (latest by ``order`` wins); older rows of the
    load are ignored.  Not a watermark: old keys are updated in place.  A
    batch rewrites the files of its days that may hold its keys."""
    src = spark.readStream.schema(schema).parquet(landing_dir)

    def combine(base: DataFrame | None, delta: DataFrame) -> DataFrame:
        return upsert(delta.limit(0) if base is None else base, delta, keys, order)

    _merge_batches(src, restated_table(spark, state_root, keys, date_col), checkpoint, lambda df: load_window(df, date_col, days, load_cols), combine)


def read_restated(spark: SparkSession, state_root: str, keys: Sequence[str], date_col: str) -> DataFrame:
    return restated_table(spark, state_root, keys, date_col).read()


#: The landed file that a partial comes from: with the run, a partial's key.
SOURCE = "_source"


def telemetry_table(spark: SparkSession, state_root: str, run_key: str = "run_id", buckets: int = 16) -> SnapshotTable:
    return SnapshotTable(spark, state_root, [run_key, SOURCE], [F.pmod(F.xxhash64(run_key), F.lit(buckets))])


def ratelimit_stream(spark: SparkSession, landing_dir: str, schema: T.StructType, state_root: str,
                     checkpoint: str, run_key: str = "run_id", identity: Sequence[str] = ()) -> None:
    """Streaming per-run telemetry.  The state holds mergeable partials by
    (run, landed file): a trigger aggregates its own responses and merges them
    into the files that may hold its runs, whatever number of runs there is.
    Partials of a file replace those of the same file, so a replay, also
    under a new checkpoint, counts no response twice."""
    src = spark.readStream.schema(schema).parquet(landing_dir).withColumn(SOURCE, F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1))

    def combine(base: DataFrame | None, delta: DataFrame) -> DataFrame:
        if base is None:
            return delta
        same = delta.select(F.col(run_key).alias(f"_k_{run_key}"), F.col(SOURCE).alias(f"_k_{SOURCE}"))
        return null_safe_join(base, same, [run_key, SOURCE], "left_anti").unionByName(delta)

    def delta_of(df: DataFrame) -> DataFrame:
        return partial_rollup(signals(df, run_key, keep=[SOURCE, *identity]), [run_key, SOURCE, *identity])

    _merge_batches(src, telemetry_table(spark, state_root, run_key), checkpoint, delta_of, combine)


def read_telemetry(spark: SparkSession, state_root: str, run_key: str = "run_id", identity: Sequence[str] = ()) -> DataFrame:
    """One row for each run, from its partials."""
    return finished_rollup(merged_rollup(telemetry_table(spark, state_root, run_key).read(), [run_key, *identity]), run_key, identity)
