"""A keyed Parquet table whose files are never changed, only replaced.

Layout::

    <root>/data/<id>/_slot=<hash>/part-*.parquet     rows, sorted by key within a slot
    <root>/_snapshots/v=<n>/*.parquet                 the files of version n with their key ranges

A merge looks up which files may hold one of the batch's keys (its slot and
key range), reads and rewrites those alone, and lists all other files in the
new snapshot as they are.  A snapshot is written aside and becomes visible by
one rename; a reader lists the snapshots, takes the newest and reads its
files, so it sees one whole version, also while a merge runs.  The last
``keep`` versions stay readable; files that none of them names are deleted.

Work and memory: a merge reads, moves and writes the touched files and the
list of files; the driver holds the paths of touched, deleted or read files.
There is one writer at a time (a second one that commits the same version
gets an error).  Rows of a slot that outgrow a file are split, so a hot slot
is many files and many tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.joins import sized_broadcast

#: Files of a listing that are sent to every task of a merge; beyond, the join shuffles.
SENT_FILES = 200_000


class SnapshotTable:
    """``keys``: the columns that a row is found by; ``slot``: columns or
    expressions of them whose values share files (a tenant, a day, a bucket
    of a hash)."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], slot: Sequence[Column | str], file_rows: int = 1_000_000, keep: int = 2):
        self.spark, self.root, self.keys, self.file_rows, self.keep = spark, root.rstrip("/"), list(keys), file_rows, keep
        self._slot = F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in slot])
        self._key = F.struct(*self.keys)
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ reading
    def versions(self) -> list[int]:
        p = self._Path(f"{self.root}/_snapshots")
        if not self._fs.exists(p):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(p) if s.isDirectory()]
        return sorted(int(n[2:]) for n in names if n.startswith("v="))

    def files(self, version: int | None = None) -> DataFrame | None:
        """(file, slot, low, high, n_rows) of a version (the newest, if not given)."""
        if version is None:
            there = self.versions()
            if not there:
                return None
            version = there[-1]
        return self.spark.read.parquet(f"{self.root}/_snapshots/v={version:012d}")

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version; None if there is none or it has no rows."""
        listed = self.files(version)
        return None if listed is None else self._rows([r["file"] for r in listed.select("file").collect()])

    def _rows(self, files: Sequence[str]) -> DataFrame | None:
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in sorted(files)]) if files else None

    # ------------------------------------------------------------ writing
    def touched(self, delta: DataFrame, version: int | None = None) -> list[str]:
        """Files of a version (the newest, if not given) that may hold a key of ``delta``."""
        listed = self.files(version)
        if listed is None:
            return []
        found = delta.select(self._slot.alias("_s"), self._key.alias("_k"))
        listed = sized_broadcast(listed.select("file", "slot", "low", "high"), SENT_FILES)
        hit = (F.col("_s") == F.col("slot")) & (F.col("_k") >= F.col("low")) & (F.col("_k") <= F.col("high"))
        return [r["file"] for r in found.join(listed, hit).select("file").distinct().collect()]

    def merge(self, delta: DataFrame, combine: Callable[[DataFrame | None, DataFrame], DataFrame]) -> int:
        """Commit ``combine(rows of the touched files, delta)`` in place of
        those files; returns the new version.  ``delta`` is read more than
        once, so it should be staged or persisted."""
        there = self.versions()
        old = self.touched(delta, there[-1]) if there else []
        return self._commit(combine(self._rows(old), delta), old, there)

    def replace(self, rows: DataFrame) -> int:
        """Commit ``rows`` as the whole table."""
        return self._commit(rows, None, self.versions())

    def _commit(self, rows: DataFrame, gone: Sequence[str] | None, there: Sequence[int]) -> int:
        """The version after those ``there``: all their files but ``gone`` (None: all), and ``rows``."""
        before = self.files(there[-1]) if there and gone is not None else None
        version = there[-1] + 1 if there else 0
        part = f"data/{version:012d}-{uuid.uuid4().hex[:12]}"
        (rows.withColumn("_slot", self._slot).hint("rebalance", "_slot").sortWithinPartitions("_slot", *self.keys)
             .write.option("maxRecordsPerFile", self.file_rows).partitionBy("_slot").parquet(f"{self.root}/{part}"))
        written = self.spark.read.schema(rows.schema).parquet(f"{self.root}/{part}")
        path = F.regexp_extract(F.col("_metadata.file_path"), "(data/[^/]+/_slot=[^/]+/[^/]+)$", 1)
        entries = (written.select(path.alias("file"), self._slot.alias("slot"), self._key.alias("_k"))
                   .groupBy("file", "slot").agg(F.min("_k").alias("low"), F.max("_k").alias("high"), F.count(F.lit(1)).alias("n_rows")))
        if before is not None:
            stays = before
            if gone:
                stays = before.join(self.spark.createDataFrame([(f,) for f in gone], "file string"), "file", "left_anti")
            entries = entries.unionByName(stays)
        aside = f"{self.root}/_snapshots/_new-{uuid.uuid4().hex[:12]}"
        entries.coalesce(1 + (len(gone or ()) + 1) // SENT_FILES).write.parquet(aside)
        final = self._Path(f"{self.root}/_snapshots/v={version:012d}")
        if self._fs.exists(final) or not self._fs.rename(self._Path(aside), final):
            raise RuntimeError(f"version {version} of {self.root} was committed by another writer")
        self._clean()
        return version

    def _clean(self) -> None:
        """Delete versions beyond the last ``keep``, and the files that only they name."""
        there = self.versions()
        dropped, kept = there[:-self.keep], there[-self.keep:]
        if not dropped:
            return
        named = lambda versions: self.spark.read.parquet(*[f"{self.root}/_snapshots/v={v:012d}" for v in versions]).select("file")
        for r in named(dropped).distinct().join(named(kept), "file", "left_anti").collect():
            self._fs.delete(self._Path(f"{self.root}/{r['file']}"), False)
        for v in dropped:
            self._fs.delete(self._Path(f"{self.root}/_snapshots/v={v:012d}"), True)
