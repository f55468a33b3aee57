"""Best-fit packing with large-item matching (operator 3).

Documents become token ids and a closing id; one longer than the capacity is
cut into pieces of the capacity, the first of which may be shorter.

Only lengths decide how pieces share sequences, so the packing is planned on
the exact histogram of lengths (at most ``capacity`` rows, whatever the
corpus) and then applied to the pieces by their rank among those of their
length:

* *Large items*, above a third of the capacity, can stand at most twice in a
  sequence.  Those above half take, longest first, the longest partner that
  still fits (greedy matching); large ones of at most half that are left
  over pair among themselves, and a last one may stand alone.
* *Small items*, longest first, go where they leave the least gap (best fit);
  a new sequence is opened only when no gap is large enough, and filled the
  same way.

The plan is a list of groups of equal sequences, each with its lengths: every
step handles all equal gaps or equal items at once, so its size is bounded by
the capacity and not by the corpus.  Ranks come from a window over (length,
salt) with the counts of the salts before, so no task holds all pieces of one
length.

Defined results: a null or empty text is one piece of the closing id alone; a
very long one is as many pieces as it needs; repeated rows, also of one id or
none, are pieces of their own (which of several equal pieces stands where is
not fixed); lengths that tie are taken in any order; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import partitions, stage
from adlake.llm.tokens import encode_documents

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def document_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """The pieces of every row (null text: empty, so the closing id alone),
    with their ids if asked for."""

    def cut(ids: np.ndarray) -> list[tuple]:
        if end_id is not None:
            ids = np.append(ids, np.uint32(end_id))
        first = (len(ids) - 1) % capacity + 1
        edges = [0, *range(first, len(ids) + 1, capacity)]
        return [(i, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes()), ids[a:b].tolist() if keep_ids else None) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, pieces in encode_documents(batches, tokenizer, cut):
            rows = [(name, *x) for name, mine in zip(names, pieces, strict=True) for x in mine]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            cells = [pa.array(c, t) for c, t in zip(columns, types, strict=True)][: 5 + keep_ids]
            yield pa.RecordBatch.from_arrays(cells, names=[x.split()[0] for x in (PIECES + ", ids array").split(", ")][: 5 + keep_ids])

    schema = PIECES + (", ids array<long>" if keep_ids else "")
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


class _Gaps:
    """Groups of equal sequences by what they have left."""

    def __init__(self) -> None:
        self.sizes: list[int] = []
        self.groups: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)

    def add(self, gap: int, times: int, lengths: list[int]) -> None:
        if gap not in self.groups or not self.groups[gap]:
            insort(self.sizes, gap)
        self.groups[gap].append((times, lengths))

    def least(self, size: int) -> int | None:
        at = bisect_left(self.sizes, size)
        return self.sizes[at] if at < len(self.sizes) else None

    def take(self, gap: int, most: int) -> tuple[int, list[int]]:
        times, lengths = self.groups[gap].pop()
        if times > most:
            self.groups[gap].append((times - most, lengths))
            times = most
        elif not self.groups[gap]:
            self.sizes.remove(gap)
        return times, lengths


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(sequences, lengths in each) that hold ``histogram[length]`` pieces of each length."""
    left = dict(histogram)
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a piece has between 1 and capacity tokens")
    gaps = _Gaps()
    lengths = sorted(left, reverse=True)
    large = [n for n in lengths if 3 * n > capacity]
    half = [n for n in large if 2 * n <= capacity]  # in descending order

    for n in (x for x in large if 2 * x > capacity):
        while left[n]:
            mate = next((m for m in half if left[m] and m + n <= capacity), None)
            if mate is None:
                gaps.add(capacity - n, left[n], [n])
                left[n] = 0
            else:
                k = min(left[n], left[mate])
                gaps.add(capacity - n - mate, k, [n, mate])
                left[n] -= k
                left[mate] -= k
    alone = 0  # an odd one of a length waits for the next length
    for n in half:
        if alone and left[n]:
            gaps.add(capacity - alone - n, 1, [alone, n])
            left[n] -= 1
            alone = 0
        if left[n] // 2:
            gaps.add(capacity - 2 * n, left[n] // 2, [n, n])
        if left[n] % 2:
            alone = n
        left[n] = 0
    if alone:
        gaps.add(capacity - alone, 1, [alone])

    for n in (x for x in lengths if 3 * x <= capacity):
        while left[n]:
            gap = gaps.least(n)
            if gap is None:
                each = min(capacity // n, left[n])
                times = left[n] // each
                gaps.add(capacity - each * n, times, [n] * each)
                left[n] -= times * each
                continue
            # The best gap takes as many of this length as it holds, while there are enough.
            times, mine = gaps.take(gap, left[n])
            each = min(gap // n, left[n] // times)
            gaps.add(gap - each * n, times, mine + [n] * each)
            left[n] -= times * each
    return [x for g in sorted(gaps.groups) for x in gaps.groups[g]]


def slots(planned: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, first sequence, copies, offset): copy ``c`` of sequence
    ``first + s`` at a length's rank ``first rank + s * copies + c`` begins at ``offset + c * length``."""
    used: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for times, lengths in planned:
        offset, at = 0, 0
        while at < len(lengths):
            n = lengths[at]
            copies = 1
            while at + copies < len(lengths) and lengths[at + copies] == n:
                copies += 1
            out.append((n, used[n], times * copies, sequence, copies, offset))
            used[n] += times * copies
            offset += n * copies
            at += copies
        sequence += times
    return out


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (with doc_id, piece, length) and their sequence_id and offset.

    Ties of length rank by salt, document and piece; rows that are equal in all
    of their columns are interchangeable, so ranks survive recomputation.  No
    pieces: no rows.
    """
    spark = pieces.sparkSession
    order = [c for c, t in pieces.dtypes if c not in ("length",) and not t.startswith(("map", "variant"))]
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(partitions(spark))).cast("int"))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    table = spark.createDataFrame(slots(plan(histogram, capacity)), "length long, first_rank long, ranks long, first_sequence long, copies long, at long")
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    mine = Window.partitionBy("length", "salt").orderBy(*order)
    ranked = salted.withColumn("rank", F.row_number().over(mine) - 1).join(counts, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before", "salt")
    # The plan has at most a few rows for each length: bounded by the capacity, so it is sent to every task.
    runs = table.groupBy("length").agg(F.sort_array(F.collect_list(F.struct("first_rank", "ranks", "first_sequence", "copies", "at"))).alias("runs"))
    found = ranked.join(F.broadcast(runs), "length").withColumn("run", F.expr("filter(runs, x -> x.first_rank <= rank and rank < x.first_rank + x.ranks)[0]")).drop("runs")
    step = F.col("rank") - F.col("run.first_rank")
    return found.select(
        *[F.col(c) for c in pieces.columns],
        (F.col("run.first_sequence") + F.floor(step / F.col("run.copies"))).cast("long").alias("sequence_id"),
        (F.col("run.at") + (step % F.col("run.copies")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int, end_id: int | None = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in as few sequences as the method finds; token
    ids are made once and the pieces' lengths kept in the shared folder."""
    return pack_pieces(stage(document_pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "pieces"), capacity)
