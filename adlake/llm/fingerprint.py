"""Improbable-feature digests of documents (operator 9).

Features are the windows of 64 bytes.  A window's rank is the rarity of its
entropy: the share of the corpus' windows with that entropy (in 1/16 bits),
counted over all documents, so improbable windows rank first.  Every run of 64
neighbouring windows votes for its lowest-ranked one (leftmost on ties); those
with at least 16 votes are selected.  Selected features go into a chain of
Bloom filters of 2,048 bits, five bits each and at most 160 features a filter.

Two digests are compared filter by filter: the common bits of a pair, less
what filters of that many bits have in common by chance, over the most they
could have; each filter of the shorter chain takes its best partner, and the
mean is the likeness.

A digest is text: ``features:filter:filter...`` in hex.  Defined results: in a
text of fewer than 256 bytes every window of 8 bytes is a feature, too; a text
without any feature has itself as its one; a null or empty text has the empty digest, which is like itself
(1) and unlike any other (0); equal texts have equal digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import U64, arrow, mix64, partitions, passes, texts_as_bytes
from adlake.llm.repeats import substring_hashes

WINDOW, RUN, VOTES = 64, 64, 16
BITS, HASHES, PER_FILTER = 2048, 5, 160
SHORT, SHORT_WINDOW = 256, 8
#: Entropies of a 64-byte window go from 0 to 6 bits.
CLASSES = 6 * 16 + 1
_SCALE = 1 << 20
_C_LOG_C = np.array([0] + [round(c * np.log2(c) * _SCALE) for c in range(1, WINDOW + 1)], np.int64)
_POP = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def entropy_classes(data: np.ndarray) -> np.ndarray:
    """The entropy class of each window of ``data``, which may be several texts end to end.

    H = log2 64 - sum(c log2 c) / 64 over the byte counts c of the window.
    The sum changes by the counts of the byte that leaves and the one that
    comes; both are counted by comparing the data with itself at 63 lags.
    """
    n = len(data) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.uint8)
    ahead = np.ones(len(data), np.uint8)  # equal bytes among the 64 from a place on
    behind = np.zeros(len(data), np.uint8)  # among the 63 before it
    for lag in range(1, WINDOW):
        same = (data[:-lag] == data[lag:]).view(np.uint8)
        ahead[:-lag] += same
        behind[lag:] += same
    first = np.bincount(data[:WINDOW], minlength=256)
    total = np.empty(n, np.int64)
    total[0] = _C_LOG_C[first].sum()
    if n > 1:
        gone, come = ahead[: n - 1], behind[WINDOW:]
        step = _C_LOG_C[gone - 1] - _C_LOG_C[gone] + _C_LOG_C[come + 1] - _C_LOG_C[come]
        # The window slides: the leaving byte goes first, so the coming one is counted without it.
        total[1:] = total[0] + np.cumsum(step)
    bits = 6 * _SCALE - total // WINDOW
    return np.clip(bits * 16 // _SCALE, 0, CLASSES - 1).astype(np.uint8)


def _inside(sizes: np.ndarray, count: int, width: int) -> np.ndarray:
    """Which of the first ``count`` places begin ``width`` places within one text."""
    ends = np.cumsum(sizes)
    ok = np.ones(count, bool)
    for a, b in zip(np.maximum(ends - width + 1, ends - sizes).tolist(), ends.tolist(), strict=True):
        ok[a:b] = False
    return ok


def entropy_histogram(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Windows of each entropy class over all documents (97 numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CLASSES, np.int64)
        for batch in batches:
            texts = texts_as_bytes(batch.column(0))
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            for a, b in passes(sizes, 1 << 18):
                cls = entropy_classes(np.frombuffer(b"".join(texts[a:b]), np.uint8))
                counts += np.bincount(cls[_inside(sizes[a:b], len(cls), WINDOW)], minlength=CLASSES)
        yield arrow({"class": (np.arange(CLASSES), pa.int32()), "windows": (counts, pa.int64())})

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "class int, windows long").groupBy("class").agg(F.sum("windows").alias("windows")).collect()
    out = np.zeros(CLASSES, np.int64)
    for r in rows:
        out[r["class"]] = r["windows"]
    return out


def ranks(histogram: np.ndarray) -> np.ndarray:
    """Rank of each entropy class, the rarest (that occurs) first."""
    order = np.lexsort((np.arange(CLASSES), histogram))
    out = np.empty(CLASSES, np.int64)
    out[order] = np.arange(CLASSES)
    return out


def features(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Hashes of the selected features of each text, in order of place."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out: list[np.ndarray] = []
    for a, b in passes(sizes, 1 << 18):
        joined = b"".join(texts[a:b])
        found = [np.zeros(0, np.uint64)] * (b - a)
        if len(joined) >= WINDOW:
            data = np.frombuffer(joined, np.uint8)
            cls = entropy_classes(data)
            ok = _inside(sizes[a:b], len(cls), WINDOW)
            key = np.where(ok, rank[cls], CLASSES) << 32 | np.arange(len(cls))
            if len(key) >= RUN:
                least, n = key, 1
                while n < RUN:
                    least, n = np.minimum(least[:-n], least[n:]), 2 * n
                # Runs count within one text: their first and last windows belong to it.
                inside = _inside(sizes[a:b], len(least), WINDOW + RUN - 1)
                vote = (least[inside] & 0xFFFFFFFF).astype(np.int64)
                at = np.flatnonzero(np.append(True, vote[1:] != vote[:-1])) if len(vote) else np.zeros(0, np.int64)
                votes = np.diff(np.append(at, len(vote)))
                chosen = vote[at][votes >= VOTES] if len(vote) else vote
                hashes = mix64(substring_hashes(data, WINDOW)[chosen])
                owner = np.searchsorted(np.cumsum(sizes[a:b]), chosen, side="right")
                ends = np.searchsorted(owner, np.arange(b - a + 1))
                found = [hashes[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]
        out.extend(found)
    for i in np.flatnonzero((sizes >= SHORT_WINDOW) & (sizes < SHORT)).tolist():
        every = mix64(substring_hashes(np.frombuffer(texts[i], np.uint8), SHORT_WINDOW) + U64(SHORT))
        out[i] = np.concatenate([out[i], np.unique(every)])
    for i, (text, f) in enumerate(zip(texts, out, strict=True)):
        if text and not len(f):
            out[i] = np.array([int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")], np.uint64)
    return out


def filters(found: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters, a row of bytes each."""
    chain = -(-len(found) // PER_FILTER)
    bits = np.zeros((chain, BITS), bool)
    row = np.arange(len(found)) // PER_FILTER
    for i in range(HASHES):
        bits[row, (found >> U64(11 * i)) & U64(BITS - 1)] = True
    return np.packbits(bits, axis=1)


def digest(found: np.ndarray) -> str:
    if not len(found):
        return ""
    return f"{len(found)}:" + ":".join(x.tobytes().hex() for x in filters(found))


def parse(text: str) -> np.ndarray:
    parts = text.split(":")[1:]
    return np.frombuffer(bytes.fromhex("".join(parts)), np.uint8).reshape(len(parts), BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1, of two chains of filters."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    ones_a, ones_b = _POP[a].sum(1, dtype=np.int64), _POP[b].sum(1, dtype=np.int64)
    scores = np.empty(len(a))
    for i, row in enumerate(a):
        common = _POP[b & row].sum(1, dtype=np.int64)
        most = np.minimum(ones_a[i], ones_b)
        # What two sets of so many bits share by chance, and three deviations more.
        chance = ones_a[i] * ones_b / BITS
        chance = np.minimum(chance + 3 * np.sqrt(chance * (1 - ones_b / BITS)), most - 1)
        scores[i] = np.clip((common - chance) / (most - chance), 0, 1).max()
    return float(scores.mean())


def likeness_of(a: str, b: str) -> float:
    """The likeness of two digests."""
    if a == b:
        return 1.0
    return likeness(parse(a) if a else np.zeros((0, BITS // 8), np.uint8), parse(b) if b else np.zeros((0, BITS // 8), np.uint8))


def fingerprint(docs: DataFrame, rank: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_as_bytes(batch.column(1))
            yield arrow(
                {
                    "id": (batch.column(0).to_pylist(), pa.int64()),
                    "n_chars": ([len(x.decode()) for x in texts], pa.int64()),
                    "fingerprint": ([digest(f) for f in features(texts, rank)], pa.string()),
                }
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "id long, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


NO_ID = -(1 << 63)


def edit_likeness(docs: DataFrame, rank: np.ndarray, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """Every document's digest, that of its edited text, and its likeness to that and to the next document.

    The next document is that of the next id (ties: by text; null ids first),
    after the last the first.  Documents are dealt by ranges of id, whose
    bounds are quantiles of the ids, in one exchange, and sorted.  A range
    needs one document more, the first of the next: the first id of each range
    (one number for each) is known beforehand, and that document goes to both.
    """
    spark = docs.sparkSession
    parts = parts or partitions(spark)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    count = 2 * parts
    bounds = np.unique(np.array(rows.agg(F.percentile_approx("id", [i / count for i in range(1, count)], 100 * count)).first()[0] or [], np.int64))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(bounds, ids, side="right")
            each = [(r, int(ids[at == r].min())) for r in np.unique(at).tolist()]
            yield arrow({"range": ([r for r, _ in each], pa.int64()), "id": ([i for _, i in each], pa.int64())})

    firsts = sorted((r["range"], r["id"]) for r in rows.select("id").mapInArrow(ranges, "range long, id long").groupBy("range").agg(F.min("id").alias("id")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}  # the range before (of the first: the last)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            also = np.array([i for i, x in enumerate(ids.tolist()) if x in before], np.int64)
            at = np.concatenate([np.searchsorted(bounds, ids, side="right"), np.array([before[x] for x in ids[also].tolist()], np.int64)])
            kind = np.concatenate([np.zeros(len(ids), np.int32), np.ones(len(also), np.int32)])
            every = pa.array(np.concatenate([np.arange(len(ids)), also]))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(kind), batch.column(0).take(every), batch.column(1).take(every)], names=["range", "kind", "id", "text"])

    dealt = rows.mapInArrow(deal, "range long, kind int, id long, text string")
    near = dealt.repartition(parts, "range").sortWithinPartitions("range", "kind", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pairs(rows: list[tuple[int, int, int, str]]) -> pa.RecordBatch:
            """Of each row but the last and those of kind 1: the document and its successor."""
            texts = [r[3] for r in rows]
            mine = [i for i, r in enumerate(rows[:-1]) if r[1] == 0]
            new = [edited(texts[i], texts[i + 1]) for i in mine]
            found = features([t.encode() for t in texts], rank)
            other = features([t.encode() for t in new], rank)
            own, chains = [filters(f) for f in found], [filters(f) for f in other]
            return arrow(
                {
                    "id": ([None if rows[i][2] == NO_ID else rows[i][2] for i in mine], pa.int64()),
                    "n_chars": ([len(texts[i]) for i in mine], pa.int64()),
                    "edited_sha256": ([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
                    "fingerprint": ([digest(found[i]) for i in mine], pa.string()),
                    "edited_fingerprint": ([digest(f) for f in other], pa.string()),
                    "near_edited": ([likeness(own[i], c) for i, c in zip(mine, chains, strict=True)], pa.float64()),
                    "near_next": ([likeness(own[i], own[i + 1]) for i in mine], pa.float64()),
                }
            )

        held: list[tuple[int, int, int, str]] = []
        size = 0
        for batch in batches:
            for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                held.append(row)
                size += len(row[3])
                if size > 4 << 20:
                    yield pairs(held)
                    held, size = held[-1:], len(held[-1][3])
        if len(held) > 1:
            yield pairs(held)

    return near.mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
