"""Exact Jaccard join of n-gram sets by blocked sparse products (operator 10).

Documents are rows and word n-grams columns of a 0/1 incidence matrix ``A``;
two documents link when their entry of ``A A^T`` (the overlap) reaches the
bound that their sizes set for the similarity.

1. *Blocks of columns.*  Sizes bound the symmetric difference ``d`` of a
   linked pair (by size class), so if the columns are hashed into ``d + 1 + s``
   blocks, a linked pair has at least ``s + 1`` equal blocks.  Rows that agree
   in no non-empty block are below the bound and never multiplied.  (A row
   with more than ``s`` empty blocks also shows those.)  Block digests meet in
   one exchange by hash; equal sets count as one row.
2. *Blocks of rows.*  Rows that agree in a block get a common unit: the least
   label among them.  A unit of more than ``unit_ngrams`` entries is dealt into
   chunks; chunk pairs are separate tasks, first each chunk with itself and
   with chunk 0, then only rows outside the unit's largest component against
   the other chunks.
3. *Products.*  A task multiplies tiles of its rows, accumulating overlaps
   over column blocks, and drops a tile's pairs as soon as the overlap so far
   and the entries left cannot reach the size bound.  It returns a spanning
   forest of the links, never the pairs.  Tasks are run in up to ``ROUNDS``
   rounds, so that the sets on their way to them are never all on disk at once.
4. *Components* of the links by star contraction, in the shared folder.

Every link between differing sets is found or both ends are connected through
other links.  Defined results: null or wordless text has no set and is its own
component; rows with equal sets are linked; a null id is no component's name
and gets a null component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import U64, arrow, connected_components, drop_shuffles, marked_by, mix64, partitions, passes, stage, texts_as_bytes, unpack, unstage
from adlake.llm.repeats import _slices
from adlake.llm.shingles import shingle_sets

MAX_SIZE = 1 << 31
TILE, COLUMNS = 512, 1024
#: Products run in a round for each so many bytes of n-grams that are sent, and in so many at most.
ROUND_BYTES, ROUNDS = 64 << 20, 6


class Bounds:
    """What a similarity of ``num / den`` demands of two sets, by their sizes."""

    def __init__(self, similarity: Fraction) -> None:
        self.num, self.den = similarity.numerator, similarity.denominator
        low = [1, 2]
        while low[-1] < MAX_SIZE:
            low.append(max(low[-1] + 1, (low[-1] - 1) * self.den // self.num + 1))
        #: Class c holds the sizes low[c] .. low[c + 1] - 1; a partner is at most one class away.
        self.low = np.array(low, np.int64)
        largest = self.low[1:] - 1
        both = largest + largest * self.den // self.num
        self.differ = both * (self.den - self.num) // (self.den + self.num)
        blocks = self.differ + 1
        empty = blocks * np.exp(-self.low[:-1] / blocks)
        self.spare = np.where(self.differ > 0, np.ceil(3 * empty).astype(np.int64), 0)
        self.blocks = blocks + self.spare

    def linked(self, overlap, a, b):
        return overlap * (self.den + self.num) >= self.num * (a + b)


def block_digests(values: np.ndarray, counts: np.ndarray, bounds: Bounds) -> tuple[np.ndarray, np.ndarray]:
    """(digest, row) of the column blocks of each row, for the classes in which it may have a partner."""
    row = np.repeat(np.arange(len(counts)), counts)
    own = np.searchsorted(bounds.low, counts, side="right") - 1
    spread, weight = mix64(values + U64(0x5BD1E995)), mix64(values ^ U64(0xA0761D6478BD642F))
    digests, rows = [], []
    for shift in (0, 1):
        cls = own - shift
        use = (counts > 0) & (cls >= 0)
        use[use] &= bounds.differ[cls[use]] > 0
        blocks = np.where(use, bounds.blocks[np.maximum(cls, 0)], 0)
        base = np.cumsum(blocks) - blocks
        mine = use[row]
        if not mine.any():
            continue
        slot = base[row[mine]] + (spread[mine] % blocks[row[mine]].astype(np.uint64)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        slot = slot[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        total = np.add.reduceat(weight[mine][order], first)
        slot, where = slot[first], row[mine][order][first]
        filled = np.bincount(where, minlength=len(counts))
        bare = np.flatnonzero(use & (blocks - filled > bounds.spare[np.maximum(cls, 0)]))
        if len(bare):  # rows of many empty blocks show those, too
            every = np.concatenate([np.arange(base[r], base[r] + blocks[r]) for r in bare])
            none = np.setdiff1d(every, slot, assume_unique=True)
            at = np.searchsorted(base, none, side="right") - 1
            slot, where = np.concatenate([slot, none]), np.concatenate([where, at])
            total = np.concatenate([total, np.zeros(len(none), np.uint64)])
        digests.append(mix64(mix64(total + (slot - base[where]).astype(np.uint64) * U64(0x9E3779B97F4A7C15)) + cls[where].astype(np.uint64)))
        rows.append(where)
    if not digests:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(digests), np.concatenate(rows)


def set_keys(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set; sets of one name are one row (empty: 0)."""
    key = np.zeros(len(counts), np.uint64)
    has = np.flatnonzero(counts)
    if len(has):
        first = (np.cumsum(counts) - counts)[has]
        key[has] = mix64(np.add.reduceat(mix64(values + U64(0x2545F491)), first) + counts[has].astype(np.uint64))
    return key.view(np.int64)


PACKED = "bucket int, kind int, ids binary, sizes binary, keys binary, low binary, high binary"
FOUND = "kind int, id long, n long, key long, block long, members array<long>"


def _rows(buckets: int, k: int, lower: bool, similarity: Fraction):
    """Packed by bucket: names of sets with their documents (kind 0) and block digests (kind 1)."""
    bounds = Bounds(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            texts = texts_as_bytes(batch.column(1))
            keys, counts, digests, owners = [], [], [], []
            seen: set[int] = set()
            for a, b in passes(np.fromiter(map(len, texts), np.int64, len(texts))):
                value, count = shingle_sets(texts[a:b], k, lower)
                key = set_keys(value, count)
                digest, row = block_digests(value, count, bounds)
                new = np.fromiter((x not in seen and not seen.add(x) for x in key.tolist()), bool, len(key))
                mine = new[row]
                keys.append(key)
                counts.append(count)
                digests.append(digest[mine])
                owners.append(key[row[mine]])
            key, count, digest, owner = (np.concatenate(x) for x in (keys, counts, digests, owners))
            out: dict[str, list] = {x.split()[0]: [] for x in PACKED.split(", ")}
            bucket = (mix64(key.view(np.uint64)) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            for value, a, b in _slices(bucket[order]):
                x = order[a:b]
                for name, cell in zip(out, (value, 0, ids[x].tobytes(), count[x].tobytes(), key[x].tobytes(), b"", b""), strict=True):
                    out[name].append(cell)
            bucket = ((digest >> U64(48)) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket.astype(np.uint16), kind="stable")
            bucket, digest, owner = bucket[order], digest[order], owner[order]
            low, high = digest.astype(np.uint32), (digest >> U64(32)).astype(np.uint16)
            for value, a, b in _slices(bucket):
                at = np.flatnonzero(np.append(True, owner[a + 1 : b] != owner[a : b - 1]))
                for name, cell in zip(out, (value, 1, b"", np.diff(np.append(at, b - a)).astype(np.uint32).tobytes(), owner[a:b][at].tobytes(), low[a:b].tobytes(), high[a:b].tobytes()), strict=True):
                    out[name].append(cell)
            yield arrow({c: (v, pa.int32() if c in ("bucket", "kind") else pa.binary()) for c, v in out.items()})

    return run


def _agreeing():
    """The documents' rows (kind 0), and the sets that agree in a block (kind 1)."""
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = [x.split()[0] for x in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for bucket, kind, ids, sizes, keys, low, high in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if kind == 0:
                    n = len(ids) // 8
                    yield pa.RecordBatch.from_arrays([pa.array([0] * n, types[0]), *(pa.array(np.frombuffer(x, np.int64), pa.int64()) for x in (ids, sizes, keys)), pa.nulls(n, types[4]), pa.nulls(n, types[5])], names=names)
                    continue
                digest = np.frombuffer(low, np.uint32).astype(np.uint64) | np.frombuffer(high, np.uint16).astype(np.uint64) << U64(32) | U64(bucket) << U64(48)
                parts.append((digest, np.repeat(np.frombuffer(keys, np.int64), np.frombuffer(sizes, np.uint32))))
        if not parts:
            return
        digest, key = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
        del parts
        order = np.argsort(digest, kind="stable")
        digest, key = digest[order], key[order]
        first = np.flatnonzero(np.append(True, digest[1:] != digest[:-1]))
        several = np.minimum.reduceat(key, first) != np.maximum.reduceat(key, first) if len(first) else np.zeros(0, bool)
        keep = np.repeat(several, np.diff(np.append(first, len(digest))))
        digest, key = digest[keep], key[keep]
        order = np.lexsort((key, digest))
        digest, key = digest[order], key[order]
        new = np.append(True, (digest[1:] != digest[:-1]) | (key[1:] != key[:-1]))[: len(key)]
        digest, key = digest[new], key[new]
        blocks, members = [], []
        for _, a, b in _slices(digest):
            blocks.append(digest[a])
            members.append(key[a:b])
        for a in range(0, len(blocks), 4096):
            n = len(blocks[a : a + 4096])
            at = np.concatenate([[0], np.cumsum([len(x) for x in members[a : a + n]])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(members[a : a + n]), pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([1] * n, types[0]), *(pa.nulls(n, pa.int64()) for _ in range(3)), pa.array(np.array(blocks[a : a + n], np.uint64).view(np.int64)), lists], names=names)

    return run


def _sets(k: int, lower: bool):
    """(key, n-grams) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_as_bytes(batch.column(0))
            for a, b in passes(np.fromiter(map(len, texts), np.int64, len(texts))):
                value, count = shingle_sets(texts[a:b], k, lower)
                ends = np.cumsum(count).tolist()
                yield arrow({"key": (set_keys(value, count), pa.int64()), "n": (count, pa.int64()), "ngrams": ([value[i:j].tobytes() for i, j in zip([0, *ends[:-1]], ends, strict=True)], pa.binary())})

    return run


class Forest:
    """Disjoint sets of row numbers."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], bounds: Bounds) -> np.ndarray | None:
    """Overlaps of the rows of two tiles, or None if none can reach its bound.

    Columns common to the tiles are taken in blocks, those with the most
    products first: dense blocks by a matrix product, the rest as a list of
    products.  Between blocks the size bound may end it.
    """
    na, nb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    ca, cb = np.concatenate(a), np.concatenate(b)
    ra, rb = np.repeat(np.arange(len(a)), na), np.repeat(np.arange(len(b)), nb)
    columns = np.intersect1d(ca, cb)
    ia, ib = np.searchsorted(columns, ca), np.searchsorted(columns, cb)
    ia[ia == len(columns)] = 0
    ib[ib == len(columns)] = 0
    out = np.zeros((len(a), len(b)), np.int32)
    if not len(columns):
        return None
    keep_a, keep_b = columns[ia] == ca, columns[ib] == cb
    ra, ia, rb, ib = ra[keep_a], ia[keep_a], rb[keep_b], ib[keep_b]
    fa, fb = np.bincount(ia, minlength=len(columns)), np.bincount(ib, minlength=len(columns))
    left_a, left_b = np.bincount(ra, minlength=len(a)), np.bincount(rb, minlength=len(b))
    need = na[:, None] + nb[None, :]

    def hopeless() -> bool:
        return not bounds.linked(out + np.minimum(left_a[:, None], left_b[None, :]), 0, need).any()

    if hopeless():
        return None
    rank = np.empty(len(columns), np.int64)
    by = np.argsort(-(fa * fb), kind="stable")
    rank[by] = np.arange(len(columns))
    dense = int((fa * fb > 64).sum())
    ia, ib = rank[ia], rank[ib]
    oa, ob = np.argsort(ia, kind="stable"), np.argsort(ib, kind="stable")
    ra, ia, rb, ib = ra[oa], ia[oa], rb[ob], ib[ob]
    for c in range(0, dense, COLUMNS):
        d = min(c + COLUMNS, dense)
        sa, sb = slice(*np.searchsorted(ia, [c, d])), slice(*np.searchsorted(ib, [c, d]))
        xa, xb = np.zeros((len(a), d - c), np.float32), np.zeros((len(b), d - c), np.float32)
        xa[ra[sa], ia[sa] - c] = 1
        xb[rb[sb], ib[sb] - c] = 1
        out += (xa @ xb.T).astype(np.int32)
        left_a -= np.bincount(ra[sa], minlength=len(a))
        left_b -= np.bincount(rb[sb], minlength=len(b))
        if hopeless():
            return None
    ta, tb = np.searchsorted(ia, dense), np.searchsorted(ib, dense)
    ra, ia, rb, ib = ra[ta:], ia[ta:], rb[tb:], ib[tb:]
    if len(ia):
        start, stop = np.searchsorted(ib, ia), np.searchsorted(ib, ia, side="right")
        times = stop - start
        at = np.repeat(start - (np.cumsum(times) - times), times) + np.arange(times.sum())
        out += np.bincount(np.repeat(ra, times) * len(b) + rb[at], minlength=out.size).reshape(out.shape).astype(np.int32)
    return out


def link_rows(rows: list[np.ndarray], others: list[np.ndarray] | None, bounds: Bounds) -> Forest:
    """Components of the links among ``rows``, or between ``rows`` and ``others`` (numbered behind them)."""
    n = len(rows)
    every = rows + (others or [])
    size = np.fromiter(map(len, every), np.int64, len(every))
    forest = Forest(len(every))
    left = np.argsort(size[:n], kind="stable")
    right = left if others is None else n + np.argsort(size[n:], kind="stable")
    for i in range(0, len(left), TILE):
        a = left[i : i + TILE]
        for j in range(i if others is None else 0, len(right), TILE):
            b = right[j : j + TILE]
            least = min(size[a[-1]], size[b[-1]])
            if least * bounds.den < bounds.num * max(size[a[0]], size[b[0]]):
                continue
            out = _overlaps([every[x] for x in a], [every[x] for x in b], bounds)
            if out is None:
                continue
            for x, y in np.argwhere(bounds.linked(out.astype(np.int64), size[a][:, None], size[b][None, :])).tolist():
                forest.join(int(a[x]), int(b[y]))
    return forest


def _links(similarity: Fraction):
    """Spanning edges of the links in each block of rows; rows come sorted by block."""
    bounds = Bounds(similarity)

    def forest(keys: list[int], sides: list[int], sets: list[bytes]) -> tuple[list[int], list[int]]:
        rows: dict[tuple[int, int], np.ndarray] = {(s, k): np.frombuffer(x, np.uint64) for k, s, x in zip(keys, sides, sets, strict=True)}
        a = [k for s, k in rows if s == 0]
        b = [k for s, k in rows if s == 1]
        names = a + b
        found = link_rows([rows[0, k] for k in a], [rows[1, k] for k in b] if b else None, bounds)
        pairs = [(names[i], names[found.find(i)]) for i in range(len(names))]
        pairs = [(x, y) for x, y in pairs if x != y]
        return [x for x, _ in pairs], [y for _, y in pairs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, ([], [], [])
        for batch in batches:
            for block, side, key, ngrams in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if block != now and held[0]:
                    a, b = forest(*held)
                    if a:
                        yield arrow({"a": (a, pa.int64()), "b": (b, pa.int64())})
                    held = ([], [], [])
                now = block
                for column, x in zip(held, (key, side, ngrams), strict=True):
                    column.append(x)
        if held[0]:
            a, b = forest(*held)
            if a:
                yield arrow({"a": (a, pa.int64()), "b": (b, pa.int64())})

    return run


def _joined_on(roots: DataFrame, more: DataFrame) -> DataFrame:
    """The components (node, root) after links ``more`` (a, b) between them:
    only those links, from root to root, are contracted."""
    root_of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    lifted = more.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    top = connected_components(lifted)
    above = top.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = roots.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    found = stage(moved.unionByName(top.join(roots, "node", "left_anti").select("node", "root")), "cc-roots")
    unstage(top, roots)
    return found


def ngram_jaccard_join(
    docs: DataFrame, k: int, similarity: Fraction, id_col: str = "doc_id", text_col: str = "text", lower: bool = True, unit_ngrams: int = 4_000_000
) -> DataFrame:
    """(id, n_ngrams, component) of every row of ``docs``; the component is the
    least id that links reach.  See the module's text."""
    spark = docs.sparkSession
    parts = partitions(spark)
    buckets = min(4 * parts, 1 << 15)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    named = rows.where("id is not null")
    found = stage(named.mapInArrow(_rows(buckets, k, lower, similarity), PACKED).repartition(parts, "bucket").mapInArrow(_agreeing(), FOUND), "ngram-blocks")
    drop_shuffles(spark)
    sets = found.where("kind = 0").select("id", "n", "key")

    blocks = found.where("kind = 1").select("block", "members")
    member = blocks.select("block", F.array_min("members").alias("least"), F.explode("members").alias("key"))
    label = member.groupBy("key").agg(F.min("least").alias("label"))
    unit = member.join(label, "key").groupBy("block").agg(F.min("label").alias("unit"))
    units = stage(member.join(unit, "block").select("unit", "key").distinct(), "ngram-units")

    chosen = units.select("key").distinct()
    drop_shuffles(spark)
    first = sets.join(chosen, "key", "left_semi").groupBy("key").agg(F.min("id").alias("id"))
    ngrams = stage(named.join(first.select("id").distinct(), "id", "left_semi").select("text").mapInArrow(_sets(k, lower), "key long, n long, ngrams binary"), "ngram-sets")
    sized = units.join(ngrams.select("key", "n"), "key")
    chunks = sized.groupBy("unit").agg(F.ceil(F.sum("n") / F.lit(unit_ngrams)).cast("int").alias("chunks"), F.count("*").alias("rows")).where("rows > 1")
    dealt = stage(sized.join(chunks, "unit").select("unit", "key", "chunks", F.pmod(F.xxhash64("key", F.lit(7)), F.col("chunks")).cast("int").alias("chunk")), "ngram-chunks")

    def linked(pairs: DataFrame) -> list[DataFrame]:
        """Links of ``pairs`` (block, side, key), staged by rounds of blocks; a
        round's shuffle files go before the next one's are written."""
        sent = pairs.join(ngrams.select("key", "n"), "key").agg(F.sum("n")).first()[0] or 0
        rounds = max(1, min(ROUNDS, -(-8 * int(sent) // ROUND_BYTES)))
        out = []
        for i in range(rounds):
            mine, sets = pairs, ngrams.select("key", "ngrams")
            if rounds > 1:
                mine = pairs.where(F.pmod("block", F.lit(rounds)) == i)
                sets = marked_by(sets, mine.select("key").distinct(), "key")
            task = mine.join(sets, "key").select("block", "side", "key", "ngrams")
            drop_shuffles(spark)
            out.append(stage(task.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(_links(similarity), "a long, b long"), "ngram-links"))
        drop_shuffles(spark)
        return out

    name = F.xxhash64
    inside = dealt.select(name("unit", "chunk", "chunk").alias("block"), F.lit(0).alias("side"), "key")
    several = dealt.where("chunks > 1")
    zero = several.where("chunk = 0").select("unit", "key", F.explode(F.expr("sequence(1, chunks - 1)")).alias("to"))
    to_zero = several.where("chunk > 0").select(name("unit", F.lit(0), "chunk").alias("block"), F.lit(0).alias("side"), "key").unionByName(
        zero.select(name("unit", F.lit(0), "to").alias("block"), F.lit(1).alias("side"), "key")
    )
    edges = linked(inside.unionByName(to_zero))
    roots = connected_components(reduce(DataFrame.unionByName, edges))

    state = several.join(roots, several.key == roots.node, "left").select("unit", "key", "chunks", "chunk", F.coalesce("root", "key").alias("root"))
    count = state.groupBy("unit", "root").count()
    largest = count.groupBy("unit").agg(F.max(F.struct("count", "root")).alias("top")).select("unit", F.col("top.root").alias("main"))
    outside = state.join(largest, "unit").where("root <> main")
    open_pairs = outside.select("unit", "chunk", "chunks").distinct().select("unit", F.col("chunk").alias("from"), F.explode(F.expr("sequence(1, chunks - 1)")).alias("to")).where("from <> to and from > 0")
    out_rows = outside.where("chunk > 0").select("unit", "key", F.col("chunk").alias("from"), F.explode(F.expr("filter(sequence(1, chunks - 1), x -> x <> chunk)")).alias("to"))
    in_rows = several.join(open_pairs.withColumnRenamed("to", "chunk"), ["unit", "chunk"]).select(name("unit", "from", "chunk", F.lit(2)).alias("block"), F.lit(1).alias("side"), "key")
    rest = out_rows.select(name("unit", "from", "to", F.lit(2)).alias("block"), F.lit(0).alias("side"), "key").unionByName(in_rows)
    unstage(*edges)
    if not several.isEmpty():
        rounds = linked(rest)
        more = reduce(DataFrame.unionByName, rounds)
        if not more.isEmpty():
            roots = _joined_on(roots, more)
        unstage(*rounds)
    unstage(units, ngrams, dealt)

    joined = sets.join(roots, sets.key == roots.node, "left").select("id", "n", F.coalesce("root", "key").alias("root"))
    least = joined.where("n > 0").groupBy("root").agg(F.min("id").alias("component"))
    result = joined.where("n > 0").join(least, "root").select("id", F.col("n").alias("n_ngrams"), "component")
    alone = joined.where("n = 0").select("id", F.col("n").alias("n_ngrams"), F.col("id").alias("component"))
    nameless = rows.where("id is null").select("text").mapInArrow(_sets(k, lower), "key long, n long, ngrams binary").select(F.lit(None).cast("long").alias("id"), F.col("n").alias("n_ngrams"), F.lit(None).cast("long").alias("component"))
    return result.unionByName(alone).unionByName(nameless)


def exactly(similarity: float | str | Fraction) -> Fraction:
    return Fraction(str(similarity)) if not isinstance(similarity, Fraction) else similarity
