"""Removal of repeated byte strings by suffix arrays (operator 6).

A byte of a document goes if a string of ``min_bytes`` bytes that covers it
also starts in a document with a smaller id.  Whole texts, exact.

1. *Candidates.*  Every window of ``min_bytes`` bytes is keyed by the least
   hash among its ``ANCHOR``-byte substrings; equal windows have equal keys.
   Neighbouring windows with one key form a run.  (key, document) pairs,
   packed by hash bucket, meet in one exchange; keys that a single document
   has are dropped, the rest go back to their documents.
2. *Suffix arrays.*  Documents, dealt by id, cut out the strings under their
   shared runs; equal strings of a batch travel once.  They are dealt by key,
   so all copies of a window meet.  The distinct strings under a key are
   suffix-sorted by Lyndon grouping (``suffix_array``); equal windows are
   neighbours there and take the least id among their strings' documents.
   A key with one distinct string needs no sorting: all its windows are equal
   to their copies.
3. *Spans* go back to the documents, which drop the union of their spans.

Nothing is gathered by one document or passage: exchanges are by hash of key
or id.  Keys with more than ``hot`` occurrences (boilerplate between differing
contexts) are keyed anew, window by window, which splits them: equal windows
then are one string.

Defined results: null text = empty; documents shorter than ``min_bytes`` stay
whole; rows with the same id never remove from each other, and identical rows
give identical results; a null id neither removes nor loses anything; an empty
table gives an empty result.  ``without_repeats`` puts the texts that are left
into the documents; characters that a span cuts apart go as a whole, and all
other columns pass through.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import U64, arrow, mix64, partitions, passes, texts_as_bytes, unpack
from adlake.llm.suffix_array import window_classes

ANCHOR = 28
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))
_MULT = U64(0x9E3779B97F4A7C15)
#: Bytes of strings that one suffix array holds (small enough for a core's cache), and beyond which one key's strings are split by window.
SORT_BYTES, SPLIT_BYTES = 8_000, 500_000


def substring_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of each substring of ``width`` bytes, by doubling."""
    h, n = _BYTE[data], 1
    while 2 * n <= width:
        x = h[:-n] * _MULT
        x += h[n:]
        x ^= x >> U64(29)
        x *= U64(0xC2B2AE3D27D4EB4F)
        h, n = x, 2 * n
    if n < width:
        count = len(data) - width + 1
        x = h[:count] * _MULT
        x += h[width - n : width - n + count]
        x ^= x >> U64(29)
        x *= U64(0xC2B2AE3D27D4EB4F)
        h = x
    return h ^ (h >> U64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, m = 1, values
    while 2 * n <= width:
        m, n = np.minimum(m[:-n], m[n:]), 2 * n
    if n < width:
        count = len(values) - width + 1
        m = np.minimum(m[:count], m[width - n : width - n + count])
    return m


def window_runs(texts: list[bytes], width: int, anchor: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(joined texts, key, start in the joined texts, windows, text index) of
    each run of windows of ``width`` bytes with one key."""
    joined = b"".join(texts)
    none = np.zeros(0, np.int64)
    if len(joined) < width:
        return joined, none.astype(np.uint64), none, none, none
    data = np.frombuffer(joined, np.uint8)
    m = sliding_min(substring_hashes(data, anchor), width - anchor + 1)
    count = len(m)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    new = np.empty(count, bool)
    new[0] = True
    np.not_equal(m[1:], m[:-1], out=new[1:])
    # Windows across the end of a text: the last width - 1 starts of each.
    first = np.concatenate([[0], ends[:-1]])
    new[first[first < count]] = True
    stop = np.maximum(ends - width + 1, first)
    new[stop[stop < count]] = True
    start = np.flatnonzero(new)
    text = np.searchsorted(ends, start, side="right")
    windows = np.diff(np.append(start, count))
    inside = start + width <= ends[text]
    return joined, m[start][inside], start[inside], windows[inside], text[inside]


def _part(ids: np.ndarray, parts: int) -> np.ndarray:
    return (mix64(ids.astype(np.int64).view(np.uint64) + U64(77)) % U64(parts)).astype(np.int64)


def _row(ids: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """Tells rows with one id and differing texts apart."""
    return mix64(ids.astype(np.int64).view(np.uint64) + tags.astype(np.uint64) * _MULT).view(np.int64)


def _tags(texts: list[bytes], tagged: bool) -> np.ndarray:
    if not tagged:
        return np.zeros(len(texts), np.uint64)
    return np.fromiter(map(zlib.crc32, texts), np.uint64, len(texts))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> U64(KEY_BITS)) % U64(buckets)).astype(np.int64)


def _slices(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, from, to) of each run in a sorted array."""
    if len(sorted_values):
        at = np.flatnonzero(np.append(True, sorted_values[1:] != sorted_values[:-1]))
        for a, b in zip(at.tolist(), [*at[1:].tolist(), len(sorted_values)], strict=True):
            yield int(sorted_values[a]), a, b


#: Bits of a key that travel; with the bucket they only have to tell most keys
#: apart, as strings are compared whole later.
KEY_BITS = 40
_MASK = U64((1 << KEY_BITS) - 1)
PAIRS = "bucket int, docs binary, counts binary, low binary, high binary"
ITEMS = "part int, kind int, ids binary, sizes binary, body binary"
STRINGS = "bucket int, sizes binary, body binary, places binary"


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), texts_as_bytes(batch.column(1))


def _pairs(buckets: int, width: int):
    """(key, document) pairs of each batch, packed by bucket: ids once per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids, texts = _read(batch)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            keys, docs = [], []
            for a, b in passes(sizes):
                _, key, _, _, text = window_runs(texts[a:b], width, ANCHOR)
                keys.append(key)
                docs.append(text + a)
            if not keys or not sum(map(len, keys)):
                continue
            key, doc = np.concatenate(keys), np.concatenate(docs)
            bucket = _bucket(key, buckets)
            order = np.argsort(bucket.astype(np.uint16), kind="stable")
            bucket, key, doc = bucket[order], key[order], doc[order]
            low, high = key.astype(np.uint32), (key >> U64(32)).astype(np.uint8)
            rows = [[], [], [], [], []]
            for value, a, b in _slices(bucket):
                at = np.flatnonzero(np.append(True, doc[a + 1 : b] != doc[a : b - 1]))
                for column, x in zip(rows, (value, pack.compress(ids[doc[a:b][at]].tobytes()), pack.compress(np.diff(np.append(at, b - a)).astype(np.uint32).tobytes()), low[a:b].tobytes(), high[a:b].tobytes()), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *(pa.array(x, pa.binary()) for x in rows[1:])], names=["bucket", "docs", "counts", "low", "high"])

    return run


def _shared(parts: int, hot: int):
    """Keys of at least two documents, packed for each part of the documents.
    The top bit of a key says that it is hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list] = [[], [], [], [], []]
        for batch in batches:
            for column, x in zip(cols, batch.columns, strict=True):
                column.extend(x.to_pylist())
        if not cols[0]:
            return
        unzip = zstandard.ZstdDecompressor().decompress
        counts = unpack([unzip(x) for x in cols[2]], np.uint32)
        doc = np.repeat(unpack([unzip(x) for x in cols[1]], np.int64), counts)
        key = unpack(cols[3], np.uint32).astype(np.uint64) | unpack(cols[4], np.uint8).astype(np.uint64) << U64(32)
        rows = np.fromiter((len(x) // 4 for x in cols[3]), np.int64, len(cols[3]))
        key |= np.repeat(np.array(cols[0], np.uint64), rows) << U64(KEY_BITS)  # the bucket keeps keys of two buckets apart here
        del cols
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        size = np.diff(np.append(at, len(key)))
        several = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
        keep = np.repeat(several, size)
        short = (key & _MASK) | np.repeat(size > hot, size).astype(np.uint64) << U64(63)
        key, doc = short[keep], doc[keep]
        part = _part(doc, parts)
        order = np.lexsort((key, doc, part))
        part, key, doc = part[order], key[order], doc[order]
        out: dict[str, list] = {"part": [], "ids": [], "sizes": [], "body": []}
        for value, a, b in _slices(part):
            first = np.flatnonzero(np.append(True, doc[a + 1 : b] != doc[a : b - 1]))
            out["part"].append(value)
            out["ids"].append(doc[a:b][first].tobytes())
            out["sizes"].append(np.diff(np.append(first, b - a)).astype(np.uint32).tobytes())
            out["body"].append(_planes(key[a:b]))
        n = len(out["part"])
        yield arrow({"part": (out["part"], pa.int32()), "kind": ([0] * n, pa.int32()), "ids": (out["ids"], pa.binary()), "sizes": (out["sizes"], pa.binary()), "body": (out["body"], pa.binary())})

    return run


def _texts(parts: int):
    """The documents of each batch, packed by part and compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, texts = _read(batch)
            part = _part(ids, parts)
            order = np.argsort(part, kind="stable")
            out: list[list] = [[], [], [], []]
            for value, a, b in _slices(part[order]):
                mine = [texts[i] for i in order[a:b]]
                for c, d in passes(np.fromiter(map(len, mine), np.int64, len(mine))):
                    for column, x in zip(out, (value, ids[order[a + c : a + d]].tobytes(), np.fromiter(map(len, mine[c:d]), np.uint32, d - c).tobytes(), pack.compress(b"".join(mine[c:d]))), strict=True):
                        column.append(x)
            n = len(out[0])
            yield arrow({"part": (out[0], pa.int32()), "kind": ([1] * n, pa.int32()), "ids": (out[1], pa.binary()), "sizes": (out[2], pa.binary()), "body": (out[3], pa.binary())})

    return run


def _unpacked(ids: bytes, sizes: bytes, body: bytes) -> tuple[np.ndarray, list[bytes]]:
    text = zstandard.ZstdDecompressor().decompress(body, max_output_size=max(1, int(np.frombuffer(sizes, np.uint32).sum(dtype=np.int64))))
    ends = np.cumsum(np.frombuffer(sizes, np.uint32).astype(np.int64)).tolist()
    return np.frombuffer(ids, np.int64), [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _planes(values: np.ndarray) -> bytes:
    """The bytes of 8-byte values: all first ones, then all second ones, and so
    on.  High bytes that hardly differ then take next to no room in a shuffle."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(blob: bytes, dtype) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, len(blob) // 8).T).view(dtype).ravel()


class _Lookup:
    """Packed per-document values that came before the texts."""

    def __init__(self) -> None:
        self.packed: dict[int, list[tuple[bytes, bytes, bytes]]] = {}
        self.by_part: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def add(self, part: int, *blobs: bytes) -> None:
        self.packed.setdefault(part, []).append(blobs)

    def of(self, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document ids in order, from, to) into the sorted values of a part, and the values."""
        if part not in self.by_part:
            got = self.packed.pop(part, [])
            doc = np.repeat(unpack([x[0] for x in got], np.int64), unpack([x[1] for x in got], np.uint32))
            value = np.concatenate([np.zeros(0, np.uint64), *(_from_planes(x[2], np.uint64) for x in got)])
            order = np.argsort(doc, kind="stable")
            self.by_part[part] = doc[order], value[order], order
        return self.by_part[part]


def _strings(buckets: int, width: int, tagged: bool):
    """The strings under the shared runs, packed by bucket of their key."""

    def flush(found: dict[bytes, int], keys: list[np.ndarray], which: list[np.ndarray], docs: list[np.ndarray], starts: list[np.ndarray]) -> pa.RecordBatch | None:
        if not found:
            return None
        string, doc, at = np.concatenate(which), np.concatenate(docs), np.concatenate(starts)
        key = np.zeros(len(found), np.uint64)
        key[string] = np.concatenate(keys)
        texts = list(found)
        bucket = _bucket(key, buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        by = np.argsort(place[string], kind="stable")
        doc, at = doc[by], at[by]
        times = np.bincount(place[string], minlength=len(order))
        ends = np.concatenate([[0], np.cumsum(times)])
        out: dict[str, list] = {x.split()[0]: [] for x in STRINGS.split(", ")}
        pack = zstandard.ZstdCompressor(level=3)
        for value, a, b in _slices(bucket[order]):
            mine = [texts[i] for i in order[a:b]]
            out["bucket"].append(value)
            out["sizes"].append(np.fromiter(map(len, mine), np.uint32, b - a).tobytes())
            out["body"].append(pack.compress(b"".join(mine)))
            # Place by place: keys (32 bits tell those of a bucket apart well enough) and copies of the strings, then document and start of each copy.
            places = (key[order[a:b]].astype(np.uint32).tobytes(), times[a:b].astype(np.uint32).tobytes(), _planes(doc[ends[a] : ends[b]]), _planes(at[ends[a] : ends[b]]))
            out["places"].append(pack.compress(b"".join(places)))
        return arrow({k: (v, pa.int32() if k == "bucket" else pa.binary()) for k, v in out.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Lookup()
        found: dict[bytes, int] = {}
        lists: tuple[list, list, list, list] = ([], [], [], [])
        held = 0
        for batch in batches:
            for part, kind, ids, sizes, body in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if kind == 0:
                    known.add(part, ids, sizes, body)
                    continue
                doc_of, keys_of, _ = known.of(part)
                names, texts = _unpacked(ids, sizes, body)
                a, b = np.searchsorted(doc_of, names), np.searchsorted(doc_of, names, side="right")
                use = np.flatnonzero(b > a)
                if not len(use):
                    continue
                joined, key, start, windows, text = window_runs([texts[i] for i in use], width, ANCHOR)
                wanted = np.concatenate([keys_of[a[i] : b[i]] for i in use])
                salt = mix64(np.arange(len(use), dtype=np.uint64) + U64(1))
                wanted_by = np.repeat(salt, b[use] - a[use])
                mine = mix64((key & _MASK) ^ salt[text])
                names_of, is_hot = mix64((wanted & _MASK) ^ wanted_by), wanted >> U64(63) == U64(1)
                # Bits that travel may be those of a hot and of a cold key: such a run goes both ways, so its copies are met in either.
                hot, cold = np.isin(mine, names_of[is_hot]), np.isin(mine, names_of[~is_hot])
                shared = hot | cold
                key, start, windows, text, hot, cold = (x[shared] for x in (key, start, windows, text, hot, cold))
                if hot.any():
                    key, start, windows, text = _split(joined, key, start, windows, text, hot, cold, width)
                offset = np.concatenate([[0], np.cumsum([len(texts[i]) for i in use])])
                which = np.empty(len(start), np.int64)
                for i, (s, e) in enumerate(zip(start.tolist(), (start + windows + width - 1).tolist(), strict=True)):
                    which[i] = found.setdefault(joined[s:e], len(found))
                held += int(windows.sum()) + (width + 60) * len(windows)
                for column, x in zip(lists, (key, which, names[use][text], (start - offset[text]).astype(np.uint64) | _tags([texts[i] for i in use], tagged)[text] << U64(32)), strict=True):
                    column.append(x)
                if held > 64 << 20:
                    if (out := flush(found, *lists)) is not None:
                        yield out
                    found, lists, held = {}, ([], [], [], []), 0
        if (out := flush(found, *lists)) is not None:
            yield out

    return run


def _split(joined: bytes, key: np.ndarray, start: np.ndarray, windows: np.ndarray, text: np.ndarray, hot: np.ndarray, cold: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Runs with a hot key become runs of single windows, each keyed by itself; those with a cold key stay."""
    strings = [joined[s:e] for s, e in zip(start[hot].tolist(), (start[hot] + windows[hot] + width - 1).tolist(), strict=True)]
    base = np.concatenate([[0], np.cumsum([len(x) for x in strings])[:-1]]).astype(np.int64)
    _, k, s, w, which = window_runs(strings, width, width)
    return tuple(np.concatenate(x) for x in ((key[cold], mix64(k)), (start[cold], start[hot][which] + s - base[which]), (windows[cold], w), (text[cold], text[hot][which])))


def _spans(parts: int, width: int):
    """(document, start, length) of what repeats a document with a smaller id, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[bytes, int] = {}
        keys, which, docs, starts = [], [], [], []
        for batch in batches:
            for _, sizes, body, places in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                _, strings = _unpacked(b"", sizes, body)
                places = zstandard.ZstdDecompressor().decompress(places)
                key, times = np.frombuffer(places, np.uint32, 2 * len(strings)).reshape(2, -1)
                half = (len(places) - 8 * len(strings)) // 2
                doc, start = (_from_planes(places[i : i + half], np.int64) for i in (8 * len(strings), 8 * len(strings) + half))
                own = np.fromiter((index.setdefault(x, len(index)) for x in strings), np.int64, len(strings))
                keys.append((own, key))
                which.append(np.repeat(own, times))
                docs.append(doc)
                starts.append(start.view(np.uint64))
        if not index:
            return
        string, doc, start = np.concatenate(which), np.concatenate(docs), np.concatenate(starts)
        tag, start = start >> U64(32), (start & U64(0xFFFFFFFF)).astype(np.int64)
        texts = list(index)
        key = np.zeros(len(index), np.uint32)
        for own, k in keys:
            key[own] = k
        del index, keys, which, docs, starts
        least = np.full(len(texts), np.iinfo(np.int64).max)
        np.minimum.at(least, string, doc)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        # A string of which a copy has a smaller id goes whole.
        later = doc > least[string]
        out_row, out_start, out_size = [np.flatnonzero(later)], [start[later]], [size[string[later]]]
        # Among several strings under a key, windows of the first copies may repeat parts of others.
        rows = np.flatnonzero(~later)
        rows = rows[np.argsort(string[rows], kind="stable")]
        first = np.searchsorted(string[rows], np.arange(len(texts) + 1))
        order = np.argsort(key, kind="stable")
        at = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
        times = np.diff(np.append(at, len(order)))
        order = order[np.repeat(times > 1, times)]
        for a, b in _groups(key[order], size[order]):
            mine = order[a:b]
            for owner, offset, cls in _classes([texts[i] for i in mine], width):
                ids = least[mine[owner]]
                lowest = np.full(int(cls.max(initial=-1)) + 1, np.iinfo(np.int64).max)
                np.minimum.at(lowest, cls, ids)
                gone = lowest[cls] < ids
                if not gone.any():
                    continue
                owner, offset = owner[gone], offset[gone]
                by = np.lexsort((offset, owner))
                owner, offset = owner[by], offset[by]
                new = np.append(True, (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1))
                at = np.flatnonzero(new)
                last = np.append(at[1:], len(owner)) - 1
                s = mine[owner[at]]
                copies = first[s + 1] - first[s]
                which_rows = np.repeat(first[s] - np.concatenate([[0], np.cumsum(copies)[:-1]]), copies) + np.arange(copies.sum())
                r = rows[which_rows]
                out_row.append(r)
                out_start.append(start[r] + np.repeat(offset[at], copies))
                out_size.append(np.repeat(offset[last] - offset[at] + width, copies))
        row, start, size = np.concatenate(out_row), np.concatenate(out_start), np.concatenate(out_size)
        part, doc = _part(doc[row], parts), _row(doc[row], tag[row])
        by = np.lexsort((start, doc, part))
        part, doc, value = part[by], doc[by], start[by].astype(np.uint64) << U64(32) | size[by].astype(np.uint64)
        out: dict[str, list] = {"part": [], "ids": [], "sizes": [], "body": []}
        for p, a, b in _slices(part):
            at = np.flatnonzero(np.append(True, doc[a + 1 : b] != doc[a : b - 1]))
            out["part"].append(p)
            out["ids"].append(doc[a:b][at].tobytes())
            out["sizes"].append(np.diff(np.append(at, b - a)).astype(np.uint32).tobytes())
            out["body"].append(_planes(value[a:b]))
        n = len(out["part"])
        yield arrow({"part": (out["part"], pa.int32()), "kind": ([0] * n, pa.int32()), "ids": (out["ids"], pa.binary()), "sizes": (out["sizes"], pa.binary()), "body": (out["body"], pa.binary())})

    return run


def _groups(key: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of whole keys, of about ``SORT_BYTES`` bytes; a larger key alone."""
    begin, total = 0, 0
    for _, a, b in _slices(key):
        more = int(size[a:b].sum())
        if a > begin and total + more > SORT_BYTES:
            yield begin, a
            begin, total = a, 0
        total += more
    if len(key) > begin:
        yield begin, len(key)


def _classes(strings: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Window classes of the strings.  More than SPLIT_BYTES under one key go
    window by window instead, dealt by hash over rounds that bound the memory."""
    total = sum(map(len, strings))
    if total <= SPLIT_BYTES:
        yield window_classes(strings, width)
        return
    joined, _, start, windows, which = window_runs(strings, width, width)
    start = np.repeat(start - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    which = np.repeat(which, windows)
    base = np.cumsum([len(x) for x in strings]) - [len(x) for x in strings]
    hashes = substring_hashes(np.frombuffer(joined, np.uint8), width)[start]
    rounds = -(-len(start) // 250_000)
    for turn in range(rounds):
        mine = np.flatnonzero(hashes % U64(rounds) == U64(turn))
        seen: dict[bytes, int] = {}
        cls = np.fromiter((seen.setdefault(joined[i : i + width], len(seen)) for i in start[mine].tolist()), np.int64, len(mine))
        yield which[mine], start[mine] - base[which[mine]], cls


def _keep(tagged: bool, whole: bool):
    """The documents without their spans and, if ``whole``, without the bytes
    left of characters that spans cut apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Lookup()
        for batch in batches:
            for part, kind, ids, sizes, body in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if kind == 0:
                    known.add(part, ids, sizes, body)
                    continue
                doc_of, spans_of, _ = known.of(part)
                names, texts = _unpacked(ids, sizes, body)
                own = _row(names, _tags(texts, tagged))
                a, b = np.searchsorted(doc_of, own).tolist(), np.searchsorted(doc_of, own, side="right").tolist()
                kept, removed, runs = [], [], []
                for text, i, j in zip(texts, a, b, strict=True):
                    pieces, at, gone, n = [], 0, 0, 0
                    if j > i:
                        spans = np.sort(spans_of[i:j])
                        start, stop = (spans >> U64(32)).astype(np.int64), (spans >> U64(32)).astype(np.int64) + (spans & U64(0xFFFFFFFF)).astype(np.int64)
                        reach = np.maximum.accumulate(stop)
                        new = np.flatnonzero(np.append(True, start[1:] > reach[:-1]))
                        for s, e in zip(start[new].tolist(), reach[np.append(new[1:], len(start)) - 1].tolist(), strict=True):
                            pieces.append(text[at:s])
                            at, gone, n = e, gone + e - s, n + 1
                    pieces.append(text[at:])
                    if whole and n:
                        # Piece by piece: halves of two characters must not meet and make a third.
                        pieces = [x.decode("utf-8", "ignore").encode() for x in pieces]
                    kept.append(b"".join(pieces))
                    removed.append(gone)
                    runs.append(n)
                for c, d in passes(np.fromiter(map(len, kept), np.int64, len(kept)), 8 << 20):
                    yield arrow({"id": (names[c:d], pa.int64()), "kept": (kept[c:d], pa.binary()), "n_bytes": ([len(x) for x in texts[c:d]], pa.int64()), "n_removed": (removed[c:d], pa.int64()), "n_spans": (runs[c:d], pa.int64()), "text_crc": ([zlib.crc32(x) for x in texts[c:d]], pa.int64())})

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 50, hot: int = 2_000, whole_characters: bool = False) -> DataFrame:
    """(id, kept binary, n_bytes, n_removed, n_spans, text_crc) of every row of ``docs``,
    with ``whole_characters`` kept without the rest of those that a span cuts apart;
    see the module's text for the method and the defined results."""
    if min_bytes <= ANCHOR:
        raise ValueError(f"strings of more than {ANCHOR} bytes")
    spark = docs.sparkSession
    parts = partitions(spark)
    buckets = min(4 * parts, 1 << 15)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    named = rows.where("id is not null")
    # Only where an id repeats do its rows need telling apart.
    tagged = not named.groupBy("id").count().where("count > 1").isEmpty()
    pairs = named.mapInArrow(_pairs(buckets, min_bytes), PAIRS)
    shared = pairs.repartition(parts, "bucket").mapInArrow(_shared(4 * parts, hot), ITEMS)
    texts = named.mapInArrow(_texts(4 * parts), ITEMS)

    def beside(found: DataFrame) -> DataFrame:
        """The packed values before the texts, by part."""
        return found.unionByName(texts).repartition(parts, "part").sortWithinPartitions("kind")

    strings = beside(shared).mapInArrow(_strings(buckets, min_bytes, tagged), STRINGS)
    spans = strings.repartition(parts, "bucket").mapInArrow(_spans(4 * parts, min_bytes), ITEMS)
    done = beside(spans).mapInArrow(_keep(tagged, whole_characters), "id long, kept binary, n_bytes long, n_removed long, n_spans long, text_crc long")
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rest = rows.where("id is null").select("id", whole.alias("kept"), F.octet_length(whole).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.crc32(whole).alias("text_crc"))
    return done.unionByName(rest)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 50) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts (null stays null)."""
    doc = F.col(id_col).cast("long")
    named, rest = docs.where(doc.isNotNull()), docs.where(doc.isNull())
    kept = remove_repeats(named, id_col, text_col, min_bytes, whole_characters=True).select(F.col("id").alias("__id"), "kept", "text_crc", "n_bytes")
    own = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    # The other columns travel in a struct, so their names can't clash.
    others = [c for c in docs.columns if c != text_col]
    rows = named.select(F.struct(*others).alias("__row"), doc.alias("__doc"), F.crc32(own).alias("__crc"), F.octet_length(own).cast("long").alias("__size"), F.col(text_col).isNull().alias("__none"))
    if not named.groupBy(id_col).count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(["__id", "text_crc", "n_bytes"])  # rows equal in these lose the same
    found = rows.join(kept, (F.col("__doc") == F.col("__id")) & (F.col("__crc") == F.col("text_crc")) & (F.col("__size") == F.col("n_bytes")))
    whole = F.when(~F.col("__none"), F.col("kept").cast("string"))
    done = found.select(*[whole.alias(c) if c == text_col else F.col(f"__row.{c}") for c in docs.columns])
    # Rows without an id lose nothing, so they stay as they are.
    return done.unionByName(rest.withColumn(text_col, F.col(text_col).cast("string")))
