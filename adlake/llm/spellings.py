"""Spelling variants by a dictionary of trie-node pairs (operator 11).

*Words.*  Maximal runs of letters of all whole texts, lower-cased in A-Z only,
are counted over the corpus; each task adds up its own texts first.

*Tries.*  The distinct words, sorted, are range partitions of a trie in
preorder: a word makes one node for every letter beyond what it shares with
the word before it, so its nodes are runs of consecutive numbers.  Every
partition returns its first and last word, the nodes it made and the path of its last word
(one row a partition, with paths as runs); the driver chains these rows, which
gives each partition the path that it goes on from and its first free number.
The same over the reversed words numbers the suffixes.  Numbers are exact, no
hashes, and a word of ``L`` letters costs ``O(L)`` numbers, not ``O(L^2)``
letters of prefixes.

*Pairs.*  A word skipping letter ``i`` is the pair (node of the prefix before
``i``, node of the suffix after ``i``); a word split at ``i`` without skipping
is the pair of both its sides.  Words meet on equal pairs:

* two skipping: they differ by a replaced letter (in just one place, so they
  meet once);
* one skipping, one split: the first has one letter more.  Skipping any letter
  of a run of equal ones gives the same word, so only the first of a run
  counts; then these too meet once.

A pair holds at most one split word, and no two skipping words with the same
letter.  No neighbours are paired up: in one window over the pair every word
sees how many others are there and which of them occurs most, and one
aggregate by word adds this up.  A pair that very many words share (a large
alphabet) is counted, not multiplied.

*Forms.*  A word's form is its near word of most occurrences (ties: smallest),
if that has ``factor`` times its own; chains of forms at least multiply the
occurrences by ``factor``, and are followed by pointer jumping.

Defined results: null and empty texts have no words; rows of equal ids count
as often as they are there; a row without an id loses no letter; without words
the result is empty; extra columns are not read.  Very long runs are words
like others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import arrow, partitions, stage, texts_as_bytes, unstage

#: Letters: A-Z, a-z and U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
#: A run whose checksum this divides loses a letter.
CHANGED = 199
#: Distinct words that a task adds up before it sends them on.
HELD = 300_000


def changed(run: str, doc_id: int | None) -> str:
    """The run of a document as it is counted."""
    if doc_id is None:
        return run
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % CHANGED:
        return run
    i = h % len(run)
    return run[:i] + run[i + 1 :]


def word_counts(docs: DataFrame, id_col: str, text_col: str, min_letters: int, min_count: int) -> DataFrame:
    """(word, n) of the words of at least ``min_letters`` letters and ``min_count`` occurrences."""
    # A shorter run can't become a word.
    runs = re.compile(f"[{LETTERS.replace('A-Z', '')}]{{{min_letters},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = arrow({"word": (list(counts), pa.string()), "n": (list(counts.values()), pa.int64())})
            counts.clear()
            return made

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_as_bytes(batch.column(1)), strict=True):
                # bytes.lower() takes A-Z only.
                for run, n in Counter(runs.findall(text.lower().decode("utf-8", "replace"))).items():
                    word = changed(run, doc_id)
                    if len(word) >= min_letters:
                        counts[word] += n
                if len(counts) > HELD:
                    yield out()
        yield out()

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def shared(a: str, b: str) -> int:
    """Letters that two words have in common at their start."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


# A path is a list of runs (first depth, node there); nodes of a run follow one another.
Path = list[tuple[int, int]]


def cut(path: Path, depth: int) -> Path:
    """The runs of a path down to ``depth``."""
    return [r for r in path if r[0] <= depth]


def nodes(path: Path, length: int) -> np.ndarray:
    """Node of each depth 0 .. length; the root is node 0."""
    at = np.arange(length + 1, dtype=np.int64)
    if not path:
        return np.zeros(1, np.int64)
    first = np.array([d for d, _ in path])
    start = np.array([n for _, n in path], np.int64)
    run = np.searchsorted(first, at, side="right") - 1
    return np.where(run >= 0, start[run] + at - first[run], 0)


def descend(words: Iterator[str], before: str, path: Path, free: int) -> Iterator[tuple[str, Path, int]]:
    """(word, its path, next free number) of sorted words, after the word
    ``before`` with its ``path``."""
    for word in words:
        d = shared(before, word)
        path = cut(path, d)
        if d < len(word):
            path = [*path, (d + 1, free)]
            free += len(word) - d
        before = word
        yield word, path, free


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition: rows, first and last word, numbers used and the last
    word's path, as if the partition were the whole trie."""
    first, rows, word, path, free = None, 0, "", [], 1

    def words() -> Iterator[str]:
        for batch in batches:
            yield from batch.column("word").to_pylist()

    for word, path, free in descend(words(), "", [], 1):
        first = word if first is None else first
        rows += 1
    if rows:
        yield arrow({
            "part": ([TaskContext.get().partitionId()], pa.int32()), "rows": ([rows], pa.int64()), "first": ([first], pa.string()), "last": ([word], pa.string()),
            "used": ([free - 1], pa.int64()), "depths": ([[d for d, _ in path]], pa.list_(pa.int64())), "starts": ([[n for _, n in path]], pa.list_(pa.int64()))})


_EDGES = "part int, rows long, first string, last string, used long, depths array<long>, starts array<long>"


def chained(edges: list) -> dict[int, tuple[str, Path, int, int]]:
    """For each partition: the word before it, its path, the first free number
    and the number of words before."""
    begin: dict[int, tuple[str, Path, int, int]] = {}
    before, path, free, rank = "", [], 1, 0
    for e in sorted(edges, key=lambda e: e["part"]):
        begin[e["part"]] = (before, path, free, rank)
        known = shared(before, e["first"])
        own = list(zip(e["depths"], e["starts"], strict=True))
        # By itself the partition made the nodes of its first word's first `known` letters as 1 .. known;
        # they are the ones of the path before it.  All its other nodes move by the same step.
        step = free - 1 - known
        ends = [d for d, _ in own[1:]] + [len(e["last"]) + 1]
        moved: Path = []
        for (d, n), end in zip(own, ends, strict=True):
            if n <= known:  # the first word's own run: its first `known` nodes are inherited
                held = min(known, end - 1)
                moved += cut(path, held)
                if end - 1 > known:
                    moved.append((known + 1, known + 1 + step))
            else:
                moved.append((d, n + step))
        before, path, free, rank = e["last"], moved, free + e["used"] - known, rank + e["rows"]
    return begin


def numbered(words: DataFrame, key: str) -> DataFrame:
    """``words`` in the order of the string column ``key``, each with its
    ``rank`` in it (from 0) and ``nodes``, the trie nodes of its prefixes."""
    spark = words.sparkSession
    others = [c for c in words.columns if c != key]
    # The checkpoint fixes which word is in which partition.
    ordered = words.select(F.col(key).alias("word"), *others).repartitionByRange(partitions(spark), "word").sortWithinPartitions("word").checkpoint()
    begin = chained(ordered.select("word").mapInArrow(_edges, _EDGES).collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, path, free, rank = begin.get(TaskContext.get().partitionId(), ("", [], 1, 0))
        for batch in batches:
            found = []
            for word, path, free in descend(iter(batch.column("word").to_pylist()), before, path, free):  # noqa: B020
                found.append(nodes(path, len(word)))
                before = word
            n = batch.num_rows
            ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(rank, rank + n)), lists], names=[*batch.schema.names, "rank", "nodes"])
            rank += n

    kinds = "".join(f"{c} {words.schema[c].dataType.simpleString()}, " for c in others)
    return ordered.mapInArrow(run, f"word string, {kinds}rank long, nodes array<long>").withColumnRenamed("word", key)


def node_pairs(words: DataFrame) -> DataFrame:
    """(rank, n, head, tail, skips, leads): every pair of every word of (word,
    rank, n, nodes, tails); ``skips``: a letter is left out; ``leads``: that
    letter is the first of its run."""
    # tails[j]: the node of the suffix of j letters.
    length, letters = F.length("word"), F.split("word", "")
    pair = lambda i, j, skips, leads: F.struct(F.get("nodes", i).alias("head"), F.get("tails", j).alias("tail"), F.lit(skips).alias("skips"), leads.alias("leads"))
    skip = F.transform(F.sequence(F.lit(0), length - 1), lambda i: pair(i, length - i - 1, True, (i == 0) | (F.get(letters, i) != F.get(letters, i - 1))))
    split = F.transform(F.sequence(F.lit(0), length), lambda i: pair(i, length - i, False, F.lit(False)))
    return words.select("rank", "n", F.inline(F.concat(skip, split)))


def near_words(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, best_n, best): near words of every word that has any, and
    the one of most occurrences (ties: smallest rank)."""
    ranked = Window.partitionBy("head", "tail").orderBy(F.col("skips").desc(), F.col("n").desc(), "rank")
    pair = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    value = F.struct(F.col("n"), (-F.col("rank")).alias("minus"))
    skips, leads = F.col("skips"), F.col("leads")
    seen = pairs.select(
        "rank", "skips", "leads",
        F.count_if(skips).over(pair).alias("m"),
        F.count_if(leads).over(pair).alias("m_leads"),
        F.max(F.when(~skips, value)).over(pair).alias("split"),
        F.max(F.when(leads, value)).over(pair).alias("lead"),
        F.max(F.when(skips, value)).over(pair).alias("top"),
        # For the top skipping word itself: the one after it.
        F.when(F.lead("skips").over(ranked), F.lead(value).over(ranked)).alias("next"),
    )
    replaced = F.when(-F.col("rank") == F.col("top.minus"), F.col("next")).otherwise(F.col("top"))
    longer = leads & F.col("split").isNotNull()
    count = F.when(skips, F.col("m") - 1 + F.when(longer, 1).otherwise(0)).otherwise(F.col("m_leads"))
    best = F.when(skips, F.greatest(replaced, F.when(leads, F.col("split")))).otherwise(F.col("lead"))
    found = seen.select("rank", count.alias("c"), best.alias("b")).where("c > 0").groupBy("rank").agg(F.sum("c").alias("n_near"), F.max("b").alias("b"))
    return found.select("rank", "n_near", F.col("b.n").alias("best_n"), (-F.col("b.minus")).alias("best"))


def roots(forms: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(rank, root): the last of each chain of (rank, form), by pointer jumping."""
    at = stage(forms.select("rank", F.col("form").alias("root")), "spelling-roots")
    for _ in range(max_rounds):
        step = at.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        told = stage(at.join(step, "root", "left").select("rank", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        unstage(at)
        if told.where("moved").isEmpty():
            return told
        at = told
    raise RuntimeError("chains of forms did not end")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 6, min_count: int = 5, factor: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus."""
    counts = stage(word_counts(docs, id_col, text_col, min_letters, min_count), "spelling-words")
    forward = stage(numbered(counts, "word"), "spelling-heads")
    unstage(counts)
    backward = numbered(forward.select(F.reverse("word").alias("back"), F.col("rank").alias("own")), "back").select(F.col("own").alias("rank"), F.col("nodes").alias("tails"))
    words = stage(forward.join(backward, "rank"), "spelling-nodes")
    unstage(forward)
    near = stage(near_words(node_pairs(words)), "spelling-near")
    facts = words.select("word", "rank", "n")
    forms = facts.join(near, "rank").where(F.col("best_n") >= factor * F.col("n")).select("rank", F.col("best").alias("form"))
    forms = stage(forms, "spelling-forms")
    ends = roots(forms).select("rank", "root")
    names = facts.select(F.col("rank").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    tops = facts.select(F.col("rank").alias("root"), F.col("word").alias("root_word"))
    named = forms.join(names, "form").join(ends.join(tops, "root"), "rank").select("rank", "form_word", "form_n", "root_word")
    return (
        facts.join(near.select("rank", "n_near"), "rank", "left").join(named, "rank", "left")
        .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
    )
