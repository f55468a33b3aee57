"""Quality by positive-unlabelled learning (operator 12).

Trusted positives are the labelled good documents; all text is unlabelled
text, good or not.  No bad example is learned from.  Equal texts count once in
either, so a text of many copies is one example; each copy has its score.

*Features.*  Shares of character classes and of repeated words, windows and
neighbours of every whole text, and the logarithm of its words, as integers of
``UNIT`` (in NumPy, one pass, written once without the texts).

*Prior.*  The share of good documents in unlabelled text is estimated by best
bin estimation: a logistic model first tells positives from unlabelled text;
where its score is high, unlabelled text is (almost) all good, so the least
ratio of the two upper tails, with a confidence bound against small tails,
estimates the prior.  Tails come from a histogram over a fifth of the texts (by
hash) that this model has not seen.

*Risk.*  With the prior ``q`` and the logistic loss ``l``, the unbiased risk
of a linear score ``f`` from positives P and unlabelled U is
``q E_P[l(f)] + (E_U[l(-f)] - q E_P[l(-f)])``.  The bracket estimates a mean
loss over bad documents and cannot be negative but by overfitting: the
non-negative risk takes the larger of it and zero, and where it falls below
zero a step goes back against it instead.  Steps are damped Newton steps over all
documents, the one of the least risk wins.

Sums are exact: features, weights and the factors of each row are integers of
fixed size, so the same table gives the same model whatever its partitions.
A step is one pass over the features; a task returns one row of sums for each
million rows, the driver sees one row.

Rows of fold 0 (crc32 of the id as text mod 5) give no label.  Defined results: a null text is the empty text and has a score;
equal texts score alike; labels of an id that disagree, null labels and ids
are not learned from; rows of one id are told apart by their texts; without
positives every score is 0; empty table, empty result; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import U64, mix64, passes, stage, texts_as_bytes, unstage
from adlake.llm.shingles import word_hashes

#: A share of one, and the resolution of weights and factors.
UNIT, FINE = 1 << 10, 1 << 16
FOLDS, PRIOR_FOLD = 5, 4
#: Rows whose sums surely stay within 64 bits.
SUMMED = 1 << 20

_CLASSES = {"space": " \t\x0b\x0c\r", "line": "\n", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": "0123456789", "symbol": "#*$%&<>@^~_=+\\/", "bar": "|", "mark": "!?", "point": ".,;:", "quote": "\"'`()[]{}-"}
_CLASS = np.zeros(256, np.int64)
for _i, _signs in enumerate(_CLASSES.values(), 1):
    _CLASS[[ord(c) for c in _signs]] = _i
_CLASS[128:] = len(_CLASSES) + 1
NAMES = ("one", *(c for c in _CLASSES if c != "space"), "beyond_ascii", "few_words", "few_windows", "same_neighbour", "word_bytes", "words", "empty")


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Distinct values of each owner."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.append(True, (v[1:] != v[:-1]) | (o[1:] != o[:-1])) if len(v) else np.zeros(0, bool)
    return np.bincount(o[new], minlength=n)


def features(texts: list[bytes]) -> np.ndarray:
    """One row of integers of ``UNIT`` for each text, by NAMES."""
    n, kinds = len(texts), len(_CLASSES) + 2
    size = np.fromiter(map(len, texts), np.int64, n)
    owner = np.repeat(np.arange(n), size)
    by = np.bincount(owner * kinds + _CLASS[np.frombuffer(b"".join(texts), np.uint8)], minlength=n * kinds).reshape(n, kinds)
    hashes, words = word_hashes(texts, lower=False)
    of = np.repeat(np.arange(n), words)
    inside = of[2:] == of[:-2]
    windows = mix64(mix64(hashes[:-2] * U64(3) + hashes[1:-1]) * U64(5) + hashes[2:])[inside] if len(hashes) > 2 else np.zeros(0, np.uint64)
    window_of = of[2:][inside] if len(hashes) > 2 else np.zeros(0, np.int64)
    n_windows = np.bincount(window_of, minlength=n)
    same = np.bincount(of[1:][(hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])], minlength=n) if len(hashes) > 1 else np.zeros(n)
    drawn = np.maximum(size - by[:, 1] - by[:, 2], 1)
    columns = [np.ones(n)]
    for name, count in zip(_CLASSES, by.T[1:], strict=False):
        if name != "space":
            columns.append(np.sqrt(np.minimum(count / (np.maximum(words, 1) if name == "line" else drawn), 1)))
    columns += [
        np.sqrt(by[:, -1] / drawn),
        1 - _distinct(hashes, of, n) / np.maximum(words, 1),
        1 - _distinct(windows, window_of, n) / np.maximum(n_windows, 1),
        np.sqrt(same / np.maximum(words, 1)),
        np.minimum(drawn / np.maximum(words, 1) / 32, 1) * (words > 0),
        np.minimum(np.log2(1 + words) / 16, 1.5),
        words == 0,
    ]
    columns[-6][words == 0] = columns[-5][words == 0] = 0
    columns[-5][n_windows == 0] = 0
    return np.floor(np.stack(columns, 1) * UNIT).astype(np.int64)


def fold(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)).cast("int")


def feature_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, hash, x, fold, trusted) of every row, staged: a hash of its text, its
    features, and whether it is a good document that may be learned from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_as_bytes(batch.column(1))
            for a, b in passes(np.fromiter(map(len, texts), np.int64, len(texts))):
                x = features(texts[a:b]).astype(np.int16)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), lists], names=["id", "hash", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash")).mapInArrow(run, f"id {kind}, hash bigint, x array<smallint>")
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("low"), F.max(label_col).alias("high"))
    good = marks.where("low = 1 and high = 1").select("id", F.lit(True).alias("good"))
    found = rows.join(good, "id", "left").withColumn("fold", fold("id"))
    return stage(found.select("id", "hash", "x", "fold", (F.coalesce("good", F.lit(False)) & (F.col("fold") != 0)).alias("trusted")), "web-quality")


def _linear(batch: pa.RecordBatch, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of a batch, and its linear scores: exact, as both sides are integers."""
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.float64)
    return x, (x @ weights) / (UNIT * FINE)


def _fixed(weights: np.ndarray) -> np.ndarray:
    return np.round(weights * FINE)


@dataclass
class Sums:
    """Of a group of rows: their number, means of ``log(1 + exp f)``, ``f``, the
    gradients of both and the Hessian of the first."""

    n: int
    loss: float
    f: float
    grad: np.ndarray
    mean: np.ndarray
    hess: np.ndarray

    @classmethod
    def of(cls, totals: list[int], weights: np.ndarray) -> Sums:
        m = len(weights)
        n = totals[0]
        t = np.array([float(v) for v in totals[1:]]) / max(n, 1)
        grad, mean, hess = t[1 : 1 + m] / (UNIT * FINE), t[1 + m : 1 + 2 * m] / UNIT, t[1 + 2 * m :].reshape(m, m) / (UNIT * UNIT * FINE)
        return cls(n, t[0] / FINE, float(mean @ weights) / FINE, grad, mean, hess)


def _sums(rows: DataFrame, weights: np.ndarray) -> tuple[Sums, Sums]:
    """Sums over all rows and over the trusted ones, by one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, seen = len(weights), 0
        total = np.zeros((2, 2 + 2 * m + m * m), np.int64)

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.int64()))], names=["s"])
            total[:] = 0
            return made

        for batch in batches:
            if not batch.num_rows:
                continue
            x, f = _linear(batch, weights)
            s = 1 / (1 + np.exp(-f))
            parts = np.round(np.stack([np.logaddexp(0, f), s, s * (1 - s)], 1) * FINE)
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
            for group, (a, p) in enumerate(((x, parts), (x[trusted], parts[trusted]))):
                sums = [[len(a), p[:, 0].sum()], p[:, 1] @ a, a.sum(0), ((a * p[:, 2:]).T @ a).ravel()]
                total[group] += np.concatenate(sums).astype(np.int64)
            seen += batch.num_rows
            if seen >= SUMMED:
                yield out()
                seen = 0
        yield out()

    places = rows.select("x", "trusted").mapInArrow(run, "s array<bigint>").select(F.posexplode("s").alias("i", "v"))
    found = {r["i"]: int(r["v"]) for r in places.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()}
    half = 2 + 2 * len(weights) + len(weights) ** 2
    totals = [found.get(i, 0) for i in range(2 * half)]
    return Sums.of(totals[:half], weights), Sums.of(totals[half:], weights)


def _tails(rows: DataFrame, weights: np.ndarray) -> list[tuple[int, int, int]]:
    """(bin, rows, trusted rows) of the linear score in 64ths, at most 4097 bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, f = _linear(batch, weights)
            bins, at = np.unique(np.clip(np.floor(f * 64), -2048, 2048).astype(np.int64), return_inverse=True)
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(np.bincount(at, minlength=len(bins))), pa.array(np.bincount(at[trusted], minlength=len(bins)))], names=["bin", "u", "p"])

    counted = rows.select("x", "trusted").mapInArrow(run, "bin long, u long, p long").groupBy("bin").agg(F.sum("u").alias("u"), F.sum("p").alias("p"))
    return sorted((r["bin"], r["u"], r["p"]) for r in counted.collect())


def best_bin_prior(tails: list[tuple[int, int, int]], delta: float = 0.1, slack: float = 0.01) -> float:
    """The share of positives among the rows: the ratio of upper tails where its
    upper confidence bound is least."""
    all_u, all_p = sum(u for _, u, _ in tails), sum(p for _, _, p in tails)
    if not all_u or not all_p:
        return 0.5
    wide = math.sqrt(math.log(4 / delta) / (2 * all_u)) + math.sqrt(math.log(4 / delta) / (2 * all_p))
    found, u, p = [], 0, 0
    for _, more_u, more_p in reversed(tails):
        u, p = u + more_u, p + more_p
        if p:
            qu, qp = u / all_u, p / all_p
            found.append((qu / qp + (1 + slack) * wide / qp, qu / qp))
    return min(max(min(found)[1], 1e-3), 1 - 1e-3)


@dataclass
class Model:
    weights: np.ndarray
    prior: float
    risk: float
    learned: bool = True


def _ridge(m: int, ridge: float) -> np.ndarray:
    """The penalty of each weight; none for the constant."""
    return np.array([1e-9] + [ridge] * (m - 1))


def _newton(start: np.ndarray, of: Callable[[np.ndarray], tuple[float, float, np.ndarray, np.ndarray, np.ndarray]], ridge: float, steps: int, tol: float = 1e-3, back: float = 0.5) -> tuple[np.ndarray, float]:
    """Steps from ``start`` by ``of(weights) -> (risk, loss that can't be negative,
    gradient, Hessian, gradient of that loss)``; the best weights and their risk."""
    w, pen = start, _ridge(len(start), ridge)
    best, found, last = math.inf, start, math.inf
    for _ in range(steps):
        risk, rest, grad, hess, grad_rest = of(w)
        risk += float(pen @ (w * w)) / 2
        if risk < best:
            best, found = risk, w
        if abs(last - risk) <= tol * abs(risk):
            break
        last = risk
        if rest < 0:
            w = _fixed(w + back * grad_rest) / FINE
            continue
        step = np.linalg.solve(hess + np.diag(pen), grad + pen * w)
        w = _fixed(w - step * min(1.0, 5.0 / max(float(np.abs(step).max()), 1e-12))) / FINE
    return found, best


def learn(rows: DataFrame, ridge: float = 1e-4, steps: int = 16) -> Model:
    """The linear model of the least non-negative risk, from ``feature_rows``."""
    m = len(NAMES)
    zero = np.zeros(m)
    texts = stage(rows.groupBy("hash", "x").agg(F.bool_or("trusted").alias("trusted")), "web-texts")
    part = F.pmod("hash", F.lit(FOLDS))
    train, seen = texts.where(part != PRIOR_FOLD), texts.where(part == PRIOR_FOLD)
    if train.where("trusted").isEmpty():
        return Model(zero, 0.0, math.inf, learned=False)

    def apart(w: np.ndarray):
        u, p = _sums(train, _fixed(w))
        return u.loss + p.loss - p.f, 0.0, u.grad + p.grad - p.mean, u.hess + p.hess, zero

    first, _ = _newton(zero, apart, 1e-3, steps)
    tails = _tails(seen, _fixed(first))
    if not any(p for _, _, p in tails):
        tails = _tails(train, _fixed(first))
    prior = best_bin_prior(tails)

    def non_negative(w: np.ndarray):
        u, p = _sums(train, _fixed(w))
        rest = u.loss - prior * p.loss
        return prior * (p.loss - p.f) + max(rest, 0.0), rest, u.grad - prior * p.mean, u.hess, u.grad - prior * p.grad

    start = zero.copy()
    start[0] = math.log(prior / (1 - prior))
    weights, risk = _newton(_fixed(start) / FINE, non_negative, ridge, steps)
    unstage(texts)
    return Model(weights, prior, risk)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """(id, fold, score) of ``feature_rows``."""
    weights, learned = _fixed(model.weights), model.learned

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, f = _linear(batch, weights)
            score = np.round(1 / (1 + np.exp(-f)), 9) if learned else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("fold"), pa.array(score)], names=["id", "fold", "score"])

    return rows.select("id", "x", "fold").mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fold int, score double")


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, fold, score) of every document by the model learned from its trusted ones."""
    rows = feature_rows(docs, labels, id_col, text_col, label_col)
    found = stage(scored(rows, learn(rows)), "web-scores")
    unstage(rows)
    return found
