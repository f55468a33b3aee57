"""Toxic passages by maximum-scoring segments (operator 8).

*Weights.*  For every token, its log-odds between toxic and other labelled
documents under a Dirichlet prior: the prior of a token is its share of all
labelled tokens times ``prior_tokens``.  A token counts once for a document,
so one document's repetitions weigh little, and documents of equal words count
once for a class, so copies of one text weigh as one (near copies, which differ
in a word, count each).  Tokens whose counts differ between the classes by a
root of the log-likelihood ratio of at least ``min_z`` score, however small the
factor; all others count as nothing but length.  A drift is taken from every
token so that ordinary text loses.

*Segments.*  One linear-time scan of a text's token scores finds all of its
maximal scoring segments (disjoint; none can be extended or shortened to score
more).

*Calibration.*  The best segment of random text of ``n`` tokens follows an
extreme-value law: ``lambda`` solves E[exp(lambda s)] = 1 over the scores of
non-toxic tokens, and ``lambda S - ln n`` places a segment score ``S`` on that
law.  Segments significant at ``p`` are the toxic passages; a document's
evidence is the best segment's place and the sum of significant ones, mapped
to a probability by a logistic fit on labelled documents that gave no weights.

Training sees the labelled documents whose crc32(id as text) mod 5 is 1-3
(weights) and 4 (calibration); remainder 0 is held out.

The model is the scoring tokens only, however many.  The ``held`` ones of most
texts are sent to the tasks; if there are more, those stay in a staged table
that the documents' own tokens are joined to, with the same results.  Weights
have ``DIGITS`` decimals.  Defined results: a null or empty text has no
segment and the lowest evidence; equal texts score alike; without both classes
in training nothing scores and every document gets the training share of
toxic ones (0 without labels); null ids or labels are not learned from.
"""

from __future__ import annotations

import hashlib
import math
from collections import ChainMap, Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import arrow, marked_by, partitions, stage, unstage

FOLDS = 5
#: Decimals of a weight, so that all weights together are a bounded table of values.
DIGITS = 3


def fold(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS))


#: Signs that are taken off the ends of a word.
EDGES = ".,;:!?*#$%&|<>()[]{}\"'`~^_=+/\\-"


def tokens(text: str) -> list[str]:
    """Lower-case words between white space, without signs at their ends."""
    return [w.strip(EDGES) for w in text.lower().split()]


def segments(scores: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """(score, first, last) of all maximal scoring segments of a sequence in
    which the given places score and every token costs ``drift``.

    Linear time: each candidate keeps the total before and after it; a new one
    is put together with the last candidate that starts from a lower total, if
    that one also ends lower, and so on.
    """
    done: list[tuple[float, float, int, int]] = []  # total before, total after, first, last
    total, last = 0.0, -1
    link: list[int] = []
    for at, score in scores:
        total -= drift * (at - last - 1)
        last = at
        if score - drift <= 0:
            total += score - drift
            continue
        low, high, first = total, total + score - drift, at
        total = high
        while True:
            j = len(done) - 1
            while j >= 0 and done[j][0] >= low:
                j = link[j]
            if j < 0 or done[j][1] >= high:
                break
            low, first = done[j][0], done[j][2]
            del done[j:], link[j:]
        done.append((low, high, first, at))
        link.append(j)
    return [(b - a, i, k) for a, b, i, k in done]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    #: (token, odds) of the scoring tokens that ``weights`` doesn't hold, staged.
    table: DataFrame | None = None
    drift: float = 0.05
    lam: float = 1.0
    p: float = 0.01
    #: Intercept, weight of the best place, weight of the sum of significant places.
    logistic: tuple[float, float, float] = (-math.inf, 0.0, 0.0)

    def sent(self) -> Model:
        """The model that goes to the tasks."""
        return replace(self, table=None)

    def scan(self, words: list[str], more: dict[str, float] | None = None) -> list[tuple[float, int, int]]:
        """(place on the extreme-value law, first token, last token) of each
        segment; ``more``: the words' weights that ``weights`` doesn't hold."""
        get = ChainMap(self.weights, more).get if more else self.weights.get
        scored = [(i, x) for i, x in enumerate(map(get, words)) if x is not None]
        if not scored:
            return []
        size = math.log(len(words))
        return [(self.lam * s - size, a, b) for s, a, b in segments(scored, self.drift)]

    def significant(self, place: float) -> bool:
        """P(best segment of ordinary text this long >= it) <= p, by the extreme-value law."""
        return -math.expm1(-math.exp(-place)) <= self.p

    def evidence(self, words: list[str], more: dict[str, float] | None = None) -> tuple[float, float, int]:
        found = [x for x, _, _ in self.scan(words, more)]
        strong = [x for x in found if self.significant(x)]
        return max(found, default=-math.log(len(words) + 1)), sum(strong), len(strong)

    def probability(self, best: float, total: float) -> float:
        a, b, c = self.logistic
        z = a + b * math.tanh(best / 10) + c * math.log1p(max(total, 0.0))
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(key, toxic, text) over rows (text, toxic): rows with equal words have equal
    keys and stand side by side; a task sends each of its own once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[bytes, int]] = set()
        for batch in batches:
            out: list[list] = [[], [], []]
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                key = hashlib.blake2b("\0".join(tokens(text or "")).encode("utf-8", "surrogatepass"), digest_size=16).digest()
                if (key, toxic) in seen:
                    continue
                if len(seen) >= 500_000:
                    seen.clear()
                seen.add((key, toxic))
                for column, x in zip(out, (key, toxic, text), strict=True):
                    column.append(x)
            yield arrow({"key": (out[0], pa.binary()), "toxic": (out[1], pa.int32()), "text": (out[2], pa.string())})

    keyed = rows.select("text", F.col("toxic").cast("int")).mapInArrow(run, "key binary, toxic int, text string")
    return keyed.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key", "toxic")


def token_counts(rows: DataFrame) -> DataFrame:
    """(token, toxic, other): the texts of rows (text, toxic) with differing words that
    hold the token, by class; combined within each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        last = None

        def out() -> pa.RecordBatch:
            words = list(counts[0].keys() | counts[1].keys())
            made = arrow({"token": (words, pa.string()), "toxic": ([counts[1][w] for w in words], pa.int64()), "other": ([counts[0][w] for w in words], pa.int64())})
            for c in counts:
                c.clear()
            return made

        for batch in batches:
            for key, toxic, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (key, toxic) == last:
                    continue
                last = (key, toxic)
                counts[bool(toxic)].update(set(tokens(text or "")))
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield out()
        yield out()

    return distinct_texts(rows).mapInArrow(run, "token string, toxic long, other long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _scored(counts: DataFrame, t_all: float, o_all: float, prior_tokens: float, min_z: float) -> DataFrame:
    """(token, odds, other, both) of the tokens that differ between the classes."""
    prior = (F.col("toxic") + F.col("other")) / F.lit(t_all + o_all) * F.lit(prior_tokens)
    t, o = F.col("toxic") + prior, F.col("other") + prior
    odds = F.log(t / (F.lit(t_all + prior_tokens) - t)) - F.log(o / (F.lit(o_all + prior_tokens) - o))
    both = F.col("toxic") + F.col("other")
    ratio = F.lit(0.0)
    for column, share in (("toxic", t_all / (t_all + o_all)), ("other", o_all / (t_all + o_all))):
        ratio = ratio + F.when(F.col(column) > 0, F.col(column) * F.log(F.col(column) / (both * F.lit(share)))).otherwise(0.0)
    z = F.sqrt(F.greatest(2 * ratio, F.lit(0.0)))
    return counts.where("token <> ''").where(z >= min_z).select("token", F.round(odds, DIGITS).alias("odds"), "other", both.alias("both"))


def learn(labelled: DataFrame, prior_tokens: float = 1_000.0, min_z: float = 4.5, held: int = 100_000, p: float = 0.01) -> Model:
    """``labelled``: (text, toxic 0/1, fold 1-4)."""
    model = Model(p=p)
    train = labelled.where(F.col("fold") < FOLDS - 1).select("text", "toxic")
    counts = stage(token_counts(train), "token-counts")
    whole = counts.agg(F.sum("toxic").alias("t"), F.sum("other").alias("o")).first()
    t_all, o_all = float(whole["t"] or 0), float(whole["o"] or 0)
    if t_all and o_all:
        scored = stage(_scored(counts, t_all, o_all, prior_tokens, min_z), "toxic-weights")
        first = scored.orderBy(F.col("both").desc(), "token").limit(held).collect()
        model.weights = {r["token"]: r["odds"] for r in first}
        if scored.count() > len(first):
            last = first[-1]
            model.table = scored.where((F.col("both") < last["both"]) | ((F.col("both") == last["both"]) & (F.col("token") > last["token"]))).select("token", "odds")
        by_odds = scored.groupBy("odds").agg(F.sum("other").alias("other")).orderBy("odds").collect()
        shares = [(r["odds"], r["other"] / o_all) for r in by_odds]
        rest = 1 - sum(q for _, q in shares)
        mean = sum(s * q for s, q in shares)
        model.drift = max(0.02, 2 * mean)
        model.lam = _lambda([(s - model.drift, q) for s, q in shares] + [(-model.drift, rest)])
        if model.table is None:
            unstage(scored)
    model.logistic = _logistic(_evidence_table(labelled.where(F.col("fold") == FOLDS - 1), model))
    unstage(counts)
    return model


def _with_more(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with a column ``more``, the weights of a text's words that
    ``model.weights`` doesn't hold (null without any).  Those it holds are the
    ones of most texts, so no token of the join is in more texts than they are."""
    if model.table is None:
        return rows.withColumn("more", F.lit(None).cast("map<string,double>"))
    own = stage(rows.withColumn("__row", F.monotonically_increasing_id()), "toxic-rows")
    known = model.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[str] = []
        of: list[int] = []
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                new = [w for w in set(tokens(text or "")) if w and w not in known]
                words += new
                of += [row] * len(new)
                if len(words) > 200_000:
                    yield arrow({"token": (words, pa.string()), "__row": (of, pa.int64())})
                    words, of = [], []
        yield arrow({"token": (words, pa.string()), "__row": (of, pa.int64())})

    pairs = own.select("__row", "text").mapInArrow(run, "token string, __row long").join(model.table, "token")
    more = pairs.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("token", "odds"))).alias("more"))
    return own.join(more, "__row", "left").drop("__row")


def _lambda(scores: list[tuple[float, float]]) -> float:
    """The positive root of E[exp(lambda s)] = 1 (bisection; 1 if no score is positive)."""
    if not any(s > 0 and q > 0 for s, q in scores):
        return 1.0

    def excess(x: float) -> float:
        return sum(q * math.expm1(min(x * s, 500.0)) for s, q in scores)

    low, high = 0.0, 1.0
    while excess(high) < 0 and high < 1e3:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if excess(mid) > 0 else (mid, high)
    return max(high, 1e-6)


def _evidence_table(rows: DataFrame, model: Model) -> list[tuple[int, float, float, int]]:
    """(label, best, total, documents), counted by rounded evidence: a bounded table."""

    sent = model.sent()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, total = [], []
            for text, more in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                x, y, _ = sent.evidence(tokens(text or ""), dict(more or ()))
                best.append(round(10 * math.tanh(x / 10), 1))
                total.append(round(math.log1p(max(y, 0.0)), 1))
            yield arrow({"best": (best, pa.float64()), "total": (total, pa.float64()), "toxic": (batch.column(1).cast(pa.int64()).to_pylist(), pa.int64())})

    counted = _with_more(rows.select("text", "toxic"), model).mapInArrow(run, "best double, total double, toxic long").groupBy("toxic", "best", "total").count()
    return sorted((r["toxic"], r["best"] / 10, r["total"], r["count"]) for r in counted.collect())


def _logistic(table: list[tuple[int, float, float, int]]) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps on a table of counts."""
    if not table:
        return (-math.inf, 0.0, 0.0)
    x = np.array([(1.0, b, t) for _, b, t, _ in table])
    y, n = np.array([r[0] for r in table], float), np.array([r[3] for r in table], float)
    beta = np.zeros(3)
    ridge = np.diag([1e-6, 1e-2, 1e-2])
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (n * q * (1 - q))) @ x + ridge, x.T @ (n * (y - q)) - ridge @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in beta)


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(text, toxic, fold) of the labelled documents that may be learned from,
    joined once and kept in the shared folder."""
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("toxic"))
    marks = marks.withColumn("fold", fold("__id")).where("fold <> 0")
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text")).where(fold("__id") != 0)
    # Bits of the labelled ids first: the texts of others are not sent.
    return stage(marked_by(rows, marks.select("__id")).join(marks.hint("merge"), "__id").select("text", "toxic", "fold"), "toxic-labelled")


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_tokens, n_passages, best_place, passages) of every row; a
    passage is (first token, last token, text, place on the extreme-value law)."""
    sent = model.sent()
    shape = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("text", pa.string()), ("place", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text, more in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                words = tokens(text or "")
                found = sent.scan(words, dict(more or ()))
                strong = [x for x in found if sent.significant(x[0])]
                best = max((x[0] for x in found), default=-math.log(len(words) + 1))
                score = sent.probability(best, sum(x[0] for x in strong))
                passages = [{"first": a, "last": b, "text": " ".join(words[a : b + 1]), "place": x} for x, a, b in strong]
                for column, x in zip(out, (score, len(words), len(strong), best, passages), strict=True):
                    column.append(x)
            types = [pa.float64(), pa.int64(), pa.int64(), pa.float64(), shape]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(c, t) for c, t in zip(out, types, strict=True))], names=["id", "score", "n_tokens", "n_passages", "best_place", "passages"])

    schema = "id long, score double, n_tokens long, n_passages long, best_place double, passages array<struct<first:int,last:int,text:string,place:double>>"
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return _with_more(rows, model).mapInArrow(run, schema)
