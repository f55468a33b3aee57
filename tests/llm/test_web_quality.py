"""Positive-unlabelled quality scores: features by definition, sums against
plain NumPy, the prior, and held-out accuracy."""

import math
import random
import zlib

import numpy as np
import pytest

from adlake.llm import queries, web_quality


def plain(text: bytes) -> dict:
    """Features by their definitions, word by word."""
    words = [w for w in text.translate(bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")).split(b" ") if w]
    drawn = max(sum(c not in b" \t\n\x0b\x0c\r" for c in text), 1)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    n = max(len(words), 1)
    out = {"one": 1.0, "empty": float(not words), "words": min(math.log2(1 + len(words)) / 16, 1.5), "word_bytes": min(drawn / n / 32, 1) if words else 0.0}
    out["few_words"] = 1 - len(set(words)) / n if words else 0.0
    out["few_windows"] = 1 - len(set(windows)) / len(windows) if windows else 0.0
    out["same_neighbour"] = math.sqrt(sum(a == b for a, b in zip(words, words[1:], strict=False)) / n)
    for name, signs in (("upper", bytes(range(65, 91))), ("digit", b"0123456789"), ("bar", b"|"), ("mark", b"!?"), ("symbol", b"#*$%&<>@^~_=+\\/"), ("point", b".,;:"), ("quote", b"\"'`()[]{}-"), ("beyond_ascii", bytes(range(128, 256)))):
        out[name] = math.sqrt(sum(c in signs for c in text) / drawn)
    out["line"] = math.sqrt(min(text.count(b"\n") / n, 1))
    return out


def test_features_by_definition():
    rnd = random.Random(1)
    texts = [b"", b" ", b"\n\n", b"a", b"a a a a", b"Ab! ab? #1 | x\nAb! ab? #1", "é é ж\t\x0bц".encode(), b"x" * 5000]
    texts += [" ".join(rnd.choice(["the", "OF", "a!", "b|", "3", "né", "\n", "(q)"]) for _ in range(rnd.randint(1, 80))).encode() for _ in range(40)]
    got = web_quality.features(texts)
    for row, text in zip(got, texts, strict=True):
        want = plain(text)
        assert [abs(v / web_quality.UNIT - want[name]) < 1.001 / web_quality.UNIT for name, v in zip(web_quality.NAMES, row, strict=True)].count(False) == 0, (text, dict(zip(web_quality.NAMES, row, strict=True)), want)


def test_sums_are_exact_and_do_not_depend_on_partitions(spark):
    rnd = np.random.default_rng(3)
    m = len(web_quality.NAMES)
    x = rnd.integers(0, 1024, (500, m))
    trusted = rnd.random(500) < 0.3
    rows = spark.createDataFrame([(i, v.tolist(), i % 5, bool(t)) for i, (v, t) in enumerate(zip(x, trusted, strict=True))], "id long, x array<smallint>, fold int, trusted boolean")
    w = np.round(rnd.normal(0, 1, m) * web_quality.FINE)
    once, again = (web_quality._sums(rows.repartition(k), w) for k in (1, 7))
    for a, b in zip(once, again, strict=True):
        assert a.n == b.n and a.loss == b.loss and (a.hess == b.hess).all() and (a.grad == b.grad).all()
    f = x @ w / web_quality.UNIT / web_quality.FINE
    s = 1 / (1 + np.exp(-f))
    z = x / web_quality.UNIT
    assert once[0].loss == pytest.approx(np.logaddexp(0, f).mean(), abs=1e-4)
    assert np.allclose(once[0].grad, (z * s[:, None]).mean(0), atol=1e-4)
    assert np.allclose(once[0].hess, (z.T * (s * (1 - s))) @ z / 500, atol=1e-4)
    assert once[1].f == pytest.approx(f[trusted].mean(), abs=1e-9)


def test_prior_of_a_known_mixture():
    rnd = np.random.default_rng(4)
    for share in (0.2, 0.5, 0.9):
        good = rnd.normal(1, 1, 20_000)
        all_ = np.where(rnd.random(40_000) < share, rnd.normal(1, 1, 40_000), rnd.normal(-2, 1, 40_000))
        bins = np.arange(-400, 400)
        count = lambda v: np.bincount(np.clip(np.floor(v * 64), -400, 399).astype(int) + 400, minlength=800)
        assert web_quality.best_bin_prior(list(zip(bins.tolist(), count(all_).tolist(), count(good).tolist(), strict=True))) == pytest.approx(share, abs=0.06)


def test_risk_that_falls_below_zero_goes_back():
    calls = []

    def of(w):
        calls.append(w.copy())
        return 1.0 / len(calls), (-1.0 if len(calls) == 2 else 1.0), np.array([0.0, 1.0]), np.eye(2), np.array([0.0, 4.0])

    web_quality._newton(np.zeros(2), of, 0.0, 3)
    assert calls[1][1] < 0 and calls[2][1] == pytest.approx(calls[1][1] + 2.0)


def words(rnd, good):
    base = [rnd.choice(["the", "ban", "rest", "of", "sing", "er", "lo", "ton", "mi", "sa"]) + rnd.choice(["a", "en", "ing", "o", ""]) for _ in range(rnd.randint(60, 120))]
    return " ".join(base) + "." if good else " ".join(w + rnd.choice(["###", "%%%", "!!"]) for w in base)


def test_held_out_accuracy_and_defined_results(spark):
    rnd = random.Random(7)
    good = {i: rnd.random() < 0.7 for i in range(900)}
    docs = [(i, words(rnd, g)) for i, g in good.items()]
    docs += [(5000 + i, docs[0][1]) for i in range(400)]  # a hot group of copies
    docs += [(6000, None), (6001, ""), (None, docs[3][1]), (3, docs[3][1]), (6002, "word " * 200_000)]
    labels = [(i, int(g)) for i, g in good.items() if i % 2] + [(None, 1), (6003, None), (3, 1), (3, 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as x", "2 as fold", "true as trusted", "doc_id as id", "0 as score")
    lab = spark.createDataFrame(labels, "doc_id long, quality int").selectExpr("*", "1 as good", "0 as low")
    got = web_quality.quality_scores(d, lab).collect()
    assert len(got) == len(docs)
    by = {r.id: r.score for r in got}
    held = [i for i in good if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((by[i] >= 0.5) == good[i] for i in held) / len(held) > 0.97
    assert by[6000] == by[6001] and all(0 <= s <= 1 for s in by.values())
    assert all(by[5000 + i] == by[0] for i in range(400)) and by[None] == by[3]


def test_labels_of_held_out_rows_change_nothing(spark):
    rnd = random.Random(8)
    docs = [(i, words(rnd, i % 3 > 0)) for i in range(300)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    outside = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    found = []
    for flip in (0, 1):
        lab = spark.createDataFrame([(i, int(i % 3 > 0) ^ (flip and outside(i))) for i in range(300)], "doc_id long, quality int")
        found.append(sorted((r.id, r.score) for r in web_quality.quality_scores(d.repartition(2 + flip), lab).collect()))
    assert found[0] == found[1]


def test_empty_and_without_positives(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in web_quality.quality_scores(docs, none).collect()] == [0.0, 0.0]
    assert web_quality.quality_scores(docs.where("doc_id = 9"), none).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES["op12_web_quality"](spark, sf).collect()}
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(got[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0 and i in got]
    assert all(r.held_out for r, _ in held)
    assert sum(r.predicted == y for r, y in held) / len(held) > 0.95
