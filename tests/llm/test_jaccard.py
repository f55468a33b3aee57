"""The n-gram Jaccard join against brute force."""

import random
import re
from fractions import Fraction

import numpy as np
import pytest

from adlake.llm import jaccard, queries


def brute(docs, k, num, den):
    sets = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if docs[i][0] is not None and docs[j][0] is not None and sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), 1 << 60), d)
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(docs)), key=str)


def made():
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    docs = []
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.choice([2, 4, 11, 30, 60, 120, 200]))]
        cur = list(base)
        for _ in range(20):
            if rnd.random() < 0.3:
                cur = list(base)
            for _ in range(rnd.randint(0, 2)):
                cur[rnd.randrange(len(cur))] = rnd.choice(words)
            docs.append((len(docs), rnd.choice([" ", "\n", "\t "]).join(x.upper() if rnd.random() < 0.1 else x for x in cur)))
    docs += [(1000, None), (1001, ""), (1002, "  "), (None, docs[0][1]), (5, docs[5][1]), (1003, "one"), (1004, "ONE"), (1005, "é É")]
    rnd.shuffle(docs)
    return docs


@pytest.mark.parametrize(("k", "similarity", "unit"), [(3, "9/10", 4_000_000), (3, "9/10", 300), (5, "4/5", 300), (1, "1/2", 300)])
def test_components(spark, k, similarity, unit):
    docs, f = made(), Fraction(similarity)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((r.id, r.n_ngrams, r.component) for r in jaccard.ngram_jaccard_join(df, k, f, unit_ngrams=unit).collect()), key=str)
    assert got == brute(docs, k, f.numerator, f.denominator)


def test_empty_table(spark):
    assert jaccard.ngram_jaccard_join(spark.createDataFrame([], "doc_id long, text string"), 3, Fraction(9, 10)).count() == 0


def test_query_against_brute_force(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.QUERIES["op10_ngram_jaccard_join"](spark, sf_small).collect()), key=str) == brute(docs, 3, 9, 10)


def test_bounds_never_lose_a_pair():
    rnd = np.random.default_rng(1)
    for f in (Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)):
        bounds = jaccard.Bounds(f)
        for _ in range(60):
            n = int(rnd.integers(1, 300))
            a = rnd.choice(1 << 62, n, replace=False).astype(np.uint64)
            b = a[rnd.random(n) > (1 - float(f)) / 2]
            b = np.concatenate([b, rnd.choice(1 << 62, int(rnd.integers(0, max(1, n // 12) + 1)), replace=False).astype(np.uint64)])
            overlap = len(np.intersect1d(a, b))
            if not len(b) or not bounds.linked(overlap, len(a), len(b)) or len(np.union1d(a, b)) == overlap:
                continue
            digest, row = jaccard.block_digests(np.concatenate([np.sort(a), np.sort(b)]), np.array([len(a), len(b)]), bounds)
            assert np.intersect1d(digest[row == 0], digest[row == 1]).size


def test_rounds_of_products_find_the_same(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    rows = [(10 * g + c, " ".join(words[g * 7 + (c > 3) : g * 7 + 60])) for g in range(8) for c in range(6)]
    docs = spark.createDataFrame([*rows, (999, None), (None, "w1 w2")], "doc_id long, text string")
    sent, own = [], jaccard.stage
    monkeypatch.setattr(jaccard, "stage", lambda df, name: (sent.append(name), own(df, name))[1])
    found = []
    for bytes_of_round in (1 << 30, 1):
        monkeypatch.setattr(jaccard, "ROUND_BYTES", bytes_of_round)
        monkeypatch.setattr(jaccard, "ROUNDS", 3)
        sent.clear()
        found.append((sorted(map(str, jaccard.ngram_jaccard_join(docs, 3, jaccard.exactly("0.8")).collect())), sent.count("ngram-links")))
    assert found[0][0] == found[1][0] and [x[1] for x in found] == [1, 3]
