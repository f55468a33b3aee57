"""Spelling variants by trie-node pairs against comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np

from adlake.llm import queries, spellings


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs, min_letters=6, min_count=5, factor=5):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_letters and n >= min_count}
    form, n_near = {}, {}
    for w, n in words.items():
        others = [o for o in words if abs(len(o) - len(w)) <= 1 and near(o, w)]
        n_near[w] = len(others)
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= factor * n else None
    found = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        found.append((w, form[w], root, n, n_near[w], words.get(form[w])))
    return sorted(found, key=str)


def run(spark, docs, extra=False, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    if extra:
        df = df.selectExpr("*", "1 as word", "2 as n", "3 as rank", "doc_id as id", "'x' as nodes")
    found = spellings.spelling_variants(df, **kw)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, found.collect()), key=str)


def made():
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abé") for _ in range(rnd.randint(5, 8))) for _ in range(40)] + ["aaaaaaa", "aaaaaaaa", "Éaaaaaa", "éaaaaaa", "÷÷÷÷÷÷×"]
    docs = []
    for i in range(400):
        text = []
        for _ in range(rnd.randint(0, 60)):
            w = base[min(int(rnd.expovariate(0.12)), len(base) - 1)]
            while rnd.random() < 0.25:
                j = rnd.randrange(len(w))
                w = w[:j] + rnd.choice(["", "a", "b", "é", "ab"]) + w[j + rnd.randint(0, 1) :]
            text.append(w.upper() if rnd.random() < 0.1 and "é" not in w else w)
        docs.append((i, rnd.choice([" ", "\n", "1", "_", "ā"]).join(text)))
    long = "xyz" * 3000
    docs += [(900 + i, " ".join([long + "q", long[:4000] + "k" + long[4001:], long] * (1 + i))) for i in range(5)]
    docs += [(500, None), (501, ""), (502, " "), (None, docs[3][1]), (3, docs[3][1])]
    return docs


def test_against_brute_force(spark):
    docs = made()
    got = run(spark, docs, extra=True)
    assert got == brute(docs)
    assert sum(r[1] is not None for r in got) > 20
    assert any(r[1] != r[2] for r in got if r[1])


def test_hot_word_and_other_limits(spark):
    docs = [(i, "tion " * 500 + ("tions " if i % 7 else "tian ")) for i in range(60)]
    assert run(spark, docs, min_letters=4, min_count=1, factor=2) == brute(docs, 4, 1, 2)


def test_without_words(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, ""), (None, "abc"), (4, "abcdefg")]) == []


def test_trie_numbers_do_not_depend_on_partitions():
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9))) for _ in range(120)})
    whole = {w: spellings.nodes(p, len(w)).tolist() for w, p, _ in spellings.descend(iter(words), "", [], 1)}
    assert len({n for v in whole.values() for n in v}) == len({w[:i] for w in words for i in range(len(w) + 1)})
    for cuts in ([], [1], [5, 6, 7], sorted(rnd.sample(range(1, len(words)), 30)), list(range(1, len(words)))):
        parts = [words[a:b] for a, b in zip([0, *cuts], [*cuts, len(words)], strict=True)]
        edges = []
        for i, part in enumerate(parts):
            *_, (last, path, free) = spellings.descend(iter(part), "", [], 1)
            edges.append({"part": 2 * i, "rows": len(part), "first": part[0], "last": last, "used": free - 1, "depths": [d for d, _ in path], "starts": [n for _, n in path]})
        begin = spellings.chained(edges)
        for i, part in enumerate(parts):
            before, path, free, rank = begin[2 * i]
            assert rank == words.index(part[0])
            for w, p, _ in spellings.descend(iter(part), before, path, free):
                assert spellings.nodes(p, len(w)).tolist() == whole[w]


def test_paths():
    assert spellings.nodes([(1, 4), (3, 9)], 4).tolist() == [0, 4, 5, 9, 10]
    assert spellings.nodes([], 0).tolist() == [0]
    assert spellings.shared("abcd", "abx") == 2
    assert spellings.shared("", "a") == 0
    assert np.array_equal(spellings.cut([(1, 1), (4, 8)], 3), [(1, 1)])
    assert spellings.changed("abcdef", None) == "abcdef"


def test_query_against_brute_force(spark, sf_small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    assert sorted(map(tuple, queries.QUERIES["op11_spelling_variants"](spark, sf_small).collect()), key=str) == brute(docs)
