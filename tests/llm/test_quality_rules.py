"""Text statistics against brute force; learned rules on labelled rows."""

import re
from collections import Counter

from adlake.llm import queries, quality_rules as q


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(inside)


ODD = [(-1, None), (-2, ""), (-3, " \n\t "), (-4, "a b a b a b a\na b\na b\n \n  x\x0bz"), (-5, "a a a a"), (-6, "é y <>|\U0001f600"), (-7, "a " * 30_000), (-8, " x y"), (None, "n"), (-5, "a a a a")]


def test_statistics(spark, sf_small):
    rows = ODD + [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    df = spark.createDataFrame([(*r, 5, "h") for r in rows], "doc_id long, text string, n_words int, h string")
    got = q.with_stats(df).select("doc_id", "text", "n_words", "__stats.*").collect()
    assert sorted(((r[0], (r[3], r[4], r[5], r[6], r[7])) for r in got), key=str) == sorted(((d, brute(t)) for d, t in rows), key=str)
    assert {r[2] for r in got} == {5}  # the caller's own column


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in queries.QUERIES["op4_quality_rules"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        b, o = brute(r.text), out[r.doc_id]
        assert b == (o.n_words, o.word_chars, o.n_symbols, o.n_dup_lines, o.n_repeat_words)
        assert o.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert o.kept == (not o.base_failed and o.rule is None)
    labels = [(out[r.doc_id], r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    judged = [(o.kept, y) for o, y in labels if not o.base_failed]
    assert sum(k for k, y in judged if y == 1) >= 0.98 * sum(y == 1 for _, y in judged)
    assert sum(not k for k, y in judged if y == 0) >= 0.9 * sum(y == 0 for _, y in judged)


def test_learned_list_is_ordered_and_prunes(spark):
    rows = [(i, 100, 500, 400 if i % 4 == 0 else 2, 0, 0, 0, 0, 0, 10, 90, int(i % 4 != 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} long" for c in q.COUNTS) + ", y int")
    rules = q.learn_rules(df, "y")
    assert [[str(c).split()[0] for c in r] for r in rules] == [["symbol_share"]]
    assert q.judged(df, rules).where("kept <> (y = 1)").count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(i, "w%d " % i * 3 + " ".join(f"u{i}x{j}" for j in range(60 * (i % 2)))) for i in range(6)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert sorted(r.doc_id for r in q.quality_filter(docs, none).collect()) == [1, 3, 5]
    assert q.quality_filter(docs.limit(0), none).count() == 0
    assert sorted(r.doc_id for r in q.quality_filter(docs, spark.createDataFrame([(1, None), (None, 0)], "doc_id long, quality int")).collect()) == [1, 3, 5]
