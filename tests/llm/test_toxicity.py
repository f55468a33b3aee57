"""Maximal scoring segments against their definition; held-out accuracy."""

import random

from adlake.llm import queries, toxicity as tox


def by_definition(seq):
    out = []

    def rec(lo, hi):
        best, arg = 0, None
        for i in range(lo, hi):
            s = 0
            for j in range(i, hi):
                s += seq[j]
                if s > best + 1e-9 or (abs(s - best) <= 1e-9 and arg and j - i < arg[1] - arg[0]):
                    best, arg = s, (i, j)
        if arg:
            rec(lo, arg[0])
            out.append(arg)
            rec(arg[1] + 1, hi)

    rec(0, len(seq))
    return sorted(out)


def test_segments():
    rnd = random.Random(2)
    for _ in range(1500):
        n = rnd.randint(0, 14)
        scores = [(i, rnd.choice([1.37, 2.11, 0.53, -0.7, 3.01])) for i in range(n) if rnd.random() < 0.6]
        seq = [-0.41] * n
        for i, x in scores:
            seq[i] = x - 0.41
        assert sorted((i, j) for _, i, j in tox.segments(scores, 0.41)) == by_definition(seq)


def test_lambda_solves_its_equation():
    import math

    scores = [(3.0, 0.01), (-0.1, 0.99)]
    assert abs(sum(q * math.exp(tox._lambda(scores) * s) for s, q in scores) - 1) < 1e-9
    assert tox._lambda([(-0.1, 1.0)]) == 1.0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in queries.QUERIES["op8_toxic_segments"](spark, sf).collect()}
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    labels = [(out[r.doc_id], r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(o.predicted, y) for o, y in labels if o.held_out]
    hit = sum(p and y for p, y in held)
    assert hit >= 0.85 * sum(y for _, y in held) and hit >= 0.9 * sum(p for p, _ in held)
    assert all(0 <= o.score <= 1 and o.predicted == (o.score >= 0.5) for o in out.values())


def test_labels_of_the_held_out_fold_change_nothing(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(tox.fold("doc_id") == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (tox.learn(tox.labelled_rows(docs, x)) for x in (labels, flipped))
    assert a.weights == b.weights and a.logistic == b.logistic


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "", 2), (2, "idiot " * 3, 3), (3, "x " * 50_000, 4)], "doc_id long, text string, score int")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = tox.learn(tox.labelled_rows(docs, none))
    rows = tox.score_documents(docs, model).collect()
    assert len(rows) == 5 and {r.score for r in rows} == {0.0} and not any(r.passages for r in rows)
    assert tox.score_documents(docs.limit(0), model).count() == 0
    strong = tox.Model(weights={"idiot": 8.0}, lam=1.0, logistic=(-3.0, 9.0, 0.1))
    found = {r.id: r for r in tox.score_documents(docs.where("doc_id = 2"), strong).collect()}[2]
    assert found.score > 0.5 and found.passages[0].text == "idiot idiot idiot"


def labelled(spark, rows):
    """A staged table (text, toxic, fold) of fold 1."""
    return tox.stage(spark.createDataFrame([(t, y, 1) for t, y in rows], "text string, toxic int, fold int").repartition(4), "toxic-test")


def plain(rnd, n=20):
    return " ".join(f"w{rnd.randrange(300)}" for _ in range(n))


def test_a_fixed_phrase_scores_and_a_copied_text_does_not(spark):
    rnd = random.Random(3)
    rows = [(plain(rnd), 0) for _ in range(1500)] + [(f"{plain(rnd, 9)} you utter swine there {plain(rnd, 9)}", 1) for _ in range(200)]
    rows += [("One copied text of odd words", 1), ("one  copied text, of odd words!", 1)] * 150
    weights = tox.learn(labelled(spark, rows)).weights
    assert all(weights.get(w, 0) > 0 for w in ("you", "utter", "swine", "there"))
    assert not {"one", "copied", "text", "of", "odd", "words"} & weights.keys()


def test_mild_tokens_score_on_both_sides(spark):
    rnd = random.Random(4)
    rows = [(plain(rnd) + " mild" * (rnd.random() < (0.25, 0.5)[y]) + " calm" * (rnd.random() < (0.5, 0.25)[y]), y) for y in (0, 1) for _ in range(1000)]
    weights = tox.learn(labelled(spark, rows)).weights
    assert 0 < weights["mild"] < 1 and -1 < weights["calm"] < 0


def test_tokens_beyond_those_sent_are_joined(spark):
    rnd = random.Random(5)
    rows = [(plain(rnd), 0) for _ in range(1000)] + [(f"{plain(rnd)} bad{rnd.randrange(20)} bad{rnd.randrange(20)}", 1) for _ in range(1000)]
    train = labelled(spark, rows + [(t, y) for t, y in rows[::7]])
    train = train.unionByName(train.selectExpr("text", "toxic", "4 as fold"))
    sent, joined = tox.learn(train), tox.learn(train, held=3)
    assert len(sent.weights) >= 20 and sent.table is None and len(joined.weights) == 3
    assert joined.weights | {r.token: r.odds for r in joined.table.collect()} == sent.weights
    assert (sent.drift, sent.lam, sent.logistic) == (joined.drift, joined.lam, joined.logistic)
    docs = spark.createDataFrame([(i // 2 or None, t) for i, (t, _) in enumerate(rows)] + [(9, None), (9, ""), (8, " ".join(f"bad{i}" for i in range(20)))], "doc_id long, text string")
    a, b = (sorted(map(str, tox.score_documents(docs, m).collect())) for m in (sent, joined))
    assert a == b and any("n_passages=1" in x for x in a)


def test_rows_marked_by_ids_lose_none_of_them(spark):
    from adlake.llm.common import marked_by

    rows = spark.range(20_000).selectExpr("id as __id", "'t' as text")
    for ids in (range(0, 20_000, 10), [], [7], [None, 3, 99_999_999]):
        some = spark.createDataFrame([(i,) for i in ids], "__id long")
        left = {r[0] for r in marked_by(rows, some).collect()}
        wanted = {i for i in ids if i is not None and i < 20_000}
        assert wanted <= left and len(left - wanted) < 4_000
