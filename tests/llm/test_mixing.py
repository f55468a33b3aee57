"""Mixing: rates against a plain solver, posteriors against labels, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from adlake.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def solved(p, n, goal, ridge=1e-3):
    share = (n[:, None] * p).sum(0)
    r = np.ones(len(n))
    for _ in range(8000):
        off = ((n * r)[:, None] * p).sum(0) - goal
        r = np.maximum(0, r - 0.9 * (p @ (off / share) + ridge * (r - 1)))
    return r


def test_query(spark):
    out = queries.QUERIES["op2_soft_mixing"](spark, SF).toPandas()
    p, n = out[["p_high", "p_low", "p_toxic"]].to_numpy(), out.n_tokens.to_numpy() / out.n_tokens.sum()
    goal = np.array([mixing.TARGETS[k] for k in mixing.DOMAINS])
    assert np.allclose(p.sum(1), 1) and (out.rate >= 0).all()
    assert np.abs(((n * out.rate.to_numpy())[:, None] * p).sum(0) - goal).max() < 2e-3
    assert np.abs(solved(p, n, goal) - out.rate.to_numpy()).max() < 5e-3
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().merge(out, on="doc_id")
    truth = np.where(labels.toxic == 1, "p_toxic", np.where(labels.quality == 0, "p_low", "p_high"))
    assert (labels[["p_high", "p_low", "p_toxic"]].idxmax(axis=1).to_numpy() == truth).mean() > 0.9


def test_rates_that_reach_zero(spark):
    rows = [(float(i % 3 == 0), float(i % 3 == 1), float(i % 3 == 2), 10 + i) for i in range(60)] + [(0.5, 0.25, 0.25, 500)]
    df = spark.createDataFrame(rows, "p_high double, p_low double, p_toxic double, n_tokens long")
    got = mixing.fit_rates(df, {"high": 0.995, "low": 0.005, "toxic": 0.0}, steps=300, tolerance=1e-8).toPandas()
    p, n = got[["p_high", "p_low", "p_toxic"]].to_numpy(), got.n_tokens.to_numpy() / got.n_tokens.sum()
    expected = solved(p, n, np.array([0.995, 0.005, 0.0]))
    assert (expected == 0).any() and np.abs(expected - got.rate.to_numpy()).max() < 1e-2


def test_odd_rows(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    odd = spark.createDataFrame([(None, None, 1, 9), (1, "", 2, 9), (1, "", 2, 9), (2, "a a a", 3, 9), (3, "b " * 50_000, 4, 9)], "doc_id long, text string, rate int, p_high int")
    found = mixing.with_rates(mixing.domain_posteriors(odd, labels.limit(0)), mixing.TARGETS).collect()
    assert len(found) == 5 and {round(r.p_low, 9) for r in found} == {round(1 / 3, 9)}
    mixed = mixing.mix_documents(odd, labels.limit(0))
    assert mixed.columns == odd.columns and {r.rate for r in mixed.collect()} == {1, 2, 3, 4}
    assert mixing.mix_documents(odd.limit(0), labels).count() == 0
    assert mixing.mix_documents(odd, labels.withColumn("toxic", F.lit(None).cast("int")).withColumn("quality", F.lit(None).cast("int"))).count() >= 5


def test_mixing_keeps_likely_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    mixed = mixing.mix_documents(docs, labels)
    ids = {r.doc_id for r in mixed.select("doc_id").collect()}
    post = mixing.domain_posteriors(docs, labels).collect()
    assert {r.doc_id for r in post if r.p_high >= max(r.p_low, r.p_toxic)} <= ids < {r.doc_id for r in post}


def test_every_significant_word_marks_its_domain(spark):
    words = [f"mark{i}'s\\${{x}}" for i in range(150)]
    docs = spark.createDataFrame([(i, " ".join(words if i % 2 else [f"plain{j}" for j in range(150)]) + f" {i}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0 if i % 2 else 1, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    model = mixing.learn_classifier(docs, labels)
    assert set(words) <= set(model.lexicons["low"])
    rows = model.posteriors(model.rows(docs, ["doc_id"], mixing._body("text"))).collect()
    assert all((r.p_low > 0.99) == bool(r.doc_id % 2) for r in rows)
    codes = {}
    for r in rows:
        assert codes.setdefault(r.code, (r.p_high, r.p_low, r.p_toxic)) == (r.p_high, r.p_low, r.p_toxic)


def test_targets_out_of_reach_are_told(spark):
    import pytest

    df = spark.createDataFrame([(1.0, 0.0, 0.0, 10), (0.0, 1.0, 0.0, 10)], "p_high double, p_low double, p_toxic double, n_tokens long")
    with pytest.warns(UserWarning, match="miss a target"):
        mixing.fit_rates(df, {"high": 0.3, "low": 0.7, "toxic": 0.0}, steps=2)
