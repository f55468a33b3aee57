"""Every stage of the pipeline against brute force on what it was given."""

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from adlake.llm.common import documents, stage
from tests.llm import test_jaccard, test_repeats
from tests.llm.test_quality_rules import brute as statistics


def test_stages(spark, sf_small):
    docs = documents(spark, sf_small)
    columns = docs.columns
    steps = dict(pipeline.STAGES)
    assert len(steps) == 5 and entry.queries()["pipeline"] and len([q for q in entry.queries() if q.startswith("op")]) == 13
    rows = lambda d: [(r.doc_id, r.text) for r in d.collect()]

    kept = stage(steps["quality rules"](spark, docs, sf_small), "test")
    assert kept.columns == columns
    failed = {d for d, t in rows(docs) if (b := statistics(t))[0] < 50 or 100 * b[4] > 50 * b[0]}
    good = {r.doc_id for r in spark.read.parquet(f"{sf_small}/labels.parquet").where("quality = 1").collect()}
    left = {d for d, _ in rows(kept)}
    assert not left & failed and len(good - failed - left) <= 0.03 * len(good)

    one = stage(steps["n-gram Jaccard join"](spark, kept, sf_small), "test")
    assert one.columns == columns
    assert {d for d, _ in rows(one)} == {c for _, _, c in test_jaccard.brute(rows(kept), 5, 4, 5)}

    apart = stage(steps["suffix-array dedup"](spark, one, sf_small), "test")
    assert apart.columns == columns
    assert dict(rows(apart)) == dict(test_repeats.brute_texts(rows(one)))
    assert all(r.n_chars == len(r.text) for r in apart.collect())

    mixed = stage(steps["mixing sources to target weights"](spark, apart, sf_small), "test")
    assert mixed.columns == columns and set(rows(mixed)) <= set(rows(apart))

    packed = steps["best-fit packing"](spark, mixed, sf_small)
    assert {r.doc_id for r in packed.collect()} == {d for d, _ in rows(mixed)}
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_run_is_the_stages_in_order(spark, sf_small):
    out = pipeline.run(spark, sf_small)
    assert out.columns[:5] == ["doc_id", "piece", "start", "length", "ids_crc32"] and out.count() > 0


def test_stages_on_odd_rows(spark, sf_small):
    """Nulls in any column, empty and very long texts, repeated rows and ids,
    extra columns with the stages' own names, and an empty table."""
    from pyspark.sql import functions as F

    docs = documents(spark, sf_small).where("doc_id < 60")
    plain = dict(lang="en", source="s")
    good = docs.where("doc_id = 1").first().text or "word " * 60
    odd = [(None, good), (None, None), (900, None), (901, ""), (902, " \n\t"), (903, "w " * 120_000), (904, good), (904, good), (904, "other " + good), (905, "é" * 300 + " " + "ж" * 300)]
    rows = spark.createDataFrame([(i, t, plain["lang"] if i else None, plain["source"], len(t) if t else None) for i, t in odd], docs.schema)
    clash = ["id", "n", "key", "code", "rate", "kept", "rule", "__row", "component", "text_crc", "length", "piece"]
    whole = docs.unionByName(rows).select("*", *[F.lit(i).alias(c) for i, c in enumerate(clash)])
    for given in (whole, whole.limit(0)):
        n = given.count()
        for name, step in pipeline.STAGES[:-1]:
            out = step(spark, given, sf_small)
            assert out.columns == given.columns, name
            got = out.collect()
            assert bool(got) == bool(n), name
            if name == "n-gram Jaccard join":
                assert sum(r.doc_id is None for r in got) == 2 * bool(n)  # rows without an id stay
                assert sum(r.doc_id in (900, 901, 902) for r in got) == 3 * bool(n)  # wordless texts are like no other
            if name == "suffix-array dedup" and n:
                assert len(got) == n and sum(r.text is None for r in got) == given.where("text is null").count()
                assert all(r.n_chars == len(r.text) for r in got if r.text is not None and r.doc_id is not None)
            if name == "quality rules" and n:
                assert all(r.text and len(r.text.split()) >= 50 for r in got)
        packed = pipeline.STAGES[-1][1](spark, given, sf_small).collect()
        assert sum(r.piece == 0 for r in packed) == n
