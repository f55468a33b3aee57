"""Property checks: tolerant parsing vs a Python model, orphans + kept =
children, rollup grand total = overall sums."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlake.functions import casts as C
from adlake.operators import entities as EN
from adlake.operators import metrics as M
from adlake.plans import proxies as P


def _py_float(s):
    """Python-side model of the tolerant float parse (Spark-style: no '_')."""
    if s is None:
        return None
    t = s.strip(" \t\n\r\f\x0b")
    if t == "" or "_" in t:
        return None
    try:
        return float(t)
    except ValueError:
        return None


_texts = st.one_of(
    # ASCII digits only: non-ASCII decimal digits are a documented divergence.
    st.from_regex(r"\A[ \t]{0,2}[+-]?[0-9]{1,6}(\.[0-9]{0,4})?([eE][+-]?[0-9]{1,2})?[ \t]{0,2}\Z"),
    st.text(alphabet="0123456789.eE+-abcd_ ", max_size=8),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(_texts, min_size=20, max_size=60))
def test_tolerant_float_matches_python_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(C.tolerant_float(F.col("s"))).collect()]
    for t, g in zip(texts, got):
        want = _py_float(t)
        if want is None or g is None:
            assert want is None and g is None, (t, g, want)
        else:
            assert math.isclose(g, want, rel_tol=1e-15) or (math.isinf(g) and math.isinf(want)), (t, g, want)


def test_orphans_plus_kept_is_all(spark, sf_small):
    from adlake.operators import normalize as N
    from adlake.operators import unify as U
    from adlake.specs import CHILD_SPECS, PARENT_SPECS
    t = N.normalize_nested(P.nested(spark, sf_small), "ads_insights", 2, carry=("client",))
    c = U.apply_spec(t["ads_insights__actions"], CHILD_SPECS["ads_insights__actions"], keep=["client"])
    p = t["ads_insights"]
    p = U.apply_spec(p.withColumn("extracted_at", U.extracted_at(p)), PARENT_SPECS["ads_insights"],
                     keep=["client", "extracted_at"])
    kept = U.dedupe_latest(p, ["client", "ad_id", "date_start"], [F.col("extracted_at").desc_nulls_last()])
    assert EN.keep_children(c, kept).count() + EN.orphan_children(c, kept).count() == c.count()


def test_rollup_grand_total(spark, sf_small):
    i = P.insights(spark, sf_small)
    r = M.aggregate(i, ["client", "campaign_id"], mode="rollup")
    grand = r.where(F.col("grouping_level") == 3).first()
    tot = i.agg(F.sum("spend").alias("s"), F.sum("clicks").alias("c")).first()
    assert math.isclose(grand["spend"], tot["s"], rel_tol=1e-9) and grand["clicks"] == tot["c"]
    assert math.isclose(grand["cpc"], tot["s"] / tot["c"], rel_tol=1e-9)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(min_value=-3, max_value=400), min_size=5, max_size=20),
       st.dates(min_value=dt.date(1970, 1, 1), max_value=dt.date(2100, 12, 31)))
def test_chunks_tile_any_window(spark, ns, today):
    from adlake.operators import scope as SC
    plan = spark.createDataFrame([(str(i), n) for i, n in enumerate(ns)], "client string, history_days int")
    ch = SC.insights_chunks(plan, today).collect()
    for i, n in enumerate(ns):
        rows = sorted((r["chunk_idx"], r["since"], r["until"]) for r in ch if r["client"] == str(i))
        if n <= 0:
            assert rows == []
            continue
        assert sum((u - s).days + 1 for _, s, u in rows) == n
        assert rows[0][2] == today and rows[-1][1] == today - dt.timedelta(days=n - 1)
        assert all(rows[k][1] == rows[k + 1][2] + dt.timedelta(days=1) for k in range(len(rows) - 1))


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet="abcxyz0189", min_size=0, max_size=5), min_size=1, max_size=300))
def test_dense_positions_match_sorted_order(spark, ids):
    from adlake.operators import scope as SC
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(5)
    got = {r["id"]: r["pos"] for r in SC.dense_positions(df, "id").collect()}
    want = {v: i for i, v in enumerate(sorted(set(ids)))}
    assert got == want
