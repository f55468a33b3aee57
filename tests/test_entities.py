"""ConversionEvent, ratio recomputation, orphans, creative assets."""


from adlake.operators import assets as A
from adlake.operators import entities as EN
from adlake.operators import metrics as M


C = "parent_dlt_id string, action_type string, value double"
PARENT = "parent_dlt_id string, ad_id string, spend double"


def test_conversion_event_keeps_one_sided_types_at_full_grain(spark):
    a = spark.createDataFrame([("p", "purchase", 3.0), ("q", "purchase", 1.0), ("old", "purchase", 9.0)], C)
    v = spark.createDataFrame([("p", "purchase", 90.0), ("p", "view", 1.0)], C)
    w = spark.createDataFrame([("q", "video_view", 7.0)], C)
    parents = spark.createDataFrame([("p", "1", 10.0), ("q", "1", 5.0)], PARENT)
    out = sorted(tuple(r) for r in EN.conversion_event(a, v, w, parents, ["ad_id"]).collect())
    assert out == [("1", "purchase", 4.0, 90.0, None), ("1", "video_view", None, None, 7.0), ("1", "view", None, 1.0, None)]


def test_roas_counts_all_spend_once(spark):
    roas = "roas_kind string, " + C
    two = spark.createDataFrame([("purchase", "p", "a", 0.5), ("purchase", "p", "b", 0.5)], roas)
    r = EN.attributed_roas(two, spark.createDataFrame([("p", "1", 10.0)], PARENT), ["ad_id"], by_type=False).first()
    assert (r["roas"], r["spend"]) == (1.0, 10.0)
    one = spark.createDataFrame([("purchase", "p", "a", 1.0)], roas)
    r = EN.attributed_roas(one, spark.createDataFrame([("p", "1", 10.0), ("q", "1", 30.0)], PARENT), ["ad_id"]).first()
    assert (r["roas"], r["spend"], r["n_parents"]) == (0.25, 40.0, 2)
    c = EN.cost_per_action(spark.createDataFrame([("p", "buy", 4.0)], C), spark.createDataFrame([("p", "1", 10.0), ("q", "1", 30.0)], PARENT), ["ad_id"]).first()
    assert c["cpa"] == 10.0


def test_groups_with_a_null_key_stay(spark):
    parents = spark.createDataFrame([("p", "1", "web", 10.0), ("q", "1", None, 10.0), ("r", "1", None, 30.0)], "parent_dlt_id string, ad_id string, platform string, spend double")
    keys = ["ad_id", "platform"]
    roas = spark.createDataFrame([("purchase", "p", "a", 2.0), ("purchase", "q", "a", 4.0)], "roas_kind string, " + C)
    out = {r.platform: (r.roas, r.spend, r.n_parents) for r in EN.attributed_roas(roas, parents, keys).collect()}
    assert out == {"web": (2.0, 10.0, 1), None: (1.0, 40.0, 2)}
    acts = spark.createDataFrame([("p", "buy", 5.0), ("q", "buy", 8.0)], C)
    out = {r.platform: (r.actions, r.spend, r.cpa) for r in EN.cost_per_action(acts, parents, keys).collect()}
    assert out == {"web": (5.0, 10.0, 2.0), None: (8.0, 40.0, 5.0)}


def test_dimension_attributes_come_from_one_row(spark):
    rows = [("t1", "a", "s1", "c9", 5, "r1"), ("t1", "a", "s9", "c1", 5, "r2"), ("t2", "a", "s4", "c4", 1, "r3")]
    f = spark.createDataFrame(rows, "client string, ad string, s string, c string, day int, rid string")
    out = {(r.kind, r.client, r.id): (r.s, r.c) for r in EN.thin_dimensions(f, "client", {"Ad": ("ad", ("s", "c")), "Set": ("s", ("c",))}, "day", "rid").collect()}
    assert out[("Ad", "t1", "a")] == ("s9", "c1") and out[("Ad", "t2", "a")] == ("s4", "c4") and len(out) == 5


def test_scd2_per_tenant_with_ties(spark):
    from pyspark.sql import functions as F

    rows = [("t1", "a", "x", 1, "1"), ("t1", "a", "x", 5, "1"), ("t1", "a", "y", 90_000, "1"), ("t1", "a", "z", 90_000, "2"), ("t1", "a", None, 200_000, "1"), ("t2", "a", "z", 3, "1")]
    v = spark.createDataFrame(rows, "t string, id string, v string, s long, tie string").withColumn("ts", F.timestamp_seconds("s"))
    out = sorted((r.t, r.v or "-", r.is_current) for r in EN.scd2(v, ["t", "id"], ["v"], "ts", "tie").collect())
    assert out == [("t1", "-", True), ("t1", "x", False), ("t1", "z", False), ("t2", "z", True)]


def test_scd2_of_a_hot_key_spreads_and_stitches(spark):
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(3)
    rows, now = [], "x"
    for s in range(3000):
        now = rnd.choice("xyz") if rnd.random() < 0.01 else now  # long stretches without a change, over whole ranges
        rows.append(("hot", s, now))
    rows += [(k, s, rnd.choice("xy")) for k in ("a", None, "z") for s in range(20)]
    v = spark.createDataFrame([(*r, "t") for r in rows], "id string, s long, v string, tie string").withColumn("ts", F.timestamp_seconds("s"))
    want = []
    for key in {r[0] for r in rows}:
        mine = sorted((s, x) for k, s, x in rows if k == key)
        changes = [(s, x) for i, (s, x) in enumerate(mine) if not i or mine[i - 1][1] != x]
        want += [(key, x, s, changes[i + 1][0] if i + 1 < len(changes) else None) for i, (s, x) in enumerate(changes)]
    out = EN.scd2(v, ["id"], ["v"], "ts", "tie")
    got = [(r.id, r.v, int(r.valid_from.timestamp()), r.valid_to and int(r.valid_to.timestamp())) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    ranged = v.repartitionByRange(8, "id", "ts").where("id = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert ranged > 4


def test_reach_is_not_added_over_days(spark):
    df = spark.createDataFrame([("a", "d1", 1.0, 1, 10, 5), ("a", "d2", 1.0, 1, 10, 5)], "ad_id string, date_start string, spend double, clicks long, impressions long, reach long")
    over = M.aggregate(df, ["ad_id"]).first()
    assert over["reach"] is None and over["frequency"] is None and over["impressions"] == 20
    assert [r["frequency"] for r in M.aggregate(df, ["ad_id", "date_start"]).collect()] == [2.0, 2.0]


def test_ratio_recomputed_from_sums(spark):
    df = spark.createDataFrame([("a", 10.0, 1, 100, 50), ("a", 10.0, 9, 100, 50)],
                               "ad_id string, spend double, clicks long, impressions long, reach long")
    r = M.aggregate(df, ["ad_id"]).first()
    assert r["cpc"] == 2.0


def test_orphans_after_reextract(spark):
    children = spark.createDataFrame([("c1", "old"), ("c2", "new")], "child_dlt_id string, parent_dlt_id string")
    parents = spark.createDataFrame([("new",)], "parent_dlt_id string")
    assert [r[0] for r in EN.orphan_children(children, parents).select("child_dlt_id").collect()] == ["c1"]
    assert [r[0] for r in EN.keep_children(children, parents).select("child_dlt_id").collect()] == ["c2"]


def test_creative_without_assets(spark):
    c = spark.createDataFrame([("c", "1", '{"creative_name": "n"}')], "client_uid string, source_id string, payload string")
    m = spark.createDataFrame([], "client_uid string, creative_id string, asset_kind string, byte_size long")
    r = A.creative_assets(c, m).first()
    assert r["n_assets"] == 0 and r["kinds_present"] is None and r["total_bytes"] is None


def test_unpivot_keeps_nulls(spark):
    w = spark.createDataFrame([("1", "OPT_IN", None)], "creative_id string, f1 string, f2 string")
    assert EN.unpivot_flags(w, ["creative_id"], ["f1", "f2"]).count() == 2
