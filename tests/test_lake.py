"""Hive lake: text partition values, drift-safe reads, pruning, versions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.operators.frames import MissingTableError
from adlake.sources import lake as L


def test_partition_values_stay_text(spark, tmp_path):
    root = str(tmp_path / "raw")
    df = spark.createDataFrame([("007", "2024-01-01", "a")], "client string, date string, id string")
    L.write_raw(df, root, "ads")
    r = L.read_raw(spark, root, "ads").first()
    assert r["client"] == "007" and r["entity"] == "ads"


def test_drifted_types_read_per_schema(spark, tmp_path):
    root = str(tmp_path / "raw")
    L.write_raw(spark.createDataFrame([("a", "2024-01-01", 1.5)], "client string, date string, spend double"), root, "x")
    L.write_raw(spark.createDataFrame([("b", "2024-01-01", "2.5")], "client string, date string, spend string"), root, "x")
    frames = L.read_raw_groups(spark, root, "x")
    assert len(frames) == 2


def test_drift_within_one_tenant(spark, tmp_path):
    root = str(tmp_path / "raw")
    t = "client string, date string, "
    L.write_raw(spark.createDataFrame([("a", "2024-01-01", 1.5)], t + "spend double"), root, "x")
    L.write_raw(spark.createDataFrame([("a", "2024-01-02", "2.5", "on")], t + "spend string, status string"), root, "x")
    L.write_raw(spark.createDataFrame([("b", "2024-01-02", 3.5, "off")], t + "spend double, status string"), root, "x")
    frames = L.read_raw_groups(spark, root, "x")
    got = sorted((r["client"], r["date"], str(r["spend"]), r["status"] if "status" in r else None) for f in frames for r in map(lambda x: x.asDict(), f.collect()))
    assert got == [("a", "2024-01-01", "1.5", None), ("a", "2024-01-02", "2.5", "on"), ("b", "2024-01-02", "3.5", "off")]
    assert len(frames) == 2


def _land_drift(spark, root):
    t = "client string, date string, "
    L.write_raw(spark.createDataFrame([("a b:c%", "2024-01-01", 1.5)], t + "spend double"), root, "x")
    L.write_raw(spark.createDataFrame([("a b:c%", "2024-01-01", 2)], t + "spend int"), root, "x")
    L.write_raw(spark.createDataFrame([("d", "2024-01-02", 3.5, "off")], t + "spend double, status string"), root, "x")
    L.write_raw(spark.createDataFrame([("d", "2024-01-03", "on")], t + "status string"), root, "x")


def test_footers_are_mapped_without_trial_merges(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    _land_drift(spark, root)
    days = L.list_dirs(spark, f"{root}/client=*/entity=x/date=*")
    found = L.footers(spark, days)
    assert len(found) == 4 and all(s for *_, s in found) and len({s for *_, s in found}) == 4
    rows = lambda frames: sorted(str(r) for f in frames for r in f.select(*[F.col(c).cast("string") for c in sorted(f.columns)]).collect())
    probed = L._probed(spark, root, days)
    monkeypatch.setattr(L, "_probed", lambda *a: 1 / 0)
    frames = L.read_raw_groups(spark, root, "x")
    assert len(frames) == 2 and sum(f.count() for f in frames) == 4
    assert {r.client for f in frames for r in f.collect()} == {"a b:c%", "d"}
    whole = L.one_frame(frames)
    assert dict(whole.dtypes)["spend"] == "double"
    assert sorted((r.client, r.spend, r.status) for r in whole.where("spend is not null").collect()) == [("a b:c%", 1.5, None), ("a b:c%", 2.0, None), ("d", 3.5, "off")]
    assert rows([L.one_frame(probed)]) == rows([whole])


def test_unreadable_footers_are_probed(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "raw")
    _land_drift(spark, root)
    real = L.footers
    monkeypatch.setattr(L, "footers", lambda spark, folders: [(f, n, None) for f, n, _ in real(spark, folders)])
    assert sum(f.count() for f in L.read_raw_groups(spark, root, "x")) == 4


def test_groups_are_bounded_by_schemas():
    js = lambda *cols: T.StructType([T.StructField(n, t) for n, t in cols]).json()
    a, b, c, d = js(("x", T.LongType())), js(("x", T.StringType())), js(("y", T.LongType())), js(("x", T.StringType()), ("y", T.StringType()))
    groups = L.agreeing([a, b, a, c, d, b] * 50)
    assert [m for _, m in groups] == [[a, c], [b, d]]
    assert [f.name for f in groups[0][0]] == ["x", "y"]


def test_entities_of_differing_schemas_keep_their_columns(spark, tmp_path):
    root = str(tmp_path / "raw")
    t = "client string, date string, "
    L.write_raw(spark.createDataFrame([("a", "2024-01-01", "o", 5)], t + "objective string, v int"), root, "campaigns")
    L.write_raw(spark.createDataFrame([("a", "2024-01-01", "c", "x")], t + "creative string, v string"), root, "ads")
    got = {r.entity: r.asDict() for r in L.read_raw(spark, root).collect()}
    assert got["campaigns"]["objective"] == "o" and got["campaigns"]["v"] == "5" and got["campaigns"]["creative"] is None
    assert got["ads"]["creative"] == "c" and got["ads"]["v"] == "x"


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    import pytest

    root = str(tmp_path / "ods")
    L.write_ods(spark.range(3), root, "ads")
    with pytest.raises(Exception):
        L.write_ods(spark.range(5).withColumn("x", F.raise_error(F.lit("no"))), root, "ads")
    assert L.read_ods(spark, root, "ads").count() == 3
    L.write_ods(spark.range(7), root, "ads")
    assert L.read_ods(spark, root, "ads").count() == 7


def test_entity_filter_is_partition_pruned(spark, tmp_path):
    root = str(tmp_path / "raw")
    L.write_raw(spark.createDataFrame([("a", "2024-01-01", 1)], "client string, date string, v int"), root, "ads_insights")
    L.write_raw(spark.createDataFrame([("a", "2024-01-01", 1)], "client string, date string, v int"), root, "_state")
    df = L.read_raw(spark, root)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and df.count() == 1


def test_missing_entity_raises(spark, tmp_path):
    try:
        L.read_raw_groups(spark, str(tmp_path / "nothing"), "ads")
    except MissingTableError:
        return
    raise AssertionError("expected MissingTableError")


def test_path_keys(spark):
    df = spark.createDataFrame([("s3://b/raw/client=007/entity=ads/date=2024-01-01/p.parquet",)], "p string")
    m = df.select(L.path_keys(F.col("p")).alias("m")).first()["m"]
    assert m == {"client": "007", "entity": "ads", "date": "2024-01-01"}


def test_sizing_conf():
    from adlake.session import sizing_conf
    c = sizing_conf(100 * (1 << 40), executor_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert int(sizing_conf(1 << 20, executor_cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_unify_lake_empty_root_raises(spark, tmp_path):
    import datetime as dt

    from adlake.plans.jobs import unify_lake
    (tmp_path / "raw").mkdir()
    try:
        unify_lake(spark, str(tmp_path / "raw"), str(tmp_path / "ods"), dt.datetime(2024, 1, 1))
    except MissingTableError:
        return
    raise AssertionError("expected MissingTableError")


def test_steps_run_after_their_inputs(spark):
    import pytest

    from adlake.plans.steps import Step, in_order, run_steps

    built, kept = [], []

    def make(name, n):
        def build(*inputs):
            built.append(name)
            return None if n is None else spark.range(n + sum(i.count() for i in inputs if i is not None))
        return build

    steps = [Step("c", make("c", 1), ("a", "b")), Step("a", make("a", 2)), Step("b", make("b", None)), Step("d", make("d", 0), ("c", "a"))]
    out = run_steps(steps, lambda name, df: (kept.append(name), df)[1])
    assert built.index("c") > max(built.index("a"), built.index("b")) and built[-1] == "d" and sorted(built) == ["a", "b", "c", "d"]
    assert out["b"] is None and out["c"].count() == 3 and out["d"].count() == 5 and sorted(kept) == ["a", "c", "d"]
    with pytest.raises(ValueError, match="unknown"):
        in_order([Step("a", make("a", 1), ("z",))])
    with pytest.raises(Exception, match="cycle"):
        in_order([Step("a", make("a", 1), ("b",)), Step("b", make("b", 1), ("a",))])
    built.clear()
    with pytest.raises(ZeroDivisionError):
        run_steps([Step("a", lambda: 1 / 0), Step("b", make("b", 1), ("a",))], lambda name, df: df)
    assert built == []


def test_unify_lake_reads_children_after_their_parents(spark, tmp_path):
    import datetime as dt

    from adlake.plans.jobs import unify_lake

    raw = str(tmp_path / "raw")
    parent = "client string, date string, ad_id string, date_start string, _dlt_id string, _dlt_load_id string"
    L.write_raw(spark.createDataFrame([("a", "d", "1", "2024-01-01", "old", "1"), ("a", "d", "1", "2024-01-01", "new", "2")], parent), raw, "ads_insights")
    child = "client string, date string, _dlt_id string, _dlt_parent_id string, _dlt_list_idx long, action_type string, value string"
    L.write_raw(spark.createDataFrame([("a", "d", "x", "old", 0, "buy", "1"), ("a", "d", "y", "new", 0, "buy", "2")], child), raw, "ads_insights__actions")
    got = {r.entity: tuple(r)[1:] for r in unify_lake(spark, raw, str(tmp_path / "ods"), dt.datetime(2024, 1, 1)).collect()}
    assert got == {"ads_insights": ("parent", 1, 1, None), "ads_insights__actions": ("child", 1, 2, 1)}
    rows = L.read_ods(spark, str(tmp_path / "ods"), "ads_insights__actions").collect()
    assert {r.child_dlt_id: r.is_orphan for r in rows} == {"x": True, "y": False}
