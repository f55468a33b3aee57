"""Date windows, history resolver, id batches."""

import datetime as dt

from pyspark.sql import functions as F

from adlake.operators import scope as SC

TODAY = dt.date(2026, 5, 8)


def test_chunks_tile_window(spark):
    plan = spark.createDataFrame([("a", 16), ("b", 0), ("c", 7), ("d", 1125)], "client string, history_days int")
    ch = SC.insights_chunks(plan, TODAY).collect()
    a = sorted((r["chunk_idx"], r["since"], r["until"]) for r in ch if r["client"] == "a")
    assert a == [(0, dt.date(2026, 5, 2), dt.date(2026, 5, 8)), (1, dt.date(2026, 4, 25), dt.date(2026, 5, 1)),
                 (2, dt.date(2026, 4, 23), dt.date(2026, 4, 24))]
    assert not [r for r in ch if r["client"] == "b"]
    for c, n in (("c", 7), ("d", 1125)):
        rows = [r for r in ch if r["client"] == c]
        assert sum((r["until"] - r["since"]).days + 1 for r in rows) == n
        assert all((r["until"] - r["since"]).days < 7 for r in rows)


def test_history_resolver_branches(spark):
    target = TODAY - dt.timedelta(days=730)
    rows = [(None, None), (target + dt.timedelta(days=5), TODAY),
            (target, TODAY - dt.timedelta(days=100)), (target, TODAY - dt.timedelta(days=20)),
            (target, TODAY - dt.timedelta(days=1))]
    df = spark.createDataFrame(rows, "cmin date, cmax date")
    out = [r[0] for r in df.select(SC.resolve_history_days(
        F.col("cmin"), F.col("cmax"), F.lit(TODAY), F.lit(target), F.lit(1125))).collect()]
    assert out == [1125, 730, 1125, 27, 7]


def test_id_batches(spark):
    ids = [str(i) for i in range(120)] + ["5", "6", "7", "8", "9", ""]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    b = sorted((r["batch_no"], r["n_ids"]) for r in SC.id_batches(df, "id").collect())
    assert b == [(0, 50), (1, 50), (2, 20)]
    first = SC.id_batches(df, "id").where("batch_no = 0").first()["ids"].split(",")
    assert first == sorted(set(i for i in ids if i))[:50]


def test_initial_days_and_override(spark):
    df = spark.createDataFrame([(" PROD ", "30"), ("staging", "-5"), ("weird", "x"), (None, None)], "e string, o string")
    out = df.select(SC.initial_load_days(F.col("e")), SC.history_override(F.col("o"))).collect()
    assert [tuple(r) for r in out] == [(1125, 30), (365, None), (1125, None), (7, None)]  # missing: dev


def test_each_tenants_own_days_are_picked_at_run_time(spark, tmp_path):
    import datetime as dt

    from adlake.sources import lake as L

    root = str(tmp_path / "raw")
    rows = [(c, f"2024-01-{d:02d}", d) for c in ("a", "b", "c") for d in range(1, 31)]
    L.write_raw(spark.createDataFrame(rows, "client string, date string, v int"), root, "x")
    day = lambda d: dt.date(2024, 1, d)
    windows = spark.createDataFrame([("a", day(3), day(5)), ("b", day(28), day(30)), ("b", day(29), day(30)), ("z", day(1), day(9)), ("c", day(9), day(2))], "client string, since date, until date")
    out = SC.tenant_windows(L.read_raw(spark, root, "x"), windows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert sorted((r.client, r.v) for r in out.collect()) == [("a", 3), ("a", 4), ("a", 5), ("b", 28), ("b", 29), ("b", 30)]
    assert out.columns == L.read_raw(spark, root, "x").columns


def test_file_list_is_sorted_by_client_and_entity(spark, tmp_path):
    from adlake.sources import lake as L

    root = str(tmp_path / "raw")
    L.write_raw(spark.createDataFrame([("b", "2024-01-02", 1), ("a", "2024-01-02", 1), ("a", "2024-01-01", 1)], "client string, date string, v int"), root, "x", source="s")
    files = L.file_list(spark, L.source_root(root, "s"))
    assert sorted((r.client, r.entity, r.position, r.date) for r in files.collect()) == [("a", "x", 1, "2024-01-01"), ("a", "x", 2, "2024-01-02"), ("b", "x", 1, "2024-01-02")]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1].split("\n")[0]
