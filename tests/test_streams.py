"""Streams: a replay (fresh checkpoint over the same files) leaves the
state unchanged; pointer state keeps the last non-empty digest."""

from pyspark.sql import functions as F

from adlake.plans import proxies as P
from adlake.plans.catalog_unify import _typed
from adlake.streaming import streams as ST

KEYS = ["tenant_skey", "ad_id", "date_start"]


def _order():
    return [F.col("extracted_at").desc_nulls_last(), F.col("_tie").desc()]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_restatement_replay_is_idempotent(spark, sf_small, tmp_path):
    t = _typed(spark, sf_small)
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    t.where(F.col("date_start") < "2024-01-15").write.parquet(landing)
    ST.restatement(spark, landing, t.schema, state, str(tmp_path / "ck1"), KEYS, _order(), "date_start", 60, ["tenant_skey"])
    t.where(F.col("date_start") >= "2024-01-15").write.mode("append").parquet(landing)
    ST.restatement(spark, landing, t.schema, state, str(tmp_path / "ck1"), KEYS, _order(), "date_start", 60, ["tenant_skey"])
    first = _rows(ST.read_restated(spark, state, KEYS, "date_start"))
    ST.restatement(spark, landing, t.schema, state, str(tmp_path / "ck2"), KEYS, _order(), "date_start", 60, ["tenant_skey"])
    assert _rows(ST.read_restated(spark, state, KEYS, "date_start")) == first
    assert len(first) == t.select(*KEYS).distinct().count()


def test_pointer_sync_replay_is_idempotent(spark, sf_small, tmp_path):
    m = P.manifest(spark, sf_small)
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    m.write.parquet(landing)
    ST.pointer_sync(spark, landing, m.schema, state, str(tmp_path / "ck1"))
    first = _rows(ST.read_pointers(spark, state))
    ST.pointer_sync(spark, landing, m.schema, state, str(tmp_path / "ck2"))
    assert _rows(ST.read_pointers(spark, state)) == first


def test_null_client_keeps_all_pointers(spark, sf_small, tmp_path):
    m = P.manifest(spark, sf_small).limit(2).withColumn("client_uid", F.lit(None).cast("string"))
    a, b = (m.withColumn("creative_id", F.lit(x)).limit(1) for x in ("a", "b"))
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    for part in (a, b):
        part.write.mode("append").parquet(landing)
        ST.pointer_sync(spark, landing, m.schema, state, str(tmp_path / "ck"))
    assert sorted(r.creative_id for r in ST.read_pointers(spark, state).collect()) == ["a", "b"]


def test_windows_count_from_each_tenants_own_days(spark):
    from adlake.operators.frames import lag_window, load_window

    rows = [("t1", f"2024-01-{d:02d}") for d in range(20, 31)] + [("t2", f"2024-01-{d:02d}") for d in range(10, 21)] + [(None, "2024-01-02")]
    df = spark.createDataFrame(rows, "t string, d string").withColumn("d", F.col("d").cast("date"))
    got = {(r.t, str(r.d)) for r in load_window(df, "d", 7, ["t"]).collect()}
    assert got == {("t1", f"2024-01-{d:02d}") for d in range(24, 31)} | {("t2", f"2024-01-{d:02d}") for d in range(14, 21)} | {(None, "2024-01-02")}
    state = spark.createDataFrame([("t1", "2024-01-28"), ("t2", "2024-01-15")], "t string, d string").withColumn("d", F.col("d").cast("date"))
    took = [(r.t, str(r.d)) for r in lag_window(df, state, "d", 3, ["t"]).collect()]
    assert min(d for t, d in took if t == "t1") == "2024-01-25" and min(d for t, d in took if t == "t2") == "2024-01-12" and (None, "2024-01-02") in took


def _responses(spark, rows):
    return spark.createDataFrame([(r, i, '{"call_count": %d}' % c, None, '{"b": [{"type": "t", "call_count": %d}]}' % c) for i, (r, c) in enumerate(rows)],
                                 "run_id string, seq long, app_usage string, account_usage string, business_usage string")


def test_telemetry_state_follows_the_runs_of_a_trigger(spark, tmp_path):
    from adlake.operators.telemetry import rollup

    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    many = _responses(spark, [(f"r{i % 40}", i % 90) for i in range(400)])
    many.coalesce(2).write.parquet(landing)
    ST.ratelimit_stream(spark, landing, many.schema, state, str(tmp_path / "ck"))
    table = ST.telemetry_table(spark, state)
    before = {r.file for r in table.files().collect()}
    more = _responses(spark, [("r7", 100), ("new", 3)]).withColumn("seq", F.col("seq") + 1000)
    more.coalesce(1).write.mode("append").parquet(landing)
    ST.ratelimit_stream(spark, landing, many.schema, state, str(tmp_path / "ck"))  # a restart on the same checkpoint
    after = {r.file for r in table.files().collect()}
    assert len(before) >= 10 and len(before - after) <= 2 and len(after - before) <= 2
    want = sorted(map(tuple, rollup(many.unionByName(more)).collect()), key=str)
    assert sorted(map(tuple, ST.read_telemetry(spark, state).collect()), key=str) == want
    ST.ratelimit_stream(spark, landing, many.schema, state, str(tmp_path / "other"))  # all files once more
    assert sorted(map(tuple, ST.read_telemetry(spark, state).collect()), key=str) == want
