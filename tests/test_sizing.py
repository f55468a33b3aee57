"""Work that follows the input: partitions, buckets, columns and sorts."""

import datetime as dt

from adlake import session as SE
from adlake.operators import normalize as N
from adlake.operators import unify as U
from adlake.plans import catalog_nested as C
from adlake.sources import lake as L

INITIAL, SCAN = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes"


def test_partitions_follow_the_input(spark):
    before = (spark.conf.get(INITIAL, None), spark.conf.get(SCAN, None))
    try:
        SE.size_session(spark, 6 << 30)
        assert int(spark.conf.get(INITIAL)) == (6 << 30) // SE.INPUT_PER_PARTITION
        assert int(spark.conf.get(SCAN)) <= SE.INPUT_PER_SCAN
        SE.size_session(spark, 1000)  # small input: the session's own settings
        assert (spark.conf.get(INITIAL, None), spark.conf.get(SCAN, None)) == before
    finally:
        SE.unsize_session(spark)
    assert (spark.conf.get(INITIAL, None), spark.conf.get(SCAN, None)) == before


def test_tables_share_columns_and_writers(spark):
    df = spark.createDataFrame([("p1", [("a", "1")], [("b", 2)])], "_dlt_id string, x array<struct<kind:string, value:string>>, y array<struct<kind:string, value:long>>")
    rows, schemas = N.tagged_rows(df, "t", 2)
    # ids, kind, and two values of different types; not a column for each table
    assert sorted(rows.columns) == sorted(["_table", "_c0__dlt_id", "_c0__dlt_parent_id", "_c0__dlt_list_idx", "_c0_kind", "_c0_value", "_c1_value"])
    assert len(schemas) == 3 and rows.count() == 3
    key = "spark.sql.maxConcurrentOutputFileWriters"
    own = spark.conf.get(key, None)
    with SE.open_writers(spark, 3):
        assert spark.conf.get(key) == "4"
    assert spark.conf.get(key, None) == own


def test_layouts_are_lean_and_buckets_grow(spark, tmp_path, monkeypatch):
    rows = [(i, i % 5, i % 3, i % 7 + 1, 1.0, 2.0, 0.1, 0.2, "N", "O", dt.datetime(2024, 1, 1)) for i in range(50)]
    kind = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    size = SE.input_bytes(spark, f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(C, "BUCKET_INPUT", size // 20)
    got = C._children_laid(spark, str(tmp_path), "n", "child_dlt_id")
    assert got.columns == ["parent_dlt_id", "child_dlt_id"]
    assert got.count() == sum((i % 7 + 1) % 4 for i in range(50))
    assert [n for k, (_, _, n) in C._LAYOUTS.items() if k[1] == str(tmp_path)][0] >= 20


def test_unified_rows_tell_their_raw_row(spark):
    raw = spark.createDataFrame([("a", "1", "10.0", "r1"), ("a", "1", "20.0", "r2"), ("a", "2", "20.0", None)], "client string, id string, _dlt_load_id string, _dlt_id string")
    out = U.unify_parent(raw, "campaigns", dt.datetime(2024, 1, 1), row_id="_dlt_id")
    assert sorted((r.source_id, r._dlt_id) for r in out.collect()) == [("1", "r2"), ("2", None)]
    assert "_dlt_id" not in U.unify_parent(raw, "campaigns", dt.datetime(2024, 1, 1)).columns


def test_one_day_lands_without_a_shuffle(spark, tmp_path):
    rows = spark.createDataFrame([(c, str(i), "2024-02-01") for i, c in enumerate("aabbc")], "client string, id string, date string").repartition(3)
    for few in (True, False):
        L.write_raw(rows, f"{tmp_path}/{few}", "campaigns", few=few)
        assert sorted(tuple(r) for r in L.read_raw(spark, f"{tmp_path}/{few}", "campaigns").select("client", "id").collect()) == [("a", "0"), ("a", "1"), ("b", "2"), ("b", "3"), ("c", "4")]
    L.drop(spark, f"{tmp_path}/True")
    assert not SE.exists(spark, f"{tmp_path}/True")
