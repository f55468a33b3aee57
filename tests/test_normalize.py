"""Nested rows -> parent + child tables; nesting cap; name normalising."""

from pyspark.sql import functions as F

from adlake.operators import normalize as N
from adlake.operators.frames import normalize_name


def _nested(spark):
    return spark.sql("""
        SELECT 'p1' AS _dlt_id, named_struct('id', 'c9') AS creative,
               array(named_struct('action_type', 'a', `1d_view`, '1'), named_struct('action_type', 'b', `1d_view`, '2')) AS actions
    """.replace("`1d_view`", "'1d_view'"))


def test_children_with_ids_and_index(spark):
    t = N.normalize_nested(_nested(spark), "ins", 2)
    assert set(t) == {"ins", "ins__actions"}
    assert "creative__id" in t["ins"].columns
    rows = t["ins__actions"].orderBy("_dlt_list_idx").collect()
    assert [r["_dlt_list_idx"] for r in rows] == [0, 1]
    assert rows[0]["_dlt_parent_id"] == "p1" and "_1d_view" in t["ins__actions"].columns


def test_cap_zero_keeps_json(spark):
    t = N.normalize_nested(_nested(spark), "ins", 0)
    assert set(t) == {"ins"}
    assert t["ins"].select(F.json_array_length("actions")).first()[0] == 2


def test_names():
    assert normalize_name("1d_view") == "_1d_view"
    assert normalize_name("Action Type") == "action_type"
    assert normalize_name("_dlt_id") == "_dlt_id"


def _two_levels(spark):
    kind = "_dlt_id string, client string, creative struct<id:string>, actions array<struct<`1d_view`:string, info:struct<n:int>, touches:array<struct<pos:int, tags:array<string>>>>>, labels array<string>"
    rows = [("p1", "a", ("c",), [("1", (1,), [(0, ["x", "y"]), (1, None)]), ("2", None, None), None, ("3", (4,), [])], ["l", None]),
            ("p2", "b", None, None, []), ("p3", "a", ("d",), [], None)]
    return spark.createDataFrame(rows, kind)


def test_one_scan_gives_the_same_tables(spark, tmp_path):
    for cap in (0, 1, 2, 3):
        df = _two_levels(spark)
        want = N.normalize_nested(df, "ins", cap, carry=("client",))
        got = N.normalize_to(df, f"{tmp_path}/{cap}", "ins", cap, carry=("client",))
        assert list(got) == list(want)
        assert cap < 2 or "ins__actions__touches" in got
        for name in want:
            assert got[name].columns == want[name].columns and [f.dataType for f in got[name].schema] == [f.dataType for f in want[name].schema]
            assert sorted(map(str, got[name].collect())) == sorted(map(str, want[name].collect())), (cap, name)


def test_one_scan_reads_the_source_once(spark, tmp_path):
    _two_levels(spark).write.parquet(f"{tmp_path}/in")
    rows, schemas = N.tagged_rows(spark.read.parquet(f"{tmp_path}/in"), "ins", 2, ("client",))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and len(schemas) == 4
    rows.limit(0).write.partitionBy("_table").parquet(f"{tmp_path}/none")
    empty = N.normalize_to(spark.read.parquet(f"{tmp_path}/in").limit(0), f"{tmp_path}/out", "ins", 2, ("client",))
    assert all(f.count() == 0 for f in empty.values())
