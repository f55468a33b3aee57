"""Bucketed layouts: joins on the bucket key run without an exchange."""

from adlake.operators import entities as EN
from adlake.sources import buckets as B


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_and_sums_by_parent_need_no_exchange(spark, tmp_path):
    children = spark.createDataFrame([(f"p{i % 50}", f"c{i}", "buy" if i % 3 else "view", float(i), "nvp"[i % 3]) for i in range(400)] + [(None, "x", "buy", 1.0, "n")],
                                     "parent_dlt_id string, child_dlt_id string, action_type string, value double, _side string")
    parents = spark.createDataFrame([(f"p{i}", f"ad{i % 7}", float(i)) for i in range(0, 60, 2)] + [("p4", "ad9", 1.0)], "parent_dlt_id string, ad_id string, spend double")
    laid = {}
    for name, df in (("children", children), ("parents", parents)):
        B.write_buckets(df, f"{tmp_path}/{name}", ["parent_dlt_id"], 4)
        laid[name] = B.read_buckets(spark, f"{tmp_path}/{name}", df.schema, ["parent_dlt_id"], 4).hint("merge")
    assert len(spark.catalog.listTables()) == len([t for t in spark.catalog.listTables() if not t.name.startswith("adlake_")])
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    for laid_out, plain in (
        (EN.child_parent_join(laid["children"], laid["parents"]), EN.child_parent_join(children, parents)),
        (EN.mark_orphans(laid["children"], laid["parents"]), EN.mark_orphans(children, parents)),
        (EN.keep_children(laid["children"], laid["parents"]), EN.keep_children(children, parents)),
    ):
        assert "Exchange" not in _plan(laid_out) and _plan(laid_out).count("Bucketed: true") == 2
        assert rows(laid_out) == rows(plain)
    events = EN.conversion_event_of(laid["children"], laid["parents"], ["ad_id"])
    assert _plan(events).count("Exchange") == 1  # the last sums, by ad
    sides = [children.where(f"_side = '{s}'").drop("_side") for s in "nvp"]
    assert rows(events) == rows(EN.conversion_event(*sides, parents, ["ad_id"]))
