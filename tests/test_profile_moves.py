"""The profile and the duplicate count move their rows once: the trips are derived once, the repeating prints are
looked up by broadcast in parts, and all prints go through one exchange."""

from __future__ import annotations

import datetime as dt

import pyspark.sql.functions as F

from zonecast.operators import quality
from zonecast.plans import products as PR
from zonecast.sources.catalog import Catalog

DAY = dt.datetime(2024, 1, 1)


def _catalog(spark) -> Catalog:
    cat = Catalog(spark, "/nowhere")
    # order 50 is copied by the view; the second line of order 2 is a null-ridden repeat of the first
    lines = [(o, 1, s, 1, 5.0, 7.0, 0.1, 0.2, "N", "O", DAY) for o, s in ((50, 1), (2, 1), (2, 1), (3, 2), (4, 9))]
    for name, rows, schema in (
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
         " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        ("orders", [(50, 1, DAY), (2, 1, DAY), (3, None, DAY), (4, 1, DAY)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz"),
        ("customer", [(1, 3)], "c_custkey long, c_nationkey int"),
        ("supplier", [(1, 4), (2, None)], "s_suppkey long, s_nationkey int"),
        ("part", [(1, "A")], "p_partkey long, p_type string"),
    ):
        cat.register(name, spark.createDataFrame(rows, schema))
    return cat


def test_duplicate_rows_derives_the_trips_once(spark):
    cat = _catalog(spark)
    # order 3 has no customer and order 4 no supplier: the inner joins leave (50 twice) and (2 twice)
    assert tuple(PR.duplicate_rows(cat).first()) == (4, 2, 2)
    plan = cat["trips_messy"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "parquet" in plan


def test_frames_put_in_by_hand_stay(spark):
    cat = _catalog(spark)
    cat.register("trips_messy", spark.createDataFrame([(1,), (1,), (None,)], "a int"))
    assert tuple(PR.duplicate_rows(cat).first()) == (3, 2, 1)


def test_repeating_prints_are_looked_up_in_parts(spark):
    df = spark.createDataFrame([(i // 2, None if i % 4 < 2 else "x") for i in range(40)], "a int, b string")
    rows = df.select("*", *quality._row_print(df))
    twice = rows.groupBy("_h1", "_h2").count().where("count > 1")
    parts = quality._distinct_among(0, df, twice.select("_h1", "_h2"), 20, most=6)
    assert len(parts) == 4
    assert sum(r["_d"] for p in parts for r in p.collect()) == 20
    assert all("BroadcastHashJoin" in p._jdf.queryExecution().executedPlan().toString() for p in parts)


def test_all_prints_go_through_one_exchange(spark, monkeypatch):
    frames = []

    def kept(df, name, *rest):
        frames.append(df)
        df.collect()
        return df.localCheckpoint()
    monkeypatch.setattr(quality, "written", kept)
    df = spark.range(2000).select((F.col("id") % 1500).alias("a"))
    assert tuple(quality.duplicate_rows(df).first()) == (2000, 1500, 500)
    plan = frames[0]._jdf.queryExecution().executedPlan()
    assert frames[0].columns[:2] == ["_t", "rows"] and "ReusedExchange" in plan.toString()
