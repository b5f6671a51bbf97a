"""Plan shape checks for the scale claims in README."""

import re

import pyspark.sql.functions as F

from conftest import SF_SMALL
from zonecast.operators import ranking
from zonecast.plans import products as PR
from zonecast.session import written
from zonecast.sources.catalog import Catalog


def _plan(df, capsys):
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_percentile_reads_the_panel_once(spark, capsys):
    panel = written(spark.createDataFrame([(i, float(i % 97), float(i)) for i in range(5000)], "id int, v double, w double"), "panel")
    plan = _plan(ranking.percentile_scores(panel, {"v": "s", "w": "t"}), capsys)
    assert "Window" not in plan and "SinglePartition" not in plan and "Exchange hash" not in plan
    files = re.findall(r"Location: \w+ \[(.*?)\]", plan)
    assert sum("panel" in f for f in files) == 1 and sum("rank-index" in f for f in files) == 2


def test_rank_index_windows_over_ranges(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ranking, "written", lambda df, name: seen.append(df._jdf.queryExecution().executedPlan().toString()) or written(df, name))
    ranking.rank_index(spark.range(5000).selectExpr("double(id % 97) AS v", "double(id) AS w"), ["v", "w"])
    windows = re.findall(r"Window \[.*?\], \[(_m#\d+, _b#\d+)\]", seen[1])
    assert len(windows) == 1 and "SinglePartition" not in seen[1]


def test_global_rank_sorts_by_ranges(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ranking, "written", lambda df, name: seen.append(df._jdf.queryExecution().executedPlan().toString()) or written(df, name))
    rows = [(i * 7919 % 4001, None if i % 11 == 0 else i % 13) for i in range(4001)]
    df = spark.createDataFrame(rows, "id int, v int").repartition(5)
    got = ranking.global_rank(df, [F.col("v").desc_nulls_last(), F.col("id").asc()]).collect()
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [(r["id"], r["v"]) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 4002))
    assert "rangepartitioning" in seen[0] and "SinglePartition" not in seen[0]
    assert ranking.global_rank(df.where("false"), [F.col("id").asc()]).count() == 0


def test_star_joins_dimensions_by_broadcast(spark, capsys):
    plan = _plan(PR.zone_hour_star(Catalog(spark, SF_SMALL)), capsys)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_cleaning_shuffles_once(spark, capsys):
    plan = _plan(PR.trips_clean(Catalog(spark, SF_SMALL)), capsys)
    tree = plan.split("\n\n")[0]
    assert len(re.findall(r"\bExchange \(", tree)) == 1   # the dedup; every join is broadcast
    assert tree.count("Scan parquet") == 5                 # one scan per base table, copies by a generator
