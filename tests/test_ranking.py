"""Percentile score against pandas, top-1 ties, top-k, seeded sample exactness."""

import numpy as np
import pandas as pd
import pytest

from zonecast.operators import ranking, stats


def _pandas_scores(values):
    return (pd.Series(values, dtype="float64").rank(pct=True, method="average") * 100).tolist()


def _spark_scores(spark, values, ranges=None):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    out = ranking.percentile_scores(df, {"v": "s"}, ranges=ranges).orderBy("id").collect()
    return [r["s"] for r in out]


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 2.0, 3.0, None, 2.0],          # ties and a null
    [5.0, 5.0, 5.0],                           # all equal
    [7.0],                                     # one row
    [None, None],                              # only nulls
])
def test_percentile_edge_fixtures(spark, values):
    got = _spark_scores(spark, values)
    want = _pandas_scores(values)
    for g, w in zip(got, want):
        assert (g is None and np.isnan(w)) or abs(g - w) < 1e-9


def test_percentile_empty(spark):
    df = spark.createDataFrame([], "id int, v double")
    assert ranking.percentile_scores(df, {"v": "s"}).count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_percentile_matches_pandas_with_hot_value(spark, ranges):
    rng = np.random.default_rng(7)
    vals = [float(v) for v in np.round(rng.exponential(3.0, 3000), 1)]
    vals += [0.0] * 1500                      # one value holds a third of the rows
    vals += [None] * 50
    got = _spark_scores(spark, vals, ranges)
    want = _pandas_scores(vals)
    diff = max(abs(g - w) for g, w in zip(got, want) if g is not None)
    assert diff < 1e-9
    assert sum(g is None for g in got) == 50
    scores = [g for g in got if g is not None]
    n = len(scores)
    assert abs(np.mean(scores) - 50 * (n + 1) / n) < 1e-9   # invariant of SURVEY §5.2


def test_top1_per_group_tie_takes_first_label(spark):
    df = spark.createDataFrame([("z", 1, "Sedan", 3), ("z", 1, "Auto", 3), ("z", 1, "Bike", 2),
                                ("y", 2, "Bike", 1)], "zone string, hour int, vt string, n long")
    out = {(r["zone"], r["hour"]): r["vt"] for r in ranking.top1_per_group(df, ["zone", "hour"], "n", "vt").collect()}
    assert out == {("z", 1): "Auto", ("y", 2): "Bike"}


def test_top_k_ranks_and_tie_breaks(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(10)], "id int, v double")
    import pyspark.sql.functions as F
    out = ranking.top_k(df, [F.col("v").desc(), "id"], 4).orderBy("rank").collect()
    assert [(r["id"], r["rank"]) for r in out] == [(2, 1), (5, 2), (8, 3), (1, 4)]


def test_seeded_sample_is_exact_and_deterministic(spark):
    import pyspark.sql.functions as F
    df = spark.createDataFrame([(f"k{i}", i) for i in range(5000)], "key string, x int").repartition(7)
    a = stats.seeded_sample(df, "key", 1234)
    b = stats.seeded_sample(df.repartition(3), "key", 1234)
    ka = sorted(r["key"] for r in a.collect())
    kb = sorted(r["key"] for r in b.collect())
    brute = (df.withColumn("h", F.md5(F.concat(F.col("key").cast("string"), F.lit(f"|{stats.SAMPLE_SEED}")).cast("binary")))
             .orderBy("h", "key").limit(1234).collect())
    assert ka == kb == sorted(r["key"] for r in brute)
    assert stats.seeded_sample(df, "key", 10_000).count() == 5000


def test_percentile_shuffle_join_path_matches_broadcast_path(spark):
    vals = [float(v) for v in np.round(np.random.default_rng(3).normal(0, 1, 2000), 2)] + [None] * 5
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, v double")
    a = {r["id"]: r["s"] for r in ranking.percentile_scores(df, {"v": "s"}).collect()}
    b = {r["id"]: r["s"] for r in ranking.percentile_scores(df, {"v": "s"}, max_broadcast_rows=0).collect()}
    assert a == b


def test_seeded_sample_with_a_hot_key_is_deterministic(spark):
    rows = [("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "key string, x int")
    a = sorted(tuple(r) for r in stats.seeded_sample(df.repartition(5), "key", 4000).collect())
    b = sorted(tuple(r) for r in stats.seeded_sample(df.repartition(3), "key", 4000).collect())
    assert a == b and len(a) == 4000


def test_explicit_order_puts_unknown_levels_last(spark):
    import pyspark.sql.functions as F
    df = spark.createDataFrame([("Severe",), ("Gridlock",), ("Low",), ("High",)], "level string")
    out = ranking.explicit_order(df, "level", ["Low", "Medium", "High", "Severe"]) \
        .orderBy(F.col("position").asc_nulls_last()).collect()
    assert [(r["level"], r["position"]) for r in out] == [("Low", 1), ("High", 3), ("Severe", 4), ("Gridlock", None)]


def test_percentile_of_many_values_comes_back_by_row(spark):
    rng = np.random.default_rng(4)
    a = [None if k % 17 == 0 else 5.0 if k % 3 == 0 else float(v) for k, v in enumerate(rng.normal(size=2000))]
    b = [float(v) for v in rng.integers(0, 900, 2000)]
    df = spark.createDataFrame(list(zip(range(2000), a, b)), "id int, a double, b double")
    # no broadcast: hot values by broadcast, the rest by shuffle, one wide step back
    out = {r["id"]: r for r in ranking.percentile_scores(df, {"a": "sa", "b": "sb"}, max_broadcast_rows=0).collect()}
    assert len(out) == 2000 and set(out[0].asDict()) == {"id", "a", "b", "sa", "sb"}
    for col, vals in (("sa", a), ("sb", b)):
        for k, w in enumerate(_pandas_scores(vals)):
            g = out[k][col]
            assert (g is None and np.isnan(w)) or abs(g - w) < 1e-9
