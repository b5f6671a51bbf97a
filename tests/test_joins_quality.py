"""Joins keep their grain; integrity and profile counts on edge frames."""


import pandas as pd
import pyspark.sql.functions as F

from zonecast.operators import joins, quality


def test_update_join_last_match_wins_and_keeps_rows(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10, 1), ("a", 11, 2), ("b", 20, 1)], "k string, w int, seq int")
    out = joins.update_join_last(left, right, {"k": "k"}, ["w"], order_by="seq")
    got = {r["k"]: r["w"] for r in out.collect()}
    assert got == {"a": 11, "b": 20, "c": None}
    assert out.columns == ["k", "v", "w"]


def test_star_assemble_checks_grain(spark):
    import pytest
    panel = spark.createDataFrame([(1,), (2,)], "k int")
    dup = spark.createDataFrame([(1, "x"), (1, "y")], "k int, s string")
    with pytest.raises(ValueError):
        joins.star_assemble(panel, [(dup, ["k"])], check_grain=True)


def test_reindex_keeps_listed_categories_only(spark):
    agg = spark.createDataFrame([("B", 5), ("Z", 9)], "c string, n long")
    out = {r["c"]: (r["position"], r["n"]) for r in joins.reindex_categories(agg, "c", ["A", "B"]).collect()}
    assert out == {"A": (1, None), "B": (2, 5.0)}


def test_orphan_counts_null_child_orphan_and_null_parent(spark):
    child = spark.createDataFrame([("1",), ("2",), (None,), ("9",), ("9",)], "k string")
    parent = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    r = joins.orphan_counts(child, "k", parent, "id").first()
    assert (r["records_checked"], r["missing_foreign_keys"], r["orphan_foreign_keys"]) == (5, 1, 2)


def test_profile_and_missing_match_pandas(spark):
    pdf = pd.DataFrame({"a": [1, 1, 2, None], "b": ["x", "x", None, None]})
    df = spark.createDataFrame([(1.0, "x"), (1.0, "x"), (2.0, None), (None, None)], "a double, b string")
    p = quality.dataset_profile({"t": df}).first()
    assert p["rows"] == len(pdf) and p["columns"] == 2
    assert p["duplicate_rows"] == int(pdf.duplicated().sum())
    assert p["missing_cells"] == int(pdf.isna().sum().sum())
    m = {r["column_name"]: (r["missing_count"], r["missing_pct"]) for r in quality.missing_by_column("t", df).collect()}
    assert m == {"a": (1, 0.25), "b": (2, 0.5)}


def test_rule_failures_ignore_null_and_gates(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    r = quality.rule_failures("t", df, [("neg", F.col("x") < 0)]).first()
    assert r["failed_records"] == 1
    g = quality.gate("g", df, F.col("x") < 0, allow=F.col("x") == -1.0).first()
    assert g["failed"] == 0 and g["passed"]
    import pytest
    with pytest.raises(AssertionError):
        quality.assert_gates(quality.gate("g", df, F.col("x") < 0))


def test_fk_integrity_one_pass_per_child_matches_per_relation(spark):
    child = spark.createDataFrame([("1", "a"), ("2", None), (None, "z"), ("9", "a")], "p string, q string")
    parent_p = spark.createDataFrame([("1",), ("2",)], "id string")
    parent_q = spark.createDataFrame([("a",), (None,)], "id string")
    rels = [("c.p -> P", child, "p", parent_p, "id"), ("c.q -> Q", child, "q", parent_q, "id")]
    got = {r["relationship"]: tuple(r)[1:] for r in quality.fk_integrity(rels).collect()}
    for label, c, ck, par, pk in rels:
        one = joins.orphan_counts(c, ck, par, pk).first()
        assert got[label] == (one["records_checked"], one["missing_foreign_keys"], one["orphan_foreign_keys"])
    assert got == {"c.p -> P": (4, 1, 1), "c.q -> Q": (4, 1, 1)}


def test_join_dim_without_broadcast_gives_same_rows(spark):
    fact = spark.createDataFrame([(i, str(i % 7)) for i in range(300)], "id int, k string")
    dim = spark.createDataFrame([(str(i), f"n{i}") for i in range(5)], "k string, name string")
    a = sorted(tuple(r) for r in joins.join_dim(fact, dim, "k", "left").collect())
    b = sorted(tuple(r) for r in joins.join_dim(fact, dim, "k", "left", max_bytes=1).collect())
    assert a == b and len(a) == 300


def test_profile_and_missing_in_one_pass_match_separate_reports(spark):
    from conftest import SF_SMALL
    from zonecast.plans import products as PR
    from zonecast.sources.catalog import Catalog
    cat = Catalog(spark, SF_SMALL)
    tables = PR.role_tables(cat)
    profile, missing = quality.profile_and_missing(tables)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(profile.select("dataset", "rows", "columns", "duplicate_rows", "missing_cells")) == \
        key(quality.dataset_profile(tables).select("dataset", "rows", "columns", "duplicate_rows", "missing_cells"))
    assert key(missing) == key(quality.missing_values(tables).select("dataset", "column_name", "missing_count",
                                                                     "missing_pct"))


def test_broadcast_check_reads_plan_statistics(spark):
    from conftest import SF_SMALL
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    size = joins.estimated_bytes(nation)
    assert 0 < joins.estimated_bytes(nation.select("n_nationkey")) < size     # scaled to the columns read
    assert joins.fits_broadcast(nation, max_bytes=size) and not joins.fits_broadcast(nation, max_bytes=size - 1)


def test_prints_tell_rows_apart(spark):
    rows = [(None, 1, "a"), (1, None, "a"), (1, 1, None), (None, None, None), (None, None, None), (1, 1, "a"), (1, 1, "a"), (1, 1, "a")]
    df = spark.createDataFrame(rows, "x int, y int, s string")
    assert tuple(quality.duplicate_rows(df).first()) == (8, 5, 3)
    wide = df.select(*[F.lit(i).alias(f"c{i}") for i in range(70)], F.col("s").alias("last"), F.col("x").alias("a.b"))
    f = quality.table_facts({"w": wide, "e": df.where("false")})
    assert (f["w"].rows, f["w"].distinct_rows, f["w"].nulls["last"], f["w"].nulls["a.b"], f["w"].nulls["c3"]) == (8, 4, 3, 3, 0)
    assert (f["e"].rows, f["e"].distinct_rows) == (0, 0)


def test_rows_under_one_print_are_compared(spark, monkeypatch):
    monkeypatch.setattr(quality, "_row_print", lambda df: [F.lit(1).alias("_h1"), F.lit(2).alias("_h2")])
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "c")], "x int, s string")
    assert tuple(quality.duplicate_rows(df).first()) == (4, 3, 1)


def test_split_join_with_a_hot_key(spark):
    left = spark.createDataFrame([("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{i}", i) for i in range(3000)], "k string, v int")
    right = spark.createDataFrame([("hot", 1.0)] + [(f"k{i}", float(i)) for i in range(0, 3000, 2)], "k string, w double")
    want = sorted(map(str, left.join(right, "k", "left").collect()))
    assert sorted(map(str, joins.split_join(left, right, ["k"], share=0.01).select("k", "v", "w").collect())) == want
    star = joins.star_assemble(left, [(right, ["k"])], check_grain=True, hot=True)
    assert sorted(map(str, star.select("k", "v", "w").collect())) == want
    assert [r["k"] for r in joins.frequent_keys(left, ["k"], 0.1).collect()] == ["hot"]
    # the hot key's rows reach no shuffle: its part of the plan joins by broadcast on the left
    plan = joins.split_join(left, right, ["k"], share=0.01)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
