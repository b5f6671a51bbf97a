"""Hot groups: one key, copy group or value holds a third of all rows.
Results must stay whole and exact."""

import pyspark.sql.functions as F

from zonecast.operators import cleaning, joins, quality, ranking
from test_cleaning import SCHEMA, _trip


def test_dedup_and_audit_with_a_hot_copy_group(spark):
    rows = [_trip(0)] * 3000 + [_trip(i) for i in range(1, 2001)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert cleaning.clean_trips(df).count() == 2001
    audit = {r["step_no"]: r for r in cleaning.cleaning_audit(df).collect()}
    assert audit[1]["affected_records"] == 2999 and audit[1]["rows_remaining"] == 2001
    assert quality.duplicate_rows(df).first()["duplicate_rows"] == 2999


def test_update_join_and_orphans_with_a_hot_key(spark):
    left = spark.createDataFrame([("hot" if i % 3 == 0 else f"k{i}", i) for i in range(6000)], "k string, v int")
    right = spark.createDataFrame([("hot", 1.0, 1), ("hot", 2.0, 2)] + [(f"k{i}", float(i), 1) for i in range(0, 6000, 2)],
                                  "k string, w double, seq int")
    out = joins.update_join_last(left, right, {"k": "k"}, ["w"], order_by="seq")
    assert out.count() == 6000
    assert out.where("k = 'hot'").agg(F.min("w"), F.max("w")).first() == (2.0, 2.0)
    parent = right.select(F.col("k").alias("id"))
    r = joins.orphan_counts(left, "k", parent, "id").first()
    expected_orphans = sum(1 for i in range(6000) if i % 3 != 0 and i % 2 == 1)
    assert (r["records_checked"], r["missing_foreign_keys"], r["orphan_foreign_keys"]) == (6000, 0, expected_orphans)


def test_top1_and_percentile_with_a_hot_value(spark):
    df = spark.createDataFrame([(i, 0.0 if i % 3 == 0 else float(i)) for i in range(9000)], "id int, v double")
    out = ranking.percentile_scores(df, {"v": "s"}, ranges=16)
    hot = out.where("v = 0.0").select("s").distinct().collect()
    assert len(hot) == 1 and abs(hot[0]["s"] - (1 + 3000) / 2 / 9000 * 100) < 1e-9
    assert out.count() == 9000
