"""Edge values that small green tables do not show: huge sums, NaN, null orders, CSV text, empty children, new files."""

import datetime
import math

import duckdb
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, StringType, StructField, StructType

from zonecast.functions import rules as RU
from zonecast.functions import sqltext
from zonecast.operators import joins, quality
from zonecast.session import scratch_path
from zonecast.sources import sinks
from zonecast.sources.catalog import Catalog


def test_rounding_beyond_bigint(spark):
    values = [1e13, 1e15, 3e16, -3e16, 0.145, -2.5, 9.3e18, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["y"] for r in df.select(RU.round_half_up("x", 4).alias("y")).collect()]
    assert got == [1e13, 1e15, 3e16, -3e16, 0.145, -2.5, 9.3e18, None]
    units = [r["u"] for r in df.select(RU.fixed_units("x").cast("string").alias("u")).collect()]
    assert units[:4] == [str(10 ** 19), str(10 ** 21), str(3 * 10 ** 22), str(-3 * 10 ** 22)]
    sql = [r[0] for r in duckdb.sql(
        f"SELECT {sqltext.rnd('x', 4)} FROM (VALUES (1e13::DOUBLE), (3e16), (-3e16), (0.145)) t(x)").fetchall()]
    assert sql == [1e13, 3e16, -3e16, 0.145]


def test_nan_is_no_value(spark):
    df = spark.createDataFrame([(float("nan"),), (10.0,), (float("inf"),), (None,)], "x double")
    r = df.agg(RU.fixed_avg("x").alias("m"), RU.fixed_sum("x").alias("s")).head()
    assert (r["m"], r["s"]) == (10.0, 10.0)
    assert math.isnan(df.select(RU.round_half_up("x", 2).alias("y")).head()["y"])


def test_update_join_null_orders_and_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "Low", 1), (1, "High", 2), (2, None, 5), (2, "x", None), (3, "p", None), (None, "n", 1)],
                                  "k int, level string, seq int")
    got = {r["v"]: r["level"] for r in joins.update_join_last(left, right, {"k": "k"}, ["level"], order_by="seq").collect()}
    assert got == {"a": "High", "b": None, "c": "p", "d": None}


def test_update_join_splits_a_hot_key(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        left = spark.range(0, 40000, 1, 16).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 500).alias("k"),
                                                   F.sha2(F.col("id").cast("string"), 256).alias("v"))
        right = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        out = joins.update_join_last(left, right, {"k": "k"}, ["w"], order_by="w")
        assert out.count() == 40000 and out.where("w IS NULL").count() == 0
        out.write.format("noop").mode("overwrite").save()
        collected = joins.update_join_last(left, right, {"k": "k"}, ["w"], order_by="w")
        collected.collect()
        assert "skew=true" in collected._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_csv_quotes_tokens_dates(spark):
    schema = StructType([StructField("t", StringType()), StructField("x", DoubleType()), StructField("d", DateType()),
                         StructField("b", BooleanType())])
    rows = [('say "hi", ok', 1.5, datetime.date(2020, 1, 2), True), ("two\nlines", None, None, False), ("plain", 0.0, None, None)]
    path = scratch_path(spark, "t-csv")
    sinks.write_csv(spark.createDataFrame(rows, schema).coalesce(1), path)
    assert sorted(map(tuple, sinks.read_csv(spark, path, schema).collect())) == sorted(rows)
    raw = scratch_path(spark, "t-csv-raw")
    spark.createDataFrame([("nan", "maybe", "#N/A"), ("None", "TRUE", "NULL"), ("2", "0", "<NA>")], "x string, b string, t string").write.option(
        "header", True).csv(raw)
    typed = StructType([StructField("x", DoubleType()), StructField("b", BooleanType()), StructField("t", StringType())])
    assert sorted(map(tuple, sinks.read_csv(spark, raw, typed).collect()), key=str) == sorted(
        [(None, None, None), (None, True, None), (2.0, False, None)], key=str)


def test_empty_child_keeps_its_relations(spark):
    child = spark.createDataFrame([], "a string, b string")
    parent = spark.createDataFrame([("1",)], "p string")
    for rels in ([("one", child, "a", parent, "p")], [("one", child, "a", parent, "p"), ("two", child, "b", parent, "p")]):
        got = [(r["records_checked"], r["missing_foreign_keys"], r["orphan_foreign_keys"]) for r in quality.fk_integrity(rels).collect()]
        assert got == [(0, 0, 0)] * len(rels)


def test_catalog_sees_added_files(spark):
    base = scratch_path(spark, "t-catalog")
    one = spark.range(10).select(F.col("id").alias("r_regionkey"), F.lit("x").alias("r_name"))
    one.write.parquet(f"{base}/region.parquet")
    assert Catalog(spark, base)["region"].count() == 10
    one.limit(5).write.mode("append").parquet(f"{base}/region.parquet")
    assert Catalog(spark, base)["region"].count() == 15
