"""Sinks read back what they wrote; named SQL agrees with the DataFrame form."""


from conftest import SF_SMALL
from zonecast.plans import named_sql
from zonecast.plans import products as PR
from zonecast.plans.registry import QUERIES
from zonecast.session import scratch_path
from zonecast.sources import sinks
from zonecast.sources.catalog import Catalog, load_catalog


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_dataframe_and_sql_vehicle_revenue_agree(spark):
    cat = Catalog(spark, SF_SMALL)
    frames = {"trips": PR.trips_clean(cat)}
    sql = named_sql.run_named(spark, "vehicle_revenue_performance", frames)
    df = PR.vehicle_revenue(cat)
    cols = ["vehicle_type", "trips", "completed_revenue", "avg_fare"]
    assert _rows(sql, cols) == _rows(df, cols)


def test_named_runner_exports_csv(spark):
    cat = Catalog(spark, SF_SMALL)
    frames = {"demand_supply": cat["demand_supply"], "zones": cat["zones"], "traffic": cat["traffic"],
              "trips": PR.trips_clean(cat), "timed_trips": PR.timed_clean(cat)}
    out = scratch_path(spark, "named")
    results = named_sql.run_all(spark, frames, out)
    assert set(results) == set(named_sql.NAMED_QUERIES)
    back = spark.read.option("header", True).csv(f"{out}/zone_hourly_fleet_pressure")
    assert back.count() == 100


def test_table_sink_twice_in_one_session(spark):
    a = QUERIES["sink_table_roundtrip"](spark, SF_SMALL).count()
    b = QUERIES["sink_table_roundtrip"](spark, SF_SMALL).count()
    assert a == b == 951


def test_csv_reader_normalises_na_tokens_and_bad_text(spark):
    path = scratch_path(spark, "na")
    spark.createDataFrame([("1", "2.5", "2024-01-01 10:00:00"), ("NA", "N/A", "garbage"), ("", "null", None)],
                          "a string, b string, c string").write.option("header", True).csv(path)
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType, TimestampNTZType
    schema = StructType([StructField("a", LongType()), StructField("b", DoubleType()), StructField("c", TimestampNTZType())])
    got = sorted(sinks.read_csv(spark, path, schema).collect(), key=lambda r: (r["a"] is None, r["a"]))
    assert got[0]["a"] == 1 and got[0]["b"] == 2.5 and got[0]["c"] is not None
    assert all(r["a"] is None and r["b"] is None and r["c"] is None for r in got[1:])


def test_missing_table_fails_before_work(spark):
    import pytest
    with pytest.raises(FileNotFoundError):
        load_catalog(spark, SF_SMALL, ["lineitem", "no_such_table"])
