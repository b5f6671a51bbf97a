"""Append load with its ledger, table and folder pairs with their marker, and the script forms."""

import pyspark.sql.functions as F
import pytest

from conftest import SF_SMALL
from zonecast.operators import quality
from zonecast.plans import jobs
from zonecast.plans import products as PR
from zonecast.session import scratch_path
from zonecast.sources import load, sinks
from zonecast.sources.catalog import Catalog
from zonecast.sources.schemas import ROLE_SCHEMAS

SCHEMA = ROLE_SCHEMAS["demand_supply"]


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_append_load_is_incremental_and_idempotent(spark):
    ds = Catalog(spark, SF_SMALL)["demand_supply"]
    folder, table = scratch_path(spark, "t-load"), scratch_path(spark, "t-table")
    assert load.read_table(spark, table, SCHEMA).count() == 0
    sinks.write_csv(ds.where("zone_id < '3'"), f"{folder}/a")
    first = load.append_load(spark, folder, table, SCHEMA)
    assert first.files > 0 and rows_of(load.read_table(spark, table, SCHEMA)) == rows_of(ds.where("zone_id < '3'"))
    assert load.append_load(spark, folder, table, SCHEMA) == load.LoadResult(0, None)
    sinks.write_csv(ds.where("zone_id >= '3'"), f"{folder}/b")
    second = load.append_load(spark, folder, table, SCHEMA)
    assert second.batch != first.batch and load.append_load(spark, folder, table, SCHEMA).files == 0
    assert rows_of(load.read_table(spark, table, SCHEMA)) == rows_of(ds)
    assert load.ledger(spark, table).select("path").distinct().count() == first.files + second.files


def test_load_that_failed_before_its_commit_leaves_the_table(spark, monkeypatch):
    ds = Catalog(spark, SF_SMALL)["demand_supply"]
    folder, table = scratch_path(spark, "t-load"), scratch_path(spark, "t-table")
    sinks.write_csv(ds.limit(10), f"{folder}/a")
    load.append_load(spark, folder, table, SCHEMA)
    before = rows_of(load.read_table(spark, table, SCHEMA))
    sinks.write_csv(ds.where("zone_id = '7'"), f"{folder}/b")
    # rows of a batch without a ledger entry are not part of the table
    ds.write.parquet(f"{table}/data/batch=half-way")
    assert rows_of(load.read_table(spark, table, SCHEMA)) == before
    load.append_load(spark, folder, table, SCHEMA)
    assert load.read_table(spark, table, SCHEMA).count() == 10 + ds.where("zone_id = '7'").count()


def test_replaced_file_is_refused(spark):
    folder, table = scratch_path(spark, "t-load"), scratch_path(spark, "t-table")
    ds = Catalog(spark, SF_SMALL)["demand_supply"]
    sinks.write_csv(ds.limit(5).coalesce(1), folder)
    load.append_load(spark, folder, table, SCHEMA)
    path = load.ledger(spark, table).first()["path"].removeprefix("file:")
    with open(path, "a", encoding="utf-8") as f:
        f.write("2024-01-01 00:00:00,9,1,1,1,0,1.0\n")
    with pytest.raises(ValueError, match="replaced"):
        load.append_load(spark, folder, table, SCHEMA)


def test_pair_agrees_and_carries_checks(spark):
    path = scratch_path(spark, "t-pair")
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    table, folder, seen = sinks.save_table(df, "zonecast_t_pair", path, checks=quality.gate_counts(F.col("x") == 3))
    assert rows_of(table) == rows_of(folder) == rows_of(df)
    assert seen == {"checked": 1000, "failed": df.where("x = 3").count()}
    again, _, none = sinks.save_table(df.where("x = 1"), "zonecast_t_pair", path)
    assert none == {} and again.count() == spark.table("zonecast_t_pair").count() == df.where("x = 1").count()


def test_pair_survives_failures(spark, monkeypatch):
    path = scratch_path(spark, "t-pair")
    old = spark.range(5).withColumn("x", F.lit(1))
    sinks.save_table(old, "zonecast_t_pair2", path)
    # before the marker: the old pair stays
    monkeypatch.setattr(sinks, "_write_marker", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sinks.save_table(spark.range(9).withColumn("x", F.lit(2)), "zonecast_t_pair2", path)
    monkeypatch.undo()
    table, folder = sinks.open_table(spark, "zonecast_t_pair2", path)
    assert rows_of(table) == rows_of(folder) == rows_of(old) and spark.table("zonecast_t_pair2").count() == 5
    # after the marker: opening the pair finishes the job
    monkeypatch.setattr(sinks, "open_table", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        sinks.save_table(spark.range(9).withColumn("x", F.lit(2)), "zonecast_t_pair2", path)
    monkeypatch.undo()
    table, folder = sinks.open_table(spark, "zonecast_t_pair2", path)
    assert table.count() == folder.count() == spark.table("zonecast_t_pair2").count() == 9


def test_script_forms(spark):
    cat = Catalog(spark, SF_SMALL)
    trips = PR.timed_clean(cat).limit(1).select("*")
    row = trips.first().asDict()
    frame = spark.createDataFrame([row | {"trip_id": None}, row], trips.schema)
    plain = PR.zone_hour_trip_metrics(frame).first()["observed_trips"]
    assert (plain, PR.zone_hour_trip_metrics(frame, count_ids=True).first()["observed_trips"]) == (2, 1)
    ds = cat["demand_supply"].limit(2)
    cat.register("demand_supply", ds.withColumn("available_vehicles", F.lit(-2)))
    assert PR.fleet_pressure(cat).where("demand_supply_ratio IS NULL").count() == 0
    assert PR.fleet_pressure(cat, script=True).where("demand_supply_ratio IS NULL").count() == 2
    nulls = spark.createDataFrame([row | {"fare": None}], trips.schema).drop("is_driver_linked")
    cat.register("trips_timed", nulls)
    assert (PR.timed_clean(cat).count(), PR.timed_clean(cat, null_policy="drop").count()) == (1, 0)


def test_notebook_gates_equal_the_entry(spark):
    got = jobs.notebook_job(spark, SF_SMALL, scratch_path(spark, "t-notebook"), table_prefix="zonecast_t")
    want = {r["gate"]: (r["checked"], r["failed"]) for r in PR.data_gates(Catalog(spark, SF_SMALL)).collect()}
    assert got == {g: want[g] for g in got} and len(got) == 2
