"""Validation products on hand-made trips, demand and traffic (FIXTURES §2)."""

import datetime as dt

from conftest import SF_SMALL
from zonecast.plans import products as PR
from zonecast.sources.catalog import Catalog

T = dt.datetime(2026, 5, 1, 9)
M = dt.timedelta(minutes=1)
TRIPS = ("trip_id string, request_timestamp timestamp_ntz, pickup_timestamp timestamp_ntz, "
         "dropoff_timestamp timestamp_ntz, pickup_zone_id string, drop_zone_id string, driver_id string, "
         "vehicle_id string, vehicle_type string, distance_km double, fare double, wait_time_min double, "
         "trip_duration_min double, status string, cancellation_reason string, payment_method string, "
         "surge_multiplier double, discount double, rating double, is_driver_linked boolean")


def _t(i, req=T, pick=T + M, drop=T + 9 * M, pz="z1", dz="z2", drv="d1", dist=2.0, fare=80.0, wait=3.0,
       dur=8.0, status="Completed"):
    return (i, req, pick, drop, pz, dz, drv, "v1", "Cab", dist, fare, wait, dur, status, None, "Card", 1.0, 0.0, 4.0,
            drv is not None)


def catalog(spark):
    cat = Catalog(spark, SF_SMALL)
    cat.register("zones", spark.createDataFrame([("z1", "A", "North"), ("z2", "B", "South"), ("z3", "C", "North")],
                                                "zone_id string, zone_name string, city string"))
    cat.register("trips", spark.createDataFrame([
        _t("a"), _t("b", pick=T - M), _t("c", drop=T), _t("d", pz="zX"), _t("e", dz=None), _t(None),
        _t("f", wait=-1.0), _t("g", dur=-2.0), _t("h", dist=0.0, status="Cancelled"), _t("i", drv=None, dz="z3"),
    ], TRIPS))
    cat.register("drivers", spark.createDataFrame([("d1", "z1"), (None, "z7")], "driver_id string, home_zone_id string"))
    cat.register("vehicles", spark.createDataFrame([("v1", "z1")], "vehicle_id string, home_zone_id string"))
    cat.register("city_events", spark.createDataFrame([("e1", "z9")], "event_id string, zone_id string"))
    cat.register("demand_supply", spark.createDataFrame(
        [(T, "z1", 5, 0, 1, 1), (T, "z2", 0, 0, 0, 0), (T, "z3", 3, -1, 3, 2), (T, "z9", 4, 2, 1, 1)],
        "timestamp timestamp_ntz, zone_id string, ride_requests int, available_vehicles int, completed_trips int, "
        "cancelled_trips int"))
    cat.register("traffic", spark.createDataFrame([(T, "z1", 0.0), (T, "z2", 20.0), (T, "z3", None)],
                                                  "timestamp timestamp_ntz, zone_id string, avg_speed_kmph double"))
    return cat


def test_quality_rules(spark):
    got = {(r["dataset"], r["check"]): r["failed_records"] for r in PR.quality_checks(catalog(spark)).collect()}
    assert got[("trips", "pickup_before_request")] == 1
    assert got[("trips", "dropoff_before_pickup")] == 1
    assert got[("trips", "negative_wait_time")] == 1 and got[("trips", "negative_duration")] == 1
    assert got[("trips", "non_positive_distance")] == 1 and got[("trips", "non_positive_fare")] == 0
    assert got[("demand_supply", "negative_available_vehicles")] == 1
    assert got[("demand_supply", "completed_plus_cancelled_exceeds_requests")] == 1
    assert got[("traffic", "non_positive_speed")] == 1      # the null speed is not a failure


def test_integrity_and_outcome(spark):
    cat = catalog(spark)
    fk = {r["relationship"]: (r["records_checked"], r["missing_foreign_keys"], r["orphan_foreign_keys"])
          for r in PR.fk_integrity(cat).collect()}
    assert fk["trips.pickup_zone_id -> zones.zone_id"] == (10, 0, 1)
    assert fk["trips.drop_zone_id -> zones.zone_id"] == (10, 1, 0)
    assert fk["trips.driver_id -> drivers.driver_id"] == (10, 1, 0)
    assert fk["events.zone_id -> zones.zone_id"] == (1, 0, 1)
    out = {r["outcome"]: r["value"] for r in PR.validation_outcome(cat).collect()}
    assert fk["drivers.home_zone_id -> zones.zone_id"] == (2, 0, 1)
    assert out == {"integrity_failures": 5, "failed_quality_rules": 8}


def test_kpis_null_city_counts_as_cross_city(spark):
    k = {r["metric"]: r["value"] for r in PR.kpis(catalog(spark)).collect()}
    # pickup zX and drop null have no city: different by the pandas rule; i goes North -> North
    assert k["cross_city_trip_share"] == 0.9
    assert k["cancellation_rate"] == 0.1
    # zero denominators give null and are skipped; a negative one is kept (G-4): (-3 + 2) / 2
    assert k["average_demand_supply_ratio"] == -0.5
