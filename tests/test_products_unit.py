"""Opportunity score and recommendations on a hand-made catalog; expected
values worked out by hand from the rules (SURVEY D-12, D-13, G-8, G-10)."""

import datetime as dt

from conftest import SF_SMALL
from test_cleaning import SCHEMA
from zonecast.plans import products as PR
from zonecast.sources.catalog import Catalog

H10, H11 = dt.datetime(2026, 3, 1, 10), dt.datetime(2026, 3, 1, 11)


def _trip(i, ts, zone, vtype, status, fare):
    return (f"t{i}", ts, ts, ts, zone, "z1", "d1", "v1", vtype, 3.0, fare, 4.0, 9.0, status, None, "Card",
            1.0, 0.0, 4.0)


def tiny_catalog(spark):
    cat = Catalog(spark, SF_SMALL)
    cat.register("zones", spark.createDataFrame([("z1", "Zone One", "North")], "zone_id string, zone_name string, city string"))
    cat.register("demand_supply", spark.createDataFrame(
        [(H10, "z1", 10, 5, 8, 1, 5.0), (H11, "z1", 4, 0, 4, 0, 3.0), (H10, "z2", 0, 0, 0, 0, 1.0)],
        "timestamp timestamp_ntz, zone_id string, ride_requests int, available_vehicles int, completed_trips int, "
        "cancelled_trips int, avg_wait_time_min double"))
    cat.register("traffic", spark.createDataFrame([(H10, "z1", "Low", 50.0, 7.5)],
                                                  "timestamp timestamp_ntz, zone_id string, congestion_level string, "
                                                  "avg_speed_kmph double, traffic_index double"))
    cat.register("weather", spark.createDataFrame([(H10, 20.0, 0.4, 50.0, 9.0, "Rain")],
                                                  "timestamp timestamp_ntz, temperature_c double, rainfall_mm double, "
                                                  "humidity_pct double, visibility_km double, weather_condition string"))
    cat.register("trips_timed", spark.createDataFrame(
        [_trip(1, H10, "z1", "Sedan", "Completed", 100.0), _trip(2, H10, "z1", "Sedan", "Completed", 100.0),
         _trip(3, H10, "z1", "Auto", "Cancelled", 50.0)], SCHEMA))
    return cat


def test_opportunity_scores_by_hand(spark):
    rows = {(r["zone_id"], r["hour"]): r for r in PR.opportunity_scores(tiny_catalog(spark)).collect()}
    assert len(rows) == 3
    a, b, c = rows[("z1", 10)], rows[("z1", 11)], rows[("z2", 10)]
    assert (a["demand_pressure_score"], b["demand_pressure_score"], c["demand_pressure_score"]) == (100.0, None, None)
    assert (a["cancellation_pressure_score"], b["cancellation_pressure_score"]) == (100.0, 50.0)
    assert abs(c["wait_pressure_score"] - 100 / 3) < 1e-12 and a["wait_pressure_score"] == 100.0
    # completed revenue 200, 0, 0: the two empty zone-hours share one tie (G-10)
    assert (a["revenue_opportunity_score"], b["revenue_opportunity_score"], c["revenue_opportunity_score"]) == \
        (100.0, 50.0, 50.0)
    assert a["completed_revenue"] == 200.0 and a["traffic_index"] == 7.5 and a["weather_condition"] == "Rain"
    # (30 + 20 + 20 + 20 - 10) / 0.8 = 100 -> Critical; a null composite is Critical too (G-8)
    assert a["mobility_opportunity_score"] == 100.0 and a["priority_band"] == "Critical"
    assert b["mobility_opportunity_score"] is None and b["priority_band"] == "Critical"
    assert a["recommended_vehicle_type"] == "Sedan"
    assert b["recommended_vehicle_type"] == "Review demand mix" and c["city"] is None


def test_recommendations_by_hand(spark):
    recs = {(r["hour"], r["recommended_vehicle_type"]): r for r in PR.fleet_recommendations(tiny_catalog(spark)).collect()}
    assert set(recs) == {(10, "Sedan"), (11, "Review demand mix")}      # the zone absent from zones is dropped
    hi, lo = recs[(10, "Sedan")], recs[(11, "Review demand mix")]
    assert hi["avg_opportunity_score"] == 100.0 and hi["critical_hours"] == 1
    assert hi["recommended_action"].startswith("Prioritize")
    assert lo["avg_opportunity_score"] is None and lo["critical_hours"] == 1
    assert lo["recommended_action"].startswith("Monitor")
