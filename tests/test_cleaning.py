"""Cleaning and its audit on the messy-trip edge rows of FIXTURES.md §2."""

import datetime as dt


from zonecast.operators import cleaning
from zonecast.sources.roles import TRIP_COLUMNS

T0 = dt.datetime(2026, 1, 1, 8)


def _trip(i, distance=5.0, fare=100.0, payment="Card", discount=0.1, driver="d1", rating=4.0,
          reason=None, status="Completed"):
    return (f"t{i}", T0, T0, T0, "z1", "z2", driver, "v1", "Sedan", distance, fare, 10.0, 20.0,
            status, reason, payment, 1.0, discount, rating)


SCHEMA = ("trip_id string, request_timestamp timestamp_ntz, pickup_timestamp timestamp_ntz, "
          "dropoff_timestamp timestamp_ntz, pickup_zone_id string, drop_zone_id string, driver_id string, "
          "vehicle_id string, vehicle_type string, distance_km double, fare double, wait_time_min double, "
          "trip_duration_min double, status string, cancellation_reason string, payment_method string, "
          "surge_multiplier double, discount double, rating double")


def messy(spark):
    rows = [_trip(1)] * 2 + [_trip(2)] * 3 + [
        _trip(3, distance=0.0), _trip(4, distance=-1.0), _trip(5, distance=None),
        _trip(6, fare=0.0), _trip(7, fare=None),
        _trip(8, payment="upi"), _trip(9, payment="UPI"), _trip(10, payment="Upi"),
        _trip(11, discount=None), _trip(12, driver=None), _trip(13, rating=None),
        _trip(14, status=None), _trip(15, status="Cancelled", reason="Driver"),
        _trip(16, payment="upi", distance=0.0),  # counted by rule 2 only
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_clean_keep_null_policy(spark):
    out = cleaning.clean_trips(messy(spark))
    ids = sorted(r["trip_id"] for r in out.collect())
    # 16 distinct ids; 3, 4, 6, 16 removed; nulls 5 and 7 survive (pandas mask)
    assert ids == sorted(f"t{i}" for i in [1, 2, 5, 7, 8, 9, 10, 11, 12, 13, 14, 15])
    rows = {r["trip_id"]: r for r in out.collect()}
    assert rows["t8"]["payment_method"] == "UPI" and rows["t10"]["payment_method"] == "Upi"
    assert rows["t11"]["discount"] == 0.0
    assert rows["t12"]["is_driver_linked"] is False and rows["t1"]["is_driver_linked"] is True
    assert out.columns == TRIP_COLUMNS + ["is_driver_linked"]


def test_clean_drop_null_policy(spark):
    out = cleaning.clean_trips(messy(spark), null_policy="drop")
    ids = {r["trip_id"] for r in out.collect()}
    assert "t5" not in ids and "t7" not in ids and len(ids) == 10


def test_audit_is_sequential_and_monotone(spark):
    df = messy(spark)
    audit = cleaning.cleaning_audit(df).orderBy("step_no").collect()
    assert [r["affected_records"] for r in audit] == [3, 4, 1, 1, 1]
    remaining = [r["rows_remaining"] for r in audit]
    assert remaining == sorted(remaining, reverse=True)
    assert remaining[-1] == cleaning.clean_trips(df).count()
    s = cleaning.cleaning_summary(df).first().asDict()
    assert s["source_rows"] == 19 and s["cleaned_rows"] == 12 and s["duplicate_rows_removed"] == 3
    assert s["unrated_trips_retained"] == 1
    assert s["null_cancellation_reasons_retained"] == 11


def test_unknown_policy_fails(spark):
    import pytest
    with pytest.raises(ValueError):
        cleaning.clean_trips(messy(spark), null_policy="maybe")


def test_keep_filter_reaches_parquet(spark, capsys):
    from zonecast.session import scratch_path
    path = scratch_path(spark, "trips-parquet")
    messy(spark).write.parquet(path)
    out = cleaning.clean_trips(spark.read.parquet(path))
    capsys.readouterr()
    out.explain()
    plan = capsys.readouterr().out
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line][0]
    assert "GreaterThan(distance_km,0.0)" in pushed and "IsNull(distance_km)" in pushed
    assert out.count() == 12


def test_distinct_with_multiplicity_feeds_all_three_outputs(spark):
    df = messy(spark)
    d = cleaning.distinct_with_multiplicity(df)
    key = lambda x: sorted(tuple(r) for r in x.collect())
    assert key(cleaning.clean_distinct(d)) == key(cleaning.clean_trips(df))
    assert key(cleaning.cleaning_audit(d)) == key(cleaning.cleaning_audit(df))
    assert key(cleaning.cleaning_summary(d)) == key(cleaning.cleaning_summary(df))
