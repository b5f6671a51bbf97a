"""Declared schemas of the eight role tables (S-2, S-6), as DDL text."""

from __future__ import annotations

from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructType, TimestampNTZType

_TYPES = {"string": StringType(), "int": IntegerType(), "double": DoubleType(), "date": DateType(),
          "timestamp_ntz": TimestampNTZType()}

_DDL = {
    "zones": "zone_id string, zone_name string, city string, zone_type string, population_density_score int, "
             "commercial_density_score int, residential_density_score int, metro_access string, airport_proximity string",
    "vehicles": "vehicle_id string, vehicle_type string, fuel_type string, capacity int, vehicle_age_years double, "
                "home_zone_id string, status string, join_date date",
    "drivers": "driver_id string, vehicle_id string, home_zone_id string, experience_years double, driver_rating double, "
               "driver_status string, join_date date",
    "trips_messy": "trip_id string, request_timestamp timestamp_ntz, pickup_timestamp timestamp_ntz, "
                   "dropoff_timestamp timestamp_ntz, pickup_zone_id string, drop_zone_id string, driver_id string, "
                   "vehicle_id string, vehicle_type string, distance_km double, fare double, wait_time_min double, "
                   "trip_duration_min double, status string, cancellation_reason string, payment_method string, "
                   "surge_multiplier double, discount double, rating double",
    "demand_supply": "timestamp timestamp_ntz, zone_id string, ride_requests int, available_vehicles int, "
                     "completed_trips int, cancelled_trips int, avg_wait_time_min double",
    "traffic": "timestamp timestamp_ntz, zone_id string, congestion_level string, avg_speed_kmph double, traffic_index double",
    "weather": "timestamp timestamp_ntz, temperature_c double, rainfall_mm double, humidity_pct double, "
               "visibility_km double, weather_condition string",
    "city_events": "event_id string, event_date date, zone_id string, event_type string, expected_impact string",
}


def _struct(ddl: str) -> StructType:
    out = StructType()
    for field in ddl.split(", "):
        name, kind = field.split(" ")
        out.add(name, _TYPES[kind])
    return out


ROLE_SCHEMAS: dict[str, StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}
