"""Named SQL queries (S-11, D-20..D-23): a registry of name -> SQL text run
with ``spark.sql`` over DataFrame arguments, optionally exported as CSV.

Query names and output columns are fixed values of the contract.  The plans
aggregate before they join: trips are first reduced to exact partial sums per
zone, zone pair or (zone, hour), and only those meet the zones or the traffic
readings.  Every result carries a ``rank`` with a total order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonecast.functions.sqltext import rnd, units


def _partial(table: str, keys: str, *measures: str) -> str:
    """Exact partial sums of trips per key: rows, cancelled ones, completed revenue, and sum and count per measure."""
    sums = "".join(f", sum({units(m)}) AS {m}_sum, count({units(m)}) AS {m}_n" for m in measures)
    paid = units("CASE WHEN status = 'Completed' THEN fare ELSE 0e0 END")
    return (f"SELECT {keys}, count(*) AS n, count_if(status = 'Cancelled') AS gone, sum({paid}) AS paid{sums} "
            f"FROM {{{table}}} GROUP BY {keys}")


def _mean(measure: str) -> str:
    return rnd(f"CAST(sum({measure}_sum) AS DOUBLE) / CAST(sum({measure}_n) AS DOUBLE) / 1e6", 2)


_GONE_PCT = rnd("100e0 * CAST(sum(gone) AS DOUBLE) / sum(n)", 2)
_PAID = rnd("CAST(sum(paid) AS DOUBLE) / 1e6", 2)


def _ranked(body: str, order: str) -> str:
    # the rows that get a rank are groups of zones, cities or classes, never trips
    return f"SELECT g.*, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank FROM ({body}) g"


_PRESSURE_ORDER = "demand_supply_ratio DESC NULLS LAST, cancelled_trips DESC, city, zone_name, timestamp"

NAMED_QUERIES: dict[str, str] = {
    "zone_hourly_fleet_pressure": _ranked(f"""
        WITH places AS (SELECT zone_id AS place_id, city, zone_name FROM {{zones}}),
             panel AS (SELECT zone_id AS place_id, timestamp, ride_requests, available_vehicles, cancelled_trips,
                              avg_wait_time_min,
                              {rnd("CAST(ride_requests AS DOUBLE) / NULLIF(available_vehicles, 0)", 2)} AS demand_supply_ratio
                       FROM {{demand_supply}})
        SELECT city, zone_name, timestamp, ride_requests, available_vehicles, demand_supply_ratio, cancelled_trips,
               avg_wait_time_min
        FROM panel INNER JOIN places USING (place_id)
        ORDER BY {_PRESSURE_ORDER} LIMIT 100""", _PRESSURE_ORDER),
    "zone_experience_hotspots": _ranked(f"""
        WITH by_zone AS ({_partial("trips", "pickup_zone_id", "wait_time_min")})
        SELECT city, zone_name, sum(n) AS trips, {_GONE_PCT} AS cancellation_rate_pct,
               {_mean("wait_time_min")} AS avg_wait_time_min, {_PAID} AS completed_revenue
        FROM by_zone INNER JOIN {{zones}} ON zone_id = pickup_zone_id
        GROUP BY city, zone_name""",
        "cancellation_rate_pct DESC, avg_wait_time_min DESC NULLS LAST, trips DESC, city, zone_name"),
    "vehicle_revenue_performance": _ranked(f"""
        WITH by_vehicle AS ({_partial("trips", "vehicle_type", "fare")})
        SELECT vehicle_type, sum(n) AS trips, {_PAID} AS completed_revenue, {_mean("fare")} AS avg_fare,
               {_GONE_PCT} AS cancellation_rate_pct
        FROM by_vehicle GROUP BY vehicle_type""",
        "completed_revenue DESC, vehicle_type"),
    "cross_city_corridors": _ranked(f"""
        WITH by_pair AS ({_partial("trips", "pickup_zone_id, drop_zone_id", "wait_time_min")}),
             towns AS (SELECT zone_id, city FROM {{zones}}),
             legs AS (SELECT here.city AS here, there.city AS there, by_pair.* FROM by_pair
                      INNER JOIN towns here ON here.zone_id = pickup_zone_id
                      INNER JOIN towns there ON there.zone_id = drop_zone_id)
        SELECT concat(here, ' → ', there) AS corridor, sum(n) AS trips, {_mean("wait_time_min")} AS avg_wait_time_min,
               {_PAID} AS completed_revenue
        FROM legs WHERE here <> there GROUP BY here, there""",
        "trips DESC, corridor"),
    "traffic_customer_experience": _ranked(f"""
        WITH by_hour AS ({_partial("timed_trips", "pickup_zone_id, request_timestamp", "trip_duration_min", "wait_time_min")})
        SELECT congestion_level, sum(n) AS trips, {_mean("trip_duration_min")} AS avg_trip_duration_min,
               {_mean("wait_time_min")} AS avg_wait_time_min, {_GONE_PCT} AS cancellation_rate_pct
        FROM by_hour INNER JOIN {{traffic}} ON zone_id = pickup_zone_id AND timestamp = request_timestamp
        GROUP BY congestion_level""",
        "avg_trip_duration_min DESC NULLS LAST, congestion_level"),
}


def query_tables(name: str) -> list[str]:
    text = NAMED_QUERIES[name]
    return [t for t in ("demand_supply", "zones", "trips", "timed_trips", "traffic") if "{" + t + "}" in text]


def run_named(spark: SparkSession, name: str, frames: dict[str, DataFrame]) -> DataFrame:
    """Run one named query with its tables passed as DataFrames (no global views)."""
    return spark.sql(NAMED_QUERIES[name], **{t: frames[t] for t in query_tables(name)})


def run_all(spark: SparkSession, frames: dict[str, DataFrame], out_dir: str | None = None) -> dict[str, DataFrame]:
    """Run every named query; with ``out_dir`` also export each as CSV (S-7)."""
    results = {}
    for name in NAMED_QUERIES:
        df = run_named(spark, name, frames)
        if out_dir:
            df.write.mode("overwrite").option("header", True).csv(f"{out_dir.rstrip('/')}/{name}")
        results[name] = df
    return results
