"""Role views: the mobility tables expressed over the driver's parquet tables.

Each role is one SQL text shared by Spark (``spark.sql`` with DataFrame
arguments) and the DuckDB oracle (as a CTE).  Table references are written as
``{name}``; the two dialect differences (a day difference and the
timestamp-without-zone cast) and the copy generator go through :class:`Dialect`.

Fixed values (labels the reference's logic depends on):
  status: Completed, Cancelled
  payment variant: 'upi' canonicalised to 'UPI'
  congestion levels in order: Low, Medium, High, Severe
  weather conditions by hour of day modulo 4: Clear, Rain, Fog, Cloudy
  (visibility follows hour modulo 5, so it is not a function of the condition)
"""

from __future__ import annotations

from dataclasses import dataclass

from zonecast.functions.sqltext import rnd


@dataclass(frozen=True)
class Dialect:
    name: str

    def ntz(self, expr: str) -> str:
        """Timestamp without time zone; Spark's date_trunc returns a zoned timestamp."""
        return f"CAST({expr} AS TIMESTAMP_NTZ)" if self.name == "spark" else f"CAST({expr} AS TIMESTAMP)"

    def days(self, end: str, start: str) -> str:
        if self.name == "spark":
            return f"datediff({end}, {start})"
        return f"date_diff('day', {start}, {end})"

    def orders_of_customers(self) -> str:
        """Orders (o) and their customers (c), ready to join with l; Spark joins the two narrow tables first, before the wide l is dealt out."""
        if self.name == "spark":
            return """({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) ON l.l_orderkey = o.o_orderkey"""
        return """{orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey"""

    def copies(self, twice: str) -> str:
        """One output row per copy: 1, or 1 and 2 when ``twice`` holds (a generator)."""
        if self.name == "spark":
            return f"explode(CASE WHEN {twice} THEN array(1, 2) ELSE array(1) END)"
        return f"unnest(CASE WHEN {twice} THEN [1, 2] ELSE [1] END)"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


def _r6(expr: str) -> str:
    # Averages feed rankings; six decimals make both engines agree on ties.
    return rnd(expr, 6)


def _hour(d: Dialect, col: str) -> str:
    return d.ntz(f"date_trunc('hour', {col})")


# name -> (dependencies, sql builder)
def _zones(d: Dialect) -> str:
    return """
SELECT CAST(n.n_nationkey AS STRING) AS zone_id,
       n.n_name AS zone_name,
       r.r_name AS city,
       CASE n.n_nationkey % 3 WHEN 0 THEN 'Commercial' WHEN 1 THEN 'Residential' ELSE 'Mixed' END AS zone_type,
       CAST(n.n_nationkey % 10 + 1 AS INTEGER) AS population_density_score,
       CAST((n.n_nationkey * 3) % 10 + 1 AS INTEGER) AS commercial_density_score,
       CAST((n.n_nationkey * 7) % 10 + 1 AS INTEGER) AS residential_density_score,
       CASE WHEN n.n_nationkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS metro_access,
       CASE WHEN n.n_nationkey % 5 = 0 THEN 'Near' ELSE 'Far' END AS airport_proximity
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""


def _vehicles(d: Dialect) -> str:
    return """
SELECT CAST(p_partkey AS STRING) AS vehicle_id,
       p_type AS vehicle_type,
       CASE WHEN p_size % 2 = 0 THEN 'EV' ELSE 'CNG' END AS fuel_type,
       CAST(p_size % 4 + 1 AS INTEGER) AS capacity,
       CAST(p_size AS DOUBLE) / 10 AS vehicle_age_years,
       CAST(p_size % 30 AS STRING) AS home_zone_id,
       CASE WHEN p_size % 5 = 0 THEN 'Inactive' ELSE 'Active' END AS status,
       DATE '2015-01-01' + CAST(p_partkey % 2000 AS INTEGER) AS join_date
FROM {part}
"""


def _drivers(d: Dialect) -> str:
    return """
SELECT CAST(s_suppkey AS STRING) AS driver_id,
       CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE CAST(s_suppkey * 3 AS STRING) END AS vehicle_id,
       CAST(s_nationkey AS STRING) AS home_zone_id,
       CAST(s_suppkey % 15 AS DOUBLE) AS experience_years,
       CAST(s_suppkey % 5 AS DOUBLE) + 0.5 AS driver_rating,
       CASE WHEN s_acctbal < 0 THEN 'Suspended' ELSE 'Active' END AS driver_status,
       DATE '2016-01-01' + CAST(s_suppkey % 1500 AS INTEGER) AS join_date
FROM {supplier}
"""


def _trip_base(d: Dialect) -> str:
    return f"""
SELECT concat_ws('-', CAST(l.l_orderkey AS STRING), CAST(l.l_linenumber AS STRING),
                 CAST(l.l_partkey AS STRING), CAST(l.l_suppkey AS STRING)) AS trip_id,
       o.o_orderdate AS request_timestamp,
       CASE WHEN l.l_linenumber = 7 THEN l.l_shipdate ELSE o.o_orderdate END AS pickup_timestamp,
       l.l_shipdate AS dropoff_timestamp,
       CAST(c.c_nationkey AS STRING) AS pickup_zone_id,
       CAST(s.s_nationkey AS STRING) AS drop_zone_id,
       CASE WHEN l.l_suppkey % 17 = 0 THEN NULL ELSE CAST(l.l_suppkey AS STRING) END AS driver_id,
       CAST(l.l_partkey AS STRING) AS vehicle_id,
       p.p_type AS vehicle_type,
       l.l_quantity - 2 AS distance_km,
       l.l_extendedprice AS fare,
       l.l_quantity AS wait_time_min,
       CAST({d.days('l.l_shipdate', 'o.o_orderdate')} AS DOUBLE) AS trip_duration_min,
       CASE WHEN l.l_returnflag = 'A' THEN 'Cancelled' ELSE 'Completed' END AS status,
       CASE WHEN l.l_returnflag = 'A' THEN l.l_linestatus END AS cancellation_reason,
       CASE l.l_linenumber WHEN 1 THEN 'upi' WHEN 2 THEN 'UPI' WHEN 3 THEN 'Cash' ELSE 'Card' END AS payment_method,
       CAST(1 AS DOUBLE) + l.l_tax AS surge_multiplier,
       CASE WHEN l.l_discount = 0 THEN NULL ELSE l.l_discount END AS discount,
       CASE WHEN l.l_tax = 0 THEN NULL ELSE 5 - l.l_tax * 10 END AS rating,
       l.l_orderkey % 50 = 0 AS copied_twice
FROM {{lineitem}} l
JOIN {d.orders_of_customers()}
JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey
JOIN {{part}} p ON l.l_partkey = p.p_partkey
"""


TRIP_COLUMNS = [
    "trip_id", "request_timestamp", "pickup_timestamp", "dropoff_timestamp",
    "pickup_zone_id", "drop_zone_id", "driver_id", "vehicle_id", "vehicle_type",
    "distance_km", "fare", "wait_time_min", "trip_duration_min", "status",
    "cancellation_reason", "payment_method", "surge_multiplier", "discount", "rating",
]
_TC = ", ".join(TRIP_COLUMNS)


def _trips_messy(d: Dialect) -> str:
    # Every trip once, plus a second exact copy of the trips of every 50th
    # order: a generator over one scan, not a second pass over the fact.
    return f"""
SELECT {_TC} FROM (SELECT *, {d.copies('copied_twice')} AS copy_no FROM {{trip_base}}) c
"""


def _trips(d: Dialect) -> str:
    return f"SELECT {_TC}, driver_id IS NOT NULL AS is_driver_linked FROM {{trip_base}}"


def _trips_timed(d: Dialect) -> str:
    return f"""
SELECT CAST(event_id AS STRING) AS trip_id,
       {_hour(d, 'ts')} AS request_timestamp,
       ts AS pickup_timestamp,
       ts AS dropoff_timestamp,
       CAST(user_id % 25 AS STRING) AS pickup_zone_id,
       CAST((user_id * 7 + event_id) % 25 AS STRING) AS drop_zone_id,
       CASE WHEN user_id % 13 = 0 THEN NULL ELSE CAST(user_id AS STRING) END AS driver_id,
       CAST(event_id % 997 AS STRING) AS vehicle_id,
       CASE event_id % 4 WHEN 0 THEN 'Auto' WHEN 1 THEN 'Bike' WHEN 2 THEN 'Cab' ELSE 'Sedan' END AS vehicle_type,
       1 + value % 10 AS distance_km,
       value AS fare,
       value % 30 AS wait_time_min,
       value % 45 AS trip_duration_min,
       CASE WHEN event_type = 'error' THEN 'Cancelled' ELSE 'Completed' END AS status,
       CASE WHEN event_type = 'error' THEN 'Rider cancelled' END AS cancellation_reason,
       CASE user_id % 4 WHEN 0 THEN 'upi' WHEN 1 THEN 'UPI' WHEN 2 THEN 'Cash' ELSE 'Card' END AS payment_method,
       CAST(1 AS DOUBLE) + (user_id % 5) / 10 AS surge_multiplier,
       CASE WHEN event_type = 'signup' THEN NULL ELSE value % 5 END AS discount,
       CASE WHEN event_type = 'view' THEN NULL ELSE CAST(user_id % 5 + 1 AS DOUBLE) END AS rating
FROM {{events}}
"""


def _demand_supply(d: Dialect) -> str:
    return f"""
SELECT {_hour(d, 'ts')} AS timestamp,
       CAST(user_id % 25 AS STRING) AS zone_id,
       CAST(count(*) AS INTEGER) AS ride_requests,
       CAST(count(CASE WHEN event_type IN ('view', 'click') THEN 1 END) AS INTEGER) AS available_vehicles,
       CAST(count(CASE WHEN event_type = 'purchase' THEN 1 END) AS INTEGER) AS completed_trips,
       CAST(count(CASE WHEN event_type = 'error' THEN 1 END) AS INTEGER) AS cancelled_trips,
       {_r6('avg(value % 30)')} AS avg_wait_time_min
FROM {{events}}
GROUP BY {_hour(d, 'ts')}, CAST(user_id % 25 AS STRING)
"""


def _traffic(d: Dialect) -> str:
    return f"""
SELECT timestamp, zone_id,
       CASE WHEN traffic_index < 10 THEN 'Low' WHEN traffic_index < 20 THEN 'Medium'
            WHEN traffic_index < 40 THEN 'High' ELSE 'Severe' END AS congestion_level,
       60 - least(traffic_index, CAST(60 AS DOUBLE)) AS avg_speed_kmph,
       traffic_index
FROM (
  SELECT {_hour(d, 'ts')} AS timestamp,
         CAST(user_id % 25 AS STRING) AS zone_id,
         {_r6('avg(value)')} AS traffic_index
  FROM {{events}}
  WHERE event_type = 'click'
  GROUP BY {_hour(d, 'ts')}, CAST(user_id % 25 AS STRING)
) t
"""


def _weather(d: Dialect) -> str:
    return f"""
SELECT timestamp,
       CAST(15 + h AS DOUBLE) AS temperature_c,
       rainfall_mm,
       CAST(40 + 2 * h AS DOUBLE) AS humidity_pct,
       CAST(10 - 2 * (h % 5) AS DOUBLE) AS visibility_km,
       CASE h % 4 WHEN 0 THEN 'Clear' WHEN 1 THEN 'Rain' WHEN 2 THEN 'Fog' ELSE 'Cloudy' END AS weather_condition
FROM (
  SELECT {_hour(d, 'ts')} AS timestamp,
         CAST(hour(ts) AS INTEGER) AS h,
         {_r6('avg(value)')} AS rainfall_mm
  FROM {{events}}
  GROUP BY {_hour(d, 'ts')}, CAST(hour(ts) AS INTEGER)
) w
"""


def _city_events(d: Dialect) -> str:
    return """
SELECT CAST(event_id AS STRING) AS event_id,
       CAST(ts AS DATE) AS event_date,
       CAST(user_id % 30 AS STRING) AS zone_id,
       event_type,
       CASE WHEN value > 100 THEN 'High' WHEN value > 20 THEN 'Medium' ELSE 'Low' END AS expected_impact
FROM {events}
"""


ROLES: dict[str, tuple[tuple[str, ...], object]] = {
    "zones": (("nation", "region"), _zones),
    "vehicles": (("part",), _vehicles),
    "drivers": (("supplier",), _drivers),
    "trip_base": (("lineitem", "orders", "customer", "supplier", "part"), _trip_base),
    "trips_messy": (("trip_base",), _trips_messy),
    "trips": (("trip_base",), _trips),
    "trips_timed": (("events",), _trips_timed),
    "demand_supply": (("events",), _demand_supply),
    "traffic": (("events",), _traffic),
    "weather": (("events",), _weather),
    "city_events": (("events",), _city_events),
}

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
)


def role_sql(name: str, dialect: Dialect) -> str:
    return ROLES[name][1](dialect)


def role_deps(name: str) -> tuple[str, ...]:
    return ROLES[name][0]


def closure(names) -> list[str]:
    """Roles needed for ``names``, dependencies first."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in out:
            return
        for dep in role_deps(n):
            visit(dep)
        out.append(n)

    for n in names:
        visit(n)
    return out


def duck_ctes(names) -> str:
    """``WITH`` clause defining the given roles (and their dependencies) for DuckDB."""
    parts = []
    for n in closure(names):
        body = role_sql(n, DUCK).format(**{t: t for t in role_deps(n)})
        parts.append(f"{n} AS ({body.strip()})")
    return "WITH " + ",\n".join(parts) if parts else ""
