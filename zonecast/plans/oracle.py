"""DuckDB oracle texts: the role views as CTEs plus hand-written SQL per entry.

The SQL is written independently of the DataFrame code it checks; only the
role views (the inputs) share text.
"""

from __future__ import annotations

from zonecast.functions.sqltext import favg, fsum, ratio
from zonecast.functions.sqltext import rnd as r
from zonecast.sources import roles as R
from zonecast.sources.roles import TRIP_COLUMNS


def r4(expr: str) -> str:
    return r(expr, 4)


def _clean(src: str) -> str:
    cols = []
    for c in TRIP_COLUMNS:
        if c == "payment_method":
            cols.append("CASE WHEN payment_method = 'upi' THEN 'UPI' ELSE payment_method END AS payment_method")
        elif c == "discount":
            cols.append("coalesce(discount, CAST(0 AS DOUBLE)) AS discount")
        else:
            cols.append(c)
    cols.append("driver_id IS NOT NULL AS is_driver_linked")
    return (f"SELECT {', '.join(cols)} FROM (SELECT DISTINCT * FROM {src}) s "
            "WHERE NOT (coalesce(distance_km <= 0, false) OR coalesce(fare <= 0, false))")


_CF = "CASE WHEN status = 'Completed' THEN fare ELSE CAST(0 AS DOUBLE) END"
_CANCEL = "CASE WHEN status = 'Cancelled' THEN 1 ELSE 0 END"

DERIVED: dict[str, tuple[tuple[str, ...], str]] = {
    "trips_clean": (("trips_messy",), _clean("trips_messy")),
    "timed_clean": (("trips_timed",), _clean("trips_timed")),
    "trip_cities": (("trips", "zones"), """
SELECT t.*, p.zone_name AS pickup_zone_name, p.city AS pickup_city, d.city AS drop_city,
       coalesce(p.city <> d.city, true) AS is_cross_city
FROM trips t LEFT JOIN zones p ON t.pickup_zone_id = p.zone_id
LEFT JOIN zones d ON t.drop_zone_id = d.zone_id"""),
    "clean_cities": (("trips_clean", "zones"), """
SELECT t.*, p.zone_name AS pickup_zone_name, p.city AS pickup_city, d.city AS drop_city,
       coalesce(p.city <> d.city, true) AS is_cross_city
FROM trips_clean t LEFT JOIN zones p ON t.pickup_zone_id = p.zone_id
LEFT JOIN zones d ON t.drop_zone_id = d.zone_id"""),
    "analysis": (("timed_clean", "traffic", "weather"), """
SELECT t.trip_id, t.request_timestamp, t.pickup_zone_id, t.wait_time_min, t.status,
       CASE WHEN t.status = 'Cancelled' THEN 1 ELSE 0 END AS cancelled,
       tr.congestion_level, tr.avg_speed_kmph, tr.traffic_index,
       w.rainfall_mm, w.visibility_km, w.weather_condition
FROM timed_clean t
LEFT JOIN traffic tr ON tr.zone_id = t.pickup_zone_id AND tr.timestamp = t.request_timestamp
LEFT JOIN weather w ON w.timestamp = t.request_timestamp
WHERE tr.traffic_index IS NOT NULL AND w.rainfall_mm IS NOT NULL AND w.visibility_km IS NOT NULL
  AND w.weather_condition IS NOT NULL AND t.wait_time_min IS NOT NULL"""),
    "metrics_hour": (("timed_clean",), f"""
SELECT pickup_zone_id AS zone_id, CAST(date_trunc('hour', request_timestamp) AS TIMESTAMP) AS timestamp,
       count(*) AS observed_trips, coalesce({fsum(_CF)}, CAST(0 AS DOUBLE)) AS completed_revenue
FROM timed_clean WHERE pickup_zone_id IS NOT NULL AND request_timestamp IS NOT NULL
GROUP BY 1, 2"""),
    "metrics_exact": (("timed_clean",), f"""
SELECT pickup_zone_id AS zone_id, request_timestamp AS timestamp,
       count(*) AS observed_trips, coalesce({fsum(_CF)}, CAST(0 AS DOUBLE)) AS completed_revenue
FROM timed_clean WHERE pickup_zone_id IS NOT NULL AND request_timestamp IS NOT NULL
GROUP BY 1, 2"""),
    "mix": (("timed_clean",), """
SELECT zone_id, hour, vehicle_type AS recommended_vehicle_type, n AS vehicle_type_trips
FROM (SELECT *, row_number() OVER (PARTITION BY zone_id, hour ORDER BY n DESC, vehicle_type) AS rn
      FROM (SELECT pickup_zone_id AS zone_id, CAST(hour(request_timestamp) AS INTEGER) AS hour, vehicle_type,
                   count(*) AS n
            FROM timed_clean
            WHERE pickup_zone_id IS NOT NULL AND request_timestamp IS NOT NULL AND vehicle_type IS NOT NULL
            GROUP BY 1, 2, 3) c) x
WHERE rn = 1"""),
    "star": (("demand_supply", "zones", "traffic", "weather", "metrics_exact", "mix"), """
SELECT d.timestamp, d.zone_id, d.ride_requests, d.available_vehicles, d.completed_trips, d.cancelled_trips,
       d.avg_wait_time_min, z.zone_name, z.city, tr.traffic_index, w.rainfall_mm, w.weather_condition,
       m.observed_trips, m.completed_revenue, CAST(hour(d.timestamp) AS INTEGER) AS hour,
       x.recommended_vehicle_type
FROM demand_supply d
LEFT JOIN zones z ON z.zone_id = d.zone_id
LEFT JOIN traffic tr ON tr.timestamp = d.timestamp AND tr.zone_id = d.zone_id
LEFT JOIN weather w ON w.timestamp = d.timestamp
LEFT JOIN metrics_exact m ON m.timestamp = d.timestamp AND m.zone_id = d.zone_id
LEFT JOIN mix x ON x.zone_id = d.zone_id AND x.hour = CAST(hour(d.timestamp) AS INTEGER)"""),
}


def _pct(col: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN NULL ELSE "
            f"(CAST(rank() OVER (ORDER BY {col}) - 1 AS DOUBLE) "
            f"+ CAST(count(*) OVER (PARTITION BY {col}) + 1 AS DOUBLE) / CAST(2 AS DOUBLE)) "
            f"/ CAST(count({col}) OVER () AS DOUBLE) * CAST(100 AS DOUBLE) END")


_COMPOSITE_RAW = ("(CAST(0.3 AS DOUBLE) * demand_pressure_score + CAST(0.2 AS DOUBLE) * cancellation_pressure_score"
                  " + CAST(0.2 AS DOUBLE) * wait_pressure_score + CAST(0.2 AS DOUBLE) * revenue_opportunity_score"
                  " + CAST(-0.1 AS DOUBLE) * fleet_adequacy_score) / CAST(0.8 AS DOUBLE)")

DERIVED["scores"] = (("star",), f"""
SELECT *,
       CASE WHEN mobility_opportunity_score <= 25 THEN 'Stable' WHEN mobility_opportunity_score <= 50 THEN 'Monitor'
            WHEN mobility_opportunity_score <= 75 THEN 'Intervention' ELSE 'Critical' END AS priority_band
FROM (
  SELECT *,
         CASE WHEN _raw IS NULL THEN NULL
              ELSE {r('least(greatest(_raw, CAST(0 AS DOUBLE)), CAST(100 AS DOUBLE))', 1)} END
           AS mobility_opportunity_score
  FROM (
    SELECT *, {_COMPOSITE_RAW} AS _raw
    FROM (
      SELECT *,
             {_pct('demand_supply_ratio')} AS demand_pressure_score,
             {_pct('cancellation_rate')} AS cancellation_pressure_score,
             {_pct('avg_wait_time_min')} AS wait_pressure_score,
             {_pct('completed_revenue')} AS revenue_opportunity_score,
             {_pct('supply_adequacy')} AS fleet_adequacy_score
      FROM (
        SELECT timestamp, zone_id, ride_requests, available_vehicles, cancelled_trips, avg_wait_time_min,
               zone_name, city, traffic_index, rainfall_mm, weather_condition, hour,
               coalesce(completed_revenue, CAST(0 AS DOUBLE)) AS completed_revenue,
               coalesce(recommended_vehicle_type, 'Review demand mix') AS recommended_vehicle_type,
               {ratio('ride_requests', 'available_vehicles')} AS demand_supply_ratio,
               {ratio('cancelled_trips', 'ride_requests')} AS cancellation_rate,
               {ratio('available_vehicles', 'ride_requests')} AS supply_adequacy
        FROM star) a) b) c) d""")

_REC_KEYS = "city, zone_id, zone_name, hour, recommended_vehicle_type"
DERIVED["recommendations_exact"] = (("scores",), f"""
SELECT {_REC_KEYS}, {favg('mobility_opportunity_score')} AS _score,
       {r4(favg('mobility_opportunity_score'))} AS avg_opportunity_score,
       count_if(priority_band = 'Critical') AS critical_hours,
       {r4(favg('demand_supply_ratio'))} AS avg_demand_supply_ratio,
       {r4(favg('avg_wait_time_min'))} AS avg_wait_time_min,
       {r4(favg('cancellation_rate'))} AS avg_cancellation_rate,
       {r4(favg('completed_revenue'))} AS avg_completed_revenue,
       CASE WHEN {favg('mobility_opportunity_score')} > 75
            THEN 'Prioritize additional fleet or reposition vehicles into this zone-hour.'
            ELSE 'Monitor demand and reposition fleet if pressure persists.' END AS recommended_action
FROM scores
WHERE city IS NOT NULL AND zone_id IS NOT NULL AND zone_name IS NOT NULL AND hour IS NOT NULL
  AND recommended_vehicle_type IS NOT NULL
GROUP BY {_REC_KEYS}""")
DERIVED["recommendations"] = (("recommendations_exact",), "SELECT * EXCLUDE (_score) FROM recommendations_exact")

_TRIP_MEASURES = f"""count(*) AS trips,
       {r4('avg(' + _CANCEL + ')')} AS cancellation_rate,
       {r4(favg('wait_time_min'))} AS avg_wait_min,
       {r4('coalesce(' + fsum(_CF) + ', CAST(0 AS DOUBLE))')} AS completed_revenue"""

DERIVED["eda_hourly"] = (("timed_clean",), f"""
SELECT CAST(hour(request_timestamp) AS INTEGER) AS hour, count(*) AS trips, {r4(favg('wait_time_min'))} AS avg_wait_min
FROM timed_clean WHERE request_timestamp IS NOT NULL GROUP BY 1""")
DERIVED["eda_city"] = (("clean_cities",), f"""
SELECT o.pickup_city, o.position, CAST(a.trips AS DOUBLE) AS trips, a.cancellation_rate, a.avg_wait_min,
       a.completed_revenue
FROM (VALUES ('ASIA', 1), ('EUROPE', 2), ('AMERICA', 3), ('OCEANIA', 4)) AS o(pickup_city, position)
LEFT JOIN (SELECT pickup_city, {_TRIP_MEASURES} FROM clean_cities WHERE pickup_city IS NOT NULL
           GROUP BY pickup_city) a ON a.pickup_city = o.pickup_city""")
DERIVED["eda_vehicle"] = (("trips_clean",), f"""
SELECT vehicle_type, count(*) AS trips,
       {r4('coalesce(' + fsum(_CF) + ', CAST(0 AS DOUBLE))')} AS completed_revenue,
       {r4(favg('fare'))} AS avg_fare
FROM trips_clean WHERE vehicle_type IS NOT NULL GROUP BY vehicle_type""")
DERIVED["eda_zone"] = (("clean_cities",), f"""
SELECT pickup_zone_id, pickup_zone_name, pickup_city, {_TRIP_MEASURES}
FROM clean_cities
WHERE pickup_zone_id IS NOT NULL AND pickup_zone_name IS NOT NULL AND pickup_city IS NOT NULL
GROUP BY pickup_zone_id, pickup_zone_name, pickup_city""")
DERIVED["eda_corridors"] = (("clean_cities",), f"""
SELECT pickup_city, drop_city, count(*) AS trips, {r4(favg('wait_time_min'))} AS avg_wait_min,
       {r4('coalesce(' + fsum(_CF) + ', CAST(0 AS DOUBLE))')} AS completed_revenue
FROM clean_cities
WHERE is_cross_city AND pickup_city IS NOT NULL AND drop_city IS NOT NULL
GROUP BY pickup_city, drop_city""")
DERIVED["by_congestion"] = (("analysis",), f"""
SELECT congestion_level, count(*) AS trips, {r('avg(cancelled)', 6)} AS cancellation_rate,
       {r4(favg('wait_time_min'))} AS avg_wait_time_min, {r4(favg('traffic_index'))} AS avg_traffic_index,
       CAST(CASE congestion_level WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3
                                  WHEN 'Severe' THEN 4 END AS INTEGER) AS position
FROM analysis GROUP BY congestion_level""")
DERIVED["by_weather"] = (("analysis",), f"""
SELECT weather_condition, count(*) AS trips, {r('avg(cancelled)', 6)} AS cancellation_rate,
       {r4(favg('wait_time_min'))} AS avg_wait_time_min, {r4(favg('rainfall_mm'))} AS avg_rainfall_mm
FROM analysis GROUP BY weather_condition""")
DERIVED["fleet_pressure"] = (("demand_supply", "zones", "traffic", "metrics_hour"), f"""
SELECT d.timestamp, d.zone_id, d.ride_requests, d.available_vehicles, d.completed_trips, d.cancelled_trips,
       d.avg_wait_time_min, z.zone_name, z.city, tr.traffic_index,
       coalesce(m.observed_trips, 0) AS observed_trips,
       {r4('coalesce(m.completed_revenue, CAST(0 AS DOUBLE))')} AS completed_revenue,
       {r(ratio('d.ride_requests', 'd.available_vehicles'), 2)} AS demand_supply_ratio
FROM demand_supply d
JOIN zones z ON z.zone_id = d.zone_id
LEFT JOIN traffic tr ON tr.timestamp = d.timestamp AND tr.zone_id = d.zone_id
LEFT JOIN metrics_hour m ON m.timestamp = d.timestamp AND m.zone_id = d.zone_id""")


# --- the logistic model, unrolled ---------------------------------------------------------
# Terms of the model: intercept, three measures, and the levels of weather after the first ('Clear').
LOGIT_TERMS = (("(Intercept)", "1e0"), ("traffic_index", "traffic_index"), ("rainfall_mm", "rainfall_mm"),
               ("visibility_km", "visibility_km"), *((f"factor(weather_condition){v}", f"CAST(weather_condition = '{v}' AS DOUBLE)")
                                                     for v in ("Cloudy", "Fog", "Rain")))
LOGIT_STEPS = 25  # as many as R takes at most


def _solve_ctes(step: int, k: int) -> list[str]:
    """Gauss-Jordan on one row that holds the matrix, the right side and an identity (for the inverse)."""
    cols = [*range(k), "g", *(f"e{j}" for j in range(k))]
    out, src = [], f"sums{step}"
    for p in range(k):
        new = []
        for i in range(k):
            for c in cols:
                a = f"m{i}_{c}"
                new.append(f"m{p}_{c} / m{p}_{p} AS {a}" if i == p else f"{a} - m{i}_{p} * m{p}_{c} / m{p}_{p} AS {a}")
        out.append(f"elim{step}_{p} AS MATERIALIZED (SELECT dev, {', '.join(new)} FROM {src})")
        src = f"elim{step}_{p}"
    return out


def logit_ctes(source: str) -> str:
    """CTEs of ``LOGIT_STEPS`` Newton steps from zero; ``path`` has a row per step with its coefficients, deviance and errors."""
    k = len(LOGIT_TERMS)
    xs = ", ".join(f"{x} AS x{i}" for i, (_, x) in enumerate(LOGIT_TERMS))
    ctes = [f"pat AS MATERIALIZED (SELECT {xs}, count(*) AS n, CAST(sum(cancelled) AS BIGINT) AS y FROM {source} GROUP BY ALL)",
            "b0 AS MATERIALIZED (SELECT " + ", ".join(f"0e0 AS b{i}" for i in range(k)) + ")"]
    path = []
    for step in range(LOGIT_STEPS + 1):
        eta = " + ".join(f"b{i} * x{i}" for i in range(k))
        ctes.append(f"mu{step} AS MATERIALIZED (SELECT pat.*, 1e0 / (1e0 + exp(-({eta}))) AS mu FROM pat, b{step})")
        sums = [f"sum(n * mu * (1 - mu) * x{i} * x{j}) AS m{i}_{j}" for i in range(k) for j in range(k)]
        sums += [f"sum((y - n * mu) * x{i}) AS m{i}_g" for i in range(k)]
        sums += [f"{int(i == j)}e0 AS m{i}_e{j}" for i in range(k) for j in range(k)]
        dev = "-2 * sum(CASE WHEN y > 0 THEN y * ln(mu) ELSE 0e0 END + CASE WHEN n > y THEN (n - y) * ln(1 - mu) ELSE 0e0 END)"
        ctes.append(f"sums{step} AS MATERIALIZED (SELECT {dev} AS dev, {', '.join(sums)} FROM mu{step})")
        ctes += _solve_ctes(step, k)
        last = f"elim{step}_{k - 1}"
        ctes.append(f"b{step + 1} AS MATERIALIZED (SELECT " + ", ".join(f"b{i} + m{i}_g AS b{i}" for i in range(k)) + f" FROM b{step}, {last})")
        path.append(f"SELECT {step} AS step, dev, " + ", ".join(f"b{i}, sqrt(m{i}_e{i}) AS s{i}" for i in range(k)) + f" FROM b{step}, {last}")
    ctes.append("path AS MATERIALIZED (" + " UNION ALL ".join(path) + ")")
    ctes.append("fit AS MATERIALIZED (SELECT * FROM (SELECT *, lag(dev) OVER (ORDER BY step) AS before FROM path) t"
                " WHERE abs(dev - before) / (abs(dev) + 0.1) < 1e-8 ORDER BY step LIMIT 1)")
    return "WITH " + ",\n".join(ctes)


def normal_tail(z: str) -> str:
    """Two-sided tail of the normal distribution: 1 - erf(|z| / sqrt 2) by the series with positive terms."""
    x = f"(abs({z}) / sqrt(2e0))"
    term = f"exp(k * ln(2e0) + (2 * k + 1) * ln({x}) - ((k + 1) * ln(2e0) + lgamma(k + 1.5e0) - 0.5e0 * ln(pi())))"
    series = f"list_sum([{term} for k in range(0, 300)])"
    return (f"CASE WHEN {x} = 0 THEN 1e0 WHEN {x} > 8 THEN 0e0"
            f" ELSE greatest(0e0, 1e0 - 2e0 / sqrt(pi()) * exp(-{x} * {x}) * {series}) END")


_LONG = logit_ctes("analysis") + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS term, b{i} AS b, s{i} AS s FROM fit" for i, (t, _) in enumerate(LOGIT_TERMS)) + ")"
COEFFICIENTS_SQL = _LONG + f"""
SELECT term, {r('b', 6)} AS estimate, {r('s', 6)} AS std_error, {r('b / s', 6)} AS z_value,
       {r(normal_tail('b / s'), 6)} AS p_value, {r('exp(b)', 6)} AS odds_ratio FROM long"""

MODEL_HEADLINE_SQL = _LONG + f"""
SELECT 'traffic_index_odds_ratio' AS finding, {r('exp(b)', 6)} AS odds_ratio, {r(normal_tail('b / s'), 6)} AS p_value
FROM long WHERE term = 'traffic_index'"""

FIT_SQL = logit_ctes("analysis") + f""",
total AS (SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(y) AS BIGINT) AS y FROM pat)
SELECT n AS rows, CAST(step AS INTEGER) AS iterations, {r('dev', 6)} AS deviance,
       {r('-2 * (y * ln(y / CAST(n AS DOUBLE)) + (n - y) * ln((n - y) / CAST(n AS DOUBLE)))', 6)} AS null_deviance,
       {r(f'dev + 2 * {len(LOGIT_TERMS)}', 6)} AS aic, n - {len(LOGIT_TERMS)} AS residual_df FROM fit, total"""


def _closure(needs) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out or n in R.BASE_TABLES:
            return
        if n in DERIVED:
            for dep in DERIVED[n][0]:
                visit(dep)
        else:
            for dep in R.role_deps(n):
                visit(dep)
        out.append(n)

    for n in needs:
        visit(n)
    return out


def _bigint_counts(sql: str) -> str:
    """DuckDB's ``count_if`` is HUGEINT; Spark's is BIGINT.  Wrap each call."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len(key) - 1
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        out.append(sql[i:j] + "CAST(" + sql[j:k + 1] + " AS BIGINT)")
        i = k + 1


def with_ctes(needs, body: str) -> str:
    parts = []
    for n in _closure(needs):
        if n in DERIVED:
            text = DERIVED[n][1]
        else:
            text = R.role_sql(n, R.DUCK).format(**{t: t for t in R.role_deps(n)})
        parts.append(f"{n} AS ({text.strip()})")
    body = body.strip()
    if parts and body[:5].upper() == "WITH ":
        return _bigint_counts("WITH " + ",\n".join(parts) + ",\n" + body[5:])
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return _bigint_counts(head + body)
