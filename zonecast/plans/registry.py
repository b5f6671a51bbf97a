"""Registry of every implemented entry: Spark callable + DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame``; ``ORACLES[name]`` is the SQL
DuckDB runs on the same parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from zonecast.functions import rules as RU
from zonecast.functions.rules import round_half_up as rnd
from zonecast.operators import cleaning, joins, quality, ranking, stats
from zonecast.plans import named_sql
from zonecast.plans import products as PR
from zonecast.functions.sqltext import favg, fsum
from zonecast.plans.oracle import _CANCEL, _CF, COEFFICIENTS_SQL, FIT_SQL, MODEL_HEADLINE_SQL, r, r4, ratio, with_ctes
from zonecast.session import ensure_checkpoint_dir, scratch_path
from zonecast.sources import load, sinks
from zonecast.sources.catalog import Catalog, load_catalog
from zonecast.sources.roles import BASE_TABLES, TRIP_COLUMNS
from zonecast.sources.schemas import ROLE_SCHEMAS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def entry(name: str, needs=(), sql: str | None = None):
    """Register ``fn(cat) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str, _fn=fn) -> DataFrame:
            return _fn(Catalog(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(needs, sql)
        return fn
    return deco


# ================================================================ sources

@entry("scan_pruned", ["zones"], "SELECT zone_id, city FROM zones")
def _scan_pruned(cat):
    """S-3 / P-1: only two columns reach the scan."""
    return cat["zones"].select("zone_id", "city")


_COUNTED_ROLES = ("trips_messy", "trips", "demand_supply", "traffic")


@entry("catalog_row_counts", list(_COUNTED_ROLES),
       " UNION ALL ".join([f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                           for t in (*BASE_TABLES, *_COUNTED_ROLES)]))
def _catalog_row_counts(cat):
    """S-5 / S-12 / U-1: load a fixed table list (a missing one fails first),
    then one count per table, unioned."""
    base = load_catalog(cat.spark, cat.sf_dir, BASE_TABLES)
    frames = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
              for n, df in base.items()]
    frames += [cat[t].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
               for t in _COUNTED_ROLES]
    return quality.union_all(frames)


def _conform(role: str):
    def fn(cat):
        return sinks.conform(cat[role], ROLE_SCHEMAS[role])
    fn.__doc__ = f"S-6: {role} conformed to its declared schema."
    return fn


for _role in ROLE_SCHEMAS:
    entry("catalog_conform" if _role == "demand_supply" else f"catalog_conform_{_role}", [_role],
          f"SELECT * FROM {_role}")(_conform(_role))


@entry("scan_csv_dates", ["drivers"], "SELECT * FROM drivers")
def _scan_csv_dates(cat):
    """S-2: a CSV with a date column, read back with a declared schema."""
    path = scratch_path(cat.spark, "csv-dates")
    sinks.write_csv(cat["drivers"], path)
    return sinks.read_csv(cat.spark, path, ROLE_SCHEMAS["drivers"])


@entry("scan_csv_roundtrip", ["trips_messy"], "SELECT * FROM trips_messy")
def _scan_csv_roundtrip(cat):
    """S-1 / S-2: write as CSV with 'NA' for missing, read back with a declared schema."""
    path = scratch_path(cat.spark, "csv-scan")
    sinks.write_csv(cat["trips_messy"], path, null_token="NA")
    return sinks.read_csv(cat.spark, path, ROLE_SCHEMAS["trips_messy"])


# ================================================================= rules

def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TRIPS_NOT_BAD = "NOT (coalesce(distance_km <= 0, false) OR coalesce(fare <= 0, false))"


_AUDIT_SQL = f"""
WITH d AS (SELECT DISTINCT * FROM trips_messy),
s AS (SELECT (SELECT count(*) FROM trips_messy) AS src, count(*) AS distinct_rows,
             count_if(NOT {_TRIPS_NOT_BAD}) AS invalid,
             count_if({_TRIPS_NOT_BAD} AND payment_method = 'upi') AS upi,
             count_if({_TRIPS_NOT_BAD} AND discount IS NULL) AS no_discount,
             count_if({_TRIPS_NOT_BAD} AND driver_id IS NULL) AS no_driver
      FROM d)
SELECT * FROM (
SELECT 1 AS step_no, {_lit(cleaning.AUDIT_STEPS[0])} AS step, {_lit(cleaning.AUDIT_ACTIONS[0])} AS action,
       src - distinct_rows AS affected_records, distinct_rows AS rows_remaining FROM s
UNION ALL SELECT 2, {_lit(cleaning.AUDIT_STEPS[1])}, {_lit(cleaning.AUDIT_ACTIONS[1])}, invalid, distinct_rows - invalid FROM s
UNION ALL SELECT 3, {_lit(cleaning.AUDIT_STEPS[2])}, {_lit(cleaning.AUDIT_ACTIONS[2])}, upi, distinct_rows - invalid FROM s
UNION ALL SELECT 4, {_lit(cleaning.AUDIT_STEPS[3])}, {_lit(cleaning.AUDIT_ACTIONS[3])}, no_discount, distinct_rows - invalid FROM s
UNION ALL SELECT 5, {_lit(cleaning.AUDIT_STEPS[4])}, {_lit(cleaning.AUDIT_ACTIONS[4])}, no_driver, distinct_rows - invalid FROM s) t"""


@entry("filter_positive_keep_null", ["trips_messy"], f"SELECT * FROM trips_messy WHERE {_TRIPS_NOT_BAD}")
def _filter_keep(cat):
    """P-3, pandas form: a null measure survives."""
    return cat["trips_messy"].where(RU.positive_or_null(["distance_km", "fare"]))


@entry("filter_positive_drop_null", ["trips_messy"],
       "SELECT * FROM trips_messy WHERE distance_km > 0 AND fare > 0")
def _filter_drop(cat):
    """P-3, Spark-script form: a null measure is removed."""
    return cat["trips_messy"].where(~cleaning.invalid_measure(["distance_km", "fare"], "drop"))


@entry("standardize_labels", ["trips_messy"],
       "SELECT trip_id, CASE WHEN payment_method = 'upi' THEN 'UPI' ELSE payment_method END AS payment_method "
       "FROM trips_messy")
def _standardize(cat):
    """P-4."""
    return cat["trips_messy"].select("trip_id", RU.canonical_label("payment_method", RU.PAYMENT_CANONICAL)
                                     .alias("payment_method"))


@entry("impute_constant", ["trips_messy"],
       "SELECT trip_id, coalesce(discount, CAST(0 AS DOUBLE)) AS discount FROM trips_messy")
def _impute(cat):
    """P-5."""
    return cat["trips_messy"].select("trip_id", F.coalesce("discount", F.lit(0.0)).alias("discount"))


@entry("flag_presence", ["trips_messy"],
       "SELECT trip_id, driver_id IS NOT NULL AS is_driver_linked FROM trips_messy")
def _flag(cat):
    """P-7."""
    return cat["trips_messy"].select("trip_id", RU.presence_flag("driver_id").alias("is_driver_linked"))


@entry("parse_timestamps", ["trips_messy"], """
SELECT trip_id, request_text, CAST(try_strptime(request_text, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS request_timestamp
FROM (SELECT trip_id, CASE WHEN payment_method = 'Cash' THEN 'not a time'
                           ELSE strftime(request_timestamp, '%Y-%m-%d %H:%M:%S') END AS request_text
      FROM trips_messy) t""")
def _parse_ts(cat):
    """P-8: timestamps held as text, some unparseable; bad text becomes null."""
    t = cat["trips_messy"].select(
        "trip_id",
        F.when(F.col("payment_method") == "Cash", F.lit("not a time"))
        .otherwise(F.date_format("request_timestamp", "yyyy-MM-dd HH:mm:ss")).alias("request_text"))
    return t.withColumn("request_timestamp", RU.parse_timestamp("request_text"))


@entry("completed_revenue_total", ["trips_clean"],
       f"SELECT {r4('coalesce(' + fsum('fare') + ', CAST(0 AS DOUBLE))')} AS completed_revenue "
       "FROM trips_clean WHERE status = 'Completed'")
def _completed_total(cat):
    """P-11: row filter on status, then a whole-table sum."""
    t = PR.trips_clean(cat).where(F.col("status") == RU.COMPLETED)
    return t.agg(rnd(F.coalesce(RU.fixed_sum("fare"), F.lit(0.0)), PR.P).alias("completed_revenue"))


@entry("cross_group_flag", ["trip_cities"],
       "SELECT trip_id, pickup_city, drop_city, is_cross_city FROM trip_cities")
def _cross_flag(cat):
    """P-12: a null city counts as different."""
    return PR.trips_with_cities(cat["trips"], cat["zones"]).select(
        "trip_id", "pickup_city", "drop_city", "is_cross_city")


@entry("safe_ratio", ["demand_supply"],
       f"SELECT timestamp, zone_id, {ratio('ride_requests', 'available_vehicles')} AS demand_supply_ratio "
       "FROM demand_supply")
def _safe_ratio(cat):
    """P-13: zero denominator gives null (ANSI-safe)."""
    return cat["demand_supply"].select("timestamp", "zone_id",
                                       RU.safe_ratio("ride_requests", "available_vehicles")
                                       .alias("demand_supply_ratio"))


@entry("round_digits", ["demand_supply"],
       f"SELECT timestamp, zone_id, {r(ratio('ride_requests', 'available_vehicles'), 2)} AS demand_supply_ratio "
       "FROM demand_supply")
def _round_digits(cat):
    """P-22 with the engine-independent half-up form (G-9)."""
    return cat["demand_supply"].select(
        "timestamp", "zone_id", rnd(RU.safe_ratio("ride_requests", "available_vehicles"), 2)
        .alias("demand_supply_ratio"))


@entry("complete_cases", ["timed_clean", "weather"], """
SELECT t.trip_id, w.rainfall_mm, w.weather_condition
FROM timed_clean t LEFT JOIN weather w ON w.timestamp = t.request_timestamp
WHERE w.rainfall_mm IS NOT NULL AND w.weather_condition IS NOT NULL""")
def _complete_cases(cat):
    """P-14: drop rows with a missing value in the listed columns."""
    t = joins.update_join_last(PR.timed_clean(cat).select("trip_id", "request_timestamp"), cat["weather"],
                               {"request_timestamp": "timestamp"}, ["rainfall_mm", "weather_condition"],
                               order_by="rainfall_mm")
    return t.na.drop(subset=["rainfall_mm", "weather_condition"]).select("trip_id", "rainfall_mm",
                                                                         "weather_condition")


@entry("weighted_composite", ["scores"],
       "SELECT timestamp, zone_id, mobility_opportunity_score FROM scores")
def _weighted(cat):
    """P-15: weighted sum of the five scores, rescaled, clipped, rounded."""
    return PR.opportunity_scores(cat).select("timestamp", "zone_id", "mobility_opportunity_score")


@entry("banding", ["scores"],
       "SELECT timestamp, zone_id, mobility_opportunity_score, priority_band FROM scores")
def _banding(cat):
    """P-16: <= 25 / 50 / 75 bands; null falls to the top band."""
    return PR.opportunity_scores(cat).select("timestamp", "zone_id", "mobility_opportunity_score",
                                             "priority_band")


@entry("hour_of_day", ["timed_clean"],
       "SELECT trip_id, CAST(hour(request_timestamp) AS INTEGER) AS hour FROM timed_clean")
def _hour(cat):
    """P-18."""
    return PR.timed_clean(cat).select("trip_id", RU.hour_of_day("request_timestamp").alias("hour"))


@entry("hour_trunc_counts", ["trips_timed"], """
SELECT CAST(date_trunc('hour', pickup_timestamp) AS TIMESTAMP) AS hour_start, count(*) AS trips
FROM trips_timed GROUP BY 1""")
def _hour_trunc(cat):
    """P-19: truncate the raw pickup time to the hour, stay timestamp_ntz."""
    return cat["trips_timed"].groupBy(RU.hour_start("pickup_timestamp").alias("hour_start")) \
        .agg(F.count(F.lit(1)).alias("trips"))


# ================================================================= joins

@entry("join_inner_dim", ["demand_supply", "zones"], """
SELECT d.timestamp, d.zone_id, z.city, z.zone_name, d.ride_requests
FROM demand_supply d JOIN zones z ON z.zone_id = d.zone_id""")
def _join_inner(cat):
    """J-1: fact x broadcast dimension."""
    return joins.join_dim(cat["demand_supply"], cat["zones"], "zone_id", "inner").select(
        "timestamp", "zone_id", "city", "zone_name", "ride_requests")


@entry("join_left_dim", ["trips", "zones"], """
SELECT t.trip_id, z.city FROM trips t LEFT JOIN zones z ON z.zone_id = t.pickup_zone_id""")
def _join_left(cat):
    """J-2."""
    z = cat["zones"].select(F.col("zone_id").alias("pickup_zone_id"), "city")
    return joins.join_dim(cat["trips"], z, "pickup_zone_id", "left").select("trip_id", "city")


@entry("join_panel_left", ["demand_supply", "traffic"], """
SELECT d.timestamp, d.zone_id, d.ride_requests, t.traffic_index, t.congestion_level
FROM demand_supply d LEFT JOIN traffic t ON t.timestamp = d.timestamp AND t.zone_id = d.zone_id""")
def _join_panel(cat):
    """J-3: composite-key left join on (timestamp, zone)."""
    tr = cat["traffic"].select("timestamp", "zone_id", "traffic_index", "congestion_level")
    return joins.star_assemble(cat["demand_supply"], [(tr, ["timestamp", "zone_id"])]).select(
        "timestamp", "zone_id", "ride_requests", "traffic_index", "congestion_level")


@entry("join_role_playing", ["trip_cities"],
       "SELECT trip_id, pickup_zone_name, pickup_city, drop_city FROM trip_cities")
def _join_roles(cat):
    """J-4: the zone dimension joined as pickup and as drop."""
    return PR.trips_with_cities(cat["trips"], cat["zones"]).select(
        "trip_id", "pickup_zone_name", "pickup_city", "drop_city")


@entry("update_join_last", ["timed_clean", "traffic"], """
SELECT t.trip_id, tr.congestion_level, tr.traffic_index
FROM timed_clean t LEFT JOIN traffic tr ON tr.zone_id = t.pickup_zone_id AND tr.timestamp = t.request_timestamp""")
def _update_join(cat):
    """J-6: keyed update-join, right side made unique first; row count kept."""
    t = PR.timed_clean(cat).select("trip_id", "pickup_zone_id", "request_timestamp")
    return joins.update_join_last(t, cat["traffic"], {"pickup_zone_id": "zone_id", "request_timestamp": "timestamp"},
                                  ["congestion_level", "traffic_index"], order_by="traffic_index").select(
        "trip_id", "congestion_level", "traffic_index")


@entry("update_join_duplicates", ["timed_clean"], """
WITH seen AS (
  SELECT CAST(user_id % 25 AS STRING) AS zone_id, date_trunc('hour', ts) AS hour_start,
         CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS last_type,
         CASE WHEN user_id % 7 = 0 THEN NULL ELSE event_id END AS last_id
  FROM events),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY zone_id, hour_start
                               ORDER BY last_id DESC NULLS LAST, last_type DESC NULLS LAST) AS place
  FROM seen)
SELECT t.trip_id, n.last_type, n.last_id
FROM timed_clean t LEFT JOIN numbered n
  ON n.place = 1 AND n.zone_id = t.pickup_zone_id AND n.hour_start = t.request_timestamp""")
def _update_join_duplicates(cat):
    """J-6 with many rows per key on the right, null orders and null levels."""
    t = PR.timed_clean(cat).select("trip_id", "pickup_zone_id", "request_timestamp")
    seen = cat["events"].select(
        F.expr("CAST(user_id % 25 AS STRING)").alias("zone_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("last_type"),
        F.when(F.col("user_id") % 7 != 0, F.col("event_id")).alias("last_id"))
    return joins.update_join_last(t, seen, {"pickup_zone_id": "zone_id", "request_timestamp": "hour_start"},
                                  ["last_type", "last_id"], order_by="last_id").select("trip_id", "last_type", "last_id")


@entry("join_hourly_dim", ["demand_supply", "weather"], """
SELECT d.timestamp, d.zone_id, w.rainfall_mm, w.weather_condition
FROM demand_supply d LEFT JOIN weather w ON w.timestamp = d.timestamp""")
def _join_hourly(cat):
    """J-7: left join on the timestamp alone."""
    w = cat["weather"].select("timestamp", "rainfall_mm", "weather_condition")
    return joins.join_dim(cat["demand_supply"], w, "timestamp", "left").select(
        "timestamp", "zone_id", "rainfall_mm", "weather_condition")


@entry("zone_hour_star", ["star"], """
SELECT timestamp, zone_id, zone_name, city, ride_requests, traffic_index, rainfall_mm, weather_condition,
       observed_trips, completed_revenue, hour, recommended_vehicle_type FROM star""")
def _star(cat):
    """J-9 / J-10: chain of left joins around the demand panel; grain kept."""
    return PR.zone_hour_star(cat).select(
        "timestamp", "zone_id", "zone_name", "city", "ride_requests", "traffic_index", "rainfall_mm",
        "weather_condition", "observed_trips", "completed_revenue", "hour", "recommended_vehicle_type")


@entry("reindex_categories", ["trip_cities"], """
SELECT o.pickup_city, o.position, CAST(a.trips AS DOUBLE) AS trips
FROM (VALUES ('ASIA', 1), ('EUROPE', 2), ('AMERICA', 3), ('OCEANIA', 4)) AS o(pickup_city, position)
LEFT JOIN (SELECT pickup_city, count(*) AS trips FROM trip_cities WHERE pickup_city IS NOT NULL
           GROUP BY pickup_city) a ON a.pickup_city = o.pickup_city""")
def _reindex(cat):
    """J-11: fixed category list; absent ones null, unlisted ones vanish."""
    t = PR.trips_with_cities(cat["trips"], cat["zones"]).where(F.col("pickup_city").isNotNull())
    agg = t.groupBy("pickup_city").agg(F.count(F.lit(1)).alias("trips"))
    return joins.reindex_categories(agg, "pickup_city", PR.CITY_ORDER)


# ========================================================== aggregations

def _by_zone(cat, *aggs):
    return PR.trips_clean(cat).groupBy("pickup_zone_id").agg(*aggs)


@entry("group_count", ["trips_clean"],
       "SELECT pickup_zone_id, count(*) AS trips FROM trips_clean GROUP BY pickup_zone_id")
def _group_count(cat):
    """A-1."""
    return _by_zone(cat, F.count(F.lit(1)).alias("trips"))


@entry("group_count_nonnull", ["trips_clean"],
       "SELECT pickup_zone_id, count(driver_id) AS linked_trips FROM trips_clean GROUP BY pickup_zone_id")
def _group_count_nn(cat):
    """A-2: non-null count."""
    return _by_zone(cat, F.count("driver_id").alias("linked_trips"))


@entry("group_sum", ["trips_clean"],
       f"SELECT vehicle_type, {r4(fsum('fare'))} AS total_fare FROM trips_clean GROUP BY vehicle_type")
def _group_sum(cat):
    """A-3."""
    return PR.trips_clean(cat).groupBy("vehicle_type").agg(rnd(RU.fixed_sum("fare"), PR.P).alias("total_fare"))


@entry("group_mean", ["trips_clean"],
       f"SELECT vehicle_type, {r4(favg('wait_time_min'))} AS avg_wait_min FROM trips_clean GROUP BY vehicle_type")
def _group_mean(cat):
    """A-4: mean skipping nulls."""
    return PR.trips_clean(cat).groupBy("vehicle_type").agg(rnd(RU.fixed_avg("wait_time_min"), PR.P).alias("avg_wait_min"))


@entry("conditional_sum", ["trips_clean"],
       f"SELECT pickup_zone_id, {r4(fsum(_CF))} AS completed_revenue FROM trips_clean "
       "GROUP BY pickup_zone_id")
def _cond_sum(cat):
    """A-5: sum of fare where completed, else 0."""
    return _by_zone(cat, rnd(RU.fixed_sum(RU.value_if(F.col("status") == RU.COMPLETED, F.col("fare"))), PR.P)
                    .alias("completed_revenue"))


@entry("conditional_rate", ["trips_clean"],
       f"SELECT pickup_zone_id, {r('avg(' + _CANCEL + ')', 6)} AS cancellation_rate FROM trips_clean "
       "GROUP BY pickup_zone_id")
def _cond_rate(cat):
    """A-6: null status stays in the denominator."""
    return _by_zone(cat, rnd(F.avg(RU.is_status("status", RU.CANCELLED)), 6).alias("cancellation_rate"))


@entry("conditional_count", ["trips_clean"],
       "SELECT pickup_zone_id, count_if(status = 'Cancelled') AS cancelled_trips FROM trips_clean "
       "GROUP BY pickup_zone_id")
def _cond_count(cat):
    """A-7."""
    return _by_zone(cat, F.count_if(F.col("status") == RU.CANCELLED).alias("cancelled_trips"))


@entry("mean_of_ratios", ["demand_supply"],
       f"SELECT zone_id, {r4(favg(ratio('ride_requests', 'available_vehicles')))} AS avg_demand_supply_ratio "
       "FROM demand_supply GROUP BY zone_id")
def _mean_ratios(cat):
    """A-8: mean of row ratios, not a ratio of sums."""
    return cat["demand_supply"].groupBy("zone_id").agg(
        rnd(RU.fixed_avg(RU.safe_ratio("ride_requests", "available_vehicles")), PR.P).alias("avg_demand_supply_ratio"))


@entry("group_multi_key", ["trips_clean"],
       "SELECT pickup_zone_id, drop_zone_id, count(*) AS trips FROM trips_clean GROUP BY pickup_zone_id, drop_zone_id")
def _multi_key(cat):
    """A-10."""
    return PR.trips_clean(cat).groupBy("pickup_zone_id", "drop_zone_id").agg(F.count(F.lit(1)).alias("trips"))


@entry("group_null_kept", ["trips_clean"],
       "SELECT driver_id, count(*) AS trips FROM trips_clean GROUP BY driver_id")
def _null_kept(cat):
    """A-11: the null key is a group."""
    return PR.trips_clean(cat).groupBy("driver_id").agg(F.count(F.lit(1)).alias("trips"))


@entry("group_null_dropped", ["trips_clean"],
       "SELECT driver_id, count(*) AS trips FROM trips_clean WHERE driver_id IS NOT NULL GROUP BY driver_id")
def _null_dropped(cat):
    """A-12: pandas drops the null key."""
    return PR._drop_null_keys(PR.trips_clean(cat), ["driver_id"]).groupBy("driver_id") \
        .agg(F.count(F.lit(1)).alias("trips"))


@entry("duplicate_rows", ["trips_messy"], """
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM trips_messy) d) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM trips_messy) d) AS duplicate_rows
FROM trips_messy""")
def _dups(cat):
    """A-13."""
    return PR.duplicate_rows(cat)


# ============================================================== rankings

@entry("percentile_score", ["demand_supply"], f"""
SELECT timestamp, zone_id, demand_supply_ratio,
       CASE WHEN demand_supply_ratio IS NULL THEN NULL ELSE
         (CAST(rank() OVER (ORDER BY demand_supply_ratio) - 1 AS DOUBLE)
          + CAST(count(*) OVER (PARTITION BY demand_supply_ratio) + 1 AS DOUBLE) / CAST(2 AS DOUBLE))
         / CAST(count(demand_supply_ratio) OVER () AS DOUBLE) * CAST(100 AS DOUBLE) END AS demand_pressure_score
FROM (SELECT timestamp, zone_id, {ratio('ride_requests', 'available_vehicles')} AS demand_supply_ratio
      FROM demand_supply) d""")
def _percentile(cat):
    """W-1: distributed average-tie percentile rank."""
    d = cat["demand_supply"].select("timestamp", "zone_id",
                                    RU.safe_ratio("ride_requests", "available_vehicles").alias("demand_supply_ratio"))
    ensure_checkpoint_dir(cat.spark)
    # the ranking reads its input three times: materialise the aggregate once
    return ranking.percentile_scores(d.checkpoint(eager=True), {"demand_supply_ratio": "demand_pressure_score"})


@entry("top1_per_group", ["mix"], "SELECT * FROM mix")
def _top1(cat):
    """W-2 / W-3: top vehicle type per (zone, hour), ties to the first label."""
    return PR.vehicle_mix(PR.timed_clean(cat))


@entry("sort_multi_key", ["trips_clean"], """
SELECT trip_id, vehicle_type, fare,
       row_number() OVER (ORDER BY vehicle_type ASC NULLS LAST, fare DESC NULLS LAST, trip_id) AS rank FROM trips_clean""")
def _sort(cat):
    """O-1: range-partitioned global sort, mixed directions, nulls last, its order as a column."""
    return ranking.global_rank(PR.trips_clean(cat).select("trip_id", "vehicle_type", "fare"), [
        F.col("vehicle_type").asc_nulls_last(), F.col("fare").desc_nulls_last(), F.col("trip_id").asc_nulls_last()])


@entry("topk_pressure", ["fleet_pressure"], """
SELECT *, CAST(row_number() OVER (ORDER BY demand_supply_ratio DESC NULLS LAST, cancelled_trips DESC,
                                  zone_id, timestamp) AS INTEGER) AS rank
FROM (SELECT timestamp, zone_id, city, demand_supply_ratio, cancelled_trips FROM fleet_pressure
      ORDER BY demand_supply_ratio DESC NULLS LAST, cancelled_trips DESC, zone_id, timestamp LIMIT 20) t""")
def _topk(cat):
    """O-2: top 20 zone-hours by pressure with unique tie-break keys."""
    fp = PR.fleet_pressure(cat).select("timestamp", "zone_id", "city", "demand_supply_ratio", "cancelled_trips")
    return ranking.top_k(fp, [F.col("demand_supply_ratio").desc_nulls_last(), F.col("cancelled_trips").desc(),
                              "zone_id", "timestamp"], 20)


@entry("nlargest_groups", ["eda_zone"], """
SELECT pickup_zone_id, pickup_zone_name, avg_wait_min,
       CAST(row_number() OVER (ORDER BY avg_wait_min DESC NULLS LAST, pickup_zone_id) AS INTEGER) AS rank
FROM (SELECT * FROM eda_zone ORDER BY avg_wait_min DESC NULLS LAST, pickup_zone_id LIMIT 5) t""")
def _nlargest(cat):
    """O-3: five zones with the longest average wait."""
    z = PR.eda_zone(cat).select("pickup_zone_id", "pickup_zone_name", "avg_wait_min")
    return ranking.nlargest(z, "avg_wait_min", 5, ["pickup_zone_id"])


@entry("argmax_argmin", ["eda_hourly"], """
SELECT * FROM (SELECT 'max' AS extreme, hour, trips FROM eda_hourly ORDER BY trips DESC, hour LIMIT 1) a
UNION ALL
SELECT * FROM (SELECT 'min' AS extreme, hour, trips FROM eda_hourly ORDER BY trips ASC, hour LIMIT 1) b""")
def _argmax(cat):
    """O-4: busiest and quietest hour of day, ties to the earliest hour."""
    h = PR.eda_hourly(cat)
    hi = ranking.arg_extreme(h, "trips", ["hour"], largest=True).select(F.lit("max").alias("extreme"), "hour", "trips")
    lo = ranking.arg_extreme(h, "trips", ["hour"], largest=False).select(F.lit("min").alias("extreme"), "hour", "trips")
    return hi.unionByName(lo)


@entry("custom_order", ["traffic"], """
SELECT congestion_level, count(*) AS zone_hours,
       CAST(CASE congestion_level WHEN 'Low' THEN 1 WHEN 'Medium' THEN 2 WHEN 'High' THEN 3
                                  WHEN 'Severe' THEN 4 END AS INTEGER) AS position
FROM traffic GROUP BY congestion_level""")
def _custom_order(cat):
    """O-5: explicit category order, unknown values last."""
    g = cat["traffic"].groupBy("congestion_level").agg(F.count(F.lit(1)).alias("zone_hours"))
    return ranking.explicit_order(g, "congestion_level", PR.CONGESTION_ORDER).orderBy(
        F.col("position").asc_nulls_last(), "congestion_level")


@entry("distinct_rows", ["trips_messy"], "SELECT DISTINCT * FROM trips_messy")
def _distinct(cat):
    """U-2: exact duplicate removal over all columns."""
    return cat["trips_messy"].dropDuplicates()


# ======================================================= data products

_CLEAN_COLS = ", ".join(TRIP_COLUMNS + ["is_driver_linked"])


@entry("clean_trips", ["trips_clean"], f"SELECT {_CLEAN_COLS} FROM trips_clean")
def _clean(cat):
    """D-1."""
    return PR.trips_clean(cat)


@entry("cleaning_audit", ["trips_messy"], _AUDIT_SQL)
def _audit(cat):
    """D-2: per step affected rows and rows left, one pass."""
    return PR.cleaning_audit(cat)


_SUMMARY_SQL = f"""
WITH d AS (SELECT DISTINCT * FROM trips_messy),
s AS (SELECT count(*) AS distinct_rows,
             count_if(NOT {_TRIPS_NOT_BAD}) AS invalid,
             count_if({_TRIPS_NOT_BAD} AND payment_method = 'upi') AS upi,
             count_if({_TRIPS_NOT_BAD} AND discount IS NULL) AS no_discount,
             count_if({_TRIPS_NOT_BAD} AND driver_id IS NULL) AS no_driver,
             count_if({_TRIPS_NOT_BAD} AND rating IS NULL) AS no_rating,
             count_if({_TRIPS_NOT_BAD} AND cancellation_reason IS NULL) AS no_reason
      FROM d)
SELECT (SELECT count(*) FROM trips_messy) AS source_rows, distinct_rows - invalid AS cleaned_rows,
       (SELECT count(*) FROM trips_messy) - distinct_rows AS duplicate_rows_removed,
       invalid AS invalid_fare_or_distance_rows_removed, upi AS payment_labels_standardized,
       no_discount AS missing_discounts_imputed, no_driver AS trips_without_driver_id_flagged,
       no_rating AS unrated_trips_retained, no_reason AS null_cancellation_reasons_retained
FROM s"""


@entry("cleaning_summary", ["trips_messy"], _SUMMARY_SQL)
def _summary(cat):
    """D-2 summary: nine fields."""
    return PR.cleaning_summary(cat)


@entry("zone_hour_trip_metrics", ["metrics_hour"], "SELECT * FROM metrics_hour")
def _zh_metrics(cat):
    """D-3: hour grain (Spark scripts)."""
    return PR.zone_hour_trip_metrics(PR.timed_clean(cat), "hour")


@entry("fleet_pressure", ["fleet_pressure"], "SELECT * FROM fleet_pressure")
def _fleet(cat):
    """D-4."""
    return PR.fleet_pressure(cat)


@entry("vehicle_revenue", ["trips_clean"], f"""
SELECT vehicle_type, count(trip_id) AS trips, {r(fsum(_CF), 2)} AS completed_revenue,
       {r(favg('fare'), 2)} AS avg_fare,
       row_number() OVER (ORDER BY {r(fsum(_CF), 2)} DESC NULLS LAST, vehicle_type) AS rank
FROM trips_clean GROUP BY vehicle_type""")
def _vehicle_revenue(cat):
    """D-5, its order as a column (O-6)."""
    return PR.ranked_vehicle_revenue(cat)


#: Tables of the profile and their columns, from the declared schemas.
_ROLE_COLUMNS = {t: ROLE_SCHEMAS[t].names for t in
                 ("zones", "vehicles", "drivers", "weather", "city_events", "traffic", "demand_supply")}
_ROLE_COLUMNS |= {"trips": [*ROLE_SCHEMAS["trips_messy"].names, "is_driver_linked"], "trips_messy": ROLE_SCHEMAS["trips_messy"].names}


def _profile_sql() -> str:
    parts = []
    for t, cols in _ROLE_COLUMNS.items():
        nulls = " + ".join(f"count_if({c} IS NULL)" for c in cols)
        parts.append(f"SELECT '{t}' AS dataset, count(*) AS rows, CAST({len(cols)} AS BIGINT) AS columns, "
                     f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {t}) d) AS duplicate_rows, "
                     f"CAST({nulls} AS BIGINT) AS missing_cells FROM {t}")
    return "\nUNION ALL\n".join(parts)


@entry("dataset_profile", list(_ROLE_COLUMNS), _profile_sql())
def _profile(cat):
    """D-6: rows, columns, duplicates, missing cells per table."""
    return PR.dataset_profile(cat)


def _missing_sql() -> str:
    parts = []
    for t, cols in _ROLE_COLUMNS.items():
        for c in cols:
            parts.append(f"SELECT '{t}' AS dataset, '{c}' AS column_name, count_if({c} IS NULL) AS missing_count, "
                         f"CAST(count_if({c} IS NULL) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS missing_pct FROM {t}")
    return "SELECT * FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) m WHERE missing_count > 0"


@entry("missing_values", list(_ROLE_COLUMNS), _missing_sql())
def _missing(cat):
    """D-7 / A-14: columns with missing values and their share."""
    return PR.missing_values(cat)


def _fk_sql() -> str:
    parts = []
    for label, child, ck, parent, pk in PR.FK_RELATIONS:
        parts.append(
            f"SELECT '{label}' AS relationship, count(*) AS records_checked, "
            f"count_if({ck} IS NULL) AS missing_foreign_keys, "
            f"count_if({ck} IS NOT NULL AND {ck} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)) "
            f"AS orphan_foreign_keys FROM {child}")
    return "\nUNION ALL\n".join(parts)


_FK_ROLES = ["trips", "drivers", "vehicles", "zones", "city_events"]


@entry("fk_integrity", _FK_ROLES, _fk_sql())
def _fk(cat):
    """D-8 / J-8: seven relationships, missing and orphan keys."""
    return PR.fk_integrity(cat)


_QUALITY_SQL = """
SELECT 'trips' AS dataset, 'non_positive_distance' AS "check", count_if(distance_km <= 0) AS failed_records FROM trips
UNION ALL SELECT 'trips', 'non_positive_fare', count_if(fare <= 0) FROM trips
UNION ALL SELECT 'trips', 'negative_wait_time', count_if(wait_time_min < 0) FROM trips
UNION ALL SELECT 'trips', 'negative_duration', count_if(trip_duration_min < 0) FROM trips
UNION ALL SELECT 'trips', 'pickup_before_request', count_if(pickup_timestamp < request_timestamp) FROM trips
UNION ALL SELECT 'trips', 'dropoff_before_pickup', count_if(dropoff_timestamp < pickup_timestamp) FROM trips
UNION ALL SELECT 'demand_supply', 'negative_requests', count_if(ride_requests < 0) FROM demand_supply
UNION ALL SELECT 'demand_supply', 'negative_available_vehicles', count_if(available_vehicles < 0) FROM demand_supply
UNION ALL SELECT 'demand_supply', 'completed_plus_cancelled_exceeds_requests',
                 count_if(completed_trips + cancelled_trips > ride_requests) FROM demand_supply
UNION ALL SELECT 'traffic', 'non_positive_speed', count_if(avg_speed_kmph <= 0) FROM traffic"""


@entry("quality_checks", ["trips", "demand_supply", "traffic"], _QUALITY_SQL)
def _quality(cat):
    """D-8 / A-16: ten rule failure counts."""
    return PR.quality_checks(cat)


@entry("validation_outcome", _FK_ROLES + ["demand_supply", "traffic"], f"""
WITH fk AS ({_fk_sql()}), q AS ({_QUALITY_SQL})
SELECT 'integrity_failures' AS outcome, count_if(missing_foreign_keys > 0 OR orphan_foreign_keys > 0) AS value FROM fk
UNION ALL SELECT 'failed_quality_rules', count_if(failed_records > 0) FROM q""")
def _outcome(cat):
    """D-11."""
    return PR.validation_outcome(cat)


@entry("kpis", ["trip_cities", "demand_supply"], f"""
SELECT 'average_distance_km' AS metric, {r4(favg('distance_km'))} AS value FROM trip_cities
UNION ALL SELECT 'average_fare_inr', {r4(favg('fare'))} FROM trip_cities
UNION ALL SELECT 'average_wait_min', {r4(favg('wait_time_min'))} FROM trip_cities
UNION ALL SELECT 'cancellation_rate', {r4('avg(' + _CANCEL + ')')} FROM trip_cities
UNION ALL SELECT 'completed_revenue_inr', {r4('coalesce(' + fsum("CASE WHEN status = 'Completed' THEN fare END") + ', CAST(0 AS DOUBLE))')} FROM trip_cities
UNION ALL SELECT 'cross_city_trip_share', {r4('avg(CAST(is_cross_city AS INTEGER))')} FROM trip_cities
UNION ALL SELECT 'average_demand_supply_ratio', {r4(favg(ratio('ride_requests', 'available_vehicles')))}
          FROM demand_supply""")
def _kpis(cat):
    """D-9: seven whole-table KPIs."""
    return PR.kpis(cat)


@entry("raw_city_metrics", ["trips", "zones"], f"""
SELECT z.city, count(*) AS trips, {r4(favg('t.wait_time_min'))} AS avg_wait_min, {r4(favg('t.fare'))} AS avg_fare
FROM trips t LEFT JOIN zones z ON z.zone_id = t.pickup_zone_id GROUP BY z.city""")
def _raw_city(cat):
    """D-10 city metrics (null city kept)."""
    return PR.raw_city_metrics(cat)


@entry("raw_vehicle_metrics", ["trips"], f"""
SELECT vehicle_type, count(*) AS trips, {r4(favg('fare'))} AS avg_fare, {r4(favg('wait_time_min'))} AS avg_wait_min
FROM trips WHERE vehicle_type IS NOT NULL GROUP BY vehicle_type""")
def _raw_vehicle(cat):
    """D-10 vehicle metrics (null type dropped)."""
    return PR.raw_vehicle_metrics(cat)


_OPP_COLS = ", ".join(PR.OPPORTUNITY_COLUMNS)


@entry("opportunity_scores", ["scores"], f"SELECT {_OPP_COLS} FROM scores")
def _opportunity(cat):
    """D-12: zone-hour opportunity score, 23 columns."""
    return PR.opportunity_scores(cat)


@entry("fleet_recommendations", ["recommendations"], "SELECT * FROM recommendations")
def _recs(cat):
    """D-13."""
    return PR.fleet_recommendations(cat)


@entry("top_recommendations", ["recommendations_exact"], """
SELECT * EXCLUDE (_score),
       CAST(row_number() OVER (ORDER BY _score DESC NULLS LAST, critical_hours DESC, city, zone_id, zone_name,
                               hour, recommended_vehicle_type) AS INTEGER) AS rank
FROM (SELECT * FROM recommendations_exact
      ORDER BY _score DESC NULLS LAST, critical_hours DESC, city, zone_id, zone_name, hour,
               recommended_vehicle_type LIMIT 20) t""")
def _top_recs(cat):
    """D-14: top 20 recommendations."""
    return PR.top_recommendations(cat)


@entry("eda_hourly", ["eda_hourly"], "SELECT * FROM eda_hourly")
def _eda_hourly(cat):
    """D-15."""
    return PR.eda_hourly(cat)


@entry("eda_city", ["eda_city"], "SELECT * FROM eda_city")
def _eda_city(cat):
    """D-16."""
    return PR.eda_city(cat)


@entry("eda_vehicle", ["eda_vehicle"], "SELECT * FROM eda_vehicle")
def _eda_vehicle(cat):
    """D-17."""
    return PR.eda_vehicle(cat)


@entry("eda_zone", ["eda_zone"], "SELECT * FROM eda_zone")
def _eda_zone(cat):
    """D-18 zone metrics."""
    return PR.eda_zone(cat)


@entry("eda_corridors", ["eda_corridors"], "SELECT * FROM eda_corridors")
def _eda_corr(cat):
    """D-18 cross-city corridors."""
    return PR.eda_corridors(cat)


@entry("eda_corridors_top6", ["eda_corridors"], """
SELECT *, CAST(row_number() OVER (ORDER BY trips DESC, pickup_city, drop_city) AS INTEGER) AS rank
FROM (SELECT *, pickup_city || ' → ' || drop_city AS corridor FROM eda_corridors
      ORDER BY trips DESC, pickup_city, drop_city LIMIT 6) t""")
def _eda_top6(cat):
    """D-30: chart series of the top six corridors."""
    return PR.eda_corridors_top6(cat)


_HEADLINE_SQL = f"""
SELECT * FROM (SELECT 'peak_hour' AS finding, 1 AS rank, lpad(CAST(hour AS VARCHAR), 2, '0') || ':00' AS label,
                      CAST(NULL AS VARCHAR) AS pickup_city, CAST(trips AS DOUBLE) AS value
               FROM eda_hourly ORDER BY trips DESC, hour LIMIT 1) a
UNION ALL
SELECT * FROM (SELECT 'largest_market', 1, pickup_city, CAST(NULL AS VARCHAR), CAST(trips AS DOUBLE) FROM eda_city
               WHERE trips IS NOT NULL ORDER BY trips DESC, position LIMIT 1) b
UNION ALL
SELECT * FROM (SELECT 'top_revenue_vehicle', 1, vehicle_type, CAST(NULL AS VARCHAR), completed_revenue FROM eda_vehicle
               ORDER BY completed_revenue DESC, vehicle_type LIMIT 1) c
UNION ALL
SELECT 'cross_city_share', 1, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), {r4('avg(CAST(is_cross_city AS INTEGER))')} FROM clean_cities
UNION ALL
SELECT 'top_demand_zone', CAST(row_number() OVER (ORDER BY trips DESC, pickup_zone_id) AS INTEGER), pickup_zone_name,
       pickup_city, CAST(trips AS DOUBLE)
FROM (SELECT * FROM eda_zone ORDER BY trips DESC, pickup_zone_id LIMIT 5) d
UNION ALL
SELECT 'longest_wait_zone', CAST(row_number() OVER (ORDER BY avg_wait_min DESC NULLS LAST, pickup_zone_id) AS INTEGER),
       pickup_zone_name, pickup_city, avg_wait_min
FROM (SELECT * FROM eda_zone ORDER BY avg_wait_min DESC NULLS LAST, pickup_zone_id LIMIT 5) e
UNION ALL
SELECT 'highest_cancel_zone', CAST(row_number() OVER (ORDER BY pct DESC NULLS LAST, pickup_zone_id) AS INTEGER),
       pickup_zone_name, pickup_city, pct
FROM (SELECT *, {r4('cancellation_rate * 100')} AS pct FROM eda_zone
      ORDER BY pct DESC NULLS LAST, pickup_zone_id LIMIT 5) f"""


@entry("headline_findings", ["eda_hourly", "eda_city", "eda_vehicle", "clean_cities", "eda_zone"], _HEADLINE_SQL)
def _headline(cat):
    """D-19: EDA headline findings, long form."""
    return PR.headline_findings(cat)


# ------------------------------------------------------------ named SQL

def _named(name: str):
    def fn(cat):
        frames = {"demand_supply": cat["demand_supply"], "zones": cat["zones"], "traffic": cat["traffic"],
                  "trips": PR.trips_clean(cat), "timed_trips": PR.timed_clean(cat)}
        return named_sql.run_named(cat.spark, name, frames)
    fn.__doc__ = f"Named SQL query {name!r} (S-11)."
    return fn


_CANCELLED_PCT = r("100e0 * CAST(count(*) FILTER (WHERE status = 'Cancelled') AS DOUBLE) / count(*)", 2)

# the oracle side is written for itself: one flat aggregate over the joined rows, then ranks
for _entry, _name, _needs, _sql in (
    ("sql_fleet_pressure", "zone_hourly_fleet_pressure", ["demand_supply", "zones"], f"""
        SELECT * FROM (
          SELECT city, zone_name, timestamp, ride_requests, available_vehicles, demand_supply_ratio, cancelled_trips,
                 avg_wait_time_min, CAST(row_number() OVER (ORDER BY demand_supply_ratio DESC NULLS LAST, cancelled_trips DESC,
                                                            city, zone_name, timestamp) AS INTEGER) AS rank
          FROM (SELECT *, {r("CAST(ride_requests AS DOUBLE) / NULLIF(available_vehicles, 0)", 2)} AS demand_supply_ratio
                FROM demand_supply) p JOIN zones USING (zone_id)) ranked
        WHERE rank <= 100"""),
    ("sql_zone_hotspots", "zone_experience_hotspots", ["trips_clean", "zones"], f"""
        SELECT *, CAST(row_number() OVER (ORDER BY cancellation_rate_pct DESC, avg_wait_time_min DESC NULLS LAST, trips DESC,
                                          city, zone_name) AS INTEGER) AS rank
        FROM (SELECT city, zone_name, count(*) AS trips, {_CANCELLED_PCT} AS cancellation_rate_pct,
                     {r(favg("wait_time_min"), 2)} AS avg_wait_time_min, {r(fsum(_CF), 2)} AS completed_revenue
              FROM trips_clean JOIN zones ON pickup_zone_id = zone_id GROUP BY ALL) g"""),
    ("sql_vehicle_performance", "vehicle_revenue_performance", ["trips_clean"], f"""
        SELECT *, CAST(row_number() OVER (ORDER BY completed_revenue DESC, vehicle_type) AS INTEGER) AS rank
        FROM (SELECT vehicle_type, count(*) AS trips, {r(fsum(_CF), 2)} AS completed_revenue,
                     {r(favg("fare"), 2)} AS avg_fare, {_CANCELLED_PCT} AS cancellation_rate_pct
              FROM trips_clean GROUP BY ALL) g"""),
    ("sql_corridors", "cross_city_corridors", ["trips_clean", "zones"], f"""
        SELECT *, CAST(row_number() OVER (ORDER BY trips DESC, corridor) AS INTEGER) AS rank
        FROM (SELECT concat(a.city, ' → ', b.city) AS corridor, count(*) AS trips,
                     {r(favg("wait_time_min"), 2)} AS avg_wait_time_min, {r(fsum(_CF), 2)} AS completed_revenue
              FROM trips_clean, zones a, zones b
              WHERE a.zone_id = pickup_zone_id AND b.zone_id = drop_zone_id AND a.city <> b.city GROUP BY ALL) g"""),
    ("sql_traffic_experience", "traffic_customer_experience", ["timed_clean", "traffic"], f"""
        SELECT *, CAST(row_number() OVER (ORDER BY avg_trip_duration_min DESC NULLS LAST, congestion_level) AS INTEGER) AS rank
        FROM (SELECT congestion_level, count(*) AS trips, {r(favg("trip_duration_min"), 2)} AS avg_trip_duration_min,
                     {r(favg("wait_time_min"), 2)} AS avg_wait_time_min, {_CANCELLED_PCT} AS cancellation_rate_pct
              FROM timed_clean JOIN traffic ON traffic.zone_id = pickup_zone_id AND timestamp = request_timestamp
              GROUP BY ALL) g"""),
):
    entry(_entry, _needs, _sql)(_named(_name))


@entry("large_sum", ["trips_clean"], f"""
SELECT vehicle_type, {r(fsum("fare * 1e9"), 4)} AS total, {r(favg("fare * 1e9"), 4)} AS mean
FROM trips_clean GROUP BY vehicle_type""")
def _large_sum(cat):
    """P-22 / A-3 beyond the BIGINT range: sums of fares a billion times as large."""
    big = PR.trips_clean(cat).select("vehicle_type", (F.col("fare") * F.lit(1e9)).alias("x"))
    return big.groupBy("vehicle_type").agg(RU.round_half_up(RU.fixed_sum("x"), 4).alias("total"),
                                           RU.round_half_up(RU.fixed_avg("x"), 4).alias("mean"))


# ---------------------------------------------------------------- study

@entry("analysis_set", ["analysis"], "SELECT * FROM analysis")
def _analysis(cat):
    """D-24: trips with traffic and weather, complete cases."""
    return PR.analysis_set(cat)


@entry("cancel_by_congestion", ["by_congestion"], "SELECT * FROM by_congestion")
def _by_cong(cat):
    """D-25."""
    return PR.cancel_by_congestion(cat)


@entry("cancel_by_weather", ["by_weather"], "SELECT * FROM by_weather")
def _by_weather(cat):
    """D-26."""
    return PR.cancel_by_weather(cat)


@entry("study_headline", ["by_congestion", "by_weather"], f"""
SELECT * FROM (SELECT 'highest_congestion_cancellation' AS finding, congestion_level AS label,
                      {r4('cancellation_rate * 100')} AS value
               FROM by_congestion ORDER BY cancellation_rate DESC, position NULLS LAST, congestion_level LIMIT 1) a
UNION ALL
SELECT * FROM (SELECT 'lowest_congestion_cancellation', congestion_level, {r4('cancellation_rate * 100')}
               FROM by_congestion ORDER BY cancellation_rate ASC, position NULLS LAST, congestion_level LIMIT 1) b
UNION ALL
SELECT 'congestion_gap_pp', CAST(NULL AS VARCHAR), {r4('(max(cancellation_rate) - min(cancellation_rate)) * 100')}
FROM by_congestion
UNION ALL
SELECT * FROM (SELECT 'highest_weather_cancellation', weather_condition, {r4('cancellation_rate * 100')}
               FROM by_weather ORDER BY cancellation_rate DESC, weather_condition LIMIT 1) c""")
def _study_headline(cat):
    """D-28."""
    return PR.study_headline(cat)


@entry("logit_coefficients", ["analysis"], COEFFICIENTS_SQL)
def _logit(cat):
    """D-27 / L-3 / P-25: coefficient table."""
    return PR.logit_coefficients(cat)


@entry("logit_fit", ["analysis"], FIT_SQL)
def _logit_fit(cat):
    """L-2: fit diagnostics."""
    return PR.logit_fit(cat)


@entry("study_model_headline", ["analysis"], MODEL_HEADLINE_SQL)
def _study_model(cat):
    """D-28, model part: traffic-index odds ratio and p-value."""
    return PR.study_model_headline(cat)


SAMPLE_ROWS = 1_000  # of the entry: below its number of rows, so that the sample leaves rows out


@entry("seeded_sample", ["analysis"], f"""
SELECT * FROM analysis ORDER BY md5(trip_id || '|{stats.SAMPLE_SEED}') LIMIT {SAMPLE_ROWS}""")
def _sample(cat):
    """L-1: the rows that come first by md5 of trip id and seed."""
    return PR.seeded_sample(cat, SAMPLE_ROWS)


@entry("data_gates", ["trips_clean", "fleet_pressure", "analysis"], """
SELECT 'no_non_positive_fare_or_distance' AS gate, count(*) AS checked,
       count_if(coalesce(distance_km <= 0, false) OR coalesce(fare <= 0, false)) AS failed,
       count_if(coalesce(distance_km <= 0, false) OR coalesce(fare <= 0, false)) = 0 AS passed FROM trips_clean
UNION ALL
SELECT 'demand_supply_ratio_present', count(*),
       count_if(demand_supply_ratio IS NULL AND NOT coalesce(available_vehicles = 0, false)),
       count_if(demand_supply_ratio IS NULL AND NOT coalesce(available_vehicles = 0, false)) = 0 FROM fleet_pressure
UNION ALL
SELECT 'analysis_set_not_empty', count(*), CASE WHEN count(*) = 0 THEN 1 ELSE 0 END, count(*) > 0 FROM analysis""")
def _gates(cat):
    """D-29."""
    return PR.data_gates(cat)


# ------------------------------------------------------------ sink trips

@entry("sink_csv_roundtrip", ["trips_clean"], f"""
SELECT vehicle_type, count(trip_id) AS trips, {r(fsum(_CF), 2)} AS completed_revenue,
       {r(favg('fare'), 2)} AS avg_fare
FROM trips_clean GROUP BY vehicle_type""")
def _sink_csv(cat):
    """S-7: CSV out, read back with a declared schema."""
    path = scratch_path(cat.spark, "csv-sink")
    sinks.write_csv(PR.vehicle_revenue(cat), path)
    schema = StructType([StructField("vehicle_type", StringType()), StructField("trips", LongType()),
                         StructField("completed_revenue", DoubleType()), StructField("avg_fare", DoubleType())])
    return sinks.read_csv(cat.spark, path, schema)


@entry("sink_parquet_roundtrip", ["fleet_pressure"], "SELECT * FROM fleet_pressure")
def _sink_parquet(cat):
    """S-8: parquet partitioned by city, read back."""
    path = scratch_path(cat.spark, "parquet-sink")
    sinks.write_parquet(PR.fleet_pressure(cat), path, partition_by=["city"])
    return cat.spark.read.parquet(path)


@entry("sink_table_roundtrip", ["fleet_pressure"], "SELECT *, CAST(2 AS BIGINT) AS places FROM fleet_pressure")
def _sink_table(cat):
    """S-9: table with a prefix plus a folder; every row is read back from both places."""
    table, folder, _ = sinks.save_table(PR.fleet_pressure(cat), "zonecast_fleet_pressure", scratch_path(cat.spark, "table-sink"))
    both = table.unionByName(folder)
    return both.groupBy(*table.columns).agg(F.count(F.lit(1)).alias("places"))


@entry("catalog_append_load", ["demand_supply"], "SELECT * FROM demand_supply")
def _append_load(cat):
    """S-6: files loaded as they come; loading again adds nothing."""
    folder, out = scratch_path(cat.spark, "load-source"), scratch_path(cat.spark, "load-table")
    schema = ROLE_SCHEMAS["demand_supply"]
    hour = F.hour("timestamp") % 3
    for k in range(3):
        sinks.write_csv(cat["demand_supply"].where(hour == k), f"{folder}/day={k}")
        load.append_load(cat.spark, folder, out, schema)
        load.append_load(cat.spark, folder, out, schema)
    return load.read_table(cat.spark, out, schema)


_LOADED = ("zones", "vehicles", "drivers", "traffic", "demand_supply")


@entry("catalog_load_counts", list(_LOADED),
       " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _LOADED))
def _load_counts(cat):
    """S-6 / S-12: append load of several tables from their folders, then what the tables hold."""
    folder, out = scratch_path(cat.spark, "load-sources"), scratch_path(cat.spark, "load-catalog")
    for t in _LOADED:
        sinks.write_csv(cat[t], f"{folder}/{t}")
    return load.load_catalog_tables(cat.spark, folder, out, {t: ROLE_SCHEMAS[t] for t in _LOADED})


@entry("cleaning_summary_json", ["trips_messy"], _SUMMARY_SQL)
def _summary_json(cat):
    """S-10: the cleaning summary as JSON, read back."""
    path = scratch_path(cat.spark, "json-sink")
    summary = PR.cleaning_summary(cat)
    sinks.write_json(summary, path)
    return cat.spark.read.schema(summary.schema).json(path)
