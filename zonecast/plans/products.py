"""Data products: each a function of a :class:`Catalog` returning a DataFrame.

Which trips feed what: ``trips_messy`` (order lines, the large fact) is cleaned
into ``trips_clean`` for revenue, zone, city, vehicle and corridor products;
``trips_timed`` (events, hour-aligned requests) is cleaned into
``timed_clean`` for everything joined to the zone-hour panels.

Fixed values:
  city order (role view over regions): ASIA, EUROPE, AMERICA, OCEANIA
  congestion order: Low, Medium, High, Severe
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import rules as RU
from zonecast.functions.rules import round_half_up as rnd
from zonecast.operators import cleaning, joins, quality, ranking, stats
from zonecast.session import ensure_checkpoint_dir, written
from zonecast.sources.catalog import Catalog

CITY_ORDER = ("ASIA", "EUROPE", "AMERICA", "OCEANIA")
CONGESTION_ORDER = ("Low", "Medium", "High", "Severe")

# Report precision of double aggregates (sum/avg): the last bits of a float
# sum depend on summation order, which differs between engines and runs.
P = 4


def _completed_fare():
    return RU.value_if(F.col("status") == RU.COMPLETED, F.col("fare"))


def _drop_null_keys(df: DataFrame, keys) -> DataFrame:
    """pandas ``groupby`` drops groups whose key is missing (G-7)."""
    return df.na.drop(subset=list(keys))


# ---------------------------------------------------------------- cleaning

def trips_clean(cat: Catalog, null_policy: str = "keep") -> DataFrame:
    return cleaning.clean_trips(cat["trips_messy"], null_policy=null_policy)


def timed_clean(cat: Catalog, null_policy: str = "keep") -> DataFrame:
    return cleaning.clean_trips(cat["trips_timed"], null_policy=null_policy)


def cleaning_audit(cat: Catalog) -> DataFrame:
    return cleaning.cleaning_audit(cat["trips_messy"])


def cleaning_summary(cat: Catalog) -> DataFrame:
    return cleaning.cleaning_summary(cat["trips_messy"])


# ------------------------------------------------------- zone-hour panels

def zone_hour_trip_metrics(trips: DataFrame, grain: str | None = "hour", count_ids: bool = False) -> DataFrame:
    """Observed trips (rows) and completed revenue per (zone, hour) (D-3).

    ``grain="hour"`` truncates the request time (Spark scripts); ``None`` keeps
    the exact timestamp (pandas, SQL and R join on equality), G-2.  ``count_ids``
    counts trips that have an id instead of rows (Spark scripts).
    """
    ts = RU.hour_start("request_timestamp") if grain == "hour" else F.col("request_timestamp")
    keyed = trips.select(F.col("pickup_zone_id").alias("zone_id"), ts.alias("timestamp"),
                         (F.col("trip_id") if count_ids else F.lit(1)).alias("_id"), _completed_fare().alias("_cf"))
    return (_drop_null_keys(keyed, ["zone_id", "timestamp"])
            .groupBy("zone_id", "timestamp")
            .agg(F.count("_id").alias("observed_trips"),
                 # exact fixed-point sum: equal in every engine and partitioning
                 F.coalesce(RU.fixed_sum("_cf"), F.lit(0.0)).alias("completed_revenue")))


def fleet_pressure(cat: Catalog, grain: str | None = "hour", trips: DataFrame | None = None,
                   script: bool = False) -> DataFrame:
    """Demand x zones, with traffic and trip metrics per zone-hour (D-4).
    ``trips``: cleaned trips (default: the cleaned timed trips).  ``script``: the form of the
    Spark scripts, which count trip ids and divide only by a positive number of vehicles."""
    zones = cat["zones"].select("zone_id", "zone_name", "city")
    traffic = cat["traffic"].select("timestamp", "zone_id", "traffic_index")
    metrics = zone_hour_trip_metrics(trips if trips is not None else timed_clean(cat), grain, count_ids=script)
    supply = F.when(F.col("available_vehicles") > 0, F.col("available_vehicles")) if script else F.col("available_vehicles")
    panel = joins.join_dim(cat["demand_supply"], zones, "zone_id", "inner")
    panel = joins.star_assemble(panel, [(traffic, ["timestamp", "zone_id"]),
                                        (metrics, ["timestamp", "zone_id"])])
    return (panel
            .withColumn("_supply", supply)
            .withColumn("demand_supply_ratio", rnd(RU.safe_ratio("ride_requests", "_supply"), 2)).drop("_supply")
            .withColumn("observed_trips", F.coalesce("observed_trips", F.lit(0)).cast("bigint"))
            .withColumn("completed_revenue", rnd(F.coalesce("completed_revenue", F.lit(0.0)), P)))


def vehicle_revenue(cat: Catalog, trips: DataFrame | None = None) -> DataFrame:
    """Trips, completed revenue and average fare per vehicle type (D-5).
    ``trips``: cleaned trips (default: the cleaned order-line trips)."""
    t = trips if trips is not None else trips_clean(cat)
    return (t.groupBy("vehicle_type")
            .agg(F.count("trip_id").alias("trips"),
                 rnd(RU.fixed_sum(_completed_fare()), 2).alias("completed_revenue"),
                 rnd(RU.fixed_avg("fare"), 2).alias("avg_fare"))
            .orderBy(F.col("completed_revenue").desc_nulls_last(), "vehicle_type"))


def ranked_vehicle_revenue(cat: Catalog, trips: DataFrame | None = None) -> DataFrame:
    """D-5 with its order as a column (O-6)."""
    return ranking.global_rank(vehicle_revenue(cat, trips),
                               [F.col("completed_revenue").desc_nulls_last(), F.col("vehicle_type").asc_nulls_first()])


# ---------------------------------------------------------------- quality

def role_tables(cat: Catalog) -> dict[str, DataFrame]:
    names = ["zones", "vehicles", "drivers", "weather", "city_events", "traffic",
             "demand_supply", "trips", "trips_messy"]
    return {n: cat[n] for n in names}


def _trips_once(cat: Catalog) -> None:
    """What reads the trips more than once reads a written copy of the rows behind them.  The suppliers are
    looked up by broadcast where they fit, so that the wide lines are dealt out for orders and parts only."""
    if not cat.given("trip_base", "trips", "trips_messy"):
        supplier = cat["supplier"]
        looked_up = {"supplier": F.broadcast(supplier)} if joins.fits_broadcast(supplier.select("s_suppkey")) else {}
        cat.register("trip_base", written(cat.derive("trip_base", **looked_up), "trip-base", "zstd"))


def duplicate_rows(cat: Catalog) -> DataFrame:
    _trips_once(cat)
    return quality.duplicate_rows(cat["trips_messy"])


def dataset_profile(cat: Catalog) -> DataFrame:
    _trips_once(cat)
    return quality.dataset_profile(role_tables(cat))


def missing_values(cat: Catalog) -> DataFrame:
    return quality.missing_values(role_tables(cat))


FK_RELATIONS = (
    ("trips.driver_id -> drivers.driver_id", "trips", "driver_id", "drivers", "driver_id"),
    ("trips.vehicle_id -> vehicles.vehicle_id", "trips", "vehicle_id", "vehicles", "vehicle_id"),
    ("trips.pickup_zone_id -> zones.zone_id", "trips", "pickup_zone_id", "zones", "zone_id"),
    ("trips.drop_zone_id -> zones.zone_id", "trips", "drop_zone_id", "zones", "zone_id"),
    ("vehicles.home_zone_id -> zones.zone_id", "vehicles", "home_zone_id", "zones", "zone_id"),
    ("drivers.home_zone_id -> zones.zone_id", "drivers", "home_zone_id", "zones", "zone_id"),
    ("events.zone_id -> zones.zone_id", "city_events", "zone_id", "zones", "zone_id"),
)


def fk_integrity(cat: Catalog) -> DataFrame:
    return quality.fk_integrity([(label, cat[c], ck, cat[p], pk) for label, c, ck, p, pk in FK_RELATIONS])


def quality_rule_sets(cat: Catalog):
    c = F.col
    return [
        ("trips", cat["trips"], [
            ("non_positive_distance", c("distance_km") <= 0),
            ("non_positive_fare", c("fare") <= 0),
            ("negative_wait_time", c("wait_time_min") < 0),
            ("negative_duration", c("trip_duration_min") < 0),
            ("pickup_before_request", c("pickup_timestamp") < c("request_timestamp")),
            ("dropoff_before_pickup", c("dropoff_timestamp") < c("pickup_timestamp")),
        ]),
        ("demand_supply", cat["demand_supply"], [
            ("negative_requests", c("ride_requests") < 0),
            ("negative_available_vehicles", c("available_vehicles") < 0),
            ("completed_plus_cancelled_exceeds_requests",
             (c("completed_trips") + c("cancelled_trips")) > c("ride_requests")),
        ]),
        ("traffic", cat["traffic"], [
            ("non_positive_speed", c("avg_speed_kmph") <= 0),
        ]),
    ]


def quality_checks(cat: Catalog) -> DataFrame:
    return quality.quality_checks(quality_rule_sets(cat))


def validation_outcome(cat: Catalog) -> DataFrame:
    return quality.validation_outcome(fk_integrity(cat), quality_checks(cat))


def trips_with_cities(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Pickup zone name/city and drop city via two joins of one dimension (J-4)."""
    out = joins.role_playing_join(trips, zones, "zone_id",
                                  {"pickup_zone_id": "pickup"}, ["zone_name", "city"])
    out = joins.role_playing_join(out, zones, "zone_id", {"drop_zone_id": "drop"}, ["city"])
    return out.withColumn("is_cross_city", RU.differs("pickup_city", "drop_city"))


def kpis(cat: Catalog) -> DataFrame:
    """Seven whole-table KPIs as (metric, value) rows (D-9, A-9)."""
    t = trips_with_cities(cat["trips"], cat["zones"])
    trip_kpis = t.agg(
        rnd(RU.fixed_avg("distance_km"), P).alias("average_distance_km"),
        rnd(RU.fixed_avg("fare"), P).alias("average_fare_inr"),
        rnd(RU.fixed_avg("wait_time_min"), P).alias("average_wait_min"),
        rnd(F.avg(RU.is_status("status", RU.CANCELLED)), P).alias("cancellation_rate"),
        rnd(F.coalesce(RU.fixed_sum(F.when(F.col("status") == RU.COMPLETED, F.col("fare"))), F.lit(0.0)), P)
        .alias("completed_revenue_inr"),
        rnd(F.avg(F.col("is_cross_city").cast("int")), P).alias("cross_city_trip_share"),
    )
    names = [c for c in trip_kpis.columns]
    long = trip_kpis.unpivot([], names, "metric", "value")
    ds = cat["demand_supply"].agg(
        rnd(RU.fixed_avg(RU.safe_ratio("ride_requests", "available_vehicles")), P).alias("value")
    ).select(F.lit("average_demand_supply_ratio").alias("metric"), "value")
    return long.unionByName(ds)


def raw_city_metrics(cat: Catalog) -> DataFrame:
    """Per pickup city on raw trips, keeping the null city (D-10, A-11)."""
    t = joins.join_dim(cat["trips"], cat["zones"].select(F.col("zone_id").alias("pickup_zone_id"), "city"),
                       "pickup_zone_id", "left")
    return t.groupBy("city").agg(F.count(F.lit(1)).alias("trips"),
                                 rnd(RU.fixed_avg("wait_time_min"), P).alias("avg_wait_min"),
                                 rnd(RU.fixed_avg("fare"), P).alias("avg_fare"))


def raw_vehicle_metrics(cat: Catalog) -> DataFrame:
    """Per vehicle type on raw trips, null type dropped (D-10, A-12)."""
    t = _drop_null_keys(cat["trips"], ["vehicle_type"])
    return t.groupBy("vehicle_type").agg(F.count(F.lit(1)).alias("trips"),
                                         rnd(RU.fixed_avg("fare"), P).alias("avg_fare"),
                                         rnd(RU.fixed_avg("wait_time_min"), P).alias("avg_wait_min"))


# ------------------------------------------------------ opportunity score

SCORE_MEASURES = {
    "demand_supply_ratio": "demand_pressure_score",
    "cancellation_rate": "cancellation_pressure_score",
    "avg_wait_time_min": "wait_pressure_score",
    "completed_revenue": "revenue_opportunity_score",
    "supply_adequacy": "fleet_adequacy_score",
}

OPPORTUNITY_COLUMNS = [
    "timestamp", "hour", "city", "zone_id", "zone_name", "ride_requests", "available_vehicles",
    "demand_supply_ratio", "cancelled_trips", "cancellation_rate", "avg_wait_time_min", "traffic_index",
    "rainfall_mm", "weather_condition", "completed_revenue", "recommended_vehicle_type",
    "demand_pressure_score", "cancellation_pressure_score", "wait_pressure_score",
    "revenue_opportunity_score", "fleet_adequacy_score", "mobility_opportunity_score", "priority_band",
]


def vehicle_mix(trips: DataFrame) -> DataFrame:
    """Most requested vehicle type per (zone, hour of day) over the whole
    period; ties to the alphabetically first type (W-2)."""
    counts = (_drop_null_keys(trips.select(F.col("pickup_zone_id").alias("zone_id"),
                                           RU.hour_of_day("request_timestamp").alias("hour"),
                                           "vehicle_type"), ["zone_id", "hour", "vehicle_type"])
              .groupBy("zone_id", "hour", "vehicle_type").agg(F.count(F.lit(1)).alias("vehicle_type_trips")))
    return ranking.top1_per_group(counts, ["zone_id", "hour"], "vehicle_type_trips", "vehicle_type",
                                  "recommended_vehicle_type")


def zone_hour_vehicle_counts(trips: DataFrame) -> DataFrame:
    """Trips and completed revenue per (zone, request time, vehicle type).

    The one pre-aggregation of the trip fact that both the zone-hour metrics
    and the vehicle mix re-aggregate (``opportunity_panel`` persists it so the
    trips are de-duplicated and shuffled once).  Null keys stay as groups
    here; they never match the panel's join keys.
    """
    return trips.groupBy(F.col("pickup_zone_id").alias("zone_id"), F.col("request_timestamp").alias("timestamp"),
                         "vehicle_type").agg(F.count(F.lit(1)).alias("_n"),
                                             F.sum(RU.fixed_units(_completed_fare())).alias("_rev"))


def zone_hour_star(cat: Catalog, counts: DataFrame | None = None) -> DataFrame:
    """The zone-hour panel: demand with zone, traffic, weather, trip metrics
    and vehicle mix, all left joins, grain = demand rows (J-9, J-10)."""
    counts = counts if counts is not None else zone_hour_vehicle_counts(timed_clean(cat))
    metrics = counts.groupBy("zone_id", "timestamp").agg(
        F.sum("_n").alias("observed_trips"),
        F.coalesce(RU.from_units(F.sum("_rev")), F.lit(0.0)).alias("completed_revenue"))
    mix = ranking.top1_per_group(
        counts.groupBy("zone_id", RU.hour_of_day("timestamp").alias("hour"), "vehicle_type")
        .agg(F.sum("_n").alias("vehicle_type_trips")),
        ["zone_id", "hour"], "vehicle_type_trips", "vehicle_type", "recommended_vehicle_type")
    zones = cat["zones"].select("zone_id", "zone_name", "city")
    traffic = cat["traffic"].select("timestamp", "zone_id", "traffic_index")
    weather = cat["weather"].select("timestamp", "rainfall_mm", "weather_condition")
    panel = joins.join_dim(cat["demand_supply"], zones, "zone_id", "left")
    panel = joins.star_assemble(panel, [(traffic, ["timestamp", "zone_id"]),
                                        (weather, ["timestamp"]),
                                        (metrics, ["timestamp", "zone_id"])])
    panel = panel.withColumn("hour", RU.hour_of_day("timestamp"))
    return panel.join(mix.drop("vehicle_type_trips"), ["zone_id", "hour"], "left")


def opportunity_panel(cat: Catalog) -> DataFrame:
    """Star plus the three row ratios, written to the shared folder: the rank
    index reads its five measures, the result the rest.

    The trip pre-aggregate feeds two branches of the star whose pushed-down
    null filters differ, so Spark would not reuse its exchange; it is persisted
    for the duration of the write so the trips are de-duplicated and
    shuffled once (a lost block is recomputed from lineage)."""
    counts = zone_hour_vehicle_counts(timed_clean(cat)).persist(StorageLevel.MEMORY_AND_DISK)
    p = (zone_hour_star(cat, counts)
         .withColumn("observed_trips", F.coalesce("observed_trips", F.lit(0)).cast("bigint"))
         .withColumn("completed_revenue", F.coalesce("completed_revenue", F.lit(0.0)))
         .withColumn("demand_supply_ratio", RU.safe_ratio("ride_requests", "available_vehicles"))
         .withColumn("cancellation_rate", RU.safe_ratio("cancelled_trips", "ride_requests"))
         .withColumn("supply_adequacy", RU.safe_ratio("available_vehicles", "ride_requests")))
    try:
        return written(p, "opportunity-panel")
    finally:
        counts.unpersist()


def opportunity_scores(cat: Catalog) -> DataFrame:
    """Zone-hour Mobility Opportunity Score, 23 columns (D-12)."""
    panel = opportunity_panel(cat)
    scored = ranking.percentile_scores(panel, SCORE_MEASURES)
    scored = (scored
              .withColumn("mobility_opportunity_score",
                          RU.weighted_composite(RU.SCORE_WEIGHTS, RU.SCORE_DIVISOR))
              .withColumn("priority_band", RU.band("mobility_opportunity_score"))
              .withColumn("recommended_vehicle_type",
                          F.coalesce("recommended_vehicle_type", F.lit(RU.NO_MIX_LABEL))))
    return scored.select(*OPPORTUNITY_COLUMNS)


def fleet_recommendations(cat: Catalog, scores: DataFrame | None = None, exact: bool = False) -> DataFrame:
    """Per (city, zone, hour of day, vehicle type): average score, critical
    hours and average pressures, with an action text (D-13).  ``exact`` keeps the unrounded score in ``_score``."""
    s = scores if scores is not None else opportunity_scores(cat)
    keys = ["city", "zone_id", "zone_name", "hour", "recommended_vehicle_type"]
    g = _drop_null_keys(s, keys).groupBy(*keys).agg(
        RU.fixed_avg("mobility_opportunity_score").alias("_score"),
        F.count_if(F.col("priority_band") == RU.TOP_BAND).alias("critical_hours"),
        rnd(RU.fixed_avg("demand_supply_ratio"), P).alias("avg_demand_supply_ratio"),
        rnd(RU.fixed_avg("avg_wait_time_min"), P).alias("avg_wait_time_min"),
        rnd(RU.fixed_avg("cancellation_rate"), P).alias("avg_cancellation_rate"),
        rnd(RU.fixed_avg("completed_revenue"), P).alias("avg_completed_revenue"),
    )
    return (g.withColumn("avg_opportunity_score", rnd("_score", P))
            .withColumn("recommended_action", RU.action_text("_score"))
            .orderBy(*recommendation_order()).drop(*([] if exact else ["_score"])))


def recommendation_order() -> list:
    """Best score first, by its exact value; ties by critical hours, then by the keys."""
    return [F.col("_score").desc_nulls_last(), F.col("critical_hours").desc(), "city", "zone_id", "zone_name", "hour",
            "recommended_vehicle_type"]


def top_recommendations(cat: Catalog, k: int = 20, recommendations: DataFrame | None = None) -> DataFrame:
    """The best ``k`` recommendations (D-14), ranked on unrounded scores."""
    rec = recommendations if recommendations is not None else fleet_recommendations(cat, exact=True)
    return ranking.top_k(rec, recommendation_order(), k).drop("_score")


# --------------------------------------------------------------------- EDA

def eda_base(cat: Catalog, trips: DataFrame | None = None) -> DataFrame:
    """One pre-aggregate of the cleaned trips that every zone, city, vehicle and
    corridor table re-aggregates: per (pickup zone, drop zone, vehicle type)
    the trip and cancellation counts and exact fixed-point partial sums.

    Trips are shuffled once, to this grain; the zone joins then run on the
    aggregate, not on every trip row.  Null keys stay as groups.
    """
    t = trips if trips is not None else trips_clean(cat)
    return t.groupBy("pickup_zone_id", "drop_zone_id", "vehicle_type").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("status") == RU.CANCELLED).alias("_cancel"),
        F.sum(RU.fixed_units("wait_time_min")).alias("_wait_u"), F.count("wait_time_min").alias("_wait_n"),
        F.sum(RU.fixed_units("fare")).alias("_fare_u"), F.count("fare").alias("_fare_n"),
        F.sum(RU.fixed_units(_completed_fare())).alias("_rev_u"))


def _mean_units(units: str, n: str):
    """Same arithmetic as ``rules.fixed_avg`` from summed units and counts."""
    total_n = F.sum(n)
    return F.when(total_n > 0, F.sum(units).cast("double") / total_n.cast("double") / F.lit(1e6))


def _base_measures(*names: str):
    m = {
        "trips": F.sum("_n").alias("trips"),
        "cancellation_rate": rnd(F.sum("_cancel").cast("double") / F.sum("_n").cast("double"), P)
        .alias("cancellation_rate"),
        "avg_wait_min": rnd(_mean_units("_wait_u", "_wait_n"), P).alias("avg_wait_min"),
        "avg_fare": rnd(_mean_units("_fare_u", "_fare_n"), P).alias("avg_fare"),
        "completed_revenue": rnd(F.coalesce(RU.from_units(F.sum("_rev_u")), F.lit(0.0)), P)
        .alias("completed_revenue"),
    }
    return [m[n] for n in names]


_TRIP_MEASURES = ("trips", "cancellation_rate", "avg_wait_min", "completed_revenue")


def _base_with_cities(cat: Catalog, base: DataFrame | None = None) -> DataFrame:
    return trips_with_cities(base if base is not None else eda_base(cat), cat["zones"])


def eda_hourly(cat: Catalog) -> DataFrame:
    t = timed_clean(cat).withColumn("hour", RU.hour_of_day("request_timestamp"))
    return (_drop_null_keys(t, ["hour"]).groupBy("hour")
            .agg(F.count(F.lit(1)).alias("trips"), rnd(RU.fixed_avg("wait_time_min"), P).alias("avg_wait_min")))


def eda_city(cat: Catalog, base: DataFrame | None = None) -> DataFrame:
    """Per pickup city, reindexed to the fixed city list (D-16, J-11, O-5)."""
    t = _drop_null_keys(_base_with_cities(cat, base), ["pickup_city"])
    agg = t.groupBy("pickup_city").agg(*_base_measures(*_TRIP_MEASURES))
    return joins.reindex_categories(agg, "pickup_city", CITY_ORDER)


def eda_vehicle(cat: Catalog, base: DataFrame | None = None) -> DataFrame:
    b = _drop_null_keys(base if base is not None else eda_base(cat), ["vehicle_type"])
    return (b.groupBy("vehicle_type").agg(*_base_measures("trips", "completed_revenue", "avg_fare"))
            .orderBy(F.col("completed_revenue").desc(), "vehicle_type"))


def eda_zone(cat: Catalog, base: DataFrame | None = None) -> DataFrame:
    keys = ["pickup_zone_id", "pickup_zone_name", "pickup_city"]
    t = _drop_null_keys(_base_with_cities(cat, base), keys)
    return t.groupBy(*keys).agg(*_base_measures(*_TRIP_MEASURES)).orderBy(F.col("trips").desc(), "pickup_zone_id")


def eda_corridors(cat: Catalog, base: DataFrame | None = None) -> DataFrame:
    keys = ["pickup_city", "drop_city"]
    t = _drop_null_keys(_base_with_cities(cat, base).where("is_cross_city"), keys)
    return (t.groupBy(*keys).agg(*_base_measures("trips", "avg_wait_min", "completed_revenue"))
            .orderBy(F.col("trips").desc(), *keys))


def eda_corridors_top6(cat: Catalog, k: int = 6, base: DataFrame | None = None) -> DataFrame:
    c = eda_corridors(cat, base).withColumn("corridor", RU.corridor_label("pickup_city", "drop_city"))
    return ranking.top_k(c, [F.col("trips").desc(), "pickup_city", "drop_city"], k)


def headline_findings(cat: Catalog, base: DataFrame | None = None) -> DataFrame:
    """EDA headline as (finding, rank, label, value) rows (D-19).

    Six findings read the same trip pre-aggregate; it is checkpointed once
    (it is small: zone pairs x vehicle types) instead of cleaning the trips
    once per finding."""
    def row(df, finding, label, value, rank=None):
        # the three zone tables say which city a zone is in
        return df.select(F.lit(finding).alias("finding"),
                         (F.col(rank) if rank else F.lit(1)).cast("int").alias("rank"),
                         F.col(label).cast("string").alias("label"),
                         (F.col("pickup_city") if rank else F.lit(None)).cast("string").alias("pickup_city"),
                         F.col(value).cast("double").alias("value"))

    if base is None:
        ensure_checkpoint_dir(cat.spark)
        base = eda_base(cat).checkpoint(eager=True)
    hourly = eda_hourly(cat).withColumn("hour_label", F.concat(F.lpad(F.col("hour").cast("string"), 2, "0"),
                                                               F.lit(":00")))
    peak = row(ranking.arg_extreme(hourly, "trips", ["hour"]), "peak_hour", "hour_label", "trips")
    city = eda_city(cat, base)
    market = row(ranking.arg_extreme(city, "trips", ["position"]), "largest_market", "pickup_city", "trips")
    veh = row(ranking.arg_extreme(eda_vehicle(cat, base), "completed_revenue", ["vehicle_type"]),
              "top_revenue_vehicle", "vehicle_type", "completed_revenue")
    cross = _base_with_cities(cat, base)
    share = cross.agg(rnd(F.sum(F.when(F.col("is_cross_city"), F.col("_n")).otherwise(F.lit(0))).cast("double")
                          / F.sum("_n").cast("double"), P).alias("value")) \
        .select(F.lit("cross_city_share").alias("finding"), F.lit(1).alias("rank"),
                F.lit(None).cast("string").alias("label"), F.lit(None).cast("string").alias("pickup_city"), "value")
    zone = eda_zone(cat, base)
    top_demand = row(ranking.nlargest(zone, "trips", 5, ["pickup_zone_id"]), "top_demand_zone",
                     "pickup_zone_name", "trips", "rank")
    top_wait = row(ranking.nlargest(zone, "avg_wait_min", 5, ["pickup_zone_id"]), "longest_wait_zone",
                   "pickup_zone_name", "avg_wait_min", "rank")
    zc = zone.withColumn("cancellation_pct", rnd(F.col("cancellation_rate") * 100, P))
    top_cancel = row(ranking.nlargest(zc, "cancellation_pct", 5, ["pickup_zone_id"]), "highest_cancel_zone",
                     "pickup_zone_name", "cancellation_pct", "rank")
    out = peak
    for f in (market, veh, share, top_demand, top_wait, top_cancel):
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------------- study

def analysis_set(cat: Catalog) -> DataFrame:
    """Trips with zone-hour traffic and hourly weather, complete cases only (D-24)."""
    t = timed_clean(cat).select("trip_id", "request_timestamp", "pickup_zone_id", "wait_time_min", "status") \
        .withColumn("cancelled", RU.is_status("status", RU.CANCELLED))
    t = joins.update_join_last(t, cat["traffic"], {"pickup_zone_id": "zone_id", "request_timestamp": "timestamp"},
                               ["congestion_level", "avg_speed_kmph", "traffic_index"], order_by="traffic_index")
    t = joins.update_join_last(t, cat["weather"], {"request_timestamp": "timestamp"},
                               ["rainfall_mm", "visibility_km", "weather_condition"], order_by="rainfall_mm")
    return t.na.drop(subset=["traffic_index", "rainfall_mm", "visibility_km", "weather_condition",
                             "wait_time_min"])


def study_base(cat: Catalog, data: DataFrame | None = None) -> DataFrame:
    """Pre-aggregate of the analysis set per (congestion level, weather
    condition): both summaries re-aggregate it, so the trip-level join runs
    once.  Partial sums are exact fixed-point units."""
    a = data if data is not None else analysis_set(cat)
    return a.groupBy("congestion_level", "weather_condition").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("cancelled").alias("_cancel"),
        F.sum(RU.fixed_units("wait_time_min")).alias("_wait_u"), F.count("wait_time_min").alias("_wait_n"),
        F.sum(RU.fixed_units("traffic_index")).alias("_traffic_u"), F.count("traffic_index").alias("_traffic_n"),
        F.sum(RU.fixed_units("rainfall_mm")).alias("_rain_u"), F.count("rainfall_mm").alias("_rain_n"))


def _study_measures(extra_units: str, extra_n: str, extra_name: str):
    return [F.sum("_n").alias("trips"),
            rnd(F.sum("_cancel").cast("double") / F.sum("_n").cast("double"), 6).alias("cancellation_rate"),
            rnd(_mean_units("_wait_u", "_wait_n"), P).alias("avg_wait_time_min"),
            rnd(_mean_units(extra_units, extra_n), P).alias(extra_name)]


def cancel_by_congestion(cat: Catalog, base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else study_base(cat)
    g = b.groupBy("congestion_level").agg(*_study_measures("_traffic_u", "_traffic_n", "avg_traffic_index"))
    return ranking.explicit_order(g, "congestion_level", CONGESTION_ORDER).orderBy(
        F.col("position").asc_nulls_last(), "congestion_level")


def cancel_by_weather(cat: Catalog, base: DataFrame | None = None) -> DataFrame:
    b = base if base is not None else study_base(cat)
    return b.groupBy("weather_condition").agg(*_study_measures("_rain_u", "_rain_n", "avg_rainfall_mm")) \
        .orderBy(F.col("cancellation_rate").desc(), "weather_condition")


MODEL_NUMERIC = ("traffic_index", "rainfall_mm", "visibility_km")
MODEL_FACTORS = ("weather_condition",)


def logit_coefficients(cat: Catalog, sample_size: int | None = None) -> DataFrame:
    """Cancellation logit on every analysis row (or on the seeded sample) (D-27)."""
    a = analysis_set(cat)
    if sample_size is not None:
        a = stats.seeded_sample(a, "trip_id", sample_size)
    return stats.logit_coefficients(a, "cancelled", MODEL_NUMERIC, MODEL_FACTORS)


def study_model_headline(cat: Catalog) -> DataFrame:
    """The model half of the study headline (D-28): traffic-index odds ratio
    per one-point increase and its p-value, from the coefficient table."""
    return logit_coefficients(cat).where(F.col("term") == "traffic_index").select(
        F.lit("traffic_index_odds_ratio").alias("finding"), "odds_ratio", "p_value")


def logit_fit(cat: Catalog) -> DataFrame:
    return stats.logit_fit_summary(analysis_set(cat), "cancelled", MODEL_NUMERIC, MODEL_FACTORS)


def seeded_sample(cat: Catalog, n: int = stats.SAMPLE_CAP) -> DataFrame:
    """The analysis set is written once: the sample reads it several times."""
    return stats.seeded_sample(written(analysis_set(cat), "analysis-set"), "trip_id", n)


def study_headline(cat: Catalog) -> DataFrame:
    """Highest and lowest congestion level by cancellation, the gap in
    percentage points, and the worst weather (D-28); the odds ratio is in
    ``logit_coefficients``."""
    ensure_checkpoint_dir(cat.spark)
    base = study_base(cat).checkpoint(eager=True)  # levels x conditions rows
    cong = cancel_by_congestion(cat, base)
    wea = cancel_by_weather(cat, base)
    hi = cong.orderBy(F.col("cancellation_rate").desc(), F.col("position").asc_nulls_last(), "congestion_level").limit(1)
    lo = cong.orderBy(F.col("cancellation_rate").asc(), F.col("position").asc_nulls_last(), "congestion_level").limit(1)
    w = wea.orderBy(F.col("cancellation_rate").desc(), "weather_condition").limit(1)
    gap = cong.agg(rnd((F.max("cancellation_rate") - F.min("cancellation_rate")) * 100, P).alias("value")) \
        .select(F.lit("congestion_gap_pp").alias("finding"), F.lit(None).cast("string").alias("label"), "value")

    def pick(df, finding, label):
        return df.select(F.lit(finding).alias("finding"), F.col(label).alias("label"),
                         rnd(F.col("cancellation_rate") * 100, P).alias("value"))

    return (pick(hi, "highest_congestion_cancellation", "congestion_level")
            .unionByName(pick(lo, "lowest_congestion_cancellation", "congestion_level"))
            .unionByName(gap)
            .unionByName(pick(w, "highest_weather_cancellation", "weather_condition")))


# ------------------------------------------------------------------- gates

def data_gates(cat: Catalog) -> DataFrame:
    """Gates of the notebook and the R study as (gate, checked, failed, passed) (D-29)."""
    clean = trips_clean(cat)
    fp = fleet_pressure(cat)
    return (quality.gate("no_non_positive_fare_or_distance", clean, RU.non_positive_any(["distance_km", "fare"]))
            .unionByName(quality.gate("demand_supply_ratio_present", fp, F.col("demand_supply_ratio").isNull(),
                                      allow=F.col("available_vehicles") == 0))
            .unionByName(quality.non_empty_gate("analysis_set_not_empty", analysis_set(cat))))
