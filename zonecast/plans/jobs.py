"""Whole-script equivalents: each job computes the products one of the
reference's scripts produces and writes them under ``out_dir`` (shared
storage on a cluster).  Jobs write first and read back for the counts they
report, so no plan runs twice.

Each returns a small dict of counts or paths (bounded), never data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from zonecast.functions import rules as RU
from zonecast.operators import cleaning, quality, stats
from zonecast.plans import named_sql
from zonecast.plans import products as PR
from zonecast.session import written
from zonecast.sources import sinks
from zonecast.sources.catalog import Catalog


def _out(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"


def validation_job(spark: SparkSession, data_dir: str, out_dir: str) -> dict:
    """Profile, missing values, key integrity, quality rules, raw metrics, KPIs."""
    cat = Catalog(spark, data_dir)
    cat.materialize("trips", _out(out_dir, "_trips"))   # six reports read it: derive it once
    profile, missing = quality.profile_and_missing(PR.role_tables(cat))   # one pass per table for both
    outputs = {
        "dataset_profile": profile,
        "missing_values": missing,
        "referential_integrity": PR.fk_integrity(cat),
        "quality_checks": PR.quality_checks(cat),
        "city_metrics": PR.raw_city_metrics(cat),
        "vehicle_metrics": PR.raw_vehicle_metrics(cat),
    }
    for name, df in outputs.items():
        sinks.write_csv(df, _out(out_dir, name))
    sinks.write_json(PR.kpis(cat), _out(out_dir, "kpis"))
    back_integrity = sinks.read_csv(spark, _out(out_dir, "referential_integrity"), outputs["referential_integrity"].schema)
    back_quality = sinks.read_csv(spark, _out(out_dir, "quality_checks"), outputs["quality_checks"].schema)
    outcome = {r["outcome"]: int(r["value"]) for r in quality.validation_outcome(back_integrity, back_quality).collect()}
    return outcome


def cleaning_job(spark: SparkSession, data_dir: str, out_dir: str) -> dict:
    """Cleaned trips (parquet), audit (CSV) and summary (JSON).

    The trips are de-duplicated once: distinct rows with their multiplicity
    are written, and all three outputs are derived from that table."""
    cat = Catalog(spark, data_dir)
    sinks.write_parquet(cleaning.distinct_with_multiplicity(cat["trips_messy"]), _out(out_dir, "_distinct_trips"))
    distinct = spark.read.parquet(_out(out_dir, "_distinct_trips"))
    sinks.write_parquet(cleaning.clean_distinct(distinct), _out(out_dir, "trips_cleaned"))
    sinks.write_csv(cleaning.cleaning_audit(distinct), _out(out_dir, "cleaning_audit"))
    sinks.write_json(cleaning.cleaning_summary(distinct), _out(out_dir, "cleaning_summary"))
    summary = spark.read.json(_out(out_dir, "cleaning_summary")).first().asDict()
    return {"source_rows": int(summary["source_rows"]), "cleaned_rows": int(summary["cleaned_rows"]),
            "written_rows": spark.read.parquet(_out(out_dir, "trips_cleaned")).count()}


def eda_job(spark: SparkSession, data_dir: str, out_dir: str) -> dict:
    """Hourly, city, vehicle, zone and corridor tables plus the headline findings."""
    cat = Catalog(spark, data_dir)
    # every table below re-aggregates one trip pre-aggregate: write it once
    sinks.write_parquet(PR.eda_base(cat), _out(out_dir, "_trip_aggregate"))
    base = spark.read.parquet(_out(out_dir, "_trip_aggregate"))
    outputs = {
        "hourly_metrics": PR.eda_hourly(cat), "city_metrics": PR.eda_city(cat, base),
        "vehicle_metrics": PR.eda_vehicle(cat, base), "zone_metrics": PR.eda_zone(cat, base),
        "cross_city_corridors": PR.eda_corridors(cat, base), "top_corridors": PR.eda_corridors_top6(cat, base=base),
        "headline_findings": PR.headline_findings(cat, base),
    }
    for name, df in outputs.items():
        sinks.write_csv(df, _out(out_dir, name))
    return {name: _out(out_dir, name) for name in outputs}


def sql_job(spark: SparkSession, data_dir: str, out_dir: str) -> dict:
    """The five named queries exported as CSV, plus the row-count manifest."""
    cat = Catalog(spark, data_dir)
    # the cleaned trips are loaded once, as the reference loads them into its database once
    sinks.write_parquet(PR.trips_clean(cat), _out(out_dir, "_trips_cleaned"))
    sinks.write_parquet(PR.timed_clean(cat), _out(out_dir, "_timed_trips_cleaned"))
    frames = {"demand_supply": cat["demand_supply"], "zones": cat["zones"], "traffic": cat["traffic"],
              "trips": spark.read.parquet(_out(out_dir, "_trips_cleaned")),
              "timed_trips": spark.read.parquet(_out(out_dir, "_timed_trips_cleaned"))}
    named_sql.run_all(spark, frames, _out(out_dir, "queries"))
    manifest = quality.union_all([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
        for n, df in (("trips", frames["trips"]), ("demand_supply", frames["demand_supply"]),
                      ("traffic", frames["traffic"]))])
    return {r["table_name"]: int(r["rows"]) for r in manifest.collect()}


def opportunity_job(spark: SparkSession, data_dir: str, out_dir: str) -> dict:
    """Zone-hour scores, recommendations and the top 20."""
    cat = Catalog(spark, data_dir)
    sinks.write_parquet(PR.opportunity_scores(cat), _out(out_dir, "zone_hour_opportunity_scores"))
    scores = spark.read.parquet(_out(out_dir, "zone_hour_opportunity_scores"))
    exact = written(PR.fleet_recommendations(cat, scores, exact=True), "recommendations")
    sinks.write_csv(exact.drop("_score"), _out(out_dir, "zone_hour_fleet_recommendations"))
    top = PR.top_recommendations(cat, recommendations=exact)
    sinks.write_csv(top, _out(out_dir, "top_recommendations"))
    first = sinks.read_csv(spark, _out(out_dir, "top_recommendations"), top.schema).where(F.col("rank") == 1).first()
    return {"scored_zone_hours": scores.count(),
            "top_zone": None if first is None else first["zone_name"],
            "top_hour": None if first is None else int(first["hour"])}


def study_job(spark: SparkSession, data_dir: str, out_dir: str, sample_size: int | None = None) -> dict:
    """Cancellation by congestion and weather, the logit table and the headline."""
    cat = Catalog(spark, data_dir)
    sinks.write_parquet(PR.analysis_set(cat), _out(out_dir, "analysis_set"))
    data = spark.read.parquet(_out(out_dir, "analysis_set"))
    n = data.count()
    if n == 0:
        raise ValueError("no trip matched traffic and weather data")
    base = PR.study_base(cat, data)
    sinks.write_csv(PR.cancel_by_congestion(cat, base), _out(out_dir, "cancellation_by_congestion"))
    sinks.write_csv(PR.cancel_by_weather(cat, base), _out(out_dir, "cancellation_by_weather"))
    model_data = stats.seeded_sample(data, "trip_id", sample_size) if sample_size else data
    coef = stats.logit_coefficients(model_data, "cancelled", PR.MODEL_NUMERIC, PR.MODEL_FACTORS)
    sinks.write_csv(coef, _out(out_dir, "cancellation_logistic_regression"))
    odds = coef.where(F.col("term") == "traffic_index").first()
    return {"analysis_rows": n, "traffic_index_odds_ratio": None if odds is None else float(odds["odds_ratio"])}


def spark_scripts_job(spark: SparkSession, data_dir: str, out_dir: str) -> dict:
    """The two spark-submit scripts: cleaned trips to parquet, then fleet
    pressure and vehicle revenue read from it."""
    cat = Catalog(spark, data_dir)
    # the scripts keep only rows with both measures positive, count trip ids and divide by positive numbers only
    sinks.write_parquet(PR.timed_clean(cat, null_policy="drop"), _out(out_dir, "trips_cleaned"))
    cleaned = spark.read.parquet(_out(out_dir, "trips_cleaned"))
    sinks.write_parquet(PR.fleet_pressure(cat, trips=cleaned, script=True), _out(out_dir, "fleet_pressure"))
    sinks.write_parquet(PR.vehicle_revenue(cat, trips=cleaned), _out(out_dir, "vehicle_revenue"))
    return {"cleaned_rows": cleaned.count(),
            "fleet_pressure_rows": spark.read.parquet(_out(out_dir, "fleet_pressure")).count()}


def notebook_job(spark: SparkSession, data_dir: str, out_dir: str, table_prefix: str = "zonecast",
                 fmt: str = "parquet") -> dict:
    """Tables with a prefix plus folder copies, then the data gates (raise on failure)."""
    cat = Catalog(spark, data_dir)
    bad_measure = RU.non_positive_any(["distance_km", "fare"])
    no_ratio = F.col("demand_supply_ratio").isNull() & ~F.coalesce(F.col("available_vehicles") == 0, F.lit(False))
    rows: dict[str, tuple[int, int]] = {}
    for name, df, gate, failing in (
            ("trips_cleaned", PR.trips_clean(cat), "no_non_positive_fare_or_distance", bad_measure),
            ("fleet_pressure", PR.fleet_pressure(cat), "demand_supply_ratio_present", no_ratio)):
        # the gate's counts ride on the write of the table that it checks
        _, _, seen = sinks.save_table(df, f"{table_prefix}_{name}", _out(out_dir, name), fmt, quality.gate_counts(failing))
        rows[gate] = (seen["checked"], seen["failed"])
    failed = [g for g, (_, n) in rows.items() if n]
    if failed:
        raise AssertionError(f"data gates failed: {', '.join(failed)}")
    return rows
