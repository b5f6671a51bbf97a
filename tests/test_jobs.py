"""Whole-script jobs write their outputs and report consistent counts."""

from conftest import SF_SMALL
from zonecast.plans import jobs
from zonecast.session import scratch_path


def test_all_jobs_run_and_agree(spark):
    out = scratch_path(spark, "jobs")
    v = jobs.validation_job(spark, SF_SMALL, f"{out}/validation")
    assert set(v) == {"integrity_failures", "failed_quality_rules"}
    c = jobs.cleaning_job(spark, SF_SMALL, f"{out}/cleaning")
    assert c == {"source_rows": 6116, "cleaned_rows": 5729, "written_rows": 5729}
    e = jobs.eda_job(spark, SF_SMALL, f"{out}/eda")
    assert spark.read.option("header", True).csv(e["city_metrics"]).count() == 4
    s = jobs.sql_job(spark, SF_SMALL, f"{out}/sql")
    assert s["trips"] == 5729 and s["demand_supply"] == 951
    o = jobs.opportunity_job(spark, SF_SMALL, f"{out}/opportunity")
    assert o["scored_zone_hours"] == 951 and o["top_zone"] is not None
    st = jobs.study_job(spark, SF_SMALL, f"{out}/study")
    assert st["analysis_rows"] > 0 and st["traffic_index_odds_ratio"] > 0
    sp = jobs.spark_scripts_job(spark, SF_SMALL, f"{out}/spark")
    assert sp["fleet_pressure_rows"] == 951
    nb = jobs.notebook_job(spark, SF_SMALL, f"{out}/notebook")
    assert nb["no_non_positive_fare_or_distance"] == (5729, 0)


def test_materialize_replaces_the_role_with_its_written_copy(spark):
    from zonecast.sources.catalog import Catalog
    cat = Catalog(spark, SF_SMALL)
    path = scratch_path(spark, "materialized-trips")
    df = cat.materialize("trips", path)
    assert cat["trips"] is df and df.count() == 6000
    assert "trips" in cat._overridden     # roles built on it are not shared across catalogs
