"""Role-view counts of SURVEY §5.3 and the driver entry points."""

import pyspark.sql.functions as F

from conftest import SF_SMALL
from zonecast.plans import products as PR
from zonecast.sources.catalog import Catalog


def test_role_counts_sf0001(spark):
    cat = Catalog(spark, SF_SMALL)
    assert cat["trips_messy"].count() == 6116
    assert cat["trips_messy"].distinct().count() == 6000
    assert PR.trips_clean(cat).count() == 5729
    ds = cat["demand_supply"]
    assert ds.count() == 951 and ds.where("available_vehicles = 0").count() == 560
    levels = {r["congestion_level"]: r["count"] for r in cat["traffic"].groupBy("congestion_level").count().collect()}
    assert levels == {"Low": 34, "Medium": 25, "High": 58, "Severe": 91}


def test_audit_matches_clean_count(spark):
    cat = Catalog(spark, SF_SMALL)
    audit = PR.cleaning_audit(cat).orderBy("step_no").collect()
    assert [r["rows_remaining"] for r in audit][:2] == [6000, 5729]
    assert audit[0]["affected_records"] == 116


def test_star_keeps_panel_grain_and_scores_in_range(spark):
    cat = Catalog(spark, SF_SMALL)
    assert PR.zone_hour_star(cat).count() == cat["demand_supply"].count()
    s = PR.opportunity_scores(cat)
    assert s.count() == 951 and len(s.columns) == 23
    r = s.agg(F.min("mobility_opportunity_score").alias("lo"), F.max("mobility_opportunity_score").alias("hi"),
              F.avg("demand_pressure_score").alias("m"), F.count("demand_pressure_score").alias("n")).first()
    assert 0 <= r["lo"] <= r["hi"] <= 100
    assert abs(r["m"] - 50 * (r["n"] + 1) / r["n"]) < 1e-9
    bands = {x["priority_band"] for x in s.select("priority_band").distinct().collect()}
    assert bands <= {"Stable", "Monitor", "Intervention", "Critical"}


def test_entry_and_registry(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    own = {n for n in q if n != "pipeline" and not (n.startswith("op") and n[2:3].isdigit())}
    assert own <= set(o)
