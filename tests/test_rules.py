"""Column rules on hand-made frames: each ledger item of SURVEY §2.13."""

import datetime as dt


from zonecast.functions import rules as RU


def _vals(df, col):
    return [r[col] for r in df.collect()]


def test_non_positive_keeps_null_and_positive_all_drops_it(spark):
    df = spark.createDataFrame([(1, 5.0, 3.0), (2, 0.0, 3.0), (3, -1.0, 3.0), (4, None, 3.0),
                                (5, 5.0, 0.0), (6, 5.0, None), (7, None, -2.0)], "id int, d double, f double")
    keep = df.where(~RU.non_positive_any(["d", "f"]))
    drop = df.where(RU.positive_all(["d", "f"]))
    assert sorted(_vals(keep, "id")) == [1, 4, 6]
    assert sorted(_vals(drop, "id")) == [1]


def test_canonical_label_is_exact_and_case_sensitive(spark):
    df = spark.createDataFrame([("upi",), ("UPI",), ("Upi",), (None,)], "p string")
    out = _vals(df.select(RU.canonical_label("p", {"upi": "UPI"}).alias("p")), "p")
    assert out == ["UPI", "UPI", "Upi", None]


def test_safe_ratio_zero_null_negative(spark):
    df = spark.createDataFrame([(4, 2), (4, 0), (0, 0), (4, None), (3, -2)], "a int, b int")
    assert _vals(df.select(RU.safe_ratio("a", "b").alias("r")), "r") == [2.0, None, None, None, -1.5]


def test_bands_at_edges_and_null(spark):
    vals = [25.0, 25.1, 50.0, 50.1, 75.0, 75.1, None]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = _vals(df.select(RU.band("s").alias("b")), "b")
    assert got == ["Stable", "Monitor", "Monitor", "Intervention", "Intervention", "Critical", "Critical"]
    opt_out = _vals(df.select(RU.band("s", null_band=None).alias("b")), "b")
    assert opt_out[-1] is None


def test_round_half_up_matches_scaled_double(spark):
    df = spark.createDataFrame([(0.145,), (2.675,), (-1.005,), (None,)], "x double")
    got = _vals(df.select(RU.round_half_up("x", 2).alias("y")), "y")
    import math
    assert got[:3] == [math.floor(v * 100 + 0.5) / 100 for v in (0.145, 2.675, -1.005)]
    assert got[3] is None


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (50.0,), (150.0,), (None,)], "x double")
    assert _vals(df.select(RU.clip_keep_null("x", 0, 100).alias("y")), "y") == [0.0, 50.0, 100.0, None]


def test_composite_null_input_gives_null(spark):
    cols = [n for n, _ in RU.SCORE_WEIGHTS]
    df = spark.createDataFrame([(100.0, 100.0, 100.0, 100.0, 0.0), (0.0, 0.0, 0.0, 0.0, 100.0),
                                (50.0, None, 50.0, 50.0, 50.0)], ", ".join(f"{c} double" for c in cols))
    got = _vals(df.select(RU.weighted_composite(RU.SCORE_WEIGHTS, RU.SCORE_DIVISOR).alias("s")), "s")
    assert got == [100.0, 0.0, None]  # 112.5 clipped to 100; -12.5 clipped to 0


def test_differs_counts_null_as_different(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", None), (None, None)], "x string, y string")
    assert _vals(df.select(RU.differs("x", "y").alias("f")), "f") == [False, True, True, True]


def test_hour_start_stays_ntz_and_parse_is_null_safe(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 59, 7), "2024-01-01 10:59:07"),
                                (dt.datetime(2024, 1, 1, 0, 0, 0), "not a time")],
                               "ts timestamp_ntz, txt string")
    out = df.select(RU.hour_start("ts").alias("h"), RU.parse_timestamp("txt").alias("p"))
    assert out.schema["h"].dataType.simpleString() == "timestamp_ntz"
    rows = out.collect()
    assert rows[0]["h"] == dt.datetime(2024, 1, 1, 10, 0)
    assert rows[0]["p"] == dt.datetime(2024, 1, 1, 10, 59, 7)
    assert rows[1]["p"] is None


def test_fixed_avg_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 17.81875, 1e5 + 0.01]
    a = spark.createDataFrame([(v,) for v in vals], "x double")
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").repartition(3)
    ga = a.agg(RU.fixed_avg("x").alias("m")).first()["m"]
    gb = b.agg(RU.fixed_avg("x").alias("m")).first()["m"]
    assert ga == gb
    assert abs(ga - sum(vals) / len(vals)) < 1e-9
    empty = spark.createDataFrame([(None,)], "x double").agg(RU.fixed_avg("x").alias("m")).first()["m"]
    assert empty is None
