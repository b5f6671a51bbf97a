"""Logistic model against a NumPy Newton fit; treatment coding as R does."""

import numpy as np
import pytest

from zonecast.operators import stats


def _data(n=3000, seed=3):
    rng = np.random.default_rng(seed)
    x1 = rng.normal(0, 1, n)
    x2 = rng.uniform(0, 5, n)
    levels = np.where(rng.uniform(size=n) < 0.05, "Fog", np.where(rng.uniform(size=n) < 0.5, "Clear", "Rain"))
    eta = -0.5 + 0.8 * x1 - 0.3 * x2 + np.select([levels == "Fog", levels == "Rain"], [1.0, 0.4], 0.0)
    y = (rng.uniform(size=n) < 1 / (1 + np.exp(-eta))).astype(int)
    return x1, x2, levels, y


def _newton(X, y, iters=50):
    b = np.zeros(X.shape[1])
    for _ in range(iters):
        p = 1 / (1 + np.exp(-X @ b))
        W = p * (1 - p)
        H = X.T @ (X * W[:, None])
        b = b + np.linalg.solve(H, X.T @ (y - p))
    p = 1 / (1 + np.exp(-X @ b))
    cov = np.linalg.inv(X.T @ (X * (p * (1 - p))[:, None]))
    return b, np.sqrt(np.diag(cov))


def test_logit_matches_numpy(spark):
    x1, x2, lv, y = _data()
    df = spark.createDataFrame([(float(a), float(b), str(c), int(d)) for a, b, c, d in zip(x1, x2, lv, y)],
                               "x1 double, x2 double, cond string, y int")
    got = {r["term"]: r for r in stats.logit_coefficients(df, "y", ["x1", "x2"], ["cond"]).collect()}
    # baseline is the alphabetically first level (Clear)
    X = np.column_stack([np.ones_like(x1), x1, x2, (lv == "Fog").astype(float), (lv == "Rain").astype(float)])
    b, se = _newton(X, y)
    names = ["(Intercept)", "x1", "x2", "factor(cond)Fog", "factor(cond)Rain"]
    assert set(got) == set(names)
    for name, bi, si in zip(names, b, se):
        assert abs(got[name]["estimate"] - bi) < 1e-6
        assert abs(got[name]["std_error"] - si) < 1e-6
        assert abs(got[name]["odds_ratio"] - np.exp(bi)) < 1e-6


def test_constant_factor_fails_clearly(spark):
    df = spark.createDataFrame([(1.0, "A", 0), (2.0, "A", 1), (3.0, "A", 1)], "x double, cond string, y int")
    with pytest.raises(ValueError, match="at least two levels"):
        stats.logit_coefficients(df, "y", ["x"], ["cond"])


def test_fit_reads_patterns_not_rows(spark):
    x1, x2, lv, y = _data(400)
    rows = [(float(round(a)), str(c), int(d)) for a, c, d in zip(x1, lv, y)]
    df = spark.createDataFrame(rows * 5 + [(None, "Fog", 1), (1.0, None, 0), (1.0, "Fog", None)], "x double, cond string, y int")
    patterns = stats.covariate_patterns(df, "y", ["x"], ["cond"]).collect()
    assert len(patterns) == len({(a, c) for a, c, _ in rows}) and sum(p["_n"] for p in patterns) == 2000
    m = stats.logit_fit(df, "y", ["x"], ["cond"])
    X = np.column_stack([np.ones(400), [a for a, _, _ in rows], [c == "Fog" for _, c, _ in rows], [c == "Rain" for _, c, _ in rows]]).astype(float)
    b, se = _newton(X, y)
    assert np.allclose(m.estimates, b, atol=1e-8) and np.allclose(m.errors, se / np.sqrt(5), atol=1e-8)
    p = 1 / (1 + np.exp(-X @ b))
    assert abs(m.deviance + 10 * np.sum(np.where(y == 1, np.log(p), np.log(1 - p)))) < 1e-6
    assert m.rows == 2000 and m.residual_df == 1996 and abs(m.aic - m.deviance - 8) < 1e-12


def test_sample_below_every_prefix(spark):
    df = spark.createDataFrame([(f"k{i % 900}", i % 40) for i in range(4000)], "key string, x int")
    brute = sorted((__import__("hashlib").md5(f"{r['key']}|{stats.SAMPLE_SEED}".encode()).hexdigest(), r["key"]) for r in df.collect())
    for n in (0, 1, 17, 2999, 3999, 4000, 9000):
        got = stats.seeded_sample(df, "key", n).collect()
        assert sorted(r["key"] for r in got) == sorted(k for _, k in brute[:n])
    same = spark.createDataFrame([("a", 1)] * 3000, "key string, x int")
    assert stats.seeded_sample(same, "key", 1200).count() == 1200
