"""Statistics: deterministic bottom-n sample (L-1) and the logistic model with a
treatment-coded factor (L-2, L-3).

The model is fitted on sufficient statistics: rows collapse to distinct covariate
patterns with their number of rows and of successes (one aggregate, written), and each Newton
step is one aggregate over the patterns that adds up the normal equations, a matrix of the
number of terms.  So the fit reads the trips once, whatever the number of steps.  The sample is a
separate operator for callers who want the reference's cap.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.session import written

# The reference's sample seed and cap.
SAMPLE_SEED = 20260812
SAMPLE_CAP = 150_000

_DIGITS = 4  # of the hash per round: 65,536 counts at most come to the driver
_SMALL = 1_000  # rows that one sort may take


def sample_key(key_col: str, seed: int = SAMPLE_SEED):
    """md5 of key and seed, as any engine computes it; the order of the sample."""
    return F.md5(F.concat(F.coalesce(F.col(key_col).cast("string"), F.lit("")), F.lit(f"|{seed}")).cast("binary"))


def seeded_sample(df: DataFrame, key_col: str, n: int, seed: int = SAMPLE_SEED) -> DataFrame:
    """The ``n`` rows that come first by md5 of (key, seed), ties by md5 of the whole row (L-1).

    Deterministic, independent of partitioning, and exact without a sort: counts
    per hash prefix (mergeable, bounded) find the prefix that holds the n-th row; all rows below it belong to
    the sample, and the prefix grows by four digits a round until its rows are few.  Rows that agree in
    both hashes are equal, so any of them will do.
    """
    whole = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).cast("binary"))
    hashed = df.withColumn("_h", F.concat(sample_key(key_col, seed), whole))
    prefix, need, below = "", n, None
    while True:
        rest = hashed.where(F.col("_h").startswith(prefix)) if prefix else hashed
        digits = F.substring("_h", len(prefix) + 1, _DIGITS)
        counts = rest.groupBy(digits.alias("_d")).agg(F.count(F.lit(1)).alias("_n")).orderBy("_d").collect()
        if need >= sum(r["_n"] for r in counts):  # first round only: the whole table
            return df
        run = 0
        for r in counts:
            if run + r["_n"] > need:
                break
            run += r["_n"]
        edge = prefix + r["_d"]
        # every row before the edge, whatever its length: prefixes sort as their hashes do
        below, need, prefix = hashed.where(F.col("_h") < edge), need - run, edge
        if not need:
            return below.drop("_h")
        if r["_n"] <= _SMALL or len(prefix) == 64:
            break
    at = hashed.where(F.col("_h").startswith(prefix))
    return below.unionByName(at.orderBy("_h").limit(need)).drop("_h")


# --- logistic model ---------------------------------------------------------------------

@dataclass(frozen=True)
class LogitModel:
    """Terms with estimates and standard errors, and the diagnostics of the fit."""

    terms: list[str]
    estimates: np.ndarray
    errors: np.ndarray
    rows: int
    iterations: int
    deviance: float
    null_deviance: float

    @property
    def aic(self) -> float:
        return self.deviance + 2 * len(self.terms)

    @property
    def residual_df(self) -> int:
        return self.rows - len(self.terms)


def covariate_patterns(df: DataFrame, label: str, numeric: Sequence[str], factors: Sequence[str] = ()) -> DataFrame:
    """Distinct covariates with their rows (_n) and successes (_y); rows with a null covariate or label are left out."""
    cols = [*numeric, *factors]
    return (df.na.drop(subset=[label, *cols]).groupBy(*[F.col(c).cast("double").alias(c) for c in numeric], *factors)
            .agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col(label).cast("bigint")).alias("_y")))


def _terms(patterns: DataFrame, numeric: Sequence[str], factors: Sequence[str]) -> list[tuple[str, object]]:
    """(name, column) per model term; the first level of a factor is its baseline, as in R."""
    terms = [("(Intercept)", F.lit(1.0)), *[(c, F.col(c)) for c in numeric]]
    for f in factors:
        levels = sorted(r[0] for r in patterns.select(f).distinct().collect())  # a factor has few levels
        if len(levels) < 2:
            raise ValueError(f"factor {f!r} needs at least two levels")
        terms += [(f"factor({f}){v}", (F.col(f) == v).cast("double")) for v in levels[1:]]
    return terms


def _log_or_zero(count, share):
    """count * ln(share), 0 where the count is 0."""
    return F.when(count > 0, count * F.log(share)).otherwise(F.lit(0.0))


def _step_sums(patterns: DataFrame, terms, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """X'WX, X'(y - n mu) and the deviance at ``b``, from one aggregate."""
    k = len(terms)
    eta = F.lit(0.0)
    for (_, x), value in zip(terms, b.tolist(), strict=True):
        eta = eta + F.lit(value) * x
    at = patterns.select("_n", "_y", *[x.alias(f"x{i}") for i, (_, x) in enumerate(terms)], (F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))).alias("mu"))
    w, rest = F.col("_n") * F.col("mu") * (1 - F.col("mu")), F.col("_y") - F.col("_n") * F.col("mu")
    deviance = -2 * (_log_or_zero(F.col("_y"), F.col("mu")) + _log_or_zero(F.col("_n") - F.col("_y"), 1 - F.col("mu")))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = at.agg(*[F.sum(w * F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs], *[F.sum(rest * F.col(f"x{i}")) for i in range(k)],
                 F.sum(deviance)).first()
    h = np.zeros((k, k))
    for (i, j), v in zip(pairs, got[:len(pairs)], strict=True):
        h[i, j] = h[j, i] = v
    return h, np.array(got[len(pairs):-1], float), float(got[-1])


def logit_fit(df: DataFrame, label: str, numeric: Sequence[str], factors: Sequence[str] = (),
              max_iter: int = 25) -> LogitModel:
    """Binomial GLM, logit link, no regularisation, by Newton steps from zero until the
    deviance changes by less than 1e-8 of itself (R's criterion).  Factor levels are
    treatment-coded with the alphabetically first level as the baseline.
    """
    patterns = written(covariate_patterns(df, label, numeric, factors), "covariate-patterns")
    rows, successes = patterns.agg(F.sum("_n"), F.sum("_y")).first()
    if not rows:
        raise ValueError("no complete rows to fit")
    terms = _terms(patterns, numeric, factors)
    share = successes / rows
    null = -2 * sum(n * math.log(p) for n, p in ((successes, share), (rows - successes, 1 - share)) if n)
    b = np.zeros(len(terms))
    h, g, deviance = _step_sums(patterns, terms, b)
    iterations = 0
    while iterations < max_iter:
        b = b + np.linalg.solve(h, g)
        before = deviance
        h, g, deviance = _step_sums(patterns, terms, b)
        iterations += 1
        if abs(deviance - before) / (abs(deviance) + 0.1) < 1e-8:
            break
    errors = np.sqrt(np.diag(np.linalg.inv(h)))
    return LogitModel([t for t, _ in terms], b, errors, int(rows), iterations, deviance, null)


def _six(x: float) -> float:
    return math.floor(x * 1e6 + 0.5) / 1e6


def coefficient_table(spark, model: LogitModel) -> DataFrame:
    """term, estimate, std_error, z_value, p_value, odds_ratio (L-3), at 6 decimals; a row per term."""
    rows = []
    for t, b, e in zip(model.terms, model.estimates.tolist(), model.errors.tolist(), strict=True):
        p = math.erfc(abs(b / e) / math.sqrt(2))  # two-sided normal tail
        rows.append((t, _six(b), _six(e), _six(b / e), _six(p), _six(math.exp(b))))
    return spark.createDataFrame(
        rows, "term string, estimate double, std_error double, z_value double, p_value double, odds_ratio double")


def logit_coefficients(df: DataFrame, label: str, numeric: Sequence[str], factors: Sequence[str] = (),
                       max_iter: int = 25) -> DataFrame:
    return coefficient_table(df.sparkSession, logit_fit(df, label, numeric, factors, max_iter))


def logit_fit_summary(df: DataFrame, label: str, numeric: Sequence[str], factors: Sequence[str] = (),
                      max_iter: int = 25) -> DataFrame:
    """Fit diagnostics: rows used, iterations, deviance, null deviance, AIC, residual degrees of freedom (L-2)."""
    m = logit_fit(df, label, numeric, factors, max_iter)
    return df.sparkSession.createDataFrame(
        [(m.rows, m.iterations, _six(m.deviance), _six(m.null_deviance), _six(m.aic), m.residual_df)],
        "rows bigint, iterations int, deviance double, null_deviance double, aic double, residual_df bigint")
