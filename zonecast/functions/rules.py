"""Column rules: JVM-side expressions (no Python UDFs), null semantics explicit.

Fixed values (labels and thresholds the reference's logic depends on):
  completed status 'Completed', cancelled status 'Cancelled'
  payment variant 'upi' -> 'UPI'
  priority bands: <= 25 Stable, <= 50 Monitor, <= 75 Intervention, else Critical
  score weights: demand .30, cancellation .20, wait .20, revenue .20, adequacy -.10; divisor .80
  recommendation threshold: average score > 75
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPLETED = "Completed"
CANCELLED = "Cancelled"
PAYMENT_CANONICAL = {"upi": "UPI"}
BANDS = ((25.0, "Stable"), (50.0, "Monitor"), (75.0, "Intervention"))
TOP_BAND = "Critical"
SCORE_WEIGHTS = (
    ("demand_pressure_score", 0.30),
    ("cancellation_pressure_score", 0.20),
    ("wait_pressure_score", 0.20),
    ("revenue_opportunity_score", 0.20),
    ("fleet_adequacy_score", -0.10),
)
SCORE_DIVISOR = 0.80
ACTION_THRESHOLD = 75.0
ACTION_HIGH = "Prioritize additional fleet or reposition vehicles into this zone-hour."
ACTION_LOW = "Monitor demand and reposition fleet if pressure persists."
WHOLE_DOUBLES = float(2 ** 53)
DECIMAL_LIMIT = 1e37
NO_MIX_LABEL = "Review demand mix"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_up(col, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d on the double (same bits in Spark and DuckDB).

    Spark's ``round`` works on the decimal text and DuckDB's on the scaled double;
    they disagree on values such as 0.145, so both sides use this form.
    """
    scale = float(10 ** digits)
    x = _c(col).cast("double")
    scaled = x * F.lit(scale)
    # from 2^53 on a double has no fraction left, and floor() would saturate at the BIGINT range
    return F.when(F.abs(scaled) < F.lit(WHOLE_DOUBLES), (F.floor(scaled + F.lit(0.5)) / F.lit(scale)).cast("double")).otherwise(x)


def fixed_units(col, scale: int = 6) -> Column:
    """The value in units of 10^-scale as an exact DECIMAL(38,0); NaN and what
    does not fit (infinities) give null, so they are not counted."""
    scaled = _c(col).cast("double") * F.lit(float(10 ** scale))
    return F.when(F.abs(scaled) < F.lit(WHOLE_DOUBLES), F.floor(scaled + F.lit(0.5)).cast("decimal(38,0)")).when(
        F.abs(scaled) < F.lit(DECIMAL_LIMIT), scaled.cast("decimal(38,0)"))


def from_units(col, scale: int = 6) -> Column:
    return _c(col).cast("double") / F.lit(float(10 ** scale))


def fixed_sum(col, scale: int = 6) -> Column:
    """Order-independent sum: values quantised to 10^-scale, summed exactly as
    DECIMAL(38,0), one division.  Every engine and every partitioning gives the
    same bits, so rounding the result is stable."""
    return F.sum(fixed_units(col, scale)).cast("double") / F.lit(float(10 ** scale))


def fixed_avg(col, scale: int = 6) -> Column:
    """Order-independent mean (see ``fixed_sum``); null when no value is present."""
    q = fixed_units(col, scale)
    n = F.count(q)
    return F.when(n > 0, F.sum(q).cast("double") / n.cast("double") / F.lit(float(10 ** scale)))


def safe_ratio(num, den) -> Column:
    """num / den as double; a zero or null denominator gives null (P-13)."""
    d = _c(den)
    return _c(num).cast("double") / F.when(d != 0, d.cast("double"))


def non_positive_any(cols: Sequence[str]) -> Column:
    """True when any column is <= 0; a null compares false (pandas mask, G-1)."""
    cond = None
    for c in cols:
        term = F.coalesce(F.col(c) <= 0, F.lit(False))
        cond = term if cond is None else (cond | term)
    return cond


def positive_or_null(cols: Sequence[str]) -> Column:
    """Keep form of the pandas mask: every column is > 0 or null.  Same rows as
    ``~non_positive_any`` (NaN sorts above every number in Spark), written so
    parquet can push it down and skip row groups."""
    cond = None
    for c in cols:
        term = (F.col(c) > 0) | F.col(c).isNull()
        cond = term if cond is None else (cond & term)
    return cond


def positive_all(cols: Sequence[str]) -> Column:
    """True only when every column is > 0; a null drops the row (Spark form, G-1)."""
    cond = None
    for c in cols:
        term = F.coalesce(F.col(c) > 0, F.lit(False))
        cond = term if cond is None else (cond & term)
    return cond


def canonical_label(col, mapping: dict[str, str]) -> Column:
    """Exact, case-sensitive replacement of label variants (P-4)."""
    out = _c(col)
    expr = None
    for variant, canonical in mapping.items():
        expr = (F.when(out == variant, F.lit(canonical)) if expr is None
                else expr.when(out == variant, F.lit(canonical)))
    return out if expr is None else expr.otherwise(out)


def presence_flag(col) -> Column:
    return _c(col).isNotNull()


def value_if(cond: Column, value, otherwise: float = 0.0) -> Column:
    """Conditional measure: value where cond holds, else a constant (P-9)."""
    return F.when(cond, _c(value)).otherwise(F.lit(otherwise))


def is_status(col, status: str) -> Column:
    """Indicator 1/0; a null status counts as 0 (pandas eq, P-10)."""
    return F.when(_c(col) == status, F.lit(1)).otherwise(F.lit(0))


def differs(a, b) -> Column:
    """pandas ``ne``: a null on either side counts as different (P-12, G-6)."""
    return F.coalesce(_c(a) != _c(b), F.lit(True))


def hour_of_day(ts) -> Column:
    return F.hour(_c(ts)).cast("int")


def hour_start(ts) -> Column:
    """Truncate to the hour and stay a timestamp without zone (G-14)."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def parse_timestamp(col, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text -> timestamp_ntz; unparseable text becomes null (ANSI-safe, G-17)."""
    return F.try_to_timestamp(_c(col), F.lit(fmt)).cast("timestamp_ntz")


def clip_keep_null(col, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; ``least``/``greatest`` skip nulls, so guard them."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def weighted_sum(weights: Sequence[tuple[str, float]]) -> Column:
    expr = None
    for name, w in weights:
        term = F.lit(float(w)) * F.col(name)
        expr = term if expr is None else expr + term
    return expr


def weighted_composite(weights, divisor: float, lo: float = 0.0, hi: float = 100.0,
                       digits: int = 1) -> Column:
    """(sum of weight * score) / divisor, clipped and rounded; null stays null (P-15)."""
    raw = weighted_sum(weights) / F.lit(float(divisor))
    return round_half_up(clip_keep_null(raw, lo, hi), digits)


def band(col, bands=BANDS, top: str = TOP_BAND, null_band: str | None = TOP_BAND) -> Column:
    """Threshold bands by <= comparisons.  A null score falls through every
    comparison to the top band, as in the reference (G-8); pass
    ``null_band=None`` to keep it null instead."""
    c = _c(col)
    expr = None
    for limit, label in bands:
        expr = (F.when(c <= limit, F.lit(label)) if expr is None
                else expr.when(c <= limit, F.lit(label)))
    expr = expr.otherwise(F.lit(top))
    if null_band != top:
        expr = F.when(c.isNull(), F.lit(null_band)).otherwise(expr)
    return expr


def action_text(col, threshold: float = ACTION_THRESHOLD) -> Column:
    return F.when(_c(col) > threshold, F.lit(ACTION_HIGH)).otherwise(F.lit(ACTION_LOW))


def corridor_label(a, b, arrow: str = " → ") -> Column:
    """'A → B'; null when either side is null (SQL ``||``, not concat_ws)."""
    return F.concat(_c(a), F.lit(arrow), _c(b))
