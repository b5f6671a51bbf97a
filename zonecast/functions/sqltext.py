"""SQL-text forms of the column rules, valid in Spark SQL and DuckDB alike.

Same arithmetic as ``rules``: half-up rounding on the double and exact
fixed-point sums and means (quantise, sum as DECIMAL(38,0), one division).
"""

from __future__ import annotations

#: 2^53: from here on a double is a whole number, and floor() would overflow further up.
WHOLE = "9007199254740992e0"


def rnd(expr: str, digits: int) -> str:
    x = f"CAST(({expr}) AS DOUBLE)"
    return (f"(CASE WHEN abs({x} * 1e{digits}) < {WHOLE} THEN CAST(floor({x} * 1e{digits} + 5e-1) AS DOUBLE) / 1e{digits}"
            f" ELSE {x} END)")


def units(expr: str, scale: int = 6) -> str:
    y = f"(CAST(({expr}) AS DOUBLE) * 1e{scale})"
    return (f"(CASE WHEN abs({y}) < {WHOLE} THEN CAST(floor({y} + 5e-1) AS DECIMAL(38,0))"
            f" WHEN abs({y}) < 1e37 THEN CAST({y} AS DECIMAL(38,0)) END)")


def fsum(expr: str, scale: int = 6) -> str:
    return f"(CAST(sum({units(expr, scale)}) AS DOUBLE) / 1e{scale})"


def favg(expr: str, scale: int = 6) -> str:
    q = units(expr, scale)
    return f"(CAST(sum({q}) AS DOUBLE) / CAST(count({q}) AS DOUBLE) / 1e{scale})"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST(NULLIF({den}, 0) AS DOUBLE))"
