"""Data-quality operators: profile, missing values, key integrity, rule
failures, validation outcome and gates (A-13..A-16, J-8, D-6..D-8, D-11, D-29).

Each table is read once per report: one aggregate computes every count, and
``unpivot`` turns the one-row result into long form.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.operators.joins import BROADCAST_MAX_ROWS, fits_broadcast, orphan_counts
from zonecast.session import written


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


_MASK_BITS = 62


def _null_masks(df: DataFrame, width: int) -> list:
    """Which columns are null, as ``width`` longs of 62 bits."""
    out = []
    for k in range(width):
        bits = [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
                for i, c in enumerate(df.columns[k * _MASK_BITS:(k + 1) * _MASK_BITS])]
        total = F.lit(0).cast("bigint")
        for b in bits:
            total = total + b
        out.append(total.alias(f"_z{k}"))
    return out


def _row_print(df: DataFrame) -> list:
    """128 bits per row: two 64-bit hashes of all columns and of which are null (a null alone leaves a hash as it is)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    masks = _null_masks(df, -(-len(cols) // _MASK_BITS))
    return [F.xxhash64(*masks, *cols).alias("_h1"), F.xxhash64(F.lit("second"), *cols[::-1], *masks).alias("_h2")]


@dataclass(frozen=True)
class TableFacts:
    """What the reports need to know of one table."""

    rows: int
    distinct_rows: int
    nulls: dict[str, int]


def table_facts(tables: dict[str, DataFrame]) -> dict[str, TableFacts]:
    """Rows, distinct rows and nulls per column of every table, from one scan each (A-13, A-14, A-15).

    Rows meet by a 128-bit print, so the exchange carries a few longs a row, not
    the columns; every count comes from the prints' multiplicity and null masks, and the same exchange gives the prints
    that repeat, which are written.  Only rows whose print repeats are then read again and compared in full: equal rows collapse
    before that exchange, and what is left over are rows that differ under one print.
    """
    spark = next(iter(tables.values())).sparkSession
    width = max(-(-len(df.columns) // _MASK_BITS) for df in tables.values())
    masks = [f"_z{k}" for k in range(width)]
    prints = union_all([df.select(F.lit(i).alias("_t"), *_row_print(df), *_null_masks(df, width))
                        for i, df in enumerate(tables.values())])
    prints = prints.groupBy("_t", "_h1", "_h2", *masks).agg(F.count(F.lit(1)).alias("_m"))
    most = max(len(df.columns) for df in tables.values())
    nulls = [F.sum(F.when(F.getbit(F.col(f"_z{j // _MASK_BITS}"), F.lit(j % _MASK_BITS)) == 1, F.col("_m")).otherwise(F.lit(0)))
             .alias(f"null_{j}") for j in range(most)]
    counts = prints.groupBy("_t").agg(F.sum("_m").alias("rows"), F.count(F.lit(1)).alias("prints"),
                                      F.count_if(F.col("_m") > 1).alias("twice"), *nulls)
    twice = prints.where(F.col("_m") > 1).select("_t", "_h1", "_h2")
    # both sides read one exchange of the prints
    facts_and_prints = written(counts.unionByName(twice, allowMissingColumns=True), "row-prints")
    got = {r["_t"]: r for r in facts_and_prints.where("rows IS NOT NULL").collect()}
    twice = facts_and_prints.where("rows IS NULL").select("_t", "_h1", "_h2")
    again = [x for i, df in enumerate(tables.values()) if i in got and got[i]["twice"]
             for x in _distinct_among(i, df, twice.where(F.col("_t") == i).select("_h1", "_h2"), got[i]["twice"])]
    exact: dict[int, int] = {}
    for r in union_all(again).collect() if again else []:
        exact[r["_t"]] = exact.get(r["_t"], 0) + int(r["_d"])
    facts = {}
    for i, (name, df) in enumerate(tables.items()):
        r = got.get(i)  # an empty table has no print
        facts[name] = TableFacts(int(r["rows"]) if r else 0, int(r["prints"] - r["twice"]) + exact.get(i, 0) if r else 0,
                                 {c: int(r[f"null_{j}"]) if r else 0 for j, c in enumerate(df.columns)})
    return facts


def _distinct_among(i: int, df: DataFrame, prints: DataFrame, n: int, most: int = BROADCAST_MAX_ROWS) -> list[DataFrame]:
    """Distinct rows of ``df`` among those whose print is listed (one row each: _t, _d, to be added up); ``n`` prints, counted
    before.  Each part of the prints is broadcast, so that only rows whose print repeats are dealt out."""
    rounds, out = -(-n // most), []
    for k in range(rounds):
        part = prints.where(F.pmod("_h1", F.lit(rounds)) == k)
        rows = df.select("*", *_row_print(df)).join(F.broadcast(part), ["_h1", "_h2"], "left_semi")
        out.append(rows.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.lit(1).alias("_one"))
                   .agg(F.count(F.lit(1)).alias("_d")).select(F.lit(i).alias("_t"), "_d"))
    return out


def duplicate_rows(df: DataFrame) -> DataFrame:
    """rows, distinct_rows and duplicate_rows (count minus distinct count, A-13), one row."""
    f = table_facts({"table": df})["table"]
    return df.sparkSession.createDataFrame([(f.rows, f.distinct_rows, f.rows - f.distinct_rows)],
                                           "rows bigint, distinct_rows bigint, duplicate_rows bigint")


_PROFILE = "dataset string, rows bigint, columns bigint, duplicate_rows bigint, missing_cells bigint"
_MISSING = "dataset string, column_name string, missing_count bigint, missing_pct double"


def profile_and_missing(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Profile (D-6) and missing values (D-7) of every table from one scan each."""
    spark = next(iter(tables.values())).sparkSession
    facts = table_facts(tables)
    profile = [(n, f.rows, len(f.nulls), f.rows - f.distinct_rows, sum(f.nulls.values())) for n, f in facts.items()]
    missing = [(n, c, k, k / f.rows) for n, f in facts.items() for c, k in f.nulls.items() if k]
    return spark.createDataFrame(profile, _PROFILE), spark.createDataFrame(missing, _MISSING)


def dataset_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """dataset, rows, columns, duplicate_rows, missing_cells per table (D-6)."""
    return profile_and_missing(tables)[0]


def missing_by_column(name: str, df: DataFrame) -> DataFrame:
    """dataset, column_name, missing_count, missing_pct for columns with nulls (A-14)."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
    long = wide.unpivot("_rows", cols, "column_name", "missing_count")
    return long.where(F.col("missing_count") > 0).select(
        F.lit(name).alias("dataset"), "column_name", "missing_count",
        (F.col("missing_count") / F.col("_rows")).alias("missing_pct"))


def missing_values(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([missing_by_column(n, df) for n, df in tables.items()])


def fk_integrity(relations: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """relationship, records_checked, missing_foreign_keys, orphan_foreign_keys (J-8, D-8).

    ``relations``: (label, child, child_key, parent, parent_key).  Relations that share a child
    DataFrame are checked in one pass over it when their parents' keys fit a broadcast; a relation
    with a larger parent reduces the child to (key, count) before it meets the parent.
    """
    by_child: dict[int, tuple[DataFrame, list]] = {}
    for label, child, ck, parent, pk in relations:
        by_child.setdefault(id(child), (child, []))[1].append((label, ck, parent, pk))
    frames = []
    for child, rels in by_child.values():
        if len(rels) > 1 and all(fits_broadcast(parent.select(pk)) for _, _, parent, pk in rels):
            frames.append(_keys_looked_up(child, rels))
        else:
            frames += [orphan_counts(child, ck, parent, pk).select(F.lit(label).alias("relationship"), "*")
                       for label, ck, parent, pk in rels]
    return union_all(frames)


def _keys_looked_up(child: DataFrame, rels: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """All relations of one child in one pass: every key is looked up in its broadcast parent, no child row is shuffled."""
    out = child.select(*[F.col(ck).alias(f"_c{i}") for i, (_, ck, _, _) in enumerate(rels)])
    for i, (_, _, parent, pk) in enumerate(rels):
        keys = parent.select(F.col(pk).alias(f"_p{i}")).where(F.col(pk).isNotNull()).distinct()
        out = out.join(F.broadcast(keys), F.col(f"_c{i}") == F.col(f"_p{i}"), "left")
    counts = out.agg(F.count(F.lit(1)).alias("n"), *[c for i in range(len(rels)) for c in (
        F.count_if(F.col(f"_c{i}").isNull()).alias(f"missing{i}"),
        F.count_if(F.col(f"_c{i}").isNotNull() & F.col(f"_p{i}").isNull()).alias(f"orphan{i}"))])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("relationship"), F.col("n").alias("records_checked"),
                 F.col(f"missing{i}").alias("missing_foreign_keys"), F.col(f"orphan{i}").alias("orphan_foreign_keys"))
        for i, (label, _, _, _) in enumerate(rels)])))


def rule_failures(dataset: str, df: DataFrame, rules: Sequence[tuple[str, object]]) -> DataFrame:
    """dataset, check, failed_records: one aggregate of ``count_if`` per rule (A-16).

    A rule that evaluates to null (null input) does not count as a failure.
    """
    names = [n for n, _ in rules]
    wide = df.agg(*[F.count_if(expr).cast("bigint").alias(n) for n, expr in rules])
    return wide.unpivot([], names, "check", "failed_records").select(
        F.lit(dataset).alias("dataset"), "check", "failed_records")


def quality_checks(rule_sets: Sequence[tuple[str, DataFrame, Sequence[tuple[str, object]]]]) -> DataFrame:
    return union_all([rule_failures(ds, df, rules) for ds, df, rules in rule_sets])


def validation_outcome(integrity: DataFrame, quality: DataFrame) -> DataFrame:
    """Number of relationships with missing or orphan keys and number of
    failed rules, as (outcome, value) rows (D-11)."""
    a = integrity.agg(F.count_if((F.col("missing_foreign_keys") > 0) | (F.col("orphan_foreign_keys") > 0))
                      .cast("bigint").alias("value")).select(F.lit("integrity_failures").alias("outcome"), "value")
    b = quality.agg(F.count_if(F.col("failed_records") > 0).cast("bigint").alias("value")) \
        .select(F.lit("failed_quality_rules").alias("outcome"), "value")
    return a.unionByName(b)


def gate_counts(failing) -> dict:
    """Aggregates of a gate, to be observed on the write of the table that it checks (G-16)."""
    return {"checked": F.count(F.lit(1)), "failed": F.count_if(failing)}


def gate(name: str, df: DataFrame, failing, allow=None) -> DataFrame:
    """One-row gate: gate, checked, failed, passed.  ``allow`` exempts rows whose
    failure is expected by design (G-16)."""
    cond = failing if allow is None else (failing & ~F.coalesce(allow, F.lit(False)))
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("checked"),
                  F.count_if(cond).cast("bigint").alias("failed")) \
        .select(F.lit(name).alias("gate"), "checked", "failed", (F.col("failed") == 0).alias("passed"))


def non_empty_gate(name: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("checked")).select(
        F.lit(name).alias("gate"), "checked",
        F.when(F.col("checked") == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias("failed"),
        (F.col("checked") > 0).alias("passed"))


def assert_gates(gates: DataFrame) -> None:
    """Raise when any gate failed; the gate table is bounded by the number of gates."""
    bad = [r["gate"] for r in gates.where(~F.col("passed")).select("gate").collect()]
    if bad:
        raise AssertionError(f"data gates failed: {', '.join(bad)}")
