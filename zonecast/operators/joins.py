"""Join operators (J-*).  Small sides are broadcast only behind a size check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.session import written

# Relations up to this many bytes, by the optimizer's estimate, are broadcast; bigger ones
# shuffle (and AQE may still pick a broadcast at run time from the real size).  For
# files the estimate is their size on disk, scaled to the columns read, so it is
# held far below what a task can keep in memory; a join's estimate is the
# product of its sides and errs to the large side.
BROADCAST_MAX_BYTES = 32 * 1024 * 1024
# Rows of a table whose exact count is known (score tables of a ranking).
BROADCAST_MAX_ROWS = 2_000_000


def estimated_bytes(df: DataFrame) -> int:
    """Size of ``df`` by plan statistics: no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Size check of a broadcast side.  Nothing is remembered between calls, as the inputs may have changed."""
    return estimated_bytes(df) <= max_bytes


def maybe_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def join_dim(fact: DataFrame, dim: DataFrame, on, how: str = "left",
             max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Fact x dimension equi-join (J-1 inner, J-2 left, J-7 hourly).

    The dimension is broadcast when its checked size allows, so the fact side
    is never shuffled for it.
    """
    return fact.join(maybe_broadcast(dim, max_bytes), on=on, how=how)


def unique_by_key(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order_by: str) -> DataFrame:
    """One row per key; among duplicates the one with the largest ``order_by``
    wins ("last match", G-11), ties by the payload columns.  A null order sorts
    first but never erases a row.  Partial aggregation keeps hot keys cheap."""
    payload = [c for c in cols if c not in keys]
    picked = F.max(F.struct(F.col(order_by).alias("_order"), *[F.col(c) for c in payload])).alias("_last")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in payload])


def update_join_last(left: DataFrame, right: DataFrame, on: dict[str, str],
                     cols: Sequence[str], order_by: str) -> DataFrame:
    """Add ``cols`` from ``right`` to every row of ``left``; unmatched rows get
    nulls and the row count never changes (R keyed update-join, J-6).

    ``on`` maps left key -> right key.  The right side is first made unique per
    key (last match by ``order_by``).  Keys meet as structs: the aggregate's
    own partitioning does not serve that, so both sides get a shuffle of the join,
    which AQE broadcasts when it is small and splits when a key is hot.  Null
    keys match nothing.
    """
    rk = list(on.values())
    for k in rk:
        right = right.where(F.col(k).isNotNull())
    uniq = unique_by_key(right, rk, list(cols), order_by)
    names = [f"k{i}" for i in range(len(rk))]
    uniq = uniq.select(F.struct(*[F.col(r).alias(n) for r, n in zip(rk, names, strict=True)]).alias("_rk"),
                       *[F.col(c).alias(f"_new_{c}") for c in cols])
    key = F.struct(*[F.col(lk).alias(n) for lk, n in zip(on, names, strict=True)])
    out = left.withColumn("_lk", key).join(uniq, F.col("_lk") == F.col("_rk"), "left")
    return out.select(*left.columns, *[F.col(f"_new_{c}").alias(c) for c in cols])


def role_playing_join(fact: DataFrame, dim: DataFrame, dim_key: str,
                      roles: dict[str, str], cols: Sequence[str]) -> DataFrame:
    """Join the same dimension once per role (e.g. pickup and drop zone, J-4).

    ``roles`` maps a fact key column to the prefix of the added columns.
    """
    small = maybe_broadcast(dim.select(dim_key, *cols))
    out = fact
    for fact_key, prefix in roles.items():
        side = small.select(F.col(dim_key).alias(f"_{prefix}key"),
                            *[F.col(c).alias(f"{prefix}_{c}") for c in cols])
        out = out.join(side, out[fact_key] == side[f"_{prefix}key"], "left").drop(f"_{prefix}key")
    return out


def star_assemble(panel: DataFrame, sides: Sequence[tuple[DataFrame, Sequence[str]]],
                  check_grain: bool = False, hot: bool = False) -> DataFrame:
    """Chain of left joins around a panel (J-9).  Every side must be unique on
    its keys; with ``check_grain`` the row count is verified (one extra job).
    ``hot``: a key of the panel may hold a large share of its rows, so that every
    join is split by ``split_join``."""
    out = panel
    for side, keys in sides:
        out = split_join(out, side, keys) if hot else out.join(side, on=list(keys), how="left")
    if check_grain:
        before, after = panel.count(), out.count()
        if before != after:
            raise ValueError(f"star assembly changed the grain: {before} -> {after} rows")
    return out


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Keys that hold more than ``share`` of the rows, so fewer than 1 / share of them (written once).

    Partial aggregation reduces a hot key to a row per task before the shuffle.
    """
    counts = written(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.where(F.col("_n") > share * total).drop("_n")


def split_join(left: DataFrame, right: DataFrame, keys: Sequence[str], share: float | None = None) -> DataFrame:
    """Left equi-join with a right side that is unique on ``keys``, split by how frequent a key is (J-9).

    Keys with more than ``share`` of the left rows (default: a quarter of a shuffle
    partition's even share) are fewer than 1 / share; their right rows are broadcast, so a hot key's left
    rows stay where they are.  The rest are shuffled, and no key among them is hot.  Null keys match nothing
    and are not shuffled either.
    """
    keys = list(keys)
    if share is None:
        share = 0.25 / max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    some = [F.col(k).isNotNull() for k in keys]
    present = some[0]
    for c in some[1:]:
        present = present & c
    heavy = F.broadcast(frequent_keys(left.where(present), keys, share))  # fewer than 1 / share rows
    heavy_right = right.join(heavy, keys, "left_semi")
    hot = left.join(heavy, keys, "left_semi").join(F.broadcast(heavy_right), keys, "left")
    rest = left.where(present).join(heavy, keys, "left_anti").join(right.join(heavy, keys, "left_anti"), keys, "left")
    names = hot.columns
    none = left.where(~present).select(*[F.col(c) if c in left.columns else F.lit(None).cast(hot.schema[c].dataType).alias(c)
                                         for c in names])
    return hot.unionByName(rest).unionByName(none)


def reindex_categories(agg: DataFrame, key: str, order: Sequence[str],
                       position_col: str = "position") -> DataFrame:
    """Keep exactly the listed categories in list order; absent ones get null
    measures, unlisted ones vanish (pandas ``reindex``, J-11).  As in pandas,
    integer measures become double, since an absent category holds a null."""
    spark = agg.sparkSession
    order_df = spark.createDataFrame([(v, i + 1) for i, v in enumerate(order)],
                                     f"{key} string, {position_col} int")
    measures = [F.col(c).cast("double").alias(c) if t in ("bigint", "int") else F.col(c)
                for c, t in agg.dtypes if c != key]
    return order_df.join(agg.select(key, *measures), on=key, how="left")


def orphan_counts(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """records_checked, missing_foreign_keys, orphan_foreign_keys for one relation (J-8).

    Parent keys that fit a broadcast are looked up where the child rows are, so no child
    row is shuffled.  Otherwise the child is first reduced to (key, count) with map-side combine, so a hot
    key costs one row; then distinct child keys meet distinct parent keys.
    """
    parent_keys = parent.select(F.col(parent_key).alias("_k")).where(F.col("_k").isNotNull())
    if fits_broadcast(parent_keys):
        keys = child.select(F.col(child_key).alias("_k"), F.lit(1).alias("_n"))
        joined = keys.join(F.broadcast(parent_keys.distinct().withColumn("_present", F.lit(True))), on="_k", how="left")
    else:
        keys = child.groupBy(F.col(child_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        joined = keys.join(parent_keys.distinct().withColumn("_present", F.lit(True)), on="_k", how="left")
    return joined.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("records_checked"),
        F.coalesce(F.sum(F.when(F.col("_k").isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
        .alias("missing_foreign_keys"),
        F.coalesce(F.sum(F.when(F.col("_k").isNotNull() & F.col("_present").isNull(), F.col("_n"))),
                   F.lit(0)).cast("bigint").alias("orphan_foreign_keys"),
    )
