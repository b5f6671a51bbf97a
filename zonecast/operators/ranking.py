"""Ranking operators (W-*, O-*).

``percentile_scores`` is the distributed average-tie percentile rank.  Its
centre is a rank index, written once:

1. one explode takes every measure to (measure, value) and a map-side combine
   to (measure, value, multiplicity), so a value shared by a third of all rows is a single row;
2. a range shuffle sorts the distinct values; a value never spans two ranges;
3. inside each range a window over the distinct values accumulates the
   multiplicities, and per-range totals (bounded by measures x ranges) give each
   range its offset;
4. the score per distinct value is joined back to the rows.

``global_rank`` numbers rows of a total order the same way, without a window
over one partition.  No step puts all rows, or one hot value's rows, into a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.operators.joins import BROADCAST_MAX_ROWS
from zonecast.session import written


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _long(df: DataFrame, measures: Sequence[str], *keys: str) -> DataFrame:
    """(keys, _m, _v): one row per row and measure that is not null."""
    return df.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("_m"), F.col(c).cast("double").alias("_v"))
                                               for i, c in enumerate(measures)])).alias("_x")) \
        .select(*keys, "_x.*").where(F.col("_v").isNotNull())


def rank_index(df: DataFrame, measures: Sequence[str], ranges: int | None = None) -> DataFrame:
    """_m, _v, _c, _score: average-tie percentile score of every distinct value of every measure, written once."""
    spark = df.sparkSession
    counted = _long(df, measures).groupBy("_m", "_v").agg(F.count(F.lit(1)).alias("_c"))
    placed = written(counted.repartitionByRange(ranges or _partitions(df), "_m", "_v").withColumn("_b", F.spark_partition_id()),
                     "rank-values")
    # per-range totals: at most measures x ranges rows, so collecting them is bounded
    offsets, before = [], {}
    for r in placed.groupBy("_m", "_b").agg(F.sum("_c").alias("_t")).orderBy("_m", "_b").collect():
        offsets.append((r["_m"], r["_b"], before.get(r["_m"], 0)))
        before[r["_m"]] = before.get(r["_m"], 0) + r["_t"]
    bounded = spark.createDataFrame([(m, b, o, before[m]) for m, b, o in offsets], "_m int, _b int, _off long, _n long")
    w = Window.partitionBy("_m", "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (placed.join(F.broadcast(bounded), ["_m", "_b"])
              .withColumn("_below", F.coalesce(F.sum("_c").over(w), F.lit(0)))
              .withColumn("_avg_rank", (F.col("_off") + F.col("_below")).cast("double")
                          + (F.col("_c") + F.lit(1)).cast("double") / F.lit(2.0)))
    return written(ranked.select("_m", "_v", "_c", (F.col("_avg_rank") / F.col("_n") * F.lit(100.0)).alias("_score")), "rank-index")


def percentile_scores(df: DataFrame, measures: dict[str, str], ranges: int | None = None,
                      max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Add one 0-100 average-tie percentile column per measure (W-1):
    pandas ``rank(pct=True, method="average") * 100``; null stays null.

    ``df`` is read once for the index and once for the result, so pass a written
    frame.  An index of at most ``max_broadcast_rows`` rows (counted exactly) is broadcast, one measure
    at a time, and no row moves.  A larger one is joined once in long form: values
    with a large share of the rows by broadcast (they are few), the rest by shuffle, and the scores
    come back to their rows by a row key in one wide step.
    """
    srcs, names = list(measures), list(measures.values())
    index = rank_index(df, srcs, ranges)
    if index.count() <= max_broadcast_rows:
        out = df
        for i, (src, dst) in enumerate(measures.items()):
            side = index.where(F.col("_m") == i).select(F.col("_v").alias(f"_k_{dst}"), F.col("_score").alias(dst))
            out = out.join(F.broadcast(side), out[src].cast("double") == side[f"_k_{dst}"], "left").drop(f"_k_{dst}")
        return out
    # the key is written with the row, so that every later scan sees the same one
    keyed = written(df.withColumn("_row", F.monotonically_increasing_id()), "rank-rows")
    long = _long(keyed, srcs, "_row")
    total = index.groupBy("_m").agg(F.sum("_c").alias("_t"))
    share = index.join(F.broadcast(total), "_m").withColumn("_hot", F.col("_c") * (4 * _partitions(df)) > F.col("_t"))
    share = written(share.select("_m", "_v", "_score", "_hot"), "rank-shares")
    # fewer than four times the partitions per measure
    hot = F.broadcast(share.where("_hot").select("_m", "_v", "_score"))
    met = (long.join(hot, ["_m", "_v"]).select("_row", "_m", "_score")
           .unionByName(long.join(hot, ["_m", "_v"], "left_anti")
                        .join(share.where("NOT _hot").select("_m", "_v", "_score"), ["_m", "_v"]).select("_row", "_m", "_score")))
    wide = met.groupBy("_row").agg(*[F.max(F.when(F.col("_m") == i, F.col("_score"))).alias(d) for i, d in enumerate(names)])
    return keyed.join(wide, "_row", "left").drop("_row")


def global_rank(df: DataFrame, order: Sequence, rank_col: str = "rank") -> DataFrame:
    """Number the rows 1, 2, ... in the given order (O-1, O-6).

    The rows are range-partitioned and sorted, written once with their place in
    the partition, and each partition's offset (a row per partition) is added.
    ``order`` should be total: rows that agree in it are numbered in no defined order, and stay in one partition.
    """
    parts = written(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_id", F.monotonically_increasing_id()), "global-order")
    parts = parts.withColumn("_p", F.shiftright("_id", 33))
    sizes = parts.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (parts.join(F.broadcast(offsets), "_p").withColumn(rank_col, (F.col("_off") + place + 1).cast("bigint"))
            .drop("_id", "_p", "_off"))


def top1_per_group(df: DataFrame, keys: Sequence[str], count_col: str, label_col: str,
                   out_col: str | None = None) -> DataFrame:
    """Per group: the label with the highest count, ties to the smallest label
    (sort + drop_duplicates in the reference, W-2/W-3).

    An aggregate (min over a struct), not a window: partial aggregation keeps
    every group's state at one row.
    """
    # A null label is skipped inside the aggregate (not by a filter), so the
    # input's plan stays identical to its other consumers and can be reused.
    best = F.min(F.when(F.col(label_col).isNotNull(),
                        F.struct((-F.col(count_col)).alias("_neg"), F.col(label_col).alias("_lab"))))
    out = df.groupBy(*keys).agg(best.alias("_best")).where(F.col("_best").isNotNull())
    return out.select(*keys, F.col("_best._lab").alias(out_col or label_col),
                      (-F.col("_best._neg")).alias(count_col))


def top_k(df: DataFrame, order: Sequence, k: int, rank_col: str | None = "rank") -> DataFrame:
    """Sort + limit (O-2): each partition keeps its best k, the driver merges
    k x partitions rows.  The rank is numbered over the k survivors only."""
    top = df.orderBy(*order).limit(k)
    if rank_col is None:
        return top
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def nlargest(df: DataFrame, col: str, k: int, tie_keys: Sequence[str], rank_col: str = "rank") -> DataFrame:
    """n largest by one measure; ties resolved by ``tie_keys`` ascending (O-3, G-13)."""
    return top_k(df, [F.col(col).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie_keys]],
                 k, rank_col)


def arg_extreme(df: DataFrame, measure: str, label_cols: Sequence[str], largest: bool = True) -> DataFrame:
    """Row holding the max (or min) of ``measure``; ties to the smallest labels (O-4)."""
    m = F.col(measure)
    order = [m.desc_nulls_last() if largest else m.asc_nulls_last(),
             *[F.col(c).asc_nulls_last() for c in label_cols]]
    return df.where(m.isNotNull()).orderBy(*order).limit(1)


def explicit_order(df: DataFrame, col: str, order: Sequence[str], position_col: str = "position") -> DataFrame:
    """Attach the position of ``col`` in a fixed category list; unknown values
    get null and sort last (O-5)."""
    expr = None
    for i, v in enumerate(order):
        expr = (F.when(F.col(col) == v, F.lit(i + 1)) if expr is None
                else expr.when(F.col(col) == v, F.lit(i + 1)))
    return df.withColumn(position_col, expr.cast("int"))
