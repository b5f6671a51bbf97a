"""Mixing sources to target weights by entropy balancing.

Each source has a target in words.  Among all document rates r between 0 and 2
with sum(size * r) = target, entropy balancing takes those nearest to the even
rate 1, which are an exponential tilt: r / (2 - r) = exp(lambda * size / mean size),
one lambda per source.  Newton steps on the convex dual find lambda.  The rate
depends on source and size only, so the steps run on the table of
(source, size, count), never on documents, and no group larger than the
different sizes of a source meets in one task.

Rates become copies (0, 1 or 2 per document) so that the words taken hit the
target: running sums over the sizes in falling order round to whole copies,
which leaves less than one document's error, and a few exchange steps add or
drop copies of the largest size that fits the rest.  Within a cell of equal
(source, size) the documents with the smallest hashes take the extra copy;
ranks are counted in hash buckets, so that a hot cell is spread.

Defined results: null or empty text has size 0 and takes nothing; null sources
are one source, the last; a source without words has target 0; rows of one
doc_id count each for themselves; an empty table gives an empty result; reruns
agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.llm.common import SPACE, drop_tables, with_row_ids, write_table
from zonecast.operators.joins import maybe_broadcast

MAX_COPIES = 2
#: Fixed value of the contract: weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
NEWTON_STEPS = 25
EXCHANGE_STEPS = 6
BUCKET_ROWS = 256


def targets(sources: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> with target: shares of ``share`` times all words by
    weight, none above twice its source, the excess shared again by weight.

    Sources in the order of their cap per weight reach their cap first; one
    running sum over that order finds the level at which the rest divides.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    # one row per source: sources are few next to documents
    ranked = sources.withColumn("k", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("k") % len(weights) + 1).cast("int")))
    cap = F.col("cap")
    level = W.orderBy((cap / F.col("weight")).asc(), F.col("k").asc())
    before = level.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    filled = (ranked.withColumn("cap", MAX_COPIES * F.col("source_size").cast("double"))
              .withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
              .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .withColumn("words_left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              .withColumn("each", F.col("words_left") / F.col("weight_left")))
    # below the first source whose cap is not reached, all divide at that source's level
    open_level = F.min(F.when(F.col("each") * F.col("weight") <= cap, F.struct(cap / F.col("weight"), F.col("k"), "each"))).over(everything)
    return (filled.withColumn("open", open_level["each"])
            .withColumn("target", F.least(cap, F.coalesce(F.col("open") * F.col("weight"), cap)))
            .select("source", "source_size", "target"))


def _same(a: str, b: str) -> str:
    return f"{a}.source <=> {b}.source"


def _rates(cells: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, size, n) -> with rate, by Newton steps on one lambda per source."""
    # z keeps exponents moderate: sizes in units of the source's mean
    base = (cells.alias("c").join(maybe_broadcast(goals).alias("g"), F.expr(_same("c", "g")))
            .select("c.source", "c.size", "c.n", "g.target", "g.source_size", "g.docs")
            .withColumn("z", F.col("size") * F.col("docs") / F.greatest(F.col("source_size"), F.lit(1))))
    # a source's cells are its different sizes; Newton runs as a fold over nothing but their sums
    lam = goals.select("source", F.lit(0.0).alias("lam"), F.lit(-5000.0).alias("low"), F.lit(5000.0).alias("high"))
    spark = cells.sparkSession
    old: list[str] = []
    for step in range(NEWTON_STEPS):
        rate = 2 / (1 + F.exp(-F.least(F.greatest(F.col("lam") * F.col("z"), F.lit(-700.0)), F.lit(700.0))))
        sums = (base.alias("b").join(maybe_broadcast(lam).alias("l"), F.expr(_same("b", "l")))
                .select("b.*", "l.lam", "l.low", "l.high").withColumn("r", rate)
                .groupBy("source", "target", "source_size", "lam", "low", "high")
                .agg(F.sum(F.col("n") * F.col("size") * F.col("r")).alias("got"),
                     F.sum(F.col("n") * F.col("size") * F.col("z") * F.col("r") * (1 - F.col("r") / 2)).alias("slope")))
        gap = F.col("got") - F.col("target")
        moved = (sums.withColumn("low", F.when(gap < 0, F.col("lam")).otherwise(F.col("low")))
                 .withColumn("high", F.when(gap > 0, F.col("lam")).otherwise(F.col("high")))
                 .withColumn("newton", F.col("lam") - gap / F.greatest(F.col("slope"), F.lit(1e-9)))
                 # a step that leaves the bracket of the convex dual is halved into it
                 .withColumn("lam", F.when(gap == 0, F.col("lam")).when(
                     (F.col("newton") > F.col("low")) & (F.col("newton") < F.col("high")), F.col("newton"))
                     .otherwise((F.col("low") + F.col("high")) / 2))
                 .withColumn("far", F.when(F.col("target") >= 2 * F.col("source_size"), 0.0)
                             .otherwise(F.abs(gap) / F.greatest(F.col("target"), F.lit(1.0)))))
        lam, path = write_table(moved.select("source", "lam", "low", "high", "far"), f"lambda{step}")
        drop_tables(spark, old)
        old = [path]
        if not lam.where("far > 1e-7 AND high - low > 1e-9").limit(1).count():
            break
    rate = 2 / (1 + F.exp(-F.least(F.greatest(F.col("lam") * F.col("z"), F.lit(-700.0)), F.lit(700.0))))
    out, path = write_table(
        base.alias("b").join(maybe_broadcast(lam).alias("l"), F.expr(_same("b", "l"))).select("b.*", "l.lam")
        .withColumn("rate", F.when(F.col("target") >= 2 * F.col("source_size"), F.lit(2.0)).otherwise(rate))
        .select("source", "size", "n", "target", "rate"), "rates")
    drop_tables(spark, old)
    return out


def _copies(cells: DataFrame) -> DataFrame:
    """(source, size, n, target, rate) -> with copies of the whole cell, near the target."""
    run = W.partitionBy("source").orderBy(F.desc("size"))
    up_to = F.sum(F.col("n") * F.col("rate")).over(run)
    first = (cells.withColumn("to", F.floor(up_to + 0.5))
             .withColumn("copies", F.col("to") - F.lag("to", 1, 0).over(run))
             .withColumn("copies", F.least(F.greatest("copies", F.lit(0)), MAX_COPIES * F.col("n")))
             .select("source", "size", "n", "target", "rate", "copies"))
    spark = cells.sparkSession
    state, path = write_table(first, "copies")
    for step in range(EXCHANGE_STEPS):
        rest = state.groupBy("source").agg(
            (F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("rest"))
        open_cells = (state.alias("s").join(rest.alias("r"), F.expr(_same("s", "r"))).select("s.*", "r.rest")
                      .withColumn("room", F.when(F.col("rest") > 0, MAX_COPIES * F.col("n") - F.col("copies")).otherwise(F.col("copies"))))
        fits = open_cells.where("size > 0 AND room > 0 AND size <= abs(rest)")
        pick = fits.groupBy("source").agg(F.max("size").alias("pick"))
        if not pick.limit(1).count():
            break
        change = F.least("room", F.floor(F.abs(F.col("rest")) / F.col("size"))) * F.signum("rest")
        new, new_path = write_table(
            open_cells.alias("s").join(pick.alias("k"), F.expr(_same("s", "k")), "left")
            .select("s.*", F.when(F.expr("size = pick"), change).otherwise(0).cast("long").alias("change"))
            .select("source", "size", "n", "target", "rate", (F.col("copies") + F.col("change")).alias("copies")),
            f"copies{step}")
        drop_tables(spark, [path])
        state, path = new, new_path
    return state


def words_in(text: str) -> Column:
    """Number of words of a text, 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, f"{SPACE}+"))).cast("long")


def mix(documents: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken of every document.

    Tables of one row per source are broadcast up to the size that ``maybe_broadcast`` checks, and shuffled beyond it.
    """
    spark = documents.sparkSession
    sized, sized_path = write_table(
        with_row_ids(documents, "doc_id", "source", "text").select("doc_id", "source", "text", words_in("text").alias("size"))
        .withColumn("h", F.xxhash64("doc_id", "text", F.lit("mix"))).drop("text"), "sized")
    cells, cells_path = write_table(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "cells")
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    goals, _ = write_table(
        targets(sources.drop("docs"), share, weights).alias("t").join(sources.alias("s"), F.expr(_same("t", "s")))
        .select("t.source", "t.source_size", "t.target", "s.docs"), "goals")
    planned, planned_path = write_table(_copies(_rates(cells, goals)), "planned")

    # rank of a document in its cell: ranks of hash buckets, then inside a bucket
    buckets = F.greatest(F.lit(1), F.ceil(F.col("p.n") / BUCKET_ROWS))
    dealt, _ = write_table(
        sized.alias("d").join(planned.alias("p"), F.expr(f"{_same('d', 'p')} AND d.size = p.size"))
        .select("d.*", "p.n", "p.target", "p.rate", F.col("p.copies").alias("cell_copies"),
                # rows without words take nothing wherever they rank, and may all be equal
                F.pmod(F.when(F.col("d.size") > 0, F.xxhash64("h")).otherwise(F.monotonically_increasing_id()), buckets)
                .alias("bucket")), "dealt")
    counts = dealt.groupBy("source", "size", "bucket").agg(F.count("*").alias("m"))
    offset = W.partitionBy("source", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets, _ = write_table(counts.select(
        "source", "size", "bucket", F.coalesce(F.sum("m").over(offset), F.lit(0)).alias("offset")), "offsets")
    inside = W.partitionBy("source", "size", "bucket").orderBy("h", "doc_id")
    ranked = (dealt.withColumn("rank", F.row_number().over(inside)).alias("d")
              .join(offsets.alias("o"), F.expr(f"{_same('d', 'o')} AND d.size = o.size AND d.bucket = o.bucket"))
              .select("d.*", (F.col("d.rank") + F.col("o.offset")).alias("place")))
    copies = (F.floor(F.col("cell_copies") / F.col("n"))
              + (F.col("place") <= F.pmod("cell_copies", "n")).cast("long"))
    out = (ranked.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("int"))
           .alias("r").join(maybe_broadcast(goals).alias("g"), F.expr(_same("r", "g")))
           .select("r.doc_id", "r.source", "r.size", "g.source_size", "r.target", "r.rate", "r.copies",
                   (F.col("r.size") * F.col("r.copies")).alias("taken")))
    drop_tables(spark, [sized_path, cells_path, planned_path])
    return out
