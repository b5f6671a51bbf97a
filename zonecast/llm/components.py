"""Connected components over a table of links, with label propagation and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import drop_tables, write_table


def connected_components(links: DataFrame) -> tuple[DataFrame, str]:
    """(a, b) links -> (node, comp) with comp the smallest node reachable.

    Each round takes the smallest label among a node's neighbours and then the
    label of that label, so long chains shrink geometrically.  Labels are
    written to the shared scratch folder each round; only the count of changed
    labels comes to the driver.  Nodes without a link are absent.
    """
    spark = links.sparkSession
    both, both_path = write_table(
        links.where("a <> b").select("a", "b").unionByName(
            links.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))), "cc-edges")
    labels, path = write_table(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("comp")), "cc-labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m")))
        low, low_path = write_table(
            labels.join(near, "node", "left")
            .select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp")), "cc-low")
        jump = low.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new, new_path = write_table(
            low.join(jump, "comp", "left").select("node", "old", F.least("comp", "far").alias("comp")),
            "cc-labels")
        changed = new.where("comp <> old").limit(1).count()
        drop_tables(spark, [low_path, path])
        labels, path = new.select("node", "comp"), new_path
        if not changed:
            drop_tables(spark, [both_path])
            return labels, path
