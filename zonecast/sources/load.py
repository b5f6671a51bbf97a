"""Incremental load of relational tables from folders of CSV files (S-6).

A table is a folder of committed batches::

    <table>/data/batch=<id>/   rows of one load, parquet
    <table>/ledger/batch_<id>/ the files of that load: path, length, modified, batch

A load lists the source files with Spark, leaves out those the ledger has,
writes the new files' rows as one batch and then the batch's ledger rows.  The ledger
is the commit: readers see only batches it lists, so a load that failed half way changes
nothing, and running it again writes the same batch anew (its id follows from its files).
Loading a folder twice therefore adds nothing, and a new file adds its rows alone.

One writer at a time per table.  A file that was replaced (other length or time) is an
error: its old rows are part of the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonecast.session import path_exists
from zonecast.sources.sinks import read_csv

_LEDGER = "path string, length bigint, modified timestamp, batch string"


@dataclass(frozen=True)
class LoadResult:
    files: int
    batch: str | None


def source_files(spark: SparkSession, folder: str) -> DataFrame:
    """path, length, modified of the CSV files of a folder; their contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(folder)
            .select("path", "length", F.col("modificationTime").alias("modified")))


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """Committed files of a table; empty before the first load."""
    if not path_exists(spark, f"{table}/ledger"):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).option("recursiveFileLookup", "true").parquet(f"{table}/ledger")


def append_load(spark: SparkSession, folder: str, table: str, schema: StructType) -> LoadResult:
    """Add the rows of the folder's new files to the table; nothing when there are none."""
    known = ledger(spark, table).withColumnRenamed("length", "old_length").withColumnRenamed("modified", "old_modified")
    state = source_files(spark, folder).join(known, "path", "left")
    # paths come to the driver, as for any read of files
    new, changed = [], []
    for r in state.orderBy("path").collect():
        if r["batch"] is None:
            new.append((r["path"], r["length"], r["modified"]))
        elif (r["length"], r["modified"]) != (r["old_length"], r["old_modified"]):
            changed.append(r["path"])
    if changed:
        raise ValueError(f"loaded files were replaced: {', '.join(changed[:5])}")
    if not new:
        return LoadResult(0, None)
    frame = spark.createDataFrame(new, "path string, length bigint, modified timestamp")
    batch = frame.agg(F.md5(F.array_join(F.array_sort(F.collect_list(
        F.concat_ws("|", "path", "length", F.col("modified").cast("double")))), "\n").cast("binary"))).first()[0]
    read_csv(spark, [p for p, _, _ in new], schema).write.mode("overwrite").parquet(f"{table}/data/batch={batch}")
    # the commit: one small file
    frame.withColumn("batch", F.lit(batch)).coalesce(1).write.mode("overwrite").parquet(f"{table}/ledger/batch_{batch}")
    return LoadResult(len(new), batch)


def read_table(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """Rows of all committed batches."""
    batches = sorted(r[0] for r in ledger(spark, table).select("batch").distinct().collect())
    if not batches:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{table}/data/batch={b}" for b in batches])


def load_catalog_tables(spark: SparkSession, folder: str, out: str, schemas: dict[str, StructType]) -> DataFrame:
    """Append-load every table from its sub-folder and count what the tables hold: table_name, row_count (S-6, S-12)."""
    counts = None
    for name, schema in schemas.items():
        append_load(spark, f"{folder}/{name}", f"{out}/{name}", schema)
        one = read_table(spark, f"{out}/{name}", schema).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    return counts
