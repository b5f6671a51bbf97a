"""Corpus pipeline: documents through toxicity, near-dedup, secret scan, mixing and SentencePiece.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as
Parquet and read again as the next stage's documents.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import op02_sentencepiece, op03_toxicity, op04_secrets, op07_minmax, op08_mixing
from zonecast.llm.common import table, write_table
from zonecast.llm.queries import PIECE_BPE, held_out, tokenizer_file
from zonecast.operators.joins import maybe_broadcast


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model calls toxic go; the model learns from the labelled rows of these documents.

    Rows without text or id are scored as any other; repeated rows are judged each; an empty
    table, or one without labels, stays as it is.
    """
    model = op03_toxicity.train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    scored = op03_toxicity.toxicity(docs, model, keep=tuple(docs.columns))
    return scored.where("predicted = 0").drop("score", "predicted").select(*docs.columns)


def _files_as_they_are(docs: DataFrame) -> bool:
    """Whether ``docs`` are Parquet files read whole: nothing filters, joins or repeats their rows."""
    if docs._jdf.queryExecution().analyzed().children().nonEmpty():
        return False
    try:
        docs.select(docs.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return False
    return True


def _keyed(docs: DataFrame, name: str) -> DataFrame:
    """The rows with a key of their own (``_key``) that every reader sees the same.

    Rows of files have their file's number and place in it as key, so no copy is made of them; others are written once.
    """
    if not _files_as_they_are(docs):
        return write_table(docs.withColumn("_key", F.monotonically_increasing_id()), name)[0]
    place = docs.metadataColumn("_metadata")
    # one row per file, of which the driver holds the listing already
    paths = sorted(r["_path"] for r in docs.select(place["file_path"].alias("_path")).distinct().collect())
    # as an Arrow table: rows of Python objects would pass through further Python workers of the executors
    files = docs.sparkSession.createDataFrame(
        pa.table([pa.array(range(len(paths)), pa.int64()), pa.array(paths, pa.string())], ["_file", "_path"]))
    placed = docs.select(*docs.columns, place["file_path"].alias("_path"), place["row_index"].alias("_row"))
    return placed.join(F.broadcast(files), "_path").select(
        *docs.columns, (F.shiftleft("_file", 40) + F.col("_row")).alias("_key"))


def _with_values(keyed: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """The rows of ``keyed`` that ``values`` (_key, _value: 1 to 3, once per key) names, with ``_value``.

    The values of 32 neighbouring keys are packed into one number.  That table is broadcast up to the size that
    ``maybe_broadcast`` checks, so texts are shuffled for it only beyond.
    """
    at = (2 * F.col("_key").bitwiseAND(31)).cast("int")
    packed, _ = write_table(
        values.groupBy(F.shiftright("_key", 5).alias("_word")).agg(
            F.bit_or(F.call_function("shiftleft", F.col("_value").cast("long"), at)).alias("_bits")), name)
    return (keyed.withColumn("_word", F.shiftright("_key", 5)).join(maybe_broadcast(packed), "_word")
            .withColumn("_value", F.call_function("shiftright", "_bits", at).bitwiseAND(3)).where("_value > 0").drop("_word", "_bits"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id (rows without an id come last).

    Every row is a document of its own, whatever id it repeats or lacks; rows without words stay.  An empty table
    stays empty.
    """
    keyed = _keyed(docs, "dedup-rows")
    groups = op07_minmax.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("_key"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key"))["_key"]
    stays = groups.join(keyed.select("_key", "doc_id"), "_key").groupBy("component_id").agg(first.alias("_key"))
    return _with_values(keyed, stays.select("_key", F.lit(1).alias("_value")), "kept-rows").select(*docs.columns)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays, its secrets replaced by a mark; null text stays null, and an empty table empty."""
    found, _ = write_table(op04_secrets.find_secrets(docs), "pipeline-secrets")
    return op04_secrets.redact(docs, found).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row appears as often as the mix takes it (none, once or twice).

    Every row is a document of its own, whatever id it repeats or lacks.  Rows without words take
    no room and stay once.  An empty table stays empty.
    """
    keyed = _keyed(docs, "mix-rows")
    taken = op08_mixing.mix(keyed.select(F.col("_key").alias("doc_id"), "text", "source")).select(
        F.col("doc_id").alias("_key"), F.when(F.col("size") > 0, F.col("copies")).otherwise(F.lit(1)).alias("_value"))
    mixed = _with_values(keyed, taken, "pipeline-mix")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_value").cast("int")))).select(*docs.columns)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: doc_id, n_pieces, ids_crc32 and whether decoding gives the text back; null text has no pieces."""
    return op02_sentencepiece.encode_and_decode(docs, tokenizer_file(PIECE_BPE))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: No stage is expressible in SQL as a whole (learned scores, hashing, a tokenizer): tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
