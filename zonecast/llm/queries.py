"""Registered queries of the dealt operators: thin contract wrappers over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.common import table
from zonecast.llm.op01_dac import read_token_files, write_token_files
from zonecast.llm.op02_sentencepiece import encode_and_decode
from zonecast.llm.op03_toxicity import toxicity, train
from zonecast.llm.op04_secrets import find_secrets
from zonecast.llm.op05_quality import quality
from zonecast.llm.op06_urlfilter import URL_FILTER_SQL, filter_urls, page_captures, page_list_events
from zonecast.llm.op07_minmax import near_duplicates
from zonecast.llm.op08_mixing import mix
from zonecast.llm.op09_topk import top_k
from zonecast.llm.op10_chat import DEFAULT_TEMPLATE, read_formatted, write_formatted
from zonecast.llm.op11_whitening import whiten
from zonecast.llm.op12_divergence import DIVERGENCE_SQL, audit
from zonecast.llm import op13_bpe
from zonecast.session import scratch_path


BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file; every worker has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_dac_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "llm-token-files")
    write_token_files(table(spark, sf_dir, "documents"), out, tokenizer_file(BYTE_BPE))
    return read_token_files(spark, out)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(table(spark, sf_dir, "documents"), tokenizer_file(PIECE_BPE))


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels no model may learn from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return (toxicity(docs, model)
            .select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", "value_sha256", "probability", "is_secret")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(page_captures(pages), page_list_events(pages)).withColumnRenamed("id", "page_id")


def op7_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op9_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=5, every=50)


#: Fixed rows of the contract: a conversation whose texts are control strings.
CONTROL_CONVERSATION = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(CONTROL_CONVERSATION, "conv_id bigint, turn bigint, role string, text string")
    out = scratch_path(spark, "llm-chat")
    write_formatted(turns.unionByName(extra), out, DEFAULT_TEMPLATE)
    return read_formatted(spark, out, DEFAULT_TEMPLATE)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), keep=4)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


def op13_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_bpe.encode_and_digest(table(spark, sf_dir, "documents"), tokenizer_file(WORD_BPE))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_dac_token_files": op1_dac_token_files,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_toxicity": op3_toxicity,
    "op4_secret_scan": op4_secret_scan,
    "op5_quality_rules": op5_quality_rules,
    "op6_url_filter": op6_url_filter,
    "op7_minmax_near_dedup": op7_minmax_near_dedup,
    "op8_entropy_mixing": op8_entropy_mixing,
    "op9_ball_tree_topk": op9_ball_tree_topk,
    "op10_chat_format": op10_chat_format,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_source_divergence": op12_source_divergence,
    "op13_tree_bpe": op13_tree_bpe,
}

ORACLES: dict[str, str] = {"op6_url_filter": URL_FILTER_SQL, "op12_source_divergence": DIVERGENCE_SQL}
