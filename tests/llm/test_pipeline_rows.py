"""Pipeline stages that pick rows: no copy of the texts is written, none is shuffled, and every row is told apart."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from zonecast.llm import op08_mixing
from zonecast.session import ensure_checkpoint_dir

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _texts(n, words=200):
    rng = random.Random(3)
    return [" ".join(f"{rng.getrandbits(48):x}" for _ in range(words + i % 7)) for i in range(n)]


def _rows():
    texts = _texts(240)
    rows = [(i, t, "en", "abc"[i % 3], len(t)) for i, t in enumerate(texts)]
    rows += [(300, texts[5], "en", "a", 1), (None, texts[6], "de", "b", 2), (7, texts[7], "fr", "c", 3)]  # copies
    rows += [(9, " ".join(reversed(texts[0].split())), "en", "a", 4)]  # an id that another text has
    rows += [(None, None, "en", None, 0), (None, None, "en", None, 0), (301, " ", "en", "b", 1)]  # without words
    return rows


def _files(spark, tmp_path, rows, parts):
    spark.createDataFrame(rows, SCHEMA).repartition(parts).write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


def _bytes(folder):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names}


def _stay(rows):
    """What near-dedup leaves of ``_rows``: of equal texts the smallest id, nulls last."""
    best = {}
    for r in rows:
        if (r[1] or "").strip():
            best.setdefault(r[1], []).append(r)
    first = [min(x, key=lambda r: (r[0] is None, r[0] or 0)) for x in best.values()]
    return Counter((r[0], r[1]) for r in first) + Counter((r[0], r[1]) for r in rows if not (r[1] or "").strip())


def _mixed(docs):
    """What mixing makes of files' rows: each as often as the mix takes it."""
    keyed = corpus_pipeline._keyed(docs, "t-mix")
    mixed = op08_mixing.mix(keyed.select(F.col("_key").alias("doc_id"), "text", "source")).select("doc_id", "size", "copies").collect()
    times = {r["doc_id"]: r["copies"] if r["size"] else 1 for r in mixed}
    assert {0, 1, 2} >= set(times.values()) and len(times) == docs.count()
    want = Counter()
    for r in keyed.collect():
        want[(r["doc_id"], r["text"])] += times[r["_key"]]
    return +want


@pytest.mark.parametrize("name", ["near_dedup", "mixing"])
def test_texts_of_files_are_neither_copied_nor_shuffled(spark, tmp_path, name):
    docs = _files(spark, tmp_path, _rows(), 3)
    scratch = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = _bytes(scratch)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        out = dict(corpus_pipeline.STAGES)[name](spark, docs, "")
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = Counter((r["doc_id"], r["text"]) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    left = sum(n for f, n in _bytes(scratch).items() if f not in before)
    assert left < sum(_bytes(tmp_path / "docs").values()) / 4
    assert "hashpartitioning" not in plan
    assert out.columns == docs.columns
    assert got == (_mixed(docs) if name == "mixing" else _stay(_rows()))


def test_near_dedup_of_rows_that_share_a_place_in_a_file(spark, tmp_path):
    docs = _files(spark, tmp_path, _rows(), 3)
    twice = docs.withColumn("again", F.explode(F.array(F.lit(1), F.lit(2)))).drop("again")
    got = corpus_pipeline.near_dedup_stage(spark, twice, "")
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == _stay(_rows() * 2)


def test_rows_that_are_not_files_as_they_are_get_written_keys(spark, tmp_path):
    docs = _files(spark, tmp_path, _rows(), 2)
    assert corpus_pipeline._files_as_they_are(docs)
    for other in (docs.where("doc_id > 3"), docs.unionByName(docs), docs.join(docs.select("doc_id").distinct(), "doc_id"),
                  spark.createDataFrame(_rows(), SCHEMA)):
        assert not corpus_pipeline._files_as_they_are(other)
        keyed = corpus_pipeline._keyed(other, "t-other")
        assert keyed.select("_key").distinct().count() == other.count() == keyed.count()


def test_values_of_neighbouring_keys_are_told_apart(spark):
    keys = [*range(70), (1 << 40) + 31, (1 << 40) + 32, (5 << 33) + 1]
    keyed = spark.createDataFrame([(k, str(k)) for k in keys], "_key bigint, text string")
    values = {k: i % 4 for i, k in enumerate(keys) if k != 40}
    table = spark.createDataFrame(list(values.items()), "_key bigint, _value int")
    got = {r["text"]: r["_value"] for r in corpus_pipeline._with_values(keyed, table, "t-values").collect()}
    assert got == {str(k): v for k, v in values.items() if v}
