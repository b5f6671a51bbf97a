"""Room of Python workers: batches are limited by bytes, free memory goes back as a task ends, the head is held once, and
small tables take no workers of their own."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

import corpus_pipeline
from zonecast.llm import common, op02_sentencepiece

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    before = spark.conf.get(LIMIT, None)
    spark.conf.unset(LIMIT)
    yield spark
    spark.conf.unset(LIMIT)
    if before is not None:
        spark.conf.set(LIMIT, before)


def _sizes():
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "bytes": [b.nbytes], "ids": [b.column(0).to_pylist()]})
    return run


def _sizes_of_frames():
    def run(frames):
        for f in frames:
            yield pd.DataFrame({"n": [len(f)], "bytes": [int(f["text"].str.len().sum())], "ids": [f["doc_id"].tolist()]})
    return run


def _texts(spark, n, size):
    return spark.range(0, n, 1, 1).selectExpr("id AS doc_id", f"repeat(chr(97 + int(id % 26)), {size}) AS text")


@pytest.mark.parametrize("mapped, run", [(common.map_arrow, _sizes()), (common.map_pandas, _sizes_of_frames())])
def test_batches_are_limited_by_bytes_and_no_row_is_lost(unset, mapped, run):
    got = mapped(_texts(unset, 600, 50_000), run, "n bigint, bytes bigint, ids array<bigint>").collect()
    assert max(r["bytes"] for r in got) <= common.BATCH_BYTES + 100_000  # 30 MB of texts
    assert [i for r in got for i in r["ids"]] == list(range(600))


def test_a_row_beyond_the_limit_goes_alone(unset):
    got = common.map_arrow(_texts(unset, 5, common.BATCH_BYTES + 7), _sizes(), "n bigint, bytes bigint, ids array<bigint>").collect()
    assert [(r["n"], r["ids"]) for r in got] == [(1, [i]) for i in range(5)]


def test_a_limit_of_the_session_stays(unset):
    unset.conf.set(LIMIT, str(1 << 20))
    got = common.map_arrow(_texts(unset, 100, 50_000), _sizes(), "n bigint, bytes bigint, ids array<bigint>").collect()
    assert unset.conf.get(LIMIT) == str(1 << 20)
    assert max(r["bytes"] for r in got) <= (1 << 20) + 100_000


def test_a_task_hands_memory_back_as_it_begins_and_ends(monkeypatch):
    told = []
    monkeypatch.setattr(common, "hand_back", lambda: told.append("back"))

    def run(batches):
        for b in batches:
            told.append(b)
            yield b
    assert list(common._with_room(run)(iter("ab"))) == ["a", "b"]
    assert told == ["back", "a", "b", "back"]


def test_small_tables_need_no_python_workers(spark, tmp_path):
    _texts(spark, 20, 30).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    table = op02_sentencepiece.PieceTable({"▁a": (1, 0), "b": (2, 1)}, {"▁a": -1.0, "b": -2.0}, [], "bpe")
    for df in (corpus_pipeline._keyed(docs, "t"), op02_sentencepiece.lattice(docs.selectExpr("text AS word"), table)):
        assert "ExistingRDD" not in df._jdf.queryExecution().toString()


def test_words_of_the_head_are_looked_up_and_not_remembered():
    head = op02_sentencepiece._Head(["▁a", "\n", "▁é", "▁", "▁▁"], np.arange(1, 8), np.array([1, 2, 1, 1, 2], np.int32))
    want = {"▁a": [1], "\n": [2, 3], "▁é": [4], "▁": [5], "▁▁": [6, 7]}
    words = ["▁é", None, "▁x", "▁▁", "\n", "", "▁a", "▁"]
    assert [x and np.frombuffer(x, "<i4").tolist() for x in head.ids_of(words)] == [want.get(w) for w in words]
    assert op02_sentencepiece._Head([], np.zeros(0), np.zeros(0, np.int32)).ids_of(["▁a", None]) == [None, None]

    asked = []
    coder = op02_sentencepiece._Stretches(head, lambda new: asked.extend(new) or [None] * len(new), 100)
    # no text, a line feed in front and an own space mark are not one word
    got = coder.ids_of(["a", "", "\na", "▁", "é", "x"])
    assert [x and np.frombuffer(x, "<i4").tolist() for x in got] == [[1], None, None, None, [4], None]
    assert asked == ["", "\na", "▁", "x"] and set(coder.young) == set(asked)
