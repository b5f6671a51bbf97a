"""Token ids as directly addressable codes in files.

An id is cut into 8-bit chunks, lowest first.  Level 0 holds the first chunk of
every id, level k the (k+1)th chunk of the ids that have one, and a bitmap per
level marks the ids that go on.  A rank directory (ones before every 512 bits)
finds the place of a continued id on the next level in constant time, so any
token is read without decoding its block.

File format: a folder with two tables.  ``segments`` has one row per segment of
whole documents in ascending doc_id order (about 2^16 ids, or one longer
document): ``part, seq, inside, n_tokens, doc_ids, lengths, chunks, bitmaps, ranks``
(``inside``: ids before it in its part).
``index`` has ``part, seq, first_token, n_tokens, first_doc, last_doc``.  Both
are written by Spark, so a lost executor's files are written again.

Defined results: null text is empty and gives the end id alone; null doc_id
comes first; rows of one doc_id follow each other in the order of their texts'
hashes; the string of a special token becomes its id, as the library does; an
empty table gives empty files.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.llm.chunks import LAST_MARKS, PLAIN_WORD, StretchCoder, in_byte_letters, model_ids, replace_rows, slices
from zonecast.llm.common import map_arrow, with_row_ids

CHUNK_BITS = 8
RANK_BITS = 512
SEGMENT_TOKENS = 1 << 16
SEGMENT_DOCS = 4096
_SEGMENT = ("part int, seq int, inside bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, "
            "chunks array<binary>, bitmaps array<binary>, ranks array<binary>")


class DacArray:
    """Directly addressable codes of one sequence of ids."""

    def __init__(self, n: int, chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes]):
        self.n = n
        self.chunks = [np.frombuffer(c, np.uint8) for c in chunks]
        self.bitmaps = [np.frombuffer(b, np.uint8) for b in bitmaps]
        self.ranks = [np.frombuffer(r, "<u4") for r in ranks]

    @staticmethod
    def encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
        chunks, bitmaps, ranks = [], [], []
        rest = ids.astype(np.uint64)
        while True:
            chunks.append((rest & np.uint64(255)).astype(np.uint8).tobytes())
            rest = rest >> np.uint64(CHUNK_BITS)
            more = rest > 0
            bits = np.packbits(more, bitorder="little")
            bitmaps.append(bits.tobytes())
            ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS)) if len(more) else np.zeros(0, np.int64)
            ranks.append(np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4").tobytes() if len(more) else b"")
            if not more.any():
                return chunks, bitmaps, ranks
            rest = rest[more]

    def access(self, i: int) -> int:
        """The ith id; each level costs one rank lookup over at most 64 bytes."""
        value, shift = 0, 0
        for chunk, bits, rank in zip(self.chunks, self.bitmaps, self.ranks, strict=True):
            value |= int(chunk[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            block = i // RANK_BITS
            inside = np.unpackbits(bits[block * RANK_BITS // 8:(i >> 3) + 1], bitorder="little")
            i = int(rank[block]) + int(inside[:i - block * RANK_BITS].sum())
            shift += CHUNK_BITS
        raise ValueError("continuation bit on the last level")

    def decode(self) -> np.ndarray:
        out = np.zeros(self.n, np.uint64)
        at = np.arange(self.n)
        for k, (chunk, bits) in enumerate(zip(self.chunks, self.bitmaps, strict=True)):
            out[at] |= chunk.astype(np.uint64) << np.uint64(k * CHUNK_BITS)
            at = at[np.unpackbits(bits, bitorder="little", count=len(at)).astype(bool)]
        return out.astype("<u4")


class ChunkedTokenizer:
    """Ids of whole texts from the tokenizers library, by their distinct stretches.

    In the byte-level pre-tokenizer a single space or line feed between two
    other characters always starts a new piece, and so do the marks between a
    letter and such a break; what lies between encodes the same alone as inside
    its document.  Each different stretch is given to the library once; a text
    with any other white-space edge (runs, leading or trailing space), with the
    string of a special token or with ``GLUED`` in it is given to it whole.

    A stretch that starts with a line feed stands at the start of a line, one
    that starts with ``GLUED`` follows without a space, any other follows a space.
    """

    GLUED = "\x01"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.line_feed = self._whole(["\n"])[0]
        self.coder = StretchCoder(self._learn)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, new: list[str]) -> list[bytes | None]:
        done: dict[str, bytes | None] = {}
        other: list[tuple[str, str, bytes]] = []
        for s in new:
            lead, body, before = " ", s, b""
            if s[:1] == "\n":
                lead, body, before = "", s[1:], self.line_feed
            elif s[:1] == self.GLUED:
                lead, body = "", s[1:]
            if not body or body[0].isspace() or body[-1].isspace():
                done[s] = None
            elif PLAIN_WORD.fullmatch(body):
                done[s] = before + model_ids(self.tokenizer.model, in_byte_letters(lead + body))
            else:
                other.append((s, lead + body, before))
        for (s, _, before), ids in zip(other, self._whole([x for _, x, _ in other]), strict=True):
            done[s] = before + ids
        return [done[s] for s in new]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and ids per text."""
        texts = pc.fill_null(texts, "")
        whole = np.zeros(len(texts), bool)
        for s in (*self.special, self.GLUED):
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        cut = pc.replace_substring_regex(texts, LAST_MARKS, rf"\1 {self.GLUED}\2\3")
        # every text starts a line here; the line feed's id is taken off again
        cut = pc.binary_join_element_wise("\n", pc.replace_substring(cut, "\n", " \n"), "")
        ids, sizes, wrong = self.coder.encode(pc.split_pattern(cut, " "))
        keep = np.ones(len(ids), bool)
        keep[(np.cumsum(sizes) - sizes)[sizes > 0]] = False
        ids, sizes = ids[keep], np.maximum(sizes - 1, 0)
        rows = np.flatnonzero(whole | wrong)
        return replace_rows(ids, sizes, rows, [np.frombuffer(x, "<u4") for x in self._whole(texts.take(pa.array(rows)).to_pylist())])


_tokenizers: dict[str, ChunkedTokenizer] = {}


def tokenizer(path: str) -> ChunkedTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = ChunkedTokenizer(path)
    return _tokenizers[path]


def _segment(part: int, seq: int, inside: int, docs: pa.Array, lengths: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    codes = DacArray.encode(ids)
    one = np.array([0, len(docs)], np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([inside], pa.int64()),
         pa.array([len(ids)], pa.int64()),
         pa.ListArray.from_arrays(pa.array(one), docs), pa.ListArray.from_arrays(pa.array(one), pa.array(lengths)),
         *(pa.array([x], pa.list_(pa.binary())) for x in codes)],
        ["part", "seq", "inside", "n_tokens", "doc_ids", "lengths", "chunks", "bitmaps", "ranks"])


def _with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids with the end id after them."""
    ends = np.cumsum(sizes + 1)
    out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint32)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[inner] = ids
    return out, sizes + 1


def _write_segments(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, inside = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for a, b in slices(batch.column(1)):
                docs = batch.column(0).slice(a, b - a)
                ids, sizes = _with_end(*tokenizer(path).encode(batch.column(1).slice(a, b - a)), end_id)
                ends = np.cumsum(sizes)
                at = 0
                while at < len(sizes):
                    before = int(ends[at] - sizes[at])
                    stop = min(max(at + 1, int(np.searchsorted(ends, before + SEGMENT_TOKENS, "right"))), at + SEGMENT_DOCS)
                    yield _segment(part, seq, inside, docs.slice(at, stop - at), sizes[at:stop], ids[before:int(ends[stop - 1])])
                    at, seq, inside = stop, seq + 1, inside + int(ends[stop - 1]) - before
    return run


def write_token_files(documents: DataFrame, out: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Encode every text, append ``end_id`` and write the token files to folder ``out``."""
    spark = documents.sparkSession
    docs = with_row_ids(documents, "doc_id", "text")
    # a repeated id is spread by its texts
    docs = docs.withColumn("print", F.xxhash64("text"))
    docs = docs.repartitionByRange("doc_id", "print").sortWithinPartitions("doc_id", "print", "text").drop("print")
    (map_arrow(docs, _write_segments(tokenizer_path, end_id), _SEGMENT)
     .write.mode("error").option("compression", "none").parquet(f"{out}/segments"))
    head = spark.read.parquet(f"{out}/segments").select(
        "part", "seq", "inside", "n_tokens", F.col("doc_ids")[0].alias("first_doc"),
        F.element_at("doc_ids", -1).alias("last_doc"))
    # a running sum over the parts (one row per write task); ``inside`` was counted while writing
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = head.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    (head.join(parts, "part")
     .select("part", "seq", (F.col("offset") + F.col("inside")).alias("first_token"), "n_tokens", "first_doc", "last_doc")
     .write.mode("error").parquet(f"{out}/index"))


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = DacArray(row["n_tokens"], row["chunks"], row["bitmaps"], row["ranks"]).decode()
            ends = np.cumsum(row["lengths"], dtype=np.int64)
            starts = ends - row["lengths"]
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first_token"], pa.int64()),
                 pa.array(row["lengths"], pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 (from the decoded ids)."""
    parts = spark.read.parquet(f"{out}/index").groupBy("part").agg(F.min("first_token").alias("offset"))
    rows = spark.read.parquet(f"{out}/segments").join(parts, "part").select(
        "n_tokens", (F.col("offset") + F.col("inside")).alias("first_token"), "doc_ids", "lengths",
        "chunks", "bitmaps", "ranks")
    return map_arrow(rows, _read_documents, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_at(spark: SparkSession, out: str, position: int) -> int | None:
    """The id at a position of the whole sequence: one index row, one segment, no decoding."""
    hit = spark.read.parquet(f"{out}/index").where(
        (F.col("first_token") <= position) & (F.col("first_token") + F.col("n_tokens") > position)).head()
    if hit is None:
        return None
    row = spark.read.parquet(f"{out}/segments").where(
        (F.col("part") == hit["part"]) & (F.col("seq") == hit["seq"])).head()
    return DacArray(row["n_tokens"], row["chunks"], row["bitmaps"], row["ranks"]).access(position - hit["first_token"])
