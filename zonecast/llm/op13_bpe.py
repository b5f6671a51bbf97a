"""BPE encoding and decoding with tree concatenation of long unsplit text.

A space or line feed always ends a word of this tokenizer, so the stretches
between them encode alone; the library encodes each different stretch once a
batch.  A word that its pre-tokenizer does not split and that is longer than
``LEAF`` symbols is encoded as a tree: it is halved until the halves fit a leaf,
the leaves are encoded in parallel, and neighbours are joined pairwise upwards.
At each join a window of the last tokens of the left and the first of the right
half is encoded again and grows until its outermost tokens agree with both
halves.  Merges are applied in rank order, so a sequence is the encoding of its
text exactly when every two neighbouring tokens are the encoding of theirs;
agreement on one token at either edge of the window therefore makes the join
exact.  Inside a word the merges run without the end-of-word mark, which
belongs to the last leaf alone.

Texts longer than ``SPREAD`` characters are dealt out: their stretches, and the
halves of words longer than that, go to other tasks, and the parts meet
again by document.

Defined results: null or empty text has no ids; strings of special tokens
become their ids, as the library does; repeated rows are encoded each; an
empty table gives an empty result; extra columns stay out.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.chunks import LAST_MARKS, PLAIN_WORD, StretchCoder, in_byte_letters, model_ids, slices
from zonecast.llm.common import map_arrow, with_row_ids, write_table

LEAF = 64
SPREAD = 1 << 15
WINDOW = 4


class TreeBpe:
    """One tokenizer: whole stretches through the library, long words by tree concatenation."""

    def __init__(self, path: str, leaf: int = LEAF):
        from tokenizers import Tokenizer

        self.leaf = max(2, leaf)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        inner = json.loads(self.tokenizer.to_str())
        self.suffix = len(inner["model"]["end_of_word_suffix"] or "")
        inner["model"]["end_of_word_suffix"] = None
        # the same merges for symbols that do not end their word
        self.inner = Tokenizer.from_str(json.dumps(inner)).model
        self.last = self.tokenizer.model
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: i for i, t in added.items()}
        names = sorted(self.special, key=len, reverse=True)
        self.special_re = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None
        self.names = {i: s for s, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.coder = StretchCoder(self.learn)

    # --- words -----------------------------------------------------------------------

    def words(self, stretch: str) -> list[str | int]:
        """What the pre-tokenizer makes of a stretch: words in the byte alphabet, and ids of special strings."""
        parts = self.special_re.split(stretch) if self.special_re else [stretch]
        out: list[str | int] = []
        for p in parts:
            if p in self.special:
                out.append(self.special[p])
            elif p:
                out += [w for w, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(p))]
        return out

    def encode_part(self, symbols: str, last: bool) -> list[int]:
        return [t.id for t in (self.last if last else self.inner).tokenize(symbols)]

    def text_of(self, ids: list[int], last: bool) -> str:
        s = "".join([self.names[i] for i in ids])
        return s[:-self.suffix] if last and self.suffix else s

    def leaves(self, word: str) -> list[str]:
        """The word halved until every half has at most ``leaf`` symbols."""
        if len(word) <= self.leaf:
            return [word]
        mid = len(word) // 2
        return self.leaves(word[:mid]) + self.leaves(word[mid:])

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The encoding of both halves' text: a window around the join grows until both sides agree."""
        k = WINDOW
        while True:
            a, b = min(k, len(left)), min(k, len(right))
            ends = last and b == len(right)
            text = self.text_of(left[len(left) - a:], False) + self.text_of(right[:b], ends)
            got = self.encode_part(text, ends)
            agree_left = a == len(left) or got[0] == left[-a]
            agree_right = b == len(right) or got[-1] == right[b - 1]
            if agree_left and agree_right:
                return left[:len(left) - a] + got + right[b:]
            k *= 2

    def join_all(self, parts: list[list[int]], last: bool = True) -> list[int]:
        """Neighbours joined pairwise, level by level; ``last``: the final part ends its word."""
        while len(parts) > 1:
            pairs = range(0, len(parts) - 1, 2)
            joined = [self.join(parts[i], parts[i + 1], last and i + 2 == len(parts)) for i in pairs]
            parts = joined + parts[len(joined) * 2:]
        return parts[0] if parts else []

    def encode_word(self, word: str, last: bool = True) -> list[int]:
        leaves = self.leaves(word)
        return self.join_all([self.encode_part(x, last and k == len(leaves) - 1) for k, x in enumerate(leaves)], last)

    # --- stretches and texts -------------------------------------------------------------

    def learn(self, new: list[str]) -> list[bytes]:
        """Ids of stretches: plain short words by the merges alone, long words by the tree, the rest by the library."""
        done, other = {}, []
        for s in new:
            if len(s) > self.leaf:
                ids: list[int] = []
                for w in self.words(s):
                    ids += [w] if isinstance(w, int) else self.encode_word(w)
                done[s] = array("I", ids).tobytes()
            elif PLAIN_WORD.fullmatch(s):
                done[s] = model_ids(self.last, in_byte_letters(s.lower()))
            else:
                other.append(s)
        for s, e in zip(other, self.tokenizer.encode_batch(other, add_special_tokens=False), strict=True):
            done[s] = array("I", e.ids).tobytes()
        return [done[s] for s in new]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and ids per text."""
        plain = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        low = pc.ascii_lower(plain)
        if not any(pc.any(pc.match_substring(low, s.lower())).as_py() for s in self.special):
            # fewer different stretches: one case, and the marks after a word on their own
            plain = pc.replace_substring_regex(low, LAST_MARKS, r"\1 \2\3")
        ids, sizes, _ = self.coder.encode(pc.split_pattern(plain, " "))
        return ids, sizes


_models: dict[tuple[str, int], TreeBpe] = {}


def model(path: str, leaf: int = LEAF) -> TreeBpe:
    if (path, leaf) not in _models:
        _models[path, leaf] = TreeBpe(path, leaf)
    return _models[path, leaf]


def _lists(sizes: np.ndarray, flat: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def _encode(path: str, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                flat, sizes = model(path, leaf).encode(batch.column(1).slice(a, b - a))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), _lists(sizes, flat)], ["doc_id", "ids"])
    return run


# --- texts that are dealt out ------------------------------------------------------------------

_PART = "row bigint, part int, kind int, last boolean, body string"
_TEXT, _HALF, _ID = 0, 1, 2  # a run of whole stretches; a part of one long word; the id of a special string


def _cut(path: str, leaf: int, spread: int):
    """Rows (row, part, ...) of each long text, in order."""
    def parts(text: str) -> Iterator[tuple[int, bool, str]]:
        tree, held, size = model(path, leaf), [], 0
        for stretch in text.replace("\n", " ").split(" "):
            if held and size + len(stretch) > spread:
                yield _TEXT, True, " ".join(held)
                held, size = [], 0
            if len(stretch) <= spread:
                held.append(stretch)
                size += len(stretch) + 1
                continue
            for w in tree.words(stretch):
                if isinstance(w, int):
                    yield _ID, True, str(w)
                    continue
                ends = [*range(0, len(w), spread)[1:], len(w)]
                for a, b in zip([0, *ends], ends):
                    yield _HALF, b == len(w), w[a:b]
        if held:
            yield _TEXT, True, " ".join(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held, size = [], 0
                for k, p in enumerate(parts(text.as_py())):
                    held.append((row, k, *p))
                    size += len(p[2])
                    if size > 16 * spread:
                        yield _part_batch(held)
                        held, size = [], 0
                yield _part_batch(held)
    return run


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      ["row", "part", "kind", "last", "body"])


def _encode_parts(path: str, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, out = model(path, leaf), []
            for kind, last, body in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                if kind == _TEXT:
                    out.append(tree.encode(pa.array([body]))[0])
                else:
                    out.append(np.array([int(body)] if kind == _ID else tree.encode_word(body, last), np.uint32))
            flat = np.concatenate(out or [np.zeros(0, np.uint32)])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], _lists(np.array([len(x) for x in out], np.int64), flat)],
                                             ["row", "part", "kind", "last", "ids"])
    return run


def _assemble(path: str, leaf: int):
    """One document's parts -> its ids: halves of a word meet by the same joins as leaves do."""
    def run(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
        tree, ids, word = model(path, leaf), [], []
        parts = parts.sort_by("part")
        for kind, last, x in zip(*(parts.column(c).to_pylist() for c in ("kind", "last", "ids")), strict=True):
            if kind != _HALF:
                ids += x
                continue
            word.append(x)
            if last:
                ids += tree.join_all(word)
                word = []
        return pa.table({"row": pa.array([key[0].as_py()], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int32()))})
    return run


def _whole(documents: DataFrame, tokenizer_path: str, leaf: int, spread: int, finish, schema: str) -> DataFrame:
    """Ids of every row, each batch of (doc_id, ids) given to ``finish`` in the worker that made it."""
    docs = with_row_ids(documents, "doc_id", "text")
    coder = _encode(tokenizer_path, leaf)
    near = map_arrow(docs.where(F.coalesce(F.length("text") <= spread, F.lit(True))), lambda batches: finish(coder(batches)), schema)
    far, _ = write_table(docs.where(F.length("text") > spread).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"),
                         "long-texts")
    parts = map_arrow(far.select("row", "text"), _cut(tokenizer_path, leaf, spread), _PART)
    coded = map_arrow(parts.repartition("row", "part"), _encode_parts(tokenizer_path, leaf),
                      "row bigint, part int, kind int, last boolean, ids array<int>")
    met = coded.groupBy("row").applyInArrow(_assemble(tokenizer_path, leaf), "row bigint, ids array<int>")
    met = (far.select("row", "doc_id").join(met, "row", "left")
           .select("doc_id", F.coalesce("ids", F.expr("cast(array() as array<int>)")).alias("ids")))
    return near.unionByName(map_arrow(met, finish, schema))


def encode(documents: DataFrame, tokenizer_path: str, leaf: int = LEAF, spread: int = SPREAD) -> DataFrame:
    """doc_id and ids of every row of ``documents``."""
    return _whole(documents, tokenizer_path, leaf, spread, lambda batches: batches, "doc_id bigint, ids array<int>")


def _token_slices(ids: pa.ListArray, limit: int = 1 << 20) -> Iterator[pa.ListArray]:
    """Runs of rows with about ``limit`` ids."""
    ends = np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ids):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield ids.slice(at, stop - at)
        at = stop


def _joined(ids: pa.ListArray, names: pa.Array) -> pa.Array:
    """Every row's names with one space between."""
    offsets = ids.offsets.to_numpy()
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), names.take(ids.flatten())), " ")


@lru_cache(maxsize=2)
def _names(path: str) -> tuple[pa.Array, pa.Array]:
    """Token strings and decimal numbers by id."""
    from tokenizers import Tokenizer

    names = {i: s for s, i in Tokenizer.from_file(path).get_vocab(with_added_tokens=True).items()}
    return (pa.array([names.get(i, "") for i in range(max(names) + 1)], pa.string()),
            pa.array([str(i) for i in range(max(names) + 1)], pa.string()))


def _decode(path: str):
    """The text of ids: the tokens' strings with one space between, since the tokenizer names no decoder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, _ = _names(path)
        for batch in batches:
            at = 0
            for ids in _token_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), ids, _joined(ids, names)],
                                                 ["doc_id", "ids", "decoded"])
                at += len(ids)
    return run


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids -> with ``decoded``, the text that the ids stand for (special strings kept)."""
    return map_arrow(encoded.select("doc_id", "ids"), _decode(tokenizer_path), "doc_id bigint, ids array<int>, decoded string")


def _digest(path: str):
    """Digests of ids and decoded text by document, without the texts leaving the worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, numbers = _names(path)
        for batch in batches:
            at = 0
            for ids in _token_slices(batch.column(1)):
                sums = [pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in _joined(ids, x)], pa.string()) for x in (numbers, names)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(ids)), pc.list_value_length(ids).cast(pa.int64()), *sums],
                                                 ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(ids)
    return run


_DIGEST = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digest(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids, one space between), decoded_sha256."""
    return map_arrow(encoded.select("doc_id", "ids"), _digest(tokenizer_path), _DIGEST)


def encode_and_digest(documents: DataFrame, tokenizer_path: str, leaf: int = LEAF, spread: int = SPREAD) -> DataFrame:
    """``digest`` of ``encode``, with the ids handed on inside the worker."""
    return _whole(documents, tokenizer_path, leaf, spread, _digest(tokenizer_path), _DIGEST)
