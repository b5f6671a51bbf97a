"""Encoding of text batches by their distinct stretches.

Arrow cuts a batch at its breaks and dictionary-encodes the stretches, so each
different stretch is looked up once a batch and given to the library once a
worker; the ids of the texts are then gathered by code with numpy.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once, and stretches that a worker remembers.
SLICE_BYTES = 4 << 20
CACHE_MAX = 800_000


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """(start, stop) of runs of rows with about ``limit`` bytes of text; a longer text is a run of its own."""
    if not len(texts):
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield at, stop
        at = stop


def byte_letters() -> dict[int, str]:
    """Byte-level alphabet: a printable byte is its own character, the others follow from 256 up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


_BYTE_LETTERS = byte_letters()
#: Letters that keep their form under composition and have one lower-case letter each.
PLAIN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: ASCII marks (no apostrophe) between such a letter and a break: one piece to either pre-tokenizer.
LAST_MARKS = "([A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@\\[-`{-~]+)( |\n|$)"


def in_byte_letters(text: str) -> str:
    return text if text.isascii() and " " not in text else text.encode().decode("latin-1").translate(_BYTE_LETTERS)


def model_ids(model, text: str) -> bytes:
    """Ids that the merges give one word of the byte alphabet."""
    return array("I", [t.id for t in model.tokenize(text)]).tobytes()


def gather(codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the stretches ``flat[starts[c]:starts[c] + sizes[c]]`` of all codes; also the size of each."""
    size = sizes[codes]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(starts[codes] - (ends - size), size)
    return flat[at], size


class StretchCoder:
    """Ids of stretches as 32-bit numbers; ``learn`` gives those of new stretches (None: not encodable alone).

    Two generations of at most half of ``cache_max`` are remembered: what was asked for
    since the younger one began, and what was before.  So frequent stretches stay.
    """

    def __init__(self, learn: Callable[[list[str]], list[bytes | None]], cache_max: int = CACHE_MAX):
        self.learn, self.cache_max = learn, cache_max
        self.young: dict[str, bytes | None] = {}
        self.old: dict[str, bytes | None] = {}

    def ids_of(self, values: list[str]) -> list[bytes | None]:
        young, old = self.young, self.old
        new = [v for v in values if v not in young]
        asked = [v for v in new if v not in old]
        fresh = dict(zip(asked, self.learn(asked), strict=True)) if asked else {}
        now = {v: fresh[v] if v in fresh else old[v] for v in new}
        out = [now[v] if v in now else young[v] for v in values]
        if len(young) + len(now) > self.cache_max // 2:
            self.old, self.young = young, now if len(now) <= self.cache_max // 2 else {}
        else:
            young.update(now)
        return out

    def encode(self, stretches: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, ids per text, and a mask of the texts that hold a stretch not encodable alone."""
        offsets = stretches.offsets.to_numpy().astype(np.int64)
        coded = stretches.flatten().dictionary_encode()
        parts = self.ids_of(coded.dictionary.to_pylist())
        codes = coded.indices.to_numpy(zero_copy_only=False)
        bad = np.array([p is None for p in parts], bool)
        sizes = np.array([len(p or b"") for p in parts], np.int64) // 4
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join([p or b"" for p in parts]), "<u4")
        ids, size = gather(codes, starts, sizes, flat)
        total = np.concatenate([[0], np.cumsum(size)])
        wrong = np.concatenate([[0], np.cumsum(bad[codes])])
        offsets = offsets - offsets[0]
        return (ids, total[offsets[1:]] - total[offsets[:-1]],
                wrong[offsets[1:]] > wrong[offsets[:-1]])


def replace_rows(ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray, new: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The ids with those of the given rows put in anew."""
    if not len(rows):
        return ids, sizes
    ends = np.cumsum(sizes)
    parts, at = [], 0
    for r, x in zip(rows.tolist(), new, strict=True):
        parts += [ids[at:ends[r] - sizes[r]], x]
        at = ends[r]
    sizes = sizes.copy()
    sizes[rows] = [len(x) for x in new]
    return np.concatenate([*parts, ids[at:]]), sizes
