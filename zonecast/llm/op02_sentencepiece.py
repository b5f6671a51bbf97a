"""SentencePiece encoding and decoding over a relational lattice of words.

The text is written as SentencePiece writes it: a dummy space in front, spaces
as U+2581.  No piece of such a model goes on after a space mark behind another
character or over a line feed, so words (space marks and what follows) encode
alone.  A word's lattice holds every substring of bounded length that is a piece:
substrings are exploded, joined with the piece table on equality, grouped by word
as edges, and folded.

Which fold depends on the model.  A unigram model takes the Viterbi fold (best
sum of scores).  A BPE model has scores that order merges, and the best sum does
not give its segmentation; there the fold goes over the edges by rank and takes
an edge when it joins exactly two symbols.  Both folds give what the library gives.

The lattice of the frequent words (whole frequency classes, at most ``HEAD_WORDS`` of
``HEAD_CHARS`` characters) is built and folded in Spark, with its ``aggregate``; their ids are
broadcast, and the bound does not grow with the data.  The other words' ids would have to be
joined back to texts that hold most of them once, which shuffles more than the texts' own size, so
their lattices are built and folded by the same steps in the task that reads the text, at any length (those
of up to ``WordLattices.CHARS`` characters many at once, as arrays); texts are never shuffled.

Defined results: null or empty text has no pieces; characters without a piece
become byte pieces; a U+2581 in a text is read as a space, so decoding gives the
space back; repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.chunks import StretchCoder, replace_rows, slices
from zonecast.llm.common import drop_tables, map_arrow, with_row_ids, worker_cache, write_table

SPACE_MARK = "▁"
HEAD_WORDS = 1 << 18
HEAD_CHARS = 32
_CHUNK = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}\n]+|{SPACE_MARK}+|\n+")
#: Counted words that a task holds before it sums them and hands them on.
_FLUSH = 400_000


@dataclass
class PieceTable:
    """Normal pieces with id and merge rank (or score), and the ids of the 256 byte pieces."""

    pieces: dict[str, tuple[int, int]]  # piece -> (id, rank); a smaller rank merges first
    scores: dict[str, float]
    bytes_: list[int]
    kind: str  # "bpe" or "unigram"
    unknown: int = 0
    texts: dict[int, str] = field(default_factory=dict)
    longest: int = 1
    #: every beginning of a piece, with the piece's rank and id where it is one itself
    beginnings: dict[str, tuple[int, int] | None] = field(default_factory=dict)

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        for p in self.pieces:
            for n in range(1, len(p)):
                self.beginnings.setdefault(p[:n], None)
        self.beginnings.update({p: (rank, i) for p, (i, rank) in self.pieces.items()})


def load_pieces(path: str) -> PieceTable:
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    sp = SentencePieceProcessor(model_file=path)
    try:
        proto = sentencepiece_model_pb2.ModelProto.FromString(sp.serialized_model_proto())
        kind = "unigram" if proto.trainer_spec.model_type == 1 else "bpe"
    except AttributeError:
        kind = "bpe"
    normal = [i for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    by_score = sorted(normal, key=lambda i: (-sp.get_score(i), i))
    rank = {i: k for k, i in enumerate(by_score)}
    byte_of = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
    return PieceTable(
        pieces={sp.id_to_piece(i): (i, rank[i]) for i in normal},
        scores={sp.id_to_piece(i): sp.get_score(i) for i in normal},
        bytes_=[byte_of[b] for b in range(256)] if len(byte_of) == 256 else [],
        kind=kind, unknown=sp.unk_id(), texts={i: sp.id_to_piece(i) for i in normal})


def marked(text: str | None) -> str:
    return SPACE_MARK + text.replace(" ", SPACE_MARK) if text else ""


def words_of(text: str | None) -> list[str]:
    """Stretches of the marked text that no piece crosses."""
    return _CHUNK.findall(marked(text))


# --- the lattice in Spark -----------------------------------------------------------

def lattice(words: DataFrame, table: PieceTable) -> DataFrame:
    """(word) -> word and its edges (rank, start, end, id, score), grouped without a second shuffle
    when ``words`` is distinct by word."""
    spark = words.sparkSession
    # the piece table has the size of the model's vocabulary
    # as an Arrow table: rows of Python objects would pass through further Python workers of the executors
    ids, ranks = zip(*table.pieces.values(), strict=True) if table.pieces else ((), ())
    pieces = spark.createDataFrame(pa.table(
        [pa.array(list(table.pieces), pa.string()), pa.array(ids, pa.int32()), pa.array(ranks, pa.int32()),
         pa.array([table.scores[p] for p in table.pieces], pa.float64())], ["piece", "id", "rank", "score"]))
    # a word grows into hundreds of substrings: deal the words out before, whatever few files they come from
    subs = (words.repartition(4 * spark.sparkContext.defaultParallelism, "word").select("word", F.length("word").alias("n"))
            .select("word", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("start"))
            .select("word", "start", F.explode(F.sequence(
                F.lit(1), F.least(F.lit(table.longest), F.col("n") - F.col("start")))).alias("len"))
            .select("word", "start", (F.col("start") + F.col("len")).alias("end"),
                    F.substring("word", F.col("start") + 1, F.col("len")).alias("piece")))
    return (subs.join(F.broadcast(pieces), "piece")
            .groupBy("word").agg(F.array_sort(F.collect_list(F.struct("rank", "start", "end", "id", "score"))).alias("edges")))


def merge_fold() -> Column:
    """Kept edges of a BPE model: edges by rank, taken when they join exactly two symbols.

    The state is a bit set of the symbol borders; words have at most 62 characters.
    """
    inner = "(shiftleft(1L, e.end) - shiftleft(1L, e.start + 1))"
    mask = ("aggregate(edges, shiftleft(1L, length(word) + 1) - 1, (m, e) -> CASE WHEN"
            " shiftright(m, e.start) & 1 = 1 AND shiftright(m, e.end) & 1 = 1"
            f" AND bit_count(m & {inner}) = 1 THEN m & ~{inner} ELSE m END)")
    return F.expr(f"transform(array({mask}), m -> filter(edges, e -> shiftright(m, e.start) & 1 = 1"
                  f" AND shiftright(m, e.end) & 1 = 1 AND m & {inner} = 0))[0]")


def viterbi_fold() -> Column:
    """Kept edges of a unigram model: best sum of scores over positions; an unmatched character costs
    far more than any piece.  The state holds score and last edge per position."""
    start = ("transform(sequence(0, length(word)), i -> struct(if(i = 0, 0D, -1e9D * i) AS s,"
             " i - 1 AS back, -1 AS id))")
    step = ("transform(a, (x, i) -> CASE WHEN i = e.end AND a[e.start].s + e.score > x.s THEN"
            " struct(a[e.start].s + e.score AS s, e.start AS back, e.id AS id)"
            " WHEN i = e.end AND x.id = -1 AND a[i - 1].s - 1e9D > x.s THEN struct(a[i - 1].s - 1e9D AS s, i - 1 AS back, -1 AS id)"
            " ELSE x END)")
    by_end = "array_sort(edges, (l, r) -> CASE WHEN l.end <> r.end THEN l.end - r.end ELSE l.start - r.start END)"
    best = f"aggregate({by_end}, {start}, (a, e) -> {step})"
    path = ("aggregate(sequence(1, length(word)), struct(length(word) AS at, cast(array() AS array<struct<start:int,end:int,id:int>>) AS p),"
            " (w, k) -> CASE WHEN w.at <= 0 THEN w ELSE struct(b[w.at].back AS at,"
            " array_prepend(w.p, struct(b[w.at].back AS start, w.at AS end, b[w.at].id AS id)) AS p) END).p")
    return F.expr(f"filter(transform(array({best}), b -> {path})[0], e -> e.id >= 0)")


def encode_words(words: DataFrame, table: PieceTable) -> DataFrame:
    """(word) -> word, kept edges (start, end, id); characters outside all of them are byte pieces.

    ``words`` must be distinct.
    """
    fold = viterbi_fold() if table.kind == "unigram" else merge_fold()
    return lattice(words, table).select(
        "word", F.transform(fold, lambda e: F.struct(e["start"].alias("start"), e["end"].alias("end"), e["id"].alias("id"))).alias("kept"))


# --- the same lattice in a task, for words outside the head -----------------------------

def _fill(word: str, kept: list[tuple[int, int, int]], table: PieceTable) -> list[int]:
    """Ids in order; what no edge covers becomes byte pieces (or the unknown id)."""
    if sum([b - a for a, b, _ in kept]) == len(word):
        return [i for _, _, i in sorted(kept)]
    ids, at = [], 0
    for start, end, i in [*sorted(kept), (len(word), len(word), -1)]:
        for c in word[at:start]:
            ids += [table.bytes_[b] for b in c.encode("utf-8", "surrogatepass")] if table.bytes_ else [table.unknown]
        if i >= 0:
            ids.append(i)
        at = end
    return ids


class WordLattices:
    """Lattices of many words at once, held as arrays: the words stand behind one another in one text, so a
    position names a word's place.  Beginnings of pieces are numbered, and a beginning and the next character
    are looked up together in a sorted table."""

    #: Words up to this length are folded together; longer ones would leave the others waiting.
    CHARS = 40
    #: Words of one pass, which bounds its arrays.
    WORDS = 1 << 13

    def __init__(self, table: PieceTable):
        node = {s: k for k, s in enumerate(table.beginnings, 1)}
        self.rank = np.full(len(node) + 1, -1, np.int64)
        self.piece = np.full(len(node) + 1, -1, np.int32)
        for s, found in table.beginnings.items():
            if found is not None:
                self.rank[node[s]], self.piece[node[s]] = found
        self.first = np.zeros(0x110000, np.int32)
        for s, k in node.items():
            if len(s) == 1:
                self.first[ord(s)] = k
        steps = sorted((node[s[:-1]] << 21 | ord(s[-1]), k) for s, k in node.items() if len(s) > 1)
        self.steps = np.array([x for x, _ in steps] or [-1], np.int64)
        self.to = np.array([k for _, k in steps] or [0], np.int64)

    def edges(self, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, node) of every substring of two or more characters that is a piece, per length by start.

        ``ends`` says for every position where its word ends.
        """
        node, at = self.first[codes].astype(np.int64), np.arange(len(codes))
        found, length = [], 1
        while True:
            live = (node > 0) & (at + length < ends[at])
            at, node = at[live], node[live]
            if not len(at):
                break
            key = node << 21 | codes[at + length]
            place = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
            node = np.where(self.steps[place] == key, self.to[place], 0)
            length += 1
            hit = self.rank[node] >= 0
            found.append((at[hit], at[hit] + length, node[hit]))
        if not found:
            return at, at, at
        return tuple(np.concatenate(x) for x in zip(*found))

    def encode(self, words: list[str]) -> list[bytes | None]:
        """Ids of each word as 32-bit numbers; None where a character is outside all pieces."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        stops = np.cumsum(sizes)
        word = np.repeat(np.arange(len(words)), sizes)
        start, end, node = self.edges(codes, stops[word])
        # equal ranks are one piece, whose edges stand by start already
        order = np.argsort(word[start] * (int(self.rank.max()) + 1) + self.rank[node], kind="stable")
        start, end, piece = start[order], end[order], self.piece[node[order]]
        count = np.bincount(word[start], minlength=len(words))
        first = np.cumsum(count) - count
        longest_first = np.argsort(-count, kind="stable")
        first, waiting = first[longest_first], np.searchsorted(-count[longest_first], -np.arange(count.max(initial=0)), "left")
        # the merge fold: every word's next edge by rank, taken when it joins exactly two symbols
        after = np.arange(1, len(codes) + 2)
        ids = self.piece[self.first[codes]]
        for k, n in enumerate(waiting.tolist()):
            e = first[:n] + k
            a, b = start[e], end[e]
            mid = after[a]
            taken = (mid > 0) & (mid < b) & (after[mid] == b)
            a, b, mid = a[taken], b[taken], mid[taken]
            after[a], after[mid], ids[a] = b, 0, piece[e[taken]]
        symbol = after[:-1] > 0
        kept = np.bincount(word[symbol], minlength=len(words))
        whole = np.bincount(word[symbol & (ids < 0)], minlength=len(words)) == 0
        raw, to = ids[symbol].astype("<i4").tobytes(), 4 * np.cumsum(kept)
        return [raw[i:j] if ok else None for i, j, ok in zip((to - 4 * kept).tolist(), to.tolist(), whole.tolist())]


def edges_of(word: str, table: PieceTable) -> list[tuple[int, int, int, int]]:
    """The word's lattice: (rank, start, end, id) of every substring that is a piece, by rank."""
    begins, n, out = table.beginnings, len(word), []
    for a in range(n):
        b = a + 1
        # a substring that begins no piece ends the search from here
        while b <= n and (s := word[a:b]) in begins:
            if (p := begins[s]) is not None:
                out.append((p[0], a, b, p[1]))
            b += 1
    out.sort()
    return out


def merged(edges: list[tuple[int, int, int, int]], n: int) -> list[tuple[int, int, int]]:
    """The merge fold over edges by rank: an edge is taken when it joins exactly two symbols.

    The state links every symbol border to the next one (0 ahead of it: no border any more).
    """
    after = list(range(1, n + 1))
    for _, a, b, _ in edges:
        mid = after[a]
        if mid and mid < b and after[mid] == b:
            after[a], after[mid] = b, 0
    return [(a, b, i) for _, a, b, i in edges if after[a] == b]


def encode_word(word: str, table: PieceTable) -> list[int]:
    if table.kind == "unigram":
        return _viterbi(word, table)
    return _fill(word, merged(edges_of(word, table), len(word)), table)


def _viterbi(word: str, table: PieceTable) -> list[int]:
    n, longest = len(word), table.longest
    best: list[tuple[float, int, int]] = [(0.0, -1, -1)]
    for e in range(1, n + 1):
        top = (best[e - 1][0] - 1e9, e - 1, -1)
        for s in range(max(0, e - longest), e):
            piece = word[s:e]
            if piece in table.pieces and best[s][0] + table.scores[piece] > top[0]:
                top = (best[s][0] + table.scores[piece], s, table.pieces[piece][0])
        best.append(top)
    kept, at = [], n
    while at > 0:
        _, s, i = best[at]
        if i >= 0:
            kept.append((s, at, i))
        at = s
    return _fill(word, kept, table)


# --- corpus ---------------------------------------------------------------------------

#: Texts whose spaces and line feeds stand alone, without a space mark of their own, are cut at them.
_ODD = f"^[ \\n]|[ \\n][ \\n]|[ \\n]$|{SPACE_MARK}"


def _stretch_words(stretch: str) -> list[str]:
    """Words of a stretch of a text that is not odd."""
    return ["\n", stretch[1:]] if stretch[0] == "\n" else [SPACE_MARK + stretch]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(parts: list[pa.Table]) -> list[pa.RecordBatch]:
        summed = pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")])
        return summed.select(["word", "n_sum"]).rename_columns(["word", "n"]).combine_chunks().to_batches()

    def counts(words: pa.Array, n: pa.Array) -> pa.Table:
        return pa.table([words.cast(pa.string()), n.cast(pa.int64())], ["word", "n"])

    held: list[pa.Table] = [counts(pa.array([], pa.string()), pa.array([], pa.int64()))]
    for batch in batches:
        for a, b in slices(batch.column(0), 2 << 20):
            texts = pc.fill_null(batch.column(0).slice(a, b - a), "")
            odd = pc.or_(pc.match_substring_regex(texts, _ODD), pc.equal(texts, ""))
            seen = Counter(w for text in texts.filter(odd).to_pylist() for w in words_of(text))
            held.append(counts(pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())))
            cut = pc.split_pattern(pc.replace_substring(texts.filter(pc.invert(odd)), "\n", " \n"), " ").flatten().value_counts()
            stretch, n = cut.field("values"), cut.field("counts")
            # the words of such a stretch, as in _stretch_words
            fed = pc.starts_with(stretch, "\n")
            held.append(counts(pc.utf8_slice_codeunits(stretch.filter(fed), 1), n.filter(fed)))
            rest = stretch.filter(pc.invert(fed))
            held.append(counts(pc.binary_join_element_wise(pa.scalar(SPACE_MARK, rest.type), rest, pa.scalar("", rest.type)), n.filter(pc.invert(fed))))
            held.append(counts(pa.array(["\n"]), pa.array([pc.sum(n.filter(fed)).as_py() or 0])))
            if sum(map(len, held)) > _FLUSH:
                yield from out(held)
                held = []
    if held:
        yield from out(held)


def head_vocabulary(texts: DataFrame) -> tuple[DataFrame, str]:
    """The most frequent words of all texts: whole frequency classes, at most ``HEAD_WORDS``."""
    counted, path = write_table(
        map_arrow(texts.select("text"), _count_words, "word string, n bigint").where(F.length("word") <= HEAD_CHARS)
        .groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
        .select("word", F.floor(16 * F.log2("n")).cast("int").alias("class")), "words")
    room, least = HEAD_WORDS, 1 << 30
    # a thousand classes at most, as they are logarithmic
    for r in counted.groupBy("class").count().orderBy(F.desc("class")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r["class"]
    return counted.where(F.col("class") >= least).select("word"), path


class _Head:
    """Broadcast form of the head: words, and their ids in one array.  Workers look words up in it as it is,
    as a dict of a quarter million words takes some ten times its size in each of them."""

    def __init__(self, words: list[str], ids: np.ndarray, sizes: np.ndarray):
        self.key = uuid.uuid4().hex
        self.words = pa.array(words, pa.string())
        self.ids = ids.astype("<i4")
        self.offsets = np.concatenate([[0], 4 * np.cumsum(sizes, dtype=np.int64)])

    def ids_of(self, words: list[str | None]) -> list[bytes | None]:
        """Ids of each word; None where it is not of the head."""
        at = pc.fill_null(pc.index_in(pa.array(words, pa.string()), self.words), -1).to_numpy(zero_copy_only=False)
        out: list[bytes | None] = [None] * len(words)
        found, raw = np.flatnonzero(at >= 0), self.ids.view(np.uint8)
        for i, a, b in zip(found.tolist(), self.offsets[at[found]].tolist(), self.offsets[at[found] + 1].tolist()):
            out[i] = raw[a:b].tobytes()
        return out


class _Stretches(StretchCoder):
    """Stretches that stand for one word of the head are looked up there; only others are remembered."""

    def __init__(self, head: _Head, learn, cache_max: int):
        super().__init__(learn, cache_max)
        self.head = head

    def ids_of(self, values: list[str]) -> list[bytes | None]:
        out = self.head.ids_of([SPACE_MARK + v if v and v[0] != "\n" and SPACE_MARK not in v else None for v in values])
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, super().ids_of([values[i] for i in rest]), strict=True):
            out[i] = x
        return out


class TextCoder:
    """Ids of whole texts from the head's ids and the other words' lattices.

    A batch is cut at its spaces and its different stretches are looked up once.  A
    stretch stands for its words behind one space mark, or behind none after a line feed; a
    text with runs of spaces or line feeds, or with a space mark of its own, is cut into words by itself.
    """

    def __init__(self, head: _Head, table: PieceTable):
        self.head, self.table = head, table
        self.lattices = WordLattices(table) if table.kind == "bpe" else None
        self.coder = _Stretches(head, self._learn, 300_000)

    def _rare(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words outside the head."""
        out: dict[str, bytes] = {}
        if self.lattices is not None:
            short = [w for w in words if len(w) <= WordLattices.CHARS]
            for i in range(0, len(short), WordLattices.WORDS):
                part = short[i:i + WordLattices.WORDS]
                out.update((w, x) for w, x in zip(part, self.lattices.encode(part), strict=True) if x is not None)
        for w in words:
            if w not in out:
                out[w] = np.array(encode_word(w, self.table), "<i4").tobytes()
        return out

    def _ids(self, lists: list[list[str]]) -> list[bytes]:
        """Ids of each list of words."""
        words = list(dict.fromkeys(w for words in lists for w in words))
        known = dict(zip(words, self.head.ids_of(words), strict=True)) if words else {}
        known.update(self._rare([w for w, x in known.items() if x is None]))
        return [b"".join([known[w] for w in words]) for words in lists]

    def _learn(self, new: list[str]) -> list[bytes | None]:
        plain: dict[str, list[str]] = {}
        for s in new:
            body = s.lstrip("\n")
            if body and len(s) - len(body) <= 1 and SPACE_MARK not in s:
                plain[s] = _stretch_words(s)
        ids = dict(zip(plain, self._ids(list(plain.values())), strict=True))
        return [ids.get(s) for s in new]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and ids per text."""
        texts = pc.fill_null(texts, "")
        ids, sizes, wrong = self.coder.encode(pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " "))
        rows = np.flatnonzero(wrong)
        odd = self._ids([words_of(t) for t in texts.take(pa.array(rows)).to_pylist()])
        return replace_rows(ids, sizes, rows, [np.frombuffer(x, "<u4") for x in odd])


_coders: dict[str, TextCoder] = worker_cache(__name__)


def _coder(head, pieces) -> TextCoder:
    key = head.value.key
    if key not in _coders:
        _coders.clear()
        _coders[key] = TextCoder(head.value, pieces.value)
    return _coders[key]


def _encoder(head, pieces):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1), 2 << 20):
                rows = batch.slice(a, b - a)
                flat, sizes = _coder(head, pieces).encode(rows.column(1))
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int32)))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), ids], ["doc_id", "text", "ids"])
    return run


def _prepared(documents: DataFrame, model_path: str):
    """Rows, and the broadcast head and piece table, both of bounded size."""
    spark = documents.sparkSession
    docs = with_row_ids(documents, "doc_id", "text")
    table = load_pieces(model_path)
    head, path = head_vocabulary(docs)
    # words with a character outside all pieces (byte pieces) are left to the tasks
    whole = F.aggregate("kept", F.lit(0), lambda n, e: n + e["end"] - e["start"]) == F.length("word")
    coded = encode_words(head, table).where(whole).select(
        "word", F.transform(F.array_sort("kept"), lambda e: e["id"]).alias("ids")).toArrow()
    lists = coded.column("ids").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()).astype(np.int32)
    held = _Head(coded.column("word").to_pylist(), lists.flatten().to_numpy(), sizes)
    drop_tables(spark, [path])
    sc = spark.sparkContext
    return docs, sc.broadcast(held), sc.broadcast(table)


def encode(documents: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text and the ids of every row of ``documents``."""
    docs, head, pieces = _prepared(documents, model_path)
    return map_arrow(docs, _encoder(head, pieces), "doc_id bigint, text string, ids array<int>")


def decode_ids(ids, table: PieceTable) -> str:
    back = {i: b for b, i in enumerate(table.bytes_)}
    out = b"".join(bytes([back[i]]) if i in back else table.texts.get(i, "").encode("utf-8", "surrogatepass") for i in ids)
    text = out.decode("utf-8", "replace").replace(SPACE_MARK, " ")
    return text.removeprefix(" ")


def _piece_bytes(table: PieceTable) -> pa.Array:
    """What every id stands for, by id."""
    back = {i: p.encode("utf-8", "surrogatepass") for i, p in table.texts.items()} | {i: bytes([b]) for b, i in enumerate(table.bytes_)}
    return pa.array([back.get(i, b"") for i in range(max(back, default=0) + 1)], pa.binary())


def _texts(ids: pa.ListArray, names: pa.Array) -> list[str]:
    offsets = ids.offsets.to_numpy()
    flat = ids.flatten()
    known = pc.if_else(pc.less(flat, len(names)), flat, pa.scalar(None, flat.type))
    lists = pa.ListArray.from_arrays(pa.array(offsets - offsets[0], pa.int32()), pc.fill_null(names.take(known), b""))
    return [x.as_buffer().to_pybytes().decode("utf-8", "replace").replace(SPACE_MARK, " ").removeprefix(" ")
            for x in pc.binary_join(lists, b"")]


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids -> with ``decoded``, the text that the ids stand for."""
    table = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_path))
    names = encoded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _piece_bytes(table.value)
        for batch in batches:
            k = batch.schema.get_field_index("ids")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_texts(batch.column(k), pieces), pa.string())], [*names, "decoded"])

    return map_arrow(encoded, run, ", ".join([*(f"`{c}` {t}" for c, t in encoded.dtypes), "decoded string"]))


_DIGEST = "doc_id bigint, n_pieces bigint, ids_crc32 bigint, round_trip boolean"


def _digests(rows: pa.RecordBatch, decoded: list[str]) -> pa.RecordBatch:
    """Of doc_id, text, ids and the decoded texts."""
    ids = rows.column(2)
    sums = [zlib.crc32(x.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()) for x in ids]
    same = [(a.as_py() or "").replace(SPACE_MARK, " ") == b for a, b in zip(rows.column(1), decoded, strict=True)]
    return pa.RecordBatch.from_arrays([rows.column(0), pc.list_value_length(ids).cast(pa.int64()), pa.array(sums, pa.int64()),
                                       pa.array(same, pa.bool_())], ["doc_id", "n_pieces", "ids_crc32", "round_trip"])


def digest(decoded: DataFrame) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 (ids as little-endian 32-bit numbers), round_trip."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _digests(batch, batch.column(3).to_pylist())
    return map_arrow(decoded.select("doc_id", "text", "ids", "decoded"), run, _DIGEST)


def encode_and_decode(documents: DataFrame, model_path: str) -> DataFrame:
    """``digest`` of ``decode`` of ``encode``; ids and texts stay in the worker that made them."""
    docs, head, pieces = _prepared(documents, model_path)
    coded = _encoder(head, pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _piece_bytes(pieces.value)
        for rows in coded(batches):
            yield _digests(rows, _texts(rows.column(2), names))

    return map_arrow(docs, run, _DIGEST)


def check_words(spark: SparkSession, words: list[str], table: PieceTable) -> dict[str, list[int]]:
    """Ids of given words through the Spark lattice (small lists: tests, notebooks)."""
    frame = spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "word string")
    got = {r["word"]: [(e["start"], e["end"], e["id"]) for e in r["kept"]] for r in encode_words(frame, table).collect()}
    return {w: _fill(w, got.get(w, []), table) for w in words}
