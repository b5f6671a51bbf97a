"""Source divergence audit: how far the term use of each source lies from the others of its language.

Counting is done by length-bucketed packing.  In the bytes of a slice of texts, a
term of up to 8 bytes becomes one uint64 word and one of up to 16 becomes two;
these are radix-sorted (16-bit digits, stable) and run-counted in numpy.  Longer
terms go into buckets by length, of fixed width and sorted by bytes; the few
beyond the widest bucket are sorted as they are.  A slice gives partial counts
(lang, source, term, occurrences, documents), which Spark adds up.

The pairwise part never holds a language whole: kept terms are dealt to blocks
of a bounded number of cells (sources x terms), each block adds up the absolute
differences of its terms, and the blocks' sums are added per pair.

All arithmetic is on integers.

Defined results: null text, lang and source are read as ''; a text without terms
counts its group all the same; a language without kept terms has pair values of
0 and no term rows; a language with one source has no pair rows; repeated rows
are documents of their own; an empty table gives an empty result; extra columns
stay out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.llm.chunks import slices
from zonecast.llm.common import drop_tables, map_arrow, with_row_ids, write_table

LEAST_DOCS = 30
SMOOTH = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
BLOCK_CELLS = 1 << 16
_WIDTHS = (32, 64, 128, 256)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[65:91] = _TERM[97:123] = _TERM[128:] = True

_COUNTS = "lang string, source string, term binary, n bigint, docs bigint"


def radix_order(words: list[np.ndarray], first: np.ndarray) -> np.ndarray:
    """Order by the uint64 words (most significant first), ties in the order ``first``: stable passes over 16-bit digits."""
    order = first
    for word in reversed(words):
        digits = word.view(np.uint16).reshape(-1, 4)  # little-endian: lowest digit first
        for k in range(4):
            digit = digits[:, k]
            if digit.any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _pack(buf: np.ndarray, starts: np.ndarray, sizes: np.ndarray, skip: int) -> np.ndarray:
    """The 8 bytes from ``skip`` on of every term as a number, zero where the term has ended."""
    out = np.zeros(len(starts), np.uint64)
    last = len(buf) - 1
    for j in range(skip, skip + 8):
        out = (out << np.uint64(8)) | np.where(j < sizes, buf[np.minimum(starts + j, last)], 0).astype(np.uint64)
    return out


def _runs(changed: np.ndarray, order: np.ndarray, docs: np.ndarray, groups: np.ndarray):
    """Runs of one term and group in sorted order: position of the first, occurrences, documents."""
    g, d = groups[order], docs[order]
    new_doc = changed.copy()
    new_doc[1:] |= d[1:] != d[:-1]
    changed = changed.copy()
    changed[1:] |= g[1:] != g[:-1]
    at = np.flatnonzero(changed)
    return order[at], np.diff(np.append(at, len(order))), np.add.reduceat(new_doc.astype(np.int64), at)


def _different(column: np.ndarray) -> np.ndarray:
    out = np.ones(len(column), bool)
    out[1:] = column[1:] != column[:-1]
    return out


def count_terms(texts: pa.Array, groups: np.ndarray):
    """(terms, group, occurrences, documents) arrays per length bucket of one slice of texts.

    ``groups``: number of each text's group.
    """
    raw = texts.cast(pa.binary()).fill_null(b"")
    offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1].astype(np.int64)
    data = raw.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(buf):
        return
    inside = np.concatenate([[False], _TERM[buf], [False]])
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    # a term starts after a byte outside terms or at a text's start, and ends likewise
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | cut[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | cut[1:])) + 1
    buf = _LOWER[buf]
    sizes = ends - starts
    text = np.searchsorted(offsets, starts, "right") - 1
    # texts in the order of their groups, so that runs of a term are runs of groups, and of texts in them
    place = np.empty(len(groups), np.int64)
    place[np.argsort(groups, kind="stable")] = np.arange(len(groups))
    for low, high, words in ((0, 8, 1), (8, 16, 2)):
        pick = np.flatnonzero((sizes > low) & (sizes <= high))
        if not len(pick):
            continue
        a, n, t = starts[pick], sizes[pick], text[pick]
        packed = [_pack(buf, a, n, 8 * k) for k in range(words)]
        order = radix_order(packed, np.argsort(place[t], kind="stable"))
        changed = _different(packed[0][order])
        for w in packed[1:]:
            changed |= _different(w[order])
        first, occurrences, documents = _runs(changed, order, place[t], groups[t])
        raw_terms = np.stack([w[first].byteswap() for w in packed], axis=1).copy().view(f"S{8 * words}")[:, 0]
        yield raw_terms.tolist(), groups[t[first]], occurrences, documents
    low = 16
    for high in (*_WIDTHS, None):
        pick = np.flatnonzero((sizes > low) & (sizes <= high)) if high else np.flatnonzero(sizes > low)
        low = high
        if not len(pick):
            continue
        a, n, t = starts[pick], sizes[pick], text[pick]
        by_place = np.argsort(place[t], kind="stable")
        if high:
            at = np.minimum(a[:, None] + np.arange(high), len(buf) - 1)
            terms = np.where(np.arange(high) < n[:, None], buf[at], 0).astype(np.uint8).view(f"S{high}")[:, 0]
            order = by_place[np.argsort(terms[by_place], kind="stable")]
        else:
            terms = np.empty(len(pick), object)
            terms[:] = [buf[x:x + k].tobytes() for x, k in zip(a.tolist(), n.tolist(), strict=True)]
            order = np.array(sorted(by_place.tolist(), key=terms.__getitem__), np.int64)
        first, occurrences, documents = _runs(_different(terms[order]), order, place[t], groups[t])
        yield terms[first].tolist(), groups[t[first]], occurrences, documents


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column(2)):
            rows = batch.slice(a, b - a)
            key = pa.StructArray.from_arrays([rows.column(0), rows.column(1)], ["lang", "source"])
            names: dict[tuple[str, str], int] = {}
            groups = np.array([names.setdefault((k["lang"], k["source"]), len(names)) for k in key.to_pylist()], np.int64)
            langs, sources = (pa.array([k[j] for k in names], pa.string()) for j in (0, 1))
            for terms, group, occurrences, documents in count_terms(rows.column(2), groups):
                at = pa.array(group)
                yield pa.RecordBatch.from_arrays(
                    [langs.take(at), sources.take(at), pa.array(terms, pa.binary()), pa.array(occurrences, pa.int64()),
                     pa.array(documents, pa.int64())], ["lang", "source", "term", "n", "docs"])


def _share(count, total, terms):
    """1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * terms)), exactly."""
    return F.expr(f"1 + (cast({UNIT} AS decimal(10,0)) * cast({count} + {SMOOTH} AS decimal(19,0)))"
                  f" div cast({total} + {SMOOTH} * {terms} AS decimal(20,0))")


def _pair_sums(key: tuple[pa.Scalar, ...], rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Sums of absolute differences over one block's terms, for every two sources.

    Rows without a term give each source's p of a term it does not have.
    """
    source, term, p = (rows.column(c) for c in ("source", "term", "p"))
    none = pc.is_null(term)
    names = pc.sort_indices(source.filter(none))
    names, base = source.filter(none).take(names).combine_chunks(), p.filter(none).take(names).to_numpy()
    held = pc.invert(none)
    coded = term.filter(held).combine_chunks().dictionary_encode()
    matrix = np.repeat(base[:, None], len(coded.dictionary), axis=1)
    matrix[pc.index_in(source.filter(held), names).to_numpy(), coded.indices.to_numpy()] = p.filter(held).to_numpy()
    lang, every = key[0], np.arange(len(names))
    for k in every:
        value = np.abs(matrix - matrix[k]).sum(axis=1)
        other = pa.array(every[every != k])
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang.as_py()] * len(other), pa.string()), names.take(pa.array(np.full(len(other), k))), names.take(other),
             pa.array(value, pa.int64()).take(other)], ["lang", "source", "item", "value"])


def _pair_table(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    return pa.Table.from_batches(list(_pair_sums(key, rows)), pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())]))


def audit(documents: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS,
          block_cells: int = BLOCK_CELLS) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the other sources and the terms a source overuses."""
    docs = with_row_ids(documents, "lang", "source", "text").select(
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    spark = documents.sparkSession
    counts, counts_path = write_table(
        map_arrow(docs, _count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "term-counts")
    kept, kept_path = write_table(
        counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        .where(F.col("docs") >= least_docs).select("lang", "term", "lang_n"), "kept-terms")
    of_lang, lang_path = write_table(
        kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "lang-totals")
    cells, cells_path = write_table(counts.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    groups = (docs.select("lang", "source").distinct()
              .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
              .join(of_lang, "lang", "left").na.fill(0, ["total", "v", "lang_total"]))
    groups, groups_path = write_table(groups, "groups")
    shares, shares_path = write_table(
        cells.join(groups, ["lang", "source"])
        .select("lang", "source", "term", "v", _share("n", "total", "v").alias("p"), _share("lang_n", "lang_total", "v").alias("q")),
        "shares")

    overused = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = overused.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)

    sizes = groups.groupBy("lang").agg(
        F.greatest(F.ceil(F.max("v") * F.count("*") / block_cells), F.lit(1)).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    placed = shares.join(sizes, "lang").select("lang", block.alias("block"), "source", "term", "p")
    absent = (groups.where("v > 0").join(sizes, "lang")
              .select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source",
                      F.lit(None).cast("binary").alias("term"), _share("0", "total", "v").alias("p")))
    empty = groups.where("v = 0").select("lang", F.lit(0).alias("block"), "source", F.lit(None).cast("binary").alias("term"),
                                         F.lit(0).cast("bigint").alias("p"))
    pairs = (placed.unionByName(absent).unionByName(empty).groupBy("lang", "block")
             .applyInArrow(_pair_table, "lang string, source string, item string, value bigint")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    out, _ = write_table(top.unionByName(ranked).select("lang", "source", "part", "item", "value", "rank"), "divergence")
    drop_tables(spark, [counts_path, kept_path, lang_path, cells_path, groups_path, shares_path])
    return out


DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
           FROM documents),
t AS (SELECT doc, lang, source,
             unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= {LEAST_DOCS}),
v AS (SELECT l.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept k ON k.lang = l.lang GROUP BY l.lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, k.term, count(t.doc) AS n
      FROM g JOIN kept k ON k.lang = g.lang
      LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term GROUP BY ALL),
gn AS (SELECT lang, source, CAST(sum(n) AS HUGEINT) AS total FROM c GROUP BY ALL),
ln AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM c GROUP BY ALL),
lt AS (SELECT lang, CAST(sum(n) AS HUGEINT) AS total FROM ln GROUP BY lang),
p AS (SELECT c.lang, c.source, c.term, c.n,
             1 + (CAST({UNIT} AS HUGEINT) * (c.n + {SMOOTH})) // (gn.total + {SMOOTH} * v.v) AS p
      FROM c JOIN gn ON gn.lang = c.lang AND gn.source = c.source JOIN v ON v.lang = c.lang),
q AS (SELECT ln.lang, ln.term, 1 + (CAST({UNIT} AS HUGEINT) * (ln.n + {SMOOTH})) // (lt.total + {SMOOTH} * v.v) AS q
      FROM ln JOIN lt ON lt.lang = ln.lang JOIN v ON v.lang = ln.lang),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term
                          WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
         FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source),
term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value
         FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
           FROM (SELECT * FROM pair UNION ALL SELECT * FROM term) u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= {TOP_TERMS}"""
