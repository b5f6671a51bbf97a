"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle space gives two signature values, the smallest
and the largest permuted shingle, so 240 values cost 120 hash passes.  The
signature is cut into 48 bands of 5 values; documents that agree on a band are
candidates (a pair of similarity 0.75 is missed with probability
(1 - 0.75^5)^48 = 2e-6, one of 0.85 with 2e-13).  Candidates are confirmed on
the full shingle sets.

Large buckets never become all pairs.  Documents with one and the same set are
first folded into their smallest id.  Each bucket has a leader, the member that meets most
others over all bands.  Candidates are compared in three rounds, and the components found are folded
between them: every document with the first of its leaders, then with those leaders that
still lie in another component, and last the members of one bucket that still lie in different
components, as far as an exact bound (their overlaps with the leader) does not rule them out.  A pair
inside one component needs no comparison, as its link cannot change any component, so no link between
different texts is lost.

Defined results: null or empty text has 0 shingles and is linked with nothing;
a text of 1 to 4 words is one shingle; equal sets are linked; a doc_id that
occurs in several rows is one node that has the links of all its texts, and
gives one row each; a null doc_id takes no part in links and is returned kept
with a null component; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import drop_tables, map_arrow, with_row_ids, worker_cache, write_table
from zonecast.llm.components import connected_components

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xBF58476D1CE4E5B9)
_WORD_CACHE_MAX = 150_000
_word_cache: dict[bytes, int] = worker_cache(__name__)


@dataclass(frozen=True)
class MinMax:
    """Shingle length, bands and rows; ``bands * rows`` values come from half as many permutations."""

    words: int = 5
    bands: int = 48
    rows: int = 5
    percent: int = 75
    seed: int = 20

    @property
    def permutations(self) -> int:
        return -(-self.bands * self.rows // 2)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        n = self.permutations
        flip = rng.integers(0, 2**32, n, dtype=np.uint32)
        mult = rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)
        return flip[:, None], mult[:, None]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _FOLD
    x = (x ^ (x >> np.uint64(27))) * _MIX
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, k: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of the whole text, A-Z lower-cased."""
    # bytes.lower and bytes.split know only the ASCII letters and the six ASCII spaces
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    cache, hashes = _word_cache, []
    for w in words:
        h = cache.get(w)
        if h is None:
            if len(cache) >= _WORD_CACHE_MAX:
                cache.clear()
            h = cache[w] = xxhash.xxh3_64_intdigest(w)
        hashes.append(h)
    h = np.array(hashes, np.uint64)
    n = max(1, len(h) - k + 1)
    take = min(k, len(h))
    acc = np.full(n, take, np.uint64)
    for j in range(take):
        acc = _scramble(acc * _MIX + h[j:j + n])
    return np.unique(acc)


def signature(shingles: np.ndarray, flip: np.ndarray, mult: np.ndarray) -> np.ndarray:
    """Minima, then maxima, under each permutation of the (non-empty) set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = high = None
    for at in range(0, len(x), 2048):
        y = (x[None, at:at + 2048] ^ flip) * mult
        a, b = y.min(axis=1), y.max(axis=1)
        low = a if low is None else np.minimum(low, a)
        high = b if high is None else np.maximum(high, b)
    return np.concatenate([low, high])


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    v = sig[:bands * rows].reshape(bands, rows).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64)
    for j in range(rows):
        key = _scramble(key * _MIX + v[:, j])
    return key.view(np.int64)


def _sign(p: MinMax):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flip, mult = p.keys()
        for batch in batches:
            sizes, prints, bands = [], [], []
            for text in batch.column(1):
                s = shingle_set(text.as_py(), p.words)
                sizes.append(len(s))
                if len(s):
                    prints.append(blake2b(s.tobytes(), digest_size=16).digest())
                    bands.append(band_keys(signature(s, flip, mult), p.bands, p.rows))
                else:
                    prints.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "print", "bands"])
    return run


def _sets(p: MinMax):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), p.words).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["doc_id", "shingles"])
    return run


def _confirm(p: MinMax):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                u, v = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                if len(u) > len(v):
                    u, v = v, u
                at = np.searchsorted(v, u)
                both = int((v[np.minimum(at, len(v) - 1)] == u).sum())
                keep.append(100 * both >= p.percent * (len(u) + len(v) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])
    return run


def _set_table(docs: DataFrame, need: DataFrame, p: MinMax) -> tuple[DataFrame, str]:
    """doc_id and shingle set (sorted 64-bit numbers) of the needed documents, from their whole texts."""
    return write_table(
        map_arrow(docs.join(need, "doc_id", "left_semi").select("doc_id", "text").distinct(),
                  _sets(p), "doc_id bigint, shingles binary"), "sets")


def _verify(docs: DataFrame, pairs: DataFrame, sizes: DataFrame, p: MinMax) -> tuple[DataFrame, list[str]]:
    """The pairs whose full shingle sets are similar enough.

    Pairs whose set sizes alone rule the link out are dropped first.  Shingles
    are computed again for the candidates' texts only, so no table of all sets
    is ever stored.
    """
    a, b = (sizes.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}")) for c in "ab")
    pairs, pairs_path = write_table(
        pairs.join(a, "a").join(b, "b")
        .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * p.percent).select("a", "b").distinct(), "pairs")
    need, need_path = write_table(
        pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "candidates")
    sets, sets_path = _set_table(docs, need, p)
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    links, links_path = write_table(
        map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b"),
                  _confirm(p), "a bigint, b bigint").distinct(), "links")
    drop_tables(docs.sparkSession, [pairs_path, need_path, sets_path])
    return links, [links_path]


def _residuals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per member: set size, shingles shared with the leader, and the shingles the leader lacks."""
    for batch in batches:
        size, both, rest = [], [], []
        for x, y in zip(batch.column(3), batch.column(4), strict=True):
            u, v = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            shared = v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u
            size.append(len(u))
            both.append(int(shared.sum()))
            rest.append(u[~shared].view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(size, pa.int64()), pa.array(both, pa.int64()), pa.array(rest, pa.list_(pa.int64()))],
            ["leader", "rep", "comp", "n", "both", "rest"])


def _possible_pairs(docs: DataFrame, hubs: DataFrame, p: MinMax) -> tuple[DataFrame, list[str]]:
    """Pairs of members of one leader's buckets that can still be similar enough.

    Members a and b share at most min(|a & h|, |b & h|) shingles of their leader h,
    and beyond those only what both have and h lacks.  A link needs an overlap of ``percent`` of either
    set, so a member whose overlap with h is short of that by m must share m of the shingles h lacks;
    of two members that do, one of the first r - m + 1 of their r shared-by-anyone such shingles, in
    rare-first order, is common (prefix filter).  Members with no shortage can also meet without any.  All bounds are exact.
    """
    need, need_path = write_table(
        hubs.select(F.explode(F.array("leader", "rep")).alias("doc_id")).distinct(), "hub-members")
    sets, sets_path = _set_table(docs, need, p)
    joined = (hubs.join(sets.select(F.col("doc_id").alias("rep"), F.col("shingles").alias("set_m")), "rep")
              .join(sets.select(F.col("doc_id").alias("leader"), F.col("shingles").alias("set_h")), "leader"))
    rests, rests_path = write_table(
        map_arrow(joined.select("leader", "rep", "comp", "set_m", "set_h"), _residuals,
                  "leader bigint, rep bigint, comp bigint, n bigint, both bigint, rest array<bigint>"), "residuals")

    rests = rests.withColumn("short", F.ceil(F.col("n") * p.percent / F.lit(100)) - F.col("both"))

    def side(df: DataFrame, c: str) -> DataFrame:
        names = {"rep": c, "comp": f"comp_{c}", "n": f"n_{c}", "both": f"both_{c}", "r": f"r_{c}"}
        return df.select("leader", *[F.col(k).alias(v) for k, v in names.items()], *[x for x in df.columns if x == "x"])

    single = rests.select("leader", "rep", "comp", "n", "both", "short", F.explode("rest").alias("x"))
    common = single.groupBy("leader", "x").agg(F.count("*").alias("c")).where("c > 1")
    firsts = (single.join(common, ["leader", "x"]).groupBy("leader", "rep", "comp", "n", "both", "short")
              .agg(F.array_sort(F.collect_list(F.struct("c", "x"))).alias("xs")).withColumn("r", F.size("xs")).where("r >= short")
              .withColumn("x", F.explode(F.expr("slice(xs, 1, int(r - greatest(short, 1) + 1))"))).withColumn("x", F.col("x.x")))
    other = "a < b AND comp_a <> comp_b"
    enough = f"(least(both_a, both_b) + s) * {100 + p.percent} >= {p.percent} * (n_a + n_b)"
    meeting = (side(firsts, "a").join(side(firsts, "b"), ["leader", "x"])
               .where(f"{other} AND {enough.replace('+ s', '+ least(r_a, r_b)')}"))
    plain = rests.where("short <= 0").withColumn("r", F.lit(0))
    without = (side(plain, "a").join(side(plain, "b"), "leader").where(f"{other} AND {enough.replace(' + s', '')}"))
    pairs, path = write_table(meeting.select("a", "b").unionByName(without.select("a", "b")).distinct(), "possible")
    return pairs, [need_path, sets_path, rests_path, path]


def _placed(rows: DataFrame, labels: DataFrame, *cols: str) -> DataFrame:
    """Add ``comp_<c>``, the component of each named column; a node without a label is its own."""
    for c in cols:
        rows = (rows.join(labels.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}")), c, "left")
                .withColumn(f"comp_{c}", F.coalesce(f"comp_{c}", c)))
    return rows


def _fold(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, list[str]]:
    """Labels after more links: only the components that the links join are formed anew."""
    met = _placed(links, labels, "a", "b").where("comp_a <> comp_b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    joined, joined_path = connected_components(met.distinct())
    up = joined.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
    moved = labels.join(up, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp"))
    # a component of one node has no label yet
    new = joined.join(labels, "node", "left_anti").select("node", "comp")
    out, path = write_table(moved.unionByName(new), "labels")
    return out, [joined_path, path]


def near_duplicates(documents: DataFrame, p: MinMax = MinMax(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, kept.

    ``class_id`` is the smallest id with exactly the same shingle set,
    ``component_id`` the smallest id reachable over links.
    """
    spark = documents.sparkSession
    docs = with_row_ids(documents, id_col, text_col).toDF("doc_id", "text")
    signed, signed_path = write_table(
        map_arrow(docs, _sign(p), "doc_id bigint, n_shingles bigint, print binary, bands array<bigint>"), "signed")
    linked = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes, classes_path = write_table(
        linked.groupBy("print").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n")), "classes")

    # one row of a class stands for it: the smallest id, unique within its class
    reps = (linked.select("print", F.col("doc_id").alias("rep"), "bands")
            .join(classes.select("print", "rep"), ["print", "rep"])
            .select("rep", F.posexplode("bands").alias("band", "key")))
    buckets, buckets_path = write_table(reps.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    shared, shared_path = write_table(reps.select("key", "rep").join(buckets, "key"), "shared")
    # a hub is met in many buckets, the original of a group of near copies more often than each copy
    degree, degree_path = write_table(
        shared.groupBy("rep").agg(
            (F.sum("n").cast("double") + F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) / (1 << 20)).alias("rank")), "degree")
    members, members_path = write_table(shared.select("key", "rep").join(degree, "rep"), "members")
    leaders, leaders_path = write_table(
        members.groupBy("key").agg(F.max_by("rep", "rank").alias("leader"), F.max("rank").alias("leader_rank")), "leaders")
    sizes = classes.select("rep", "n")
    dropped = [buckets_path, shared_path, degree_path, members_path, leaders_path]

    # a doc_id with several texts is one node: its classes are linked
    own = linked.select("print", "doc_id").join(classes.select("print", "rep"), "print").groupBy("doc_id").agg(
        F.min("rep").alias("a"), F.collect_set("rep").alias("reps")).where("size(reps) > 1")
    own = own.select("a", F.explode("reps").alias("b")).where("a <> b")

    met = members.join(leaders, "key").where("rep <> leader").select("rep", "leader", "leader_rank").distinct()
    met, met_path = write_table(met, "met")
    first, first_path = write_table(
        met.groupBy("rep").agg(F.max_by("leader", "leader_rank").alias("leader"))
        .select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct(), "first-pairs")
    links, paths = _verify(docs, first, sizes, p)
    labels, labels_path = connected_components(links.unionByName(own).distinct())
    dropped += [met_path, first_path, labels_path, *paths]

    apart = _placed(met.select("rep", "leader"), labels, "rep", "leader").where("comp_rep <> comp_leader")
    second, second_path = write_table(
        apart.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b")).distinct()
        .join(first, ["a", "b"], "left_anti"), "second-pairs")
    links, paths = _verify(docs, second, sizes, p)
    labels, label_paths = _fold(labels, links)
    dropped += [second_path, *paths, *label_paths]

    # buckets that still hold several components; a pair with the leader has been compared
    placed, placed_path = write_table(_placed(members.select("key", "rep"), labels, "rep"), "placed")
    several = placed.groupBy("key").agg(F.min("comp_rep").alias("low"), F.max("comp_rep").alias("high")).where("low <> high")
    hubs, hubs_path = write_table(
        placed.join(several.select("key"), "key").join(leaders.select("key", "leader"), "key").where("rep <> leader")
        .select("leader", "rep", F.col("comp_rep").alias("comp")).distinct(), "hubs")
    possible, possible_paths = _possible_pairs(docs, hubs, p)
    third, third_path = write_table(
        possible.join(first, ["a", "b"], "left_anti").join(second, ["a", "b"], "left_anti"), "third-pairs")
    links, paths = _verify(docs, third, sizes, p)
    labels, label_paths = _fold(labels, links)
    dropped += [placed_path, hubs_path, *possible_paths, third_path, *paths, *label_paths]

    homes = (classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
             .select("print", F.col("rep").alias("class_id"), F.coalesce("comp", "rep").alias("component_id")))
    # written without bands and prints, most of what is kept of a document
    found, _ = write_table(
        signed.select("doc_id", "n_shingles", "print").join(homes, "print", "left")
        .select("doc_id", "n_shingles",
                F.coalesce("component_id", "doc_id").alias("component_id"),
                F.coalesce("class_id", "doc_id").alias("class_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "near-duplicates")
    drop_tables(spark, [signed_path, classes_path, *dropped])
    return found
