"""Exact inner-product search: a ball tree per shard, branch and bound.

Every usable row gets a key of its own; vectors are dealt to shards of a bounded
number of rows by a hash of it.
Each shard builds a ball tree: a node keeps the centre, the radius and the
smallest id of its vectors, and no vector of the node can score more than
q.centre + |q| * radius.  A block of queries walks the tree together; the child
with the larger bound goes first, and a query leaves a branch whose bound is
below its current kth score (or equal, when the node has only larger ids).

The current kth score is shared: an eighth of the shards is searched first, the
kth scores found there go to the search of the others, which starts from them.
Queries go out in blocks of at most ``BLOCK`` vectors, the only thing broadcast.

Defined results: components become floor(256 * x), held at the ends of a long; a score
beyond a long is held at its ends (the lower one plus 1), where ties go by vec_id as anywhere; vectors that are null, or
hold null or non-finite components, take no part; vectors of another length
than the query's are no candidates; ties go to the smaller vec_id; a vec_id that
occurs in several rows is a candidate in each, also for a query of that vec_id,
and each of its rows is a query with k places of its own; only the query's own
row is no candidate; a null vec_id takes no part; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zonecast.llm.common import drop_tables, map_arrow, with_row_ids, write_table

LEAF = 64
SHARD_ROWS = 4096
BLOCK = 4096
FIRST_WAVE = 8
#: An absent place, and the range of scores.
ABSENT, LEAST, MOST = -(1 << 63), 1 - (1 << 63), (1 << 63) - 1


class BallTree:
    """Nodes in arrays; the vectors of a node are a range of the reordered rows."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.arange(len(ids))
        self.nodes: list[tuple[int, int, np.ndarray, float, int, int, int]] = []
        if len(ids):
            self._build(0, len(ids))
        self.keys, self.ids, self.vectors = keys[self.order], ids[self.order], vectors[self.order]

    def _build(self, a: int, b: int) -> int:
        rows = self.vectors[self.order[a:b]].astype(float)
        centre = rows.mean(axis=0)
        away = np.sqrt(((rows - centre) ** 2).sum(axis=1))
        # rounding of the centre and of the differences is covered by a margin of their own size
        radius = float(away.max()) * (1 + 1e-9) + 1e-9 * float(np.sqrt((centre**2).sum())) + 1e-6
        at = len(self.nodes)
        self.nodes.append((a, b, centre, radius, int(self.ids[self.order[a:b]].min()), -1, -1))
        if b - a > LEAF and away.max() > 0:
            # split between two far vectors, at the median so that ties cannot empty a side
            p = rows[away.argmax()]
            q = rows[((rows - p) ** 2).sum(axis=1).argmax()]
            side = rows @ (q - p)
            mid = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(side, mid)]
            left, right = self._build(a, a + mid), self._build(a + mid, b)
            self.nodes[at] = (*self.nodes[at][:5], left, right)
        return at

    def search(self, query_keys: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
        """Best k (score, id) of every query, at least ``least`` in score; absent places keep the lowest score."""
        n = len(queries)
        # places are (score, -id) in falling order; an absent one is below everything
        scores = np.full((n, k), ABSENT)
        found = np.full((n, k), np.iinfo(np.int64).max)
        norms = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
        if not self.nodes or not n:
            return scores, found
        as_float = queries.astype(float)
        # int64 products have no fast kernel; doubles are exact below 2^53, Python integers always
        big = float(np.abs(self.vectors.astype(float)).max(initial=0)) * float(np.abs(as_float).max(initial=0)) * queries.shape[1]
        exact = np.float64 if big < 2**53 else object
        left_q, rows = queries.astype(exact), self.vectors.astype(exact)

        def bound(node: int, active: np.ndarray) -> np.ndarray:
            centre, radius = self.nodes[node][2:4]
            far = norms[active] * radius
            # the product's rounding is of the size of its factors, not of its value
            margin = 1e-9 * (norms[active] * float(np.sqrt((centre**2).sum())) + far) + 1e-6
            # a score below the least one is held there
            return np.maximum(as_float[active] @ centre + far + margin, float(LEAST))

        def alive(node: int, active: np.ndarray, top: np.ndarray) -> np.ndarray:
            kth, kth_id = scores[active, -1], found[active, -1]
            floor = np.floor(top)
            return active[(floor >= least[active])
                          & ((floor > kth) | ((floor == kth) & (self.nodes[node][4] <= kth_id)))]

        stack = [(0, np.arange(n))]
        while stack:
            node, active = stack.pop()
            active = alive(node, active, bound(node, active))
            if not len(active):
                continue
            a, b, _, _, _, left, right = self.nodes[node]
            if left < 0:
                got = left_q[active] @ rows[a:b].T
                got = got.astype(np.int64) if exact is not object else np.array(
                    [[min(max(x, LEAST), MOST) for x in line] for line in got.tolist()], np.int64).reshape(got.shape)
                ids = np.broadcast_to(self.ids[a:b], got.shape)
                out = self.keys[a:b] == query_keys[active][:, None]
                got = np.where(out, ABSENT, got)
                ids = np.where(out, np.iinfo(np.int64).max, ids)
                all_s = np.concatenate([scores[active], got], axis=1)
                all_i = np.concatenate([found[active], ids], axis=1)
                # the complement falls as the score rises, without overflow
                best = np.lexsort((all_i, ~all_s), axis=1)[:, :k]
                scores[active] = np.take_along_axis(all_s, best, axis=1)
                found[active] = np.take_along_axis(all_i, best, axis=1)
            else:
                first, second = (left, right) if bound(left, active).sum() >= bound(right, active).sum() else (right, left)
                stack += [(second, active), (first, active)]
        return scores, found


_RESULT = "row bigint, query_id bigint, vec_id bigint, score bigint"


def _searcher(block, k: int):
    """Build the shard's tree from all batches of its rows, then search the block's queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            shard = batch.column(0).to_numpy()
            dims = batch.column(1).to_numpy()
            ids = batch.column(2).to_numpy()
            keys = batch.column(4).to_numpy()
            flat, offsets = batch.column(3).flatten().to_numpy(), np.concatenate([[0], np.cumsum(dims)])
            for s in np.unique(shard):
                for d in np.unique(dims[shard == s]):
                    at = np.flatnonzero((shard == s) & (dims == d))
                    rows = flat[(offsets[at][:, None] + np.arange(d)).ravel()].reshape(len(at), d)
                    shards.setdefault((int(s), int(d)), []).append((keys[at], ids[at], rows))
        for (_, d), parts in shards.items():
            mine = block.value.get(d)
            if mine is None:
                continue
            tree = BallTree(*(np.concatenate([p[j] for p in parts]) for j in range(3)))
            query_keys, query_ids, queries, least = mine
            scores, found = tree.search(query_keys, queries, k, least)
            row, q = np.repeat(query_keys, k), np.repeat(query_ids, k)
            ok = scores.ravel() > ABSENT
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[ok]), pa.array(q[ok]), pa.array(found.ravel()[ok]), pa.array(scores.ravel()[ok])],
                ["row", "query_id", "vec_id", "score"])
    return run


def _best(rows: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: queries are the rows whose vec_id ``every`` divides."""
    spark = embeddings.sparkSession
    usable = ("vec_id IS NOT NULL AND embedding IS NOT NULL AND forall(embedding,"
              " x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    ints, ints_path = write_table(
        with_row_ids(embeddings, "vec_id", "embedding").where(usable).select(
            "vec_id", F.expr(f"transform(embedding, x -> cast(floor({scale} * double(x)) AS bigint))").alias("v"),
            F.size("embedding").alias("dim"),
            F.monotonically_increasing_id().alias("row")), "vectors")
    rows = ints.count()
    shards = max(1, math.ceil(rows / SHARD_ROWS))
    # the hash of a repeated id or vector would gather its rows
    deal = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    dealt, dealt_path = write_table(
        ints.select(deal.alias("shard"), "dim", "vec_id", "v", "row"), "shards")
    first = max(1, shards // FIRST_WAVE)

    asked = ints.where(F.col("vec_id") % every == 0)
    queries, queries_path = write_table(
        asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, math.ceil(asked.count() / BLOCK))))), "queries")
    blocks = [r["block"] for r in queries.select("block").distinct().orderBy("block").collect()]
    found, paths = None, []
    for b in blocks:
        held = queries.where(F.col("block") == b).orderBy("vec_id", "row").toLocalIterator()
        by_dim: dict[int, tuple[list, list, list]] = {}
        for r in held:
            keys, ids, vectors = by_dim.setdefault(r["dim"], ([], [], []))
            keys.append(r["row"])
            ids.append(r["vec_id"])
            vectors.append(r["v"])
        best = None
        for wave in (F.col("shard") < first, F.col("shard") >= first):
            kth: dict[int, int] = {}
            if best is not None:
                kth = {r["row"]: r["score"] for r in best.where(F.col("rank") == k).select("row", "score").collect()}
            sent = {d: (np.array(r, np.int64), np.array(i, np.int64), np.array(v, np.int64).reshape(len(i), d),
                        np.array([kth.get(x, ABSENT) for x in r], np.int64))
                    for d, (r, i, v) in by_dim.items()}
            block = spark.sparkContext.broadcast(sent)
            part = dealt.where(wave).repartition(shards, "shard")
            got = _best(map_arrow(part, _searcher(block, k), _RESULT), k)
            merged = got if best is None else _best(best.drop("rank").unionByName(got.drop("rank")), k)
            best, path = write_table(merged, "best")
            paths.append(path)
        found = best if found is None else found.unionByName(best)
    drop_tables(spark, [ints_path, dealt_path, queries_path])
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    return found.select("query_id", "rank", "vec_id", "score")
