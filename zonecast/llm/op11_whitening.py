"""Embedding whitening by shifted CholeskyQR.

The fit list holds each distinct integer vector once.  A Gram pass is one job
over it: every task centres its rows, carries them through the triangular solves
of the R factors found so far and adds up their Gram matrix; the matrices of
the tasks are added in rounds of ``FAN_IN``, in a fixed order.  The driver
factors the sum (columns by columns, whatever the number of rows).  The first
pass adds a shift to the diagonal, so that the factor exists for any data; the
next passes orthogonalise what is left until the Gram matrix is the identity.
The composed R has the singular values and right vectors of the centred rows,
so its SVD gives the components; directions without variance (constant or
dependent columns, fewer rows than columns) come out as singular values of zero
and give no component.

Centring is exact: a row is held as the integers n * x - S.

Defined results: a component c becomes floor(256 * c), held at the ends of a
long; rows whose vector is null or holds a null or non-finite entry are
dropped, and so are empty vectors; vectors of different lengths are
fitted by length, each with a list of its own; repeated rows and null ids give
a row per component each; components whose deviation is nothing but rounding
are not returned, so vectors that are all equal give no rows; a deviation
beyond a long is null; a component's sign makes its largest entry positive;
identity_error is null where nothing is fitted; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import drop_tables, map_arrow, with_row_ids, write_table

SCALE = 256
FAN_IN = 64
PASSES = 8
_BIG = 1 << 62
_GRAM = "part bigint, i int, g array<double>"


@dataclass
class Whitening:
    """Model of one vector length: n, exact sums, components (rows) with their eigenvalues, trace."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def rank(self) -> int:
        return len(self.eigenvalues)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def offsets_from_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as longs where they fit, as Python integers otherwise."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * most + max(map(abs, sums), default=0) < _BIG:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    v = offsets_from_mean(x, n, sums)
    return (v / n).astype(float)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    v = offsets_from_mean(x, n, sums)
    if v.dtype != object and float(np.abs(v).max(initial=0)) ** 2 * v.shape[1] < _BIG:
        return (v * v).sum(axis=1).tolist()
    v = v.astype(object)
    return [t if t < 1 << 63 else None for t in (v * v).sum(axis=1).tolist()]


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n += len(x)
            # halves of 32 bits add up without overflow
            total = total + (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
        if n:
            # text, as a sum may be beyond a long
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * d, pa.int64()), pa.array(range(d), pa.int32()), pa.array(list(map(str, total)), pa.string())],
                ["n", "i", "s"])
    return run


def _gram(d: int, n: int, sums: list[int], factors: list[np.ndarray], columns: np.ndarray | None):
    """One Gram matrix per task, by rows: of the centred vectors after the solves, or of their projections on ``columns``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        total = None
        for batch in batches:
            q = centred(_matrix(batch.column(0), d), n, sums)
            for r in factors:
                # q * inverse(r), without forming the inverse
                q = _solve_upper(r, q)
            if columns is not None:
                q = q @ columns
            g = q.T @ q
            total = g if total is None else total + g
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(total), pa.int64()), pa.array(range(len(total)), pa.int32()),
                 pa.array(list(total), pa.list_(pa.float64()))], ["part", "i", "g"])
    return run


def _solve_upper(r: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Rows y of y * r = q for an upper triangular r, by forward substitution over its columns."""
    out = np.empty_like(q)
    for j in range(r.shape[0]):
        out[:, j] = (q[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _add(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("part")
    total = np.zeros(len(rows["g"][0]))
    for g in rows["g"]:
        total = total + g.values.to_numpy()
    return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "i": pa.array([key[1].as_py()], pa.int32()),
                     "g": pa.array([total], pa.list_(pa.float64()))})


def _added(fit: DataFrame, run) -> np.ndarray:
    """Sum of the tasks' matrices, in rounds over a bounded number of them."""
    sums, path = write_table(map_arrow(fit.select("x"), run, _GRAM), "gram")
    while sums.select("part").distinct().count() > 1:
        again, next_path = write_table(
            sums.groupBy(F.expr(f"part div {FAN_IN}").alias("round"), "i").applyInArrow(_add, _GRAM), "gram")
        drop_tables(fit.sparkSession, [path])
        sums, path = again, next_path
    rows = sums.orderBy("i").collect()  # columns x columns numbers
    drop_tables(fit.sparkSession, [path])
    return np.array([r["g"] for r in rows])


def _shifted_factor(gram: np.ndarray, shift: float) -> np.ndarray:
    """Upper Cholesky factor of gram + shift * I; the shift grows until the factor exists."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo(float).eps * float(np.trace(gram)))


def fit_whitening(fit: DataFrame, d: int, keep: int) -> Whitening | None:
    """Model of the distinct vectors ``x`` (all of length ``d``) of ``fit``; None for an empty list."""
    head = (map_arrow(fit.select("x"), _sums(d), "n bigint, i int, s string")
            .groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect())
    if not head:
        return None
    n, sums = int(head[0]["n"]), [int(r["s"]) for r in head]
    eps = np.finfo(float).eps
    factors: list[np.ndarray] = []
    composed = np.eye(d)
    for step in range(PASSES):
        gram = _added(fit, _gram(d, n, sums, factors, None))
        values, vectors = np.linalg.eigh(gram)
        top = float(values[-1])
        if top <= 0:
            return Whitening(n, sums, np.zeros((0, d)), np.zeros(0), 0.0)
        live = values > 1e-8 * top if step > 2 else np.ones(d, bool)
        if step and float(np.abs(values[live] - 1).max()) < 64 * d * eps:
            break
        if step == PASSES - 1:
            break
        # the shift of the first pass covers the rounding of the Gram matrix; later ones are only needed for what is left unorthogonal
        shift = 11 * d * (d + 1) * eps * top if step == 0 or values[0] < 1e-6 * top else 0.0
        factor = _shifted_factor(gram, shift)
        factors.append(factor)
        composed = factor @ composed
    # what the last Gram matrix lacks of the identity is the last factor; empty directions have no part in it
    rest = np.sqrt(np.where(values > 1e-8 * top, values, 0))[:, None] * vectors.T
    _, s, w = np.linalg.svd(rest @ composed)
    s = s[s > 16 * d * eps * s[0]]
    w = w[:len(s)]
    w = w * np.where(w[np.arange(len(w)), np.abs(w).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
    return Whitening(n, sums, w[:keep], (s**2 / n)[:keep], float((s**2).sum() / n))


def _project(d: int, model: Whitening, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.rank
        for batch in batches:
            x = _matrix(batch.column(1), d)
            z = centred(x, model.n, model.sums) @ model.components.T / np.sqrt(model.eigenvalues)
            rows = len(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, model.n, np.int64)),
                 pa.array([t for t in deviations(x, model.n, model.sums) for _ in range(k)], pa.int64()), pa.array(z.ravel()),
                 pa.array(np.tile(model.eigenvalues / model.trace, rows)), pa.array(np.full(rows * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


_RESULT = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, "
           "identity_error double")


def whiten(embeddings: DataFrame, keep: int = 4, scale: int = SCALE) -> DataFrame:
    """One row per usable vector and component up to ``keep``: the columns of the result above."""
    spark = embeddings.sparkSession
    usable = ("embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding,"
              " c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))")
    rows, _ = write_table(with_row_ids(embeddings, "vec_id", "embedding").where(usable).select(
        "vec_id", F.expr(f"transform(embedding, c -> floor({scale} * double(c)))").alias("x")), "integer-vectors")
    distinct, path = write_table(rows.select("x").groupBy("x").agg(F.lit(1).alias("one")).select("x"), "fit-list")
    out = spark.createDataFrame([], _RESULT)
    # one fit per vector length: the column of one model has one
    for (d,) in sorted(rows.select(F.size("x")).distinct().collect()):
        fit = distinct.where(F.size("x") == d)
        model = fit_whitening(fit, d, keep)
        if model is None or not model.rank:
            continue
        spread = model.components.T / np.sqrt(model.eigenvalues)
        again = _added(fit, _gram(d, model.n, model.sums, [], spread)) / model.n
        error = float(np.abs(again - np.eye(model.rank)).max())
        out = out.unionByName(map_arrow(rows.where(F.size("x") == d).select("vec_id", "x"), _project(d, model, error), _RESULT))
    drop_tables(spark, [path])
    return out
