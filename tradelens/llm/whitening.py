"""Embedding whitening by shifted CholeskyQR over Spark partitions.

Every vector entry c becomes the whole number ``floor(64 c) + 1000000``; the model is
fitted on the distinct vectors of these numbers (the *fit list*, written once to the
shared folder). The method, for centred rows X (one a distinct vector):

1. a pass over the fit list sums the Gram matrix of its rows in every task, the tasks'
   matrices are added up in two steps on executors;
2. the Cholesky factor R1 of the Gram matrix plus a small shift makes Q1 = X inv(R1)
   nearly orthonormal; the shift keeps the factorisation possible for badly conditioned
   or rank-deficient data;
3. further passes rebuild Q from X by triangular solves with all factors so far, take its
   Gram matrix and the next factor, until that matrix is the identity to rounding;
4. R = Rk ... R2 R1 has the singular values and right singular vectors of X: an SVD of R
   gives the components, e = s^2 / n the variances.

So the covariance itself, whose condition number is the square of X's, is never
decomposed. Centring subtracts exact whole-number sums before any product is formed.

Scale: a pass is one scan; a task holds one batch of rows and one d x d matrix, the
driver ``PARTS`` such matrices at most and R, which depend on d and not on the number of
rows. The distinct step pre-aggregates in every task, so a vector that fills a third of
the table is shuffled once a task. Scoring all rows is a scan with the components
(``components`` x d numbers) sent to the tasks.

Defined cases: a vector that is null or holds null or non-finite entries takes no part,
nor does one whose length is not the commonest (ties: the longer); empty vectors and an
empty table give no rows. Repeated rows stay, each with its values; they count once in the
fit. A null ``vec_id`` stays null. Components whose standard deviation is below ``RANK_TOLERANCE`` of
the first are not returned (they have no whitened value), so a table of one distinct
vector gives no rows. Entries beyond +-2^46 are taken as that bound, so that
their whole numbers are exact. ``deviation`` is decimal(38,0); extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SCALE, OFFSET, BOUND = 64, 1_000_000, 2.0 ** 52
COMPONENTS = 16
PASSES = 6                # the first is shifted, two more do for data of full rank
PARTS = 16                # summed matrices that reach the driver at most
RANK_TOLERANCE = 1e-11


@dataclass
class Whitening:
    """A fitted whitening: ``vectors`` are columns, ``values`` the variances along them."""
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    total: float
    identity_error: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.sums)


def whole_vectors(emb: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and x (array of longs) of every vector that takes part."""
    v = emb.select("vec_id", F.col(vector).cast("array<double>").alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c)
                                          & (F.abs(c) < float("inf"))))
    commonest = v.groupBy(F.size("v").alias("d")).count().orderBy(
        F.desc("count"), F.desc("d")).first()
    d = commonest.d if commonest else 0
    whole = F.transform("v", lambda c: F.floor(F.greatest(F.least(
        c * SCALE, F.lit(BOUND)), F.lit(-BOUND))).cast("long") + OFFSET)
    return v.where((F.size("v") == d) & (F.size("v") > 0)).select("vec_id", whole.alias("x"))


def matrix(column) -> np.ndarray:
    """The rows of a batch's list column as a matrix of int64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S without overflow: int64 where it fits, Python integers beyond."""
    if not len(x):
        return x
    most = n * int(np.abs(x).max()) + max(abs(s) for s in sums)
    kind = np.int64 if most < 2**63 else object
    return x.astype(kind) * n - np.array(sums, kind)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return exact(x, n, sums).astype(float) / n


def solve_right(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """x inv(r) for an upper triangular r, column by column."""
    q = np.array(x, float, order="F")
    for j in range(q.shape[1]):
        q[:, j] = (q[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _column_sums(batches):
    n, sums = 0, None
    for b in batches:
        if b.num_rows:
            x = matrix(b.column("x"))
            # 2^62 over the largest entry rows can be added without overflow
            step = max(1, 2**62 // max(1, int(np.abs(x).max())))
            for at in range(0, len(x), step):
                part = [int(s) for s in x[at:at + step].sum(axis=0)]
                sums = part if sums is None else [a + c for a, c in zip(sums, part)]
            n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(sums)), pa.int32()), pa.array([n] * len(sums), pa.int64()),
             pa.array([str(s) for s in sums])], names=["i", "n", "s"])


def _added(batches):
    total = None
    for b in batches:
        for m in b.column("m").to_pylist():
            m = np.frombuffer(m)
            total = m if total is None else total + m
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])


def distributed_sum(rows: DataFrame, of, size: int) -> np.ndarray:
    """Sum over all batches of ``of(matrix of x)``, ``size`` numbers, added on executors."""
    def run(batches):
        total = np.zeros(size)
        for b in batches:
            if b.num_rows:
                total += of(matrix(b.column("x"))).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["m"])

    each = rows.select("x").mapInArrow(run, "m binary")
    few = each.repartition(PARTS).mapInArrow(_added, "m binary").collect()
    return sum((np.frombuffer(r.m) for r in few), np.zeros(size))


def gram(rows: DataFrame, n: int, sums: list[int], factors: list[np.ndarray]) -> np.ndarray:
    """Gram matrix of the centred rows after the triangular solves with ``factors``."""
    def of(x):
        q = centred(x, n, sums)
        for r in factors:
            q = solve_right(q, r)
        return q.T @ q

    d = len(sums)
    return distributed_sum(rows, of, d * d).reshape(d, d)


def cholesky_r(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper R with R'R = g + shift I, for the smallest tenfold of ``shift`` that allows it."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, np.finfo(float).eps * np.trace(g), np.finfo(float).tiny)


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors in column ``x``; None without variance."""
    listed = cut_lineage(x.select("x").distinct())
    sums = listed.mapInArrow(_column_sums, "i int, n long, s string").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")) \
        .orderBy("i").collect()
    if not sums:
        return None
    n, s, d = sums[0].n, [int(r.s) for r in sums], len(sums)
    eps = np.finfo(float).eps
    factors: list[np.ndarray] = []
    for k in range(PASSES):
        g = gram(listed, n, s, factors)
        if k == 0:
            total = float(np.trace(g)) / n
            if not total > 0:
                return None
            shift = min(11 * (n * d + d * (d + 1)) * eps, 1e-3) * float(np.linalg.norm(g, 2))
        else:
            shift = 0.0
            if np.abs(g - np.eye(d)).max() < 8 * d * eps:
                break
        factors.append(cholesky_r(g, shift))
    r = np.eye(d)
    for f in factors:
        r = f @ r
    _, sv, vt = np.linalg.svd(r)
    keep = min(components, int((sv > RANK_TOLERANCE * sv[0]).sum()))
    model = Whitening(n, s, vt[:keep].T.copy(), sv[:keep] ** 2 / n, total)

    def spread(x):
        w = whitened(x, model)
        return np.vstack([w.sum(axis=0), w.T @ w])

    moments = distributed_sum(listed, spread, (keep + 1) * keep).reshape(keep + 1, keep) / n
    cov = moments[1:] - np.outer(moments[0], moments[0])
    model.identity_error = float(np.abs(cov - np.eye(keep)).max())
    return model


def whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return centred(x, model.n, model.sums) @ model.vectors / np.sqrt(model.values)


OUT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
       "explained double, identity_error double")


def _scores(model: Whitening):
    k = len(model.values)
    explained = model.values / model.total

    def run(batches):
        for b in batches:
            # a few thousand rows at a time: each becomes k rows
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                x = matrix(part.column("x"))
                dev = exact(x, model.n, model.sums)
                big = dev.dtype != object and x.shape[1] * int(np.abs(dev).max()) ** 2 >= 2**63
                dev = ((dev.astype(object) if big else dev) ** 2).sum(axis=1)
                m = len(x)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                    pa.array(np.full(m * k, model.n), pa.int64()),
                    pa.array([str(v) for v in dev.tolist()]).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(whitened(x, model).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                    part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k)))],
                    names=["component", "n", "deviation", "whitened", "explained",
                           "identity_error", "vec_id"])
    return run


def whiten(emb: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """Each vector on the leading ``components`` of the fit list, in units of their spread:
    vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = emb.sparkSession
    x = whole_vectors(emb, vector)
    model = fit(x, components)
    if model is None:
        return spark.createDataFrame([], OUT)
    rows = x.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(
        _scores(model), "component int, n long, deviation string, whitened double, "
                        "explained double, identity_error double, vec_id long")
    return rows.select("vec_id", "component", "n",
                       F.col("deviation").cast("decimal(38,0)").alias("deviation"),
                       "whitened", "explained", "identity_error")
