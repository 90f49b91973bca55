"""Whitening of embeddings by principal components found with Jacobi-Davidson.

Entries become integers, ``floor(scale * c) + shift``, of which the sums are exact. The covariance is never formed: it
acts on a block of vectors by one Spark job that centres every row first (an integer difference, then the fraction of
the mean), multiplies there and back, and adds up what comes out, dimensions x vectors numbers, over all tasks.

The driver holds only a search space of some ``count`` vectors of the embedding's length. Rayleigh-Ritz in it gives the pairs;
from the largest down, a pair whose residual is at rounding level is locked and the rest is kept orthogonal to it. For
the others MINRES solves the correction equations, projected against the locked pairs and the pair itself, all side by side, so
that an inner step is one distributed product of a block. The corrections widen the space, which is cut back to its best
vectors when it grows too large. The locked vectors are multiplied once more, and the search goes on if a residual is not there yet.

Rows with a null or empty vector or a null or non-finite entry are dropped; a null id stays, and repeated rows count each. Vectors
of different lengths have no covariance: ``ValueError``. Entries over 2^40 in size after scaling, or a spread over 2^31,
raise ``OverflowError``. Components whose eigenvalue cannot be told from zero (identical rows, one row, linear dependence) are left out, so there may be
fewer than ``count``, or none and an empty result; equal eigenvalues share a space, of which any basis may come. An empty table gives an
empty result. Only the two named columns are read, whatever further columns are called.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentrisk.llm.ann import directions
from rentrisk.llm.common import sum_batches
from rentrisk.session import materialize

BLOCK_ROWS = 2048
EPS = float(np.finfo(np.float64).eps)


# ---- blocks of integer vectors

def pack(scale: int, shift: int):
    """A mapInArrow function: (id, vec) to blocks of ids and integers, each block of one vector length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = pc.list_value_length(b.column(1)).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths):
                same = np.flatnonzero(lengths == dim)
                for f in range(0, len(same), BLOCK_ROWS):
                    rows = b.take(pa.array(same[f:f + BLOCK_ROWS]))
                    c = rows.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    with np.errstate(over="ignore"):
                        x = np.floor(float(scale) * c)
                    if not np.abs(x).max() <= 2.0 ** 40:
                        raise OverflowError("an entry is too large to be scaled")
                    x = x.astype(np.int64) + shift
                    kind = next(k for k in ("<i2", "<i4", "<i8") if np.abs(x).max() <= np.iinfo(k).max)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rows.column(0).to_pylist()], pa.list_(b.schema.field(0).type)),
                         pa.array([x.astype(kind).tobytes()], pa.binary()), pa.array([kind]),
                         pa.array([int(dim)], pa.int32()), pa.array([rows.num_rows], pa.int64())],
                        ["ids", "x", "kind", "dim", "n"])
    return run


def unpack(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, rows x dim int64) of every block."""
    at = {f.name: i for i, f in enumerate(batch.schema)}
    for r in range(batch.num_rows):
        get = lambda name: batch.column(at[name])[r]
        x = np.frombuffer(get("x").as_buffer(), get("kind").as_py()).astype(np.int64)
        yield get("ids").values, x.reshape(-1, get("dim").as_py())


@dataclass
class Centre:
    """The exact mean: sums of the scaled entries over n rows, as whole part and remainder."""
    n: int
    sums: list[int]

    def parts(self) -> tuple[np.ndarray, np.ndarray]:
        both = [divmod(s, self.n) for s in self.sums]
        return np.array([q for q, _ in both], np.int64), np.array([r for _, r in both], np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean, in double precision: rounded once."""
        q, r = self.parts()
        return (x - q).astype(np.float64) - r / self.n


def block_sums(blocks: DataFrame, dim: int) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim, object)
        for b in batches:
            for _, x in unpack(b):
                total = total + x.sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()),
                                          pa.array([Decimal(int(v)) for v in total], pa.decimal128(28, 0))], ["at", "v"])

    rows = blocks.mapInArrow(run, "at int, v decimal(28,0)").groupBy("at").agg(F.sum("v").alias("v")).collect()
    sums = {r["at"]: int(r["v"]) for r in rows}
    return [sums[i] for i in range(dim)]


def reduce_rows(blocks: DataFrame, centre: Centre, size: int, f: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``f(centred rows)``, an array of ``size`` doubles: one Spark job."""
    def add(batch: pa.RecordBatch) -> np.ndarray:
        return sum((f(centre.rows(x)).ravel() for _, x in unpack(batch)), np.zeros(size))

    return sum_batches(blocks.select("ids", "x", "kind", "dim"), size, add)


# ---- Jacobi-Davidson

def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->j", x, x))


def orthogonal(x: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of ``x`` less their parts in ``against``; what vanishes is left out."""
    base = np.column_stack([np.zeros((x.shape[0], 0)), *against])
    old = base.shape[1]
    for v in x.T:
        for least in (0.0, 1e-10, 1e-10):
            size = np.linalg.norm(v)
            if size <= least or base.shape[1] == len(v):
                break
            v = v / size
            v = v - base @ (base.T @ v)
        else:
            base = np.column_stack([base, v / np.linalg.norm(v)])
    return base[:, old:]


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int, enough: float) -> np.ndarray:
    """Each column's symmetric system solved by MINRES, all side by side; a step is one ``apply`` of a block."""
    beta = norms(b)
    safe = lambda v: np.where(v > 0, v, 1.0)
    x, v_old, w_old, w = (np.zeros_like(b) for _ in range(4))
    v, eta, first = b / safe(beta), beta.copy(), beta.copy()
    c_old, c, s_old, s = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        p = apply(v)
        alpha = np.einsum("ij,ij->j", v, p)
        p = p - alpha * v - beta * v_old
        after = norms(p)
        delta = c * alpha - c_old * s * beta
        rho1 = safe(np.hypot(delta, after))
        rho2, rho3 = s * alpha + c_old * c * beta, s_old * beta
        c_old, c, s_old, s = c, delta / rho1, s, after / rho1
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / rho1
        x = x + c * eta * w
        eta = -s * eta
        v_old, v, beta = v, p / safe(after), after
        if (np.abs(eta) <= enough * first).all():
            break
    return x


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dim: int, count: int, inner: int = 8, spare: int = 4,
                    most_rounds: int = 100, seed: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, their unit vectors (columns) and residuals, of a symmetric operator without negative ones.

    ``product`` applies it to the columns of a matrix. A residual is at rounding level when it is at most
    dim x 2^-52 times the largest eigenvalue.
    """
    count = min(count, dim)
    most = min(dim, 3 * count + spare)
    locked, values, top = np.zeros((dim, 0)), np.zeros(0), 0.0
    space = orthogonal(directions(min(dim, count + spare), dim, seed).T)
    image = product(space)

    def ritz(basis: np.ndarray, image: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h = basis.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        y = y[:, ::-1]
        return theta[::-1], basis @ y, image @ y

    for _ in range(most_rounds):
        theta, space, image = ritz(space, image)
        top = max(top, theta.max(initial=0.0), values.max(initial=0.0))
        limit = dim * EPS * top
        want = min(count - locked.shape[1], len(theta))
        residual = image[:, :want] - space[:, :want] * theta[:want]
        residual -= locked @ (locked.T @ residual)
        far = norms(residual) > limit
        # a pair is locked when it is there and so are all larger ones, but for ties
        largest_far = theta[np.argmax(far)] if far.any() else -np.inf
        done = np.zeros(len(theta), bool)
        done[:want] = ~far & (theta[:want] >= largest_far - 1e-10 * top)
        locked, values = np.column_stack([locked, space[:, done]]), np.concatenate([values, theta[done]])
        if locked.shape[1] == count:
            # multiplied afresh: rounding of rotated images cannot hide in the result
            values, locked, image = ritz(locked, product(locked))
            left = norms(image - locked * values)
            if (left <= 2 * limit).all():
                return values, locked, left
            space, locked, values = locked, np.zeros((dim, 0)), np.zeros(0)
            continue
        pairs, shift, residual = space[:, :want][:, far], theta[:want][far], residual[:, far]
        space, image = space[:, ~done], image[:, ~done]
        if space.shape[1] + pairs.shape[1] > most - locked.shape[1]:
            space, image = space[:, :want + spare], image[:, :want + spare]
        known = np.column_stack([locked, pairs])

        def project(t: np.ndarray) -> np.ndarray:
            return t - known @ (known.T @ t)

        more = minres(lambda t: project(product(t) - t * shift), -project(residual), inner, 1e-3)
        more = orthogonal(more, locked, space)
        if more.shape[1]:
            space, image = np.column_stack([space, more]), np.column_stack([image, product(more)])
        else:
            space = orthogonal(space, locked)
            image = product(space)
    raise ArithmeticError("the residuals did not reach rounding level")


# ---- the operator

@dataclass
class Whitening:
    """A fitted projection: ``axes`` are unit columns, ``values`` their variances."""
    centre: Centre
    axes: np.ndarray
    values: np.ndarray
    trace: float
    residual: float = 0.0
    identity_error: float = 0.0

    def project(self, centred: np.ndarray) -> np.ndarray:
        return (centred @ self.axes) / np.sqrt(self.values)


def fit(blocks: DataFrame, count: int) -> Whitening | None:
    n, least, dim = blocks.agg(F.sum("n"), F.min("dim"), F.max("dim")).first()
    if not n:
        return None
    if least != dim:
        raise ValueError(f"vectors of {least} and of {dim} entries have no common covariance")
    centre = Centre(n, block_sums(blocks, dim))
    trace = float(reduce_rows(blocks, centre, 1, lambda x: np.array([(x * x).sum()]))[0]) / n
    if trace == 0:
        return Whitening(centre, np.zeros((dim, 0)), np.zeros(0), 0.0)

    def product(u: np.ndarray) -> np.ndarray:
        return reduce_rows(blocks, centre, u.size, lambda x: x.T @ (x @ u)).reshape(u.shape) / n

    values, axes, left = jacobi_davidson(product, dim, count)
    real = values > 4 * dim * EPS * values[0]
    values, axes = values[real], axes[:, real]
    # either sign is right: the largest entry is positive
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    w = Whitening(centre, axes, values, trace, float(left.max() / values[0]))
    k = len(values)
    mean = reduce_rows(blocks, centre, k, lambda x: w.project(x).sum(axis=0)) / n

    def spread(x: np.ndarray) -> np.ndarray:
        z = w.project(x) - mean
        return z.T @ z

    w.identity_error = float(np.abs(reduce_rows(blocks, centre, k * k, spread).reshape(k, k) / n - np.eye(k)).max())
    return w


def whiten(rows: DataFrame, count: int = 32, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error, residual`` of every remaining row and component.

    ``deviation``, decimal(38,0), is the exact sum over the dimensions of (n * x - sum)^2; ``residual`` is the largest of the
    pairs' residuals over the largest eigenvalue.
    """
    element = rows.schema[vec_col].dataType.elementType
    vec = F.col(vec_col) if isinstance(element, (T.FloatType, T.DoubleType)) else F.col(vec_col).cast("array<double>")
    good = rows.select(F.col(id_col).alias("id"), vec.alias("vec")).filter("vec is not null and size(vec) > 0").filter(
        ~F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    kind = rows.schema[id_col].dataType.simpleString()
    blocks = materialize(good.mapInArrow(pack(scale, shift), f"ids array<{kind}>, x binary, kind string, dim int, n long"),
                         "whitening-blocks")
    w = fit(blocks, count)
    if w is None:
        w = Whitening(Centre(1, []), np.zeros((0, 0)), np.zeros(0), 1.0)
    n = w.centre.n

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, r = w.centre.parts()
        for b in batches:
            for ids, x in unpack(b):
                off = x - q
                widest = int(np.abs(off).max())
                if widest * n * len(q) >= 1 << 62 or widest * widest * len(q) >= 1 << 62:
                    raise OverflowError("the spread of the entries is too large for exact sums")
                z = w.project(w.centre.rows(x))
                ends = pa.array(np.arange(len(x) + 1) * z.shape[1], pa.int32())
                flat = pa.ListArray.from_arrays(ends, pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([ids, pa.array((off * off).sum(axis=1)), pa.array(off @ r), flat],
                                                 ["id", "a", "b", "z"])

    big = lambda v: F.lit(Decimal(v)).cast("decimal(38,0)")
    long = lambda c: c.cast("decimal(19,0)")
    rest = sum(int(r) ** 2 for r in w.centre.parts()[1]) if w.centre.sums else 0
    # (n x - sum)^2 with sum = n q + r, added up over the dimensions: n^2 a - 2 n b + sum of r^2
    n_ = long(F.lit(n))
    deviation = ((n_ * long(F.col("a")) - F.col("b").cast("decimal(20,0)") * F.lit(2)).cast("decimal(38,0)") * n_
                 + big(rest)).cast("decimal(38,0)")
    out = blocks.select("ids", "x", "kind", "dim").mapInArrow(apply, f"id {kind}, a long, b long, z array<double>")
    shares = F.array(*[F.lit(float(v)) for v in w.values / w.trace]).cast("array<double>")
    return (out.select("id", deviation.alias("deviation"), F.posexplode("z").alias("at", "whitened"))
            .select(F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"),
                    F.lit(w.identity_error).alias("identity_error"), F.lit(w.residual).alias("residual")))
