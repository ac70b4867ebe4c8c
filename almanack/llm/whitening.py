"""Whitening by the first principal components, found by contour integration (FEAST).

Vectors become whole numbers; the different ones are the fit list.  Spark sums the list and
then the products of its centred components, so what reaches the driver is one number per
pair of components, whatever the rows.

Inertia counts (the signs of the factors of the shifted covariance) tell how many
eigenvalues lie above any number; bisection with them finds an interval that holds the
wanted ones and ends in the gap below.  A circle through its ends is the contour: at each
quadrature node a complex shifted covariance is solved, one task per node, and the solutions
add up to a filter that keeps the interval's eigenvectors and damps the others.
Filtering and Rayleigh-Ritz alternate until the residuals vanish; the number of Ritz
values in the interval must be the inertia count, else the subspace grows.

Defined results: rows whose vector is null or empty or holds null or non-finite entries are
dropped; rows with a null id or of a repeated id stay, each for itself; vectors of
different lengths are whitened apart, each length with its own fit; directions without
spread (all of them when there is one vector) have no component; ``deviation`` is null
where it exceeds a long; an empty table gives no rows; other columns are left.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from almanack.llm import vectors as V
from almanack.llm.base import register, staged, table

COMPONENTS = 4
SCALE = 256
NODES = 8
SEED = 5
SMALL = 1e-13


# -- eigenvalues of a symmetric matrix --------------------------------------------


def tridiagonal(v):
    """Diagonal and off-diagonal of a tridiagonal matrix with ``v``'s eigenvalues."""
    a = np.array(v, float)
    size = len(a)
    for i in range(size - 2):
        x = a[i + 1 :, i].copy()
        length = np.linalg.norm(x)
        if length == 0:
            continue
        x[0] += np.copysign(length, x[0])
        x /= np.linalg.norm(x)
        block = a[i + 1 :, i + 1 :]
        y = block @ x
        y -= (x @ y) * x
        block -= 2 * (np.outer(x, y) + np.outer(y, x))
        a[i + 1 :, i] = a[i, i + 1 :] = 0
        a[i + 1, i] = a[i, i + 1] = -np.copysign(length, x[0])
    return np.diag(a).copy(), np.abs(np.diag(a, 1))


def count_above(diagonal, off, shift):
    """How many eigenvalues exceed ``shift``: the inertia of the shifted matrix."""
    tiny = np.finfo(float).tiny
    above, pivot, before = 0, 1.0, 0.0
    for d, e in zip(diagonal, np.r_[0.0, off]):
        pivot = (d - shift) - (e * e / pivot if e else 0.0)
        if pivot == 0:
            pivot = -tiny
        above += pivot > 0
    return above


def bracket(diagonal, off, count):
    """``(low, high, inside)``: an interval with at least the ``count`` largest
    eigenvalues, ``low`` in the gap below them, and the number it holds."""
    reach = np.r_[0.0, off] + np.r_[off, 0.0]
    floor, top = float((diagonal - reach).min()), float((diagonal + reach).max())
    width = max(top - floor, 1e-3 * max(abs(top), abs(floor)))
    floor, top = floor - 1e-3 * width, top + 1e-3 * width

    def value(place):
        """The ``place``-th largest eigenvalue, from 1."""
        low, high = floor, top
        while high - low > 1e-14 * max(abs(low), abs(high), width):
            middle = (low + high) / 2
            if middle in (low, high):
                break
            if count_above(diagonal, off, middle) >= place:
                low = middle
            else:
                high = middle
        return (low + high) / 2

    size = len(diagonal)
    first, last = value(1), value(count)
    inside = count
    while inside < size:  # equal eigenvalues stay together
        below = value(inside + 1)
        if last - below > 1e-9 * width:
            break
        inside += 1
        last = below
    low = (last + below) / 2 if inside < size else last - 1e-3 * width
    high = first + max(first - low, 1e-3 * width) * 0.05
    if count_above(diagonal, off, low) - count_above(diagonal, off, high) != inside:
        raise ArithmeticError("inertia counts disagree")
    return low, high, inside


def contour(low, high, nodes=NODES):
    """Points on the upper half of the circle through ``low`` and ``high``, and factors."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    turn = (high - low) / 2 * np.exp(1j * np.pi / 2 * (x + 1))
    return (low + high) / 2 + turn, w / 2 * turn


def shifted_solution(v, point, factor):
    """A node's share of the filter."""
    return (factor * np.linalg.solve(point * np.eye(len(v)) - v, np.eye(len(v)))).real


def _solutions(v):
    def run(batches):
        for batch in batches:
            a, b, c, d = (batch.column(i).to_numpy() for i in range(4))
            for k in range(len(a)):
                share = shifted_solution(v, a[k] + 1j * b[k], c[k] + 1j * d[k])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v))), pa.array(list(share))], names=["i", "share"])

    return run


def filter_on_spark(spark, v, low, high):
    """The quadrature, a task per node."""
    points, factors = contour(low, high)
    rows = [(float(z.real), float(z.imag), float(f.real), float(f.imag)) for z, f in zip(points, factors)]
    nodes = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(len(rows))
    parts = nodes.mapInArrow(_solutions(v), "i long, share array<double>").toArrow()
    total = np.zeros_like(v)
    np.add.at(total, parts["i"].to_numpy(), np.array(parts["share"].to_pylist()))
    return total


def feast(v, low, high, inside, quadrature):
    """Eigenvalues in the interval, falling, and unit eigenvectors as columns."""
    size, norm = len(v), np.abs(v).sum(axis=1).max()
    rng = np.random.default_rng(SEED)
    width = min(size, 2 * inside + 8)
    keeping = (quadrature + quadrature.T) / 2
    y = rng.standard_normal((size, width))
    for turn in range(1, 401):
        q, _ = np.linalg.qr(keeping @ y)
        ritz, small = np.linalg.eigh(q.T @ v @ q)
        y = q @ small
        own = np.flatnonzero((ritz > low) & (ritz <= high))[::-1]
        residual = np.linalg.norm(v @ y[:, own] - y[:, own] * ritz[own], axis=0)
        if len(own) == inside and (residual <= SMALL * norm).all():
            return ritz[own], y[:, own]
        if turn % 20 == 0 and width < size:  # damped too little outside: a wider subspace
            width = min(size, 2 * width)
            y = np.c_[y, rng.standard_normal((size, width - y.shape[1]))]
    raise ArithmeticError("contour integration did not settle")


def components(spark, v, count=COMPONENTS):
    """The first ``count`` eigenvalues above rounding and their unit vectors."""
    trace = float(np.trace(v))
    if not trace > 0:
        return np.zeros(0), np.zeros((len(v), 0))
    unit = v / trace
    diagonal, off = tridiagonal(unit)
    low, high, inside = bracket(diagonal, off, min(count, len(v)))
    values, vectors = feast(unit, low, high, inside, filter_on_spark(spark, unit, low, high))
    real = np.flatnonzero(values > len(v) * np.finfo(float).eps)[:count]
    return values[real] * trace, vectors[:, real]


# -- sums over the fit list ---------------------------------------------------------


def _sums(batches):
    """Per length and component: the sum, and the number of vectors."""
    total = {}
    for batch in batches:
        lists = batch.column(0)
        sizes = lists.value_lengths().to_numpy()
        for size in np.unique(sizes).tolist():
            x = V.matrix(lists.filter(pa.array(sizes == size)), size)
            n, s = total.get(size, (0, 0))
            total[size] = n + len(x), s + x.sum(axis=0)
    for size, (n, s) in total.items():
        yield pa.RecordBatch.from_arrays([pa.array(np.full(size, size, np.int32)), pa.array(np.arange(size)), pa.array(np.full(size, n)), pa.array(s)], names=["size", "i", "n", "s"])


def _products(of, project):
    """Per pair of components: the sum of products of what ``project`` gives, and at
    place -1 the plain sums."""

    def run(batches):
        total, single = 0.0, 0.0
        for batch in batches:
            x = V.matrix(batch.column(0), of)
            for at in range(0, len(x), max(1, V.AT_ONCE // of)):
                y = project(x[at : at + max(1, V.AT_ONCE // of)])
                total, single = total + y.T @ y, single + y.sum(axis=0)
        if np.ndim(total):
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[np.full(len(single), -1), i]), pa.array(np.r_[np.arange(len(single)), j]), pa.array(np.r_[single, total[i, j]])],
                names=["i", "j", "s"],
            )

    return run


def _covariance(fit, size, n, project, width):
    """Covariance of ``project``'s values over the fit list, centred again by their mean."""
    own = fit.where(F.size("x") == size).select("x")
    sums = own.mapInArrow(_products(size, project), "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
    i, j, s = (sums[c].to_numpy() for c in ("i", "j", "s"))
    out, mean = np.zeros((width, width)), np.zeros(width)
    mean[j[i < 0]] = s[i < 0] / n
    i, j, s = i[i >= 0], j[i >= 0], s[i >= 0]
    out[i, j] = out[j, i] = s / n
    return out - np.outer(mean, mean)


class Fit:
    """What whitens the vectors of one length."""

    def __init__(self, fit, size, n, sums, count):
        self.size, self.n, self.sums = size, n, [int(s) for s in sums]
        mean = np.array([s / n for s in self.sums])
        covariance = _covariance(fit, size, n, lambda x: x - mean, size)
        self.mean, self.trace = mean, float(np.trace(covariance))
        self.values, self.vectors = components(fit.sparkSession, covariance, count)
        self.error = 0.0
        if len(self.values):
            got = _covariance(fit, size, n, self.whitened, len(self.values))
            self.error = float(np.abs(got - np.eye(len(got))).max())

    def whitened(self, x):
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)

    def deviation(self, x):
        """Sums of ``(n x - S) ** 2``, exact, ``None`` beyond a long."""
        top = self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, self.sums), default=0)
        if self.size * top * top < 2 ** 63:
            return ((self.n * x - np.array(self.sums)) ** 2).sum(axis=1)
        exact = ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1)
        return [e if e < 2 ** 63 else None for e in exact.tolist()]


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _applied(f):
    def run(batches):
        many = len(f.values)
        for batch in batches:
            for at in range(0, batch.num_rows, max(1, V.AT_ONCE // f.size)):
                part = batch.slice(at, max(1, V.AT_ONCE // f.size))
                x = V.matrix(part.column(1), f.size)
                rows = np.repeat(np.arange(len(x)), many)
                deviation = pa.array(f.deviation(x), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(rows), f.n)), deviation.take(pa.array(rows)), pa.array(f.whitened(x).ravel()),
                        pa.array(np.tile(f.values / f.trace, len(x))), pa.array(np.full(len(rows), f.error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whole_numbers(vectors, vec_id="vec_id", embedding="embedding", scale=SCALE):
    """``id, x`` of the rows that stay."""
    whole = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.transform(F.col(embedding), lambda c: c.cast("double")).alias("v"))
    return rows.where(whole & (F.size("v") > 0)).select("id", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))


def fits(rows, count=COMPONENTS):
    """A ``Fit`` for each length of vectors in ``rows``."""
    fit = staged(rows.select("x").distinct(), "fit-list")
    sums = fit.mapInArrow(_sums, "size int, i long, n long, s long").groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    lengths = {}
    for r in sums.orderBy("size", "i").collect():
        lengths.setdefault(r.size, (r.n, []))[1].append(r.s)
    return [Fit(fit, size, n, s, count) for size, (n, s) in lengths.items()]


def whitened(vectors, vec_id="vec_id", embedding="embedding", count=COMPONENTS):
    """One row per row that stays and component; see the module's first lines."""
    rows = staged(whole_numbers(vectors, vec_id, embedding), "whole-numbers")
    out = None
    for f in fits(rows, count):
        own = rows.where(F.size("x") == f.size).select("id", "x").mapInArrow(_applied(f), OUT)
        out = own if out is None else out.unionByName(own)
    return vectors.sparkSession.createDataFrame([], OUT) if out is None else out


@register("op13_contour_whitening")
def op13_contour_whitening(spark, folder):
    return whitened(table(spark, folder, "embeddings"))
