"""op11: whitened embeddings by Chebyshev-filtered subspace iteration.

Vectors become whole numbers (floor of ``scale`` times an entry, plus ``shift``); the fit list
holds each distinct one once, as a table in the shared folder.  One pass over it gives the exact
sums, and every further pass multiplies a thin block Q by the covariance: each task centres its
rows, adds up its part of X'(XQ), and Spark sums the parts by row of the product.  The driver
holds only blocks of dims x (components + guard).

A round filters the block by a Chebyshev polynomial that is small over the unwanted part of the
spectrum (from a lower bound up to the block's least Ritz value) and large above it, makes it
orthonormal (QR) and solves the small problem in its span (Rayleigh-Ritz).  The lower bound comes
from a Lanczos run that rides along with the first round's passes.  Rounds end when the wanted
pairs' residuals are at rounding level; they must be under ``CERTIFIED`` of the largest
eigenvalue, else the fit is refused.  The whitened fit list's covariance is measured by a pass of
its own.

Results in the odd cases: rows whose vector is null, empty or holds a null, NaN or infinite
entry are dropped, and so are rows of another length than most distinct vectors have (ties: the
longer).  Entries beyond +-2**40 / scale count as that.  Repeated rows are fitted once and all
returned.  Directions without variance (eigenvalue under ``RANK`` of the largest) are no
components, so a table of no or one distinct vector has none.  A deviation that no long holds
is null.  Other columns pass through; one named as the output is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from quayside.llm import batches as B

SCALE, SHIFT = 64, 1_000_000
WIDEST = float(1 << 40)
GUARD = 16  # columns of the block beyond the wanted components
DEGREE = 10  # of the polynomial at most
SPREAD = 1e10  # most by which the filter may set the block's columns apart
FLOOR, CERTIFIED, RANK = 1e-14, 1e-10, 1e-12
ROUNDS = 100
ENTRIES = 1 << 18  # vector entries handled at once inside a task
X = "__whole"

RESULT = StructType([StructField("deviation", LongType()),
                     StructField("whitened", ArrayType(DoubleType()))])


def whole(vector: str, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """The vector as whole numbers; null where it is no usable vector."""
    usable = (F.size(vector) > 0) & F.forall(
        vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    entries = F.transform(vector, lambda c: F.floor(F.greatest(F.least(
        c.cast("double") * scale, F.lit(WIDEST)), F.lit(-WIDEST))).cast("long") + shift)
    return F.when(F.coalesce(usable, F.lit(False)), entries)


def blocks(batch: pa.RecordBatch, name: str, dims: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, matrix of whole numbers) of slices of a batch."""
    flat = batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    step = max(1, ENTRIES // dims)
    for first in range(0, len(flat), step):
        yield first, flat[first:first + step]


def _summed(fit: DataFrame, rows: int, width: int, kind: str,
            part: Callable[[np.ndarray], np.ndarray], dims: int) -> np.ndarray:
    """The sum over the fit list of ``part`` (a matrix of rows x width for some vectors)."""
    names = [f"c{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in blocks(batch, X, dims):
                found = part(x)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(rows, dtype=np.int32)),
                 *(pa.array(np.ascontiguousarray(c)) for c in total.T)], ["i", *names])

    schema = "i int, " + ", ".join(f"{n} {kind}" for n in names)
    added = fit.mapInArrow(run, schema).groupBy("i").agg(*(F.sum(n) for n in names))
    out = np.zeros((rows, width), np.int64 if kind == "long" else float)
    for row in added.collect():  # rows x width numbers, whatever the number of vectors
        out[row[0]] = row[1:]
    return out


@dataclass
class Whitening:
    """A fitted model: exact sums, unit eigenvectors (columns) by falling eigenvalue."""

    dims: int
    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    passes: int

    def apply(self, docs: DataFrame, vector: str = "embedding", out: str = "whitening",
              scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
        """``docs`` with a struct ``out`` of deviation and whitened vector; unusable rows go."""
        docs = docs.withColumn(X, whole(vector, scale, shift)).where(F.size(X) == self.dims)
        keep = [f for f in docs.schema.fields if f.name not in (out, X)]
        dims, centre = self.dims, _centre(self.n, self.sums)
        n, sums = self.n, self.sums
        axes = self.vectors / np.sqrt(self.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, x in blocks(batch, X, dims):
                    here = centre(x) @ axes
                    rows = pa.ListArray.from_arrays(
                        pa.array(np.arange(len(x) + 1, dtype=np.int32) * here.shape[1]),
                        pa.array(here.ravel()))
                    found = pa.StructArray.from_arrays(
                        [_deviations(x, n, sums), rows], ["deviation", "whitened"])
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(f.name).slice(first, len(x)) for f in keep), found],
                        [*(f.name for f in keep), out])

        return docs.mapInArrow(run, StructType([*keep, StructField(out, RESULT)]))


def _centre(n: int, sums: list[int]) -> Callable[[np.ndarray], np.ndarray]:
    """x - S/n: whole parts are taken off as whole numbers, so nothing cancels."""
    base = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    return lambda x: (x - base) - rest


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of (n*x - S)**2 over the entries: in longs where they hold it, else in big integers."""
    base = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    rough = ((n * (x - base).astype(float) - np.array(rest, float)) ** 2).sum(axis=1)
    small = rough < 2.0 ** 62
    with np.errstate(over="ignore"):  # of rows that are done anew below
        exact = ((n * (x - base) - np.array(rest, np.int64)) ** 2).sum(axis=1)
    found: list[int | None] = exact.tolist()
    for k in np.flatnonzero(~small):
        total = sum((n * int(v) - s) ** 2 for v, s in zip(x[k], sums))
        found[k] = total if total < 1 << 63 else None
    return pa.array(found, pa.int64())


def _chebyshev(times: Callable, q: np.ndarray, vq: np.ndarray, low: float, high: float,
               top: float, degree: int) -> np.ndarray:
    """The polynomial that is 1 at ``top`` and least over low..high, applied to ``q``."""
    half, mid = (high - low) / 2, (high + low) / 2
    sigma = half / (top - mid)
    tau = 2 / sigma
    y = (vq - mid * q) * (sigma / half)
    for _ in range(1, degree):
        after = 1 / (tau - sigma)
        y, q = (times(y) - mid * y) * (2 * after / half) - sigma * after * q, y
        sigma = after
    return y


class _Lanczos:
    """A Lanczos run that gets one product at a time; bounds the spectrum from below."""

    def __init__(self, start: np.ndarray):
        self.basis, self.alpha, self.beta = [start / np.linalg.norm(start)], [], []

    def take(self, product: np.ndarray) -> None:
        self.alpha.append(float(self.basis[-1] @ product))
        seen = np.array(self.basis)
        for _ in range(2):
            product = product - seen.T @ (seen @ product)
        self.beta.append(float(np.linalg.norm(product)))
        self.basis.append(product / self.beta[-1] if self.beta[-1] > 0 else product)

    def least(self) -> float:
        inner = self.beta[:-1]
        values, vectors = np.linalg.eigh(
            np.diag(self.alpha) + np.diag(inner, 1) + np.diag(inner, -1))
        return max(0.0, values[0] - self.beta[-1] * abs(vectors[-1, 0]))


def fit(docs: DataFrame, vector: str = "embedding", components: int = 16,
        scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The model of the distinct usable vectors, or None where there is no usable vector."""
    distinct = B.saved(docs.select(whole(vector, scale, shift).alias(X)).where(F.col(X).isNotNull())
                       .distinct(), "whitening-fit")
    sizes = {r[0]: r[1] for r in distinct.groupBy(F.size(X)).count()
             .orderBy(F.desc("count"), F.desc(F.size(X))).limit(1).collect()}
    if not sizes:
        return None
    (dims, n), = sizes.items()
    listed = distinct.where(F.size(X) == dims)
    sums = [int(s) for s in _summed(
        listed, dims, 1, "long", lambda x: x.sum(axis=0)[:, None], dims)[:, 0]]
    centre = _centre(n, sums)
    wanted, width = min(components, dims), min(components + GUARD, dims)
    passes = 0

    def covariance(q: np.ndarray) -> tuple[np.ndarray, float]:
        """V q, and the trace of V."""
        nonlocal passes
        passes += 1

        def part(x: np.ndarray) -> np.ndarray:
            c = centre(x)
            out = np.zeros((dims + 1, q.shape[1]))
            out[:dims] = c.T @ (c @ q)
            out[dims, 0] = np.vdot(c, c)
            return out

        found = _summed(listed, dims + 1, q.shape[1], "double", part, dims) / n
        return found[:dims], float(found[dims, 0])

    rng = np.random.default_rng(11)
    q = np.linalg.qr(rng.standard_normal((dims, width)))[0]
    probe: _Lanczos | None = _Lanczos(rng.standard_normal(dims))

    def times(y: np.ndarray) -> np.ndarray:
        if probe is None:
            return covariance(y)[0]
        both = covariance(np.column_stack([y, probe.basis[-1]]))[0]
        probe.take(both[:, -1])
        return both[:, :-1]

    vq, trace = covariance(q)
    low, best, kept = 0.0, np.inf, None
    for turn in range(ROUNDS):
        values, turned = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turned = values[::-1], turned[:, ::-1]
        q, vq = q @ turned, vq @ turned
        top = values[0]
        error = np.linalg.norm(vq - q * values, axis=0)[:wanted].max() if top > 0 else 0.0
        stalled = error > best / 2 and best <= CERTIFIED * top
        if error < best:
            best, kept = error, (q[:, :wanted], values[:wanted])
        if best <= FLOOR * top or stalled:
            break
        if probe is not None and turn:
            low, probe = probe.least(), None
        if values[-1] <= low:
            low = 0.0
        high = max(values[-1], low + 1e-6 * top)
        growth = [np.log(2 * (v - (high + low) / 2) / ((high - low) / 2) + 1e-9)
                  for v in (top, high)]
        degree = int(np.clip(np.log(SPREAD) / max(growth[0] - growth[1], 1e-9), 2, DEGREE))
        y = _chebyshev(times, q, vq, low, high, max(top, high * 1.001), degree)
        q = np.linalg.qr(y / np.maximum(np.linalg.norm(y, axis=0), 1e-300))[0]
        vq = times(q)
    if best > CERTIFIED * top:
        raise ArithmeticError(f"residual {best} of {top} after {passes} passes")
    vectors, values = kept
    real = values > RANK * top if top > 0 else values > 0
    vectors, values = vectors[:, real], values[real]
    unit = 0.0
    if len(values):
        axes = vectors / np.sqrt(values)

        def part(x: np.ndarray) -> np.ndarray:
            z = centre(x) @ axes
            return z.T @ z

        unit = float(np.abs(_summed(listed, len(values), len(values), "double", part, dims) / n
                            - np.eye(len(values))).max())
    return Whitening(dims, n, sums, vectors, values, trace, unit, passes)


def op11(docs: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
         components: int = 16) -> DataFrame:
    """The contract's columns, a row per usable row and component."""
    model = fit(docs, vector, components)
    if model is None or not len(model.values):
        return docs.select(
            F.col(vec_id).alias("vec_id"), *(F.lit(None).cast(t).alias(c) for c, t in (
                ("component", "int"), ("n", "long"), ("deviation", "long"),
                ("whitened", "double"), ("explained", "double"),
                ("identity_error", "double")))).where("false")
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    found = model.apply(docs.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector")),
                        "vector")
    return (found.select("vec_id", F.col("whitening.deviation").alias("deviation"),
                         F.posexplode("whitening.whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"),
                    F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(shares, F.col("at") + 1).alias("explained"),
                    F.lit(model.identity_error).alias("identity_error")))
