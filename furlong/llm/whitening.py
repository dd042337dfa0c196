"""Whitening of embeddings by their leading principal components, found by Chebyshev-filtered subspace iteration.

The covariance V of the scaled vectors is never formed. A pass over the stored fit list
gives V times a narrow block Q: every task centres its rows, multiplies and adds up, and
only sums of the block's size leave the tasks. A polynomial of V, by the Chebyshev
recurrence one pass a degree, damps what lies between 0 and the block's smallest Ritz value
and so raises the wanted end of the spectrum. QR and Rayleigh-Ritz follow, until the
residuals certify the wanted pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from furlong.llm.common import cut_lineage

SCALE = 64
OFFSET = 1_000_000
#: Vectors with a larger entry take no part: their squares would outgrow every other figure.
LARGEST = 2.0**36
#: Directions in the block beyond those wanted; degree of the polynomial; rounds before the block is widened.
GUARD = 16
DEGREE = 10
ROUNDS = 8
#: Residuals, as a share of the largest eigenvalue, at which a pair is certified, and above which none is.
TARGET = 2e-14
ENOUGH = 1e-12
#: Components whose eigenvalue is a smaller share of the largest one count as without variance.
NO_VARIANCE = 1e-11


class Fit(NamedTuple):
    """Count and per-dimension sums of the fit list, and its leading components."""

    n: int
    sums: list[int]
    components: np.ndarray  # one a column
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def _scaled(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)


def usable(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``id`` and ``x`` (whole numbers) of the rows that take part."""
    rows = vectors.select(F.col(id_column).alias("id"), F.col(vector).alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) > LARGEST))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & ~F.coalesce(bad, F.lit(True)))
    return rows.select("id", _scaled(F.col("v")).alias("x"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _added(fit_rows: DataFrame, width: int, kind: str, add: Callable[[np.ndarray], np.ndarray]) -> list:
    """Sums over all rows of what ``add`` makes of a batch, flat; one row per sum and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(_matrix(batch.column(0), width)).ravel()
                total = part if total is None else total + part
        if total is not None:
            values = pa.array(total.tolist(), pa.float64() if kind == "double" else pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), values], names=["at", "part"])

    parts = fit_rows.select("x").mapInArrow(run, f"at int, part {kind}")
    return [row[1] for row in sorted(parts.groupBy("at").agg(F.sum("part")).collect())]


class Centre:
    """Exact distances from the mean: n*x - S in whole numbers, without large intermediate ones."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)  # S - n * whole

    def of(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles."""
        return (x - self.whole).astype(float) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of (n*x - S)^2, null where it does not fit a long."""
        y = x - self.whole
        most = (int(np.abs(y).max(initial=0)) + 1) * self.n
        if most * most * max(x.shape[1], 1) < 1 << 63:
            return ((self.n * y - self.rest) ** 2).sum(axis=1).tolist()
        exact = ((self.n * y.astype(object) - self.rest.astype(object)) ** 2).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in exact]


def _filtered(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, top: float, cut: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of the covariance that is at most one on [0, cut], scaled to one at ``top``."""
    half = cut / 2
    sigma = half / (top - half)
    scale = 2 / sigma
    last, now = q, (times(q) - half * q) * (sigma / half)
    for _ in range(degree - 1):
        new_sigma = 1 / (scale - sigma)
        last, now = now, (times(now) - half * now) * (2 * new_sigma / half) - last * (sigma * new_sigma)
        sigma = new_sigma
    return now


def leading(times: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors of a positive operator given by its products.

    Where the block does not converge in ``ROUNDS`` rounds (a spectrum that hardly falls) it is
    doubled; a block of full width is exact at once.
    """
    block, random = min(width, wanted + GUARD), np.random.default_rng(17)
    q = np.linalg.qr(random.standard_normal((width, block)))[0]
    best, since = np.inf, 0
    while True:
        product = times(q)
        small = q.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        top = values[0]
        if top <= 0:
            return values[:0], q[:, :0]
        residual = np.linalg.norm(product[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max() / top
        stalled = residual > best / 2
        best, since = min(best, residual), since + 1
        if residual <= TARGET or (stalled and residual <= ENOUGH):
            break
        if block == width:
            if residual > ENOUGH * 100:
                raise ArithmeticError(f"residual {residual} at full width")
            break
        if since > ROUNDS:
            block, since, best = min(width, 2 * block), 0, np.inf
            q = np.hstack([q, random.standard_normal((width, block - q.shape[1]))])
            q = np.linalg.qr(q)[0]
            continue
        cut = max(values[-1], top * 1e-6)
        if cut >= top * (1 - 1e-12):  # no spread at all: any vectors will do
            break
        q = np.linalg.qr(_filtered(times, q, top, cut, degree))[0]
    keep = values[:wanted] > NO_VARIANCE * top
    vectors = q[:, :wanted][:, keep]
    # of both signs the one that makes the largest entry positive
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[:wanted][keep], vectors * signs


def fit(rows: DataFrame, width: int, wanted: int = 16, degree: int = DEGREE) -> Fit | None:
    """Components of the different vectors of ``rows`` (``x``); none if there are no rows."""
    # equal vectors are combined before the shuffle, and the list is stored: every pass reads it
    fit_rows = cut_lineage(rows.select("x").distinct(), "fit-list")
    n = fit_rows.count()
    if not n:
        return None
    added = _added(fit_rows, width, "decimal(38,0)", lambda x: x.astype(object).sum(axis=0))
    sums = [int(s) for s in added]
    centre = Centre(n, sums)

    def times(q: np.ndarray) -> np.ndarray:
        def add(x: np.ndarray) -> np.ndarray:
            y = centre.of(x)
            return y.T @ (y @ q)

        return np.array(_added(fit_rows, width, "double", add)).reshape(q.shape) / n

    trace = _added(fit_rows, width, "double", lambda x: np.array([(centre.of(x) ** 2).sum()]))[0] / n
    values, vectors = leading(times, width, min(wanted, width), degree) if trace > 0 else (np.empty(0), np.empty((width, 0)))
    error = 0.0
    if len(values):
        turn = vectors / np.sqrt(values)

        def gram(x: np.ndarray) -> np.ndarray:
            z = centre.of(x) @ turn
            return z.T @ z

        found = np.array(_added(fit_rows, width, "double", gram)).reshape(len(values), -1) / n
        error = float(np.abs(found - np.eye(len(values))).max())
    return Fit(n, sums, vectors, values, trace, error)


def whiten(rows: DataFrame, fitted: Fit, id_column: str) -> DataFrame:
    """One row per vector and component; see ``whitened``."""
    centre, count = Centre(fitted.n, fitted.sums), len(fitted.eigenvalues)
    turn, width = fitted.components / np.sqrt(fitted.eigenvalues), len(fitted.sums)
    explained = fitted.eigenvalues / fitted.trace if count else fitted.eigenvalues

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m or not count:
                continue
            x = _matrix(batch.column(1), width)
            deviations = pa.array(centre.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each := pa.array(np.repeat(np.arange(m), count))),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * count, fitted.n, np.int64)),
                    deviations.take(each),
                    pa.array((centre.of(x) @ turn).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * count, fitted.identity_error)),
                ],
                names=["__id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"__id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    return rows.select("id", "x").mapInArrow(run, schema).withColumnRenamed("__id", id_column)


def whitened(
    vectors: DataFrame, components: int = 16, id_column: str = "vec_id", vector: str = "embedding", degree: int = DEGREE
) -> DataFrame:
    """Per vector and component: id, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Entries c become x = floor(64 * c) + 1,000,000. Components are those of the covariance of
    the different x vectors, by falling eigenvalue; of both signs the one with the largest entry
    positive. ``n``: different vectors; ``deviation``: the sum of (n*x - S)^2 over the dimensions,
    exact, null where it does not fit a long; ``whitened``: the centred vector projected on the
    component, over the root of its eigenvalue; ``explained``: the eigenvalue's share of the
    trace; ``identity_error``: the largest entry of the whitened covariance minus the identity.

    Left out are rows whose vector is null, empty, holds null, NaN, an infinity or an entry
    beyond 2^36, or has another length than most vectors (of equally frequent lengths the
    smaller). Rows that repeat an id, or lack one, have their results; repeated vectors count
    once in the fit. There are as many components as have variance, at most as asked for: one
    vector alone, and an empty table, give no rows. Other columns are neither read nor
    returned.
    """
    rows = usable(vectors, id_column, vector)
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), "width").head(1)
    width = widths[0]["width"] if widths else 1
    rows = rows.filter(F.size("x") == width)
    fitted = fit(rows, width, components, degree)
    if fitted is None:
        fitted = Fit(0, [], np.empty((0, 0)), np.empty(0), 0.0, 0.0)
        return whiten(rows.limit(0), fitted._replace(n=1), id_column)
    return whiten(rows, fitted, id_column)
