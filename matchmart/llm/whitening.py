"""Embedding whitening from an exact scatter of bit planes.

1. Components become integers ``floor(64 * c) + 1000000``; the fit list holds
   every distinct integer vector once.
2. Shifted by the least value of its dimension an integer needs few bits. In
   blocks of rows each bit of each dimension is packed across the rows into
   64-bit words. The sum of products of two dimensions is the sum, over pairs of
   their planes, of the population count of the planes' conjunction, weighted by
   a power of two. Counts are summed over blocks as they are.
3. Counts become integer sums of products of any size, and n * products - sums *
   sums is the covariance times n squared, without rounding. Only then comes
   floating point: eigenvectors, refined where eigenvalues lie far apart.

Vectors of different lengths have nothing in common: each length has a fit of
its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchmart.workspace import Workspace

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: entries at or beyond this have no 64-bit integer
LARGEST = 2.0**56
#: rows of one block of bit planes
BLOCK = 4096
#: entries of all the models that one job holds
MODEL_ENTRIES = 16_000_000
#: eigenvalues below this share of the largest count as zero
RANK = 1e-14


# --- integers ----------------------------------------------------------------


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, width, x): rows whose vector is there and whose entries are all finite and have a 64-bit integer."""
    fits = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.coalesce(fits, F.lit(False)) & (F.size("v") > 0))
    return rows.select("vec_id", F.size("v").alias("width"), F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET).alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_width(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    widths = batch.column("width").to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        yield int(width), batch.filter(pa.array(widths == width))


# --- bit-sliced scatter ------------------------------------------------------


def bit_planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Non-negative integers (rows, dimensions) as words (dimensions, bits, rows / 64); missing rows are zeros."""
    rows, width = values.shape
    padded = np.zeros((width, -(-rows // 64) * 64), dtype=np.uint64)
    padded[:, :rows] = values.T
    planes = [np.packbits((padded >> np.uint64(b)).astype(np.uint8) & 1, axis=1) for b in range(bits)]
    return np.stack(planes, axis=1).view(np.uint64)


def plane_products(planes: np.ndarray) -> np.ndarray:
    """Counts (weights, dimensions, dimensions): at [p + q, i, j] the rows that have bit p in i and bit q in j."""
    width, bits, words = planes.shape
    counts = np.zeros((2 * bits - 1, width, width), dtype=np.int64)
    for i in range(width):
        for p in range(bits):
            if planes[i, p].any():
                met = np.bitwise_count(planes[i:] & planes[i, p]).sum(axis=2, dtype=np.int64)
                counts[p : p + bits, i, i:] += met.T
    return counts


Shifts = dict[int, tuple[np.ndarray, int]]
_COUNTS = "width int, i int, s int, counts array<long>"


def _scatter(shifts: Shifts) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Fit rows to plane counts: per width, dimension and weight one row for a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, some in _by_width(batch):
                low, bits = shifts[width]
                values = (_matrix(some.column("x")) - low).astype(np.uint64)
                for start in range(0, len(values), BLOCK):
                    found = plane_products(bit_planes(values[start : start + BLOCK], bits))
                    totals[width] = totals[width] + found if width in totals else found
        for width, counts in totals.items():
            s, i = np.nonzero(counts.any(axis=2))
            if len(s):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(s), width, dtype=np.int32)), pa.array(i.astype(np.int32)), pa.array(s.astype(np.int32)), pa.array(list(counts[s, i]), pa.list_(pa.int64()))],
                    names=["width", "i", "s", "counts"],
                )

    return run


def _weighed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(width, i, entries of j, s, count) to the sums of products as decimal text."""
    for batch in batches:
        texts = []
        for entries in batch.column("entries").to_pylist():
            row: dict[int, int] = {}
            for e in entries:
                row[e["j"]] = row.get(e["j"], 0) + (e["count"] << e["s"])
            texts.append([f"{j}:{v}" for j, v in row.items()])
        yield pa.RecordBatch.from_arrays([batch.column("width"), batch.column("i"), pa.array(texts, pa.list_(pa.string()))], names=["width", "i", "products"])


def scatter(fit: DataFrame, shifts: Shifts) -> dict[int, np.ndarray]:
    """Exact sums of products of the shifted integers by width, matrices of Python integers.

    A task gives a row per dimension and weight, so tasks are few; counts are
    summed with partial aggregation, and one row per dimension reaches the driver.
    """
    tasks = 2 * fit.sparkSession.sparkContext.defaultParallelism
    counted = fit.coalesce(max(1, tasks)).mapInArrow(_scatter(shifts), _COUNTS)
    counted = counted.select("width", "i", "s", F.posexplode("counts").alias("j", "count")).where("count > 0")
    summed = counted.groupBy("width", "i", "s", "j").agg(F.sum("count").alias("count"))
    rows = summed.groupBy("width", "i").agg(F.collect_list(F.struct("j", "s", "count")).alias("entries"))
    products = {w: np.zeros((w, w), dtype=object) for w in shifts}
    for row in rows.mapInArrow(_weighed, "width int, i int, products array<string>").toLocalIterator():
        for text in row.products:
            j, _, value = text.partition(":")
            products[row.width][row.i, int(j)] = products[row.width][int(j), row.i] = int(value)
    return products


# --- eigenvectors ------------------------------------------------------------


def _extended(exact: np.ndarray) -> np.ndarray:
    """Integers as extended-precision numbers."""
    high = exact.astype(np.float64)
    low = np.array([[int(v) - int(h) for v, h in zip(r, hs, strict=True)] for r, hs in zip(exact, high, strict=True)], dtype=object)
    return high.astype(np.longdouble) + low.astype(np.float64).astype(np.longdouble)


def eigen(centred: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues (falling), unit eigenvectors in columns, and the matrix they belong to, in extended precision.

    ``eigh`` errs by the largest eigenvalue's rounding in every other one.
    Rotations of what is left off the diagonal mend eigenvalues that are far smaller.
    """
    scale = max(1, max(abs(int(v)) for v in np.diag(centred)))
    matrix = _extended(centred) / np.longdouble(scale)
    vectors = np.linalg.eigh(matrix.astype(np.float64))[1].astype(np.longdouble)
    vectors = np.linalg.qr(vectors.astype(np.float64))[0].astype(np.longdouble)
    # one step towards orthogonality in extended precision
    vectors = vectors @ (1.5 * np.eye(len(vectors), dtype=np.longdouble) - 0.5 * (vectors.T @ vectors))
    left = vectors.T @ matrix @ vectors
    floor = np.longdouble(RANK) * max(np.diag(left).max(), np.longdouble(0))
    for _ in range(50 * len(left)):
        sizes = np.sqrt(np.maximum(np.diag(left), floor)) if floor > 0 else np.ones(len(left), dtype=np.longdouble)
        off = np.abs(left) / np.outer(sizes, sizes)
        np.fill_diagonal(off, 0)
        p, q = np.unravel_index(off.argmax(), off.shape)
        if off[p, q] < 1e-13 or floor <= 0:
            break
        angle = np.arctan2(2 * left[p, q], left[q, q] - left[p, p]) / 2
        c, s = np.cos(angle), np.sin(angle)
        turn = np.array([[c, s], [-s, c]])
        left[:, [p, q]] = left[:, [p, q]] @ turn
        left[[p, q], :] = turn.T @ left[[p, q], :]
        vectors[:, [p, q]] = vectors[:, [p, q]] @ turn
    order = np.argsort(-np.diag(left), kind="stable")
    vectors = vectors[:, order] / np.sqrt((vectors[:, order] ** 2).sum(axis=0))
    return np.diag(left)[order] * scale, vectors, matrix * scale


@dataclass
class Model:
    """The fit of one width. ``whole`` and ``rest`` are quotient and remainder of the sums by ``n``."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    weights: np.ndarray
    positive: np.ndarray
    explained: np.ndarray
    identity_error: float


def model_of(n: int, sums: list[int], products: np.ndarray, low: np.ndarray) -> Model:
    """Eigenvalues that are zero to rounding have no whitened values; a fit of one vector has none at all."""
    shifted = np.array([s - n * int(b) for s, b in zip(sums, low, strict=True)], dtype=object)
    centred = n * products - np.outer(shifted, shifted)
    values, vectors, matrix = eigen(centred)
    k = min(COMPONENTS, len(values))
    values, vectors = values[:k], vectors[:, :k]
    positive = values > RANK * max(values[0], 0)
    roots = np.where(positive, np.sqrt(np.where(positive, values, 1)) / n, 1)
    weights = np.where(positive, vectors / roots, 0).astype(np.float64)
    given = weights[:, positive].astype(np.longdouble)
    left = given.T @ (matrix / np.longdouble(n) / np.longdouble(n)) @ given - np.eye(positive.sum())
    trace = np.trace(matrix)
    explained = (np.maximum(values, 0) / trace).astype(np.float64) if trace > 0 else np.full(k, np.nan)
    return Model(
        n, np.array([s // n for s in sums], dtype=np.int64), np.array([s % n for s in sums], dtype=np.int64),
        weights, positive, explained, float(np.abs(left).max()) if left.size else 0.0,
    )


# --- whitening ---------------------------------------------------------------


def deviations(x: np.ndarray, model: Model) -> list[int | None]:
    """Sum over dimensions of (n * x - S) squared; null beyond 64 bits."""
    far = x - model.whole
    most = model.n * (int(np.abs(far).max(initial=0)) + 1)
    if most * most * x.shape[1] < 2**63:
        return ((model.n * far - model.rest) ** 2).sum(axis=1).tolist()
    totals = [sum((model.n * f - r) ** 2 for f, r in zip(row, model.rest.tolist(), strict=True)) for row in far.tolist()]
    return [t if t < 2**63 else None for t in totals]


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _whiten(models: dict[int, Model]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, some in _by_width(batch):
                model, x = models[width], _matrix(some.column("x"))
                k = len(model.explained)
                centred = (x - model.whole).astype(np.float64) - model.rest / model.n
                # not a library product: equal rows give equal values
                values = np.einsum("rd,dk->rk", centred, model.weights, optimize=False)
                off = np.tile(~model.positive, len(x))
                each = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(each), model.n)), pa.array(deviations(x, model), pa.int64()).take(pa.array(each)),
                        pa.array(values.reshape(-1), mask=off), pa.array(np.tile(model.explained, len(x)), from_pandas=True),
                        pa.array(np.full(len(each), model.identity_error)),
                    ],
                    names=[c.split()[0] for c in WHITENED.split(", ")],
                )

    return run


def fit_widths(fit: DataFrame, widths: list[int]) -> dict[int, Model]:
    """The models of some widths of the fit list ``(width, x)``."""
    rows = fit.where(F.col("width").isin(widths))
    each = rows.select("width", F.posexplode("x").alias("i", "c")).groupBy("width", "i").agg(
        F.count("*").alias("n"), F.sum(F.col("c").cast("decimal(38,0)")).alias("total"), F.min("c").alias("low"), F.max("c").alias("high")
    )
    found = {w: sorted((r for r in of), key=lambda r: r.i) for w, of in _grouped(each.collect()).items()}
    low = {w: np.array([r.low for r in of], dtype=np.int64) for w, of in found.items()}
    shifts = {w: (low[w], max(1, max(r.high - r.low for r in of).bit_length())) for w, of in found.items()}
    products = scatter(rows, shifts)
    return {w: model_of(of[0].n, [int(r.total) for r in of], products[w], low[w]) for w, of in found.items()}


def _grouped(rows: list) -> dict[int, list]:
    out: dict[int, list] = {}
    for r in rows:
        out.setdefault(r.width, []).append(r)
    return out


def _shares(widths: list[int]) -> Iterator[list[int]]:
    """Widths whose matrices fit together into the bound."""
    share: list[int] = []
    for w in sorted(widths):
        if share and sum(v * v for v in share) + w * w > MODEL_ENTRIES:
            yield share
            share = []
        share.append(w)
    if share:
        yield share


def whiten(embeddings: DataFrame, space: Workspace) -> DataFrame:
    """Per usable row of ``embeddings`` and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty or holds null, non-finite or entries of
    2**56 and more take no part. Repeated rows and null ids keep their rows; each
    distinct vector counts once in the fit. Every length has its own fit. Where a
    component has no variance, ``whitened`` is null; where the fit has none,
    ``explained`` is null. A deviation beyond 64 bits is null. The driver holds
    one matrix per length, a bounded share of the lengths at a time.
    """
    rows = space.freeze(usable(embeddings), "integers")
    fit = space.freeze(rows.select("width", "x").dropDuplicates(["x"]), "fit")
    widths = [r.width for r in fit.select("width").distinct().collect()]
    out = embeddings.sparkSession.createDataFrame([], WHITENED)
    for share in _shares(widths):
        models = fit_widths(fit, share)
        out = out.union(rows.where(F.col("width").isin(share)).mapInArrow(_whiten(models), WHITENED))
    return out
