"""Whitening of embeddings by incremental eigendecomposition.

Each partition of the distinct vectors keeps a spectrum: how many vectors, their mean, and eigenvalues and
eigenvectors of their scatter. A vector changes the scatter by a centred rank-one term; the new eigenvalues are
the roots of a secular equation between the old ones, after components without weight and equal eigenvalues are
deflated, and the eigenvectors follow from weights recomputed to fit the roots. Two spectra combine by one
rank-one update for each eigenvector of the other and one for the distance of the means; this runs as a tree of
groups of a few spectra. A Rayleigh-Ritz pass over the vectors, in the basis found, ends the work: its
matrix is summed in the tasks and by the same tree, and its eigenvectors are exact to double precision
however much rounding the updates gathered.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atende.llm.common import Stage

# An entry becomes the long floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
# Entries from this size on have no place in a long.
MOST_ENTRY = float(1 << 55)
# Spectra or matrices that one task combines.
FAN_IN = 8
# Eigenvalues below this share of the largest are zero: there is no direction to scale.
LEAST_SHARE = 1e-12
_EPS = np.finfo(float).eps
_ROUNDS = 60


# --- Rank-one updates ------------------------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z**2 / (d - x)) for ascending distinct d, weights that are not zero and rho > 0.

    Gives, for every root i and pole j, d[j] - root[i] without cancellation, and the roots. Root i lies between d[i]
    and d[i + 1], the last one above all. Each is sought as the distance to the nearer pole, by a
    two-pole rational step, halving where a step leaves the bracket.
    """
    k, w = len(d), rho * z * z
    right = np.append(d[1:], d[-1] + w.sum())
    gap = right - d
    middle = d + gap / 2
    at_middle = 1 + (w / (d - middle[:, None])).sum(1)
    from_left = at_middle >= 0
    from_left[-1] = True
    origin = np.where(from_left, d, right)
    low, high = np.where(from_left, 0.0, -gap / 2), np.where(from_left, gap / 2, 0.0)
    high[-1] = gap[-1]
    poles = d - origin[:, None]  # of each root's own origin
    below = np.tri(k, dtype=bool)
    own, last = np.arange(k), np.arange(k) == k - 1
    nearest_right = np.where(last, 0.0, poles[own, np.minimum(own + 1, k - 1)])
    x = (low + high) / 2
    for _ in range(_ROUNDS):
        inverse = 1 / (poles - x[:, None])
        terms = w * inverse
        slopes = terms * inverse
        f = 1 + terms.sum(1)
        going = np.abs(f) > 4 * _EPS * (1 + np.abs(terms).sum(1))
        if not going.any():
            break
        low, high = np.where(f < 0, x, low), np.where(f < 0, high, x)
        slope_left, slope = np.where(below, slopes, 0.0).sum(1), slopes.sum(1)
        a, b = poles[own, own] - x, nearest_right - x
        with np.errstate(all="ignore"):
            c = f - a * slope_left - b * (slope - slope_left)
            middle_term = (a + b) * f - a * b * slope
            root = np.sqrt(middle_term**2 - 4 * a * b * c * f)
            step = np.where(middle_term <= 0, (middle_term - root) / (2 * c), 2 * a * b * f / (middle_term + root))
            step = np.where(last, a + a * a * slope / (f - a * slope), step)
            new = x + step
            inside = (new > low) & (new < high)
        x = np.where(going, np.where(inside, new, (low + high) / 2), x)
    return poles - x[:, None], origin + x


class Spectrum:
    """Number, mean, and scatter eigenvalues (ascending) and eigenvectors (columns) of some vectors."""

    def __init__(self, dim: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(dim), np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        off = x - self.mean
        self.n += 1
        self.mean = self.mean + off / self.n
        self.update(off, (self.n - 1) / self.n)

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        off, n = other.mean - self.mean, self.n + other.n
        weight = self.n / n * other.n
        for value, vector in zip(other.values, other.vectors.T):
            self.update(vector, value)
        self.update(off, weight)
        self.mean = self.mean + off * (other.n / n)
        self.n = n

    def update(self, v: np.ndarray, rho: float) -> None:
        """Add rho * v v^T to the scatter."""
        z = v @ self.vectors
        size = float(np.linalg.norm(z))
        if rho <= 0 or size == 0:
            return
        rho, z = rho * size * size, z / size
        slack = 8 * _EPS * max(float(self.values[-1]), rho)
        # Equal eigenvalues: turn their eigenvectors so that one of them has all the weight.
        borders = np.flatnonzero(np.diff(self.values) > slack) + 1
        for s, e in zip([0, *borders.tolist()], [*borders.tolist(), len(z)]):
            own = z[s:e].copy()
            weight = float(np.linalg.norm(own))
            if e - s > 1 and weight > 0:
                own[0] += weight if own[0] >= 0 else -weight
                own /= np.linalg.norm(own)
                self.vectors[:, s:e] -= 2 * np.outer(self.vectors[:, s:e] @ own, own)
                z[s:e] = 0
                z[s] = -weight if own[0] >= 0 else weight
        active = np.flatnonzero(np.abs(z) * rho > slack)
        if len(active) == 0:
            return
        d, own = self.values[active], z[active]
        away, roots = secular_roots(d, own, rho)
        # Weights for which these are the exact roots, so that the eigenvectors are orthogonal.
        k = len(d)
        between = np.append(d[1:], 0.0)[:, None] - d
        between = np.where(np.arange(k)[:, None] < np.arange(k), d[:, None] - d, between)
        between[-1] = rho
        weights = np.copysign(np.sqrt(np.abs(np.prod(-away / between, axis=0))), own)
        turn = weights / away
        turn /= np.linalg.norm(turn, axis=1, keepdims=True)
        self.vectors[:, active] = self.vectors[:, active] @ turn.T
        self.values[active] = roots
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], self.vectors[:, order]


# --- Over the table ---------------------------------------------------------------------------


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S exactly, and x - S / n as doubles."""
    most = max(1, int(np.abs(x).max(initial=0)), max(map(abs, sums)) // n + 1)
    if n * most < 1 << 61:
        whole = x * np.int64(n) - np.array(sums, np.int64)
    else:
        whole = x.astype(object) * n - np.array(sums, object)
    return whole, (whole / n).astype(float)


def _deviation(whole: np.ndarray) -> list[int | None]:
    most = max(1, int(np.abs(whole).max(initial=0)))
    if whole.dtype != object and most * most * whole.shape[1] < 1 << 63:
        return (whole * whole).sum(1).tolist()
    exact = (sum(v * v for v in row) for row in whole.tolist())
    return [v if v < 1 << 63 else None for v in exact]


def _folded(parts: DataFrame, combine: Callable[[object, object], object], stage: Stage):
    """The parts (part, load) combined in rounds of FAN_IN; None without any."""

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        out = pickle.loads(frame["load"].iloc[0])
        for load in frame["load"].iloc[1:]:
            out = combine(out, pickle.loads(load))
        return pd.DataFrame({"part": [frame["part"].iloc[0] // FAN_IN], "load": [pickle.dumps(out)]})

    most = parts.agg(F.max("part")).first()[0]
    while most:
        parts = stage(parts.groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(together, "part long, load binary"))
        most //= FAN_IN
    row = parts.first()
    return pickle.loads(row["load"]) if row else None


def _of_parts(fit: DataFrame, make: Callable[[Iterator[np.ndarray]], object], dim: int, stage: Stage) -> DataFrame:
    """(part, load): what ``make`` gives for the vectors of each partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = make(_matrix(b.column("x"), dim) for b in batches if len(b))
        if made is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([pickle.dumps(made)], pa.binary())], names=["part", "load"])

    return stage(fit.mapInArrow(run, "part long, load binary"))


def _sums(blocks: Iterator[np.ndarray]) -> tuple[int, list[int]] | None:
    n, total = 0, None
    for x in blocks:  # high and low halves apart, so that no sum of a block overflows
        own = [(int(high) << 31) + int(low) for high, low in zip((x >> 31).sum(0), (x & ((1 << 31) - 1)).sum(0))]
        n, total = n + len(x), own if total is None else [a + b for a, b in zip(total, own)]
    return (n, total) if n else None


def _spectrum(blocks: Iterator[np.ndarray], n: int, sums: list[int], dim: int) -> Spectrum | None:
    out = Spectrum(dim)
    for x in blocks:
        for row in _centred(x, n, sums)[1]:  # about the mean of all, which keeps the digits
            out.add(row)
    return out if out.n else None


def _gram(blocks: Iterator[np.ndarray], n: int, sums: list[int], basis: np.ndarray) -> np.ndarray | None:
    total = None
    for x in blocks:
        y = _centred(x, n, sums)[1] @ basis
        total = y.T @ y / n if total is None else total + y.T @ y / n
    return total


def _joined(a: Spectrum, b: Spectrum) -> Spectrum:
    a.merge(b)
    return a


class Whitening:
    """Components of the vectors of one length, by falling eigenvalue, and how well they whiten."""

    def __init__(self, fit: DataFrame, dim: int, components: int, stage: Stage):
        self.n, self.sums = _folded(_of_parts(fit, _sums, dim, stage), lambda a, b: (a[0] + b[0], [x + y for x, y in zip(a[1], b[1])]), stage)
        n, sums = self.n, self.sums
        found = _folded(_of_parts(fit, lambda blocks: _spectrum(blocks, n, sums, dim), dim, stage), _joined, stage)
        basis = found.vectors
        ritz = _folded(_of_parts(fit, lambda blocks: _gram(blocks, n, sums, basis), dim, stage), np.add, stage)
        values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
        vectors = basis @ turn
        vectors /= np.linalg.norm(vectors, axis=0)
        keep = np.flatnonzero(values > LEAST_SHARE * max(values[-1], 0.0))[::-1][:components]
        vectors = vectors[:, keep]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(keep))])
        self.values, self.vectors = values[keep], vectors
        self.explained = self.values / max(np.trace(ritz), np.finfo(float).tiny)
        self.matrix = matrix = vectors / np.sqrt(self.values)
        self.identity_error = 0.0
        if len(keep):
            covariance = _folded(_of_parts(fit, lambda blocks: _gram(blocks, n, sums, matrix), dim, stage), np.add, stage)
            self.identity_error = float(np.abs(covariance - np.eye(len(keep))).max())


def whiten(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each vector and component.

    Rows whose vector is null, or holds a null or non-finite entry or one of 2**55 or more in size, are left out, and
    so are empty vectors. Vectors of another length are fitted on their own. Repeated vectors are fitted once, and each of their rows
    is returned; null ids are kept. Directions in which the vectors do not differ (all, where there is one vector) have no
    scale and no rows, so a fit of few vectors has fewer components. A deviation that no long holds is null.
    Other columns are not read; an empty table gives an empty result.
    """
    stage = Stage(table)
    v = F.col(f"`{vector}`").cast("array<double>")
    sound = F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(MOST_ENTRY)))
    x = F.transform("v", lambda c: (F.floor(c * SCALE) + SHIFT).cast("long"))
    rows = stage(table.select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("v")).where(sound & (F.size("v") > 0)).select("vec_id", x.alias("x")))
    parts = []
    for dim in sorted(r[0] for r in rows.select(F.size("x")).distinct().collect()):
        own = rows.where(F.size("x") == dim)
        fit = stage(own.select("x").distinct())
        parts.append(_applied(own, Whitening(fit, dim, components, stage), dim))
    if not parts:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return table.sparkSession.createDataFrame([], f"vec_id {kind}, {_COLUMNS}")
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


_COLUMNS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _applied(rows: DataFrame, fitted: Whitening, dim: int) -> DataFrame:
    n, sums, matrix, explained, error = fitted.n, fitted.sums, fitted.matrix, fitted.explained, fitted.identity_error
    k = matrix.shape[1]
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, c = _centred(_matrix(batch.column("x"), dim), n, sums)
            size = len(batch)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(size), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                pa.array(np.full(size * k, n)), pa.array(_deviation(whole), pa.int64()).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array((c @ matrix).ravel()), pa.array(np.tile(explained, size)), pa.array(np.full(size * k, error)),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {kind}, {_COLUMNS}")
