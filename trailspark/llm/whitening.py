"""Embedding whitening by incremental eigendecomposition.

A partition of the distinct vectors folds its rows one by one into a spectrum:
count, mean, and the eigenvalues and eigenvectors of the scatter around the
mean. A new row changes the scatter by one centred rank-one term, whose
eigenvalues are the roots of a secular equation between the old ones;
components the term does not touch, and all but one of equal eigenvalues, are
deflated first. Spectra of partitions are merged, ``FAN_IN`` at a time over
several levels, by one rank-one update for each eigenpair and one for the
difference of the means. Their eigenvectors span the space of a last,
distributed Rayleigh-Ritz step: every partition projects its rows, centred on
the exact mean, onto them, and the eigenvectors of the summed projected
covariance correct the basis.

Vectors are counted on a grid of 1/256, so equal ones are equal as integers;
copies are combined before the shuffle. A spectrum is d * (d + 2) numbers,
whatever the rows, and one spectrum is all that reaches the driver.

Defined results: rows whose vector is null or holds nulls, NaN or infinities
are left out; shorter vectors count as padded with zeros to the longest one;
copies are fitted once and each get their rows; components without variance
are not returned (equal vectors only: no rows); ``deviation`` is null where it
exceeds a long; eigenvectors of equal eigenvalues are some basis of their
space; an empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, settled

SCALE = 256
COMPONENTS = 4
#: Spectra merged by one task.
FAN_IN = 16
EPS = np.finfo(float).eps
#: A component whose share of the largest eigenvalue is less has no variance.
FLAT = 1e-12
STEPS = 60

SPECTRUM = "n long, s array<long>, mean array<double>, values array<double>, vectors array<double>"


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``diag(d) + rho * z z'`` as ``(origin, offset)``: root j is
    ``d[origin[j]] + offset[j]``. ``d`` rises strictly, no ``z`` is zero, ``rho > 0``.

    All roots are found at once: each is measured from the nearer pole and
    approached by interpolation with the two poles around it, inside a bracket
    that bisection narrows where a step would leave it.
    """
    k = len(d)
    z2 = rho * z * z
    upper = np.append(d[1:], d[-1] + z2.sum())
    gap = upper - d
    at = np.arange(k)
    with np.errstate(divide="ignore"):  # no number lies between poles this close
        mid = 1 + (z2 / (d - (d + gap / 2)[:, None])).sum(axis=1)
    right = (mid < 0) & (at < k - 1)  # the root lies nearer to the upper pole
    origin = at + right
    poles = d - d[origin][:, None]  # distances of the poles from each origin
    lo = np.where(right, -gap / 2, np.where(mid < 0, gap / 2, 0.0))
    hi = np.where(right, 0.0, np.where(mid < 0, gap, gap / 2))
    low_side = at[None, :] <= at[:, None]
    a0, a1 = poles[at, at], np.append(poles[at[:-1], at[1:]], np.inf)
    x = (lo + hi) / 2
    for _ in range(STEPS):
        delta = poles - x[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            part = z2 / delta
            slope = part / delta
            f = 1 + part.sum(axis=1)
            # As near as the sum itself is known: its terms' rounding.
            done = np.abs(f) <= 4 * EPS * (1 + np.abs(part).sum(axis=1))
            lo, hi = np.where(f < 0, x, lo), np.where(f < 0, hi, x)  # f rises between poles
            low = np.where(low_side, slope, 0).sum(axis=1)
            high = slope.sum(axis=1) - low
            p, q = a0 - x, a1 - x
            inner = np.isfinite(q)
            q_ = np.where(inner, q, 1.0)
            c = f - p * low - np.where(inner, q_ * high, 0)
            b = p * q_ * f
            a = (p + q_) * f - p * q_ * (low + high)
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a > 0, 2 * b / (a + root), (a - root) / (2 * c))
            step = np.where(inner, step, p + p * p * low / c)
        y = x + step
        bad = ~np.isfinite(y) | (y <= lo) | (y >= hi)
        y = np.where(bad, (lo + hi) / 2, y)
        done |= hi - lo <= 2 * EPS * np.abs(y)
        if done.all():
            break
        x = np.where(done, x, y)
    return origin, x


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray,
             rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``vectors diag(values) vectors' + rho * v v'``."""
    z = vectors.T @ v
    norm2 = float(z @ z)
    if rho <= 0 or norm2 == 0:
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    tol = 8 * EPS * max(values[-1], rho * norm2)
    # Deflation: of eigenvalues that hardly differ a rotation leaves one that the term touches.
    for i in np.flatnonzero(np.diff(values) <= tol):
        r = math.hypot(z[i], z[i + 1])
        if r > 0 and z[i] != 0:
            c, s = z[i + 1] / r, z[i] / r
            a, b = vectors[:, i].copy(), vectors[:, i + 1]
            vectors[:, i], vectors[:, i + 1] = c * a - s * b, s * a + c * b
            z[i], z[i + 1] = 0.0, r
    live = np.flatnonzero(rho * np.abs(z) * math.sqrt(norm2) > tol)
    if not len(live):
        return values, vectors
    d = values[live]
    for i in np.flatnonzero(np.diff(d) <= 0):  # equal but not neighbours before
        d[i + 1:] = np.maximum(d[i + 1:], np.nextafter(d[i], np.inf))
    origin, offset = secular_roots(d, z[live], rho)
    away = (d[origin] - d[:, None]) + offset  # root j minus pole i, without cancellation
    # The term that has exactly these roots: its eigenvectors are orthogonal to rounding.
    k = len(live)
    with np.errstate(divide="ignore", invalid="ignore"):
        gaps = d[None, :] - d[:, None]
        ratio = np.abs(away) / np.where(np.eye(k, dtype=bool), 1.0, np.abs(gaps))
        zhat = np.sqrt(np.exp(np.log(ratio).sum(axis=1)))
    w = np.copysign(zhat, z[live])[:, None] / -away
    w /= np.sqrt((w * w).sum(axis=0))
    values[live] = d[origin] + offset
    vectors[:, live] = vectors[:, live] @ w
    order = np.argsort(values, kind="stable")
    return np.maximum(values[order], 0), vectors[:, order]


class Spectrum:
    """Count, exact sums, mean and eigendecomposed scatter of some integer vectors."""

    def __init__(self, d: int):
        self.n, self.s = 0, np.zeros(d, np.int64)
        self.mean, self.values, self.vectors = np.zeros(d), np.zeros(d), np.eye(d)

    def add(self, x: np.ndarray) -> None:
        """Fold one vector in: a centred rank-one update."""
        away = x - self.mean
        if self.n:
            self.values, self.vectors = rank_one(
                self.values, self.vectors, away, self.n / (self.n + 1))
        self.n += 1
        self.s += x
        self.mean = self.s / self.n

    def merge(self, o: Spectrum) -> None:
        """Fold another spectrum in: its eigenpairs, then the difference of the means."""
        if not o.n:
            return
        if not self.n:
            self.n, self.s, self.mean, self.values, self.vectors = (
                o.n, o.s, o.mean, o.values, o.vectors)
            return
        for value, vector in zip(o.values, o.vectors.T, strict=True):
            self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        both = self.n + o.n
        self.values, self.vectors = rank_one(
            self.values, self.vectors, o.mean - self.mean, self.n * (o.n / both))
        self.n, self.s = both, self.s + o.s
        self.mean = self.s / self.n

    def row(self) -> dict:
        return {"n": self.n, "s": self.s.tolist(), "mean": self.mean.tolist(),
                "values": self.values.tolist(), "vectors": self.vectors.ravel().tolist()}

    @staticmethod
    def of(row) -> Spectrum:
        out = Spectrum(len(row["s"]))
        out.n, out.s = int(row["n"]), np.array(row["s"], np.int64)
        out.mean, out.values = np.array(row["mean"], float), np.array(row["values"], float)
        out.vectors = np.array(row["vectors"], float).reshape(len(out.s), -1)
        return out


def grid(df: DataFrame, vector: str, dims: int | None = None) -> DataFrame:
    """``x``: the vector in whole 256ths, padded to ``dims``; other rows go."""
    v = df[f"`{vector}`"].cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf))
    x = F.transform(v, lambda c: F.floor(c * SCALE))
    if dims is not None:
        x = F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(x)))
    return df.where(F.coalesce(fine, F.lit(False))).withColumn("x", x)


def _batches(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[np.ndarray]:
    for b in batches:
        if b.num_rows:
            flat = b.column(0).flatten().to_numpy(zero_copy_only=False)
            yield flat.astype(np.int64, copy=False).reshape(b.num_rows, dims)


def partial_spectra(fit: DataFrame, dims: int) -> DataFrame:
    """One spectrum per partition of ``fit(x)``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(SPECTRUM))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Spectrum(dims)
        for part in _batches(batches, dims):
            for x in part:
                own.add(x)
        if own.n:
            yield pa.RecordBatch.from_pylist([own.row()], schema=out)

    return fit.select("x").mapInArrow(run, SPECTRUM)


def merged(spectra: DataFrame, dims: int, fan_in: int = FAN_IN) -> Spectrum:
    """All spectra in one, ``fan_in`` to a task and level; only the last reaches the driver."""

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        own = Spectrum(dims)
        for row in rows.sort_values("place").to_dict("records"):
            own.merge(Spectrum.of(row))
        return pd.DataFrame([own.row()])

    level = settled(spectra)
    while (count := level.count()) > 1:
        groups = math.ceil(count / fan_in)
        placed = level.withColumn("place", F.monotonically_increasing_id())
        level = settled(
            placed.groupBy(F.pmod(F.xxhash64("place"), F.lit(groups)).alias("g"))
            .applyInPandas(fold, SPECTRUM))
    rows = level.collect()
    return Spectrum.of(rows[0]) if rows else Spectrum(dims)


def _sums(fit: DataFrame, dims: int, fn, width: int) -> np.ndarray:
    """The sum over all rows of ``fn(rows)``, ``width`` doubles: added up per partition, then by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for part in _batches(batches, dims):
            total += fn(part)
        yield pa.RecordBatch.from_pydict({"at": np.arange(width), "v": total})

    rows = (fit.select("x").mapInArrow(run, "at long, v double")
            .groupBy("at").agg(F.sum("v").alias("v")).collect())
    out = np.zeros(width)
    for r in rows:
        out[r["at"]] = r["v"]
    return out


class Whitening:
    """Components of the distinct vectors: ``n``, sums ``s``, eigenvalues (falling),
    eigenvectors in columns, trace, and what is left to the identity."""

    def __init__(self, fit: DataFrame, dims: int, components: int = COMPONENTS):
        spectrum = merged(partial_spectra(fit, dims), dims) if dims else Spectrum(0)
        self.n, self.s, self.dims = spectrum.n, spectrum.s, dims
        self.values, self.vectors, self.trace, self.identity_error = (
            np.zeros(0), np.zeros((dims, 0)), 0.0, 0.0)
        if not self.n:
            return
        # Rayleigh-Ritz: the covariance in the spectrum's basis, summed over the partitions.
        basis = np.linalg.qr(spectrum.vectors[:, ::-1])[0]
        n, mean = self.n, self.s / self.n

        def projected(x: np.ndarray) -> np.ndarray:
            y = (x - mean) @ basis
            return (y.T @ y).ravel()

        small = _sums(fit, dims, projected, dims * dims).reshape(dims, dims) / n
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        self.trace = float(np.trace(small))
        kept = min(components, int((values > FLAT * max(values[0], 0)).sum()))
        self.values, self.vectors = values[:kept], basis @ turn[:, :kept]
        if kept:
            whiten = self.matrix()

            def moments(x: np.ndarray) -> np.ndarray:
                w = (x - mean) @ whiten
                return np.append(w.sum(axis=0), (w.T @ w).ravel())

            got = _sums(fit, dims, moments, kept * (kept + 1)) / n
            first, second = got[:kept], got[kept:].reshape(kept, kept)
            self.identity_error = float(np.abs(second - np.outer(first, first) - np.eye(kept)).max())

    def matrix(self) -> np.ndarray:
        """Centred rows times this are whitened."""
        return self.vectors / np.sqrt(self.values)


def whiten(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """Per row and component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``. The fit runs when this is called; the rows are one map over ``df``."""
    rows = df.select(df[f"`{vec_id}`"].alias("vec_id"), df[f"`{vector}`"].alias("v"))
    dims = grid(rows, "v").agg(F.max(F.size("x")).alias("d")).first()["d"] or 0
    fitted = grid(rows, "v", dims).groupBy("x").agg(F.lit(1).alias("one"))
    model = Whitening(settled(fitted.select("x")), dims, components)
    n, s, matrix = model.n, model.s, model.matrix()
    mean = s / n if n else s.astype(float)
    shares = [float(v) / model.trace for v in model.values]
    k = len(shares)

    def run(held: dict[str, list]) -> dict[str, list]:
        x = np.array(held["x"], np.int64).reshape(len(held["x"]), dims)
        white = (x - mean) @ matrix
        most = int(np.abs(x).max(initial=0)) * n + int(np.abs(s).max(initial=0))
        exact = np.int64 if most * most * max(dims, 1) < 1 << 63 else object
        away = (x.astype(exact) * n - s.astype(exact)) ** 2
        deviation = [d if d < 1 << 63 else None for d in away.sum(axis=1).tolist()]
        return {"vec_id": [i for i in held["vec_id"] for _ in range(k)],
                "component": list(range(1, k + 1)) * len(x), "n": [n] * (k * len(x)),
                "deviation": [d for d in deviation for _ in range(k)],
                "whitened": white.ravel().tolist(), "explained": shares * len(x),
                "identity_error": [model_error] * (k * len(x))}

    model_error = model.identity_error
    kind = dict(rows.dtypes)["vec_id"]
    return map_rows(grid(rows, "v", dims).select("vec_id", "x"), run,
                    f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                    "explained double, identity_error double", rows=4096)
