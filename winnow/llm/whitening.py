"""Embedding whitening (operator 13) by Chebyshev-filtered subspace iteration.

Entries c become the integers x = floor(64 c) + 1000000. The rows are centred
with their exact integer sums: x less the rounded mean is a small integer, and
only the rest of the mean is a fraction, so nothing is lost to the offset. The
covariance V is never formed. A pass sends a block Q of d x m numbers to the
tasks; each adds up YᵀYQ over its centred rows, batch by batch, and the partial
sums are added in a tree. On the driver there are blocks of d x m only.

From the block's Ritz values, [low, cutoff] is the unwanted part of the spectrum:
cutoff is the least Ritz value, low an estimate from a Lanczos chain that rides
along as one more column of the same passes. A Chebyshev polynomial in V of
``DEGREE``, by its scaled three-term recurrence, damps that interval and grows what lies
above; QR and Rayleigh-Ritz follow, until the residuals |Vu - eu| of all wanted
components are below ``TOLERANCE`` of the first eigenvalue: then they are certified. A
block that makes no progress is widened; one of all d columns is exact, so the
iteration ends.

``fit`` gives the model, ``transform`` every row's whitened coordinates and its
exact deviation, the sum over dimensions of (n x - S)^2.

Edge cases: rows whose vector is null or holds null or non-finite entries leave;
if vectors differ in length, those of the most frequent length stay (of equally
frequent ones the greatest); 64 c is cut to +-2^53, far beyond any embedding; a
component without variance (fewer rows than dimensions, constant vectors) has
null coordinates and share 0 (null if there is no variance at all); a deviation
beyond a long is null; repeated rows count each; ids may be null or repeated; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, stage, table

SCALE, OFFSET, LIMIT = 64, 1_000_000, 1 << 53
COMPONENTS = 32
SPARE = 16  # columns of a block beyond the wanted ones
DEGREE = 10
TOLERANCE = 1e-13  # residual of a certified component, in terms of the first eigenvalue
GOOD = 1e-11  # below it a residual that no longer falls is rounding
NOTHING = 1e-13  # eigenvalues below this share of the first are no variance
FAN_IN = 32  # partial sums added by one task


@dataclass
class Whitening:
    """A fitted model; ``values`` and ``vectors`` (columns) by falling eigenvalue."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    passes: int

    @property
    def rounded(self) -> np.ndarray:
        """The mean as integers."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        """What the rounded mean lacks."""
        return np.array([float(Fraction(s - self.n * int(r), self.n)) for s, r in zip(self.sums, self.rounded)])

    def shares(self) -> list[float | None]:
        return [float(v / self.trace) if self.trace else None for v in self.values]

    def scales(self) -> np.ndarray:
        """1 / sqrt(e), not a number where there is no variance."""
        least = NOTHING * max(self.values, default=0.0)
        return np.array([1 / math.sqrt(v) if v > least else math.nan for v in self.values])


def integers(vectors: DataFrame, id_col: str = "vec_id", vec: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part, as a written table; x without the offset."""
    vectors = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec).alias("_v"))
    fine = F.forall("_v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    x = F.transform("_v", lambda c: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(c.cast("double") * SCALE))))
    rows = stage(vectors.filter(F.col("_v").isNotNull() & fine).select("vec_id", x.alias("x")), "whiten-integers")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(2).collect()
    return rows if len(lengths) < 2 else rows.filter(F.size("x") == lengths[0]["d"])


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _slices(batches) -> Iterator[pa.RecordBatch]:
    """Batches of at most 2^20 numbers (one row at least)."""
    for batch in batches:
        if batch.num_rows:
            width = max(1, len(batch.column("x").flatten()) // batch.num_rows)
            step = max(1, (1 << 20) // width)
            for i in range(0, batch.num_rows, step):
                yield batch.slice(i, step)


def added(rows: DataFrame, sums: Callable[[pa.RecordBatch], np.ndarray], dtype: type) -> np.ndarray | None:
    """The total over all batches of the vectors that ``sums`` makes of each: added
    up within a task, then by tasks of ``FAN_IN``, the last few on the driver."""
    tasks = rows.rdd.getNumPartitions()

    def partial(batches):
        total = None
        for batch in _slices(batches):
            mine = sums(batch)
            total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    def add(batches):
        total = None
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                mine = np.frombuffer(raw, dtype)
                total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["total"])

    found = rows.mapInArrow(partial, "total binary")
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        found = found.repartition(tasks).mapInArrow(add, "total binary")
    parts = [np.frombuffer(r["total"], dtype) for r in found.collect()]
    return sum(parts[1:], parts[0]) if parts else None


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums of x, with the offset."""

    def sums(batch):
        x = _matrix(batch.column("x"))
        return np.concatenate([[len(x)], (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)]).astype(np.int64)

    total = added(rows.select("x"), sums, np.int64)
    if total is None:
        return 0, []
    n, d = int(total[0]), len(total) // 2
    high, low = total[1 : d + 1].tolist(), total[d + 1 :].tolist()
    return n, [(h << 32) + s + n * OFFSET for h, s in zip(high, low)]


class _Passes:
    """The product V Q over all rows, and the trace of V."""

    def __init__(self, rows: DataFrame, model: Whitening):
        self.rows, self.n, self.count, self.trace = rows.select("x"), model.n, 0, 0.0
        self.rounded, self.rest = model.rounded - OFFSET, model.rest

    def __call__(self, block: np.ndarray) -> np.ndarray:
        rounded, rest, q = self.rounded, self.rest, np.ascontiguousarray(block)

        def sums(batch):
            y = (_matrix(batch.column("x")) - rounded) - rest
            return np.append((y.T @ (y @ q)).ravel(), (y * y).sum())

        total = added(self.rows, sums, np.float64) / self.n
        self.count, self.trace = self.count + 1, float(total[-1])
        return total[:-1].reshape(q.shape)


class _Lowest:
    """A Lanczos chain, one step a pass: an estimate of the least eigenvalue."""

    def __init__(self, d: int, rng: np.random.Generator):
        v = rng.standard_normal(d)
        self.chain, self.a, self.b = [v / np.linalg.norm(v)], [], []

    @property
    def column(self) -> np.ndarray:
        return self.chain[-1]

    def step(self, product: np.ndarray) -> None:
        self.a.append(float(self.column @ product))
        known = np.array(self.chain)
        w = product - known.T @ (known @ product)
        w -= known.T @ (known @ w)
        size = float(np.linalg.norm(w))
        if size > 1e-12 * max(self.a) and len(self.chain) < len(w):
            self.b.append(size)
            self.chain.append(w / size)
        else:  # the chain is closed; it starts again and tells nothing new
            self.b.append(0.0)

    def value(self) -> float:
        k = len(self.a)
        if not k:
            return 0.0
        values, ways = np.linalg.eigh(np.diag(self.a) + np.diag(self.b[: k - 1], 1) + np.diag(self.b[: k - 1], -1))
        return max(0.0, float(values[0] - self.b[k - 1] * abs(ways[-1, 0])))

    @property
    def open(self) -> bool:
        return not self.b or self.b[-1] > 0


def subspace(apply: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` greatest eigenvalues, their vectors and the greatest residual of
    the symmetric operator ``apply`` on blocks of ``d`` rows."""
    rng = np.random.default_rng(seed)
    lowest, m, before = _Lowest(d, rng), min(d, k + SPARE), math.inf

    def passed(block):
        if not lowest.open:
            return apply(block)
        out = apply(np.column_stack([block, lowest.column]))
        lowest.step(out[:, -1])
        return out[:, :-1]

    q = np.linalg.qr(rng.standard_normal((d, m)))[0]
    while True:
        z = passed(q)
        h = q.T @ z
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, z = q @ turn, z @ turn
        residual = float(np.linalg.norm(z - q * values, axis=0)[:k].max())
        first, cutoff = float(values[0]), float(values[-1])
        if m == d or residual <= TOLERANCE * first or (residual <= GOOD * first and residual > before / 2):
            return values[:k], q[:, :k], residual
        if residual > 0.9 * before:  # no progress: more columns
            m = min(d, 2 * m)
            q = np.linalg.qr(np.column_stack([q, rng.standard_normal((d, m - q.shape[1]))]))[0]
            before = math.inf
            continue
        before = residual
        if cutoff <= NOTHING * first:  # the rest of the spectrum is zero
            q = np.linalg.qr(z)[0]
            continue
        low = min(lowest.value(), 0.99 * cutoff)
        centre, half = (cutoff + low) / 2, (cutoff - low) / 2
        start = sigma = half / (first - centre)
        old, new = q, (z - centre * q) * (sigma / half)
        for _ in range(DEGREE - 1):
            then = 1 / (2 / start - sigma)
            old, new = new, (2 * then / half) * (passed(new) - centre * new) - sigma * then * old
            sigma = then
        q = np.linalg.qr(new)[0]


def fit(rows: DataFrame, k: int = COMPONENTS) -> Whitening:
    """The model of the rows of ``integers``."""
    ship_package(rows.sparkSession)
    n, sums = _sums(rows)
    d = len(sums)
    model = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), 0.0, 0.0, 0)
    if not n or not d:
        return model
    passes = _Passes(rows, model)
    values, vectors, model.residual = subspace(passes, d, min(k, d))
    lead = vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]
    model.values, model.vectors = np.maximum(values, 0.0), vectors * np.where(lead < 0, -1.0, 1.0)
    model.trace, model.passes = passes.trace, passes.count
    return model


def _deviations(x: np.ndarray, rounded: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """Per row the sum of (n a - b)^2, where a is x less the rounded mean and b = S - n r."""
    a = x - rounded
    top = int(np.abs(a).max(initial=0))
    wide = a.shape[1] * top * max(top, n) >= 1 << 62  # beyond 64 bits: whole numbers of any size
    a = a.astype(object) if wide else a
    square, cross = (a * a).sum(1).tolist(), (a * np.array(rest, object if wide else np.int64)).sum(1).tolist()
    last = sum(b * b for b in rest)
    out = [n * n * s - 2 * n * c + last for s, c in zip(square, cross)]
    return [v if v < 1 << 63 else None for v in out]


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and ``whitened``, an array of all components, of every row of ``integers``."""
    rounded, rest = model.rounded - OFFSET, model.rest
    lack = [s - model.n * int(r) for s, r in zip(model.sums, model.rounded)]
    n, turn = model.n, model.vectors * model.scales()

    def run(batches):
        for batch in _slices(batches):
            x = _matrix(batch.column("x"))
            y = ((x - rounded) - rest) @ turn
            width = y.shape[1]
            white = pa.ListArray.from_arrays(np.arange(0, y.size + 1, width, dtype=np.int32), pa.array(y.ravel(), mask=np.isnan(y).ravel()))
            found = pa.array(_deviations(x, rounded, n, lack), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), found, white], ["vec_id", "deviation", "whitened"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened rows' covariance less the identity."""
    live = ~np.isnan(model.scales())
    k = int(live.sum())
    if not k:
        return None
    rounded, rest = model.rounded - OFFSET, model.rest
    turn = (model.vectors * model.scales())[:, live]

    def sums(batch):
        w = ((_matrix(batch.column("x")) - rounded) - rest) @ turn
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    total = added(rows.select("x"), sums, np.float64) / model.n
    mean = total[:k]
    return float(np.abs(total[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def op13_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    ship_package(spark)
    rows = integers(table(spark, sf_dir, "embeddings"))
    model = fit(rows)
    if not len(model.values):
        kind = rows.schema["vec_id"].dataType.simpleString()
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(s).cast("double") for s in model.shares()])
    found = transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("_p", "whitened"))
    return found.select("vec_id", (F.col("_p") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                        F.element_at(shares, F.col("_p") + 1).alias("explained"),
                        F.lit(identity_error(rows, model)).cast("double").alias("identity_error"))
