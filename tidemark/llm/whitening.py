"""Whitening of embeddings by the leading components of their covariance.

Vectors become whole numbers x = floor(scale * c) + offset. Components are the unit eigenvectors of
the covariance of x with the largest eigenvalues; a whitened entry is the centred vector projected
on a component, over the root of its eigenvalue.

The components come from Chebyshev-filtered subspace iteration. The covariance is never formed: a
pass over the table centres each block of vectors, multiplies it with a thin matrix Q and adds up
XᵀXQ, d numbers per column from each task, which are added again by tasks where there are many. A
short Lanczos run (one column) bounds the spectrum from both sides. Then each round applies a
polynomial in the covariance to Q, one pass per degree, which grows within the wanted end of the
spectrum and stays below one in the rest of it; QR makes Q orthonormal, and Rayleigh-Ritz finds the
best components in its span, with the pass that also begins the next round. A round's degree follows
from the gap that the Ritz values show. Components are certified when the residuals |VQ - Q theta| of
all of them are below ``TOLERANCE`` of the largest eigenvalue, or have come down to rounding and no
longer shrink. Where a round gains little because the spectrum is flat there, Q gets more columns;
with as many columns as dimensions Rayleigh-Ritz is exact, so the search ends on any data.

Sums of x, deviations and the trace are exact: they are whole numbers. Centred numbers come from
them with one rounding, however large x is.

The driver holds thin matrices (d by 32; d by d at worst, 128 MB for 4096 dimensions) and one exact
sum per dimension. Blocks of vectors are written to the shared folder once and read by each pass.

Defined cases: vectors that are null, empty, or hold null or non-finite entries are dropped, and so
are those with an entry for which x is not below 2**53 in size. If vectors differ in length, the
commonest length is taken (of equally common ones the greatest), and the others are dropped. Ids may
be null or repeat; every row keeps its results. Components with an eigenvalue below 1e-12 of the
largest are left out, as they cannot be scaled: equal vectors, or one alone, give no rows. Where
eigenvalues tie, any orthonormal basis may come out. An empty table gives no rows. Other columns are
not looked at."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from math import acosh, ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.cluster import prepare, written

COMPONENTS = 8
GUARD = 24  # columns beside the wanted ones
LANCZOS_STEPS = 12
MOST_DEGREE = 12
ROUNDS = 60
TOLERANCE = 2e-14
ROUNDING = 1e-10  # a residual that no longer shrinks is due to rounding only below this
BLOCK_BYTES = 2 << 20
EXACT = 1 << 53
FAN_IN = 64  # partial sums that the driver adds itself


@dataclass(frozen=True)
class Moments:
    """Dimensions, number and exact sums of the vectors, and what follows for each from them."""

    size: int
    n: int
    sums: tuple[int, ...]

    def rows(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, np.int64).reshape(-1, self.size)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, with one rounding."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - whole) - rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per vector the sum of (n * x - sums) ** 2, exact."""
        whole = np.array([s // self.n for s in self.sums], dtype=np.int64)
        rest = np.array([s % self.n for s in self.sums], dtype=np.int64)
        near = x - whole
        most = self.n * (int(np.abs(near).max(initial=0)) + 1)
        if most * most * self.size < 1 << 63:
            return ((near * self.n - rest) ** 2).sum(axis=1).tolist()
        return ((near.astype(object) * self.n - rest.astype(object)) ** 2).sum(axis=1).tolist()


@dataclass(frozen=True)
class Blocks:
    """The vectors as whole numbers, many to a row."""

    table: DataFrame  # ids array, x binary (int64, row by row)
    moments: Moments

    def added(self, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all blocks of what ``work`` makes of a block of x."""
        moments = self.moments

        def partial(batches):
            total = None
            for batch in batches:
                for raw in batch.column(0).to_pylist():
                    part = work(moments.rows(raw))
                    total = part if total is None else total + part
            if total is not None:
                here = TaskContext.get().partitionId()
                yield pa.RecordBatch.from_pydict({"part": [here], "sum": [total.tobytes()]})

        def together(batches):
            rows = [r for b in batches for r in b.to_pylist()]
            if rows:
                rows.sort(key=lambda r: r["part"])
                total = sum(np.frombuffer(r["sum"]) for r in rows)
                first = rows[0]["part"]
                yield pa.RecordBatch.from_pydict({"part": [first], "sum": [total.tobytes()]})

        ddl = "part bigint, sum binary"
        given = self.table.select("x")
        tasks = given.rdd.getNumPartitions()
        sums = given.mapInArrow(partial, ddl)
        if tasks > FAN_IN:
            fan = isqrt(tasks)
            sums = sums.repartition(fan, F.col("part") % fan).mapInArrow(together, ddl)
        rows = sorted(sums.collect(), key=lambda r: r["part"])
        return sum(np.frombuffer(r["sum"]) for r in rows)


def packed(vectors: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> DataFrame:
    """Blocks of vectors of one length: ``size``, ``n``, ``ids``, ``x``, and ``sums`` per dimension."""
    prepare(vectors.sparkSession)
    kind = vectors.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    names = ["size", "n", "ids", "x", "sums"]

    def work(batches):
        for batch in batches:
            ids, column = batch.column(0), batch.column(1)
            lengths = np.asarray(column.value_lengths().fill_null(0))
            values = np.asarray(column.flatten().cast(pa.float64()).fill_null(np.nan))
            ends = np.cumsum(lengths, dtype=np.int64)
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(values * scale)
                bad = ~(np.abs(x) < EXACT - abs(offset))
            wrong = np.concatenate([[0], np.cumsum(bad)])
            good = (wrong[ends] == wrong[ends - lengths]) & (lengths > 0)
            x = np.where(bad, 0, x).astype(np.int64) + offset
            for size in np.unique(lengths[good]).tolist():
                rows = np.flatnonzero(good & (lengths == size))
                step = max(1, BLOCK_BYTES // (8 * size))
                for first in range(0, len(rows), step):
                    own = rows[first : first + step]
                    block = x[(ends[own] - size)[:, None] + np.arange(size)]
                    fits = int(np.abs(block).max()) * len(own) < 1 << 63
                    sums = block.sum(axis=0) if fits else block.astype(object).sum(axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([size], pa.int32()), pa.array([len(own)], pa.int64()),
                            pa.array([ids.take(pa.array(own)).to_pylist()], pa.list_(id_type)),
                            pa.array([block.tobytes()], pa.binary()),
                            pa.array([[Decimal(s) for s in sums.tolist()]], pa.list_(pa.decimal128(38))),
                        ],
                        names,
                    )

    ddl = f"size int, n bigint, ids array<{kind.simpleString()}>, x binary, sums array<decimal(38,0)>"
    given = vectors.select(vectors[id_col], vectors[vector_col].cast("array<double>"))
    return given.mapInArrow(work, ddl)


def blocks(vectors: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> Blocks | None:
    """The vectors, written once, of their commonest length; None if there are none."""
    table = written(packed(vectors, id_col, vector_col, scale, offset), "whitening")
    counted = table.groupBy("size").agg(F.sum("n").alias("n"))
    most = counted.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return None
    own = table.where(F.col("size") == most["size"])
    sums = own.select(F.posexplode("sums").alias("at", "s")).groupBy("at").agg(F.sum("s").alias("s"))
    exact = {r["at"]: int(r["s"]) for r in sums.collect()}
    moments = Moments(most["size"], most["n"], tuple(exact[i] for i in range(most["size"])))
    return Blocks(own.select("ids", "x"), moments)


def exact_total(found: Blocks) -> int:
    """The sum of all deviations: n**3 times the trace of the covariance."""
    moments = found.moments

    def work(batches):
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total = sum(moments.deviations(moments.rows(raw)))
                # In digits of base 2**48, so that sums of many blocks stay exact.
                parts = [total >> 48 * i & (1 << 48) - 1 for i in range(6)]
                yield pa.RecordBatch.from_pydict({f"p{i}": [p] for i, p in enumerate(parts)})

    names = [f"p{i}" for i in range(6)]
    digits = found.table.select("x").mapInArrow(work, ", ".join(f"{c} bigint" for c in names))
    row = digits.agg(*(F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in names)).first()
    return sum(int(row[c] or 0) << 48 * i for i, c in enumerate(names))


class Covariance:
    """Products of the covariance with thin matrices, a pass over the table each."""

    def __init__(self, found: Blocks):
        self.found, self.passes = found, 0

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        moments, q = self.found.moments, np.ascontiguousarray(q)

        def work(x):
            centred = moments.centred(x)
            return centred.T @ (centred @ q)

        self.passes += 1
        return self.found.added(work).reshape(q.shape) / moments.n


def spectrum_bounds(v: Covariance, size: int, random: np.random.Generator) -> tuple[float, float]:
    """Numbers between which the spectrum lies, or all but a little of it, by a Lanczos run."""
    q = random.standard_normal(size)
    q /= np.linalg.norm(q)
    basis, diagonal, beside, r = [q], [], [], None
    for _ in range(min(LANCZOS_STEPS, size)):
        r = (v @ basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ r))
        for _ in range(2):  # twice is enough against loss of orthogonality
            for b in basis:
                r -= (b @ r) * b
        beside.append(float(np.linalg.norm(r)))
        if beside[-1] <= 1e-12 * max(map(abs, diagonal)):
            break
        basis.append(r / beside[-1])
    k = len(diagonal)
    inner = np.diag(diagonal) + np.diag(beside[: k - 1], 1) + np.diag(beside[: k - 1], -1)
    ritz = np.linalg.eigvalsh(inner)
    slack = beside[-1]
    return max(0.0, float(ritz[0]) - slack), float(ritz[-1]) + slack


def filtered(v: Covariance, q: np.ndarray, vq: np.ndarray, low: float, cut: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` on [low, cut] times q, scaled to one at ``top``;
    ``vq`` is the product for the first degree."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    first = half / (top - middle)
    ratio = first
    before, now = q, (vq - middle * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - ratio)
        before, now = now, (v @ now - middle * now) * (2 * following / half) - ratio * following * before
        ratio = following
    return now


def ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values from the largest, their vectors, and the products of those with the matrix."""
    inner = q.T @ vq
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def leading(found: Blocks, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """Certified eigenvalues and vectors (columns) from the largest, and the passes it took."""
    size, random = found.moments.size, np.random.default_rng(seed)
    v, width = Covariance(found), min(size, wanted + GUARD)
    low, high = spectrum_bounds(v, size, random) if width < size else (0.0, 0.0)
    q, _ = np.linalg.qr(random.standard_normal((size, width)))
    values, q, vq = ritz(q, v @ q)
    last = np.inf
    for _ in range(ROUNDS):
        residual = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0)
        scale = max(values[0], np.finfo(float).tiny)
        worst = float(residual.max(initial=0.0)) / scale
        done = worst <= TOLERANCE or (worst <= ROUNDING and worst > last / 2)
        if done or width == size:
            return values[:wanted], q[:, :wanted], v.passes
        # A round that gained less than a digit needs more columns, or more of the spectrum damped.
        if worst > last / 10 and worst > ROUNDING:
            more = min(size - width, width)
            fresh = random.standard_normal((size, more))
            q = np.linalg.qr(np.hstack([q, fresh]))[0]
            width += more
            values, q, vq = ritz(q, v @ q)
            last = np.inf
            continue
        last = worst
        cut = max(float(values[-1]), low + 1e-6 * (high - low))
        place = (values[min(wanted, len(values)) - 1] - (cut + low) / 2) / max((cut - low) / 2, 1e-300)
        rate = acosh(max(place, 1 + 1e-6))
        degree = min(MOST_DEGREE, max(2, ceil(37 / rate)))
        q, _ = np.linalg.qr(filtered(v, q, vq, low, cut, max(high, float(values[0])), degree))
        values, q, vq = ritz(q, v @ q)
    raise ArithmeticError(f"components not certified after {ROUNDS} rounds: residual {worst}")


@dataclass(frozen=True)
class Components:
    """Components of vectors, with what is needed to whiten them."""

    moments: Moments
    values: np.ndarray
    vectors: np.ndarray  # a column each
    explained: np.ndarray
    passes: int

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.moments.centred(x) @ (self.vectors / np.sqrt(self.values))


def identity_error(found: Blocks, model: Components) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity."""
    k = len(model.values)

    def work(x):
        w = model.project(x)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    sums = found.added(work).reshape(k + 1, k) / model.moments.n
    covariance = sums[:k] - np.outer(sums[k], sums[k])
    return float(np.abs(covariance - np.eye(k)).max())


def fit(found: Blocks, wanted: int = COMPONENTS) -> Components:
    """The leading components of all vectors."""
    total, moments = exact_total(found), found.moments
    if total == 0:
        return Components(moments, np.zeros(0), np.zeros((moments.size, 0)), np.zeros(0), 0)
    values, columns, passes = leading(found, min(wanted, moments.size))
    kept = values > 1e-12 * values[0]
    values, columns = values[kept], columns[:, kept]
    # Either sign is right; the same is taken in every run.
    heavy = columns[np.abs(columns).argmax(axis=0), np.arange(columns.shape[1])]
    trace = total / moments.n**3
    return Components(moments, values, columns * np.sign(heavy), values / trace, passes)


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = COMPONENTS,
             scale: int = 1024, offset: int = 100_000) -> DataFrame:
    """Per vector and component: id, ``component`` from 1, ``n``, ``deviation`` (decimal),
    ``whitened``, ``explained`` share of the trace, and ``identity_error`` (one value)."""
    spark, kind = vectors.sparkSession, vectors.schema[id_col].dataType
    ddl = (
        f"`{id_col}` {kind.simpleString()}, component int, n bigint, deviation decimal(38,0),"
        " whitened double, explained double, identity_error double"
    )
    found = blocks(vectors, id_col, vector_col, scale, offset)
    model = fit(found, wanted) if found else None
    if model is None or not len(model.values):
        return spark.createDataFrame([], ddl)
    error, k, id_type = identity_error(found, model), len(model.values), to_arrow_type(kind)
    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def work(batches):
        for batch in batches:
            for ids, raw in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                x = model.moments.rows(raw)
                exact = [Decimal(d) for d in model.moments.deviations(x)]
                rows = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids.as_py(), id_type).take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(rows), model.moments.n)),
                        pa.array(exact, pa.decimal128(38)).take(pa.array(rows)),
                        pa.array(model.project(x).ravel()),
                        pa.array(np.tile(model.explained, len(x))),
                        pa.array(np.full(len(rows), error)),
                    ],
                    names,
                )

    return found.table.mapInArrow(work, ddl)
