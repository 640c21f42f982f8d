"""Embedding whitening by spectral divide and conquer with QDWH polar decompositions.

1. Every entry c becomes the integer floor(64 c) + 1000000. Count and sums of all vectors are exact integers.
2. Products of vectors that were moved by their rounded mean are summed exactly, and corrected by the rest of the
   mean, so the covariance does not depend on the order of the rows.
3. The unitary factor of V - s I, found by the QR form of the dynamically weighted Halley iteration, is the sign of
   that matrix; (sign + I) / 2 projects on the eigenvectors above s. Bases of the projector and of its
   complement split the problem in two, and so on down to single components. A last step sharpens all
   components at once in extended precision.
4. The rotation, one small matrix, goes to all tasks, which turn their vectors into whitened coordinates.

What reaches the driver are sums by pair of dimensions, never vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tallyline.llm.registry import query, table

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
LARGEST = 1 << 53  # beyond it doubles leave out integers
BLOCK = 2_048
EXACT = 1 << 62


# ---- spectral divide and conquer -------------------------------------------------------------


def polar(a: np.ndarray) -> np.ndarray:
    """The unitary factor of a symmetric matrix that is not singular, by QDWH in its QR form."""
    n = len(a)
    x = a / np.linalg.norm(a)  # the Frobenius norm bounds the spectral one
    low = max(1.0 / (np.linalg.norm(np.linalg.inv(x), 2)), 1e-16) if n else 1.0
    low = min(low * 0.9, 1.0)  # a lower bound of the smallest singular value
    for _ in range(40):
        d = np.cbrt(4 * (1 - low * low) / low ** 4)
        root = np.sqrt(1 + d)
        alpha = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * root), 0.0))
        beta = (alpha - 1) ** 2 / 4
        gamma = alpha + beta - 1
        q, _ = np.linalg.qr(np.concatenate((np.sqrt(gamma) * x, np.eye(n))))
        new = beta / gamma * x + (alpha - beta / gamma) / np.sqrt(gamma) * q[:n] @ q[n:].T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(low * (alpha + beta * low * low) / (1 + gamma * low * low), 1.0)
        if moved < 1e-14 * np.sqrt(n) or (moved < 1e-5 and low > 1 - 1e-15):
            break
    return x


def _split(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first k columns span what lies above ``shift``; None where the shift hits an eigenvalue."""
    n = len(a)
    moved = a - shift * np.eye(n)
    try:
        sign = polar(moved)
    except np.linalg.LinAlgError:
        return None
    projector = (sign + np.eye(n)) / 2
    k = round(float(np.trace(projector)))
    if not 0 < k < n:
        return None
    basis, _ = np.linalg.qr(projector @ rng.normal(size=(n, k)), mode="complete")
    for _ in range(3):
        rest = basis[:, k:].T @ a @ basis[:, :k]
        if np.linalg.norm(rest) <= 1e-13 * np.linalg.norm(a):
            return basis, k
        basis, _ = np.linalg.qr(projector @ basis[:, :k], mode="complete")
    return (basis, k) if np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k]) <= 1e-9 * np.linalg.norm(a) else None


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix, falling, and unit eigenvectors in columns, by divide and conquer."""
    rng = np.random.default_rng(12)

    def solve(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(part)
        middle = np.trace(part) / max(n, 1)
        off = part - middle * np.eye(n)
        if n <= 1 or np.linalg.norm(off) <= 4e-16 * n * max(abs(middle), np.linalg.norm(part)):
            return np.diag(part).copy(), np.eye(n)
        if n == 2:  # one rotation
            angle = 0.5 * np.arctan2(2 * part[0, 1], part[0, 0] - part[1, 1])
            c, s = np.cos(angle), np.sin(angle)
            turn = np.array([[c, -s], [s, c]])
            return np.diag(turn.T @ part @ turn).copy(), turn
        diagonal = np.sort(np.diag(part))
        spread = np.linalg.norm(off) / np.sqrt(n)
        shifts = [float(np.median(diagonal)), float(middle)] + [float(middle + spread * t) for t in rng.normal(0, 1, 60)]
        for shift in shifts:
            found = _split(part, shift, rng)
            if found is not None:
                break
        else:
            raise ArithmeticError("no shift separates the eigenvalues")
        basis, k = found
        turned = basis.T @ part @ basis
        turned = (turned + turned.T) / 2
        upper, lower = solve(turned[:k, :k]), solve(turned[k:, k:])
        vectors = np.concatenate((basis[:, :k] @ upper[1], basis[:, k:] @ lower[1]), 1)
        return np.concatenate((upper[0], lower[0])), vectors

    a = (a + a.T) / 2
    values, vectors = solve(a)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def sharpen(a: np.ndarray, vectors: np.ndarray, steps: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of ``a`` (extended precision) from vectors near them, falling."""
    a, q = a.astype(np.longdouble), vectors.astype(np.longdouble)
    n = len(a)
    norm = max(float(np.abs(a).sum(0).max(initial=0.0)), 1e-300)
    values = np.zeros(n, np.longdouble)
    for step in range(steps + 1):
        lost = np.eye(n, dtype=np.longdouble) - q.T @ q
        turned = q.T @ a @ q
        values = np.diag(turned) / (1 - np.diag(lost))
        if step == steps:
            break
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > 1e-12 * norm
        fix = np.where(far, (turned + values[None, :] * lost) / np.where(far, gap, 1), lost / 2)
        np.fill_diagonal(fix, np.diag(lost) / 2)
        q = q + q @ fix
    order = np.argsort(-values, kind="stable")
    q = q[:, order]
    return values[order], q / np.sqrt((q * q).sum(0))


# ---- exact sums ------------------------------------------------------------------------------


def _integers(column: pa.Array, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their integer vectors): whole vectors of ``dimension`` finite entries."""
    n = len(column)
    sizes = np.asarray(column.value_lengths().fill_null(-1))
    whole = np.flatnonzero(sizes == dimension)
    if not len(whole) or not dimension:
        return whole[:0], np.zeros((0, dimension), np.int64)
    flat = column.take(pa.array(whole)).flatten() if len(whole) < n else column.flatten()
    entries = flat.to_numpy(zero_copy_only=False).astype(float).reshape(-1, dimension)
    moved = np.floor(entries * SCALE) + SHIFT
    fine = (np.isfinite(entries) & (np.abs(moved) < LARGEST)).all(1)
    return whole[fine], moved[fine].astype(np.int64)


def _product(y: np.ndarray) -> np.ndarray:
    """The sum of outer products of integer rows, exactly."""
    largest = int(np.abs(y).max(initial=0))
    if largest * largest * max(len(y), 1) < LARGEST:
        return (y.astype(float).T @ y.astype(float)).astype(np.int64)  # every partial sum is an integer that a double holds
    if largest * largest * max(len(y), 1) < EXACT:
        return y.T @ y
    return y.astype(object).T @ y.astype(object)


@dataclass(frozen=True)
class Whitening:
    """What the rows are whitened with: count, exact sums, eigenvalues and components (columns), trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def usable(self) -> np.ndarray:
        """Components whose eigenvalue is more than rounding."""
        return self.values > max(float(self.values.max(initial=0.0)), 0.0) * max(len(self.values), 1) * 4e-16


def _vectors(df: DataFrame, vector: str) -> DataFrame:
    return df.select(F.col(vector).cast("array<double>").alias("v"))


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Count, sums and components of all vectors of ``df``.

    Left out are null vectors, vectors with null or non-finite entries, entries of 2**53 or more after scaling, and
    vectors shorter than the longest one. Repeated rows count as often as they stand there. Without vectors there are
    no components.
    """
    rows = _vectors(df, vector)
    dimension = rows.agg(F.max(F.size("v"))).first()[0]
    dimension = max(dimension or 0, 0)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dimension
        for batch in batches:
            _, x = _integers(batch.column("v"), dimension)
            n += len(x)
            part = x.sum(0) if len(x) < 1 << 9 else x.astype(object).sum(0)  # 2**9 numbers below 2**53 fit
            sums = [a + int(b) for a, b in zip(sums, part, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dimension), pa.int32()), pa.array([Decimal(s) for s in [n, *sums]], pa.decimal128(38, 0))],
                                         names=["i", "s"])

    total = {r["i"]: int(r["s"]) for r in rows.mapInArrow(add, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()}
    n = total.get(-1, 0)
    sums = tuple(total.get(i, 0) for i in range(dimension))
    if not n:
        return Whitening(0, sums, np.zeros(0), np.zeros((dimension, 0)), 0.0)
    near = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)  # rounded means
    pairs = np.triu_indices(dimension)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((dimension, dimension), object)
        for batch in batches:
            _, x = _integers(batch.column("v"), dimension)
            for at in range(0, len(x), BLOCK):
                products = products + _product(x[at:at + BLOCK] - near)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int32()), pa.array(pairs[1], pa.int32()),
                                          pa.array([Decimal(int(p)) for p in products[pairs]], pa.decimal128(38, 0))], names=["i", "j", "s"])

    got = rows.mapInArrow(multiply, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s"))
    covariance = np.zeros((dimension, dimension), np.longdouble)
    rest = [s - n * int(m) for s, m in zip(sums, near, strict=True)]
    for r in got.collect():  # one row a pair of dimensions
        i, j = r["i"], r["j"]
        exact = n * int(r["s"]) - rest[i] * rest[j]  # n * n times the covariance
        covariance[i, j] = covariance[j, i] = _quotient(exact, n * n)
    values, vectors = sharpen(covariance, eigen(covariance.astype(float))[1])
    few = min(components, dimension)
    return Whitening(n, sums, values[:few].astype(float), vectors[:, :few].astype(float), float(np.trace(covariance)))


def _quotient(a: int, b: int) -> np.longdouble:
    """a / b of integers of any size, rounded once to a double and once more for what the double leaves."""
    high = a / b
    top, bottom = high.as_integer_ratio()
    return np.longdouble(high) + np.longdouble((a * bottom - top * b) / (b * bottom))


# ---- rows ------------------------------------------------------------------------------------


def _centred(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int | None]]:
    """x - S / n of every row, and the squared length of n x - S, null where it is too long for a long."""
    if not len(x):
        return np.zeros(x.shape), []
    largest = max(model.n * int(np.abs(x).max()), max(map(abs, model.sums)))
    if largest < EXACT:
        scaled = model.n * x - np.array(model.sums, np.int64)
    else:
        scaled = model.n * x.astype(object) - np.array(model.sums, object)
    size = int(np.abs(scaled).max())
    if size * size * x.shape[1] < EXACT:
        lengths = (scaled.astype(np.int64) ** 2).sum(1).tolist()
    else:
        exact = (scaled.astype(object) ** 2).sum(1)
        lengths = [int(v) if v < 1 << 63 else None for v in exact]
    return scaled.astype(float) / model.n, lengths


def whiten(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """(row: the columns of ``df``, deviation, whitened: one number a component) for each row that took part in ``fit``.

    A component without spread gives null. The rows are turned on their own; repeated rows give equal numbers.
    ``deviation`` is exact, and null where it does not fit a long.
    """
    schema = df.select(F.struct("*").alias("row")).schema.add("deviation", "long").add("whitened", ArrayType(DoubleType()))
    dimension = len(model.sums)
    usable = model.usable
    turn = model.vectors / np.sqrt(np.where(usable, model.values, np.nan))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, x = _integers(batch.column("v"), dimension)
            for at in range(0, len(x), BLOCK):
                y, lengths = _centred(x[at:at + BLOCK], model)
                out = y @ turn
                flat = pa.array(out.ravel(), mask=np.isnan(out.ravel()))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * out.shape[1], pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(which[at:at + BLOCK])), pa.array(lengths, pa.int64()), lists],
                                                 names=["row", "deviation", "whitened"])

    return df.select(F.struct("*").alias("row"), F.col(vector).cast("array<double>").alias("v")).mapInArrow(work, schema)


def identity_error(df: DataFrame, model: Whitening, vector: str = "embedding") -> float | None:
    """The largest absolute entry of the covariance of all whitened rows less the identity, over the components with
    spread; None without any."""
    usable = np.flatnonzero(model.usable)
    m = len(usable)
    if not m:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, products = np.zeros(m), np.zeros((m, m))
        for batch in batches:
            some = batch.column("whitened")
            w = some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1)[:, usable]
            sums += w.sum(0)
            products += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(m * (m + 1)), pa.int32()), pa.array(np.concatenate((sums, products.ravel())))], names=["i", "s"])

    rows = whiten(df.select(vector), model, vector).select("whitened")
    got = rows.mapInArrow(add, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    flat = np.zeros(m * (m + 1))
    for r in got:
        flat[r["i"]] = r["s"]
    mean = flat[:m] / model.n
    return float(np.abs(flat[m:].reshape(m, m) / model.n - np.outer(mean, mean) - np.eye(m)).max())


def components(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """(row, component from 1, n, deviation, whitened, explained, identity_error) for each row and component.

    Without spread in any direction ``explained`` is null.
    """
    spread = df.sparkSession.createDataFrame(
        [(k + 1, float(e / model.trace) if model.trace > 0 else None) for k, e in enumerate(model.values)], "component int, explained double")
    error = identity_error(df, model, vector)
    rows = whiten(df, model, vector).select("row", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    rows = rows.withColumn("component", F.col("_at") + 1).drop("_at")
    return rows.join(F.broadcast(spread), "component").select(  # one row a component
        "row", "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(error).cast("double").alias("identity_error"))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return components(rows, fit(rows)).select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
