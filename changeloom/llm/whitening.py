"""Whitening of embeddings by Jacobi-Davidson, without ever forming the covariance.

Entries become whole numbers x = floor(1024 c) + 100000. The vectors are stored once as blocks; sums, squares and every product V q with the covariance V of x are passes over the blocks that centre each x
before multiplying (q is as small as a vector times the number of columns). The driver holds vectors of the embeddings' dimension only: a search space, its products, and the eigenvectors found.

Each outer round takes Ritz pairs of the search space, locks those at the top whose residuals are at double precision, and for the others solves the correction equations
(I - QQ')(V - e)(I - QQ') t = -r, Q being all locked and current Ritz vectors, by a few steps of MINRES, all equations in step, so that one pass serves them all; what they give widens the space. A
space that is full is restarted from its best Ritz vectors.

Cases: vectors that are null, hold null or non-finite entries, are shorter than the longest (their missing entries count as null), or whose x has no place in a long take no part; no vector at all, or an empty table,
gives an empty result; null ids and repeated rows are rows like any others; a component without variance (fewer vectors than dimensions, or all alike) has whitened 0, explained 0 and an error of 1 from the identity;
a deviation beyond a long is null; other columns, whatever their names, don't take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.common import stored, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Columns of the search space above the wanted ones, steps of an inner solution, outer rounds, and a residual's size that counts as double precision, against the largest eigenvalue.
EXTRA, INNER, OUTER, EXACT = 4, 10, 60, 2e-14
#: Share of the largest eigenvalue under which a component has no variance.
NONE = 1e-12
BLOCK = 4096
LONGEST = 2**63 - 1


def whole(vectors: pa.ListArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of a batch take part, and their x."""
    sizes = np.nan_to_num(vectors.value_lengths().to_numpy(zero_copy_only=False), nan=-1).astype(np.int64)
    right = sizes == width
    flat = vectors.filter(pa.array(right)).flatten()
    c = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
    with np.errstate(all="ignore"):
        scaled = np.floor(SCALE * c)
        fine = (np.abs(scaled) < 2.0**62).all(axis=1)  # not so of what isn't finite, or null
    used = np.zeros(len(sizes), bool)
    used[np.flatnonzero(right)[fine]] = True
    return used, scaled[fine].astype(np.int64) + SHIFT


def blocks_of(vectors: DataFrame, width: int, name: str) -> DataFrame:
    """The vectors' x, up to BLOCK in a row: n, x (longs, row by row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = whole(batch.column(0).slice(at, BLOCK), width)[1]
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), pa.array([x.tobytes()], pa.binary())], names=["n", "x"])

    return stored(vectors.mapInArrow(run, "n long, x binary"), name)


@dataclass
class Moments:
    """n, the sums S and sums of squares by dimension, exactly."""

    n: int
    sums: list[int]
    squares: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])  # one rounding: the quotient of whole numbers

    @property
    def trace(self) -> float:
        return sum(self.n * q - s * s for s, q in zip(self.sums, self.squares)) / (self.n * self.n)


def moments(blocks: DataFrame, width: int) -> Moments:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(1):
                x = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, width)
                low, high = x & 0xFFFF, x >> 16  # squares in parts, none of which leaves a long
                parts = [x.sum(axis=0, dtype=object), ((high.astype(object) ** 2).sum(axis=0) << 32) + ((high.astype(object) * low).sum(axis=0) << 17) + (low.astype(object) ** 2).sum(axis=0)] if np.abs(x).max() >= 1 << 25 else [x.sum(axis=0), (x * x).sum(axis=0)]
                s, q = ([str(v) for v in p.tolist()] for p in parts)
                yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(s), pa.array(q), pa.array([len(x)] + [0] * (width - 1), pa.int64())], names=["d", "s", "q", "n"])

    parts = blocks.mapInArrow(run, "d int, s string, q string, n long")
    rows = parts.groupBy("d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum(F.col("q").cast("decimal(38,0)")).alias("q"), F.sum("n").alias("n")).orderBy("d").collect()  # a row a dimension
    return Moments(sum(r.n for r in rows), [int(r.s) for r in rows], [int(r.q) for r in rows])


class Covariance:
    """V as something that multiplies: one pass over the blocks a product, however many columns it has."""

    def __init__(self, blocks: DataFrame, held: Moments):
        self.blocks, self.n, self.mean, self.passes = blocks, held.n, held.mean, 0

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        width, mean = len(self.mean), self.mean

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for data in batch.column(1):
                    centred = np.frombuffer(data.as_buffer(), np.int64).reshape(-1, width) - mean
                    part = centred.T @ (centred @ q)
                    total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["d", "y"])

        columns = [F.sum(F.col("y")[k]).alias(f"y{k}") for k in range(q.shape[1])]
        rows = self.blocks.mapInArrow(run, "d int, y array<double>").groupBy("d").agg(*columns).orderBy("d").collect()  # a row a dimension
        self.passes += 1
        return np.array([list(r)[1:] for r in rows]) / self.n


def joined(basis: np.ndarray, new: np.ndarray) -> np.ndarray:
    """The parts of new's columns that basis lacks, orthonormal; columns with none are left out."""
    out = basis
    for k in range(new.shape[1]):
        v = new[:, k]
        size = np.linalg.norm(v)
        if not size > 0:
            continue
        v = v / size
        for _ in range(3):
            v = v - out @ (out.T @ v)
        if np.linalg.norm(v) < 1e-10:
            continue
        v = v / np.linalg.norm(v)
        v = v - out @ (out.T @ v)
        out = np.column_stack([out, v / np.linalg.norm(v)])
    return out[:, basis.shape[1] :]


def minres(apply, b: np.ndarray, steps: int, enough: float = 0.05) -> np.ndarray:
    """Columns t with apply(t) near b, apply being symmetric column by column; all columns go on together, so a step is one product."""
    tiny = np.finfo(float).tiny
    norm = lambda a: np.sqrt((a * a).sum(axis=0))
    first = beta = norm(b)
    x, w, w_old, back, y = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b), b, b
    beta_old, bar, eps = np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    left, cs, sn = beta, -np.ones_like(beta), np.zeros_like(beta)
    before = None
    for step in range(steps):
        v = y / np.maximum(beta, tiny)
        y = apply(v)
        if before is not None:
            y = y - (beta / np.maximum(beta_old, tiny)) * before
        alpha = (v * y).sum(axis=0)
        y = y - (alpha / np.maximum(beta, tiny)) * back
        before, back, beta_old, beta = back, y, beta, norm(y)
        eps_old, delta, low = eps, cs * bar + sn * alpha, sn * bar - cs * alpha
        eps, bar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(low, beta), tiny)
        cs, sn = low / gamma, beta / gamma
        w, w_old, w_older = None, w, w_old
        w = (v - eps_old * w_older - delta * w_old) / gamma
        x = x + cs * left * w
        left = sn * left
        if (left <= enough * first).all() or not (beta > first * 1e-15).any():
            break
    return np.where(np.isfinite(x), x, 0.0)


def eigenpairs(v, width: int, wanted: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The wanted largest eigenvalues of v (anything with @), falling, and unit eigenvectors as columns."""
    wanted = min(wanted, width)
    most = min(width, max(4 * (wanted + EXTRA), 48))
    space = joined(np.zeros((width, 0)), np.random.default_rng(seed).normal(size=(width, min(width, wanted + EXTRA))))
    made = v @ space
    locked, best, stalled = 0, np.inf, 0
    for _ in range(OUTER):
        small = space.T @ made
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        ritz, image = space @ turn[:, :wanted], made @ turn[:, :wanted]
        residual = image - ritz * values[:wanted]
        sizes = np.linalg.norm(residual, axis=0)
        scale = max(values[0], 0.0)
        locked = 0
        while locked < wanted and sizes[locked] <= EXACT * scale:
            locked += 1
        stalled, best = (stalled + 1, best) if sizes.max() > 0.5 * best else (0, sizes.max())
        # the whole space is the answer; and a residual that has stopped falling at rounding's size is as small as products are exact
        if locked == wanted or space.shape[1] == width or (stalled >= 3 and best <= 50 * EXACT * scale):
            return values[:wanted], ritz
        if space.shape[1] + wanted - locked > most:
            keep = min(wanted + EXTRA, space.shape[1])
            space, made = space @ turn[:, :keep], made @ turn[:, :keep]
        shift = values[locked:wanted]
        project = lambda t: t - ritz @ (ritz.T @ t)  # noqa: B023, E731
        corrected = minres(lambda t: project(v @ (p := project(t)) - p * shift), -project(residual[:, locked:]), INNER)  # noqa: B023
        new = joined(space, project(corrected))
        if not new.shape[1]:
            new = joined(space, np.random.default_rng(seed + space.shape[1]).normal(size=(width, min(wanted, width - space.shape[1]))))
        space, made = np.column_stack([space, new]), np.column_stack([made, v @ new])
    raise ValueError("the eigenvectors didn't settle")


def whitened(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error of each vector that takes part."""
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    out = f"key {rows.schema['key'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    held = None
    if width > 0:
        blocks = blocks_of(rows.select("vector"), width, "whitening")
        held = moments(blocks, width)
    if held is None or not held.n:
        return rows.sparkSession.createDataFrame([], out).withColumnRenamed("key", key)
    values, q = eigenpairs(Covariance(blocks, held), width, components)
    trace, mean, n = held.trace, held.mean, held.n
    flat = values <= NONE * max(values[0], 0.0)
    scaled = np.where(flat, 0.0, q / np.sqrt(np.where(flat, 1.0, values)))
    explained = np.where(flat, 0.0, values / trace if trace > 0 else 0.0)
    wrong = identity_error(blocks, mean, scaled, n)
    sums = np.array(held.sums, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = scaled.shape[1]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                used, x = whole(part.column(1), width)
                if not len(x):
                    continue
                keys = part.column(0).filter(pa.array(used))
                far = deviations(x, n, sums)
                white = (x - mean) @ scaled
                repeat = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(repeat)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(repeat), n, np.int64)), pa.array(far, pa.int64()).take(pa.array(repeat)),
                     pa.array(white.reshape(-1)), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(repeat), wrong))],
                    names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, out).withColumnRenamed("key", key)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n x - S)^2, exactly; None beyond a long."""
    most = n * int(np.abs(x).max()) + max(abs(int(s)) for s in sums)
    if most < 2**62:
        far = n * x - sums.astype(np.int64)
        if x.shape[1] * int(np.abs(far).max()) ** 2 <= LONGEST:
            return (far * far).sum(axis=1).tolist()
        far = far.astype(object)
    else:
        far = n * x.astype(object) - sums
    exact = (far * far).sum(axis=1)
    return [int(v) if v <= LONGEST else None for v in exact]


def identity_error(blocks: DataFrame, mean: np.ndarray, scaled: np.ndarray, n: int) -> float:
    """The largest entry, without sign, of the whitened vectors' covariance minus the identity: two passes, the second centred by the first's mean."""
    width, k = scaled.shape

    def sums(centre: np.ndarray, products: bool) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, k if products else 1))
            for batch in batches:
                for data in batch.column(1):
                    w = (np.frombuffer(data.as_buffer(), np.int64).reshape(-1, width) - mean) @ scaled - centre
                    total += w.T @ w if products else w.sum(axis=0)[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["d", "y"])

        columns = [F.sum(F.col("y")[j]).alias(f"y{j}") for j in range(k if products else 1)]
        return np.array([list(r)[1:] for r in blocks.mapInArrow(run, "d int, y array<double>").groupBy("d").agg(*columns).orderBy("d").collect()]) / n

    return float(np.abs(sums(sums(np.zeros(k), False)[:, 0], True) - np.eye(k)).max())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
