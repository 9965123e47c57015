"""Whitening of embeddings by Jacobi-Davidson, without ever forming the covariance.

Entries become integers (``floor(64 c) + 1000000``), so counts, sums and distances
from the mean are exact. The distinct vectors, the *fit list*, are packed into
blocks and checkpointed; every product of the covariance with a few columns is
one pass over them: each task centres its blocks, multiplies, and emits a sum
of the size of the product, which Spark adds up.

The search space lives on the driver: ``dim`` x at most four times the wanted
columns, whatever the number of rows. Each round takes Ritz pairs from it,
locks those whose residual has reached double precision, and expands it by the
solutions of the projected correction equations
``(I - PP')(A - t I)(I - PP') z = -r``, solved by a few steps of MINRES; the
equations of all open pairs advance together, so one pass serves them all.

Rows: vectors that are null, empty, or hold null or non-finite entries are
dropped, and so are those of another length than the most common one (the
longer one of equals), which have no place in the covariance. Repeated vectors
count once in the fit list and keep all their rows. Fixed values are held within
2^53 (entries beyond +-1.4e14); a deviation that passes 64 bits is null.
Directions without variance (rank below the wanted number, one distinct vector)
give no rows, an empty table an empty result. Null and repeated ids are kept,
other columns ignored. A lost executor costs the pass it was in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from eventide.llm.blocks import col, small_batches
from eventide.session import ensure_checkpoint_dir

SCALE, SHIFT, LIMIT = 64, 1_000_000, 1 << 53
#: Vectors of a packed block.
BLOCK_ROWS = 4096
#: Bytes of packed integers that a task of a pass reads at least, where the cores allow it.
PASS_BYTES = 32 << 20
#: Residuals count as double precision below this part of the largest eigenvalue.
TOLERANCE = 2.0 ** -43
#: MINRES steps of a round at most, and the drop of the residual that ends them.
INNER_STEPS, INNER_DROP = 8, 1e-3
#: Columns of the search space, in multiples of the wanted ones.
SPACE = 4
#: Exact sums are kept in two parts of this many lower bits.
LOW_BITS = 20

Product = Callable[[np.ndarray], np.ndarray]


# --- the solver: small matrices on the driver ---------------------------------------

def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of ``block`` outside those of ``against``."""
    norms = np.linalg.norm(block, axis=0)
    block = block[:, norms > 0] / norms[norms > 0]
    for _ in range(2):
        block = block - against @ (against.T @ block)
    if not block.shape[1]:
        return block
    left, size, _ = np.linalg.svd(block, full_matrices=False)
    left = left[:, size > 1e-10]
    left = left - against @ (against.T @ left)
    return np.linalg.qr(left)[0]


def minres(product: Product, shifts: np.ndarray, right: np.ndarray, outside: np.ndarray, steps: int, drop: float) -> np.ndarray:
    """Approximate solutions z_i of ``(I - PP')(A - shifts_i I)(I - PP') z_i = right_i``, all
    columns in step: one product with A for each step."""
    def project(block):
        return block - outside @ (outside.T @ block)

    def unit(block, norms):
        return np.divide(block, norms, out=np.zeros_like(block), where=norms > 0)

    v = project(right)
    beta0 = np.linalg.norm(v, axis=0)
    v, v_old = unit(v, beta0), np.zeros_like(v)
    z, w, w_old = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    eta, beta = beta0.copy(), np.zeros_like(beta0)
    c = c_old = np.ones_like(beta0)
    s = s_old = np.zeros_like(beta0)
    for _ in range(steps):
        p = project(product(v) - v * shifts)
        alpha = (v * p).sum(0)
        p = project(p - v * alpha - v_old * beta)
        beta_new = np.linalg.norm(p, axis=0)
        delta, upper, top = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta, s_old * beta
        rho = np.hypot(delta, beta_new)
        c_old, s_old = c, s
        c = np.divide(delta, rho, out=np.zeros_like(rho), where=rho > 0)
        s = np.divide(beta_new, rho, out=np.zeros_like(rho), where=rho > 0)
        w, w_old = unit(v - w_old * top - w * upper, rho), w
        z += w * (c * eta)
        eta = -s * eta
        v, v_old, beta = unit(p, beta_new), v, beta_new
        if np.all(np.abs(eta) <= drop * beta0):
            break
    return z


def jacobi_davidson(product: Product, dim: int, wanted: int, tolerance: float = TOLERANCE, seed: int = 0,
                    rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) and unit eigenvectors of the
    symmetric positive matrix that ``product`` applies to columns."""
    locked, values = np.zeros((dim, 0)), []
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dim, wanted)), locked)
    image = product(space)
    for _ in range(rounds):
        theta, turn = np.linalg.eigh((space.T @ image + image.T @ space) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        residual = image - space * theta
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        largest = max([*values, *theta[:1], 0.0])
        missing = wanted - len(values)
        whole = space.shape[1] + locked.shape[1] >= dim  # nothing is left to search
        open_ = (size[:missing] > tolerance * largest) & (not whole)
        done = int(np.argmax(open_)) if open_.any() else len(open_)
        if done:  # lock the leading pairs that are there
            values += theta[:done].tolist()
            locked = np.hstack((locked, space[:, :done]))
            space, image, residual, theta = space[:, done:], image[:, done:], residual[:, done:], theta[done:]
            open_, missing = open_[done:], missing - done
        if not missing:
            return np.array(values), locked
        if space.shape[1] + missing > SPACE * wanted:  # restart from the best directions
            space, image = space[:, :2 * wanted], image[:, :2 * wanted]
        pick = np.flatnonzero(open_)
        outside = np.hstack((locked, space[:, :missing]))
        found = minres(product, theta[pick], -residual[:, pick], outside, INNER_STEPS, INNER_DROP)
        basis = np.hstack((locked, space))
        new = _orthonormal(found, basis)
        if not new.shape[1]:  # the corrections lie in the space: go on from a fresh direction
            new = _orthonormal(np.random.default_rng(seed + len(values) + 1).standard_normal((dim, 1)), basis)
        space, image = np.hstack((space, new)), np.hstack((image, product(new)))
    raise RuntimeError(f"residuals above {tolerance:g} after {rounds} rounds")


# --- vectors and passes over them ------------------------------------------------------

def fixed(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, x)``: the fixed values of the vectors that are whole and not empty."""
    entry = col(vector_col)
    whole = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    held = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LIMIT))), F.lit(-float(LIMIT))))
    return (vectors.select(col(id_col).alias("vec_id"), entry.alias("v"), F.coalesce(whole, F.lit(False)).alias("whole"))
            .filter(F.col("whole") & (F.size("v") > 0))
            .select("vec_id", F.transform("v", lambda c: held(c) + F.lit(SHIFT)).alias("x")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dim)


def pack(x: DataFrame, dim: int) -> DataFrame:
    """``(n_rows, width, block)``: the distinct vectors as blocks of integers, checkpointed."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                m = _matrix(batch["x"].slice(at, BLOCK_ROWS), dim)
                width = 4 if np.abs(m).max() < 1 << 31 else 8
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(m)], pa.int32()), pa.array([width], pa.int32()),
                     pa.array([m.astype(f"<i{width}").tobytes()], pa.binary())], ["n_rows", "width", "block"])

    ensure_checkpoint_dir(x.sparkSession)
    # copies of a vector are folded before they are exchanged
    return x.select("x").distinct().mapInArrow(blocks, "n_rows int, width int, block binary").checkpoint()


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for width, block in zip(batch["width"].to_pylist(), batch["block"].to_pylist()):
            yield np.frombuffer(block, f"<i{width}").reshape(-1, dim).astype(np.int64)


@dataclass(frozen=True)
class Moments:
    """Number of distinct vectors and exact sums of their fixed values."""
    n: int
    sums: tuple[int, ...]

    @property
    def dim(self) -> int:
        return len(self.sums)

    def centred(self, m: np.ndarray) -> np.ndarray:
        """``x - S/n``: whole parts are subtracted as integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (m - whole).astype(np.float64) - rest

    def deviations(self, m: np.ndarray) -> list[int | None]:
        """The exact sum of ``(n x - S)^2`` of each row; None beyond 64 bits."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = [s % self.n for s in self.sums]
        near = m - whole
        if (float(np.abs(near).max(initial=0)) + 1) ** 2 * float(self.n) ** 2 * self.dim < 2.0 ** 62:
            return ((near * self.n - np.array(rest, np.int64)) ** 2).sum(1).tolist()
        exact = (sum((v * self.n - r) ** 2 for v, r in zip(row, rest)) for row in near.tolist())
        return [v if v < 1 << 63 else None for v in exact]


def moments(packed: DataFrame, dim: int) -> Moments:
    """One pass; the sums travel in two parts, so no partial sum passes 64 bits."""
    def partial(batches):
        high, low, n = np.zeros(dim, np.int64), np.zeros(dim, np.int64), 0
        for m in _blocks(batches, dim):
            high, low, n = high + (m >> LOW_BITS).sum(0), low + (m & ((1 << LOW_BITS) - 1)).sum(0), n + len(m)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dim + 1), pa.int32()), pa.array([*high.tolist(), 0], pa.int64()),
                 pa.array([*low.tolist(), n], pa.int64())], ["k", "high", "low"])

    wide = "decimal(38,0)"
    rows = (packed.mapInArrow(partial, "k int, high long, low long").groupBy("k")
            .agg(F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")).collect())
    total = {r.k: (int(r.high) << LOW_BITS) + int(r.low) for r in rows}  # dim + 1 rows
    return Moments(total.pop(dim, 0), tuple(total[k] for k in range(dim)) if total else ())


def merged(packed: DataFrame, about: Moments) -> DataFrame:
    """The blocks in as many partitions as their size asks for, or one for each core: the
    passes are many, and each pays for its tasks."""
    needed = -(-about.n * about.dim * 8 // PASS_BYTES)
    return packed.coalesce(max(needed, packed.sparkSession.sparkContext.defaultParallelism))


def _total(packed: DataFrame, about: Moments, of_block: Callable[[np.ndarray], np.ndarray], length: int) -> np.ndarray:
    """The sum over all blocks of a vector of numbers taken from the centred block."""
    dim = about.dim

    def partial(batches):
        total, seen = np.zeros(length), False
        for m in _blocks(batches, dim):
            total, seen = total + of_block(about.centred(m)), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(length), pa.int32()), pa.array(total, pa.float64())], ["k", "v"])

    rows = packed.mapInArrow(partial, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()  # length rows
    out = np.zeros(length)
    for k, v in rows:
        out[k] = v
    return out


def covariance_product(packed: DataFrame, about: Moments) -> Product:
    """The covariance of the fit list applied to columns: one pass over the blocks."""
    def product(columns: np.ndarray) -> np.ndarray:
        flat = _total(packed, about, lambda c: (c.T @ (c @ columns)).ravel(), columns.size)
        return flat.reshape(columns.shape) / about.n

    return product


@dataclass(frozen=True)
class Whitening:
    about: Moments
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def projection(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(x: DataFrame, components: int = 16, seed: int = 0) -> Whitening | None:
    """Whitening of the distinct vectors of ``x`` (one length); None where nothing varies."""
    sizes = x.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not sizes:
        return None
    dim = sizes[0]["dim"]
    packed = pack(x.filter(F.size("x") == dim), dim)
    about = moments(packed, dim)
    packed = merged(packed, about)
    trace = float(_total(packed, about, lambda c: np.array([np.sum(c * c)]), 1)[0]) / about.n
    wanted = min(components, dim, about.n - 1)
    if not wanted or not trace:
        return None
    values, vectors = jacobi_davidson(covariance_product(packed, about), dim, wanted, seed=seed)
    real = values > values[0] * dim * 2.0 ** -46  # rounding leaves that much where nothing varies
    values, vectors = values[real], vectors[:, real]
    turn, k = vectors / np.sqrt(values), len(values)

    def products(c: np.ndarray) -> np.ndarray:
        z = c @ turn
        return np.concatenate((z.sum(0), (z.T @ z).ravel()))

    flat = _total(packed, about, products, k + k * k) / about.n
    mean, cov = flat[:k], flat[k:].reshape(k, k)
    error = float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(about, values, vectors, trace, error)


def whiten(vectors: DataFrame, components: int = 16, seed: int = 0, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``: a row for
    each vector and component."""
    small_batches(vectors.sparkSession)
    x = fixed(vectors, id_col, vector_col)
    id_type = x.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(x, components, seed)
    if model is None:
        return x.sparkSession.createDataFrame([], schema)
    about, turn, k = model.about, model.projection, len(model.values)
    explained = model.values / model.trace

    def rows(batches):
        for batch in batches:
            m = _matrix(batch["x"], about.dim)
            size = len(m)
            own = pa.array(np.repeat(np.arange(size), k), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"].take(own), pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                 pa.array(np.full(size * k, about.n), pa.int64()), pa.array(about.deviations(m), pa.int64()).take(own),
                 pa.array((about.centred(m) @ turn).ravel(), pa.float64()), pa.array(np.tile(explained, size), pa.float64()),
                 pa.array(np.full(size * k, model.identity_error), pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.filter(F.size("x") == about.dim).mapInArrow(rows, schema)
