"""Embedding whitening (operator 11): Jacobi-Davidson on distributed centred products.

Every entry c becomes the whole number floor(1024 c) + 100000, and sums S over
all n vectors are exact, so a centred entry x - S / n is rounded once.  The
covariance V is never built: a product V U with a narrow block U is one pass over
the vectors, in which each task adds up y (y . U) for its centred rows y and only
the sums of tasks, one row per dimension, are added up and brought to the driver.

Eigenpairs: the subspace starts from random directions; Rayleigh-Ritz inside it
gives the wanted pairs and their residuals.  For each pair that is not yet exact
the projected correction equation (I - QQ')(V - e I)(I - QQ') t = -r is solved by a
few steps of MINRES (all pairs in step, so a step is one pass), and t widens the
subspace.  A pair whose residual is at rounding level is locked: it leaves
the search and everything later stays orthogonal to it.  A subspace that has
grown too wide restarts from its best pairs.  The end is reached when all wanted
pairs are locked.

Scale: vectors are packed once into rows of a few MB (read by numpy without
conversion) in the shared folder; per pass the driver gets and sends
dimension x block numbers, whatever the number of vectors.

Results for odd input: a vector that is NULL, holds NULL, NaN or an infinity, or an
entry of 2**43 or more (no whole number of 53 bits) is dropped, as is one of another length than
the most frequent (the longest of these); NULL and repeated ids give their rows each;
components with no variance beyond rounding cannot be whitened and are left out,
so equal vectors, a single one or an empty table give no rows; ``deviation`` is NULL
where it exceeds a long; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

GRID, SHIFT, BLOCK_BYTES = 1024, 100_000, 4 << 20
EPS = np.finfo(float).eps


# eigenpairs of a symmetric matrix known by its products

def minres(apply: Callable, b: np.ndarray, steps: int, tol: float) -> np.ndarray:
    """Approximate solutions of A x = b, column by column, ``apply`` taking the whole block."""
    def over(a, b):
        return np.divide(a, b, out=np.zeros_like(a), where=b != 0)

    first = np.linalg.norm(b, axis=0)
    x, v_old, v = np.zeros_like(b), np.zeros_like(b), over(b, np.broadcast_to(first, b.shape))
    w_old, w, eta, beta = np.zeros_like(b), np.zeros_like(b), first.copy(), np.zeros_like(first)
    c_old = c = np.ones_like(first)
    s_old = s = np.zeros_like(first)
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - beta * v_old
        grown = np.linalg.norm(p, axis=0)
        diag = c * alpha - c_old * s * beta
        rho = np.hypot(diag, grown)
        new = over(v - (s_old * beta) * w_old - (s * alpha + c_old * c * beta) * w, np.broadcast_to(rho, b.shape))
        c_old, s_old, c, s = c, s, over(diag, rho), over(grown, rho)
        x = x + (c * eta) * new
        eta = -s * eta
        w_old, w, v_old, v, beta = w, new, v, over(p, np.broadcast_to(grown, b.shape)), grown
        if (np.abs(eta) <= tol * first).all():
            break
    return x


def without(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """``t`` made orthogonal to the orthonormal columns of ``q`` (twice, for rounding)."""
    for _ in range(2):
        t = t - q @ (q.T @ t)
    return t


def orthonormal(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Orthonormal directions that ``t`` adds to the orthonormal ``q``; those lost in rounding are left out."""
    out = np.zeros((len(t), 0))
    for j in range(t.shape[1]):
        col = t[:, j:j + 1]
        size = np.linalg.norm(col)
        if not size:
            continue
        col = without(np.hstack([q, out]), col / size)
        size = np.linalg.norm(col)
        if size > 1e-10:
            out = np.hstack([out, without(np.hstack([q, out]), col / size)])
            out[:, -1] /= np.linalg.norm(out[:, -1])
    return out


def jacobi_davidson(product: Callable, d: int, k: int, steps: int = 6, width: int = 64, limit: int = 300,
                    seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors (columns) of a symmetric semidefinite matrix.

    ``product`` multiplies it with a block of columns.  A pair is locked when its
    residual is at most 4 sqrt(d) units of rounding of the largest eigenvalue, or
    below 1e-12 of it and no longer falling (sums over very many tasks round more).
    """
    rng, k = np.random.default_rng(seed), min(k, d)
    width = max(width, 4 * k)
    locked, values, top, best, idle = np.zeros((d, 0)), [], 0.0, np.inf, 0
    basis = orthonormal(locked, rng.standard_normal((d, min(2 * k, d))))
    image = product(basis)
    for turn in range(limit):
        h = basis.T @ image
        e, s = np.linalg.eigh((h + h.T) / 2)
        e, s = e[::-1], s[:, ::-1]
        want = min(k - len(values), len(e))
        top = max(top, abs(e[0]) if len(e) else 0.0)
        u = basis @ s[:, :want]
        r = image @ s[:, :want] - u * e[:want]
        sizes = np.linalg.norm(r, axis=0)
        exact = sizes <= 4 * np.sqrt(d) * EPS * top
        whole = locked.shape[1] + basis.shape[1] == d  # nothing to add: Rayleigh-Ritz is exact
        best, idle = (sizes[0], 0) if sizes[0] < best / 2 else (best, idle + 1)
        exact[0] |= idle > 3 and sizes[0] <= 1e-12 * top
        if whole:
            exact[:] = True
        n = want if exact.all() else int(np.argmin(exact))  # from the largest on, so that the order holds
        if n:
            fresh = u[:, :n] if not locked.shape[1] else without(locked, u[:, :n])
            locked = np.hstack([locked, fresh / np.linalg.norm(fresh, axis=0)])
            values += e[:n].tolist()
            basis, image = basis @ s[:, n:], image @ s[:, n:]
            e, s = e[n:], np.eye(len(e) - n)
            u, r, want, best, idle = u[:, n:], r[:, n:], want - n, np.inf, 0
        if len(values) == k:
            order = np.argsort(-np.array(values), kind="stable")
            return np.array(values)[order], locked[:, order]
        if basis.shape[1] + want > width:
            basis, image = basis @ s[:, :2 * k], image @ s[:, :2 * k]
        q, shift = np.hstack([locked, u]), e[:want]

        def projected(v: np.ndarray) -> np.ndarray:
            v = without(q, v)
            return without(q, product(v) - v * shift)

        t = minres(projected, -without(q, r), steps, 0.5 ** (turn + 1)) if want else np.zeros((d, 0))
        more = orthonormal(np.hstack([locked, basis]), t)
        if not more.shape[1]:  # no direction left from the equations
            more = orthonormal(np.hstack([locked, basis]), rng.standard_normal((d, max(want, 1))))
        basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])
    raise RuntimeError(f"{len(values)} of {k} eigenpairs after {limit} rounds")


# vectors

def valid(table: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that can be used, of the most frequent length."""
    entry = F.col("embedding")
    fine = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 43)))
    rows = table.select("vec_id", entry.cast("array<double>").alias("embedding")).filter(entry.isNotNull()).filter(fine)
    length = rows.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("k")).orderBy(
        F.desc("k"), F.desc("d")).limit(1).first()
    return rows.filter(F.size("embedding") == (length["d"] if length else 0))


def packed(rows: DataFrame) -> DataFrame:
    """(ids, x): the whole numbers of many vectors as one binary value."""
    def pack(batches):
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            flat = np.floor(GRID * lists.flatten().to_numpy(zero_copy_only=False)).astype(np.int64) + SHIFT
            if not len(flat):
                continue
            x = flat.reshape(len(ids), -1)
            step = max(1, BLOCK_BYTES // (8 * x.shape[1]))
            for k in range(0, len(ids), step):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[k:k + step].to_pylist()], pa.list_(pa.int64())), pa.array([x[k:k + step].tobytes()], pa.binary())],
                    names=["ids", "x"])

    return rows.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(pack, "ids array<long>, x binary")


@dataclass
class Centre:
    """Exact sums of n vectors: sum = n * whole + rest, 0 <= rest < n."""

    n: int
    whole: np.ndarray
    rest: np.ndarray

    def offsets(self, raw: bytes) -> np.ndarray:
        """x - whole, exact."""
        return np.frombuffer(raw, np.int64).reshape(-1, len(self.whole)) - self.whole

    def centred(self, raw: bytes) -> np.ndarray:
        return self.offsets(raw) - self.rest / self.n

    def deviations(self, raw: bytes) -> list[int | None]:
        """Sum over dimensions of (n x - S)**2 = (n (x - whole) - rest)**2."""
        d, n, rest = self.offsets(raw), self.n, self.rest
        far, m = int(np.abs(d).max(initial=0)), len(self.whole)
        if m * (n * (far + 1)) ** 2 < 1 << 62:
            return ((n * d - rest) ** 2).sum(1).tolist()
        if m * (far + 1) * max(far + 1, n) >= 1 << 62:
            d, rest = d.astype(object), rest.astype(object)
        squares, mixed, last = (d * d).sum(1).tolist(), (d * rest).sum(1).tolist(), sum(int(r) ** 2 for r in rest)
        out = [n * n * a - 2 * n * b + last for a, b in zip(squares, mixed)]
        return [v if v < 1 << 63 else None for v in out]


def centre_of(blocks: DataFrame) -> Centre:
    """Number and exact sums of the packed vectors."""
    def sums(batches):
        n, high, low = 0, 0, 0
        for batch in batches:
            for ids, raw in zip(batch.column(0), batch.column(1)):
                x = np.frombuffer(raw.as_py(), np.int64).reshape(len(ids), -1)
                n += len(x)
                # two halves, so that no sum leaves 64 bits
                high = high + (x >> 26).sum(0).astype(object)
                low = low + (x & ((1 << 26) - 1)).sum(0).astype(object)
        if n:
            total = [n, *((high << 26) + low).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(
                [str(t) for t in total], pa.string())], names=["i", "s"])

    rows = blocks.mapInArrow(sums, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    total = [int(r["s"]) for r in sorted(rows)]
    if not total:
        return Centre(0, np.zeros(0, np.int64), np.zeros(0, np.int64))
    parts = [divmod(t, total[0]) for t in total[1:]]
    return Centre(total[0], np.array([p for p, _ in parts], np.int64), np.array([r for _, r in parts], np.int64))


def summed(blocks: DataFrame, part: Callable[[bytes], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """Sum over all blocks of the matrix ``part`` makes of one: tasks add up theirs, Spark adds those by row."""
    def sums(batches):
        total = np.zeros(shape)
        for batch in batches:
            for raw in batch.column(0):
                total += part(raw.as_py())
        yield pa.RecordBatch.from_arrays([pa.array(range(shape[0]), pa.int32()), pa.array(
            total.tolist(), pa.list_(pa.float64()))], names=["i", "v"])

    rows = blocks.select("x").mapInArrow(sums, "i int, v array<double>").groupBy("i").agg(
        F.array(*[F.sum(F.col("v")[j]) for j in range(shape[1])]).alias("v")).collect()
    out = np.zeros(shape)
    for r in rows:
        out[r["i"]] = r["v"]
    return out


@dataclass
class Whitening:
    """Fitted components: ``matrix`` takes a centred vector to whitened coordinates."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    def whitened(self, raw: bytes) -> np.ndarray:
        return self.centre.centred(raw) @ self.matrix


def fit(blocks: DataFrame, k: int = 8) -> Whitening:
    """The ``k`` leading components of the packed vectors' covariance."""
    centre = centre_of(blocks)
    n, d = centre.n, len(centre.whole)
    if not d:
        return Whitening(centre, np.zeros(0), np.zeros((0, 0)), 0.0)
    trace = float(summed(blocks, lambda raw: (centre.centred(raw) ** 2).sum(0)[:, None], (d, 1)).sum()) / n

    def product(u: np.ndarray) -> np.ndarray:
        def part(raw: bytes) -> np.ndarray:
            y = centre.centred(raw)
            return y.T @ (y @ u)
        return summed(blocks, part, u.shape) / n

    if not trace:
        return Whitening(centre, np.zeros(0), np.zeros((d, 0)), 0.0)
    values, vectors = jacobi_davidson(product, d, k)
    real = values > d * EPS * trace
    values, vectors = values[real], vectors[:, real]
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(values))])  # the largest entry is positive
    return Whitening(centre, values, vectors * signs, trace)


def identity_error(blocks: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    k, n = len(model.values), model.centre.n
    mean = summed(blocks, lambda raw: model.whitened(raw).sum(0)[:, None], (k, 1))[:, 0] / n

    def part(raw: bytes) -> np.ndarray:
        z = model.whitened(raw) - mean
        return z.T @ z
    return float(np.abs(summed(blocks, part, (k, k)) / n - np.eye(k)).max())


def whiten(table: DataFrame, k: int = 8) -> DataFrame:
    """Per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    schema = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    blocks = written(packed(valid(table)), "vectors")
    model = fit(blocks, k)
    k = len(model.values)
    if not k:
        return table.sparkSession.createDataFrame([], schema)
    error, share = identity_error(blocks, model), model.values / model.trace
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(batches):
        for batch in batches:
            for ids, raw in zip(batch.column(0), batch.column(1)):
                raw = raw.as_py()
                z, dev, ids = model.whitened(raw), model.centre.deviations(raw), ids.values
                at = np.repeat(np.arange(len(z)), k)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z))),
                    pa.array(np.full(len(at), model.centre.n)), pa.array(dev, pa.int64()).take(pa.array(at)),
                    pa.array(z.ravel()), pa.array(np.tile(share, len(z))), pa.array(np.full(len(at), error))], names=names)

    return blocks.mapInArrow(rows, schema)
