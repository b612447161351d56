"""Embedding whitening: eigenvectors of the covariance by Jacobi-Davidson, which only ever multiplies by it.

Entries become integers, floor(scale * c) + shift, so that sums, and with them the centre, are exact. The covariance V
(divisor: the number of vectors) is never formed. A product V Q is one pass over the vectors: each task centres its
vectors, multiplies, and hands on one small matrix of the size of Q; these are added up in a tree.

1. A block of starting directions is multiplied once. Rayleigh-Ritz in the space spanned gives values and vectors.
2. Leading pairs whose residual is down to rounding are locked, and all that follows stays orthogonal to them.
3. For each wanted pair that is not, the correction equation, projected away from the locked and the current vectors,
   is solved by a few steps of MINRES. All pairs step together, so a step is one pass, not one for each pair.
4. The corrections widen the space. At ``BASIS`` times the wanted number it restarts from its best vectors.

Ends when all wanted pairs are locked; a search that cannot reach that raises.

Defined cases: a vector that is null, empty, or holds null or non-finite entries is dropped; repeated rows and ids are
rows of their own, a null id stays null; vectors of different lengths, which have no covariance, raise; a direction in
which the vectors do not vary (eigenvalue zero to rounding, so all of them for a single vector) cannot be scaled and is
no component; an empty table gives no rows. ``deviation`` is a decimal, since it outgrows a long at some 1e8 rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
#: Directions beside the wanted ones in the starting block.
SPARE = 8
#: The space restarts when it is so many times as wide as the wanted pairs.
BASIS = 4
#: Steps of MINRES for a correction, and the part of its right side at which it may end.
INNER, INNER_GOAL = 8, 0.1
OUTER = 200
#: Partial results that the driver adds up itself; more are first added up by tasks.
FAN_IN = 64

_LONG_BOUND = float(1 << 62)


@dataclass(frozen=True)
class Centre:
    """The mean of integer vectors in two parts: an integer, which leaves small numbers, and the exact rest."""

    n: int
    whole: np.ndarray
    over: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        whole = [s // n for s in sums]
        return cls(n, np.array(whole, dtype=np.int64), np.array([s - n * w for s, w in zip(sums, whole, strict=True)], dtype=np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.over / self.n

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2, exact."""
        x = x - self.whole
        rough = x.astype(np.float64) * self.n - self.over
        if not len(x) or (rough * rough).sum(axis=1).max() < _LONG_BOUND:
            d = x * self.n - self.over
            return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
        over = self.over.tolist()
        exact = [sum((self.n * a - b) ** 2 for a, b in zip(row, over, strict=True)) for row in x.tolist()]
        return pa.array(exact, type=pa.decimal128(38, 0))


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """For each usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    scratch = Scratch(vectors.sparkSession, "whitening")
    rows = scratch.keep(integer_rows(vectors, id_col, vector_col, scale, shift), "rows")
    size = rows.agg(F.count("*").alias("n"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("most")).first()
    if not size.n:
        return _result(rows, None, np.zeros((0, 0)), np.zeros(0), 0.0)
    if size.least != size.most:
        raise ValueError(f"vectors of {size.least} to {size.most} entries have no common covariance")
    sums = _integer_sums(rows, size.most)
    centre = Centre.of(size.n, sums)
    product = lambda q: _gathered(rows, lambda x: _times(centre.centred(x), q), q.shape) / size.n
    values, basis = eigenpairs(product, size.most, min(components, size.most))
    varies = values > 4 * size.most * np.finfo(float).eps * max(values[0], 0.0)
    values, basis = values[varies], basis[:, varies]
    scaled = basis / np.sqrt(values)
    k = len(values)
    moments = _gathered(rows, lambda x: _moments(centre.centred(x), scaled), (k + 2, max(k, 1))) / size.n
    covariance, mean, trace = moments[:k, :k], moments[k, :k], moments[k + 1, 0]
    error = np.abs(covariance - np.outer(mean, mean) - np.eye(k)).max() if k else 0.0
    return _result(rows, centre, scaled, values / trace if k else values, float(error))


def integer_rows(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """vec_id and the integer vector x of the usable rows."""
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    integers = F.transform("v", lambda c: F.floor(F.lit(float(scale)) * c).cast("long") + F.lit(shift))
    return rows.where(finite & (F.size("v") > 0)).select("vec_id", integers.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _integer_sums(rows: DataFrame, d: int) -> list[int]:
    """Exact sums of each dimension; a task's are longs, their total is any integer."""

    def run(batches):
        total = np.zeros(d, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                total += _matrix(batch.column(0)).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total)], ["at", "part"])

    parts = rows.select("x").mapInArrow(run, "at int, part long")
    found = parts.groupBy("at").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    return [int(r.total) for r in sorted(found, key=lambda r: r.at)]


def _times(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return x.T @ (x @ q)


def _moments(x: np.ndarray, scaled: np.ndarray) -> np.ndarray:
    """Second moments of the projections, then their sums, then the total of the squares of ``x``."""
    y, k = x @ scaled, scaled.shape[1]
    out = np.zeros((k + 2, max(k, 1)))
    out[:k, :k], out[k, :k], out[k + 1, 0] = y.T @ y, y.sum(axis=0), (x * x).sum()
    return out


def _gathered(rows: DataFrame, work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum over all vectors of small matrices that ``work`` makes of some of them."""

    def run(batches):
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += work(_matrix(batch.column(0)))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def add(batches):
        total = np.zeros(shape)
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total += np.frombuffer(part).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    read = rows.select("x")
    tasks = read.rdd.getNumPartitions()
    parts = read.mapInArrow(run, "part binary")
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        parts = parts.repartition(tasks).mapInArrow(add, "part binary")
    return sum((np.frombuffer(bytes(r.part)).reshape(shape) for r in parts.collect()), np.zeros(shape))


def eigenpairs(product: Callable[[np.ndarray], np.ndarray], d: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and unit eigenvectors of the symmetric d x d ``product``."""
    width = min(d, k + SPARE)
    space = np.linalg.qr(np.random.default_rng(d).standard_normal((d, width)))[0]
    image = product(space)
    locked, values, whole = np.zeros((d, 0)), np.zeros(0), False
    for _ in range(OUTER):
        ritz, turn = np.linalg.eigh(_symmetric(space.T @ image))
        ritz, turn = ritz[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        residual = image - space * ritz
        residual -= locked @ (locked.T @ residual)
        small = 4 * d * np.finfo(float).eps * max(np.abs(ritz).max(initial=0.0), np.abs(values).max(initial=0.0))
        size = np.linalg.norm(residual, axis=0)
        want = min(k - len(values), len(ritz))
        done = want if whole or (size[:want] <= small).all() else int((size[:want] > small).argmax())
        locked, values = np.hstack([locked, space[:, :done]]), np.append(values, ritz[:done])
        if len(values) == k:
            order = np.argsort(-values, kind="stable")
            return values[order], locked[:, order]
        space, image, residual, ritz, size = (a[..., done:] for a in (space, image, residual, ritz, size))
        if space.shape[1] >= BASIS * k + SPARE and len(values) + space.shape[1] < d:
            space, image = space[:, : k - len(values) + SPARE], image[:, : k - len(values) + SPARE]
        open_ = np.flatnonzero(size[: k - len(values)] > small)
        away = np.hstack([locked, space])
        if away.shape[1] >= d:  # nothing is left to add: products computed anew are as good as it gets
            space, whole = np.linalg.qr(_projected(space, locked))[0], True
            image = product(space)
            continue
        fresh = _corrections(product, away, ritz[open_], residual[:, open_])
        fresh = _independent(_projected(fresh, away), away, d - away.shape[1])
        space, image = np.hstack([space, fresh]), np.hstack([image, product(fresh)])
    raise ArithmeticError(f"{len(values)} of {k} eigenpairs after {OUTER} rounds")


def _symmetric(m: np.ndarray) -> np.ndarray:
    return (m + m.T) / 2


def _projected(x: np.ndarray, away: np.ndarray) -> np.ndarray:
    """``x`` without its part in ``away``; twice, since once leaves rounding."""
    for _ in range(2):
        x = x - away @ (away.T @ x)
    return x


def _independent(x: np.ndarray, away: np.ndarray, room: int) -> np.ndarray:
    """Orthonormal directions, at most ``room``, of what ``x`` spans beside ``away``."""
    x = x / np.maximum(np.linalg.norm(x, axis=0), np.finfo(float).tiny)
    left, sizes, _ = np.linalg.svd(x, full_matrices=False)
    left = left[:, : min(room, max(1, int((sizes > 1e-8).sum())))]
    return np.linalg.qr(_projected(left, away))[0]


def _corrections(product, away: np.ndarray, ritz: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Solutions t of (I - QQ')(V - ritz)(I - QQ') t = -residual, by MINRES on all columns at once."""
    tiny = np.finfo(float).tiny
    right = -_projected(residual, away)
    start = np.linalg.norm(right, axis=0)
    out = np.zeros_like(right)
    before, now, beta, beta_before = right, right, start, np.zeros_like(start)
    d_bar, eps, phi_bar, cos, sin = 0 * start, 0 * start, start, 0 * start - 1, 0 * start
    w, w_before = np.zeros_like(right), np.zeros_like(right)
    for step in range(INNER):
        v = now / np.maximum(beta, tiny)
        y = _projected(product(v) - v * ritz, away)
        if step:
            y = y - before * (beta / np.maximum(beta_before, tiny))
        alpha = (v * y).sum(axis=0)
        y = y - now * (alpha / np.maximum(beta, tiny))
        before, now, beta_before, beta = now, y, beta, np.linalg.norm(y, axis=0)
        eps_before = eps
        delta, g_bar = cos * d_bar + sin * alpha, sin * d_bar - cos * alpha
        eps, d_bar = sin * beta, -cos * beta
        gamma = np.maximum(np.hypot(g_bar, beta), tiny)
        cos, sin = g_bar / gamma, beta / gamma
        phi, phi_bar = cos * phi_bar, sin * phi_bar
        w, w_before = (v - eps_before * w_before - delta * w) / gamma, w
        out = out + phi * w
        if (phi_bar <= INNER_GOAL * start).all():
            break
    return out


def _result(rows: DataFrame, centre: Centre | None, scaled: np.ndarray, explained: np.ndarray, error: float) -> DataFrame:
    k = scaled.shape[1]

    def run(batches):
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x, many = _matrix(batch.column(1)), batch.num_rows
            row = pa.array(np.repeat(np.arange(many), k))
            columns = [
                batch.column(0).take(row),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                pa.array(np.full(many * k, centre.n)),
                centre.deviation(x).take(row),
                pa.array((centre.centred(x) @ scaled).ravel()),
                pa.array(np.tile(explained, many)),
                pa.array(np.full(many * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kind = rows.schema["vec_id"].dataType.simpleString()
    types = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, {types}")
