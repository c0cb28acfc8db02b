"""Whitening of embeddings: blockwise QR, Householder bidiagonalisation, dqds singular values, twisted factorisations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.tables import input_columns, stored

COMPONENTS = 8
# Fixed values of the integer scale: x = floor(1024 c) + 100000.
STEP, ORIGIN = 1024.0, 100_000
# Factors that one task stacks and factors again.
FAN_IN = 16
# Numbers of centred rows worked on together.
BLOCK_VALUES = 1 << 20
# Relative distance of eigenvalues under which their vectors are made orthogonal to one another.
CLOSE = 1e-6

_EPS = float(np.finfo("float64").eps)
_TINY = float(np.finfo("float64").tiny)
# Deviations are summed in pieces of so many bits, so that no sum passes 64 bits.
_LIMB = 24


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper diagonal and right vectors: ``r = u b v'`` by Householder reflections from both sides."""
    a, d = r.astype("float64").copy(), r.shape[1]
    v = np.eye(d)

    def reflection(x: np.ndarray) -> tuple[np.ndarray, float, float]:
        top = float(np.abs(x).max(initial=0.0))
        if top == 0.0 or len(x) == 1:
            return x, 0.0, float(x[0])
        x = x / top
        head = -np.copysign(np.linalg.norm(x), x[0])
        w = x.copy()
        w[0] -= head
        return w, 2.0 / float(w @ w), head * top

    for i in range(d):
        w, beta, head = reflection(a[i:, i])
        if beta:
            a[i:, i:] -= np.outer(beta * w, w @ a[i:, i:])
        a[i, i], a[i + 1 :, i] = head, 0.0
        if i + 1 < d:
            w, beta, head = reflection(a[i, i + 1 :])
            if beta:
                a[i:, i + 1 :] -= np.outer(a[i:, i + 1 :] @ w, beta * w)
                v[:, i + 1 :] -= np.outer(v[:, i + 1 :] @ w, beta * w)
            a[i, i + 1], a[i, i + 2 :] = head, 0.0
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform; none if the shift is beyond the smallest eigenvalue. Also the least of its differences."""
    n, to_q, to_e = len(q), [0.0] * len(q), [0.0] * len(e)
    d = low = q[0] - shift
    for i in range(n - 1):
        if d < 0.0:
            return None
        total = d + e[i]
        to_q[i] = total
        if total <= _TINY:
            to_e[i], d = 0.0, q[i + 1] - shift
        else:
            ratio = q[i + 1] / total
            to_e[i], d = e[i] * ratio, d * ratio - shift
        low = min(low, d)
    if d < 0.0:
        return None
    to_q[n - 1] = d
    return to_q, to_e, low


def singular_squares(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling, each to a few units in its last place."""
    scale = float(max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0)))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    blocks = [([float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (upper / scale) ** 2], 0.0)]
    while blocks:
        q, e, moved = blocks.pop()
        tries = 0
        while len(q) > 1:
            # Where a coupling is negligible, the block falls into two.
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= _EPS**2 * (q[i] + moved) or e[i] <= _EPS**2 * (q[i + 1] + moved)), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e, tries = q[cut + 1 :], e[cut + 1 :], 0
                continue
            # The smallest eigenvalue is under the last ratio; a shift too large is taken back.
            shift = 0.0 if tries == 0 else max(0.0, low * (1.0 - 2.0 * (e[-1] / max(q[-1], _TINY)) ** 0.5) if e[-1] < q[-1] else low / 4.0)
            step = _qd_step(q, e, shift)
            while step is None:
                shift = shift / 4.0 if shift > _EPS * (moved + low) else 0.0
                step = _qd_step(q, e, shift)
            q, e, low = step
            moved, tries = moved + shift, tries + 1
            if tries > 100 * len(q) + 1_000:
                raise RuntimeError("the singular values did not converge")
        found.append(q[0] + moved)
    return np.sort(np.array(found))[::-1] * scale**2


class Twisted:
    """``L D L' - shift`` as twisted factors, from both ends to the row where they meet best."""

    def __init__(self, diagonal: np.ndarray, upper: np.ndarray, shift: float):
        n = len(diagonal)
        # Zeros would stop the recurrences: they become as good as zero.
        floor = _TINY ** 0.5 * (float(np.abs(diagonal).max(initial=0.0)) + 1.0)
        a = np.where(np.abs(diagonal) < floor, floor, diagonal)
        d, l = a**2, upper / a[:-1]
        least = _EPS**2 * (float(d.max(initial=0.0)) + abs(shift)) + _TINY

        def safe(x: float) -> float:
            return x if abs(x) > least else (least if x >= 0 else -least)

        self.down, self.from_top = np.zeros(n), np.zeros(max(n - 1, 0))
        s = np.zeros(n)
        s[0] = -shift
        for i in range(n - 1):
            self.down[i] = safe(d[i] + s[i])
            self.from_top[i] = d[i] * l[i] / self.down[i]
            s[i + 1] = self.from_top[i] * l[i] * s[i] - shift
        self.down[n - 1] = safe(d[n - 1] + s[n - 1])
        self.up, self.from_bottom = np.zeros(n), np.zeros(max(n - 1, 0))
        p = np.zeros(n)
        p[n - 1] = d[n - 1] - shift
        for i in range(n - 2, -1, -1):
            self.up[i + 1] = safe(d[i] * l[i] ** 2 + p[i + 1])
            ratio = d[i] / self.up[i + 1]
            self.from_bottom[i] = l[i] * ratio
            p[i] = p[i + 1] * ratio - shift
        self.gamma = s + p + shift
        self.twist = int(np.argmin(np.abs(self.gamma)))
        self.middle = safe(float(self.gamma[self.twist]))

    def vectors(self, tolerance: float) -> Iterator[np.ndarray]:
        """Vectors that the factors send to (almost) nothing, the best first; more than one where the matrix falls apart."""
        best = self.twist
        for k in np.argsort(np.abs(self.gamma), kind="stable"):
            if k == best or abs(self.gamma[k]) <= tolerance:
                self.twist = int(k)
                yield self.vector()
        self.twist = best

    def vector(self) -> np.ndarray:
        z = np.zeros(len(self.down))
        z[self.twist] = 1.0
        for i in range(self.twist - 1, -1, -1):
            z[i] = -self.from_top[i] * z[i + 1]
        for i in range(self.twist, len(z) - 1):
            z[i + 1] = -self.from_bottom[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, b: np.ndarray) -> np.ndarray:
        """One step of inverse iteration."""
        y, k, n = b.copy(), self.twist, len(b)
        for i in range(k):
            y[i + 1] -= self.from_top[i] * y[i]
        for i in range(n - 2, k - 1, -1):
            y[i] -= self.from_bottom[i] * y[i + 1]
        y[:k] /= self.down[:k]
        y[k + 1 :] /= self.up[k + 1 :]
        y[k] /= self.middle
        for i in range(k - 1, -1, -1):
            y[i] -= self.from_top[i] * y[i + 1]
        for i in range(k, n - 1):
            y[i + 1] -= self.from_bottom[i] * y[i]
        return y / np.linalg.norm(y)


def principal_directions(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Squares of all singular values of ``r``, falling, and the right vectors of the first ``components``."""
    diagonal, upper, v = bidiagonal(r)
    scale = float(max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))) or 1.0
    squares = singular_squares(diagonal / scale, upper / scale)
    vectors = np.zeros((r.shape[1], components))
    random = np.random.default_rng(0)
    for j in range(components):
        factors = Twisted(diagonal / scale, upper / scale, float(squares[j]))
        near = [i for i in range(j) if squares[i] - squares[j] <= CLOSE * squares[0]]
        others = vectors[:, near]

        def apart(z: np.ndarray, others: np.ndarray = others) -> np.ndarray:
            for _ in range(2):
                z = z - others @ (others.T @ z)
            return z

        # Of equal eigenvalues each gets a direction of its own.
        some = (apart(z) for z in factors.vectors(CLOSE * max(float(squares[0]), 1.0)))
        z = next((z for z in some if np.linalg.norm(z) > 0.1), None)
        if z is None:
            z = apart(random.standard_normal(len(diagonal)))
            for _ in range(3):
                z = apart(factors.solve(z / np.linalg.norm(z)))
        vectors[:, j] = z / np.linalg.norm(z)
    return squares * scale**2, v @ vectors


def _values(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Vectors as rows of integers, as doubles hold them exactly."""
    column = batch.column("v")
    flat = np.asarray(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False))
    return (np.floor(STEP * flat) + ORIGIN).reshape(-1, width)


def _exact(x: np.ndarray) -> np.ndarray:
    if len(x) and np.abs(x).max() >= 2.0**53:
        raise ValueError("an entry is too large: 1024 times it must be under 2^53")
    return x.astype("int64")


def _sums(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _exact(_values(batch, width))
                if float(np.abs(x).max()) * len(x) >= 2.0**63:
                    raise ValueError("the sum of a dimension passes 64 bits")
                total = x.sum(axis=0, dtype="int64")
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], "int64"), pa.array([total.tolist()], pa.list_(pa.int64()))], ["n", "s"])

    return run


def _centred(batch: pa.RecordBatch, n: int, s: list[int], width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Blocks of ``n x - S`` as exact integers, with the row each starts at."""
    rows = max(BLOCK_VALUES // max(width, 1), 1)
    total = np.array(s, "int64")
    for low in range(0, batch.num_rows, rows):
        x = _exact(_values(batch.slice(low, rows), width))
        if len(x) and float(np.abs(x).max()) * n + float(np.abs(total).max(initial=0)) >= 2.0**62:
            raise ValueError("n times an entry passes 64 bits")
        yield low, x * n - total


def _factors(n: int, s: list[int], width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            for _, block in _centred(batch, n, s, width):
                r = np.linalg.qr(np.vstack([r, block / float(n)]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    return run


def _stacked(width: int):
    def run(table: pa.Table) -> pa.Table:
        r = np.vstack([np.frombuffer(b.as_py(), "float64").reshape(-1, width) for b in table.column("r")])
        return pa.table({"r": pa.array([np.linalg.qr(r, mode="r").tobytes()], pa.binary())})

    return run


def _triangle(rows: DataFrame, n: int, s: list[int], width: int) -> np.ndarray:
    """R of the QR factorisation of all centred rows: a factor a task, then factors of factors."""
    factors = stored(rows.mapInArrow(_factors(n, s, width), "r binary"), "factors")
    left = factors.count()
    while left > 1:
        groups = -(-left // FAN_IN)
        dealt = factors.withColumn("g", F.pmod(F.xxhash64("r"), F.lit(groups)))
        factors = stored(dealt.groupBy("g").applyInArrow(_stacked(width), "r binary"), "factors")
        left = factors.count()
    # One triangle, whose size depends on the dimension alone.
    r = np.frombuffer(factors.first().r, "float64").reshape(-1, width)
    return np.vstack([r, np.zeros((width - len(r), width))]) if len(r) < width else r


def _limbs(block: np.ndarray) -> list[np.ndarray]:
    """Sums of squares of the rows, exact, as five numbers for powers 0 to 4 of 2^24."""
    mask = np.int64((1 << _LIMB) - 1)
    v = np.abs(block)
    a, b, c = v & mask, v >> _LIMB & mask, v >> 2 * _LIMB
    return [(a * a).sum(axis=1), 2 * (a * b).sum(axis=1), (b * b + 2 * a * c).sum(axis=1), 2 * (b * c).sum(axis=1), (c * c).sum(axis=1)]


def _projected(n: int, s: list[int], width: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, block in _centred(batch, n, s, width):
                part = batch.slice(low, len(block))
                white = block / float(n) @ weights
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(list(white), pa.list_(pa.float64())), *map(pa.array, _limbs(block))],
                    ["id", "white", "p0", "p1", "p2", "p3", "p4"],
                )

    return run


def _moments(n: int, s: list[int], width: int, weights: np.ndarray):
    """Sums of the whitened rows and of their products, a row a task."""
    k = weights.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, block in _centred(batch, n, s, width):
                white = block / float(n) @ weights
                first += white.sum(axis=0)
                second += white.T @ white
        flat = np.concatenate([first, second.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), "int32"), pa.array(flat)], ["at", "value"])

    return run


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Key, ``component, n, deviation, whitened, explained, identity_error`` for each vector and leading component.

    Rows whose vector is null, or holds null or non-finite entries, go; entries become integers ``x = floor(1024 c) + 100000``.
    With ``n`` rows and sums ``S``, tasks factor blocks of the centred rows ``(n x - S) / n``; triangles are stacked
    and factored again until one is left, of a size set by the dimension alone. Its singular values (squared and over
    ``n``: eigenvalues ``e`` of the covariance) and directions are found on the driver. ``deviation``, a
    decimal(38,0), is the exact sum of ``(n x - S)^2``; ``whitened`` the projection of ``x - S / n`` over ``sqrt(e)``; ``explained`` is
    ``e / trace``; ``identity_error`` the largest entry of the covariance of all whitened rows minus the identity.

    Where ``e`` is nothing beside the largest one (fewer rows than components, equal vectors), ``whitened`` is null and
    ``explained`` 0, and the component is left out of ``identity_error``. Vectors of different lengths are an error,
    as are entries of 2^43 and more. Null, tied and repeated keys and vectors are rows like others; vectors of any
    length have at most as many components; an empty table, or one of empty vectors, gives no rows. Of other columns none is read.
    """
    spark = df.sparkSession
    rows = input_columns(df, id=key, v=vector)
    kind = dict(rows.dtypes)["id"]
    good = F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    rows = rows.where(good & (F.size("v") > 0)).select("id", F.col("v").cast("array<double>").alias("v"))
    lengths = rows.agg(F.min(F.size("v")), F.max(F.size("v"))).first()
    if lengths[0] != lengths[1]:
        raise ValueError(f"vectors of different lengths, {lengths[0]} to {lengths[1]}")
    width = lengths[0] or 0
    names = f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not width:
        return spark.createDataFrame([], names)
    sums = rows.select("v").mapInArrow(_sums(width), "n long, s array<long>")
    totals = sums.select("n", F.posexplode("s").alias("at", "s")).groupBy("at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    totals = sorted(totals.collect())  # one row a dimension
    n, s = totals[0]["n"], [t["s"] for t in totals]

    k = min(components, width)
    squares, directions = principal_directions(_triangle(rows.select("v"), n, s, width), k)
    values, trace = squares / n, float(squares.sum()) / n
    real = squares[:k] > squares[0] * width * _EPS if trace > 0 else np.zeros(k, bool)
    weights = np.where(real, directions / np.sqrt(np.where(real, values[:k], 1.0)), 0.0)

    moments = rows.select("v").mapInArrow(_moments(n, s, width, weights), "at int, value double")
    moments = moments.groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.array([m["value"] for m in sorted(moments.collect())])  # k + k * k rows
    covariance = flat[k:].reshape(k, k) / n - np.outer(flat[:k] / n, flat[:k] / n)
    error = float(np.abs(covariance - np.diag(real.astype(float))).max())

    kept = ", ".join(f"p{i} long" for i in range(5))
    found = rows.mapInArrow(_projected(n, s, width, weights), f"id {kind}, white array<double>, {kept}")
    powers = [F.col(f"p{i}").cast("decimal(38,0)") * F.lit(str(1 << _LIMB * i)).cast("decimal(38,0)") for i in range(5)]
    deviation = sum(powers[1:], powers[0]).cast("decimal(38,0)").alias("deviation")
    shares = F.array(*[F.lit(float(values[j] / trace) if real[j] else 0.0) for j in range(k)])
    live = F.array(*[F.lit(bool(r)) for r in real])
    long = found.select("id", deviation, F.posexplode("white").alias("at", "white"))
    return long.select(
        F.col("id").alias(key), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(F.get(live, F.col("at")), F.col("white")).alias("whitened"), F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
