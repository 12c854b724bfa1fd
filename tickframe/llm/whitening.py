"""Whitening of embeddings: leading components by a Jacobi-Davidson method on distributed products."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from typing import Any

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickframe.llm.storage import materialise

#: An entry c counts as floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Pairs beyond the wanted ones that are sought with them, so that none of these is missed.
GUARD = 2
#: Octets of the vectors that a task works on at once.
BLOCK = 4_000_000
#: Partial sums of a product that come to the driver: each as large as the vectors multiplied.
PARTIALS = 32
#: Vectors of the search space, per sought pair, before it is cut back.
SPACE = 8
EPSILON = float(np.finfo(np.float64).eps)


# the eigenproblem: dense algebra on matrices of as many rows as the embeddings have dimensions


def _outside(t: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """t without what lies in the bases (twice, for rounding)."""
    for _ in range(2):
        for b in bases:
            t = t - b @ (b.T @ t)
    return t


def _orthonormal(t: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what t adds to the bases; directions that rounding alone would give are left out."""
    size = np.linalg.norm(t, axis=0)
    t = t[:, size > 0] / size[size > 0]
    if not t.shape[1]:
        return t
    u, s, _ = np.linalg.svd(_outside(t, *bases), full_matrices=False)
    return np.linalg.qr(_outside(u[:, s > 1e-10], *bases))[0]


def minres(apply: Callable[[np.ndarray], np.ndarray], b: np.ndarray, relative: float, steps: int) -> np.ndarray:
    """Columns x of apply(x) = b for a symmetric map, all in step, so that a step is one product; until
    every residual is below `relative` of its column, or for so many steps."""
    beta = np.linalg.norm(b, axis=0)
    first, eta = beta.copy(), beta.copy()
    ok = beta > 0
    v, v_old = np.where(ok, b / np.where(ok, beta, 1.0), 0.0), np.zeros_like(b)
    x, w, w_old = np.zeros_like(b), np.zeros_like(b), np.zeros_like(b)
    c_old, c, s_old, s, beta = np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    for _ in range(steps):
        if not (ok & (np.abs(eta) > relative * first)).any():
            break
        p = apply(v)
        alpha = np.sum(v * p, axis=0)
        p = p - alpha * v - beta * v_old
        after = np.linalg.norm(p, axis=0)
        delta, r2, r3 = c * alpha - c_old * s * beta, s * alpha + c_old * c * beta, s_old * beta
        r1 = np.hypot(delta, after)
        ok = ok & (r1 > 0)
        r1 = np.where(ok, r1, 1.0)
        c_old, c, s_old, s = c, np.where(ok, delta / r1, 1.0), s, np.where(ok, after / r1, 0.0)
        w, w_old = np.where(ok, (v - r3 * w_old - r2 * w) / r1, 0.0), w
        x = x + np.where(ok, c * eta, 0.0) * w
        eta = np.where(ok, -s * eta, 0.0)
        go = ok & (after > 0)
        v, v_old, beta, ok = np.where(go, p / np.where(go, after, 1.0), 0.0), v, after, go
    return x


@dataclass
class Pairs:
    """Eigenvalues in falling order, unit eigenvectors as columns, norms of their residuals, products made."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray
    products: int


def jacobi_davidson(apply: Callable[[np.ndarray], np.ndarray], d: int, wanted: int, seed: int = 0) -> Pairs:
    """The `wanted` largest eigenpairs of a symmetric positive semidefinite map of d dimensions, known by its
    products with blocks of vectors alone.

    Each round: Rayleigh-Ritz in the search space; pairs whose residual is at rounding level (or has been
    near it and falls no more) are locked, largest first, and the search goes on beside them; for the
    others, and GUARD more, MINRES solves the correction equation, projected off the locked and the
    current vectors, which widens the space. It ends when all wanted pairs are locked and the next one is
    seen to be smaller."""
    made = 0

    def times(u: np.ndarray) -> np.ndarray:
        nonlocal made
        made += 1
        return apply(u)

    wanted = min(wanted, d)
    q, values = np.zeros((d, 0)), np.zeros(0)
    v = _orthonormal(np.random.default_rng(seed).normal(size=(d, min(d, 2 * (wanted + GUARD)))))
    w, best, still, rounds = times(v), np.inf, 0, 0
    while True:
        theta, y = np.linalg.eigh((v.T @ w + w.T @ v) / 2)
        theta, u, wu = theta[::-1], v @ y[:, ::-1], w @ y[:, ::-1]
        top = max([*values, *theta[:1]], default=0.0)
        level, full = 8 * EPSILON * math.sqrt(d) * abs(top), q.shape[1] + v.shape[1] == d
        active = min(wanted - len(values) + GUARD if len(values) < wanted else 1, len(theta))
        r = wu[:, :active] - u[:, :active] * theta[:active]
        size = np.linalg.norm(r, axis=0)
        if len(values) >= wanted and (not active or theta[0] + size[0] <= values.min() or size[0] <= level):
            if active and theta[0] > values.min() and size[0] <= level:  # it came late: it takes the smallest one's place
                q, values = np.concatenate([q, u[:, :1]], 1), np.append(values, theta[0])
            break
        still = 0 if not active or size[0] < best / 2 else still + 1
        best = min(best, size[0]) if active else best
        settled = full or (still >= 3 and best <= 1e3 * level)
        n = 0
        while n < active and len(values) + n < wanted and (size[n] <= level or (settled and size[n] <= max(1e3 * level, 2 * best))):
            n += 1
        if n:
            q, values, best, still = np.concatenate([q, u[:, :n]], 1), np.append(values, theta[:n]), np.inf, 0
            v, w = u[:, n:], wu[:, n:]
            if full and len(values) < wanted:
                continue
            if not v.shape[1]:
                break
            continue
        if full:
            break
        if v.shape[1] + active > SPACE * (wanted + GUARD):
            keep = 2 * (wanted + GUARD)
            v, w, u = u[:, :keep], wu[:, :keep], u[:, :keep]
        beside, shift, rounds = np.concatenate([q, u[:, :active]], 1), theta[:active], rounds + 1
        t = minres(lambda z: _outside(times(_outside(z, beside)) - _outside(z, beside) * shift, beside), -_outside(r, beside), 2.0**-rounds, min(4 + 2 * rounds, 16))
        more = _orthonormal(np.concatenate([t, r], 1) if not np.all(np.linalg.norm(t, axis=0)) else t, q, v)
        if not more.shape[1]:
            more = _orthonormal(np.random.default_rng(seed + rounds).normal(size=(d, 1)), q, v)
        v, w = np.concatenate([v, more], 1), np.concatenate([w, times(more)], 1)
    # a last Rayleigh-Ritz over all that were locked, with fresh products
    q = np.linalg.qr(q)[0]
    cq = times(q)
    theta, y = np.linalg.eigh((q.T @ cq + cq.T @ q) / 2)
    theta, u, cu = theta[::-1][:wanted], (q @ y[:, ::-1])[:, :wanted], (cq @ y[:, ::-1])[:, :wanted]
    u_sign = np.where(u[np.argmax(np.abs(u), axis=0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    return Pairs(np.maximum(theta, 0.0), u * u_sign, np.linalg.norm(cu - u * theta, axis=0), made)


# the vectors, in blocks


@dataclass
class Whitener:
    """blocks(vec_ids, x): the fit list, as whole numbers less OFFSET; n vectors of d dimensions with sums
    `sums` of these numbers, none larger than `most`; pairs of their covariance, whose trace is `trace`."""

    blocks: DataFrame
    n: int
    d: int
    sums: list[int]
    most: int
    pairs: Pairs | None = None
    trace: float = 0.0

    def rank(self) -> int:
        """Components that have any variance."""
        e = self.pairs.values
        return int((e > self.d * EPSILON * e[0]).sum()) if len(e) and e[0] > 0 else 0

    def scaled(self) -> np.ndarray:
        """What a centred vector is multiplied with."""
        k = self.rank()
        return self.pairs.vectors[:, :k] / np.sqrt(self.pairs.values[:k])


def _usable(vectors: DataFrame, vector_col: str) -> DataFrame:
    c = F.col(vector_col).cast("array<double>")
    top = F.lit(float(1 << 52))  # beyond it the number would be no long
    return vectors.select(F.col("vec_id"), c.alias("c")).where((F.size("c") > 0) & F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < top)))


def _blocks(rows: DataFrame, d: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = max(1, BLOCK // (8 * d))
        for b in batches:
            for k in range(0, len(b), size):
                own = b.iloc[k : k + size]
                x = np.floor(SCALE * np.stack(own.c.to_numpy()).astype(np.float64)).astype("<i8")
                ids = [None if pd.isna(i) else int(i) for i in own.vec_id.astype("Int64")]
                yield pd.DataFrame({"vec_ids": [ids], "x": [x.tobytes()]})

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "c").mapInPandas(run, "vec_ids array<bigint>, x binary")


def _wide(x: np.ndarray, bound: int) -> np.ndarray:
    """Whole numbers as 64 bits where nothing made from them exceeds these, or else of any length."""
    return x if bound < 1 << 62 else x.astype(object)


def _sums(blocks: DataFrame, d: int) -> tuple[int, list[int], int]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, most, total = 0, 0, [0] * d
        for b in batches:
            for octets in b.x:
                x = np.frombuffer(octets, "<i8").reshape(-1, d)
                n, most = n + len(x), max(most, int(np.abs(x).max()))
                total = [t + int(s) for t, s in zip(total, _wide(x, most * len(x)).sum(0), strict=True)]
        yield pd.DataFrame({"dim": np.arange(d), "n": n, "most": most, "total": [Decimal(t) for t in total]})

    made = blocks.mapInPandas(run, "dim int, n long, most long, total decimal(38,0)")
    rows = made.groupBy("dim").agg(F.sum("n").alias("n"), F.max("most").alias("most"), F.sum("total").cast("decimal(38,0)").alias("total")).orderBy("dim").collect()
    return rows[0]["n"], [int(r["total"]) for r in rows], rows[0]["most"]


def _centred(octets: bytes, n: int, d: int, sums: list[int], most: int) -> np.ndarray:
    """n times each vector less the sums: whole numbers, so that nothing is lost by centring."""
    kind = np.int64 if 2 * n * most < 1 << 62 else object
    return n * _wide(np.frombuffer(octets, "<i8").reshape(-1, d), 2 * n * most) - np.array(sums, kind)


def _summed(model: Whitener, one: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The sum of one(centred vectors) over all blocks: a partial sum for each task, PARTIALS at most to the driver."""
    n, d, sums, most = model.n, model.d, model.sums, model.most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, some = np.zeros(shape), False
        for b in batches:
            for octets in b.x:
                total, some = total + one(_centred(octets, n, d, sums, most).astype(np.float64) / n), True
        if some:
            task = TaskContext.get().partitionId()
            yield pd.DataFrame({"part": [task % PARTIALS], "task": [task], "total": [total.tobytes()]})

    def gathered(key: tuple[Any, ...], groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(shape)
        for g in groups:
            for octets in g.total:
                total = total + np.frombuffer(octets).reshape(shape)
        yield pd.DataFrame({"part": [key[0]], "total": [total.tobytes()]})

    made = model.blocks.select("x").mapInPandas(run, "part int, task int, total binary")
    rows = made.groupBy("part").applyInPandas(gathered, "part int, total binary").collect()
    return sum((np.frombuffer(r["total"]).reshape(shape) for r in sorted(rows, key=lambda r: r["part"])), np.zeros(shape))


def fit(vectors: DataFrame, components: int = COMPONENTS, vector_col: str = "embedding") -> Whitener | None:
    """The leading components of all usable vectors (see `whiten`); None where there is none.

    The covariance is never made: it is known by its products with a few vectors, X'(XU)/n of the centred
    X, each a job over the blocks whose partial sums are as large as U. What the driver holds are matrices
    of d rows and at most SPACE * (components + GUARD) columns."""
    rows = _usable(vectors, vector_col)
    sizes = rows.groupBy(F.size("c").alias("d")).agg(F.count("*").alias("c")).orderBy(F.col("c").desc(), F.col("d").desc()).first()
    if sizes is None:
        return None
    d = sizes["d"]
    blocks = materialise(_blocks(rows.where(F.size("c") == d), d), "vectors")
    n, sums, most = _sums(blocks, d)
    model = Whitener(blocks, n, d, sums, most)
    model.trace = float(_summed(model, lambda x: np.array([np.sum(x * x)]), (1,))[0]) / n

    def product(u: np.ndarray) -> np.ndarray:
        return _summed(model, lambda x: x.T @ (x @ u), u.shape) / n

    model.pairs = jacobi_davidson(product, d, components)
    return model


def identity_error(model: Whitener) -> float | None:
    """The largest entry of the whitened vectors' covariance less the identity; None without components."""
    k, scaled = model.rank(), model.scaled()
    if not k:
        return None
    mean = _summed(model, lambda x: (x @ scaled).sum(0), (k,)) / model.n

    def square(x: np.ndarray) -> np.ndarray:
        z = x @ scaled - mean
        return z.T @ z

    return float(np.abs(_summed(model, square, (k, k)) / model.n - np.eye(k)).max())


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, vector_col: str = "embedding") -> DataFrame:
    """For each usable row and component (vec_id, component, n, deviation, whitened, explained,
    identity_error): components are numbered from 1 by falling variance; deviation is the sum over the
    dimensions of (n x - S)^2 of whole numbers; whitened is the centred vector's part along the component
    over its standard deviation; explained the component's share of all variance.

    Left out are null and empty vectors, those with null or non-finite entries or entries of 2^52 or more,
    and those of another length than most have (the longer one of two as frequent). Null and repeated ids
    come back as often as read; a component without variance has null as whitened, as has deviation what
    no long can hold; with fewer dimensions than components there are as many as dimensions; an empty
    table gives an empty result; other columns aren't looked at."""
    model = fit(vectors, components, vector_col)
    if model is None:
        return vectors.sparkSession.createDataFrame([], _OUT)
    n, d, sums, most, k, scaled = model.n, model.d, model.sums, model.most, model.rank(), model.scaled()
    error, of = identity_error(model), len(model.pairs.values)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for ids, octets in zip(b.vec_ids, b.x, strict=True):
                x = _centred(octets, n, d, sums, most)
                z = (x.astype(np.float64) / n) @ scaled
                size = int(np.abs(x).max())
                squares = (_wide(x, d * size * size) ** 2).sum(1)
                yield pd.DataFrame(
                    {"vec_id": pd.array(list(ids), "Int64"), "deviation": pd.array([int(s) if s < 1 << 63 else None for s in squares], "Int64"), "z": [[*map(float, r), *[None] * (of - k)] for r in z]}
                )

    shares = F.array(*[F.lit(float(e / model.trace) if model.trace else None).cast("double") for e in model.pairs.values])
    made = model.blocks.mapInPandas(run, "vec_id long, deviation long, z array<double>").select("vec_id", "deviation", F.posexplode("z").alias("k", "whitened"))
    return made.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.element_at(shares, F.col("k") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
