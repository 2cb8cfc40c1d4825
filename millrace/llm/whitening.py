"""Whitening of vectors by Golub-Kahan-Lanczos bidiagonalisation.

With C the rows of whole numbers less their means, the method builds orthonormal v (as long as a
row) and u (as long as the table) with ``C v_k = b_(k-1) u_(k-1) + a_k u_k`` and
``C' u_k = a_k v_k + b_k v_(k+1)``. The small matrix of the a and b has the singular values of C, and
its singular vectors turn the v into the components.

One pass over the rows makes one step. The u are never stored: each is C times a short vector w,
which the driver keeps, so a pass forms ``C w`` and the earlier u row by row and returns sums as long
as a row: ``C' u``, the products of u with all earlier u, and its square. From these sums the driver
takes u apart from the earlier u and the next v apart from the earlier v, both in full. The steps
end when the wanted components no longer change and what is left of the variance is too little to
hide another one, and after as many steps as a row has components in any case.

Rows whose vector is null, empty, or of another length than most (the longer one, if two lengths
are as frequent) take no part, nor do those with a null or non-finite entry. Directions without
variance are no components, so equal rows, or a single one, give nothing. Equal rows count as often
as they are there, and a null id is kept.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.search import whole_vectors
from millrace.llm.storage import stored

SETTLED = 1e-14  # of the largest singular value: a component's rest that counts as none
NIL = 1e-9  # of the largest singular value: a direction without variance
EXACT = 1 << 62  # products below this are exact in 64 bits


@dataclass
class Moments:
    """Number of rows and exact sums per place, with the mean as a whole number and a rest."""

    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.whole = np.array([round(s / self.n) for s in self.sums], np.int64)
        rest = [s - self.n * int(w) for s, w in zip(self.sums, self.whole)]
        self.rest = np.array([r / self.n for r in rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(float) - self.rest

    def deviations(self, x: np.ndarray) -> list[Decimal]:
        """Sum of (n x - sum) squared over each row, exactly."""
        sums = np.array(self.sums, object)
        widest = max(
            (abs(self.n * int(v) - s) for side in (x.min(0), x.max(0)) for v, s in zip(side, self.sums)),
            default=0,
        )
        if self.n * int(np.abs(x).max(initial=0)) < EXACT and widest**2 * x.shape[1] < EXACT:
            apart = self.n * x - sums.astype(np.int64)
            return [Decimal(int(d)) for d in (apart * apart).sum(axis=1)]
        apart = self.n * x.astype(object) - sums
        return [Decimal(sum(int(d) ** 2 for d in row)) for row in apart]


def fixed_point(embedding: Column, scale: int, offset: int) -> Column:
    """floor(scale * c) + offset of each entry as long; null if one is null or not finite."""
    return F.transform(whole_vectors(embedding, scale), lambda x: x + F.lit(offset))


def whitened(vectors: DataFrame, wanted: int = 8) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of rows (id, vec).

    ``vec`` is an array of longs. ``deviation`` is the exact sum of squares of n times the row less
    the column sums, a decimal. ``whitened`` is the centred row along the component over its
    standard deviation, ``explained`` the component's share of the variance, and ``identity_error``
    the largest entry by which the covariance of the whitened rows departs from the identity.
    Other columns are dropped.
    """
    spark = vectors.sparkSession
    out = (
        f"id {vectors.schema['id'].dataType.simpleString()}, component int, n bigint, "
        "deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    lengths = vectors.where(F.size("vec") > 0).groupBy(F.size("vec").alias("m")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("m")).first()
    if common is None:
        return spark.createDataFrame([], out)
    m = common["m"]
    rows = stored(vectors.where(F.size("vec") == m).select("id", "vec"))
    moments = column_sums(rows, m)
    spread, components, total = bidiagonalised(rows, moments, m, wanted)
    if not len(spread):
        return spark.createDataFrame([], out)
    deviations = spread / np.sqrt(moments.n)
    onto = components / deviations
    explained = spread**2 / total
    error = identity_error(rows, moments, onto)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(explained)
        for batch in batches:
            x = matrix(batch, m)
            if not len(x):
                continue
            each = np.repeat(np.arange(len(x)), k)
            deviation = pa.array(moments.deviations(x), pa.decimal128(38, 0))
            columns = {
                "id": batch.column("id").take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                "n": pa.array(np.full(len(x) * k, moments.n, np.int64)),
                "deviation": deviation.take(pa.array(each)),
                "whitened": pa.array((moments.centred(x) @ onto).ravel()),
                "explained": pa.array(np.tile(explained, len(x))),
                "identity_error": pa.array(np.full(len(x) * k, error)),
            }
            yield pa.RecordBatch.from_pydict(columns)

    return rows.mapInArrow(emit, out)


def matrix(batch: pa.RecordBatch, m: int) -> np.ndarray:
    values = batch.column("vec").flatten()
    return values.to_numpy(zero_copy_only=False).reshape(-1, m)


def totals(rows: DataFrame, m: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sums over all rows of what ``part`` makes of some of them, numbers or whole numbers.

    Each task adds up its own rows, and one task adds up the sums of the tasks.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = matrix(batch, m)
            if len(x):
                found = part(x)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [pickle.dumps(total)]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for one in batch.column("sums").to_pylist():
                total = pickle.loads(one) if total is None else total + pickle.loads(one)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"sums": [pickle.dumps(total)]})

    kind = "sums binary"
    found = rows.select("vec").mapInArrow(sums, kind).repartition(1).mapInArrow(add, kind)
    return pickle.loads(found.collect()[0]["sums"])


def column_sums(rows: DataFrame, m: int) -> Moments:
    def part(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x)], x.sum(axis=0)]).astype(object)  # exact at any size

    n, *sums = totals(rows, m, part)
    return Moments(int(n), [int(s) for s in sums])


def bidiagonalised(
    rows: DataFrame, moments: Moments, m: int, wanted: int
) -> tuple[np.ndarray, np.ndarray, float]:
    """Singular values of the centred rows, components as columns, and the sum of all squares."""
    random = np.random.default_rng(12)
    along = np.zeros((m, m))  # v as columns
    short = np.zeros((m, m))  # w, with C w = u
    back = np.zeros((m, m))  # C' u
    small = np.zeros((m, m))
    v, step, beta, total, steps = apart(random.normal(size=m), along), 0, 0.0, 0.0, 0

    for step in range(m):
        along[:, step] = v
        w = v - beta * short[:, step - 1] if step else v
        onto = np.column_stack([short, w])

        def part(x: np.ndarray) -> np.ndarray:
            c = moments.centred(x)
            u = c @ onto
            squares = [np.einsum("ij,ij->", c, c)]
            return np.concatenate([c.T @ u[:, m], u.T @ u[:, m], squares])

        found = totals(rows, m, part)
        g, h, square, total = found[:m], found[m : 2 * m], found[2 * m], found[2 * m + 1]
        tiny = 1e-13 * np.sqrt(total)
        w, g = w - short @ h, g - back @ h
        alpha = np.sqrt(max(square - h @ h, 0.0))
        steps = step + 1
        if alpha > tiny:
            small[step, step] = alpha
            short[:, step], back[:, step] = w / alpha, g / alpha
            ahead = apart(back[:, step] - alpha * v, along, keep_length=True)
            beta = float(np.linalg.norm(ahead))
        else:
            beta = 0.0
        if steps == m or settled_by(small[:steps, :steps], beta, total, wanted):
            break
        if beta > tiny:
            v = apart(ahead / beta, along)
        else:  # all that can be reached from the start is found: go on from another one
            beta, v = 0.0, apart(random.normal(size=m), along)
        small[step, step + 1] = beta

    _, values, right = np.linalg.svd(small[:steps, :steps])
    kept = values[:wanted] > NIL * values[0] if values[0] > 0 else np.zeros(0, bool)
    values, right = values[: len(kept)][kept], right[: len(kept)][kept]
    components = along[:, :steps] @ right.T
    signs = np.sign(components[np.abs(components).argmax(axis=0), np.arange(len(values))])
    return values, components * signs, float(total)


def apart(v: np.ndarray, along: np.ndarray, keep_length: bool = False) -> np.ndarray:
    """The vector less its share in earlier ones, taken off twice, with length one unless kept."""
    for _ in range(2):
        v = v - along @ (along.T @ v)
        if not keep_length:
            v = v / np.linalg.norm(v)
    return v


def settled_by(small: np.ndarray, beta: float, total: float, wanted: int) -> bool:
    """Whether the wanted components are found, and no other can be as large as the least of them."""
    if len(small) < wanted:
        return False
    left, values, _ = np.linalg.svd(small)
    rest = beta * np.abs(left[-1, :wanted])
    hidden = total - float((values**2).sum())
    return bool(rest.max() <= SETTLED * values[0] and hidden < values[wanted - 1] ** 2)


def identity_error(rows: DataFrame, moments: Moments, onto: np.ndarray) -> float:
    """Largest entry of the covariance of the whitened rows, less the identity."""
    m, k = onto.shape

    def part(x: np.ndarray) -> np.ndarray:
        y = moments.centred(x) @ onto
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    found = totals(rows, m, part) / moments.n
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    return float(np.abs(covariance - np.eye(k)).max())
