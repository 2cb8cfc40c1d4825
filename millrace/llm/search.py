"""Exact top-k by inner product with vector-approximation files.

Vectors are whole numbers; each component falls into one of 64 cells. A scan of the cells, in
blocks of queries against blocks of vectors, bounds every score from both sides; a vector stays a
candidate if its upper bound reaches the k-th best lower bound of its query. Exact vectors are
then read in the order of their bounds: a first round reads the most promising, and the k-th
exact score says which of the rest can still matter; only these are read in the second round.

Equal vectors are one class with its smallest ids, as many as can be asked for, so copies are
compared once. Vectors that are null or hold a null, NaN or infinity take no part; vectors of
different lengths aren't compared. Rows of the same id and vector count once; a query is never
answered with its own id. Ties go to the smaller id. Components must stay within 64 bits after
scaling, and so must scores.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.storage import settled

CELLS = 64
VECTORS = 8192  # vectors in a block, on average
QUERIES = 1024  # queries in a block, on average
FIRST_READ = 12  # candidates of a query that the first round reads


def whole_vectors(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of each component as long; null if a component is null or not finite."""
    finite = F.forall(
        embedding,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    return F.when(finite, whole.cast("array<bigint>"))


def vector_classes(vectors: DataFrame, k: int) -> DataFrame:
    """(class, vec, ids) of rows (id, vec): distinct vectors with their k + 1 smallest ids."""
    order = Window.partitionBy("vec").orderBy("id")
    few = vectors.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k + 1)
    ids = F.sort_array(F.collect_set("id"))
    classes = few.groupBy("vec").agg(ids.alias("ids"))
    return classes.select(class_of("vec").alias("class"), "vec", "ids")


def class_of(vec: str) -> Column:
    """A key of equal vectors, of 128 bits."""
    return F.concat_ws(":", F.xxhash64(vec), F.xxhash64(F.lit(1), vec))


def _scan(approximations: pa.Table, queries: pa.Table, low: int, width: int, k: int) -> pa.Table:
    names = ["query", "class", "lower", "upper"]
    kinds = [pa.string(), pa.string(), pa.float64(), pa.float64()]
    if not approximations.num_rows or not queries.num_rows:
        return pa.table([pa.array([], t) for t in kinds], names=names)
    raw = b"".join(approximations["codes"].to_pylist())
    codes = np.frombuffer(raw, np.uint8).reshape(approximations.num_rows, -1)
    corners = low + codes.astype(float) * width
    asked = np.array(queries["vec"].to_pylist(), float).reshape(queries.num_rows, -1)
    most = np.abs(corners).max(initial=0) + width
    # Sums of doubles are exact up to 2 ** 53; beyond, bounds give way by the error possible.
    size = corners.shape[1] * np.abs(asked).max(initial=0) * most
    slack = 0.0 if size < 2**52 else size * 1e-12
    out = []
    for start in range(0, len(asked), 128):
        part = asked[start : start + 128]
        base = part @ corners.T
        upper = base + (width - 1) * np.maximum(part, 0).sum(1, keepdims=True) + slack
        lower = base + (width - 1) * np.minimum(part, 0).sum(1, keepdims=True) - slack
        n = min(k, lower.shape[1])
        kth = np.partition(lower, lower.shape[1] - n, axis=1)[:, lower.shape[1] - n]
        at, found = np.nonzero(upper >= kth[:, None])
        out.append((at + start, found, lower[at, found], upper[at, found]))
    at, found, lower, upper = (np.concatenate(x) for x in zip(*out))
    return pa.table(
        [
            queries["class"].take(pa.array(at)),
            approximations["class"].take(pa.array(found)),
            pa.array(lower),
            pa.array(upper),
        ],
        names=names,
    )


def candidates(classes: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query, class, upper) of all that can be among the k best, from the cells alone."""
    spread = classes.agg(
        F.min(F.array_min("vec")), F.max(F.array_max("vec")), F.count(F.lit(1))
    ).first()
    low, high, n = spread[0] or 0, spread[1] or 0, spread[2]
    width = (high - low) // CELLS + 1
    n_vectors = max(1, ceil(n / VECTORS))
    n_queries = max(1, ceil(asked.count() / QUERIES))

    @F.arrow_udf("binary")
    def cells(vectors: pa.Array) -> pa.Array:
        rows = [
            ((np.array(v, np.int64) - low) // width).astype(np.uint8).tobytes()
            for v in vectors.to_pylist()
        ]
        return pa.array(rows, pa.binary())

    def everywhere(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    approximations = classes.select(
        "class",
        cells("vec").alias("codes"),
        F.size("vec").alias("length"),
        F.pmod(F.xxhash64("class"), F.lit(n_vectors)).alias("part"),
        everywhere(n_queries).alias("turn"),
    )
    queries = asked.select(
        "class",
        "vec",
        F.size("vec").alias("length"),
        everywhere(n_vectors).alias("part"),
        F.pmod(F.xxhash64("class"), F.lit(n_queries)).alias("turn"),
    )
    key = ["length", "part", "turn"]
    scanned = (
        approximations.groupBy(*key)
        .cogroup(queries.groupBy(*key))
        .applyInArrow(
            lambda a, q: _scan(a, q, low, width, k),
            "query string, class string, lower double, upper double",
        )
    )
    scanned = settled(scanned)
    best = Window.partitionBy("query").orderBy(F.col("lower").desc())
    kth = (
        scanned.select("query", "lower")
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .groupBy("query")
        .agg(F.min("lower").alias("kth"), F.count(F.lit(1)).alias("n"))
    )
    kept = scanned.join(kth, "query").where((F.col("n") < k) | (F.col("upper") >= F.col("kth")))
    return kept.select("query", "class", "upper")


def read_exact(found: DataFrame, classes: DataFrame, asked: DataFrame) -> DataFrame:
    """(query, score, ids) of candidates, from the exact vectors."""
    dot = F.aggregate(
        F.zip_with("vec", "query_vec", lambda a, b: a * b), F.lit(0).cast("bigint"), lambda s, x: s + x
    )
    queries = asked.select(F.col("class").alias("query"), F.col("vec").alias("query_vec"))
    return (
        found.join(classes, "class")
        .join(queries, "query")
        .select("query", dot.alias("score"), "ids")
    )


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score) of the k best for each query; both have (id, vec)."""
    vectors = vectors.where("vec is not null and id is not null")
    classes = settled(vector_classes(vectors, k))
    keyed = settled(
        queries.where("vec is not null and id is not null")
        .select(F.col("id").alias("query_id"), class_of("vec").alias("query"), "vec")
        .distinct()
    )
    asked = settled(keyed.select(F.col("query").alias("class"), "vec").distinct())
    most = k + 1  # the query's own class may take one place
    promising = Window.partitionBy("query").orderBy(F.col("upper").desc(), "class")
    found = settled(
        candidates(classes, asked, most).withColumn("turn", F.row_number().over(promising))
    )
    first = settled(read_exact(found.where(F.col("turn") <= FIRST_READ), classes, asked))
    best = Window.partitionBy("query").orderBy(F.col("score").desc())
    certain = (
        first.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") == most)
        .select("query", F.col("score").alias("certain"))
    )
    later = found.where(F.col("turn") > FIRST_READ).join(certain, "query", "left")
    later = later.where("certain is null or upper >= certain").select("query", "class")
    exact = first.unionByName(read_exact(later, classes, asked))
    rows = exact.select("query", "score", F.explode("ids").alias("id"))
    top = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    few = rows.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= most)
    own = few.drop("rank").join(keyed.select("query", "query_id"), "query")
    own = own.where(F.col("id") != F.col("query_id"))
    answer = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = own.withColumn("rank", F.row_number().over(answer)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
