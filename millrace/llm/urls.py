"""Url filters: host rules first, then a ratio of character language models.

The rules label the urls they fit; two Markov models over the characters of host and path, one of
accepted and one of rejected urls, judge the rest. Orders 0 to 3 are interpolated by the number
of different continuations a context has (Witten-Bell). A url's score is the mean log ratio of
its characters; the limit is the score at which accepted and rejected urls are told apart best.

Null urls and urls without ``://`` have an empty host and path, fit no rule and are allowed, as
is everything if the rules fit no url of one of the two kinds. Repeated rows count as often as
they occur and are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Symbols of the models: start, letters, any digit, signs, anything else. The bound on the size
# of a model, here 42 to the fourth power, doesn't depend on the data.
SIGNS = "abcdefghijklmnopqrstuvwxyz0./-_?=&#%:~+@"
SYMBOLS = len(SIGNS) + 2
ORDER = 3
BINS = 100  # score bins per unit, for the calibration
BIN_RANGE = 30 * BINS

Rule = tuple[str, str, str]  # verdict, host, path


def url_host(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """A struct of verdict and rule of the longest rule that fits, or null."""
    found = None
    for verdict, on, under in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(under)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(on + under).alias("rule"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def _codes(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return _SYMBOL_OF[raw]


def _symbol_table() -> np.ndarray:
    table = np.full(256, SYMBOLS - 1, np.int64)
    for i, sign in enumerate(SIGNS):
        table[ord(sign)] = table[ord(sign.upper())] = i + 1
    table[ord("0") : ord("9") + 1] = SIGNS.index("0") + 1
    return table


_SYMBOL_OF = _symbol_table()


def _grams(text: str) -> np.ndarray:
    """Each character with the three before it, as one number."""
    codes = np.concatenate([np.zeros(ORDER, np.int64), _codes(text)])
    n, grams = len(codes) - ORDER, 0
    for back in range(ORDER + 1):
        grams = grams * SYMBOLS + codes[back : back + n]
    return grams


def _smoothed(counts: np.ndarray) -> np.ndarray:
    """Log probability of each character in each context, from counts of grams."""
    full = counts.reshape((SYMBOLS,) * (ORDER + 1)).astype(float)
    chance = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(ORDER + 1):
        seen = full.sum(axis=tuple(range(ORDER - order)))
        kinds = (seen > 0).sum(-1, keepdims=True)
        total = seen.sum(-1, keepdims=True)
        mixed = (seen + np.maximum(kinds, 1) * chance) / (total + np.maximum(kinds, 1))
        chance = mixed
    return np.log(chance).reshape(-1)


def fit_url_models(labelled: DataFrame) -> np.ndarray:
    """Log ratio of accepted to rejected for each gram; rows are (address, accepted).

    Counts are gathered per task before the shuffle; at most two rows per possible gram come to
    the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, accepted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for kind in (True, False):
                found = [_grams(t) for t, a in zip(texts, accepted) if a is kind]
                if found:
                    grams, n = np.unique(np.concatenate(found), return_counts=True)
                    kinds = pa.array([kind] * len(grams))
                    yield pa.RecordBatch.from_arrays(
                        [kinds, pa.array(grams), pa.array(n)], ["accepted", "gram", "n"]
                    )

    rows = labelled.select("address", "accepted").mapInArrow(
        count, "accepted boolean, gram bigint, n bigint"
    )
    table = rows.groupBy("accepted", "gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((2, SYMBOLS ** (ORDER + 1)), np.int64)
    kind = np.array(table["accepted"].to_pylist(), bool).astype(int)
    counts[kind, table["gram"].to_numpy()] = table["n"].to_numpy()
    if not counts.any(axis=1).all():
        return np.zeros(counts.shape[1], np.float32)
    return (_smoothed(counts[1]) - _smoothed(counts[0])).astype(np.float32)


def url_score(df: DataFrame, address: Column, ratios: np.ndarray) -> Column:
    """Mean log ratio of the characters; 0 for an empty address."""
    shared = df.sparkSession.sparkContext.broadcast(ratios)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        table = shared.value
        means = [float(table[_grams(t)].mean(dtype=float)) if t else 0.0 for t in texts.to_pylist()]
        return pa.array(means, pa.float64())

    return score(address)


def calibrated_limit(scored: DataFrame) -> float:
    """The score from which a url is accepted; rows are (score, accepted).

    Chosen among the edges of fixed bins by the sum of both error rates, the smallest in absolute
    value if several are as good.
    """
    place = F.round(F.col("score") * BINS).cast("int")
    place = F.least(F.greatest(place, F.lit(-BIN_RANGE)), F.lit(BIN_RANGE))
    rows = scored.groupBy(place.alias("bin"), "accepted").count().collect()
    counts = np.zeros((2, 2 * BIN_RANGE + 2))
    for row in rows:
        counts[int(row["accepted"]), row["bin"] + BIN_RANGE] += row["count"]
    if not counts.any(axis=1).all():
        return -np.inf
    below = np.concatenate([np.zeros((2, 1)), counts.cumsum(1)], axis=1)[:, :-1]
    lost = below[1] / counts[1].sum()
    passed = 1 - below[0] / counts[0].sum()
    edges = (np.arange(lost.size) - BIN_RANGE - 0.5) / BINS
    errors = np.round(lost + passed, 12)
    best = np.flatnonzero(errors == errors.min())
    return float(edges[best[np.argmin(np.abs(edges[best]))]])


def filter_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """Every row with host, path, rule, score and verdict; columns of these names are replaced."""
    found = longest_rule(F.col("host"), F.col("path"), rules)
    parted = pages.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    ruled = parted.withColumn("rule", found)
    labelled = ruled.where("rule is not null").select(
        F.concat("host", "path").alias("address"),
        (F.col("rule.verdict") == "allow").alias("accepted"),
    )
    ratios = fit_url_models(labelled)
    limit = calibrated_limit(
        labelled.select(url_score(pages, F.col("address"), ratios).alias("score"), "accepted")
    )
    scored = ruled.withColumn("score", url_score(pages, F.concat("host", "path"), ratios))
    judged = (F.col("score") >= limit) | (F.concat("host", "path") == "")
    verdict = F.coalesce("rule.verdict", F.when(judged, "allow").otherwise("block"))
    return scored.withColumn("verdict", verdict).withColumn("rule", F.col("rule.rule"))
