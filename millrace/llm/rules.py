"""Quality rules in SQL functions only: plain counts, and a ratio of hashed n-gram models.

Word and word-pair hashes fall into a fixed number of buckets. Two multinomials over the buckets
are counted, one of the trusted documents and one of the whole corpus. A document's score is the
mean log ratio of its n-grams, and it is kept from a fixed limit on. Ratios are whole micro-nats,
so sums don't depend on the order of rows and every run gives the same verdicts.

Null texts count as empty; a text without words has score 0. Without trusted documents all
ratios are those of the smoothing alone. Repeated rows are judged alike.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import WHITE, without, words_of

BUCKETS = 1 << 16  # the model's size, whatever the corpus
SMOOTHING = 1.0
LIMIT = -0.08  # nats per n-gram
MICRO = 1_000_000
SYMBOLS = "#*$%&|<>"


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def pair_hashes(hashes: str) -> Column:
    """A hash for each two neighbours, from a column of word hashes."""
    n = F.size(hashes)
    firsts = F.slice(hashes, 1, F.greatest(n - 1, F.lit(0)))
    seconds = F.slice(hashes, 2, F.greatest(n, F.lit(1)))
    return F.zip_with(firsts, seconds, lambda a, b: F.xxhash64(a, b))


def gram_buckets(hashes: str, pairs: str) -> Column:
    """Buckets of all words and pairs of neighbours."""
    return F.transform(
        F.concat(hashes, pairs), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int")
    )


def base_counts(df: DataFrame, text: str, hashes: str, pairs: str) -> DataFrame:
    """Adds the counts of the plain rules, from the text and its hashes.

    Three words in a row are told apart by a hash of 64 bits.
    """
    t, n = F.coalesce(F.col(text), F.lit("")), F.size(hashes)
    lines = F.filter(F.split(t, "\n", -1), lambda line: F.length(F.btrim(line, F.lit(WHITE))) > 0)
    triples = F.zip_with(
        F.slice(pairs, 1, F.greatest(n - 2, F.lit(0))),
        F.slice(hashes, 3, F.greatest(n, F.lit(1))),
        lambda a, b: F.xxhash64(a, b),
    )
    counted = df.withColumns(
        {
            "n_words": n.cast("bigint"),
            "word_chars": F.length(without(F.col(text), WHITE)).cast("bigint"),
            "n_symbols": (F.length(t) - F.length(without(F.col(text), SYMBOLS))).cast("bigint"),
            "__lines": lines,
            "__triples": F.slice(triples, 1, F.greatest(n - 2, F.lit(0))),
        }
    )
    # A window found twice stands next to its copy once windows are sorted by their hash.
    ordered = F.sort_array(
        F.transform("__triples", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    repeats = F.size(F.array_distinct("__triples")) < F.size("__triples")
    counted = counted.withColumns(
        {
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
            "__ordered": F.when(repeats, ordered),
        }
    )
    o = F.col("__ordered")
    twice = F.filter(
        o,
        lambda x, i: F.get(o, i - 1)["h"].eqNullSafe(x["h"])
        | F.get(o, i + 1)["h"].eqNullSafe(x["h"]),
    )
    covered = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    repeated = F.when(o.isNull(), 0).otherwise(F.size(F.array_distinct(covered)))
    return counted.withColumn("n_repeat_words", repeated.cast("bigint")).drop(
        "__lines", "__triples", "__ordered"
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def with_hashes(df: DataFrame, text: str) -> DataFrame:
    hashed = df.withColumn("__hashes", word_hashes(words_of(F.col(text))))
    return hashed.withColumn("__pairs", pair_hashes("__hashes"))


def gram_ratios(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str) -> list[int]:
    """The model: the log ratio of each bucket, in micro-nats.

    ``trusted`` holds the ids of the target's documents. Texts are dealt out by id once, beside
    the ids, and counts are added up per task before they are exchanged. One row per bucket
    comes to the driver.
    """
    target = trusted.select(F.col(doc_id).alias("__id"), F.lit(1).alias("__in")).distinct()
    marked = docs.select(doc_id, text).join(
        target.hint("shuffle_hash"), F.col(doc_id) == F.col("__id"), "left"
    )
    hashed = with_hashes(marked, text)
    grams = hashed.select("__in", F.explode(gram_buckets("__hashes", "__pairs")).alias("bucket"))
    rows = (
        grams.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("__in").alias("target"))
        .collect()
    )
    raw, aimed = [SMOOTHING] * BUCKETS, [SMOOTHING] * BUCKETS
    for row in rows:
        raw[row["bucket"]] += row["raw"]
        aimed[row["bucket"]] += row["target"]
    gap = log(sum(raw)) - log(sum(aimed))
    return [round((log(a) - log(r) + gap) * MICRO) for a, r in zip(aimed, raw)]


def judge_quality(
    docs: DataFrame,
    trusted: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: float = LIMIT,
) -> DataFrame:
    """One row per document: id, counts of the plain rules, their verdict, score and verdict.

    The model is part of the expression, one number per bucket, so documents are judged where
    they are read.
    """
    ratios = gram_ratios(docs, trusted, doc_id, text)
    model = F.from_json(F.lit(str(ratios)), "array<bigint>")  # a constant: read once
    hashed = with_hashes(docs.select(doc_id, text), text)
    counted = base_counts(hashed, text, "__hashes", "__pairs").withColumn(
        "__grams", gram_buckets("__hashes", "__pairs")
    )
    zero = F.lit(0).cast("bigint")
    total = F.aggregate("__grams", zero, lambda s, g: s + F.get(model, g))
    mean = F.when(F.size("__grams") > 0, total / F.size("__grams") / MICRO).otherwise(0.0)
    return (
        counted.withColumn("score", mean)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= limit))
        .drop(text, "__hashes", "__pairs", "__grams")
    )
