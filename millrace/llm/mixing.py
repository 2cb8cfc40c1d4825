"""Mixing sources to target weights, in SQL functions only.

The words of each source are packed, documents one after the other, into blocks of fixed length.
Output slots are dealt to shards; the sources of a shard's slots are drawn at random without
replacement from the slots that the whole mix owes each source, so the counts per shard are
multinomial given the totals, and no source misses its target or passes its cap by chance. A
slot's number within its source goes through a pseudorandom permutation of the source's block
numbers, and blocks are joined by number. A source with more slots than blocks goes through its
blocks again.

Both permutations are swap-or-not shuffles keyed by seed and source, exact for any length, so the
mix is the same in every run and no sort is needed.

A null text has no words; a document without words is in no block and nothing of it is taken. A
null source is a source of its own, last in the order. Rows of the same id and size are
interchangeable. Without any words all targets are 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.rows import ROW, ids_are_keys, with_row_ids
from millrace.llm.storage import settled
from millrace.llm.words import word_count
from millrace.session import SHUFFLE_PARTITIONS_CONF

BLOCK = 128  # words
SHARD = 4096  # slots
CHUNK = 4096  # slots made by one row
ROUNDS = 24
SEED = 20


def permuted(x: Column, n: Column, key: Column, seed: int, back: bool = False) -> Column:
    """Position of ``x`` under a pseudorandom permutation of 0 to n - 1, or its inverse."""
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS)) if not back else F.sequence(F.lit(ROUNDS), F.lit(1))

    def step(at: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(seed), key, r), n) - at, n)
        swap = F.xxhash64(F.lit(seed + 1), key, r, F.greatest(at, partner)) % 2 == 0
        return F.when(swap, partner).otherwise(at)

    return F.aggregate(rounds, x.cast("bigint"), step)


def source_targets(
    sizes: DataFrame, weights: Sequence[int], share: float, most: float
) -> DataFrame:
    """Per source: number (in order), size, target. One row each, so windows over them are small.

    Targets are in proportion to the weights, which repeat along the sources, and sum to
    ``share`` of all sizes, but none is above ``most`` times its size: with sources ordered by
    size over weight, the capped ones come first, and the level at which the rest share what is
    left is the first that lies under the next cap.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.col("source_no"), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1).cast("double")
    numbered = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(order) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * F.lit(float(most)))
    )
    all_rows = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(all_rows) * share - F.coalesce(
        F.sum("cap").over(before), F.lit(0.0)
    )
    rest = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = left / rest
    levels = numbered.withColumn("level", level).withColumn(
        "fits", F.col("level") * F.col("weight") <= F.col("cap")
    )
    placed = levels.withColumn("place", F.row_number().over(by_cap))
    first = F.min(F.when(F.col("fits"), F.struct("place", "level"))).over(all_rows)
    target = F.coalesce(F.least(F.col("cap"), first["level"] * F.col("weight")), F.col("cap"))
    return placed.withColumn("target", target).select(
        "source", "source_no", "source_size", "target"
    )


def packed(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the place of their first word in their source's stream.

    Places are running sums in two steps, over chunks of a source's documents and inside them,
    with about as many chunks as documents in one, so that no source is summed in one task.
    """
    n_chunks = max(1, ceil(sqrt(docs.count())))
    same = F.col("d.source").eqNullSafe(F.col("s.source"))
    rows = docs.alias("d").join(sources.alias("s"), same).select(
        "d.*", "s.source_no", "s.source_size", "s.target"
    )
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)))
    inside = Window.partitionBy("source_no", "chunk").orderBy("doc_id", "size")
    rows = rows.withColumn("__row", F.row_number().over(inside)).withColumn(
        "__to", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    chunks = rows.groupBy("source_no", "chunk").agg(F.sum("size").alias("__words"))
    along = Window.partitionBy("source_no").orderBy("chunk")
    starts = chunks.select(
        "source_no",
        "chunk",
        (F.sum("__words").over(along) - F.col("__words")).alias("__from"),
    )
    return rows.join(starts, ["source_no", "chunk"]).withColumn(
        "start", F.col("__from") + F.col("__to") - F.col("size")
    )


def drawn_slots(sources: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix: (shard, slot, source_no, block), one row per slot.

    The slots owed to a source are its target over its mean block, at most two rounds of blocks
    where its target is at the cap.
    """
    blocks = F.ceil(F.col("source_size") / BLOCK)
    owed = F.round(F.col("target") * blocks / F.col("source_size")).cast("bigint")
    counted = sources.where("source_size > 0").select(
        "source_no", blocks.alias("blocks"), owed.alias("owed")
    )
    before = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumns(
        {
            "first": F.coalesce(F.sum("owed").over(before), F.lit(0)),
            "slots": F.sum("owed").over(Window.partitionBy()),
        }
    ).where("owed > 0")
    # A number of its own, or adaptive execution puts the few bytes of these rows into one task.
    n_chunks = counted.agg(F.sum(F.ceil(F.col("owed") / CHUNK))).first()[0] or 1
    most = int(counted.sparkSession.conf.get(SHUFFLE_PARTITIONS_CONF))
    chunks = counted.withColumn(
        "at", F.explode(F.sequence(F.lit(0), F.col("owed") - 1, F.lit(CHUNK)))
    ).repartition(min(most, int(n_chunks)), F.col("source_no"), F.col("at"))
    last = F.least(F.col("at") + CHUNK, F.col("owed")) - 1
    ranks = chunks.withColumn("rank", F.explode(F.sequence(F.col("at"), last)))
    draw = F.lit(-1)
    place = permuted(F.col("first") + F.col("rank"), F.col("slots"), draw, seed, back=True)
    key = F.col("source_no")
    block = permuted(F.pmod(F.col("rank"), F.col("blocks")), F.col("blocks"), key, seed + 2)
    return ranks.withColumn("__place", place).select(
        F.floor(F.col("__place") / SHARD).alias("shard"),
        F.pmod(F.col("__place"), F.lit(SHARD)).alias("slot"),
        "source_no",
        block.alias("block"),
    )


def pieces(rows: DataFrame) -> DataFrame:
    """Packed documents cut at the blocks' borders: block, first word and words of each piece."""
    first = F.floor(F.col("start") / BLOCK)
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK)
    cut = rows.where("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("start"), F.col("block") * BLOCK)
    end = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK)
    return cut.withColumns({"piece_from": begin - F.col("start"), "piece_words": end - begin})


def mixed_pieces(
    docs: DataFrame, weights: Sequence[int], share: float, most: float, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Packed documents, and their pieces with how many slots take each.

    ``docs`` has doc_id, source and size. Slots are counted per block before they are joined.
    """
    sizes = settled(docs.select("doc_id", "source", F.col("size").cast("bigint").alias("size")))
    sources = settled(source_targets(sizes, weights, share, most))
    rows = settled(packed(sizes, sources))
    wanted = drawn_slots(sources, seed).groupBy("source_no", "block").agg(
        F.count(F.lit(1)).alias("times")
    )
    return rows, pieces(rows).join(wanted, ["source_no", "block"])


def mixed_shards(
    docs: DataFrame, weights: Sequence[int], share: float, most: float, seed: int = SEED
) -> DataFrame:
    """The mix itself: (shard, slot, source_no, block, doc_id, piece_from, piece_words).

    Each slot of a shard has one block, found by its number, and a row for each piece of a document
    in the block. The slots of a shard are a draw without replacement from those owed to all
    sources, so the counts of sources in a shard vary as in such a draw and add up over the shards
    to what is owed. ``docs`` has doc_id, source and size, and its ids tell rows apart.
    """
    sizes = settled(docs.select("doc_id", "source", F.col("size").cast("bigint").alias("size")))
    sources = settled(source_targets(sizes, weights, share, most))
    cut = pieces(settled(packed(sizes, sources)))
    part = cut.select("source_no", "block", "doc_id", "piece_from", "piece_words")
    found = drawn_slots(sources, seed).join(part, ["source_no", "block"])
    return found.select("shard", "slot", *part.columns)


def shard_counts(slots: DataFrame) -> DataFrame:
    """(shard, source_no, n): the slots that each source has in each shard."""
    each = slots.select("shard", "slot", "source_no").distinct()
    return each.groupBy("shard", "source_no").agg(F.count(F.lit(1)).alias("n"))


def mixed_sizes(
    docs: DataFrame, weights: Sequence[int], share: float, most: float, seed: int = SEED
) -> DataFrame:
    """Per document: doc_id, size, source_size, target, and the words that the mix takes."""
    rows, cut = mixed_pieces(docs, weights, share, most, seed)
    key = ["source_no", "chunk", "__row", "doc_id", "size", "source_size", "target"]
    none = rows.select(*key, F.lit(0).cast("bigint").alias("words"))
    some = cut.select(*key, (F.col("piece_words") * F.col("times")).alias("words"))
    return (
        none.unionByName(some)
        .groupBy(*key)
        .agg(F.sum("words").alias("taken"))
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int],
    share: float,
    most: float,
    text: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """Documents with only the words that the mix takes, those of a block taken twice twice.

    Rows keep their columns; documents of which nothing is taken go, those without words among
    them. Rows are told apart also where ids are null or repeated, and each is a document. Words
    keep the white space that follows them.
    """
    keyed = with_row_ids(docs, "doc_id", text, ids_are_keys(docs, "doc_id"))
    sized = keyed.select(
        F.col(ROW).alias("doc_id"), "source", word_count(F.col(text)).alias("size")
    )
    _, cut = mixed_pieces(sized, weights, share, most, seed)
    piece = F.struct("piece_from", "piece_words", "times")
    taken = cut.groupBy("doc_id").agg(F.sort_array(F.collect_list(piece)).alias("__pieces"))
    ended = F.concat(F.coalesce(F.col(text), F.lit("")), F.lit(" "))
    spaced = F.regexp_extract_all(ended, F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]+"), F.lit(0))
    taken = taken.withColumnRenamed("doc_id", "__id")
    found = keyed.join(taken, F.col(ROW).eqNullSafe(F.col("__id")))
    words = found.withColumn("__words", spaced).withColumn("__all", F.size("__words"))

    def chosen(p: Column) -> Column:
        part = F.slice(
            F.col("__words"), (p["piece_from"] + 1).cast("int"), p["piece_words"].cast("int")
        )
        return F.repeat(F.array_join(part, ""), p["times"].cast("int"))

    mixed = F.rtrim(F.array_join(F.transform("__pieces", chosen), ""))
    return words.where("__all > 0").withColumn(text, mixed).select(*docs.columns)
