"""The trie of conversation prefixes, grouped exactly where a count-min sketch can't rule it out.

Every prefix of a conversation has a digest of 128 bits, an exclusive or over hashes of its turns
and their places, so digests are running aggregates. A count-min sketch of all digests, built in
each task and added up, never counts a prefix too low: an estimate of one proves that no other
conversation has it. From there on the conversation is alone; its nodes are written where they are.
Only prefixes that may be shared are shuffled, as 60 bytes without texts, and grouped.

A node is named by its smallest member, its ``rep``. Along a conversation m the reps change to m at
some depth and stay, so with t(m) that depth, and q(m) the characters of m's first t(m) - 1 turns,
what a node says of its subtree is a sum over its members: one leaf for each m that is the rep of a
childless end, one child for each m with t(m) at most one deeper, and as saved characters the q(m)
of all members but the rep, less what lies above the node. No recursion, whatever the depth.

Rows without a conversation id take no part, null roles and texts are empty. Turns are ordered by
``turn``, null first, and where it is equal by an md5 of role and text; repeated rows are turns of
their own. Other columns are dropped. No rows give no nodes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.storage import stored

LONG_TURNS = 1 << 16  # turns of a conversation from which it is dealt over tasks
SLICES = 64  # ranges of turns that a long conversation is cut into
SKETCH_ROWS = 4
SKETCH_CELLS = 1 << 22  # cells of a row at most: 16 MB in a task, 2 MB broadcast
STRIPE = 1 << 16  # cells that are shuffled together
HEAVY_SHARE = 1000  # a node of more than this part of all prefixes is joined by broadcast
NODE = ["x", "y", "depth"]
COLUMNS = [
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
]


# Turns and rebuilt conversations


def turn_digests(conversations: DataFrame) -> DataFrame:
    """(conv, turn, digest, chars): each turn's md5 of role and text, and its text's code points."""
    role, text = (F.coalesce(n, F.lit("")) for n in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where(F.col("conv_id").isNotNull())
    return rows.select(
        F.col("conv_id").cast("bigint").alias("conv"),
        "turn",
        F.unhex(F.md5(whole.cast("binary"))).alias("digest"),
        F.length(text).cast("bigint").alias("chars"),
    )


def rebuilt_prefixes(
    turns: DataFrame, block: int = 100, kinds: int = 6, long_turns: int = LONG_TURNS
) -> DataFrame:
    """Prefixes of conversations that begin with turns of the first one of their block.

    Conversation c takes the first h turns of conversation c - c % ``block`` in place of its own
    first h, with h the crc32 of c's decimal digits modulo ``kinds``. ``turns`` are turn digests.
    """
    turns = stored(turns)
    counts = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    digits = F.col("conv").cast("string").cast("binary")
    start = F.col("conv") - F.col("conv") % block
    whole = counts.select("conv", "own", start.alias("block"), (F.crc32(digits) % kinds).alias("h"))

    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "digest")
    heads = turns.where(F.col("conv") % block == 0)
    heads = heads.withColumn("depth", F.row_number().over(order).cast("bigint"))
    heads = _lanes(heads.where(F.col("depth") < kinds).withColumnRenamed("conv", "block"))
    sums = Window.partitionBy("block").orderBy("depth")
    heads = heads.select("block", "depth", "px", "py", "chars", *_running(sums))
    heads = _parents(heads)
    step = F.struct("depth", "x", "y", "px", "py", "upto", "chars")
    heads = heads.groupBy("block").agg(F.sort_array(F.collect_list(step)).alias("steps"))

    there = F.when(F.col("steps").isNull(), 0).otherwise(F.size("steps"))
    taken = F.least("h", there).cast("bigint")
    none = F.array().cast(heads.schema["steps"].dataType)
    whole = whole.join(heads, "block", "left").select(
        "conv",
        "h",
        taken.alias("taken"),
        F.when(taken > 0, F.slice("steps", 1, taken.cast("int"))).otherwise(none).alias("steps"),
        (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"),
    )
    zero = F.lit(0).cast("bigint")
    parts = ["conv", "depth", "x", "y", "px", "py", "upto", "chars", "length"]
    roots = whole.select("conv", "length", *[zero.alias(n) for n in parts[1:-1]])
    begun = whole.select("conv", "length", F.inline("steps"))
    last = F.get("steps", (F.col("taken") - 1).cast("int"))
    ends = whole.select(
        "conv", "h", "taken", "length", *[F.coalesce(last[n], zero).alias(f"b{n}") for n in ("x", "y", "upto")]
    )
    own = _own_prefixes(turns, counts, ends, long_turns)
    return reduce_union([frame.select(*parts) for frame in (roots, begun, own)])


def reduce_union(frames: list[DataFrame]) -> DataFrame:
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union


def _own_prefixes(
    turns: DataFrame, counts: DataFrame, ends: DataFrame, long_turns: int
) -> DataFrame:
    """Prefixes that end in a conversation's own turn, behind those it takes from another."""
    long = counts.where(F.col("own") > long_turns).select("conv")
    paged = not long.isEmpty()
    rows = _with_slices(turns, long) if paged else turns
    keys = ["conv", "slice"] if paged else ["conv"]
    order = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("turn"), "digest")
    rows = rows.withColumn("place", F.row_number().over(order).cast("bigint"))
    if paged:
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        rows = rows.join(_before(sizes, {"n": F.sum}), keys)
        rows = rows.withColumn("place", F.col("place") + F.col("n")).drop("n")
    rows = rows.join(ends, "conv").where(F.col("place") > F.col("h"))
    rows = _lanes(rows.withColumn("depth", F.col("place") - F.col("h") + F.col("taken")))
    running = Window.partitionBy(*keys).orderBy("depth")
    summed = rows.select("*", *_running(running))
    if paged:
        rows = stored(rows)
        summed = rows.select("*", *_running(running))
        parts = {"x": F.bit_xor("px"), "y": F.bit_xor("py"), "upto": F.sum("chars")}
        sums = rows.groupBy(*keys).agg(*[value.alias(f"o{n}") for n, value in parts.items()])
        opening = _before(sums, {"ox": F.bit_xor, "oy": F.bit_xor, "oupto": F.sum})
        summed = summed.join(opening, keys)
    else:
        summed = summed.withColumns({n: F.lit(0).cast("bigint") for n in ("ox", "oy", "oupto")})
    for n in ("x", "y"):
        value = F.col(n).bitwiseXOR(F.col(f"o{n}")).bitwiseXOR(F.col(f"b{n}"))
        summed = summed.withColumn(n, value)
    upto = F.col("upto") + F.col("oupto") + F.col("bupto")
    return _parents(summed.withColumn("upto", upto))


def _parents(prefixes: DataFrame) -> DataFrame:
    """Digests of the prefixes one turn shorter, in place of the last turn's own hashes."""
    return prefixes.withColumns(
        {p: F.col(n).bitwiseXOR(F.col(p)) for n, p in (("x", "px"), ("y", "py"))}
    )


def _with_slices(turns: DataFrame, long: DataFrame) -> DataFrame:
    """Turns with the number of their slice: ranges of equal size in a long conversation, else 0."""
    shares = [i / SLICES for i in range(SLICES)]
    cuts = turns.join(long, "conv", "left_semi").groupBy("conv")
    cuts = cuts.agg(F.array_distinct(F.percentile_approx("turn", shares)).alias("cuts"))
    at = F.col("turn")
    number = F.size(F.filter("cuts", lambda cut: cut <= at))
    dealt = turns.join(cuts, "conv", "left")
    return dealt.withColumn("slice", F.coalesce(F.when(F.col("cuts").isNotNull(), number), F.lit(0))).drop("cuts")


def _before(sums: DataFrame, columns: dict) -> DataFrame:
    """What the earlier slices of a conversation come to; zero in the first."""
    earlier = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    return sums.select(
        "conv",
        "slice",
        *[F.coalesce(add(n).over(earlier), zero).cast("bigint").alias(n) for n, add in columns.items()],
    )


def _lanes(turns: DataFrame) -> DataFrame:
    """Two hashes of a turn at its depth, for now under the names of the parent's digest."""
    return turns.withColumns(
        {n: F.xxhash64(F.lit(i), F.col("depth"), F.col("digest")) for i, n in ((1, "px"), (2, "py"))}
    )


def _running(window) -> list[Column]:
    """Digest and characters of the prefix that ends in a row."""
    rows = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return [
        F.bit_xor("px").over(rows).alias("x"),
        F.bit_xor("py").over(rows).alias("y"),
        F.sum("chars").over(rows).alias("upto"),
    ]


# The sketch


def cells_of(x: np.ndarray, y: np.ndarray, bits: int) -> np.ndarray:
    """The cell of each digest in each row of a sketch of 2 ** bits cells a row, numbered through."""
    shift = np.uint64(64 - bits)
    lanes = [
        lane.astype(np.int64).view(np.uint64) * np.uint64(factor)
        for factor in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
        for lane in (x, y)
    ]
    return np.stack([(h >> shift) + (np.uint64(r) << np.uint64(bits)) for r, h in enumerate(lanes)])


def sketch(prefixes: DataFrame, bits: int) -> np.ndarray:
    """Bits of the cells of a count-min sketch that count two or more; its counters stop at two."""
    size = SKETCH_ROWS << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, any_row = np.zeros(size, np.uint8), False
        for batch in batches:
            x, y = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("x", "y"))
            for row in cells_of(x, y, bits):
                cells, times = np.unique(row.astype(np.int64), return_counts=True)
                counts[cells] = np.minimum(2, counts[cells] + np.minimum(2, times))
            any_row = any_row or len(x) > 0
        if any_row:
            for i, start in enumerate(range(0, size, STRIPE)):
                part = counts[start : start + STRIPE]
                if part.any():
                    yield stripe(i, part)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, packed in zip(*(batch.column(n).to_pylist() for n in ("stripe", "counts"))):
                part = np.frombuffer(zlib.decompress(packed), np.uint8)
                sums[i] = np.minimum(2, sums[i] + part) if i in sums else part
        for i, part in sums.items():
            yield stripe(i, part)

    kind = "stripe int, counts binary"
    parts = prefixes.where("depth > 0").select("x", "y").mapInArrow(count, kind)
    merged = parts.repartition("stripe").mapInArrow(add, kind).collect()
    often = np.zeros(size, bool)
    for row in merged:
        part = np.frombuffer(zlib.decompress(row["counts"]), np.uint8)
        often[row["stripe"] * STRIPE :][: len(part)] = part > 1
    return np.packbits(often)


def stripe(number: int, counts: np.ndarray) -> pa.RecordBatch:
    packed = zlib.compress(counts.astype(np.uint8).tobytes(), 1)
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([packed], pa.binary())], ["stripe", "counts"]
    )


def screen(prefixes: DataFrame, bits: int) -> DataFrame:
    """Prefixes with ``alone``, proven to be of one conversation, and the same of their parents."""
    shared = prefixes.sparkSession.sparkContext.broadcast(sketch(prefixes, bits))

    @F.arrow_udf("boolean")
    def proven(x: pa.Array, y: pa.Array) -> pa.Array:
        cells = cells_of(
            x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False), bits
        ).astype(np.int64)
        often = (shared.value[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1
        return pa.array((often == 0).any(axis=0))

    marked = prefixes.withColumns({"_own": proven("x", "y"), "_parent": proven("px", "py")})
    parent = (F.col("depth") > 1) & F.col("_parent")
    return marked.withColumns(
        {"alone": (F.col("depth") > 0) & (F.col("_own") | parent), "parent_alone": parent}
    ).drop("_own", "_parent")


# Nodes


def trie_nodes(prefixes: DataFrame, sketch_cells: int = SKETCH_CELLS) -> DataFrame:
    """One row per distinct prefix, the empty one included, with ``COLUMNS``."""
    prefixes = stored(prefixes)
    total = prefixes.count()
    bits = max(8, min((2 * max(1, total) - 1).bit_length(), sketch_cells.bit_length() - 1))
    screened = screen(prefixes, bits)
    maybe = stored(screened.where(~F.col("alone")).drop("alone", "parent_alone", "px", "py"))
    members = stored(_with_nodes(maybe))
    convs = _conversations(members)
    nodes = _shared_nodes(members, convs)
    alone = screened.where("alone")
    tails = alone.where("parent_alone").withColumn("parent_conv_id", F.col("conv"))
    tops = alone.where(~F.col("parent_alone")).join(convs.select("conv", "t", "above"), "conv")
    own = F.col("depth") > F.col("t")
    tops = tops.withColumn("parent_conv_id", F.when(own, F.col("conv")).otherwise(F.col("above")))
    return reduce_union([nodes, _lone_nodes(tails), _lone_nodes(tops)])


def _with_nodes(maybe: DataFrame) -> DataFrame:
    """Possibly shared prefixes with their node's rep, members and ends."""
    ends = F.col("depth") == F.col("length")
    nodes = stored(
        maybe.groupBy(*NODE).agg(
            F.min("conv").alias("rep"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(ends).alias("n_ends"),
        )
    )
    total = nodes.agg(F.sum("n")).first()[0] or 0
    often = max(64, total // HEAVY_SHARE)
    # At most HEAVY_SHARE nodes, as their members are rows of the total.
    heavy = F.broadcast(nodes.where(F.col("n") > often))
    light = nodes.where(F.col("n") <= often)
    hot = maybe.join(heavy, NODE)
    cold = maybe.join(heavy.select(*NODE), NODE, "left_anti").join(light, NODE)
    return hot.unionByName(cold).drop("x", "y")


def _conversations(members: DataFrame) -> DataFrame:
    """Of each conversation: where it begins to be the rep (t), the rep above, q, and if it is a leaf."""
    other = F.when(F.col("rep") != F.col("conv"), F.struct("depth", "rep", "upto"))
    at_end = F.when(
        F.col("depth") == F.col("length"),
        (F.col("rep") == F.col("conv")) & (F.col("n") == F.col("n_ends")),
    )
    found = members.groupBy("conv").agg(F.max(other).alias("o"), F.max(at_end).alias("leaf"))
    return found.select(
        "conv",
        F.coalesce(F.col("o.depth") + 1, F.lit(0)).alias("t"),
        F.col("o.rep").alias("above"),
        F.coalesce("o.upto", F.lit(0)).alias("q"),
        F.coalesce("leaf", F.lit(True)).alias("leaf"),  # its end is proven to be its own
    )


def _shared_nodes(members: DataFrame, convs: DataFrame) -> DataFrame:
    rows = members.join(convs, "conv")
    is_rep = F.col("conv") == F.col("rep")
    below = (F.col("t") <= F.col("depth") + 1) & (F.col("length") > F.col("depth"))
    nodes = rows.groupBy("rep", "depth").agg(
        F.max("n").alias("n"),
        F.max("n_ends").alias("n_ends"),
        F.count_if(below).alias("n_children"),
        F.count_if("leaf").alias("n_leaves"),
        F.sum(F.when(is_rep, 0).otherwise(F.col("q"))).alias("q"),
        F.max(F.col("upto") - F.col("chars")).alias("above_chars"),
        F.max(F.when(is_rep, F.col("t"))).alias("t"),
        F.max(F.when(is_rep, F.col("above"))).alias("above"),
        F.max(F.when(F.col("depth") == F.col("length"), F.col("conv"))).alias("ends"),
    )
    several = members.where((F.col("n_ends") > 1) & (F.col("depth") == F.col("length")))
    hashes = list_hashes(several.select("rep", "depth", "conv"))
    one = F.sha2(F.coalesce(F.col("ends").cast("string"), F.lit("")), 256)
    own = F.col("depth") > F.col("t")
    return nodes.join(hashes, ["rep", "depth"], "left").select(
        F.col("rep").alias("conv_id"),
        "depth",
        F.when(own, F.col("rep")).otherwise(F.col("above")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        "n_children",
        "n_leaves",
        (F.col("q") - (F.col("n") - 1) * F.col("above_chars")).alias("saved_tokens"),
        F.coalesce("sha", one).alias("ends_sha256"),
    )


def _lone_nodes(rows: DataFrame) -> DataFrame:
    """Nodes of prefixes that are proven to belong to one conversation."""
    ends = F.col("depth") == F.col("length")
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return rows.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        one.alias("n_convs"),
        F.when(ends, zero).otherwise(one).alias("n_children"),
        one.alias("n_leaves"),
        zero.alias("saved_tokens"),
        F.sha2(F.when(ends, F.col("conv").cast("string")).otherwise(F.lit("")), 256).alias("ends_sha256"),
    )


def list_hashes(members: DataFrame) -> DataFrame:
    """(rep, depth, sha): SHA-256 of the ascending decimal ids of each node, joined by commas.

    A hash takes its text in order, so the last step is one stream per node. Ids are therefore
    sorted and joined before, in ranges that cut a node of any size into many tasks, and the stream
    reads pieces of thousands of ids and holds one at a time.
    """
    order = ["rep", "depth", "conv"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, depth, conv = (
                batch.column(n).to_numpy(zero_copy_only=False) for n in order
            )
            new = np.flatnonzero((np.diff(rep) != 0) | (np.diff(depth) != 0)) + 1
            starts = np.concatenate([[0], new]) if len(rep) else new
            ends = np.append(starts[1:], len(rep))
            yield pa.RecordBatch.from_pydict(
                {
                    "rep": rep[starts],
                    "depth": depth[starts],
                    "first": conv[starts],
                    "ids": [",".join(map(str, conv[a:b].tolist())) for a, b in zip(starts, ends)],
                }
            )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for rep, depth, ids in zip(
                *(batch.column(n).to_pylist() for n in ("rep", "depth", "ids"))
            ):
                if node == (rep, depth):
                    state.update(b",")
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (rep, depth), hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield rows_of(done)
        if node:
            yield rows_of([(*node, state.hexdigest())])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(("rep", "depth", "sha"), zip(*done))
        return pa.RecordBatch.from_pydict({name: list(values) for name, values in columns})

    kinds = "rep bigint, depth bigint"
    dealt = members.repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = dealt.mapInArrow(join, f"{kinds}, first bigint, ids string")
    ordered = pieces.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first")
    return ordered.mapInArrow(hashed, f"{kinds}, sha string")
