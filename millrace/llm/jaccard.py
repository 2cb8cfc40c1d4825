"""Documents linked by the Jaccard similarity of their word n-grams, exactly.

Equal n-gram sets are one class; only classes are compared. Two sets above the threshold differ in
at most k n-grams, k following from their sizes, so if n-grams are dealt by hash into more than k
groups, some group is the same in both. Classes are brought together by equal groups, within
ranges of sizes, which no unrelated texts share.

N-grams are also counted by hash into coordinates. The sum of the smaller coordinates of two such
points bounds the overlap of their sets from above, and boxes over points bound it for many sets.

In each cell every class is first compared with the one that shares most cells with others. In cells
that aren't all connected by then, boxes are searched for classes that may be similar to one of
another component, first by coarse points and then, of the classes found, by fine ones; the others
are done. What is left is dealt anew, by the rarest n-grams of each class, and searched in these
smaller cells: the pairs whose bound suffices are compared exactly, except those already connected.
Links therefore come out complete up to connection, without all pairs of a group of copies, and
n-grams are moved only of classes that may still link. A cell of any size is searched in parts.

N-grams and sets are told apart by hashes of 64 bits. Null and empty texts and texts without words
have no n-grams and are linked with nothing; a text of fewer words than n is one n-gram. Rows of
the same id are judged one by one; a null id keeps its place as the smallest of all.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, exp, sqrt

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.hashing import chunks, mixed, sequence_hashes, word_hashes
from millrace.llm.rows import ROW, ids_are_keys, with_row_ids
from millrace.llm.storage import discard, free_shuffles, stored
from millrace.llm.travel import compressed, opened
from millrace.llm.workers import make_room

COORDINATES = 16, 4096  # of a point, fewest and most; between them a quarter or less of the n-grams
FINE = 1 << 14  # coordinates of a fine point, most; up to it, two to four times the n-grams
FULL = 255  # a coordinate that counts as many n-grams or more
ENDLESS = 1 << 30  # n-grams that a full coordinate may stand for
LEAF = 16  # points in a box of the tree
LEVELS = 6  # dealings tried where too many groups of a set are empty
CHUNK = 256  # classes of a cluster compared with as many others at once
WIDE = 4  # times as many, where points are compared; a class comes out once for each of its parts
TASK_ROWS = 2048  # classes of clusters in a task, on average
SEED = 0xA24BAED4963EE407
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Similarity:
    """At least num / den of the union, of n-grams of n words."""

    n: int = 5
    num: int = 4
    den: int = 5

    def most_apart(self, total: int) -> int:
        """How many n-grams two similar sets of this total size can differ in."""
        return total * (self.den - self.num) // (self.den + self.num)

    def least_common(self, total):
        """How many n-grams two similar sets of this total size have in common at least."""
        return -(-total * self.num // (self.num + self.den))


def text_sets(texts: list[str], n: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text, ASCII letters lower-cased."""
    for _, part in chunks(texts):
        words, firsts = word_hashes(part, lower=True)
        grams = sequence_hashes(words, n)
        for start, end in zip(firsts, firsts[1:]):
            if end - start >= n:
                yield np.unique(grams[start : end - n + 1])
            elif end > start:
                yield sequence_hashes(words[start:end], int(end - start))
            else:
                yield np.zeros(0, np.uint64)


def set_hash(grams: np.ndarray) -> int:
    size = np.uint64(len(grams))
    total = mixed(grams + size).sum(dtype=np.uint64, keepdims=True)
    return int(mixed(total)[0].astype(np.int64))


@lru_cache(maxsize=4096)
def _groups(sim: Similarity, least: int, total: int) -> tuple[int, int]:
    """Number of groups, and the differences they allow for, for sets from a size on."""
    k = sim.most_apart(total)
    empty = (k + 1) * exp(-least / (k + 1))
    return k + 1 + ceil(empty + 3 * sqrt(empty)), k


def signatures(grams: np.ndarray, sim: Similarity) -> np.ndarray:
    """A hash per group of n-grams, such that similar sets that differ share one at least.

    Sizes are cut at powers of two. A set has groups for its own range, and for the border to the
    next range if a similar set can lie beyond. Empty groups say nothing; a set with too many for
    the guarantee is dealt again by another hash, as is any similar set, for they have the same
    groups empty that they don't differ in.
    """
    size = len(grams)
    if not size:
        return np.zeros(0, np.uint64)
    high = (1 << size.bit_length()) - 1
    low = (high + 1) // 2
    labels = [(2 * size.bit_length(), low, 2 * high)]
    for border, number in ((high, size.bit_length()), (low - 1, size.bit_length() - 1)):
        beyond = border * sim.den // sim.num
        within = -(-(border + 1) * sim.num // sim.den)
        if border and within <= size <= beyond and beyond > border:
            labels.append((2 * number + 1, within, border + beyond))
    out = []
    for label, least, total in labels:
        groups, k = _groups(sim, least, total)
        if not k:  # only equal sets are similar
            continue
        for level in range(LEVELS):
            seed = np.uint64((label * LEVELS + level + 1) * SEED % (1 << 64))
            dealt = mixed(grams ^ seed)
            place = (dealt % np.uint64(groups)).astype(np.int64)
            sums = np.zeros(groups, np.uint64)
            np.add.at(sums, place, mixed(dealt))
            full = np.bincount(place, minlength=groups) > 0
            out.append(mixed(sums + seed + np.arange(groups, dtype=np.uint64))[full])
            if groups - full.sum() < groups - k:
                break
        else:
            out.append(mixed(np.array([seed])))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def coordinates(grams: np.ndarray) -> np.ndarray:
    """How many n-grams fall into each coordinate, whose number follows from the set's size."""
    least, most = COORDINATES
    return _counted(grams, min(most, max(least, 1 << max(0, len(grams).bit_length() - 2))))


def fine_coordinates(grams: np.ndarray) -> np.ndarray:
    """The same of so many coordinates that few n-grams meet others, for a bound close to the overlap."""
    return _counted(grams, min(FINE, max(COORDINATES[0], 2 << len(grams).bit_length())))


def _counted(grams: np.ndarray, many: int) -> np.ndarray:
    counts = np.bincount((grams % np.uint64(many)).astype(np.int64), minlength=many)
    return np.minimum(counts, FULL).astype(np.uint8)


def same_space(points: list[np.ndarray]) -> np.ndarray:
    """Points of different sizes in the coordinates of the smallest; full ones bound nothing.

    They stay numbers of 8 bits unless a coordinate is full, or has become so.
    """
    least = min(map(len, points))
    placed = np.empty((len(points), least), np.uint8)
    for row, p in zip(placed, points):
        folded = p if len(p) == least else p.reshape(-1, least).sum(0)
        if folded.max() >= FULL:
            return _wide_space(points, least)
        row[:] = folded
    return placed


def _wide_space(points: list[np.ndarray], least: int) -> np.ndarray:
    placed = np.empty((len(points), least), np.int32)
    for row, p in zip(placed, points):
        wide = np.where(p == FULL, ENDLESS, p.astype(np.int64)).reshape(-1, least).sum(0)
        row[:] = np.minimum(wide, ENDLESS)
    return placed


class BoxTree:
    """Points in boxes of a few, ordered by size and place; searched by bounds on the overlap."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, sim: Similarity) -> None:
        self.sim = sim
        self.order = np.lexsort([points.argmax(1), sizes])
        self.points, self.sizes = points[self.order], sizes[self.order]
        starts = np.arange(0, len(sizes), LEAF)
        self.high = np.maximum.reduceat(self.points, starts, axis=0)
        self.least = np.minimum.reduceat(self.sizes, starts)

    def similar(self, point: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the points that may overlap enough."""
        bound = np.minimum(self.high, point).sum(1)
        boxes = np.flatnonzero(bound >= self.sim.least_common(size + self.least))
        rows = (boxes[:, None] * LEAF + np.arange(LEAF)).ravel()
        rows = rows[rows < len(self.sizes)]
        overlap = np.minimum(self.points[rows], point).sum(1)
        return self.order[rows[overlap >= self.sim.least_common(size + self.sizes[rows])]]


def _root(parents: dict[int, int], x: int) -> int:
    while parents[x] != x:
        parents[x] = parents[parents[x]]
        x = parents[x]
    return x


def cell_links(
    classes: list[int], labels: list[int], sets: list[np.ndarray], sim: Similarity
) -> Iterator[tuple[int, int]]:
    """Links between classes that the labels and the links before don't connect."""
    parents = {label: label for label in labels}
    points = same_space([coordinates(s) for s in sets])
    tree = BoxTree(points, np.array([len(s) for s in sets]), sim)
    for i, grams in enumerate(sets):
        for j in tree.similar(points[i], len(grams)):
            a, b = _root(parents, labels[i]), _root(parents, labels[j])
            if j >= i or a == b:
                continue
            total = len(grams) + len(sets[j])
            common = len(np.intersect1d(grams, sets[j], assume_unique=True))
            if common >= sim.least_common(total):
                parents[max(a, b)] = min(a, b)
                yield classes[i], classes[j]


def may_link(points: list[np.ndarray], sizes: np.ndarray, labels: list[int], sim: Similarity) -> list[bool]:
    """Whether each point may overlap enough with one of another label."""
    placed, named = same_space(points), np.array(labels)
    tree = BoxTree(placed, sizes, sim)
    return [
        bool((named[tree.similar(point, size)] != label).any())
        for point, size, label in zip(placed, sizes, named)
    ]


def _map_sets(docs: DataFrame, sim: Similarity) -> DataFrame:
    """(id, n, class, point, fine) of every row; points are compressed."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            n, keys, points, fine = [], [], [], []
            for grams in text_sets(batch.column(1).to_pylist(), sim.n):
                n.append(len(grams))
                keys.append(set_hash(grams))
                points.append(pack(coordinates(grams).tobytes()))
                fine.append(pack(fine_coordinates(grams).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(points, pa.binary()),
                    pa.array(fine, pa.binary()),
                ],
                ["id", "n", "class", "point", "fine"],
            )

    return docs.mapInArrow(
        rows, "id bigint, n bigint, class bigint, point binary, fine binary"
    )


def _map_signatures(docs: DataFrame, sim: Similarity) -> DataFrame:
    """(sig, class), once for each group of each row's set."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for start in range(0, len(texts), 500):
                sigs, keys = [], []
                for grams in text_sets(texts[start : start + 500], sim.n):
                    found = signatures(grams, sim)
                    sigs.append(found.view(np.int64))
                    keys.append(np.full(len(found), set_hash(grams), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sigs)), pa.array(np.concatenate(keys))],
                    ["sig", "class"],
                )

    return docs.mapInArrow(rows, "sig bigint, class bigint")


def _map_grams(docs: DataFrame, sim: Similarity) -> DataFrame:
    """(class, grams, n) of rows (id, text, class) whose text has the class asked for."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            keys, sets = [], []
            wanted = batch.column(2).to_pylist()
            texts = opened(batch.column(1).to_pylist())
            for grams, key in zip(text_sets(texts, sim.n), wanted):
                if set_hash(grams) == key:
                    keys.append(key)
                    sets.append(grams.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                ["class", "grams"],
            )

    found = docs.mapInArrow(rows, "class bigint, grams array<bigint>")
    return found.withColumn("n", F.size("grams"))


def _points(packed: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    return (np.frombuffer(unpack(p), np.uint8) for p in packed.to_pylist())


def _beside(pairs: DataFrame, classes: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with the columns of both classes, named for their side."""
    for side in ("a", "b"):
        named = [F.col(c).alias(f"{c}_{side}") for c in columns]
        pairs = pairs.join(classes.select(F.col("class").alias(side), *named), side)
    return pairs


def _bounded(pairs: DataFrame, classes: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs (a, b) of classes whose points allow for enough overlap."""

    @F.arrow_udf("bigint")
    def overlap(ours: pa.Array, theirs: pa.Array) -> pa.Array:
        spaces = map(same_space, zip(_points(ours), _points(theirs)))
        return pa.array([int(space.min(0).sum()) for space in spaces], pa.int64())

    beside = _beside(pairs, classes, "point", "n")
    bound = overlap("point_a", "point_b") * (sim.num + sim.den)
    return beside.where(bound >= sim.num * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def _compared(pairs: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """The pairs (a, b) of classes that are similar."""
    common = F.size(F.array_intersect("grams_a", "grams_b"))
    total = F.size("grams_a") + F.size("grams_b")
    alike = common * (sim.num + sim.den) >= sim.num * total
    return _beside(pairs, sets, "grams").where(alike).select("a", "b")


def _weighty(cells: DataFrame) -> DataFrame:
    """(sig, b): of each cell the class that shares most with others, as an original does."""
    sizes = cells.groupBy("sig").agg(F.count(F.lit(1)).alias("size"))
    weights = cells.join(sizes, "sig").groupBy("class").agg(F.sum("size").alias("weight"))
    order = F.struct("weight", "class")
    return cells.join(weights, "class").groupBy("sig").agg(F.max_by("class", order).alias("b"))


def _rare_cells(apart: DataFrame, sets: DataFrame, sim: Similarity) -> DataFrame:
    """Cells (sig, class, label) by the rarest n-grams of each class.

    With all n-grams in one order, similar sets share one among the first that are more than they
    may differ in; in the order of their counts, near copies share few of these but with the
    copies that have hardly any of their own. N-grams of one class come first in this order and make
    no cell, so their number is all that is needed of them.
    """
    grams = apart.select("class").join(sets.select("class", "grams"), "class")
    each = grams.select("class", F.explode("grams").alias("gram"))
    count = F.count(F.lit(1)).over(Window.partitionBy("gram"))
    shared = each.withColumn("count", count).where("count > 1")
    ranked = shared.groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("count", "gram"))).alias("grams")
    )
    rows = ranked.join(apart, "class").join(sets.select("class", "n"), "class")
    smallest = f"((n * {sim.num} + {sim.den - 1}) div {sim.den})"
    each_way = sim.num + sim.den
    common = f"(((n + {smallest}) * {sim.num} + {each_way - 1}) div {each_way})"
    left = F.expr(f"cast(greatest(0, size(grams) - greatest({common}, 1) + 1) as int)")
    first = F.slice("grams", F.lit(1), left)
    cells = rows.select("class", "label", F.explode(first).alias("g"))
    return cells.select(F.col("g.gram").alias("sig"), "class", "label")


def _parts(cells: DataFrame, chunk: int) -> DataFrame:
    """Cells (sig, class, label) in parts (sig, i, j, class, label) that hold what is to be compared.

    A cell of up to ``chunk`` classes is one part. In a larger one the classes of the commonest label
    aren't compared with each other; all others are, and with those, in chunks.
    """
    counts = cells.groupBy("sig", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("sig").agg(
        F.max_by("label", F.struct("n", "label")).alias("top"),
        F.sum("n").alias("size"),
        F.ceil(F.max("n") / chunk).alias("top_parts"),
        F.ceil((F.sum("n") - F.max("n")) / chunk).alias("parts"),
    )
    parted = cells.join(sizes.where("parts > 0"), "sig").withColumn("hash", F.xxhash64("class"))
    is_top, whole = F.col("label") == F.col("top"), F.col("size") <= chunk
    own = F.when(is_top, F.col("parts") + F.pmod("hash", "top_parts")).otherwise(
        F.pmod("hash", "parts")
    )
    facing = F.col("parts") + F.when(is_top, 0).otherwise(F.col("top_parts"))
    turn = F.explode(F.sequence(F.lit(0).cast("bigint"), F.when(whole, 0).otherwise(facing - 1)))
    rows = parted.withColumn("own", F.when(whole, 0).otherwise(own)).withColumn("other", turn)
    i, j = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    return rows.select("sig", i, j, "class", "label")


def _tasks(parts: DataFrame, cell: str = "sig") -> Column:
    """The task of each part, of so many that each has TASK_ROWS on average."""
    tasks = max(1, ceil(parts.count() / TASK_ROWS))
    return F.pmod(F.xxhash64(cell, "i", "j"), F.lit(tasks)).alias("task")


def _members(table: pa.Table, cell: str = "sig") -> list[list[int]]:
    """The rows of each part."""
    parts: dict[tuple, list[int]] = defaultdict(list)
    for row, key in enumerate(zip(*(table[c].to_pylist() for c in (cell, "i", "j")))):
        parts[key].append(row)
    return list(parts.values())


def _possible(
    cells: DataFrame, least: int, classes: DataFrame, point: str, sim: Similarity
) -> DataFrame:
    """Of cells (sig, class, label) the classes that may link with one of another label there.

    Cells of the same classes are one, and those of less than ``least`` are left out.
    """
    state = cells.groupBy("sig").agg(
        F.count(F.lit(1)).alias("size"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        *(F.bit_xor(F.xxhash64("class", F.lit(k))).alias(f"members_{k}") for k in (1, 2)),
    )
    wide = state.where((F.col("size") >= least) & (F.col("low") < F.col("high")))
    wide = wide.groupBy("size", "members_1", "members_2").agg(F.min("sig").alias("sig"))
    parts = stored(_parts(cells.join(wide.select("sig"), "sig"), WIDE * CHUNK))
    loaded = parts.join(classes.select("class", "n", F.col(point).alias("point")), "class").select(
        _tasks(parts), "sig", "i", "j", "class", "label", "n", "point"
    )

    def possible(table: pa.Table) -> pa.Table:
        make_room()
        labels, packed = table["label"].to_pylist(), table["point"].combine_chunks()
        sizes, some = table["n"].to_numpy(), []
        for rows in _members(table):  # points are opened for one part after the other
            points = list(_points(packed.take(pa.array(rows, pa.int64()))))
            near = may_link(points, sizes[rows], [labels[r] for r in rows], sim)
            some += [r for r, yes in zip(rows, near) if yes]
        return table.select(["sig", "class", "label"]).take(pa.array(some, pa.int64()))

    near = loaded.groupBy("task").applyInArrow(possible, "sig bigint, class bigint, label bigint")
    found = stored(near.distinct())
    discard(parts)
    return found


def _apart(cells: DataFrame, known: DataFrame, classes: DataFrame, sim: Similarity) -> DataFrame:
    """(class, label) of what may link with a class that the known (node, root) leave apart."""
    placed = cells.join(known.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.select("sig", "class", F.coalesce("root", "class").alias("label"))
    roughly = _possible(placed, 3, classes, "point", sim)  # two have been compared
    closely = _possible(roughly, 2, classes, "fine", sim)
    apart = stored(closely.select("class", "label").distinct())
    discard(roughly, closely)
    return apart


def _searched(
    apart: DataFrame, sets: DataFrame, sim: Similarity
) -> tuple[DataFrame, list[DataFrame]]:
    """Links (a, b) of classes (class, label) that their labels leave apart.

    They are dealt anew by rare n-grams. The stored tables that the links are read from come with
    them.
    """
    dealt = stored(_rare_cells(apart, sets, sim))
    free_shuffles(apart.sparkSession)
    rows = stored(_parts(dealt, CHUNK).withColumnRenamed("sig", "cluster"))
    loaded = rows.join(sets.select("class", "grams"), "class").select(
        _tasks(rows, "cluster"), "cluster", "i", "j", "class", "label", "grams"
    )

    def links(table: pa.Table) -> pa.Table:
        make_room()
        names, labels = table["class"].to_pylist(), table["label"].to_pylist()
        sets = [np.array(g.values).view(np.uint64) for g in table["grams"]]
        found = [
            link
            for rows in _members(table, "cluster")
            for link in cell_links(
                [names[r] for r in rows], [labels[r] for r in rows], [sets[r] for r in rows], sim
            )
        ]
        a, b = zip(*found) if found else ((), ())
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return loaded.groupBy("task").applyInArrow(links, "a bigint, b bigint"), [dealt, rows]


def similar_documents(
    docs: DataFrame, sim: Similarity, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    The component is the smallest id that links lead to.
    """
    unique = ids_are_keys(docs, doc_id)
    keyed = with_row_ids(docs, doc_id, text, unique)
    found = _similar_rows(keyed, sim, ROW, text)
    if unique:
        return found.withColumnRenamed(ROW, doc_id)
    names = keyed.select(F.col(ROW).alias("component_id"), F.col(doc_id).alias("__least"))
    named = found.join(keyed.select(ROW, doc_id), ROW).join(names, "component_id")
    return named.select(doc_id, "n_shingles", F.col("__least").alias("component_id"))


def _similar_rows(docs: DataFrame, sim: Similarity, doc_id: str, text: str) -> DataFrame:
    """The same of rows whose id is a key; only one may be null."""
    rows = docs.select(F.coalesce(F.col(doc_id), F.lit(NO_ID)).cast("bigint").alias("id"), text)
    mapped = stored(_map_sets(rows, sim))
    sized = mapped.select("id", "n", "class")
    ids = sized.where("n > 0").groupBy("class").agg(F.min("id").alias("id"))
    classes = stored(mapped.join(ids, ["class", "id"], "left_semi"))
    # Signatures are made and shuffled once, and counted where they then lie.
    times = F.count(F.lit(1)).over(Window.partitionBy("sig"))
    repeated = _map_signatures(rows, sim).withColumn("times", times).where("times > 1")
    cells = stored(repeated.select("sig", "class").distinct())
    del repeated
    free_shuffles(rows.sparkSession)
    leaders = _weighty(cells)
    pairs = cells.join(leaders, "sig").where("class != b").select(F.col("class").alias("a"), "b")
    near = stored(_bounded(pairs.distinct(), classes, sim))
    free_shuffles(rows.sparkSession)
    packed = rows.select("id", compressed(F.col(text)).alias("text"))

    def grams_of(asked: DataFrame) -> DataFrame:
        asked = classes.join(asked, "class", "left_semi").select("id", "class")
        return stored(_map_grams(packed.join(asked, "id").select("id", "text", "class"), sim))

    sides = [near.select(F.col(side).alias("class")) for side in ("a", "b")]
    sets = grams_of(sides[0].unionByName(sides[1]).distinct())
    first = stored(_compared(near, sets, sim))
    discard(near, sets)
    apart = _apart(cells, components(first), classes, sim)
    discard(cells)
    sets = grams_of(apart)
    searched, used = _searched(apart, sets, sim)
    more = stored(searched)
    discard(apart, sets, *used)
    roots = components(first.unionByName(more))
    rooted = ids.join(roots.withColumnRenamed("node", "class"), "class", "left").select(
        "class", "id", F.coalesce("root", "class").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    named = rooted.join(least, "root").select("class", "component_id")
    full = sized.where("n > 0").join(named, "class")
    alone = sized.where("n = 0").withColumn("component_id", F.col("id"))
    every = full.select("id", "n", "component_id").unionByName(
        alone.select("id", "n", "component_id")
    )
    back = {c: F.when(F.col(c) != NO_ID, F.col(c)) for c in ("id", "component_id")}
    return every.withColumns(back).select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id"
    )


def one_of_each(
    docs: DataFrame, sim: Similarity, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of each component, that of the smallest id.

    Rows of one id, or without one, are documents like others: of those in one component the one
    with the least hash of its text stays, so equal rows leave one. Rows without words all stay.
    """
    keyed = with_row_ids(docs, doc_id, text, ids_are_keys(docs, doc_id))
    found = _similar_rows(keyed, sim, ROW, text)
    kept = found.where(F.col(ROW).eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col(ROW).alias("__id"))
    return keyed.join(kept, F.col(ROW).eqNullSafe(F.col("__id")), "left_semi").drop(ROW)
