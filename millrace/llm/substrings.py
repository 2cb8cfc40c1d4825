"""Removal of passages that occur earlier in the corpus, exact to the word.

A window is a fixed number of consecutive words; every word in a window whose words also start
earlier goes. Equal windows have the same anchor, the least of the hashes of their short word
sequences, so a document's windows are cut into segments of one anchor each and only anchors
that occur again are followed up:

* Segments with the same words are settled by their first occurrence, found by an aggregate.
* Different segments of an anchor are dealt to shards. In a shard, segments are streamed in corpus
  order through a suffix automaton of the segments before them; where the matching statistic
  reaches the window's length, the window occurred earlier.
* An anchor of very many different segments, as at the border of a passage that a large part of
  the corpus shares, would not fit a shard. Its windows are compared one by one by an aggregate.

The automata are of shards of the repeated text and live where their segments are dealt, rather
than being sent everywhere: that text grows with the corpus.

Null texts count as empty. Texts shorter than a window lose nothing. Rows of the same id and text
stand at the same place and aren't earlier than each other; rows of the same id and different
texts are ordered by a hash. A null id comes first. Segments are told apart by hashes of 96 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.hashing import WORD_BASE, chunks, sequence_hashes, spans_hashes, word_hashes
from millrace.llm.rows import ROW, ids_are_keys, with_text_ids
from millrace.llm.storage import stored
from millrace.llm.travel import compressed, opened
from millrace.llm.workers import make_room

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ANCHOR_WORDS = 8
SHARED = 64  # different segments of an anchor from which its windows are compared one by one
SHARD_SEGMENTS = 4096
PLACE_BITS = 40  # of a position: the word; above it, a hash that tells texts of one id apart
SIZE_BITS = 12  # below the position in a segment's row: its number of windows
MOST_WINDOW = 4000  # words, so that the windows of a segment can be counted in SIZE_BITS
NO_ID = -(1 << 63)


class SuffixAutomaton:
    """All word sequences of the segments added so far."""

    def __init__(self) -> None:
        self.length, self.link = [0], [-1]
        self.next: list[dict[str, int]] = [{}]

    def matches(self, words: list[str]) -> Iterator[int]:
        """For each word, how many words up to it are a sequence seen before."""
        state = matched = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                matched += 1
            yield matched

    def add(self, words: list[str]) -> None:
        last = 0
        for word in words:
            last = self._extended(last, word)

    def _state(self, length: int, link: int, after: dict[str, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(after)
        return len(self.length) - 1

    def _extended(self, last: int, word: str) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, word, self.next[at][word])
        return new

    def _split(self, at: int, word: str, known: int) -> int:
        """The state of the sequences up to ``at`` and the word, on its own."""
        if self.length[known] == self.length[at] + 1:
            return known
        own = self._state(self.length[at] + 1, self.link[known], dict(self.next[known]))
        self.link[known] = own
        while at >= 0 and self.next[at].get(word) == known:
            self.next[at][word] = own
            at = self.link[at]
        return own


def anchored_segments(words: np.ndarray, firsts: np.ndarray, window: int) -> list[np.ndarray]:
    """Per segment: anchor, content, text number, first word in the text, number of windows."""
    short = min(ANCHOR_WORDS, window)
    grams = sequence_hashes(words, short)
    n = len(words) - window + 1
    if n < 1:
        return [np.zeros(0, t) for t in (np.uint64, np.uint64, int, int, int)]
    least, place = grams[:n].copy(), np.arange(n)
    for step in range(1, window - short + 1):
        other = grams[step : step + n]
        smaller = other < least
        least[smaller] = other[smaller]
        place[smaller] = np.flatnonzero(smaller) + step
    text = np.searchsorted(firsts, np.arange(n), side="right") - 1
    inside = np.arange(n) + window <= firsts[text + 1]
    fresh = np.ones(n, bool)
    fresh[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    starts = np.flatnonzero(fresh & inside)
    number = np.cumsum(fresh) - 1
    size = np.bincount(number[inside], minlength=number[-1] + 1)[number[starts]]
    content = spans_hashes(words, starts, starts + size + window - 1, WORD_BASE)
    return [least[starts], content, text[starts], starts - firsts[text[starts]], size]


def _text_bits(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A few bits that tell texts apart."""
    spans = spans_hashes(words, firsts[:-1], firsts[1:], WORD_BASE)
    return (spans >> np.uint64(50)).astype(np.int64) & 0x7FF


def _map_segments(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, content, id, at) of every segment of every row; ``at`` is place and size.

    A segment has at most as many windows as words that an anchor can move over, 2 ** SIZE_BITS
    at most.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, part in chunks(batch.column(1).to_pylist()):
                words, firsts = word_hashes(part)
                bits = _text_bits(words, firsts)
                anchor, content, text, start, n = anchored_segments(words, firsts, window)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor.view(np.int64)),
                        pa.array((content >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        pa.array(ids[first + text]),
                        pa.array(((start + (bits[text] << PLACE_BITS)) << SIZE_BITS) + n),
                    ],
                    ["anchor", "content", "id", "at"],
                )

    return docs.mapInArrow(rows, "anchor bigint, content int, id bigint, at bigint")


def _of_text(text: str, spans: list[dict]) -> tuple[list[str], list[dict]]:
    """A text's words and those of its id's spans that are this text's."""
    words, firsts = word_hashes([(text or "").encode()])
    bits = int(_text_bits(words, firsts)[0]) << PLACE_BITS
    own = [s for s in spans if s["place"] >> PLACE_BITS << PLACE_BITS == bits]
    return WORD.findall(text or ""), own


def _load_segments(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(anchor, id, place, n, kinds, words) of segments, read from the texts once."""
    fields = ["anchor", "place", "n", "kinds"]
    spans = wanted.groupBy("id").agg(F.collect_list(F.struct(*fields)).alias("spans"))
    names = ["anchor", "id", "place", "n", "kinds", "words"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make_room()
        for batch in batches:
            ids, texts, lists = (c.to_pylist() for c in batch.columns)
            for i, text, spans in zip(ids, opened(texts), lists):
                words, own = _of_text(text, spans)
                found = []
                for s in own:
                    start = s["place"] & ((1 << PLACE_BITS) - 1)
                    part = " ".join(words[start : start + s["n"] + window - 1])
                    found.append((s["anchor"], i, s["place"], s["n"], s["kinds"], part))
                columns = list(zip(*found)) or [()] * 6
                kinds = [pa.int64()] * 5 + [pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names
                )

    packed = docs.select("id", compressed(F.col(docs.columns[1])).alias("text"))
    return packed.join(spans, "id").mapInArrow(
        rows,
        "anchor bigint, id bigint, place bigint, n bigint, kinds bigint, words string",
    )


def _streamed(segments: DataFrame, window: int) -> DataFrame:
    """Spans (id, place, n) of windows that a segment of the same shard has earlier."""
    shards = max(1, ceil(segments.count() / SHARD_SEGMENTS))

    def spans(table: pa.Table) -> pa.Table:
        make_room()
        automaton, found = SuffixAutomaton(), []
        ordered = sorted(zip(*(table[c].to_pylist() for c in ("id", "place", "words"))))
        for i, place, text in ordered:
            words = text.split(" ")
            for end, matched in enumerate(automaton.matches(words)):
                if matched >= window:
                    found.append((i, place + end - window + 1, 1))
            automaton.add(words)
        ids, places, n = zip(*found) if found else ((), (), ())
        return pa.table(
            [pa.array(c, pa.int64()) for c in (ids, places, n)], names=["id", "place", "n"]
        )

    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    return (
        segments.select(shard, "id", "place", "words")
        .groupBy("shard")
        .applyInArrow(spans, "id bigint, place bigint, n bigint")
    )


def _compared(segments: DataFrame, window: int) -> DataFrame:
    """The same spans for anchors of many segments, from single windows."""
    at = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1))
    windows = segments.withColumn("at", at).select(
        F.concat_ws(" ", F.slice(F.split("words", " "), F.col("at").cast("int") + 1, window)).alias("text"),
        F.struct("id", (F.col("place") + F.col("at")).alias("place")).alias("at"),
    )
    firsts = windows.groupBy("text").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k"))
    later = windows.join(firsts.where("k > 1").drop("k"), "text").where(F.col("at") > F.col("first"))
    return later.select("at.id", "at.place", F.lit(1).cast("bigint").alias("n"))


def repeated_spans(docs: DataFrame, window: int) -> DataFrame:
    """Spans (id, place, n) of windows that occur earlier, of rows (id, text)."""
    segments = _map_segments(docs, window)
    short = F.shiftright("anchor", 16)  # 48 bits, narrower to count; a superset will do
    again = segments.groupBy(short.alias("short")).count().where("count > 1").select("short")
    rows = stored(segments.join(again, short == F.col("short")).drop("short"))
    here = F.struct("id", "at")
    contents = rows.groupBy("anchor", "content").agg(F.min(here).alias("first"))
    kinds = contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    placed = stored(
        rows.join(contents, ["anchor", "content"])
        .join(kinds, "anchor")
        .withColumn("copy", here > F.col("first"))
        .where("copy or kinds > 1")
        .select(
            F.when(~F.col("copy"), F.col("anchor")).alias("anchor"),
            "id",
            F.shiftright("at", SIZE_BITS).alias("place"),
            F.col("at").bitwiseAND(F.lit((1 << SIZE_BITS) - 1)).alias("n"),
            "kinds",
            "copy",
        )
    )
    copies = placed.where("copy").select("id", "place", "n")
    open_rows = placed.where("not copy").drop("copy").distinct()
    segments = stored(_load_segments(docs, open_rows, window).distinct())
    few, many = (segments.where(c) for c in (f"kinds <= {SHARED}", f"kinds > {SHARED}"))
    return copies.unionByName(_streamed(few, window)).unionByName(_compared(many, window))


def _covered(n_words: int, spans: list[dict], window: int) -> np.ndarray:
    edges = np.zeros(n_words + 1, np.int64)
    for s in spans:
        start = s["place"] & ((1 << PLACE_BITS) - 1)
        edges[start] += 1
        edges[min(n_words, start + s["n"] + window - 1)] -= 1
    return np.cumsum(edges[:-1]) > 0


def remove_repeats(
    docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row with n_words, n_removed, kept (its words, one space apart) and text without them.

    The text keeps its white space: a word goes with the white space that follows it. Each row is a
    document of its own, also where ids are null or repeated: texts of one id count in the order of
    their hash. Rows of one id and one text are one document, so they lose the same words.
    """
    if window > MOST_WINDOW:
        raise ValueError(f"a window has at most {MOST_WINDOW} words")
    keyed = with_text_ids(docs, doc_id, text, ids_are_keys(docs, doc_id))
    return _without_repeats(keyed, window, ROW, text).drop(ROW)


def _without_repeats(docs: DataFrame, window: int, doc_id: str, text: str) -> DataFrame:
    key = F.coalesce(F.col(doc_id), F.lit(NO_ID)).cast("bigint")
    spans = stored(repeated_spans(docs.select(key.alias("id"), text), window))
    listed = spans.groupBy(F.col("id").alias("__id")).agg(
        F.collect_list(F.struct("place", "n")).alias("__spans")
    )
    result = "n_words bigint, n_removed bigint, kept string, text string"
    kinds = pa.struct(
        [("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("text", pa.string())]
    )

    @F.arrow_udf(result)
    def removed(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for t, s in zip(opened(texts.to_pylist()), spans.to_pylist()):
            words, own = _of_text(t, s) if s else (WORD.findall(t), [])
            kept, left, n = words, t, 0
            if own:
                gone = _covered(len(words), own, window)
                n = int(gone.sum())
                kept = [w for w, g in zip(words, gone) if not g]
                places = [m.start() for m in WORD.finditer(t)] + [len(t)]
                left = t[: places[0]] + "".join(
                    t[a:b] for a, b, g in zip(places, places[1:], gone) if not g
                )
            out.append({"n_words": len(words), "n_removed": n, "kept": " ".join(kept), "text": left})
        return pa.array(out, kinds)

    packed = docs.withColumn(text, compressed(F.col(text)))
    joined = packed.join(listed, key == F.col("__id"), "left")
    found = joined.withColumn("__found", removed(F.col(text), F.col("__spans")))
    return found.withColumns(
        {
            "n_words": F.col("__found.n_words"),
            "n_removed": F.col("__found.n_removed"),
            "kept": F.col("__found.kept"),
            text: F.col("__found.text"),
        }
    ).drop("__id", "__spans", "__found")
