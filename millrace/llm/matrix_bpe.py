"""Byte-level BPE over padded matrices of pre-tokens, by the ranks of a vocabulary file.

A pre-token is a row of byte tokens. Rows of like length stand in one matrix, padded to a common
width, beside a matrix of the ranks of neighbouring pairs. In each round every row merges its
leftmost pair of lowest rank: the pair's place takes the merged token, what stands behind moves up
by one, and the ranks of the two pairs beside it are looked up anew in a hash table of all pairs.
Rows without a pair that merges are done and leave the matrix. A matrix becomes narrower by one
column with each round, so its rounds are bounded by its width.

Rows of more than ``LONG`` bytes have a matrix of their own, of one row. There the places of the
lowest rank merge in one round from the left on, up to the first that makes a pair of a lower rank.

A pre-token that is itself in the vocabulary is that token, whatever the merges would make of it.
A worker remembers the ids of pre-tokens, and merges those of a stretch of text that it has not met.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.llm.travel import stretches
from millrace.llm.workers import built

NEVER = np.int32(2**31 - 1)  # the rank of a pair that does not merge
CELLS = 1 << 19  # of a matrix
LONG = 256  # bytes from which a row has a matrix of its own
STRETCH = 1 << 21  # characters of text that are encoded together
REMEMBERED = 1 << 18  # pre-tokens in each of two generations of a worker's memory
EMPTY = np.int64(-1)


@dataclass
class PairTable:
    """Ranks of token pairs in an open hash table, a quarter full at most."""

    keys: np.ndarray
    ranks: np.ndarray
    bits: int

    @staticmethod
    def of(left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> PairTable:
        bits = max(4, int(4 * max(1, len(rank)) - 1).bit_length())
        table = PairTable(
            np.full(1 << bits, EMPTY), np.full(1 << bits, NEVER, np.int32), bits
        )
        keys, waiting = pair_key(left, right), np.arange(len(rank))
        slots = table.slot(keys)
        while len(waiting):
            free = table.keys[slots[waiting]] == EMPTY
            # Of several keys that want one free slot the first gets it.
            chosen = waiting[free]
            _, first = np.unique(slots[chosen], return_index=True)
            chosen = chosen[first]
            table.keys[slots[chosen]] = keys[chosen]
            table.ranks[slots[chosen]] = rank[chosen]
            waiting = waiting[table.keys[slots[waiting]] != keys[waiting]]
            slots[waiting] = (slots[waiting] + 1) & (len(table.keys) - 1)
        return table

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; padding, which is negative, merges with nothing."""
        keys = pair_key(left, right).ravel()
        slots = self.slot(keys)
        there = self.keys[slots]
        found = np.where(there == keys, self.ranks[slots], NEVER)
        on = np.flatnonzero((there != keys) & (there != EMPTY))
        while len(on):
            slots[on] = (slots[on] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[on]]
            hit = there == keys[on]
            found[on[hit]] = self.ranks[slots[on[hit]]]
            on = on[~hit & (there != EMPTY)]
        found[(left.ravel() < 0) | (right.ravel() < 0)] = NEVER
        return found.reshape(left.shape)


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.int64) << np.int64(32)) | (right.astype(np.int64) & np.int64(0xFFFFFFFF))


@dataclass
class Ranks:
    """A vocabulary of ranks: the bytes of each token, and which pairs merge to which token."""

    pieces: list[bytes]
    byte_ids: np.ndarray
    pairs: PairTable
    pattern: str
    newer: str
    digest: str


def read_ranks(path: str, pattern: str) -> Ranks:
    """What the encoders need of a file of ranks; some MB, fixed by the file, to be broadcast."""
    rank_of: dict[bytes, int] = {}
    digest = sha256(pattern.encode())
    with open(path, "rb") as file:
        for line in file:
            digest.update(line)
            if line.strip():
                piece, rank = line.split()
                rank_of[base64.b64decode(piece)] = int(rank)
    size = max(rank_of.values()) + 1
    pieces = [b""] * size
    for piece, rank in rank_of.items():
        pieces[rank] = piece
    found = [
        (left, right, rank)
        for piece, rank in rank_of.items()
        for i in range(1, len(piece))
        if (left := rank_of.get(piece[:i])) is not None
        and (right := rank_of.get(piece[i:])) is not None
    ]
    left, right, rank = np.array(found, np.int64).reshape(-1, 3).T
    missing = [b for b in range(256) if bytes([b]) not in rank_of]
    if missing:
        raise ValueError(f"{path} has no token for the bytes {missing}")
    byte_ids = np.array([rank_of[bytes([b])] for b in range(256)], np.int32)
    table = PairTable.of(left, right, rank.astype(np.int32))
    newer = newer_letters(pattern)
    return Ranks(pieces, byte_ids, table, pattern, newer, digest.hexdigest())


def newer_letters(pattern: str) -> str:
    """Code points that ``regex`` takes for letters or numbers and the rank library does not.

    Only those can differ that Python's own tables lack, being of a later Unicode. Under tokens of
    a letter or number and any first byte, two characters make a common token if the library sees
    them as one pre-token.
    """
    import tiktoken

    known = regex.compile(r"\p{L}|\p{N}")
    late = [
        c
        for c in map(chr, range(0x80, 0x110000))
        if unicodedata.category(c) == "Cn" and known.match(c)
    ]
    bytes_only = [bytes([b]) for b in range(256)]
    joined = [p + bytes([b]) for p in (b"a", b"1") for b in range(0xC2, 0xF5)]
    ranks = {piece: rank for rank, piece in enumerate(bytes_only + joined)}
    probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return "".join(
        c for c in late if all(probe.encode_ordinary(p + c)[0] < 256 for p in ("a", "1"))
    )


class MatrixEncoder:
    """Ids of texts, as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: Ranks) -> None:
        self.ranks = ranks
        self._newer = frozenset(ranks.newer)
        self._find = regex.compile(ranks.pattern).findall
        self._find_rare = self._find
        if ranks.newer:
            rare = ranks.pattern
            late = regex.escape(ranks.newer)
            for kind in ("L", "N"):
                inside = rf"[^\s\p{{L}}\p{{N}}]"
                rare = rare.replace(inside, rf"(?:[^\s\p{{L}}\p{{N}}]|[{late}])")
                rare = rare.replace(rf"\p{{{kind}}}+", rf"[\p{{{kind}}}--[{late}]]+")
            self._find_rare = regex.compile(rare, regex.V1).findall
        self._whole: dict[str, bytes] = {}
        for rank, piece in enumerate(ranks.pieces):
            try:
                self._whole[piece.decode()] = np.uint32(rank).tobytes()
            except UnicodeDecodeError:  # part of a letter: no pre-token
                pass
        self._young, self._old = dict(self._whole), {}

    def pretokens(self, text: str) -> list[str]:
        plain = text.isascii() or self._newer.isdisjoint(text)
        return self._find(text) if plain else self._find_rare(text)

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of each text of a stretch."""
        cut = [self.pretokens(text) for text in texts]
        unmet = set().union(*cut) - self._young.keys()
        known = self._old.keys() & unmet
        self._young.update((word, self._old[word]) for word in known)
        new = list(unmet - known)
        self._young.update(zip(new, self.merged([word.encode() for word in new])))
        ids = self._young.__getitem__
        packed = [b"".join(map(ids, words)) for words in cut]
        for word in new:
            if len(word) > LONG:
                del self._young[word]
        if len(self._young) - len(self._whole) > REMEMBERED:
            self._young, self._old = dict(self._whole), self._young
        return packed

    def merged(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of pre-tokens that are not in the vocabulary."""
        lengths = np.array([len(word) for word in words], np.int64)
        packed: list[bytes] = [b""] * len(words)
        order = np.argsort(lengths, kind="stable")
        start = int(np.searchsorted(lengths[order], 1))
        while start < len(order):
            shortest = int(lengths[order[start]])
            width = 1 << max(2, (shortest - 1).bit_length())
            if shortest > LONG:
                packed[order[start]] = self._long_row(words[order[start]])
                start += 1
                continue
            last = int(np.searchsorted(lengths[order], width, side="right"))
            chosen = order[start : min(last, start + max(1, CELLS // width))]
            for place, ids in self._matrix([words[i] for i in chosen], lengths[chosen], width):
                packed[chosen[place]] = ids
            start += len(chosen)
        return packed

    def _matrix(
        self, words: list[bytes], lengths: np.ndarray, width: int
    ) -> Iterator[tuple[int, bytes]]:
        """Place and packed ids of each row, in the order in which they are done."""
        ids = np.full((len(words), width), -1, np.int32)
        flat = np.frombuffer(b"".join(words), np.uint8)
        ids[np.arange(width) < lengths[:, None]] = self.ranks.byte_ids[flat]
        ranks = self.ranks.pairs.lookup(ids[:, :-1], ids[:, 1:])
        places, sizes = np.arange(len(words)), lengths.copy()
        while len(places):
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(places), np.int64)
            rows = np.arange(len(places))
            low = ranks[rows, best] if ranks.shape[1] else np.full(len(places), NEVER)
            done = low == NEVER
            if done.any():
                for place, size, row in zip(places[done], sizes[done], ids[done].astype("<u4")):
                    yield int(place), row[:size].tobytes()
                stay = ~done
                ids, ranks, places, sizes = ids[stay], ranks[stay], places[stay], sizes[stay]
                best, low = best[stay], low[stay]
                if not len(places):
                    return
                rows = np.arange(len(places))
            columns = np.arange(ids.shape[1] - 1)
            moved = columns + (columns > best[:, None])
            ids = np.take_along_axis(ids, moved, 1)
            ids[rows, best] = low
            ranks = np.take_along_axis(ranks, moved[:, :-1], 1)
            sizes = sizes - 1
            self._renew(ids, ranks, rows, best - 1)
            self._renew(ids, ranks, rows, best)

    def _renew(self, ids: np.ndarray, ranks: np.ndarray, rows: np.ndarray, at: np.ndarray) -> None:
        """Look up the pairs of each row at a place, where there is one."""
        there = (at >= 0) & (at < ranks.shape[1])
        rows, at = rows[there], at[there]
        ranks[rows, at] = self.ranks.pairs.lookup(ids[rows, at], ids[rows, at + 1])

    def _long_row(self, word: bytes) -> bytes:
        ids = self.ranks.byte_ids[np.frombuffer(word, np.uint8)]
        ranks = self.ranks.pairs.lookup(ids[:-1], ids[1:])
        while len(ranks) and (low := ranks.min()) < NEVER:
            at = np.flatnonzero(ranks == low)
            # Of places that follow each other every second one, from the left.
            first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
            nth = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
            at = self._before_lower(ids, at[nth % 2 == 0], low)
            ids[at] = low
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
            ranks = ranks[keep[:-1]] if keep[-1] else ranks[keep[:-1]][:-1]
            at = at - np.arange(len(at))
            beside = np.unique(np.concatenate([at - 1, at]))
            beside = beside[(beside >= 0) & (beside < len(ids) - 1)]
            ranks = ranks[: len(ids) - 1]
            ranks[beside] = self.ranks.pairs.lookup(ids[beside], ids[beside + 1])
        return ids.astype("<u4").tobytes()

    def _before_lower(self, ids: np.ndarray, at: np.ndarray, low: np.int32) -> np.ndarray:
        """Places up to the first whose merged token makes a pair of a lower rank than its own."""
        padded = np.concatenate([[np.int32(-1)], ids, [np.int32(-1)]])
        before, behind = padded[at], padded[at + 3]
        before[1:][np.diff(at) == 2] = low
        merged = np.full(len(at), low, np.int32)
        lookup = self.ranks.pairs.lookup
        lower = np.flatnonzero((lookup(before, merged) < low) | (lookup(merged, behind) < low))
        return at[: lower[0] + 1] if len(lower) else at


class MatrixDecoder:
    """Bytes of ids: all tokens' bytes in one table, cut by offsets."""

    def __init__(self, ranks: Ranks) -> None:
        self.table = np.frombuffer(b"".join(ranks.pieces), np.uint8)
        self.offsets = np.cumsum([0, *map(len, ranks.pieces)])

    def lists(self, lists: list[bytes]) -> list[bytes]:
        """The bytes of each list of packed ids, found for all of them at once."""
        ids = np.frombuffer(b"".join(lists), "<u4").astype(np.int64)
        starts = self.offsets[ids]
        lengths = self.offsets[ids + 1] - starts
        ends = np.concatenate([[0], np.cumsum(lengths)])
        places = np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)
        joined = self.table[places].tobytes()
        cuts = ends[np.cumsum([0, *(len(packed) // 4 for packed in lists)])]
        return [joined[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _worker(kind: type, ranks: Ranks):
    return built(kind, ranks.digest, lambda: kind(ranks))


def share_ranks(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The vocabulary on its way to the workers, once for encoding and decoding."""
    return spark.sparkContext.broadcast(read_ranks(path, pattern))


def matrix_encode(text: Column, shared: Broadcast) -> Column:
    """The text's ids as little-endian unsigned 32-bit integers in one binary.

    A null text counts as empty, and an empty one has no ids. Special strings are ordinary text.
    """

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        encoder = _worker(MatrixEncoder, shared.value)
        parts = [pa.array(encoder.texts(part), pa.binary()) for part in stretches(texts, "", STRETCH)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return encode(text)


def matrix_decode(ids: Column, shared: Broadcast) -> Column:
    """The bytes that ids of ``matrix_encode`` stand for; none for null or no ids."""

    @F.arrow_udf("binary")
    def decode(lists: pa.Array) -> pa.Array:
        decoder = _worker(MatrixDecoder, shared.value)
        parts = [pa.array(decoder.lists(part), pa.binary()) for part in stretches(lists, b"", STRETCH)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return decode(ids)
