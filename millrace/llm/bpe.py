"""BPE encoding by backtracking over longest tokens, and decoding by an offset table.

A pre-token's merges are found without replaying them: a sequence of tokens is the result of the
merges exactly if every two neighbours are what the merges make of the two alone. The encoder
takes the longest token at each position, found by an Aho-Corasick automaton, keeps it if it is
compatible with its left neighbour, and else tries the next shorter token or steps back. Positions
that failed are not tried again and each position's longest token is found once, so the time is
linear in the pre-token. Up to the first neighbours that are not compatible, one pass of the
automaton gives the result; it goes on from there position by position.

Nulls count as empty texts and give no ids; decoding an empty or null list gives the empty text.
"""

from __future__ import annotations

from collections.abc import Callable
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.llm.travel import stretches
from millrace.llm.vocabulary import Vocabulary, read_vocabulary, vocabulary
from millrace.llm.workers import built

REMEMBERED = 1 << 18  # pre-tokens in each of two generations of a worker's memory
LONG = 64  # letters above which a pre-token is not remembered
STRETCH = 1 << 20  # characters of text that are encoded together


class Memory(dict):
    """Packed ids by pre-token; one that is not known is encoded when it is asked for.

    What the generation before knew is taken over when it is asked for again. Long pre-tokens are
    not kept.
    """

    def __init__(self, encode: Callable[[bytes], list[int]], before: dict[str, bytes]) -> None:
        super().__init__()
        self._encode, self._before = encode, before

    def __missing__(self, word: str) -> bytes:
        packed = self._before.get(word)
        if packed is None:
            ids = self._encode(word.encode())
            packed = pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONG:
            self[word] = packed
        return packed

    def next(self) -> Memory:
        """This memory, or a new one after it if it is full."""
        if len(self) < REMEMBERED:
            return self
        self._before = {}
        return Memory(self._encode, self)


class Encoder:
    """Ids of a text, by a vocabulary."""

    def __init__(self, words: Vocabulary) -> None:
        self.words = words
        size = max(words.pieces) + 1
        self.length, self.shorter = [0] * size, [-1] * size
        for i, piece in words.pieces.items():
            self.length[i] = len(piece)
        self.size, self.first, self.last = size, list(range(size)), list(range(size))
        self._merged: dict[int, int] = {}
        for (left, right), i in words.merge_of.items():
            self.first[i], self.last[i] = left, right
            self._merged[left * size + right] = i
        self._longest = ahocorasick.Automaton()
        for piece, i in words.id_of.items():
            self.shorter[i] = self._longest_proper_prefix(piece)
            self._longest.add_word(piece.decode("latin-1"), i)
        self._longest.make_automaton()
        self._compatible: dict[tuple[int, int], bool] = {}
        self._memory = Memory(self.pretoken, {})

    def _longest_proper_prefix(self, piece: bytes) -> int:
        for n in range(len(piece) - 1, 0, -1):
            if piece[:n] in self.words.id_of:
                return self.words.id_of[piece[:n]]
        return -1

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens, side by side, as they are."""
        key = (left, right)
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) >= REMEMBERED * 4:
                self._compatible.clear()
            known = self._compatible[key] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        # Undo the latest merge beside the border again and again. A pair across the border
        # that would have merged before the merge just undone contradicts the border.
        merged, size, first, last = self._merged.get, self.size, self.first, self.last
        bound = size
        while merged(left * size + right, bound) >= bound:
            if (left > right and last[left] != left) or first[right] == right:
                bound, whole = left, left
                left = last[whole]
                if left == whole:  # single bytes on both sides
                    return True
            else:
                bound, whole = right + 1, right
                right = first[whole]
        return False

    def pretoken(self, word: bytes) -> list[int]:
        letters = word.decode("latin-1")
        tokens = [token for _, token in self._longest.iter_long(letters)]
        compatible, known = self.compatible, self._compatible.get
        for i, pair in enumerate(zip(tokens, tokens[1:]), 1):
            fits = known(pair)
            if not (compatible(*pair) if fits is None else fits):
                return self._backtrack(letters, tokens[:i], tokens[i])
        return tokens

    def _backtrack(self, letters: str, tokens: list[int], token: int) -> list[int]:
        """The ids, from where the longest ``token`` does not fit behind ``tokens``."""
        length, shorter, iter_long = self.length, self.shorter, self._longest.iter_long
        compatible, known = self.compatible, self._compatible.get
        longest: dict[int, int] = {}  # by position, of those that are come to
        closed: set[int] = set()
        n, at = len(letters), sum(map(length.__getitem__, tokens))
        while True:
            end = at + length[token]
            fits = end not in closed
            if fits and tokens:
                fits = known((tokens[-1], token))
                if fits is None:
                    fits = compatible(tokens[-1], token)
            if fits:
                tokens.append(token)
                if end == n:
                    return tokens
                at, token = end, longest.get(end, -1)
                if token < 0:  # a single byte is a token, so the next match starts here
                    token = longest[at] = next(iter_long(letters, at))[1]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                closed.add(at)
                token = tokens.pop()
                at -= length[token]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text. Pre-tokens that were not met before are encoded once each."""
        packed = []
        for text in texts:
            ids = self._memory.__getitem__
            packed.append(
                b"".join(
                    b"".join(map(ids, words)) if special is None else np.uint32(special).tobytes()
                    for special, words in self.words.pretokens(text)
                )
            )
            self._memory = self._memory.next()
        return packed


class Decoder:
    """Texts of ids: one table of all pieces' bytes, cut by offsets."""

    def __init__(self, words: Vocabulary) -> None:
        size = max(words.pieces) + 1
        pieces = [words.pieces.get(i, b"") for i in range(size)]
        self.table = np.frombuffer(b"".join(pieces), np.uint8)
        self.offsets = np.cumsum([0, *map(len, pieces)])

    def bytes_of(self, ids: np.ndarray) -> bytes:
        starts = self.offsets[ids]
        lengths = self.offsets[ids.astype(np.int64) + 1] - starts
        before = np.cumsum(lengths) - lengths
        places = np.arange(lengths.sum()) + np.repeat(starts - before, lengths)
        return self.table[places].tobytes()


def _worker(kind: type, spec: dict):
    return built(kind, spec["digest"], lambda: kind(vocabulary(spec)))


def share_vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary on its way to the workers, once for encoding and decoding."""
    return spark.sparkContext.broadcast(read_vocabulary(path))


def bpe_encode(
    spark: SparkSession, text: Column, path: str, shared: Broadcast | None = None
) -> Column:
    """The text's ids as little-endian unsigned 32-bit integers in one binary."""
    shared = shared or share_vocabulary(spark, path)

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        encoder = _worker(Encoder, shared.value)
        parts = [pa.array(encoder.texts(part), pa.binary()) for part in stretches(texts, "", STRETCH)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    return encode(text)


def bpe_decode(
    spark: SparkSession, ids: Column, path: str, shared: Broadcast | None = None
) -> Column:
    """The text of ids as ``bpe_encode`` gives them; bytes that are no UTF-8 become U+FFFD."""
    shared = shared or share_vocabulary(spark, path)

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        to_bytes = _worker(Decoder, shared.value).bytes_of
        parts = [
            pa.array(
                [to_bytes(np.frombuffer(x, "<u4")).decode("utf-8", "replace") for x in part],
                pa.string(),
            )
            for part in stretches(lists, b"", STRETCH)
        ]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return decode(ids)


def token_count(ids: Column) -> Column:
    """Number of ids in a binary of ``bpe_encode``."""
    return (F.octet_length(ids) / 4).cast("bigint")
