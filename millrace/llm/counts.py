"""Token counts without encoding: whole-token pre-tokens first, merges for the rest.

Most pre-tokens are strings of the vocabulary. For each such string it is settled beforehand
whether the merges turn it into one token; those pre-tokens count one each, and only the rest go
through the merges. Nulls count as empty texts: no bytes, no tokens.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.llm.vocabulary import Vocabulary, read_vocabulary, vocabulary
from millrace.llm.workers import built

REMEMBERED = 1 << 18  # pre-tokens whose count a worker remembers
SHORT = 48  # symbols up to which the best pair is found by looking at all
NEVER = 1 << 62  # the rank of a pair that doesn't merge


def merged_length(words: Vocabulary, word: bytes) -> int:
    """Number of tokens that the merges leave of a pre-token."""
    symbols = [words.byte_ids[b] for b in word]
    if len(symbols) > SHORT:
        return _merged_by_heap(words, symbols)
    merge_of, never = words.merge_of.get, NEVER
    ranks = [merge_of(pair, never) for pair in zip(symbols, symbols[1:])]
    while ranks and (best := min(ranks)) < never:
        i = ranks.index(best)
        symbols[i] = best
        del symbols[i + 1], ranks[i]
        if i < len(ranks):
            ranks[i] = merge_of((best, symbols[i + 1]), never)
        if i:
            ranks[i - 1] = merge_of((symbols[i - 1], best), never)
    return len(symbols)


def _merged_by_heap(words: Vocabulary, symbols: list[int]) -> int:
    merge_of, n = words.merge_of, len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    waiting = [
        (merged, i, symbols[i], symbols[i + 1])
        for i in range(n - 1)
        if (merged := merge_of.get((symbols[i], symbols[i + 1]))) is not None
    ]
    heapq.heapify(waiting)
    left = n
    while waiting:
        merged, i, a, b = heapq.heappop(waiting)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue
        symbols[i], symbols[j] = merged, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        left -= 1
        for p, q in ((before[i], i), (i, after[i])):
            if p >= 0 and q < n:
                found = merge_of.get((symbols[p], symbols[q]))
                if found is not None:
                    heapq.heappush(waiting, (found, p, symbols[p], symbols[q]))
    return left


def whole_tokens(words: Vocabulary) -> frozenset[str]:
    """Strings of the vocabulary that the merges are proven to turn into one token."""
    proven = []
    for piece in words.id_of:
        if merged_length(words, piece) == 1:
            try:
                proven.append(piece.decode())
            except UnicodeDecodeError:  # part of a letter: no pre-token
                pass
    return frozenset(proven)


class Counter:
    """Counts tokens of texts; remembers the counts of pre-tokens that need merges."""

    def __init__(self, words: Vocabulary, whole: frozenset[str]) -> None:
        self.words, self.whole = words, whole
        self._known: dict[str, int] = {}

    def text(self, text: str) -> int:
        total, whole, known = 0, self.whole, self._known
        for special, words in self.words.pretokens(text):
            if special is not None:
                total += 1
            for word in words:
                if word in whole:
                    total += 1
                    continue
                n = known.get(word)
                if n is None:
                    n = merged_length(self.words, word.encode())
                    if len(known) >= REMEMBERED:
                        known.clear()
                    if len(word) <= 64:
                        known[word] = n
                total += n
        return total


def count_tokens(spark: SparkSession, text: Column, path: str) -> Column:
    """Number of tokens of the text; special strings inside it count as their token."""
    spec = read_vocabulary(path)
    shared = spark.sparkContext.broadcast((spec, whole_tokens(Vocabulary(spec))))

    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        spec, whole = shared.value
        tokens = built(Counter, spec["digest"], lambda: Counter(vocabulary(spec), whole)).text
        return pa.array([tokens(t or "") for t in texts.to_pylist()], pa.int64())

    return count(text)
