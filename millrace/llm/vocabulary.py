"""The vocabulary, merges and pre-tokens of a byte-level BPE file."""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cached_property
from hashlib import sha256

import regex

from millrace.llm.workers import built

# Contractions, words, numbers, signs and white space of the pre-tokeniser.
PRETOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[{L}]+| ?[{N}]+| ?[^{s}{L}{N}]+|[{s}]+(?![^{s}])|[{s}]+"
BEYOND = re.compile("[\U00010000-\U0010ffff]")


def read_vocabulary(path: str) -> dict:
    """What the encoders need of a tokenizer file, small enough to broadcast (some MB, fixed).

    Raises where the file asks for something the encoders here don't do.
    """
    from tokenizers import Tokenizer

    with open(path, "rb") as file:
        raw = file.read()
    spec = json.loads(raw)
    model = spec["model"]
    splitter = spec.get("pre_tokenizer") or {}
    plain = model["type"] == "BPE" and splitter.get("type") == "ByteLevel"
    if not plain or spec.get("normalizer") or splitter.get("add_prefix_space"):
        raise ValueError(f"{path} is no plain byte-level BPE file")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    ids = model["vocab"]
    if any(ids[a + b] != 256 + i for i, (a, b) in enumerate(merges)):
        raise ValueError(f"the ids of {path} don't follow its merges")
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    splits = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    return {
        "ids": ids,
        "merges": merges,
        "special": special,
        "newer": newer_letters(splits),
        "digest": sha256(raw).hexdigest(),
    }


def newer_letters(pre_tokenize) -> str:
    """Code points that ``regex`` knows as letters or numbers and the tokenizer's tables don't.

    Only those can differ that Python's own tables lack, being of a later Unicode.
    """
    known = regex.compile(r"\p{L}|\p{N}")
    late = [
        c
        for c in map(chr, range(0x80, 0x110000))
        if unicodedata.category(c) == "Cn" and known.match(c)
    ]
    return "".join(c for c in late if all(len(pre_tokenize(p + c)) > 1 for p in "a1"))


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = {b: chr(b) for b in printable}, 0x100
    for byte in range(256):
        if byte not in letters:
            letters[byte] = chr(spare)
            spare += 1
    return [letters[b] for b in range(256)]


def ranges(letters: list[str]) -> str:
    """Characters in rising order as the inside of a class of a regular expression."""
    runs: list[list[str]] = []
    for c in letters:
        if runs and ord(c) == ord(runs[-1][1]) + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"{re.escape(a)}-{re.escape(b)}" for a, b in runs)


def splitter(newer: str) -> Callable[[str], list[str]]:
    """Cuts plain text into pre-tokens; ``newer`` are no letters or numbers.

    Python's own expressions take half the time of ``regex`` but know no classes of Unicode. They
    get the characters up to U+FFFF one by one, which they look up in a table; texts that go beyond
    are left to ``regex``.
    """
    low = "".join(c for c in map(chr, range(0x10000)) if not "\ud800" <= c <= "\udfff")
    members = {
        name: ranges([c for c in regex.findall(kind, low) if c not in newer])
        for name, kind in (("L", r"\p{L}"), ("N", r"\p{N}"), ("s", r"\s"))
    }
    find = re.compile(PRETOKENS.format(**members)).findall
    out = f"--[{regex.escape(newer)}]" if newer else ""
    kinds = {"L": rf"[\p{{L}}{out}]", "N": rf"[\p{{N}}{out}]", "s": r"\s"}
    find_any = regex.compile(PRETOKENS.format(**kinds), regex.V1).findall

    def split(text: str) -> list[str]:
        beyond = not text.isascii() and BEYOND.search(text)
        return find_any(text) if beyond else find(text)

    return split


class Vocabulary:
    """Pieces as bytes by id, merges by ids, and the pre-tokens of a text."""

    def __init__(self, spec: dict) -> None:
        byte_of = {c: b for b, c in enumerate(byte_letters())}
        ids = {k: v for k, v in spec["ids"].items() if k not in spec["special"]}
        self.id_of = {bytes(byte_of[c] for c in piece): i for piece, i in ids.items()}
        self.special = spec["special"]
        self.pieces: dict[int, bytes] = {i: piece for piece, i in self.id_of.items()}
        self.pieces |= {i: piece.encode() for piece, i in self.special.items()}
        self.merge_of = {
            (ids[a], ids[b]): 256 + rank for rank, (a, b) in enumerate(spec["merges"])
        }
        self._find = splitter(spec["newer"])
        marks = sorted(self.special, key=len, reverse=True)
        self._marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None

    def pretokens(self, text: str) -> Iterator[tuple[int | None, list[str]]]:
        """Stretches of the text: the id of a special string, or None and pre-tokens."""
        find = self._find
        if not self._marks or not any(mark in text for mark in self.special):
            yield None, find(text)
            return
        for part in self._marks.split(text):
            if part in self.special:
                yield self.special[part], []
            elif part:
                yield None, find(part)

    @cached_property
    def byte_ids(self) -> list[int]:
        return [self.id_of[bytes([b])] for b in range(256)]


def vocabulary(spec: dict) -> Vocabulary:
    """The vocabulary of a broadcast spec, built once per worker process."""
    return built(Vocabulary, spec["digest"], lambda: Vocabulary(spec))
