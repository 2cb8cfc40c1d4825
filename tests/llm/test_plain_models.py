"""Pre-tokens, the encoder's memory and the url models against the libraries and plain Python."""

import json
import math
import pickle
import unicodedata
import weakref
from collections import Counter
from random import Random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, jaccard, matrix_bpe, substrings, urls, workers
from millrace.llm.storage import ship_package
from millrace.llm.vocabulary import Vocabulary, ranges, read_vocabulary

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def words():
    return Vocabulary(read_vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def pieces(library, text):
    raw = text.encode()
    byte_of = [0]
    for c in text:
        byte_of.append(byte_of[-1] + len(c.encode()))
    found = library.pre_tokenizer.pre_tokenize_str(text)
    return [raw[byte_of[a] : byte_of[b]].decode() for _, (a, b) in found]


def test_runs_of_characters():
    assert ranges(list("abcx")) == "a-cx-x"
    assert ranges(["]", "^"]) == r"\]-\^"
    assert ranges([]) == ""


@pytest.mark.parametrize("beyond", ["", "𝔘"])
def test_every_character_is_cut_like_the_librarys(words, library, beyond):
    """Each as a letter, number, sign or space beside others, by both expressions."""
    known = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    known = [c for c in known if unicodedata.category(c) not in ("Cn", "Co")]
    if not beyond:
        known = [c for c in known if c <= "￿"]
    for i in range(0, len(known), 500):
        text = "".join(f"a{c}1{c} {c}!{c}  {c}\n" for c in known[i : i + 500]) + beyond
        assert [w for _, part in words.pretokens(text) for w in part] == pieces(library, text)


def test_encoder_forgets_and_finds_again(words, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 40)
    random, encoder = Random(3), bpe.Encoder(words)
    letters = "aeiounrstlhd '.é漢1"
    texts = ["".join(random.choice(letters) for _ in range(200)) for _ in range(150)]
    texts += ["ab" * 3000, "", " ", "<|endoftext|>", "zyxw" * 40 + " end"]
    for text in [*texts, *texts[::-1]]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.texts([text]) == [np.array(ids, "<u4").tobytes()]
        assert len(encoder._memory) < 40
        assert all(len(word) <= bpe.LONG for word in encoder._memory)
    assert encoder.texts(texts) == [encoder.texts([t])[0] for t in texts]


def test_a_worker_keeps_one_encoder_of_a_file_however_often_it_is_sent(monkeypatch, tmp_path):
    """Each job broadcasts the file again, and workers outlive jobs."""
    monkeypatch.setattr(workers, "_kept", {})
    spec = read_vocabulary(PATH)
    ranks = matrix_bpe.read_ranks(RANKS, public_tokenizers.PATTERN)
    for kind, sent, module in ((bpe.Encoder, spec, bpe), (matrix_bpe.MatrixDecoder, ranks, matrix_bpe)):
        first = module._worker(kind, pickle.loads(pickle.dumps(sent)))
        assert all(module._worker(kind, pickle.loads(pickle.dumps(sent))) is first for _ in range(3))
    assert sum(map(len, workers._kept.values())) == 3  # a vocabulary, its encoder and a decoder


class Mapped:
    """Stands for documents; keeps the function that a worker would run."""

    def mapInArrow(self, rows, schema):  # noqa: N802
        self.rows = rows
        return self

    def withColumn(self, name, column):  # noqa: N802
        return self


@pytest.mark.parametrize("step", [jaccard._map_sets, jaccard._map_signatures, substrings._map_segments])
def test_other_steps_do_not_keep_an_encoder_beside_them(monkeypatch, step):
    monkeypatch.setattr(workers, "_kept", {})
    spec, text = read_vocabulary(PATH), " ".join(f"w{i % 40}" for i in range(90))
    before = bpe._worker(bpe.Encoder, spec).texts([text])
    kept, batch = weakref.ref(bpe._worker(bpe.Encoder, spec)), pa.record_batch({"id": [1], "text": [text]})
    how = 20 if step is substrings._map_segments else jaccard.Similarity()
    assert sum(b.num_rows for b in step(Mapped(), how).rows(iter([batch])))
    assert not workers._kept and kept() is None
    assert bpe._worker(bpe.Encoder, spec).texts([text]) == before  # built again


def test_a_worker_tells_files_apart_and_keeps_few(monkeypatch, tmp_path):
    monkeypatch.setattr(workers, "_kept", {})
    whole = json.loads(open(PATH, encoding="utf-8").read())
    specs = []
    for n in range(workers.KEPT + 1):  # the same tokens, fewer and fewer merges of them
        model = whole["model"]
        model["merges"] = model["merges"][: 1000 >> n]
        model["vocab"] = {k: i for k, i in model["vocab"].items() if i < 256 + (1000 >> n)}
        path = tmp_path / f"{n}.json"
        path.write_text(json.dumps(whole), encoding="utf-8")
        specs.append((str(path), read_vocabulary(str(path))))
    text = "the words of a sentence that is merged"
    for path, spec in [*specs, *specs[::-1]]:
        ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
        assert bpe._worker(bpe.Encoder, spec).texts([text]) == [np.array(ids, "<u4").tobytes()]
        assert len(workers._kept) <= workers.KEPT


def symbols(address):
    """Numbers of the characters: letters without case, digits alike, bytes beyond ASCII alike."""
    known = {s: i + 1 for i, s in enumerate(urls.SIGNS)}
    known |= {s.upper(): i for s, i in known.items()} | {str(d): known["0"] for d in range(10)}
    return [known.get(chr(b), urls.SYMBOLS - 1) for b in address.encode()]


def plain_model(addresses):
    """Chance of a symbol behind others, each order smoothed by the one below."""
    seen, total, kinds = Counter(), Counter(), Counter()
    for address in addresses:
        codes = [0] * 3 + symbols(address)
        for i in range(3, len(codes)):
            for order in range(4):
                context = tuple(codes[i - order : i])
                kinds[context] += (context, codes[i]) not in seen
                seen[context, codes[i]] += 1
                total[context] += 1

    def chance(context, code):
        below = chance(context[1:], code) if context else 1 / urls.SYMBOLS
        weight = max(kinds[context], 1)
        return (seen[context, code] + weight * below) / (total[context] + weight)

    return chance


def plain_score(address, accepted, rejected):
    codes = [0] * 3 + symbols(address)
    logs = [
        math.log(accepted(tuple(codes[i - 3 : i]), codes[i]) / rejected(tuple(codes[i - 3 : i]), codes[i]))
        for i in range(3, len(codes))
    ]
    return sum(logs) / len(logs) if logs else 0.0


def plain_limit(scored):
    """The edge between hundredths with the least sum of both error rates, nearest to zero."""
    places = [(math.floor(abs(s) * 100 + 0.5) * (1 if s >= 0 else -1), a) for s, a in scored]
    good = [p for p, a in places if a]
    bad = [p for p, a in places if not a]
    best = []
    for edge in range(-3000, 3002):
        lost = sum(p < edge for p in good) / len(good)
        passed = sum(p >= edge for p in bad) / len(bad)
        best.append((round(lost + passed, 12), abs((edge - 0.5) / 100), (edge - 0.5) / 100))
    return min(best)[2]


def test_url_verdicts_are_those_of_plain_models(spark):
    ship_package(spark)
    random = Random(11)
    good = ["news", "article", "story", "world", "2024"]
    bad = ["win", "casino", "xxx", "88", "bonus"]
    rows = []
    for i in range(240):
        parts, host = ((good, "daily.com"), (bad, "luck.net"), (good + bad, "else.org"))[i % 3]
        path = "/".join(random.choice(parts) for _ in range(random.randrange(0, 5)))
        rows.append((i, f"https://{random.choice('abc')}.{host}/{path}?q=1", "kept"))
    rows += [(900, None, None), (901, "", "x"), (902, "é://Ü/%zz", "x"), rows[0], rows[0]]
    rules = [("allow", "com", "/"), ("block", "net", "/")]
    pages = spark.createDataFrame(rows, "page_id long, url string, score string")
    found = urls.filter_urls(pages, rules).collect()
    assert len(found) == len(rows)
    allowed = [r.host + r.path for r in found if r.rule == "com/"]
    blocked = [r.host + r.path for r in found if r.rule == "net/"]
    models = plain_model(allowed), plain_model(blocked)
    limit = plain_limit(
        [(plain_score(a, *models), True) for a in allowed] + [(plain_score(a, *models), False) for a in blocked]
    )
    judged = set()
    for row in found:
        score = plain_score(row.host + row.path, *models)
        assert row.score == pytest.approx(score, abs=1e-5)
        if row.rule:
            assert row.verdict == {"com/": "allow", "net/": "block"}[row.rule]
        elif row.host + row.path:
            assert abs(score - limit) > 1e-5
            assert row.verdict == ("allow" if score >= limit else "block")
            judged.add(row.verdict)
        else:
            assert row.verdict == "allow"
    assert judged == {"allow", "block"}
