"""The trie, whitening and matrix BPE, and rows that share an id, against plain Python."""

import hashlib
import zlib
from base64 import b64decode
from collections import Counter, defaultdict
from itertools import pairwise
from math import fmod
from random import Random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from checking import assert_same, duckdb_views
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import queries
from millrace.llm.jaccard import Similarity, one_of_each, similar_documents
from millrace.llm.matrix_bpe import (
    MatrixDecoder,
    MatrixEncoder,
    PairTable,
    matrix_decode,
    matrix_encode,
    read_ranks,
    share_ranks,
)
from millrace.llm.mixing import mixed_documents, mixed_shards, mixed_sizes, shard_counts
from millrace.llm.storage import ship_package
from millrace.llm.substrings import remove_repeats
from millrace.llm.trie import COLUMNS, rebuilt_prefixes, sketch, trie_nodes, turn_digests
from millrace.llm.whitening import Moments, fixed_point, whitened

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TURNS = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(RANKS, public_tokenizers.PATTERN)


# Trie


def plain_nodes(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in turns.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(fmod(c, 100)), [])[:h] + ts[h:]
    nodes, below = defaultdict(list), defaultdict(list)
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes[tuple(ts[:d])].append(c)
    for path in nodes:
        if path:
            below[path[:-1]].append(path)
    leaves, saved, out = {}, {}, set()
    for path in sorted(nodes, key=len, reverse=True):
        members, own_chars = nodes[path], len(path[-1][1]) if path else 0
        leaves[path] = sum(leaves[p] for p in below[path]) or 1
        saved[path] = sum(saved[p] for p in below[path]) + (len(members) - 1) * own_chars
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        out.add((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
            len(below[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    assert len(out) == len(nodes)
    return out


def odd_conversations():
    random = Random(3)
    rows = [
        (
            random.choice([None, *range(-250, 260)]),
            random.choice([None, *range(7)]),
            random.choice(["user", "assistant", None]),
            random.choice(["", "x", "yy", "naïve 😀", None]),
        )
        for _ in range(2000)
    ]
    hot = [(777, i, "user", "again") for i in range(400)]  # far more turns than the others
    copies = [(c, i, "user", f"turn {i}") for c in (801, 802, 803) for i in range(40)]
    return [*rows, *rows[:50], *hot, *copies, (900, 0, "user", "long " * 20_000)]


@pytest.mark.parametrize("long_turns, cells", [(1 << 16, 1 << 22), (30, 256)])
def test_trie_is_that_of_plain_python(spark, long_turns, cells):
    rows = odd_conversations()
    # A column whose name an operator might use.
    turns = spark.createDataFrame(rows, TURNS).withColumn("depth", F.lit("d"))
    prefixes = rebuilt_prefixes(turn_digests(turns), long_turns=long_turns)
    found = trie_nodes(prefixes, cells)
    assert found.columns == COLUMNS
    assert {tuple(r) for r in found.collect()} == plain_nodes(rows)


def test_trie_of_nothing(spark):
    for rows in ([], [(None, 0, "user", "x")]):
        turns = spark.createDataFrame(rows, TURNS)
        assert trie_nodes(rebuilt_prefixes(turn_digests(turns))).count() == 0


def test_conversation_may_be_left_without_turns(spark):
    conv = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(conv, 0, "user", "x")]
    found = trie_nodes(rebuilt_prefixes(turn_digests(spark.createDataFrame(rows, TURNS))))
    assert {tuple(r) for r in found.collect()} == plain_nodes(rows)
    assert found.count() == 1


def test_sketch_never_counts_too_low(spark):
    digests = spark.range(500).select(
        F.lit(1).alias("depth"),
        F.xxhash64(F.col("id") % 400).alias("x"),
        F.xxhash64(F.lit(1), F.col("id") % 400).alias("y"),
    )
    often = np.unpackbits(sketch(digests, 14))
    assert 100 * 4 * 0.9 < often.sum() < 4 * 130  # the hundred that are there twice, and few more
    assert not sketch(digests.where("x is null"), 8).any()


def test_trie_against_sql(spark):
    con = duckdb_views(SF)
    result = queries.QUERIES["op11_prefix_trie"](spark, SF)
    assert_same(result, con, queries.ORACLE["op11_prefix_trie"])


# Whitening


def vectors_of(spark, vectors):
    schema = "id long, embedding array<double>, vec_extra string"
    rows = [(i, v, "x") for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, schema)
    return frame.select("id", fixed_point(F.col("embedding"), 1024, 100_000).alias("vec"))


def check_whitening(rows, found, wanted):
    x = np.array(rows, object)
    n, sums = len(x), x.sum(axis=0)
    c = (n * x - sums).astype(float) / n
    values, directions = np.linalg.eigh(c.T @ c / n)
    values, directions = values[::-1][:wanted], directions[:, ::-1][:, :wanted]
    table = found.toPandas()
    assert len(table) == n * wanted and set(table.n) == {n}
    by_row = table.pivot(index="id", columns="component", values="whitened").sort_index().to_numpy()
    expected = c @ directions / np.sqrt(values)
    signs = np.sign((expected * by_row).sum(axis=0))
    assert np.abs(by_row - expected * signs).max() < 1e-8
    shares = table.drop_duplicates("component").sort_values("component").explained.to_numpy()
    assert np.allclose(shares, values / np.trace(c.T @ c / n), rtol=1e-9)
    assert table.identity_error.max() < 1e-9 and table.identity_error.nunique() == 1
    deviation = table.drop_duplicates("id").sort_values("id").deviation
    assert [int(d) for d in deviation] == [int(((n * r - sums) ** 2).sum()) for r in x]


def test_whitening_is_that_of_plain_numpy(spark):
    random = np.random.default_rng(1)
    vectors = random.normal(size=(300, 12)) * np.geomspace(3, 0.05, 12)
    vectors[:100] = vectors[0]  # a third of the rows are equal
    odd = [None, [], [1.0] * 11, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [None] + [0.0] * 11]
    frame = vectors_of(spark, [*vectors.tolist(), *odd])
    rows = (np.floor(vectors * 1024) + 100_000).astype(np.int64)
    check_whitening(rows.tolist(), whitened(frame), 8)


def test_whitening_of_equal_variances(spark):
    # Every direction has the same variance, so one start reaches only one of them.
    vectors = [[float(s * (i == j)) for j in range(4)] for i in range(4) for s in (1, -1)]
    found = whitened(vectors_of(spark, vectors)).toPandas()
    assert sorted(set(found.component)) == [1, 2, 3, 4]
    assert np.allclose(found.explained, 0.25) and found.identity_error.max() < 1e-9


def test_whitening_of_little(spark):
    assert whitened(vectors_of(spark, [])).count() == 0
    assert whitened(vectors_of(spark, [None])).count() == 0
    assert whitened(vectors_of(spark, [[1.0, 2.0]] * 3)).count() == 0  # no variance
    line = whitened(vectors_of(spark, [[1.0, 2.0], [2.0, 4.0], [4.0, 8.0]]))
    assert {r.component for r in line.collect()} == {1}  # one direction has any


def test_deviations_are_exact_at_any_size():
    for n in (3, 10**9, 10**14):
        x = np.array([[100_001, 99_000], [100_500, 101_024]])
        sums = [100_000 * n + 7, 100_000 * n - 9]
        exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
        assert [int(d) for d in Moments(n, sums).deviations(x)] == exact


# Matrix BPE


def odd_texts():
    random = Random(0)
    letters = "ab1 \n\t'sé漢字🙂̀\x1c\x85᠎ 　'tlre٣Ⅷ²!?-_=+\x00<|>"
    texts = ["".join(random.choice(letters) for _ in range(random.randrange(60))) for _ in range(800)]
    for alphabet in ("a", "ab", "abcdefghij", "aA1!"):
        for size in (255, 256, 257, 1000, 20_000):
            texts.append("".join(random.choice(alphabet) for _ in range(size)))
    return ["", " ", "<|endoftext|>", "don't", *texts, "word " * 30_000]


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_matrix_ids_are_the_librarys(library, ranks):
    texts = odd_texts()
    encoder, decoder = MatrixEncoder(ranks), MatrixDecoder(ranks)
    found = encoder.texts(texts)
    assert found == [packed(library.encode_ordinary(t)) for t in texts]
    assert encoder.texts(texts[::-1]) == found[::-1]  # now from memory
    assert decoder.lists(found) == [t.encode() for t in texts]


def test_memory_has_two_generations(library, ranks, monkeypatch):
    monkeypatch.setattr("millrace.llm.matrix_bpe.REMEMBERED", 50)
    encoder, texts = MatrixEncoder(ranks), odd_texts()
    for text in [*texts[:200], *texts[:200]]:
        assert encoder.texts([text]) == [packed(library.encode_ordinary(text))]
    assert len(encoder._young) <= len(encoder._whole) + 200


def test_every_row_merges_its_leftmost_lowest_pair(library, ranks):
    random = Random(5)
    words = ["".join(random.choice("abcdeé漢") for _ in range(random.randrange(1, 80))) for _ in range(400)]
    words = [w.encode() for w in words if w.encode() not in ranks.pieces]
    found = MatrixEncoder(ranks).merged(words)
    assert found == [packed(library._encode_bytes(w)) for w in words]


def test_pair_table():
    random = np.random.default_rng(2)
    pairs = np.unique(random.integers(0, 300, (3000, 2)), axis=0)
    table = PairTable.of(pairs[:, 0], pairs[:, 1], np.arange(len(pairs), dtype=np.int32))
    assert (table.lookup(pairs[:, 0], pairs[:, 1]) == np.arange(len(pairs))).all()
    known = set(map(tuple, pairs.tolist()))
    others = np.array([(a, b) for a in range(-1, 60) for b in range(-1, 60) if (a, b) not in known])
    assert (table.lookup(others[:, 0], others[:, 1]) == 2**31 - 1).all()


def test_matrix_bpe_of_a_table(spark, library):
    texts = [None, *odd_texts()[:50], "same", "same"]
    docs = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(texts)], "doc_id long, text string, ids binary")
    shared = share_ranks(spark, RANKS, public_tokenizers.PATTERN)
    encoded = docs.withColumn("own", matrix_encode(F.col("text"), shared))
    both = encoded.withColumn("back", matrix_decode(F.col("own"), shared)).collect()
    assert len(both) == len(texts)
    for row in both:
        text = texts[row.doc_id] or ""
        assert bytes(row.own) == packed(library.encode_ordinary(text))
        assert bytes(row.back).decode() == text
    empty = docs.where("doc_id < 0").select(matrix_encode(F.col("text"), shared).alias("i"))
    assert empty.select(matrix_decode(F.col("i"), shared)).count() == 0


def test_matrix_query_over_the_documents(spark, library):
    found = queries.QUERIES["op13_matrix_bpe"](spark, SF).toPandas().set_index("doc_id")
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(texts)
    for row in texts:
        ids = library.encode_ordinary(row.text or "")
        assert found.n_tokens[row.doc_id] == len(ids)
        assert found.ids_sha256[row.doc_id] == hashlib.sha256(packed(ids)).hexdigest()
        plain = hashlib.sha256((row.text or "").encode()).hexdigest()
        assert found.decoded_sha256[row.doc_id] == plain


# Rows that share an id


def many_of_one_id(spark):
    """A thousand rows without an id, some of one id, and passages that they share."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for i in range(1000):
        own = " ".join(f"w{i}x{j}" for j in range(25 + i % 7))
        text = f"{own} {passage}" if i % 4 == 0 else own
        rows.append((None if i % 2 else 5, text, f"s{i % 3}"))
    rows += [rows[0], rows[0], (5, None, None), (None, "", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def words_of(text):
    return (text or "").split()


def test_repeats_among_rows_of_one_id(spark):
    docs = many_of_one_id(spark)
    found = remove_repeats(docs, window=20).collect()
    assert len(found) == docs.count()
    # One of the 250 texts keeps the passage; rows of one id and text are one document.
    lost = Counter(r.n_removed for r in found)
    assert set(lost) == {0, 30} and lost[30] in (249, 251)
    before = Counter(w for r in docs.collect() for w in set(words_of(r.text)))
    kept = Counter(w for r in found for w in words_of(r.kept))
    assert set(kept) == set(before)  # nothing that is there once is lost
    with pytest.raises(ValueError, match="window"):
        remove_repeats(docs, window=5000)


def test_one_row_of_each_component_stays(spark):
    docs = many_of_one_id(spark)
    kept = one_of_each(docs, Similarity(n=5, num=4, den=5))
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 2
    texts = Counter(r.text for r in kept.collect())
    assert set(texts) == {r.text for r in docs.collect()}
    linked = similar_documents(docs, Similarity(n=3, num=9, den=10))
    assert linked.columns == ["doc_id", "n_shingles", "component_id"]
    assert linked.count() == docs.count()


def test_mix_keeps_its_cap_on_repeated_rows(spark):
    words = " ".join(f"w{i}" for i in range(300))
    rows = [(1, words, "a")] * 6 + [(None, f"{words} n{i}", "b") for i in range(6)] + [(2, words, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixed_documents(docs, (3, 1, 2), share=1.5, most=2.0).collect()
    assert len(mixed) <= len(rows)
    assert all(len(words_of(r.text)) <= 2 * 301 for r in mixed)
    sized = docs.select("doc_id", "source", F.size(F.split("text", " ")).alias("size"))
    sized = sized.withColumn("doc_id", F.monotonically_increasing_id())
    taken = mixed_sizes(sized, (3, 1, 2), share=1.5, most=2.0).agg(F.sum("taken")).first()[0]
    total = sum(len(words_of(r.text)) for r in mixed)
    assert abs(total - taken) <= 6 * 128 and total > 0


def test_shards_are_made_of_blocks(spark):
    sized = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
        (F.col("id") % 400 + 1).alias("size"),
    )
    slots = mixed_shards(sized, (3, 1, 2), share=1.5, most=2.0).collect()
    blocks, words = defaultdict(set), defaultdict(int)
    for r in slots:
        blocks[r.shard, r.slot].add((r.source_no, r.block))
        words[r.shard, r.slot] += r.piece_words
    assert all(len(b) == 1 for b in blocks.values())  # each slot has one block
    places = sorted(blocks)
    assert all(b == (a[0], a[1] + 1) or b == (a[0] + 1, 0) for a, b in pairwise(places))
    assert sum(n != 128 for n in words.values()) <= 3 * 2  # only a source's last block is short
    taken = mixed_sizes(sized, (3, 1, 2), share=1.5, most=2.0)
    by_doc = Counter()
    for r in slots:
        by_doc[r.doc_id] += r.piece_words
    assert {r.doc_id: r.taken for r in taken.where("taken > 0").collect()} == dict(by_doc)
    counts = shard_counts(spark.createDataFrame([r.asDict() for r in slots])).collect()
    assert sum(r.n for r in counts) == len(blocks)
    full = {r.shard for r in counts if r.shard < max(r.shard for r in counts)}
    for shard in full:  # each source's count in a full shard is near its share of all slots
        for no in {r.source_no for r in counts}:
            share = sum(r.n for r in counts if r.source_no == no) / len(blocks)
            n = next(r.n for r in counts if (r.shard, r.source_no) == (shard, no))
            assert abs(n - 4096 * share) < 5 * (4096 * share * (1 - share)) ** 0.5


# The registered queries and the pipeline


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_against_sql(spark, name):
    if name != "op11_prefix_trie":
        assert_same(queries.QUERIES[name](spark, SF), duckdb_views(SF), queries.ORACLE[name])


def test_pipeline_stages(spark):
    columns = spark.read.parquet(f"{SF}/documents.parquet").columns
    docs, sizes = queries.table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "tokens":
            assert docs.columns == columns
        rows = docs.collect()
        sizes.append(len(rows))
        docs = spark.createDataFrame(rows, docs.schema)
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    assert all(r.exact for r in rows)
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens").collect()} == {
        (r.doc_id, r.n_tokens) for r in rows
    }
