"""The operators on small tables against plain Python, and on the cases that break such code."""

import re
import tracemalloc
from collections import Counter, defaultdict
from random import Random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import jaccard, pages
from millrace.llm.bpe import bpe_decode, bpe_encode, token_count
from millrace.llm.components import components
from millrace.llm.counts import count_tokens
from millrace.llm.jaccard import Similarity, one_of_each, similar_documents
from millrace.llm.mixing import mixed_documents, mixed_sizes
from millrace.llm.pages import extract_pages, main_text
from millrace.llm.quality import document_statistics, fit_discriminant, quality_score
from millrace.llm.rules import judge_quality
from millrace.llm.search import nearest, whole_vectors
from millrace.llm.storage import ship_package
from millrace.llm.substrings import SuffixAutomaton, remove_repeats
from millrace.llm.urls import filter_urls

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 700}x{i % 11}" for i in range(5000))
ODD = [
    None, "", " \n\t", "one", "two words", "a b c", "a b c", "A b C", "x " * 60, LONG, LONG + " end",
    "<|endoftext|>é<|endoftext", "naïve\u00a0ça \x1c 12٣ don't", "a" * 3000, "😀 𝔘nicode ﷽",
]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def docs(spark):
    """Odd texts, repeated rows, a null id and a column whose name an operator might use."""
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [*ODD, f"start {passage} stop", f"other {passage} end", passage]
    rows = [(i, t, f"s{i % 3}" if i % 4 else None, i) for i, t in enumerate(texts)]
    rows += [rows[9], (None, passage, None, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long")


@pytest.fixture(scope="module")
def tables(spark):
    return "/root/testdata/sf0.001"


def collected(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def test_tokens_are_the_librarys(spark, docs):
    library = Tokenizer.from_file(VOCABULARY)
    ids = docs.select("doc_id", "text", bpe_encode(spark, F.col("text"), VOCABULARY).alias("ids"))
    both = ids.select(
        "*",
        bpe_decode(spark, F.col("ids"), VOCABULARY).alias("back"),
        token_count(F.col("ids")).alias("n"),
        count_tokens(spark, F.col("text"), VOCABULARY).alias("counted"),
    )
    for row in both.collect():
        expected = library.encode(row["text"] or "", add_special_tokens=False).ids
        raw = bytes(row["ids"])
        found = [int.from_bytes(raw[i : i + 4], "little") for i in range(0, len(raw), 4)]
        assert found == expected
        assert row["back"] == (row["text"] or "")
        assert row["n"] == row["counted"] == len(expected)


def test_repeats_are_those_of_a_plain_scan(spark, docs):
    found = remove_repeats(docs, window=20)
    assert set(found.columns) == {*docs.columns, "n_removed", "kept"}
    assert found.count() == docs.count()
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    seen, expected, done = set(), {}, set()
    for row in rows:
        if (row["doc_id"], row["text"]) in done:
            continue
        done.add((row["doc_id"], row["text"]))
        words = WORD.findall(row["text"] or "")
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(window)
        expected[row["doc_id"]] = [w for w, g in zip(words, gone) if not g], sum(gone)
    for row in found.collect():
        kept, n = expected[row["doc_id"]]
        assert (row["kept"], row["n_removed"]) == (" ".join(kept), n)
        assert WORD.findall(row["text"] or "") == kept


def test_automaton_counts_what_was_seen():
    automaton = SuffixAutomaton()
    automaton.add("a b c a b d".split())
    assert list(automaton.matches("c a b c a b d x a b".split())) == [1, 2, 3, 3, 4, 5, 6, 0, 1, 2]
    automaton.add("x a b".split())
    assert list(automaton.matches("x a b d".split())) == [1, 2, 3, 3]


def linked(rows, n, num, den):
    sets = {}
    for i, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n_grams = max(1, len(words) - n + 1) if words else 0
        sets[i] = {tuple(words[j : j + n]) for j in range(n_grams)}
    parent = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            common = len(sets[a] & sets[b])
            if common and den * common >= num * len(sets[a] | sets[b]):
                low, high = sorted((parent[a], parent[b]))
                parent = {k: low if v == high else v for k, v in parent.items()}
    return {i: (len(sets[i]), parent[i]) for i in sets}


@pytest.mark.parametrize("sim", [Similarity(3, 9, 10), Similarity(5, 4, 5), Similarity(2, 1, 2)])
def test_components_are_those_of_all_pairs(spark, docs, sim):
    base = [f"t{i}" for i in range(120)]
    near = [(100 + k, " ".join(base[:k] + ["new"] + base[k + 1 + k % 3 :])) for k in range(40)]
    more = [(r["doc_id"], r["text"]) for r in docs.where("doc_id is not null").distinct().collect()]
    rows = near + more
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    expected = linked(rows, sim.n, sim.num, sim.den)
    found = collected(similar_documents(frame, sim))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()} == expected
    kept = {r["doc_id"] for r in one_of_each(frame, sim).collect()}
    assert kept == {c for _, c in expected.values()}
    assert similar_documents(docs, sim).count() == docs.count()


def test_copies_apart_are_searched_in_small_cells(spark, monkeypatch):
    """Few pairs meet in a chunk, though half of the group is linked with nothing."""
    random = Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for k in range(1, 300):
        places = set(random.sample(range(150), random.choice([1, 2, 7, 8, 9])))
        rows.append((k, " ".join(f"n{k}x{i}" if i in places else w for i, w in enumerate(base))))
    # two linked with each other only
    twin = rows[-1][1].split()
    rows += [(300, " ".join([*twin[:60], *twin[61:]])), (301, " ".join([*twin[:90], *twin[91:]]))]
    sent = []
    through = jaccard.stored

    def spied(df):
        kept = through(df)
        if "cluster" in df.columns:
            met = kept.groupBy("cluster", "i", "j").count()
            sent.append(met.agg(F.sum(F.col("count") * F.col("count"))).first()[0] or 0)
        return kept

    monkeypatch.setattr(jaccard, "stored", spied)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    sim = Similarity(3, 9, 10)
    found = {i: (r["n_shingles"], r["component_id"]) for i, r in collected(similar_documents(frame, sim)).items()}
    assert found == linked(rows, 3, 9, 10)
    assert len({c for _, c in found.values()}) > 100
    assert sum(sent) < 300 * 300 / 2  # all pairs of the group, each once


def classes_apart(spark, texts, sim):
    """Numbers of the texts, all in one cell and none linked yet, that are searched for links."""
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    classes = jaccard.stored(jaccard._map_sets(frame, sim))
    cells = classes.select(F.lit(1).cast("bigint").alias("sig"), "class")
    known = spark.createDataFrame([], "node long, root long")
    apart = jaccard._apart(cells, known, classes, sim).join(classes, "class")
    return sorted(r["id"] for r in apart.select("id").collect())


def test_large_cells_are_searched_by_points(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    texts = [" ".join(f"t{k}x{i}" for i in range(100)) for k in range(30)]
    texts += [texts[17].replace("t17x50", "new"), texts[4].replace("t4x99", "")]
    assert classes_apart(spark, texts, Similarity(3, 9, 10)) == [4, 17, 30, 31]


def test_classes_of_a_cell_of_some_chunks_come_out_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 8)
    made, parts = [], jaccard._parts
    monkeypatch.setattr(jaccard, "_parts", lambda *given: made.append(parts(*given)) or made[-1])
    texts = [" ".join(f"t{k}x{i}" for i in range(100)) for k in range(60)]
    few = [*texts[:24], texts[17].replace("t17x50", "new"), texts[4].replace("t4x99", "")]
    assert classes_apart(spark, few, Similarity(3, 9, 10)) == [4, 17, 24, 25]
    assert made[0].count() == len(few)  # one row of each class
    many = [*texts, texts[59].replace("t59x50", "new"), texts[4].replace("t4x99", "")]
    assert classes_apart(spark, many, Similarity(3, 9, 10)) == [4, 59, 60, 61]
    assert made[2].groupBy("sig", "i", "j").count().count() > 1


def test_fine_points_leave_out_what_is_not_quite_similar(spark):
    random, base = Random(8), [f"w{i}" for i in range(400)]
    texts = []
    for k in range(12):
        places = set(random.sample(range(400), 8))
        texts.append(" ".join(f"n{k}" if i in places else w for i, w in enumerate(base)))
    near = texts[3].replace("w399", "end")
    assert classes_apart(spark, [*texts, near], Similarity(5, 4, 5)) == [3, 12]


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(301)} | {
        1000: 1000,
        1001: 1000,
    }


def test_rules_count_like_plain_python(spark, docs):
    rows = judge_quality(docs, docs.where("doc_id < 3").select("doc_id")).collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for row in rows:
        text = texts[row["doc_id"]]
        words = WORD.findall(text)
        triples = Counter(zip(words, words[1:], words[2:]))
        twice = {
            j
            for i, t in enumerate(zip(words, words[1:], words[2:]))
            if triples[t] > 1
            for j in (i, i + 1, i + 2)
        }
        assert row["n_words"] == len(words) and row["word_chars"] == sum(map(len, words))
        assert row["n_repeat_words"] == len(twice)
        assert row["base_failed"] == (len(words) < 50 or 100 * len(twice) > 50 * len(words))
        assert not (row["kept"] and row["base_failed"])


def test_mix_meets_its_targets(spark, docs):
    sized = spark.range(2000).selectExpr(
        "id as doc_id", "if(id % 3 = 0, null, concat('s', id % 7)) as source", "id % 97 as size"
    )
    rows = mixed_sizes(sized, (3, 1, 2), share=1.5, most=2.0).collect()
    assert len(rows) == 2000 and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    sums = defaultdict(int)
    for r in rows:
        sums[r["source_size"], r["target"]] += r["taken"]
    assert sum(t for _, t in sums) == pytest.approx(1.5 * sum(s for s, _ in sums))
    for (size, target), taken in sums.items():
        assert target <= 2 * size and taken == pytest.approx(target, rel=0.03)
    again = mixed_sizes(sized, (3, 1, 2), share=1.5, most=2.0).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    mixed = mixed_documents(docs.where("doc_id is not null").distinct(), (3, 1, 2), 1.5, 2.0)
    assert mixed.columns == docs.columns


def test_search_is_exact_with_ties(spark):
    rows = [(i, [((i * j) % 17 - 8) / 9 for j in range(1, 9)]) for i in range(300)]
    rows += [(300 + i, rows[50][1]) for i in range(20)]
    rows += [(300, None), (450, [1.0, None] + [0.0] * 6), (500, [float("nan")] * 8), rows[3]]
    frame = spark.createDataFrame(rows, "id long, embedding array<float>")
    vectors = frame.select("id", whole_vectors(F.col("embedding"), 256).alias("vec"))
    whole = {r["id"]: r["vec"] for r in vectors.where("vec is not null").collect()}
    found = defaultdict(list)
    for r in nearest(vectors, vectors.where("id % 50 = 0"), 5).orderBy("rank").collect():
        found[r["query_id"]].append((r["id"], r["score"]))
    assert set(found) == {i for i in whole if i % 50 == 0}
    for q, got in found.items():
        scores = [(-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q]
        assert got == [(i, -s) for s, i in sorted(scores)[:5]]


def test_urls_follow_the_longest_rule(spark):
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("block", "net", "/es/")]
    urls = [
        "http://A.Example.com/en/1?x=/fr/", "https://b.com/x", "http://example.net/es/", "no scheme",
        None, "http://notexample.com/en/", "x://example.com", "ftp://c.org/://d.com/en/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = {r["page_id"]: r for r in filter_urls(pages, rules).collect()}
    assert [rows[i]["rule"] for i in range(8)] == [
        "example.com/en/", "com/", "net/es/", None, None, "com/", None, None,
    ]
    assert rows[0]["host"] == "a.example.com" and rows[0]["path"] == "/en/1"
    assert (rows[7]["host"], rows[7]["path"]) == ("c.org", "/://d.com/en/")
    assert rows[3]["verdict"] == rows[4]["verdict"] == "allow"
    assert filter_urls(pages.where("page_id > 99"), rules).count() == 0


def test_pages_give_their_article(spark, monkeypatch):
    page = (
        "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=x>Home"
        "</a></nav><div class='cookie-notice'>We use cookies</div><article class='post-7'><h1>Head"
        " &amp; tail</h1><p>First <b>para\ngraph</b> here and more words to read.<br><p>Second one"
        "<div class=comments>nice!</div></article><aside>more</aside><footer>&copy; x</footer>"
    )
    wanted = "Head & tail First para graph here and more words to read. Second one"
    assert main_text(page, None) == wanted
    rows = [(1, "http://h/1", page), (2, "http://h/2", None), (3, None, ""), (4, "http://h/4", page[:-40])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in extract_pages(frame).collect()}
    assert found == {1: wanted, 2: "", 3: "", 4: wanted}
    monkeypatch.setattr(pages, "FEW_HOSTS", 0)  # the salted join
    again = extract_pages(frame)
    assert again.columns == [*frame.columns, "text"]
    assert {r["page_id"]: r["text"] for r in again.collect()} == found
    assert extract_pages(frame.where("false")).count() == 0


@pytest.mark.parametrize(
    "classes, kept",
    [
        ("content no-sidebar", True),
        ("post share-enabled", True),
        ("entry-content sidebar-left", True),
        ("has-sidebar", True),
        ("comment", False),
        ("comment body", False),
        ("comment-content", False),
        ("site-sidebar", False),
        ("ad no-print", False),
    ],
)
def test_classes_about_layout_keep_the_text(classes, kept):
    page = f"<body><div class='{classes}'><p>Words of it</p></div><nav>Home</nav></body>"
    assert main_text(page, None) == ("Words of it" if kept else "")


def test_points_bound_every_overlap():
    random, sim = Random(3), Similarity(5, 4, 5)
    draw = lambda n: np.array(random.sample(range(1 << 40), n), np.uint64)
    base = draw(3000)
    for size in (1, 5, 70, 600, 3000):
        kept, own = base[:size], draw(max(1, size // 9))
        one, other = np.unique(kept), np.unique(np.concatenate([kept[: size - size // 20], own]))
        sets = [one, other, draw(size)]
        points = [jaccard.coordinates(s) for s in sets]
        space = jaccard.same_space(points)
        common = len(np.intersect1d(one, other))
        assert space[:2].min(0).sum() >= common
        near = common >= sim.least_common(len(one) + len(other))
        found = jaccard.may_link(points, np.array([len(s) for s in sets]), [1, 2, 2], sim)
        assert found[:2] == [True, True] or not near
        assert not any(jaccard.may_link(points, np.array([len(s) for s in sets]), [1, 1, 1], sim))
    full = np.arange(600, dtype=np.uint64) << np.uint64(20)  # all in one coordinate
    point = jaccard.coordinates(full)
    assert point.max() == jaccard.FULL
    assert jaccard.same_space([point, point]).min(0).sum() >= len(full)


def test_points_of_a_part_take_little_memory():
    random = np.random.default_rng(4)
    points = [random.integers(0, 3, 8192).astype(np.uint8) for _ in range(128)]
    points[0][:] = jaccard.FULL  # full ones stay without an end in a space of few coordinates
    space = jaccard.same_space([*points[:2], points[2][:16]])
    assert (space[0] >= 1 << 30).all() and space[1].sum() == points[1].sum()
    tracemalloc.start()
    try:
        jaccard.may_link(points[1:], np.full(127, 8192), list(range(127)), Similarity(5, 4, 5))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 5 * 4 * 8192 * 128  # five spaces of 32-bit numbers


def test_points_without_full_coordinates_stay_narrow():
    random, sim = np.random.default_rng(5), Similarity(5, 4, 5)
    points = [random.integers(0, 4, n).astype(np.uint8) for n in [1024] * 120 + [2048] * 8]
    points[1][:] = points[0]
    sizes, labels = np.array([int(p.sum()) for p in points]), list(range(128))
    narrow, wide = jaccard.same_space(points), jaccard._wide_space(points, 1024)
    assert narrow.dtype == np.uint8 and (narrow == wide).all()
    both = [jaccard.BoxTree(space, sizes, sim) for space in (narrow, wide)]
    for i in range(128):
        found = [tree.similar(p[i], sizes[i]) for tree, p in zip(both, (narrow, wide))]
        assert found[0].tolist() == found[1].tolist()
    high = np.full(32, 200, np.uint8)  # full once it is folded
    assert jaccard.same_space([high, high[:16]]).tolist() == [[400] * 16, [200] * 16]
    tracemalloc.start()
    try:
        assert jaccard.may_link(points[:128], sizes, labels, sim)[:2] == [True, True]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 5 * 1024 * 128  # five spaces of 8-bit numbers


def test_classifier_on_held_out_documents(spark, tables):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = docs.select("doc_id", document_statistics(F.col("text")).alias("stats"))
    rows = stats.join(labels.selectExpr("doc_id", "quality as label"), "doc_id")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = fit_discriminant(rows.where(~held))
    scored = rows.where(held).select("doc_id", "label", quality_score(rows, F.col("stats"), model).alias("s"))
    right = [(r["s"] >= 0.3) == (r["label"] == 1) for r in scored.collect()]
    assert sum(right) / len(right) > 0.95
    empty = fit_discriminant(rows.where("false"))
    assert quality_score(rows, F.col("stats"), empty) is not None


def test_empty_tables(spark, docs):
    none = docs.where("false")
    assert remove_repeats(none).count() == 0
    assert similar_documents(none, Similarity()).count() == 0
    assert judge_quality(none, none.select("doc_id")).count() == 0
    assert mixed_sizes(none.selectExpr("doc_id", "source", "1L as size"), (3, 1, 2), 1.5, 2.0).count() == 0


