from millrace.operators import tokens, total_with_prefix, word_count
from millrace.plans import word_count_stream, word_count_table
from millrace.queries import QUERIES
from millrace.queries.inputs import scratch_table
from millrace.sources import sentences
from millrace.streaming import Snapshots, table_saver

TEXT = "The cat sat.\nOn the  Mat, 42 x1.  End\n"
WORDS = ["the", "cat", "sat", "\non", "the", "mat,", "x1", "end\n"]


def text_file(spark, path, text):
    # The writer ends the row with the given separator, here nothing that the text holds.
    spark.createDataFrame([(text,)], "value string").write.option("lineSep", "|").text(path)
    return path


def test_tokens_of_sentences_read_from_text(spark, root):
    path = f"{root}/text"
    spark.createDataFrame([(TEXT,)], "value string").write.option("lineSep", ".").text(path)
    words = [row.word for row in tokens(sentences(spark, path)).collect()]
    assert sorted(words) == sorted(WORDS)
    counts = {row["word"]: row["count"] for row in word_count(tokens(sentences(spark, path))).collect()}
    assert counts == {w: WORDS.count(w) for w in WORDS}


def test_separator_is_the_callers(spark, root):
    path = text_file(spark, f"{root}/text", "a b|c|d.e")
    assert [r.value for r in sentences(spark, path, separator="|").collect()] == ["a b", "c", "d.e"]


def test_tokens_cut_at_any_white_space(spark):
    df = spark.createDataFrame([("a\nb  c",), (None,)], "value string")
    assert [r.word for r in tokens(df, pattern=r"\s+").collect()] == ["a", "b", "c"]
    assert [r.word for r in tokens(df).collect()] == ["a\nb", "c"]


def test_tokens_carry_columns(spark):
    df = spark.createDataFrame([(1, "x y"), (2, "z")], "id int, body string")
    rows = tokens(df, "body", keep=["id"]).collect()
    assert [(r.id, r.word) for r in rows] == [(1, "x"), (1, "y"), (2, "z")]


def test_total_with_prefix(spark):
    counts = spark.createDataFrame([("sea", 2), ("sun", 3), ("ash", 4)], "word string, count bigint")
    assert total_with_prefix(counts, "s").first().total == 5
    assert total_with_prefix(counts, "su").first().total == 3


def test_table_is_replaced(spark, root):
    first = text_file(spark, f"{root}/one", "a b a")
    second = text_file(spark, f"{root}/two", "c")
    with scratch_table(spark) as name:
        word_count_table(spark, first, name, f"{root}/table", separator="|")
        assert {tuple(r) for r in spark.table(name).collect()} == {("a", 2), ("b", 1)}
        word_count_table(spark, second, name, f"{root}/table", separator="|")
        assert {tuple(r) for r in spark.table(name).collect()} == {("c", 1)}


def test_stream_counts_files_as_they_come(spark, root):
    result = Snapshots(f"{root}/counts")
    for text, expected in (("a b.a", {"a": 2, "b": 1}), ("b.c", {"a": 2, "b": 2, "c": 1})):
        rows = spark.createDataFrame([(text,)], "value string")
        rows.write.mode("append").option("lineSep", ".").text(f"{root}/text")
        word_count_stream(
            spark, f"{root}/text", result.save, f"{root}/checkpoint", "batch"
        ).awaitTermination()
        assert {r["word"]: r["count"] for r in result.read(spark).collect()} == expected


def test_stream_result_in_a_table(spark, root):
    rows = spark.createDataFrame([("a b.a",)], "value string")
    rows.write.option("lineSep", ".").text(f"{root}/text")
    with scratch_table(spark) as name:
        save = table_saver(name, f"{root}/table")
        word_count_stream(
            spark, f"{root}/text", save, f"{root}/checkpoint", "batch"
        ).awaitTermination()
        assert {tuple(r) for r in spark.table(name).collect()} == {("a", 2), ("b", 1)}


def test_words_and_sentences_are_not_shuffled(spark):
    for name in ("word_tokens", "text_sentences"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution()
        assert "Exchange" not in plan.executedPlan().toString()


def test_words_and_sentences_are_counted(spark, root):
    texts = [(1, "A b. a"), (1, "a.A b"), (2, "b a"), (None, "b b")]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    rows.write.parquet(f"{root}/documents.parquet")
    words = QUERIES["word_tokens"](spark, root)
    assert words.columns == ["doc_id", "word", "n"]
    counts = {tuple(r) for r in words.collect()}
    assert counts == {(1, "a", 4), (1, "b", 2), (2, "a", 1), (2, "b", 1), (None, "b", 2)}
    found = QUERIES["text_sentences"](spark, root)
    assert found.columns == ["sentence", "n"]
    counts = {tuple(r) for r in found.collect()}
    assert counts == {("A b", 2), (" a", 1), ("a", 1), ("b a", 1), ("b b", 1)}


def test_tokens_and_sentences_are_map_only(spark, root):
    spark.createDataFrame([("a b.a",)], "value string").write.text(f"{root}/text")
    pieces = sentences(spark, f"{root}/text")
    for frame in (pieces, tokens(pieces)):
        assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
