"""The operators over their whole tables, under production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.bpe import bpe_decode, bpe_encode, share_vocabulary, token_count
from millrace.llm.counts import count_tokens
from millrace.llm.jaccard import Similarity, similar_documents
from millrace.llm.matrix_bpe import matrix_decode, matrix_encode, share_ranks
from millrace.llm.mixing import mixed_sizes
from millrace.llm.pages import extract_pages
from millrace.llm.quality import document_statistics, fit_discriminant, quality_score
from millrace.llm.rules import judge_quality
from millrace.llm.search import nearest, whole_vectors
from millrace.llm.storage import settled, ship_package
from millrace.llm.substrings import remove_repeats
from millrace.llm.trie import rebuilt_prefixes, trie_nodes, turn_digests
from millrace.llm.urls import filter_urls
from millrace.llm.whitening import fixed_point, whitened
from millrace.llm.words import word_count

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"
TOKEN_LIMIT = 512
WEIGHTS = (3, 1, 2)
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """Rows of fold 0 are held out; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    return judge_quality(docs, labels.where("quality = 1").select("doc_id"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mixed_sizes(sized, WEIGHTS, share=1.5, most=2.0)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    stats = settled(docs.select("doc_id", document_statistics(F.col("text")).alias("stats")))
    taught = labels.where(fold(F.col("doc_id")) != 0).select("doc_id", F.col("quality").alias("label"))
    model = fit_discriminant(stats.join(taught, "doc_id"))
    scored = stats.withColumn("score", quality_score(stats, F.col("stats"), model))
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op4_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), whole_vectors(F.col("embedding"), 256).alias("vec")
    )
    found = nearest(rows, rows.where("id % 50 = 0"), 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = filter_urls(pages, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return remove_repeats(docs, window=20).select("doc_id", "n_words", "n_removed", kept)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), vocabulary_path()
    shared = share_vocabulary(spark, path)
    ids = docs.select("doc_id", bpe_encode(spark, F.col("text"), path, shared).alias("ids"))
    decoded = bpe_decode(spark, F.col("ids"), path, shared).alias("decoded")
    both = ids.select("doc_id", "ids", decoded)
    return both.select(
        "doc_id",
        token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_pages(pages)
    return found.select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        count_tokens(spark, F.col("text"), vocabulary_path()).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similar_documents(docs, Similarity(n=3, num=9, den=10))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_digests(table(spark, sf_dir, "conversations"))
    return trie_nodes(rebuilt_prefixes(turns, block=100, kinds=6))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), fixed_point(F.col("embedding"), 1024, 100_000).alias("vec")
    )
    found = whitened(rows, wanted=8).withColumnRenamed("id", "vec_id")
    return found.withColumn("deviation", F.col("deviation").cast("bigint"))


def op13_matrix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = share_ranks(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents")
    ids = docs.select("doc_id", matrix_encode(F.col("text"), ranks).alias("ids"))
    both = ids.select("doc_id", "ids", matrix_decode(F.col("ids"), ranks).alias("decoded"))
    return both.select(
        "doc_id",
        token_count(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_mix_sources,
        op3_quality_classifier,
        op4_exact_search,
        op5_url_filter,
        op6_substring_dedup,
        op7_bpe,
        op8_html,
        op9_token_counts,
        op10_jaccard_join,
        op11_prefix_trie,
        op12_whitening,
        op13_matrix_bpe,
    )
}
ORACLE: dict[str, str] = {
    "op4_exact_search": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as vec
  from embeddings
  where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         list_dot_product(q.vec, c.vec)::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank
  from s
)
select query_id, rank, vec_id, score from r where rank <= 5""",
    "op6_substring_dedup": r"""
with t as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), g as (
  select doc_id, unnest(range(1, greatest(len(w) - 18, 1))) as p, w from t
), k as (
  select doc_id, p, md5(array_to_string(w[p:p + 19], ' ')) as h from g
), f as (
  select doc_id, p,
         row_number() over (partition by h order by doc_id, p) > 1 as again
  from k
), c as (
  select distinct doc_id, unnest(range(p, p + 20)) as p from f where again
), r as (
  select doc_id, list(p) as gone from c group by doc_id
)
select t.doc_id, len(w)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
       sha256(coalesce(array_to_string(list_transform(
         list_filter(range(1, len(w) + 1), lambda i: not list_contains(coalesce(gone, []), i)),
         lambda i: w[i]), ' '), '')) as kept_sha256
from t left join r on t.doc_id = r.doc_id""",
    "op10_jaccard_join": r"""
with recursive t as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select distinct doc_id, array_to_string(w[p:p + 2], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) as p from t where len(w) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), c as (
  select a.doc_id as a, b.doc_id as b, count(*) as k
  from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), e as (
  select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * k >= 90 * (x.n + y.n - k)
), u as (
  select a, b from e union all select b, a from e
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select reach.a, u.b from reach join u on reach.b = u.a
), m as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select t.doc_id, coalesce(n.n, 0) as n_shingles, m.component_id
from t left join n on n.doc_id = t.doc_id join m on m.doc_id = t.doc_id""",
    "op11_prefix_trie": r"""
with t as (
  select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as x,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as g, turn
  from conversations where conv_id is not null
), o as (
  select c, x, g, row_number() over (partition by c order by turn nulls first, g) as p from t
), k as (
  select c, c - c % 100 as b, n, xor(4294967295, list_reduce(
      list_concat([4294967295::ubigint], flatten(list_transform(
        string_split(c::varchar, ''),
        lambda a: list_transform(range(8), lambda i: ((ascii(a) >> i) & 1)::ubigint)))),
      lambda v, bit: xor(v >> 1, 3988292384 * (xor(v, bit) & 1))::ubigint)) % 6 as h
  from (select c, count(*) as n from t group by c)
), q as (
  select k.c, k.n, k.h, count(o.p) as m from k left join o on o.c = k.b and o.p <= k.h
  group by all
), s as (
  select k.c, o.p as d, x, g from k join o on o.c = k.b and o.p <= k.h
  union all
  select q.c, o.p - q.h + q.m, x, g from q join o on o.c = q.c and o.p > q.h
), f as (
  select c, d, length(x) as chars,
         string_agg(g, '') over (partition by c order by d) as path
  from s
  union all
  select c, 0, 0, '' from k
), z as (
  select c, max(d) as len from f group by c
), v as (
  select path, d, min(f.c) as rep, count(*) as n, any_value(chars) as chars,
         list(f.c order by f.c) filter (d = len) as ends
  from f join z using (c) group by path, d
), w as (
  select a.path, a.d, a.rep, a.n, a.chars, a.ends, b.rep as up, count(e.path) as kids
  from v a left join v b on a.d > 0 and b.path = left(a.path, 32 * (a.d - 1)::bigint)
  left join v e on e.d = a.d + 1 and left(e.path, 32 * a.d::bigint) = a.path
  group by all
), y as (
  select u.path, count(*) filter (w.kids = 0) as leaves, sum((w.n - 1) * w.chars) as saved
  from w join f u on u.c = w.rep and u.d <= w.d group by u.path
)
select rep as conv_id, d::bigint as depth, up as parent_conv_id, n::bigint as n_convs,
       kids::bigint as n_children, leaves::bigint as n_leaves, saved::bigint as saved_tokens,
       sha256(coalesce(array_to_string(ends, ','), '')) as ends_sha256
from w join y using (path)""",
}
