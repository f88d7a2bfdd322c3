"""Registered queries: each operator over its whole table, with production
parameters, and the SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import held_out, table
from .mixing import Tempered

QUERIES: dict = {}
ORACLE: dict = {}

# the vocabulary of token output and the id that ends every document
TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


@query
def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_ids
    documents, _ = token_ids.token_files(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)
    return token_ids.digests(documents)


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc
    index, folder = warc.write(table(spark, sf_dir, "pages"), min_bytes=0)
    return warc.read(index, folder).drop("url")


# base32: five hexadecimal digits of the digest at a time make four characters
ORACLE["op7_warc"] = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
                  sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last,
             [CAST('0x' || substr(hex, 5 * CAST(i AS INTEGER) + 1, 5) AS BIGINT) FOR i IN range(8)] AS fives FROM p)
SELECT page_id, payload_bytes,
       list_aggregate(flatten([[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((g >> b) & 31 AS INTEGER) + 1, 1)
                                FOR b IN [15, 10, 5, 0]] FOR g IN fives]), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM d
"""


@query
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import topk
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


ORACLE["op9_top_k"] = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality
    rows = quality.feature_rows(table(spark, sf_dir, "documents"))
    model = quality.fit(rows, table(spark, sf_dir, "labels"), ~held_out("doc_id", 5))
    return quality.scored(rows, model).select("doc_id", held_out("doc_id", 5).alias("held_out"), "score", "predicted")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import near_dup
    return near_dup.classes(table(spark, sf_dir, "documents"))


@query
def op10_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import brown
    return brown.score(table(spark, sf_dir, "documents"), held_out("doc_id", 10))


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]
# words of a host name that mark the urls labelled "block" for training
BLOCKED_WORDS = ["adult", "ads", "bets", "casino", "gambling", "pills", "porn", "spam", "viagra", "warez", "xxx"]
ARTICLE_SPACES = 100  # in the html of a page that counts as prose


def url_labels(pages: DataFrame, learnt: Column | None = None) -> DataFrame:
    """(url, y) of every page. To block: hosts that name a blocked word, unless a
    rule allows the url. To allow: hosts that name none, if a rule allows the url
    or its html holds an article of some length. Others, and rows for which
    ``learnt`` (of host) is not true, have no label. The trees get neither
    words nor rules nor html, only lexical features of urls."""
    from . import urls
    parts = urls.with_parts(pages)
    _, verdict = urls.rule_for(F.col("host"), F.col("path"), URL_RULES)
    word = F.col("host").rlike(rf"(^|[.-])({'|'.join(BLOCKED_WORDS)})([.-]|$)")
    article = F.col("html").contains("<article") & (
        F.length("html") - F.length(F.replace(F.col("html"), F.lit(" "), F.lit(""))) >= ARTICLE_SPACES)
    allowed = F.coalesce(verdict == "allow", F.lit(False))
    y = F.when(word & ~allowed, 1).when(~word & (allowed | (verdict.isNull() & article)), 0)
    return parts.select("url", (y if learnt is None else F.when(learnt, y)).alias("y"))


@query
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import urls
    pages = table(spark, sf_dir, "pages")
    model = urls.fit(url_labels(pages))
    return urls.judged(pages.select("page_id", "url"), URL_RULES, model).select(
        "page_id", "host", "path", "rule", "verdict", "block_score")


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii
    documents = table(spark, sf_dir, "documents")
    return pii.digests(pii.spans(documents, pii.fit(documents)))


MIX_TARGETS = {
    "source": Tempered(0.5, fixed={"src0": 0.1}),
    "lang": {"en": 0.5, "fr": 0.18, "de": 0.18, "es": 0.14},
    "topic": {str(t): 1 / 8 for t in range(8)},
}


@query
def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing
    return mixing.mixed(table(spark, sf_dir, "documents"), MIX_TARGETS)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import periodic
    documents = table(spark, sf_dir, "documents")
    return periodic.digests(periodic.periodic_runs(documents, periodic.planted(F.col("doc_id"), F.col("text"))))


def align_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import token_align
    return token_align.summaries(table(spark, sf_dir, "documents"), *align_paths())


@query
def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import ngram_join
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
