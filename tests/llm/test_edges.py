"""Nulls, empty and long texts, ties, repeats, empty tables, clashing columns."""

import pytest

from cursorlake.llm import (brown, decontaminate, mixing, near_dup, pii, quality, token_ids, topk, urls, warc)
from cursorlake.llm.common import held_out
from cursorlake.llm.queries import MIX_TARGETS, URL_RULES, tokenizer_path
from pyspark.sql import functions as F
from tests.llm.helpers import docs, odd_rows

LABELS = "doc_id long, quality int, toxic int"


def per_row(spark):
    labels = spark.createDataFrame([(5, 1, 0), (6, 0, 0), (4, None, 0)], LABELS)
    bench = spark.createDataFrame([(1, "a b c d e f g"), (2, None), (None, "x y z w v u"), (3, "")], "item_id long, text string")

    def op6(d):
        rows = quality.feature_rows(d)
        return quality.scored(rows, quality.fit(rows, labels, F.lit(True)))

    return {
        "pii": lambda d: pii.digests(pii.spans(d, pii.fit(d))),
        "near_dup": near_dup.classes,
        "tokens": lambda d: token_ids.digests(token_ids.token_files(d, tokenizer_path(), 1)[0]),
        "quality": op6,
        "mix": lambda d: mixing.mixed(d, MIX_TARGETS),
        "brown": lambda d: brown.score(d, held_out("doc_id", 10)),
        "decontaminate": lambda d: decontaminate.matches(d, bench),
    }


@pytest.mark.parametrize("name", ["pii", "near_dup", "tokens", "quality", "mix", "brown", "decontaminate"])
def test_documents(spark, name):
    rows = odd_rows()
    op = per_row(spark)[name]
    got = op(docs(spark, rows)).collect()
    if name == "decontaminate":
        assert got == []
    else:
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
    assert op(docs(spark, [])).collect() == []


def test_pipeline_stages_keep_columns(spark, tmp_path):
    import corpus_pipeline
    sf = str(tmp_path)
    spark.createDataFrame([(5, 1, 0), (6, 0, 0)], LABELS).write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    for rows in (odd_rows(), []):
        d = docs(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, d, sf)
            assert out.columns == d.columns, name
            assert out.dtypes == d.dtypes, name
            d = out
        assert corpus_pipeline.STAGES[-1][1](spark, d, sf).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_pages(spark):
    schema = "page_id long, url string, html string, host string, path string, rule string, verdict string, digest string"
    rows = [(1, None, None), (2, "", ""), (2, "", ""), (None, "http://a.net/es/x", "<p>"), (3, "no scheme", "<p>"),
            (4, "HTTP://WWW.Example.COM/en/?q#f", "x" * 100_000), (5, "http://a\nb.com/\r\n", "\x00"), (6, "://", "é"),
            (7, "http://com", None), (8, "http://x.com/", "é")]
    pages = spark.createDataFrame([(*r, "h", "p", "r", "v", "d") for r in rows], schema)
    for frame, n in ((pages, len(rows)), (pages.limit(0), 0)):
        found = urls.judged(frame, URL_RULES, urls.fit(frame.select("url", F.lit(1).alias("y")))).select("page_id", "verdict").collect()
        assert len(found) == n and all(r["verdict"] in ("allow", "block") for r in found)
        index, folder = warc.write(frame)
        back = warc.read(index, folder, with_payload=True).collect()
        assert len(back) == n
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in back} if n else None
    assert kinds is None or kinds
    got = sorted((str(r["page_id"]), r["record_type"], r["refers_to"], r["payload_bytes"])
                 for r in warc.read(*warc.write(pages)).collect())
    assert got == sorted([("1", "revisit", 7, 0), ("2", "revisit", 7, 0), ("2", "revisit", 7, 0), ("None", "revisit", 3, 3),
                          ("3", "response", None, 3), ("4", "response", None, 100_000), ("5", "response", None, 1),
                          ("6", "revisit", 8, 2), ("7", "response", None, 0), ("8", "response", None, 2)])


def test_vectors(spark):
    big, nan = 3e38, float("nan")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [float("inf"), 0.0]), (5, []), (6, [1.0]),
            (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [big, big]), (None, [1.0, 1.0]), (9, [-1.0, -2.0])]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, score int, query_id int")
    got = [tuple(r) for r in topk.top_k(frame, F.col("vec_id") == 0, k=4).orderBy("rank").collect()]
    assert [(g[0], g[1], g[2]) for g in got] == [(0, 1, 8), (0, 2, 7), (0, 3, 7), (0, 4, 6)]
    assert [g[3] for g in got[1:]] == [256 * 256 + 512 * 512] * 2 + [256 * 256]
    huge = topk.top_k(frame, F.col("vec_id") == 8, k=2).orderBy("rank").collect()
    assert [r["vec_id"] for r in huge] == [0, 6] and huge[0]["score"] == 2**63 - 1
    assert topk.top_k(frame.limit(0), F.col("vec_id") == 0).collect() == []
