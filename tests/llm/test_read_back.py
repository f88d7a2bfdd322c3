"""Files of op5 and op7: read back by many tasks; a second try of a task does no harm."""

from pyspark.sql import functions as F

from cursorlake.llm import token_ids, warc
from cursorlake.llm.queries import END_ID, tokenizer_path
from cursorlake.session import work_dir
from tests.conftest import SF_MID


def _tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def test_bundles_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 1 << 16)
    pages = spark.read.parquet(SF_MID + "/pages.parquet")
    index, folder = warc.write(pages, frame_bytes=1 << 13)
    back = warc.read(index, folder)
    assert _tasks(back) > 4 and back.count() == pages.count()


def test_token_files_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(token_ids, "READ_BYTES", 1 << 14)
    monkeypatch.setattr(token_ids, "BLOCK_IDS", 1 << 12)
    documents = spark.read.parquet(SF_MID + "/documents.parquet")
    back, _ = token_ids.token_files(documents, tokenizer_path(), END_ID)
    assert _tasks(back) > 4 and back.count() == documents.count()


def test_two_tries_of_a_bundle_do_not_meet(spark):
    """Two writers of one folder, rows in another order, as two tries of the same
    tasks: each index finds its own records."""
    folder = work_dir(spark, "warc")
    rows = [(i, f"http://a.b/{i}", "x" * (i % 7) + ("same" if i % 3 else str(i))) for i in range(300)]
    tries = []
    for order in (rows, rows[::-1]):
        pages = spark.createDataFrame(order, "page_id long, url string, html string").coalesce(1)
        tries.append(warc.write(pages, folder, frame_bytes=500)[0])
    first, second = (sorted(map(str, warc.read(index, folder).collect())) for index in tries)
    assert first == second and len(first) == 300
    names = [{r.bundle for r in index.select("bundle").distinct().collect()} for index in tries]
    assert not names[0] & names[1]
