"""The archive's read-back against its SQL, row by row."""

import duckdb
import pandas as pd

from cursorlake.llm import warc
from cursorlake.llm.queries import ORACLE, QUERIES

COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def _order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: r[0])


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql("CREATE VIEW pages AS SELECT * FROM '/root/testdata/sf0.01/pages.parquet'")
    got = QUERIES["op7_warc"](spark, "/root/testdata/sf0.01").select(*COLUMNS).collect()
    assert _order(got) == _order(con.sql(ORACLE["op7_warc"]).fetchall())


def test_copies_and_empty_payloads_equal_sql(spark):
    html = ["<p>same</p>", None, "", "<p>é \U0001f600</p>", "<p>same</p> ", "\x00"]
    rows = [(i, f"http://h{i}.net/", html[i * i % 7 % 6]) for i in range(80)] + [(90, "u", "only once")]
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = warc.read(*warc.write(frame, min_bytes=0)).select(*COLUMNS).collect()
    want = con.sql(ORACLE["op7_warc"]).fetchall()
    assert _order(got) == _order(want) and {r[3] for r in want} == {"response", "revisit"}
