"""Registered queries against their SQL oracle (DuckDB) on sf0.001."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import compare
from cursorlake.plans import all_queries
from tests.conftest import SF_MID, SF_SMALL

LIBRARY = sorted(all_queries())


@pytest.mark.parametrize("name", LIBRARY)
def test_against_oracle(spark, duck, name):
    r = compare(spark, duck, SF_SMALL, name, E.queries()[name], E.oracle_sql()[name])
    assert r.get("values_match"), r


def test_every_form_of_dirty_message_occurs(spark, duck):
    """At this size every malformed message of the list is among the input."""
    import duckdb
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_MID}/events.parquet')")
    for name in ("decode_lenient", "coerce_defaults", "drop_unparsable", "validate_payload", "payload_bytes", "epoch_ms_to_ts"):
        r = compare(spark, con, SF_MID, name, E.queries()[name], E.oracle_sql()[name])
        assert r.get("values_match"), r


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["minute", "n"]
    assert df.count() > 0


def test_every_library_query_has_an_oracle():
    assert set(all_queries()) <= set(E.oracle_sql())
