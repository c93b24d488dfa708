"""Driver contract: entry runs, keys line up, and a sample of oracles agree at sf0.001."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from ledgerlens.plans.bindings import TABLES
from ledgerlens.plans.catalogue import QUERIES
from ledgerlens.plans.oracles import ORACLES

from conftest import SF_SMALL



def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["category", "number_of_orders", "total_units", "total_sales_krw",
                          "avg_order_value_krw"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("key", [
    "category_summary", "rank_in_category", "country_summary", "customer_summary",
    "top_bigrams", "corpus_stats", "sentence_stats", "clean_orders_lenient", "return_rate",
    "star_join", "customer_transactions", "web_term_sentences", "web_top_words", "retail_loaded",
    "category_counts_view", "word_freq_csv", "web_word_export_csv", "word_freq_lines", "dataset_row_counts",
])
def test_oracle_agrees_on_small_data(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = E.queries()[key](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[key])
    dcols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    cols = sorted(dcols)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(row[i]) for i in idx) for row in res.fetchall()), key=repr)
    assert got == want
