import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUICK = [
    "mom_revenue", "cohort_retention", "clean_customers", "clean_orders", "routed_batch", "text_functions", "date_functions", "customer_dim_one_pass",
    "scd2_event_log", "fact_sales_pit", "not_in", "daily_bars", "price_forecast", "observation_facts", "article_measures", "lexicon_sentiment", "staging_gates",
    "csv_dialect_load", "json_articles", "revenue_forecast", "fact_replay", "dimension_buckets", "replicate_changes", "store_compaction",
    "distinct_from_bitmaps", "stream_state_versions", "stream_state_lines", "mart_by_deltas", "rfm_scores_high_is_best",
    "domain_batch_run", "personal_batches", "stream_calendar", "article_sentiment",
]
NAMES = sorted(entry.QUERIES) if os.environ.get("TEST_ALL_QUERIES") else QUICK


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value + 0.0) if isinstance(value, float) else str(value)


def test_every_query_has_its_sql():
    """Queries of the training-data subpackage are tested on their own."""
    assert set(entry.ORACLE) == set(entry.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, oracle, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    result = oracle.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()), key=str)
    assert found == expected
