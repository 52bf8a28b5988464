"""One batch run of the three domains: raw tables, dimensions, facts, gates and audit rows in one commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import date_key
from ..operators.joins import only_known
from ..operators.quality import failure_alerts, quality_log, run_assertions, staging_checks
from ..session import materialize
from ..sources.store import TableStore, Transaction
from . import domains
from .audit import run_finished, run_started
from .calendar import REALTIME_RANGE, date_dim


def _part(txn: Transaction, name: str, incoming: DataFrame, ddl: str) -> DataFrame:
    table = txn.read_matching(name, incoming)
    return table if table is not None else schemas.empty(txn.store.spark, ddl)


def _upsert_raw(txn: Transaction, name: str, incoming: DataFrame, merge) -> DataFrame:
    """Merge extracted records into the buckets of a raw table that their keys fall into."""
    raw = txn.read_buckets(name, incoming)
    if raw is None:
        return txn.append(name, merge(incoming.limit(0), incoming))
    return txn.replace_buckets(name, merge(raw, incoming), txn.buckets(name, incoming))


def _stocks(txn: Transaction, bars: DataFrame) -> int:
    _upsert_raw(txn, "raw_stock_prices", bars, domains.upsert_raw_stocks)
    txn.append("dim_company", domains.new_companies(_part(txn, "dim_company", bars, schemas.DIM_COMPANY), bars, txn.high("dim_company")))
    companies = _part(txn, "dim_company", bars, schemas.DIM_COMPANY)
    touched, days = bars.select("ticker").distinct(), bars.select("ticker", "trade_date").distinct()
    history = only_known(txn.read_buckets("raw_stock_prices", touched), touched, ["ticker"])
    facts = domains.stock_facts(history, companies, only=days, first_key=txn.high("fact_stock_prices"))
    return _refresh(txn, "fact_stock_prices", facts, domains.upsert_stock_facts)


def _refresh(txn: Transaction, name: str, facts: DataFrame, merge) -> int:
    """Insert facts, refresh known ones; only segments that may hold known ones are rewritten. Returns the facts of the run."""
    facts = materialize(facts, "facts")
    loaded = txn.read_matching(name, facts)
    txn.replace_matching(name, facts if loaded is None else merge(loaded, facts))
    return facts.count()


def _weather(txn: Transaction, observations: DataFrame) -> int:
    txn.append("raw_weather_observations", observations.fillna(domains.OBSERVATION_DEFAULTS))
    txn.append("dim_location", domains.new_locations(_part(txn, "dim_location", observations, schemas.DIM_LOCATION), observations, txn.high("dim_location")))
    hourly = materialize(domains.hourly_readings(observations, _part(txn, "dim_location", observations, schemas.DIM_LOCATION)), "hourly")
    loaded = txn.read_matching("fact_weather_readings", hourly)
    return txn.append("fact_weather_readings", domains.new_readings(hourly, loaded, txn.high("fact_weather_readings"))).count()


def _news(txn: Transaction, articles: DataFrame) -> int:
    _upsert_raw(txn, "raw_news_articles", articles, domains.upsert_raw_news)
    txn.append("dim_news_source", domains.new_sources(_part(txn, "dim_news_source", articles, schemas.DIM_NEWS_SOURCE), articles, txn.high("dim_news_source")))
    single = domains.single_articles(articles, _part(txn, "dim_news_source", articles, schemas.DIM_NEWS_SOURCE))
    return _refresh(txn, "fact_news_articles", domains.new_articles(single, None, txn.high("fact_news_articles")), domains.upsert_article_facts)


def run_domains(
    store: TableStore, run_id: str, bars: DataFrame, observations: DataFrame, articles: DataFrame,
    as_of: Column | None = None, calendar: tuple[str, str] = REALTIME_RANGE,
) -> dict[str, int]:
    """Load what was extracted for stocks, weather and news; returns the counters of the run.

    Records come in the shapes of the raw tables. Bars and articles replace raw records of the same key, observations are
    appended. Dimensions get new members; known bars refresh close and volume, known articles title and description, other facts are
    inserted once. The raw records are checked, results and failures logged. A run that fails leaves the tables as they
    were and one failed audit row, and the error is raised.
    """
    spark, txn = store.spark, store.begin()
    frames = [materialize(f, "extract") for f in (bars, observations, articles)]
    counters = {"records_extracted": sum(f.count() for f in frames)}
    txn.append("pipeline_runs", run_started(spark, run_id, "full", {"domains": "stocks, weather, news"}))
    before = txn.mark()
    try:
        if txn.read("dim_date") is None:
            txn.append("dim_date", date_dim(spark, *calendar))
        counters["records_transformed"] = sum(load(txn, f) for load, f in zip((_stocks, _weather, _news), frames, strict=True))
        counters["records_loaded"] = counters["records_extracted"]
        tables = dict(zip(("raw_stock_prices", "raw_weather_observations", "raw_news_articles"), frames, strict=True))
        results = materialize(run_assertions(tables, staging_checks()), "checks")
        txn.append("data_quality_log", quality_log(results, run_id, as_of))
        txn.append("alerts", failure_alerts(results, run_id).select("alert_type", "title", "message", "pipeline_run_id"))
        txn.append("pipeline_runs", run_finished(spark, run_id, "full", "completed", counters))
    except Exception as error:
        txn.undo(before)
        txn.append("pipeline_runs", run_finished(spark, run_id, "full", "failed", {"records_extracted": counters["records_extracted"]}, str(error)))
        txn.commit()
        raise
    txn.commit()
    return counters
