"""Stock, weather and news loads: raw table -> dimension + fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..operators.joins import current_only, not_loaded, only_known
from ..operators.keys import dedupe_latest, dense_key, max_key
from ..operators.measures import (
    TEMP_RANGE, article_measures, bar_measures, eligible_articles, eligible_bars, eligible_observations, source_identifier,
)
from ..operators.merge import insert_new, upsert
from ..functions.text import has_text

STOCK_FACT = (
    "stock_fact_key", "date_key", "company_key", "open_price", "high_price", "low_price", "close_price",
    "volume", "daily_return_pct", "daily_range", "daily_range_pct", "avg_price",
)
READING_FACT = (
    "weather_fact_key", "date_key", "location_key", "observation_hour", "temp_celsius", "feels_like_c", "temp_min_c",
    "temp_max_c", "pressure_hpa", "humidity_pct", "wind_speed_ms", "wind_deg", "clouds_pct", "weather_main",
    "weather_desc", "visibility_m", "rain_1h_mm", "snow_1h_mm",
)
READING_GRAIN = ["location_key", "date_key", "observation_hour"]
ARTICLE_FACT = (
    "news_fact_key", "date_key", "source_key", "title", "description", "author", "url", "topic",
    "title_word_count", "has_image", "published_hour",
)


def new_companies(dim: DataFrame, raw: DataFrame, first_key: int | None = None) -> DataFrame:
    """One current company per ticker without a current row, valid from its first ingest, with keys after those of all rows.

    Here and in the other `new_` functions `dim` may be the rows that can match, then with the largest key given so far.
    """
    firsts = raw.groupBy("ticker").agg(F.min("ingested_at").alias("effective_start_date")).select(
        "ticker", F.col("ticker").alias("company_name"), "effective_start_date", F.lit(True).alias("is_current")
    )
    return insert_new(dim, firsts, ["ticker"], "company_key", known=current_only(dim), start=first_key)


def load_companies(dim: DataFrame, raw: DataFrame) -> DataFrame:
    """The dimension with its new companies."""
    return dim.unionByName(new_companies(dim, raw))


def _key_after(facts: DataFrame, key: str, natural: Sequence[str], loaded: DataFrame | None, first_key: int | None = None) -> DataFrame:
    start = first_key if first_key is not None else max_key(loaded, key) if loaded is not None else 0
    return dense_key(facts, key, natural, start)


def stock_facts(
    raw: DataFrame, dim_company: DataFrame, loaded: DataFrame | None = None, only: DataFrame | None = None, first_key: int | None = None
) -> DataFrame:
    """New bars with their measures.

    Returns look at the whole raw history; bars already loaded are removed afterwards,
    so the first bar of an increment still knows the bar before it. `only` names the bars (ticker, trade_date) to
    load; `loaded` may then be the part of the fact that can hold them, with the largest key given so far.
    """
    measured = bar_measures(raw.filter(eligible_bars())).withColumn("date_key", date_key("trade_date"))
    if only is not None:
        measured = only_known(measured, only, ["ticker", "trade_date"])
    bars = measured.join(current_only(dim_company).select("ticker", "company_key"), "ticker")
    if loaded is not None:
        bars = not_loaded(bars, loaded, ["company_key", "date_key"])
    return _key_after(bars, "stock_fact_key", ["ticker", "trade_date"], loaded, first_key).select(*STOCK_FACT)


def upsert_stock_facts(loaded: DataFrame, facts: DataFrame) -> DataFrame:
    """Bars of known (date, company) refresh close and volume only; others are inserted."""
    return upsert(loaded, facts, ["date_key", "company_key"], ["close_price", "volume"])


def new_locations(dim: DataFrame, raw: DataFrame, first_key: int | None = None) -> DataFrame:
    """New (city, country) pairs with the coordinates first ingested for them."""
    first = F.min_by(F.struct("latitude", "longitude"), F.struct("ingested_at", "latitude", "longitude"))
    pairs = raw.filter(F.col("city").isNotNull()).groupBy("city", "country_code").agg(first.alias("_at"))
    pairs = pairs.select("city", "country_code", "_at.latitude", "_at.longitude")
    return insert_new(dim, pairs, ["city", "country_code"], "location_key", start=first_key)


def load_locations(dim: DataFrame, raw: DataFrame) -> DataFrame:
    """The dimension with its new places."""
    return dim.unionByName(new_locations(dim, raw))


def refresh_locations(dim: DataFrame, raw: DataFrame) -> DataFrame:
    """As `load_locations`, but known places take the newest coordinates."""
    newest = F.max_by(F.struct("latitude", "longitude"), F.struct("ingested_at", "latitude", "longitude"))
    pairs = raw.filter(F.col("city").isNotNull()).groupBy("city", "country_code").agg(newest.alias("_at"))
    pairs = pairs.select("city", "country_code", "_at.latitude", "_at.longitude")
    moved = upsert(dim, dim.select("city", "country_code").join(pairs, ["city", "country_code"]), ["city", "country_code"], ["latitude", "longitude"])
    return moved.unionByName(insert_new(dim, pairs, ["city", "country_code"], "location_key"))


def hourly_readings(raw: DataFrame, dim_location: DataFrame, temp_range: tuple[float, float] = TEMP_RANGE) -> DataFrame:
    """Readings per place and hour: in range, the newest of an hour."""
    zero = F.lit(0.0)
    ranged = raw.filter(eligible_observations(*temp_range)).withColumns(
        {
            "date_key": date_key("observation_dt"),
            "observation_hour": F.hour("observation_dt"),
            "rain_1h_mm": F.coalesce("rain_1h_mm", zero),
            "snow_1h_mm": F.coalesce("snow_1h_mm", zero),
        }
    )
    placed = ranged.join(dim_location.select("city", "country_code", "location_key"), ["city", "country_code"])
    return dedupe_latest(placed, READING_GRAIN, ["observation_dt"], ["ingested_at", "temp_celsius"])


def new_readings(hourly: DataFrame, loaded: DataFrame | None = None, first_key: int | None = None) -> DataFrame:
    """Hourly readings not loaded before; `loaded` may be the part of the fact that can hold them, then with the largest key so far."""
    if loaded is not None:
        hourly = not_loaded(hourly, loaded, READING_GRAIN)
    return _key_after(hourly, "weather_fact_key", READING_GRAIN, loaded, first_key).select(*READING_FACT)


def reading_facts(
    raw: DataFrame, dim_location: DataFrame, loaded: DataFrame | None = None, temp_range: tuple[float, float] = TEMP_RANGE
) -> DataFrame:
    """New hourly readings per place: in range, newest per hour, not loaded before."""
    return new_readings(hourly_readings(raw, dim_location, temp_range), loaded)


def new_sources(dim: DataFrame, raw: DataFrame, first_key: int | None = None) -> DataFrame:
    """New source names, with their id or a slug of the name."""
    named = raw.filter(has_text("source_name")).withColumn("source_id", source_identifier())
    sources = named.groupBy("source_name").agg(F.min("source_id").alias("source_id"))
    return insert_new(dim, sources, ["source_name"], "source_key", start=first_key)


def load_sources(dim: DataFrame, raw: DataFrame) -> DataFrame:
    """The dimension with its new sources."""
    return dim.unionByName(new_sources(dim, raw))


def article_identity(df: DataFrame) -> DataFrame:
    """Add `_article`: the url, or a digest of source, title and time for articles without one."""
    parts = F.concat_ws("\u0001", F.col("_source"), F.col("title"), F.col("date_key").cast("string"), F.col("published_hour").cast("string"))
    return df.withColumn("_article", F.coalesce(F.nullif(F.trim("url"), F.lit("")), F.sha2(parts, 256)))


def single_articles(raw: DataFrame, dim_source: DataFrame) -> DataFrame:
    """Articles with word count, image flag and hour; one per url (or identity without url)."""
    measured = article_measures(raw.filter(eligible_articles()))
    sourced = measured.join(dim_source.select("source_name", "source_key"), "source_name")
    sourced = article_identity(sourced.withColumn("_source", F.col("source_key").cast("string")))
    return dedupe_latest(sourced, ["_article"], ["ingested_at", "published_at"], ["title"])


def new_articles(single: DataFrame, loaded: DataFrame | None = None, first_key: int | None = None) -> DataFrame:
    """Single articles not loaded before; `loaded` may be the part of the fact that can hold them, then with the largest key so far."""
    if loaded is not None:
        seen = article_identity(loaded.withColumn("_source", F.col("source_key").cast("string")))
        single = not_loaded(single, seen, ["_article"])
    return _key_after(single, "news_fact_key", ["_article"], loaded, first_key).select(*ARTICLE_FACT)


def article_facts(raw: DataFrame, dim_source: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """New articles of a raw table."""
    return new_articles(single_articles(raw, dim_source), loaded)


def upsert_article_facts(loaded: DataFrame, facts: DataFrame) -> DataFrame:
    """Articles of a known url refresh title and description only; others are inserted."""
    return upsert(loaded, facts, ["url"], ["title", "description"])


# --- raw loads ------------------------------------------------------------------------------


def upsert_raw_stocks(raw: DataFrame, incoming: DataFrame, keys: Sequence[str] = ("ticker", "trade_date")) -> DataFrame:
    """Newest incoming record per natural key replaces prices, volume, ingest time and run id."""
    latest = dedupe_latest(incoming, list(keys), ["ingested_at"], ["close_price", "volume"])
    fields = ["open_price", "high_price", "low_price", "close_price", "volume", "ingested_at", "pipeline_run_id"]
    return upsert(raw, latest, list(keys), fields)


# What a missing field of an observation is stored as.
OBSERVATION_DEFAULTS = {
    "country_code": "", "temp_celsius": 0.0, "feels_like_c": 0.0, "temp_min_c": 0.0, "temp_max_c": 0.0, "pressure_hpa": 0,
    "humidity_pct": 0, "wind_speed_ms": 0.0, "wind_deg": 0, "clouds_pct": 0, "weather_main": "", "weather_desc": "",
    "visibility_m": 0, "rain_1h_mm": 0.0, "snow_1h_mm": 0.0, "latitude": 0.0, "longitude": 0.0,
}


def append_raw_weather(raw: DataFrame, incoming: DataFrame) -> DataFrame:
    """Observations are appended as they come, missing fields defaulted."""
    return raw.unionByName(incoming.fillna(OBSERVATION_DEFAULTS).select(*raw.columns))


def upsert_raw_news(raw: DataFrame, incoming: DataFrame) -> DataFrame:
    """Newest incoming article per url refreshes title, description, content, ingest time and run id."""
    latest = dedupe_latest(incoming, ["url"], ["ingested_at"], ["title"])
    return upsert(raw, latest, ["url"], ["title", "description", "content", "ingested_at", "pipeline_run_id"])
