"""Nested API payloads (JSON text) -> flat raw records."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field names and markers of the payloads.
BAR_SERIES = "Time Series (Daily)"
BAR_FIELDS = {
    "open_price": "1. open", "high_price": "2. high", "low_price": "3. low", "close_price": "4. close", "volume": "5. volume",
}
REMOVED_TITLE = "[Removed]"
CONTENT_LENGTH = 500
OBSERVATION = (
    "cod int, dt bigint, visibility int, coord struct<lat:double,lon:double>, sys struct<country:string>, "
    "main struct<temp:double,feels_like:double,temp_min:double,temp_max:double,pressure:int,humidity:int>, "
    "wind struct<speed:double,deg:int>, clouds struct<all:int>, rain struct<`1h`:double>, snow struct<`1h`:double>, "
    "weather array<struct<main:string,description:string>>"
)
ARTICLES = (
    "status string, articles array<struct<source:struct<id:string,name:string>,author:string,title:string,"
    "description:string,url:string,urlToImage:string,publishedAt:string,content:string>>"
)


def _or(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def daily_bars(df: DataFrame, payload: str = "payload", ticker: str = "ticker") -> DataFrame:
    """One row per day of each payload's series; a missing number becomes 0."""
    series = F.from_json(F.col(payload), f"struct<`{BAR_SERIES}`:map<string,map<string,string>>>")[BAR_SERIES]
    days = df.select(F.upper(ticker).alias("ticker"), F.explode(series).alias("day", "bar"))

    def number(field: str, kind: str) -> Column:
        return _or(F.try_element_at("bar", F.lit(BAR_FIELDS[field])).try_cast(kind), 0).cast(kind).alias(field)

    prices = [number(f, "double") for f in BAR_FIELDS if f != "volume"]
    return days.select("ticker", F.col("day").try_cast("date").alias("trade_date"), *prices, number("volume", "bigint"))


def observations(df: DataFrame, payload: str = "payload", city: str = "city") -> DataFrame:
    """One row per successful observation payload; missing numbers become 0, missing texts blank."""
    parsed = df.select(F.col(city).alias("city"), F.from_json(F.col(payload), OBSERVATION).alias("p")).filter("p.cod = 200")
    p = F.col("p")
    sky = F.try_element_at(p["weather"], F.lit(1))
    numbers = {
        "temp_celsius": p["main"]["temp"], "feels_like_c": p["main"]["feels_like"], "temp_min_c": p["main"]["temp_min"],
        "temp_max_c": p["main"]["temp_max"], "pressure_hpa": p["main"]["pressure"], "humidity_pct": p["main"]["humidity"],
        "wind_speed_ms": p["wind"]["speed"], "wind_deg": p["wind"]["deg"], "clouds_pct": p["clouds"]["all"],
        "visibility_m": p["visibility"], "rain_1h_mm": p["rain"]["1h"], "snow_1h_mm": p["snow"]["1h"],
        "latitude": p["coord"]["lat"], "longitude": p["coord"]["lon"],
    }
    return parsed.select(
        "city",
        _or(p["sys"]["country"], "").alias("country_code"),
        F.timestamp_seconds(_or(p["dt"], 0)).alias("observation_dt"),
        *[_or(v, 0).alias(n) for n, v in numbers.items()],
        _or(sky["main"], "").alias("weather_main"),
        _or(sky["description"], "").alias("weather_desc"),
    )


def articles(df: DataFrame, payload: str = "payload", topic: str = "topic") -> DataFrame:
    """One row per article of each successful page, without removed or untitled ones; content is cut to its stored length."""
    pages = df.select(F.col(topic).alias("topic"), F.from_json(F.col(payload), ARTICLES).alias("p")).filter("p.status = 'ok'")
    a = F.col("a")
    rows = pages.select("topic", F.explode("p.articles").alias("a"))
    rows = rows.filter(_or(a["title"], "") != "").filter(a["title"] != REMOVED_TITLE)
    return rows.select(
        _or(a["source"]["id"], "").alias("source_id"),
        _or(a["source"]["name"], "Unknown").alias("source_name"),
        _or(a["author"], "").alias("author"),
        a["title"].alias("title"),
        _or(a["description"], "").alias("description"),
        _or(a["url"], "").alias("url"),
        _or(a["urlToImage"], "").alias("url_to_image"),
        F.try_to_timestamp(a["publishedAt"]).alias("published_at"),
        F.substring(_or(a["content"], ""), 1, CONTENT_LENGTH).alias("content"),
        "topic",
    )


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All per-key extracts as one batch; columns a batch lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)
