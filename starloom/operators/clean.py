"""Staging: header and alias handling, routing, cleaning, row-level rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import NULL_TOKENS, has_key, has_text, random_id, trimmed_or
from .keys import dedupe_latest

# Accepted spellings of each staging column, preferred first.
WEATHER_ALIASES = {
    "city": ("city", "location"),
    "country_code": ("country_code", "country"),
    "observation_dt": ("observation_dt", "date", "full_date"),
    "temp_celsius": ("temp_celsius", "temperature", "temp", "avg_temp"),
    "feels_like_c": ("feels_like_c", "feels_like"),
    "temp_min_c": ("temp_min_c", "temp_min"),
    "temp_max_c": ("temp_max_c", "temp_max"),
    "pressure_hpa": ("pressure_hpa", "pressure"),
    "humidity_pct": ("humidity_pct", "humidity"),
    "wind_speed_ms": ("wind_speed_ms", "wind_speed", "wind"),
    "weather_main": ("weather_main",),
}
STOCK_ALIASES = {
    "ticker": ("ticker", "symbol"),
    "trade_date": ("trade_date", "date", "full_date"),
    "open_price": ("open_price", "open"),
    "high_price": ("high_price", "high"),
    "low_price": ("low_price", "low"),
    "close_price": ("close_price", "close"),
    "volume": ("volume",),
}
NEWS_ALIASES = {
    "title": ("title", "headline"),
    "topic": ("topic", "category"),
    "source_name": ("source_name", "source"),
    "published_at": ("published_at", "date"),
    "url": ("url",),
}

# Columns whose presence sends a batch to a domain.
WEATHER_MARKS = ("temp_celsius", "temperature", "temp", "humidity", "humidity_pct", "weather_main")
STOCK_KEYS = ("ticker", "symbol")
STOCK_MARKS = ("close_price", "close", "open_price", "open", "trade_date")
NEWS_KEYS = ("title", "headline", "article")
NEWS_MARKS = ("topic", "source", "source_name", "category")
CUSTOMER_COLUMNS = (
    "customer_id", "raw_customer_id", "first_name", "last_name", "email",
    "customer_tier", "city", "state", "country", "updated_at",
)
PRODUCT_COLUMNS = (
    "product_id", "raw_product_id", "product_name", "category",
    "subcategory", "unit_price", "cost_price", "updated_at",
)
FINANCE_COLUMNS = ("raw_id", "amount", "category_name", "category_type", "merchant", "transaction_date", "notes")
FITNESS_COLUMNS = ("raw_id", "workout_name", "workout_category", "duration_minutes", "calories_burned", "workout_date", "intensity")
MEDIA_COLUMNS = ("raw_id", "title", "media_type", "genre", "creator", "consumed_date", "rating", "notes")
ORDER_COLUMNS = (
    "order_id", "order_line_number", "customer_id", "product_id", "order_timestamp",
    "quantity", "unit_price", "discount_amount", "tax_amount",
)

# Defaults for values an upload leaves out.
WEATHER_DEFAULTS = {"temp_celsius": 25.0, "pressure_hpa": 1013, "humidity_pct": 65, "wind_speed_ms": 5.0, "country_code": "IND"}
TEMP_SPREAD = 2.0
STOCK_DEFAULTS = {"open_price": 100.0, "volume": 1000000}
STOCK_RATIOS = {"high_price": 1.02, "low_price": 0.98, "close_price": 1.01}
NEWS_DEFAULTS = {"topic": "general", "source_name": "General News"}
PERSONAL_DEFAULTS = {"category_type": "Expense", "workout_category": "Cardio", "intensity": "Moderate", "calories_burned": 0}
DEFAULT_TIER = "Standard"
DEFAULT_CATEGORY = "Unassigned"
DEFAULT_SUBCATEGORY = "General"

CUSTOMER_ATTRIBUTES = ("first_name", "last_name", "email", "customer_tier", "city", "state", "country")
PRODUCT_ATTRIBUTES = ("product_name", "category", "subcategory", "unit_price", "cost_price", "updated_at")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def distinct_projection(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of those `columns` that the frame has."""
    return df.select(*[c for c in columns if c in df.columns]).dropDuplicates()


def route(df: DataFrame) -> dict[str, DataFrame]:
    """Split one mixed batch into the domains its columns describe; a batch can feed several."""
    df = normalise_headers(df)
    have = set(df.columns)
    parts: dict[str, DataFrame] = {}
    if "city" in have and have.intersection(WEATHER_MARKS):
        parts["weather"] = df
    if have.intersection(STOCK_KEYS) and have.intersection(STOCK_MARKS):
        parts["stocks"] = df
    if have.intersection(NEWS_KEYS) and have.intersection(NEWS_MARKS):
        parts["news"] = df
    if have.intersection(("customer_id", "raw_customer_id")):
        parts["customers"] = distinct_projection(df, CUSTOMER_COLUMNS)
    if have.intersection(("product_id", "raw_product_id")):
        parts["products"] = distinct_projection(df, PRODUCT_COLUMNS)
    for name, marks, columns in (
        ("finance", {"amount", "category_name"}, FINANCE_COLUMNS),
        ("fitness", {"workout_name", "duration_minutes"}, FITNESS_COLUMNS),
        ("media", {"title", "media_type"}, MEDIA_COLUMNS),
    ):
        if marks <= have:
            parts[name] = df.select(*[c for c in columns if c in have])
    if {"order_id", "quantity"} <= have:
        parts["orders"] = df.select(*[c for c in ORDER_COLUMNS if c in have])
    return parts


def first_present(df: DataFrame, names: Sequence[str], kind: str, default: Column | None = None) -> Column:
    """First usable value among alias columns, cast leniently; `default` when there is none."""
    values = []
    for name in names:
        if name in df.columns:
            text = F.col(name).cast("string")
            usable = F.when(~F.lower(F.trim(text)).isin(*NULL_TOKENS), F.trim(text))
            values.append(usable if kind == "string" else usable.try_cast(kind))
    if default is not None:
        values.append(default.cast(kind))
    return F.coalesce(*values) if values else F.lit(None).cast(kind)


def _now(as_of: Column | None) -> Column:
    return as_of if as_of is not None else F.current_timestamp()


def stage_weather(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Observations with aliases resolved and gaps defaulted; rows without a city are dropped."""
    a, d = WEATHER_ALIASES, WEATHER_DEFAULTS

    def number(name: str, default: Column, kind: str = "double") -> Column:
        return first_present(df, a[name], kind, default)

    staged = df.withColumn("_city", first_present(df, a["city"], "string")).filter("_city is not null")
    staged = staged.withColumn("_temp", number("temp_celsius", F.lit(d["temp_celsius"])))
    return staged.select(
        F.col("_city").alias("city"),
        first_present(df, a["country_code"], "string", F.lit(d["country_code"])).alias("country_code"),
        first_present(df, a["observation_dt"], "timestamp", _now(as_of)).alias("observation_dt"),
        F.col("_temp").alias("temp_celsius"),
        number("feels_like_c", F.col("_temp")).alias("feels_like_c"),
        number("temp_min_c", F.col("_temp") - TEMP_SPREAD).alias("temp_min_c"),
        number("temp_max_c", F.col("_temp") + TEMP_SPREAD).alias("temp_max_c"),
        number("pressure_hpa", F.lit(d["pressure_hpa"]), "int").alias("pressure_hpa"),
        number("humidity_pct", F.lit(d["humidity_pct"]), "int").alias("humidity_pct"),
        number("wind_speed_ms", F.lit(d["wind_speed_ms"])).alias("wind_speed_ms"),
        first_present(df, a["weather_main"], "string").alias("weather_main"),
    )


def stage_stocks(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Daily bars with aliases resolved; missing prices follow from the open price."""
    a, d = STOCK_ALIASES, STOCK_DEFAULTS
    staged = df.withColumn("_ticker", F.upper(first_present(df, a["ticker"], "string")))
    staged = staged.filter("_ticker is not null").withColumn(
        "_open", first_present(df, a["open_price"], "double", F.lit(d["open_price"]))
    )
    derived = [
        first_present(df, a[name], "double", F.col("_open") * ratio).alias(name) for name, ratio in STOCK_RATIOS.items()
    ]
    day = first_present(df, a["trade_date"], "string", F.date_format(_now(as_of), "yyyy-MM-dd"))
    return staged.select(
        F.col("_ticker").alias("ticker"),
        F.substring(day, 1, 10).try_cast("date").alias("trade_date"),
        F.col("_open").alias("open_price"),
        *derived,
        first_present(df, a["volume"], "bigint", F.lit(d["volume"])).alias("volume"),
    )


def stage_news(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Articles with aliases resolved; rows without a title are dropped."""
    a, d = NEWS_ALIASES, NEWS_DEFAULTS
    staged = df.withColumn("_title", first_present(df, a["title"], "string")).filter("_title is not null")
    return staged.select(
        F.col("_title").alias("title"),
        F.lower(first_present(df, a["topic"], "string", F.lit(d["topic"]))).alias("topic"),
        first_present(df, a["source_name"], "string", F.lit(d["source_name"])).alias("source_name"),
        first_present(df, a["published_at"], "timestamp", _now(as_of)).alias("published_at"),
        first_present(df, a["url"], "string").alias("url"),
    )


def stage_customers(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Customer records in staging shape; rows without an id are dropped."""
    staged = df.withColumn("_id", first_present(df, ("raw_customer_id", "customer_id"), "string"))
    defaults = {c: F.lit("") for c in CUSTOMER_ATTRIBUTES} | {"customer_tier": F.lit(DEFAULT_TIER)}
    return staged.filter("_id is not null").select(
        F.col("_id").alias("raw_customer_id"),
        *[first_present(df, (c,), "string", defaults[c]).alias(c) for c in CUSTOMER_ATTRIBUTES],
        first_present(df, ("updated_at",), "timestamp", _now(as_of)).alias("updated_at"),
    )


def stage_products(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Product records in staging shape; the name falls back to the id."""
    staged = df.withColumn("_id", first_present(df, ("raw_product_id", "product_id"), "string"))
    text = {"product_name": F.col("_id"), "category": F.lit("General"), "subcategory": F.lit("General")}
    return staged.filter("_id is not null").select(
        F.col("_id").alias("raw_product_id"),
        *[first_present(df, (c,), "string", dflt).alias(c) for c, dflt in text.items()],
        *[first_present(df, (c,), "decimal(12,2)", F.lit(0)).alias(c) for c in ("unit_price", "cost_price")],
        first_present(df, ("updated_at",), "timestamp", _now(as_of)).alias("updated_at"),
    )


def stage_orders(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Order lines in staging shape, bad rows included; `split_rejects` separates them."""
    money_columns = ("unit_price", "discount_amount", "tax_amount")
    return df.select(
        *[first_present(df, (c,), "string").alias(c) for c in ("order_id", "customer_id", "product_id")],
        first_present(df, ("order_line_number",), "int", F.lit(1)).alias("order_line_number"),
        first_present(df, ("order_timestamp",), "timestamp", _now(as_of)).alias("order_timestamp"),
        first_present(df, ("quantity",), "double").try_cast("int").alias("quantity"),
        *[first_present(df, (c,), "decimal(12,2)", F.lit(0)).alias(c) for c in money_columns],
    )


def _personal(df: DataFrame, tag: str, columns: dict[str, tuple[str, Column | None]], as_of: Column | None) -> DataFrame:
    """Personal records in staging shape; one without an id gets a random one, which the staging table then keeps."""
    picked = [first_present(df, (c,), kind, default).alias(c) for c, (kind, default) in columns.items()]
    return df.select(first_present(df, ("raw_id",), "string", random_id(tag)).alias("raw_id"), *picked, _now(as_of).alias("ingested_at"))


def stage_finance(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Transactions: the type falls back to an expense, the day to today."""
    kind, today = F.lit(PERSONAL_DEFAULTS["category_type"]), F.to_date(_now(as_of))
    return _personal(df, "FIN", {
        "amount": ("decimal(12,2)", None), "category_name": ("string", None), "category_type": ("string", kind),
        "merchant": ("string", None), "transaction_date": ("date", today), "notes": ("string", None),
    }, as_of)


def stage_fitness(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Workouts, bad durations and calories included; `split_rejects` separates them."""
    d = PERSONAL_DEFAULTS
    return _personal(df, "FIT", {
        "workout_name": ("string", None), "workout_category": ("string", F.lit(d["workout_category"])), "duration_minutes": ("int", None),
        "calories_burned": ("int", F.lit(d["calories_burned"])), "workout_date": ("date", F.to_date(_now(as_of))), "intensity": ("string", F.lit(d["intensity"])),
    }, as_of)


def stage_media(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Consumed media, ratings out of range included; `split_rejects` separates them."""
    text = {c: ("string", None) for c in ("title", "media_type", "genre", "creator")}
    more = {"consumed_date": ("date", F.to_date(_now(as_of))), "rating": ("double", None), "notes": ("string", None)}
    return _personal(df, "MED", text | more, as_of)


def order_reject_rules() -> dict[str, Column]:
    """Reason -> condition that makes an order line unusable."""
    return {
        "invalid order_id": ~has_key("order_id"),
        "invalid customer_id": ~has_key("customer_id"),
        "invalid product_id": ~has_key("product_id"),
        "invalid quantity": F.col("quantity").isNull() | (F.col("quantity") <= 0),
    }


def finance_reject_rules() -> dict[str, Column]:
    return {
        "missing amount": F.col("amount").isNull(),
        "missing category_name": ~has_text("category_name"),
        "missing merchant": ~has_text("merchant"),
    }


def fitness_reject_rules() -> dict[str, Column]:
    return {
        "missing workout_name": ~has_text("workout_name"),
        "duration_minutes not positive": F.col("duration_minutes").isNull() | (F.col("duration_minutes") <= 0),
        "calories_burned negative": F.coalesce(F.col("calories_burned") < 0, F.lit(False)),
    }


def media_reject_rules() -> dict[str, Column]:
    return {
        "missing title": ~has_text("title"),
        "missing media_type": ~has_text("media_type"),
        "rating outside 0..10": F.coalesce(~F.col("rating").between(0.0, 10.0), F.lit(False)),
    }


def with_reject_reason(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add `reject_reason`: every broken rule, NULL for a good row."""
    broken = [F.when(test, F.lit(reason)) for reason, test in rules.items()]
    return df.withColumn("reject_reason", F.nullif(F.concat_ws("; ", *broken), F.lit("")))


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    judged = with_reject_reason(df, rules)
    return judged.filter("reject_reason is null").drop("reject_reason"), judged.filter("reject_reason is not null")


def clean_customers(stg: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One current record per customer: trimmed, e-mail lower-cased, tier defaulted."""
    cleaned = stg.filter(has_text("raw_customer_id")).select(
        F.trim("raw_customer_id").alias("customer_id"),
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        F.lower(F.trim("email")).alias("email"),
        trimmed_or("customer_tier", DEFAULT_TIER).alias("customer_tier"),
        *[F.trim(c).alias(c) for c in ("city", "state", "country")],
        F.coalesce("updated_at", _now(as_of)).alias("updated_at"),
    )
    return dedupe_latest(cleaned, ["customer_id"], ["updated_at"], ["customer_tier", "email", "last_name", "first_name", "city"])


def clean_products(stg: DataFrame) -> DataFrame:
    """One current record per product: trimmed, blanks and missing prices defaulted."""
    zero = F.lit(0).cast("decimal(12,2)")
    cleaned = stg.filter(has_text("raw_product_id")).select(
        F.trim("raw_product_id").alias("product_id"),
        F.trim("product_name").alias("product_name"),
        trimmed_or("category", DEFAULT_CATEGORY).alias("category"),
        trimmed_or("subcategory", DEFAULT_SUBCATEGORY).alias("subcategory"),
        F.coalesce("unit_price", zero).alias("unit_price"),
        F.coalesce("cost_price", zero).alias("cost_price"),
        "updated_at",
    )
    return dedupe_latest(cleaned, ["product_id"], ["updated_at"], ["product_name", "unit_price", "cost_price", "category"])


def clean_orders(stg: DataFrame, tiebreak: Sequence[str] = (), ids_trimmed: bool = False) -> DataFrame:
    """One row per order line: usable ids, positive quantity, missing discount and tax as 0.

    ``ids_trimmed=True`` says the ids carry no padding; they then stay the columns the
    input is already partitioned by, and the de-duplication needs no exchange of its own.
    """
    ids = ["order_id", "customer_id", "product_id"]
    usable = stg
    for name in ids:
        usable = usable.filter(has_text(name) if not ids_trimmed else F.col(name).isNotNull())
    usable = usable.filter(F.col("quantity") > 0)
    zero = F.lit(0).cast("decimal(12,2)")
    values = {c: F.trim(c).alias(c) for c in ids} if not ids_trimmed else {}
    values |= {c: F.coalesce(c, zero).alias(c) for c in ("discount_amount", "tax_amount")}
    cleaned = usable.select(*[values.get(c, F.col(c)) for c in usable.columns])
    ties = list(tiebreak) or ["customer_id", "product_id", "quantity", "unit_price"]
    latest = dedupe_latest(cleaned, ["order_id", "order_line_number"], ["order_timestamp"], ties)
    return latest.select(*ORDER_COLUMNS)


