"""How a table's rows are dealt into segments, and what the manifest remembers of each segment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of a versioned dimension until it is dealt out anew.
BUCKETS = 16


@dataclass(frozen=True)
class Layout:
    """Segments, identity and surrogate key of a table.

    One segment holds the rows of one load and one part: with `dated`, a range of `width` values of that column;
    with `hashed`, one of `buckets` hash buckets of these columns. `identity` are expressions that tell a row from
    all others; each segment gets a key filter over them. The manifest keeps the least and greatest value of the
    `ranges` columns of each segment, and the largest `surrogate` ever given.
    """

    dated: str | None = None
    width: int = 100
    hashed: tuple[str, ...] = ()
    buckets: int = BUCKETS
    identity: tuple[str, ...] = ()
    ranges: tuple[str, ...] = ()
    surrogate: str | None = None

    def part(self) -> Column | None:
        """The part of a row as an integer; rows without a date are part -1."""
        if self.dated:
            return F.coalesce(F.floor(F.col(self.dated) / F.lit(self.width)).cast("int"), F.lit(-1))
        if self.hashed:
            return bucket_of(self.hashed, self.buckets)
        return None

    def columns(self) -> set[str]:
        """Columns the layout can't do without; expressions of the identity are checked when they are used."""
        plain = {c for c in self.identity if c.isidentifier()}
        return plain | set(self.hashed) | set(self.ranges) | {c for c in (self.dated, self.surrogate) if c}

    def to_json(self) -> dict:
        return {k: list(v) if isinstance(v, tuple) else v for k, v in asdict(self).items()}

    @classmethod
    def from_json(cls, stored: dict | None) -> Layout | None:
        return None if stored is None else cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in stored.items()})


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    """Hash bucket of a key; values are compared as text, so that types need not agree."""
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in columns]), F.lit(buckets).cast("bigint")).cast("int")


def identity_hash(expressions: Sequence[Column]) -> Column:
    """64-bit hash of a row's identity, with the values as text."""
    return F.xxhash64(*[e.cast("string") for e in expressions])


def fits(layout: Layout | None, df: DataFrame) -> bool:
    return layout is not None and layout.columns() <= set(df.columns)


_ARTICLE = (
    "coalesce(nullif(trim(url), ''), sha2(concat_ws('\u0001', cast(source_key AS string), title, "
    "cast(date_key AS string), cast(published_hour AS string)), 256))"
)

#: Facts lie in months of their date key, versioned dimensions in hash buckets of their natural key.
WAREHOUSE = {
    "fact_sales": Layout(dated="order_date_key", identity=("order_id", "order_line_number"), ranges=("order_date_key",), surrogate="sales_fact_key"),
    "fact_stock_prices": Layout(dated="date_key", identity=("company_key", "date_key"), ranges=("date_key",), surrogate="stock_fact_key"),
    "fact_weather_readings": Layout(
        dated="date_key", identity=("location_key", "date_key", "observation_hour"), ranges=("date_key",), surrogate="weather_fact_key"
    ),
    "fact_news_articles": Layout(dated="date_key", identity=(_ARTICLE,), ranges=("date_key",), surrogate="news_fact_key"),
    "raw_stock_prices": Layout(hashed=("ticker",)),
    "raw_news_articles": Layout(hashed=("url",)),
    "dim_customer": Layout(hashed=("customer_id",), surrogate="customer_key"),
    "dim_product": Layout(hashed=("product_id",), surrogate="product_key"),
    "dim_company": Layout(identity=("ticker",), surrogate="company_key"),
    "dim_location": Layout(identity=("city", "country_code"), surrogate="location_key"),
    "dim_category": Layout(identity=("category_name",), surrogate="category_key"),
    "dim_workout_type": Layout(identity=("workout_name",), surrogate="workout_type_key"),
    "dim_media_item": Layout(identity=("title", "media_type"), surrogate="media_key"),
    "fact_transactions": Layout(identity=("raw_id",), surrogate="transaction_key"),
    "fact_workouts": Layout(identity=("raw_id",), surrogate="workout_key"),
    "fact_media_log": Layout(identity=("raw_id",), surrogate="log_key"),
    "dim_news_source": Layout(identity=("source_name",), surrogate="source_key"),
}
