"""Finance, fitness and media star schemas keyed by raw record id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import not_loaded
from ..operators.keys import dedupe_latest, dense_key, max_key
from ..operators.merge import insert_new

# Types of members that name none.
DEFAULT_CATEGORY_TYPE = "Expense"
DEFAULT_WORKOUT_CATEGORY = "Cardio"


def _members(stg: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """One row per natural key; of several attribute sets the newest wins."""
    for key in keys:
        stg = stg.filter(F.col(key).isNotNull())
    return dedupe_latest(stg.select(*keys, *attrs, "ingested_at", "raw_id"), keys, ["ingested_at"], ["raw_id"]).select(*keys, *attrs)


def new_categories(dim: DataFrame, stg: DataFrame, first_key: int | None = None) -> DataFrame:
    """Categories the dimension lacks. Here and below `dim` may be the rows that can match, then with the largest key given so far."""
    typed = stg.withColumn("category_type", F.coalesce("category_type", F.lit(DEFAULT_CATEGORY_TYPE)))
    members = _members(typed, ["category_name"], ["category_type"])
    return insert_new(dim, members, ["category_name"], "category_key", start=first_key)


def new_workout_types(dim: DataFrame, stg: DataFrame, first_key: int | None = None) -> DataFrame:
    typed = stg.withColumn("workout_category", F.coalesce("workout_category", F.lit(DEFAULT_WORKOUT_CATEGORY)))
    members = _members(typed, ["workout_name"], ["workout_category"])
    return insert_new(dim, members, ["workout_name"], "workout_type_key", start=first_key)


def new_media_items(dim: DataFrame, stg: DataFrame, first_key: int | None = None) -> DataFrame:
    members = _members(stg, ["title", "media_type"], ["genre", "creator"])
    return insert_new(dim, members, ["title", "media_type"], "media_key", start=first_key)


def load_categories(dim: DataFrame, stg: DataFrame) -> DataFrame:
    return dim.unionByName(new_categories(dim, stg))


def load_workout_types(dim: DataFrame, stg: DataFrame) -> DataFrame:
    return dim.unionByName(new_workout_types(dim, stg))


def load_media_items(dim: DataFrame, stg: DataFrame) -> DataFrame:
    return dim.unionByName(new_media_items(dim, stg))


def raw_facts(
    stg: DataFrame, dim: DataFrame, on: Sequence[str], dim_key: str, fact_key: str, columns: Sequence[str], loaded: DataFrame | None = None,
    first_key: int | None = None,
) -> DataFrame:
    """Fact rows of staged records not loaded before; the record id is the grain. `loaded` may be the part that can hold them, with the largest key so far."""
    single = dedupe_latest(stg.filter(F.col("raw_id").isNotNull()), ["raw_id"], ["ingested_at"], list(on))
    if loaded is not None:
        single = not_loaded(single, loaded, ["raw_id"])
    joined = single.join(dim.select(*on, dim_key), list(on))
    start = first_key if first_key is not None else max_key(loaded, fact_key) if loaded is not None else 0
    keyed = dense_key(joined, fact_key, ["raw_id"], start)
    return keyed.select(fact_key, "raw_id", dim_key, *columns)


def transactions(stg: DataFrame, dim: DataFrame, loaded: DataFrame | None = None, first_key: int | None = None) -> DataFrame:
    return raw_facts(stg, dim, ["category_name"], "category_key", "transaction_key", ["amount", "merchant", "transaction_date", "notes"], loaded, first_key)


def workouts(stg: DataFrame, dim: DataFrame, loaded: DataFrame | None = None, first_key: int | None = None) -> DataFrame:
    return raw_facts(stg, dim, ["workout_name"], "workout_type_key", "workout_key", ["duration_minutes", "calories_burned", "workout_date", "intensity"], loaded, first_key)


def media_log(stg: DataFrame, dim: DataFrame, loaded: DataFrame | None = None, first_key: int | None = None) -> DataFrame:
    return raw_facts(stg, dim, ["title", "media_type"], "media_key", "log_key", ["consumed_date", "rating", "notes"], loaded, first_key)
