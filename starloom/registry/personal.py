"""Finance, fitness and media star schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import schemas
from ..operators.clean import fitness_reject_rules, media_reject_rules, split_rejects
from ..plans import bindings as B
from ..plans import marts, personal
from ..session import materialize
from . import sql as S
from .core import query


def finance(spark, sf_dir):
    stg = B.stg_finance(spark, sf_dir)
    dim = materialize(personal.load_categories(schemas.empty(spark, schemas.DIM_CATEGORY), stg), "dim_category")
    return dim, personal.transactions(stg, dim)


def fitness(spark, sf_dir):
    stg, _ = split_rejects(B.stg_fitness(spark, sf_dir), fitness_reject_rules())
    dim = materialize(personal.load_workout_types(schemas.empty(spark, schemas.DIM_WORKOUT_TYPE), stg), "dim_workout_type")
    return dim, personal.workouts(stg, dim)


def media(spark, sf_dir):
    stg, _ = split_rejects(B.stg_media(spark, sf_dir), media_reject_rules())
    dim = materialize(personal.load_media_items(schemas.empty(spark, schemas.DIM_MEDIA_ITEM), stg), "dim_media_item")
    return dim, personal.media_log(stg, dim)


_AMOUNT = S.money("value")


@query("finance_summary", f"""
SELECT COUNT(*) AS total_transactions, {S.total(_AMOUNT)} AS total_spend, {S.mean(_AMOUNT, 2)} AS avg_transaction_amount,
  CAST(MAX({_AMOUNT}) AS DOUBLE) AS max_single_transaction FROM events""")
def finance_summary(spark, sf_dir) -> DataFrame:
    return marts.finance_summary(finance(spark, sf_dir)[1])


@query("finance_by_category", f"""
SELECT event_type AS category_name, CASE WHEN event_type = 'purchase' THEN 'Income' ELSE 'Expense' END AS category_type,
  COUNT(*) AS transaction_count, {S.total(_AMOUNT)} AS category_total_spend FROM events GROUP BY 1""")
def finance_by_category(spark, sf_dir) -> DataFrame:
    return marts.finance_by_category(*finance(spark, sf_dir))


@query("fitness_summary", f"""
SELECT COUNT(*) AS total_workouts, {S.big('SUM(floor(value))')} AS total_duration_minutes,
  {S.big("SUM(CAST(json_extract_string(props, '$.k') AS BIGINT))")} AS total_calories_burned, {S.mean('floor(value)', 0, 1)} AS avg_workout_duration_min
FROM events WHERE floor(value) > 0""")
def fitness_summary(spark, sf_dir) -> DataFrame:
    return marts.fitness_summary(fitness(spark, sf_dir)[1])


@query("fitness_by_type", f"""
SELECT event_type AS workout_name, CASE WHEN event_type = 'signup' THEN 'Strength' ELSE 'Cardio' END AS workout_category, COUNT(*) AS total_sessions,
  {S.big('SUM(floor(value))')} AS total_minutes, {S.big("SUM(CAST(json_extract_string(props, '$.k') AS BIGINT))")} AS total_calories
FROM events WHERE floor(value) > 0 GROUP BY 1""")
def fitness_by_type(spark, sf_dir) -> DataFrame:
    return marts.fitness_by_type(*fitness(spark, sf_dir))


_RATED = "SELECT role AS media_type, length(text) % 110 / 10.0::DOUBLE AS rating FROM conversations WHERE length(text) % 110 <= 100"


@query("media_summary", f"SELECT COUNT(*) AS total_items_consumed, {S.mean('rating')} AS avg_rating FROM ({_RATED}) AS r")
def media_summary(spark, sf_dir) -> DataFrame:
    return marts.media_summary(media(spark, sf_dir)[1])


@query("media_by_type", f"SELECT media_type, COUNT(*) AS items_logged, {S.mean('rating')} AS avg_type_rating FROM ({_RATED}) AS r GROUP BY 1")
def media_by_type(spark, sf_dir) -> DataFrame:
    return marts.media_by_type(*media(spark, sf_dir))


@query("finance_incremental", """
SELECT CAST(COUNT(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-16') AS BIGINT) AS new_rows, COUNT(*) AS last_key FROM events""")
def finance_incremental(spark, sf_dir) -> DataFrame:
    """The second load adds only records whose id was not loaded; keys continue."""
    from pyspark.sql import functions as F

    dim, facts = finance(spark, sf_dir)
    loaded = materialize(personal.transactions(B.stg_finance(spark, sf_dir).filter("transaction_date < '2024-01-16'"), dim), "fact_transactions")
    fresh = personal.transactions(B.stg_finance(spark, sf_dir), dim, loaded)
    return fresh.agg(F.count(F.lit(1)).alias("new_rows"), F.max("transaction_key").alias("last_key"))
