"""What one micro-batch does to the warehouse."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import (
    AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException,
    NumberFormatException, SparkRuntimeException,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.dates import date_key
from ..operators.clean import (
    CUSTOMER_ATTRIBUTES, clean_customers, clean_orders, clean_products, fitness_reject_rules, media_reject_rules, normalise_headers, order_reject_rules,
    route, split_rejects, stage_customers, stage_finance, stage_fitness, stage_media, stage_news, stage_orders, stage_products, stage_stocks, stage_weather,
)
from ..operators.joins import large_dimension_strategy, not_loaded, only_known
from ..operators.keys import dedupe_latest
from ..operators.measures import high_value_alerts
from ..operators.quality import failure_alerts, reject_log, run_assertions, staging_checks
from ..plans import domains, personal
from ..plans.audit import run_finished, run_started
from ..plans.calendar import REALTIME_RANGE, date_dim
from ..plans.insights import insight_row
from ..plans.marts import vip_orders
from ..plans.sales import load_customers, load_products, sales_facts
from ..session import freed_shuffles, materialize, materialize_pieces, passing_scratch, scratch_path
from ..sources.sinks import refresh_replica
from ..sources.store import TableStore, Transaction

# Errors the batch itself causes; anything else (a lost executor, a full disk) is raised and the batch replayed.
_DATA_ERRORS = (
    AnalysisException, ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, IllegalArgumentException,
    NumberFormatException, SparkRuntimeException, ValueError,
)
#: Columns by which a stream says what file a row is from.
SOURCE_FILE, SOURCE_TIME = "_source_file", "_source_time"
_INFERRED_SINCE = "1900-01-01 00:00:00"
_PRODUCT_MARKS = ("product_name", "category", "subcategory", "cost_price")
Batch = DataFrame | Sequence[DataFrame]
#: Staged order lines that become facts at a time: their exchanges hold so many rows, however large the batch is.
PASS_ROWS = 30_000_000


@dataclass(frozen=True)
class _Personal:
    """How the records of a personal domain are staged, judged and loaded."""

    staging: str
    dim: str
    fact: str
    ddl: str
    stage: Callable
    rules: Callable | None
    members: Callable
    facts: Callable


_PERSONAL = {
    "finance": _Personal(
        "stg_finance_transactions", "dim_category", "fact_transactions", schemas.DIM_CATEGORY, stage_finance, None, personal.new_categories, personal.transactions
    ),
    "fitness": _Personal(
        "stg_fitness_workouts", "dim_workout_type", "fact_workouts", schemas.DIM_WORKOUT_TYPE, stage_fitness, fitness_reject_rules,
        personal.new_workout_types, personal.workouts,
    ),
    "media": _Personal(
        "stg_media_consumption", "dim_media_item", "fact_media_log", schemas.DIM_MEDIA_ITEM, stage_media, media_reject_rules, personal.new_media_items, personal.media_log
    ),
}
_SALES_PARTS = ("customers", "products", "orders")
_KEYS = {"orders": ("order_id",), "customers": ("customer_id", "raw_customer_id"), "products": ("product_id", "raw_product_id"),
         "finance": ("category_name",), "fitness": ("workout_name",), "media": ("media_type",)}


def _pieces(batch: Batch) -> list[DataFrame]:
    return [batch] if isinstance(batch, DataFrame) else list(batch)


def drop_absent(batch: DataFrame) -> DataFrame:
    """Columns that hold a value somewhere in the batch.

    A stream has one wide schema; what a file really carried shows in its values.
    """
    present = batch.agg(*[F.bool_or(F.col(c).isNotNull()).alias(c) for c in batch.columns]).first()
    return batch.select(*[c for c in batch.columns if present[c]])


def _of_part(frame: DataFrame, part: str) -> DataFrame:
    """Rows that name the part's key; an order row may miss its id if it has a quantity."""
    if part == "news" and {"title", "media_type"} <= set(frame.columns):
        return frame.filter(F.col("media_type").isNull())  # a media record has a title too
    marks = [c for c in _KEYS.get(part, ()) if c in frame.columns]
    if part == "orders":
        marks.append("quantity")
    if not marks:
        return frame
    return frame.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in marks]))


def load_batch(batch: Batch, txn: Transaction, run_id: str, as_of: Column | None = None) -> dict[str, int]:
    """Route, stage, update dimensions, load facts. Returns the counters of the run.

    Order lines become facts last, from their staging table, when the written batch has gone.
    """
    counters = {"records_extracted": 0, "records_loaded": 0, "records_transformed": 0, "records_rejected": 0}
    pieces = [normalise_headers(piece) for piece in _pieces(batch)]
    with passing_scratch(pieces[0].sparkSession):
        batch = materialize_pieces(pieces, "batch")
        counters["records_extracted"] = batch.count()
        if counters["records_extracted"] == 0:
            return counters
        parts = {name: _of_part(frame, name) for name, frame in route(drop_absent(batch)).items()}
        staged = _stage_sales(parts, txn, run_id, counters, as_of)
        if "stocks" in parts:
            _load_stocks(stage_stocks(parts["stocks"], as_of), txn, run_id, counters, as_of)
        if "weather" in parts:
            _load_weather(stage_weather(parts["weather"], as_of), txn, run_id, counters, as_of)
        for name in _PERSONAL:
            if name in parts:
                _load_personal(name, parts[name], txn, run_id, counters, as_of)
        if "news" in parts:
            _load_news(stage_news(parts["news"], as_of), txn, run_id, counters, as_of)
    if staged is not None:
        _load_facts(*staged, txn, run_id, counters, as_of)
    return counters


def _append(txn: Transaction, name: str, rows: DataFrame, counters: dict[str, int], counter: str) -> DataFrame:
    written = txn.append(name, rows)
    counters[counter] += written.count()
    return written


def _with_inferred(frame: DataFrame, keys: tuple[str, ...], described_by: tuple[str, ...], stage, known: DataFrame | None, key: str, as_of) -> DataFrame:
    """Staged members of a batch: described ones, and bare ids that nobody knows yet.

    An order row may name a customer or product without describing it. Such an id never
    changes a known member; an unknown one becomes a member that any later description supersedes.
    """
    marks = [c for c in described_by if c in frame.columns]
    described = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in marks], F.lit(False))
    staged = stage(frame.filter(described), as_of)
    bare = stage(frame.filter(~described).select(*[k for k in keys if k in frame.columns]), F.lit(_INFERRED_SINCE).cast("timestamp"))
    bare = not_loaded(bare.dropDuplicates([key]), staged, [key])
    if known is not None:
        bare = not_loaded(bare, known, [key])
    return staged.unionByName(bare)


def _load_members(part: DataFrame, txn: Transaction, counters: dict[str, int], as_of, names: tuple[str, str], keys, described_by, stage, clean, load) -> None:
    """Members of one dimension: staged, and merged into the hash buckets that hold their ids; other buckets are neither read nor written."""
    table, staging = names
    natural, raw_key = keys
    ids = clean(stage(part, as_of)).select(natural)
    dim = txn.read_buckets(table, ids) if txn.layout(table) is not None else txn.read(table)
    known = dim.select(F.col(natural).alias(raw_key)) if dim is not None else None
    members = _with_inferred(part, keys, described_by, stage, known, raw_key, as_of)
    before = counters["records_loaded"]
    staged = _append(txn, staging, members, counters, "records_loaded")
    if dim is None:
        txn.replace(table, load(None, clean(staged)))
    elif counters["records_loaded"] > before:
        merged = load(dim, clean(staged), first_key=txn.high(table) if txn.layout(table) is not None else None)
        if txn.layout(table) is not None:
            txn.replace_buckets(table, merged, txn.buckets(table, ids))
        else:
            txn.replace(table, merged)


def _stage_sales(parts: dict[str, DataFrame], txn: Transaction, run_id: str, counters: dict[str, int], as_of) -> tuple[DataFrame, int] | None:
    """Members and order lines of a batch; the staged lines, as the staging table holds them, and how many they are."""
    if "customers" in parts:
        names = ("dim_customer", "stg_customers")
        _load_members(parts["customers"], txn, counters, as_of, names, _KEYS["customers"], CUSTOMER_ATTRIBUTES, stage_customers, clean_customers, load_customers)
    if "products" in parts:
        names = ("dim_product", "stg_products")
        _load_members(parts["products"], txn, counters, as_of, names, _KEYS["products"], _PRODUCT_MARKS, stage_products, clean_products, load_products)
    if "orders" not in parts:
        return None
    valid, rejects = split_rejects(stage_orders(parts["orders"], as_of), order_reject_rules())
    before = counters["records_loaded"]
    staged = _append(txn, "stg_orders", valid, counters, "records_loaded")
    log = reject_log(rejects, "stg_orders", run_id, ["order_id", "customer_id", "product_id", "quantity"], as_of)
    _append(txn, "data_quality_log", log, counters, "records_rejected")
    return staged, counters["records_loaded"] - before


def _pass_of(passes: int) -> Column:
    """The pass of an order line, staged or loaded; lines of one identity share one. Salted, as slots of keys hash the same columns."""
    return F.pmod(F.xxhash64(F.lit("pass"), F.trim("order_id"), F.col("order_line_number")), F.lit(passes).cast("bigint"))


def _load_facts(staged: DataFrame, rows: int, txn: Transaction, run_id: str, counters: dict[str, int], as_of) -> None:
    """Staged order lines as facts, in passes of about PASS_ROWS lines; what a pass writes besides its facts goes with it.

    What the lines may meet in the store is looked up once for all passes.
    """
    ids = staged.withColumns({c: F.trim(c) for c in ("order_id", "customer_id", "product_id")})
    customers, products = txn.read_buckets("dim_customer", ids), txn.read_buckets("dim_product", ids)
    if customers is None or products is None:  # no line of this batch names both
        return
    loaded, strategy = txn.read_matching("fact_sales", ids), large_dimension_strategy(customers)
    passes, added = max(1, -(-rows // PASS_ROWS)), []
    for k in range(passes):
        some, met = staged, loaded
        if passes > 1:
            some = staged.filter(_pass_of(passes) == k)
            met = loaded.filter(_pass_of(passes) == k) if loaded is not None else None
        with passing_scratch(staged.sparkSession):
            facts = sales_facts(
                clean_orders(some), customers, products, met, late=True, strategy=strategy, created_at=as_of, dense=True, first_key=txn.high("fact_sales")
            )
            added.append(_append(txn, "fact_sales", facts, counters, "records_transformed"))
    written = reduce(DataFrame.unionByName, added)
    alerts = high_value_alerts(vip_orders(written, customers, ["created_at", "order_date_key", "order_id", "order_line_number"]))
    txn.append("alerts", _alert_rows(alerts, run_id))


def _alert_rows(alerts: DataFrame, run_id: str) -> DataFrame:
    return alerts.select("alert_type", "title", "message", F.lit(run_id).alias("pipeline_run_id"))


def _lineage(staged: DataFrame, run_id: str, source: str, as_of) -> DataFrame:
    when = as_of if as_of is not None else F.current_timestamp()
    return staged.withColumns({"source": F.lit(source), "ingested_at": when, "pipeline_run_id": F.lit(run_id)})


def _shape(df: DataFrame, ddl: str) -> DataFrame:
    """The columns of a raw table; those the batch lacks are NULL."""
    model = schemas.empty(df.sparkSession, ddl).schema
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in model]
    )


def _gate(raw: DataFrame, table: str, txn: Transaction, run_id: str) -> None:
    """Failure alerts of a raw table's checks; nothing failed, nothing written."""
    checks = [c for c in staging_checks() if c.table == table]
    failed = failure_alerts(run_assertions({table: raw}, checks), run_id)
    txn.append("alerts", _alert_rows(failed, run_id))


def _matching(txn: Transaction, name: str, incoming: DataFrame, ddl: str) -> DataFrame:
    """The members of a dimension that incoming rows can match."""
    table = txn.read_matching(name, incoming)
    return table if table is not None else schemas.empty(txn.store.spark, ddl)


def _load_stocks(staged: DataFrame, txn: Transaction, run_id: str, counters: dict[str, int], as_of) -> None:
    raw = _append(txn, "raw_stock_prices", _shape(_lineage(staged, run_id, "upload", as_of), schemas.RAW_STOCK_PRICES), counters, "records_loaded")
    _gate(raw, "raw_stock_prices", txn, run_id)
    txn.append("dim_company", domains.new_companies(_matching(txn, "dim_company", raw, schemas.DIM_COMPANY), raw, txn.high("dim_company")))
    companies = _matching(txn, "dim_company", raw, schemas.DIM_COMPANY)
    # returns need the history of the tickers in the batch, and only theirs
    touched = raw.select("ticker").distinct()
    history = only_known(txn.read_buckets("raw_stock_prices", touched), touched, ["ticker"])
    history = dedupe_latest(history, ["ticker", "trade_date"], ["ingested_at"], ["close_price", "volume"])
    bars = raw.select("ticker", "trade_date").distinct()
    keys = bars.join(companies.select("ticker", "company_key"), "ticker").withColumn("date_key", date_key("trade_date"))
    loaded = txn.read_matching("fact_stock_prices", keys)
    facts = domains.stock_facts(history, companies, loaded, bars, txn.high("fact_stock_prices"))
    _append(txn, "fact_stock_prices", facts, counters, "records_transformed")


def _load_weather(staged: DataFrame, txn: Transaction, run_id: str, counters: dict[str, int], as_of) -> None:
    shaped = _shape(_lineage(staged, run_id, "upload", as_of), schemas.RAW_WEATHER)
    raw = _append(txn, "raw_weather_observations", shaped, counters, "records_loaded")
    _gate(raw, "raw_weather_observations", txn, run_id)
    txn.append("dim_location", domains.new_locations(_matching(txn, "dim_location", raw, schemas.DIM_LOCATION), raw, txn.high("dim_location")))
    hourly = domains.hourly_readings(raw, _matching(txn, "dim_location", raw, schemas.DIM_LOCATION))
    facts = domains.new_readings(hourly, txn.read_matching("fact_weather_readings", hourly), txn.high("fact_weather_readings"))
    _append(txn, "fact_weather_readings", facts, counters, "records_transformed")


def _load_news(staged: DataFrame, txn: Transaction, run_id: str, counters: dict[str, int], as_of) -> None:
    shaped = _shape(_lineage(staged, run_id, "upload", as_of), schemas.RAW_NEWS)
    raw = _append(txn, "raw_news_articles", shaped, counters, "records_loaded")
    _gate(raw, "raw_news_articles", txn, run_id)
    txn.append("dim_news_source", domains.new_sources(_matching(txn, "dim_news_source", raw, schemas.DIM_NEWS_SOURCE), raw, txn.high("dim_news_source")))
    single = domains.single_articles(raw, _matching(txn, "dim_news_source", raw, schemas.DIM_NEWS_SOURCE))
    facts = domains.new_articles(single, txn.read_matching("fact_news_articles", single), txn.high("fact_news_articles"))
    _append(txn, "fact_news_articles", facts, counters, "records_transformed")


def _load_personal(name: str, part: DataFrame, txn: Transaction, run_id: str, counters: dict[str, int], as_of) -> None:
    """Finance, fitness or media records: staged, rejects logged, new members and facts appended."""
    p = _PERSONAL[name]
    valid, rejects = split_rejects(p.stage(part, as_of), p.rules()) if p.rules is not None else (p.stage(part, as_of), None)
    if rejects is not None:
        judged = materialize(rejects, "rejects")
        _append(txn, "data_quality_log", reject_log(judged, p.staging, run_id, ["raw_id"], as_of), counters, "records_rejected")
    staged = _append(txn, p.staging, valid, counters, "records_loaded")
    txn.append(p.dim, p.members(_matching(txn, p.dim, staged, p.ddl), staged, txn.high(p.dim)))
    facts = p.facts(staged, _matching(txn, p.dim, staged, p.ddl), txn.read_matching(p.fact, staged), txn.high(p.fact))
    _append(txn, p.fact, facts, counters, "records_transformed")


def _insights(txn: Transaction, run_id: str, as_of) -> None:
    fact, customers = txn.read("fact_sales"), txn.read("dim_customer")
    if fact is None or customers is None:
        return
    today = as_of if as_of is not None else F.current_timestamp()
    calendar = date_dim(txn.store.spark, *REALTIME_RANGE)
    txn.append("insights", insight_row(fact, customers, calendar, F.to_date(today)).withColumn("pipeline_run_id", F.lit(run_id)))


def by_file(batch: DataFrame) -> list[tuple[str | None, DataFrame]]:
    """The rows of each file of a batch, oldest file first, without the two columns that name it."""
    marks = (SOURCE_FILE, SOURCE_TIME)
    if SOURCE_FILE not in batch.columns:
        return [(None, batch)]
    names = [c for c in batch.columns if c not in marks]
    # places instead of names: two headers of a batch may differ only in case
    flat = batch.toDF(*[c if c in marks else f"c{i}" for i, c in enumerate(batch.columns)])
    kept = [c for c in flat.columns if c not in marks]
    files = flat.groupBy(SOURCE_FILE).agg(F.max(SOURCE_TIME).alias(SOURCE_TIME)).collect()  # a row per file
    order = [r[SOURCE_FILE] for r in sorted(files, key=lambda r: (r[SOURCE_TIME], r[SOURCE_FILE]))]
    if len(order) < 2:
        return [(order[0] if order else None, flat.select(*kept).toDF(*names))]
    apart = flat.withColumn("part", F.sha2(SOURCE_FILE, 256)).select(*kept, "part")
    path = scratch_path(batch.sparkSession, "files")
    apart.write.partitionBy("part").parquet(path)
    stored = batch.sparkSession.read.schema(apart.schema).parquet(path)
    return [(f, stored.filter(F.col("part") == hashlib.sha256(f.encode()).hexdigest()).select(*kept).toDF(*names)) for f in order]


def _load_file(rows: Batch, file: str | None, txn: Transaction, run_id: str, run_type: str, batch_id: int, as_of, insights: bool) -> bool:
    """Apply one file to the load. False if its data cannot be processed: then only its quarantine and audit rows are added."""
    spark, before = txn.store.spark, txn.mark()
    pieces = _pieces(rows)
    with freed_shuffles(spark, pieces[0].sparkSession):  # a stream's batch has a session of its own
        try:
            about = {"batch_id": batch_id} | ({"file": file} if file is not None else {})
            txn.append("pipeline_runs", run_started(spark, run_id, run_type, about))
            counters = load_batch(rows, txn, run_id, as_of)
            if insights:
                _insights(txn, run_id, as_of)
            txn.append("pipeline_runs", run_finished(spark, run_id, run_type, "completed", counters))
        except _DATA_ERRORS as error:
            txn.undo(before)
            for piece in pieces:
                txn.append("quarantine", piece.select(F.lit(run_id).alias("pipeline_run_id"), F.to_json(F.struct("*")).alias("record")))
            text = str(error) if file is None else f"{file}: {error}"
            txn.append("pipeline_runs", run_finished(spark, run_id, run_type, "failed", error=text))
            return False
    return True


def process_batch(
    batch: Batch,
    batch_id: int,
    store: TableStore,
    stream: str = "files",
    as_of: Column | None = None,
    insights: bool = False,
    replica: TableStore | None = None,
    replicated: Sequence[str] | None = None,
    calendar: tuple[str, str] = REALTIME_RANGE,
) -> str:
    """Apply one micro-batch: returns "skipped", "completed" or "failed".

    All tables, the audit rows and the batch number are published by one commit, so a batch
    that is replayed after a crash is either skipped whole or done whole. The files of a batch are
    applied one after another, oldest first, so tables don't depend on how many share a batch. A file
    whose data cannot be processed is kept as JSON in `quarantine` with a failed audit row; the other files
    and the stream go on, and the batch counts as failed. A batch that doesn't name its files is one. The first
    batch of a store also writes its calendar, `dim_date`. A large batch that is made by joins may come as several
    frames of the same columns, its pieces: they are written one after another and then are one batch.
    """
    if store.manifest()["batches"].get(stream, -1) >= batch_id:
        return "skipped"
    run_id, txn = f"{stream}-{batch_id}", store.begin()
    if txn.read("dim_date") is None:
        with freed_shuffles(store.spark):
            txn.append("dim_date", date_dim(store.spark, *calendar))
    files = by_file(batch) if isinstance(batch, DataFrame) else [(None, batch)]
    done = [
        _load_file(rows, file, txn, run_id if len(files) == 1 else f"{run_id}-{k}", f"realtime_{stream}", batch_id, as_of, insights)
        for k, (file, rows) in enumerate(files)
    ]
    txn.commit(stream, batch_id)
    if replica is not None and any(done):
        refresh_replica(store, replica, replicated or store.names())
    return "completed" if all(done) else "failed"
