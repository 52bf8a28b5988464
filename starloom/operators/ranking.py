"""Top rows, quantile groups and modes without single-task windows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CELLS = 4096  # cells a round divides an open range into
_TEXT_BYTES = 7  # of a text, in one number


def top(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First n rows of an ordering (planned as one bounded take per partition)."""
    return df.orderBy(*order).limit(n)


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First n rows of every key; map tasks forward at most n rows per key."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def top_groups(df: DataFrame, keys: Sequence[str], measure: Column, name: str, n: int) -> DataFrame:
    """The n groups with the largest measure, ties by key."""
    totals = df.groupBy(*keys).agg(measure.alias(name))
    return top(totals, [F.col(name).desc(), *[F.col(k).asc() for k in keys]], n)


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Most frequent non-null value per key, the smallest on a tie.

    Counts per value first, so a hot key is reduced on the map side to its distinct values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    first = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(first.alias("_first")).select(*keys, F.col("_first.v").alias(out))


@dataclass(frozen=True)
class _Word:
    """One 64-bit number of an ordering's code: its column, and whether it is a double."""

    name: str
    value: Column
    real: bool = False


def _words(df: DataFrame, column: str, ascending: bool, longest: int | None, prefix: str) -> list[_Word]:
    """The column as numbers whose order, one after another, is the column's own.

    Whole numbers, dates and times are one number; a decimal its digits above 10^18, those below and its fraction, all with its sign; text seven UTF-8 bytes each and then its
    length; a double a class (-inf, finite, +inf, NaN) and its value. Descending is the complement.
    """
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.StringType):
        data = F.encode(value, "UTF-8")
        parts = []
        for at in range(0, longest or 0, _TEXT_BYTES):
            digits = F.rpad(F.hex(F.substring(data, at + 1, _TEXT_BYTES)), 2 * _TEXT_BYTES, "0")
            parts.append(F.conv(digits, 16, 10).cast("bigint"))
        parts.append(F.octet_length(data).cast("bigint"))
    elif isinstance(kind, T.DecimalType):
        if kind.scale > 18:
            raise ValueError(f"{column}: more than 18 decimal places")
        unit = "1000000000000000000BD"
        high = [F.expr(f"`{column}` div {unit}")] if kind.precision - kind.scale > 18 else []
        whole = F.expr(f"`{column}` % {unit}").cast("bigint")
        fraction = [(F.expr(f"`{column}` % 1BD") * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("bigint")] if kind.scale else []
        parts = [*high, whole, *fraction]
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        x = value.cast("double")
        endless = x.isin(float("inf"), float("-inf")) | F.isnan(x)
        rank = F.when(F.isnan(x), 2).when(endless & (x > 0), 1).when(endless, -1).otherwise(0).cast("bigint")
        real = F.when(endless, 0.0).otherwise(x)
        return [
            _Word(f"{prefix}0", rank if ascending else F.bitwise_not(rank)),
            _Word(f"{prefix}1", real if ascending else -real, True),
        ]
    elif isinstance(kind, T.DateType):
        parts = [F.unix_date(value).cast("bigint")]
    elif isinstance(kind, T.TimestampType):
        parts = [F.unix_micros(value)]
    else:
        parts = [value.cast("bigint")]
    return [_Word(f"{prefix}{k}", part if ascending else F.bitwise_not(part)) for k, part in enumerate(parts)]


def _cell(word: _Word, low, high) -> Column:
    """Number of the value's cell between `low` and `high`: never falls along the order and parts the two ends."""
    value = F.col(word.name)
    if not word.real:
        shift = 0
        while (high >> shift) - (low >> shift) >= _CELLS:
            shift += 1
        return F.shiftright(value, shift) - F.lit(low >> shift)
    if math.isinf(high - low):
        return F.floor((value / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2) * (_CELLS - 1))
    return F.floor((value - F.lit(low)) / F.lit(high - low) * (_CELLS - 1))


@dataclass
class _Search:
    """The search for the row of one rank in one ordering: numbers found so far, the range the next lies in, the rank among those rows."""

    out: str
    rank: int
    found: tuple = ()
    low: object = None
    high: object = None

    @property
    def place(self) -> tuple:
        return self.out, self.found, self.low, self.high


def ntile_by_selection(
    df: DataFrame, tiles: int, measures: dict[str, Sequence[tuple[str, bool]]]
) -> DataFrame:
    """Exact NTILE for several orderings at once, with no global sort and no ranking.

    `measures` maps an output column to its ordering, a list of (column, ascending) of non-null columns that ends in a unique one.
    NTILE only depends on the tiles-1 boundary rows. An ordering is read as a row of 64-bit numbers (`_words`), and the numbers of
    all boundary rows are found together: a round counts the rows of every open range in at most 4,096 cells, one map-side combined
    aggregate for all measures, and keeps the cell each boundary lies in with its smallest and largest number. A search ends when its
    boundary is the last row of its cell, so a million rows take three or four rounds and each round divides what is left by
    up to 4,096, whatever the ties. The driver gets counts only. Tagging a row compares numbers. `df` is read once a
    round; pass a written table.
    """
    texts = sorted({c for order in measures.values() for c, _ in order if isinstance(df.schema[c].dataType, T.StringType)})
    sizes = df.agg(F.count(F.lit(1)), *[F.max(F.octet_length(c)) for c in texts]).first()
    total, longest = sizes[0], dict(zip(texts, sizes[1:]))
    if total == 0:
        return df.select("*", *[F.lit(None).cast("int").alias(o) for o in measures])
    words: dict[str, list[_Word]] = {}
    for m, (out, order) in enumerate(measures.items()):
        words[out] = [w for i, (c, up) in enumerate(order) for w in _words(df, c, up, longest.get(c), f"_w{m}_{i}_")]
    coded = df.select(*[w.value.alias(w.name) for ws in words.values() for w in ws])

    # rank of the last row of every tile but the last (the first tiles are one larger)
    small, extra = divmod(total, tiles)
    ends = sorted({e for t in range(1, tiles) if 0 < (e := t * small + min(t, extra)) < total})
    bounds: dict[str, list[tuple]] = {out: [] for out in measures}
    open_searches = [_Search(out, end) for out in measures for end in ends]
    while open_searches:
        open_searches = _narrow(coded, words, open_searches, bounds)

    tagged = df.withColumns({w.name: w.value for ws in words.values() for w in ws})
    for out in measures:
        tile = F.lit(1)
        for bound in bounds[out]:
            tile = tile + F.when(_after(words[out], bound), 1).otherwise(0)
        tagged = tagged.withColumn(out, tile)
    return tagged.drop(*[w.name for ws in words.values() for w in ws])


def _after(words: Sequence[_Word], bound: tuple) -> Column:
    """True for rows behind `bound`, the first numbers of the boundary row (the last one: of its cell's last row)."""
    past = F.lit(False)
    for word, number in reversed(list(zip(words, bound))):
        value, edge = F.col(word.name), F.lit(number)
        past = (value > edge) | ((value == edge) & past)
    return past


def _narrow(coded: DataFrame, words: dict[str, list[_Word]], searches: list[_Search], bounds: dict[str, list[tuple]]) -> list[_Search]:
    """One round: count the cells of every open range, enter closed searches into `bounds` and return the open ones."""
    places = list(dict.fromkeys(s.place for s in searches))
    tags = []
    for n, (out, found, low, high) in enumerate(places):
        word = words[out][len(found)]
        after = words[out][len(found) + 1] if len(found) + 1 < len(words[out]) else word
        value, following = F.col(word.name), F.col(after.name)
        inside = F.lit(True)
        for w, number in zip(words[out], found):
            inside = inside & (F.col(w.name) == F.lit(number))
        if low is not None:
            inside = inside & value.between(F.lit(low), F.lit(high))
        blank = F.lit(None).cast
        row = F.struct(
            F.lit(n).alias("n"), (F.lit(0) if low is None or low == high else _cell(word, low, high)).cast("int").alias("cell"),
            *[c.alias(a) for a, c in zip(("i", "r"), (blank("bigint"), value) if word.real else (value, blank("double")))],
            *[c.alias(a) for a, c in zip(("ni", "nr"), (blank("bigint"), following) if after.real else (following, blank("double")))],
        )
        tags.append(F.when(inside, row))
    rows = coded.select(F.explode(F.array_compact(F.array(*tags))).alias("t"))
    spans = [f(f"t.{c}").alias(f"{c}_{a}") for c in ("i", "r", "ni", "nr") for a, f in (("low", F.min), ("high", F.max))]
    counted: dict[int, list] = {}
    for r in rows.groupBy("t.n", "t.cell").agg(F.count(F.lit(1)).alias("rows"), *spans).collect():  # ranges x 4,096 rows at most
        counted.setdefault(r["n"], []).append(r)

    left = []
    for s in searches:
        before, n = 0, places.index(s.place)
        for r in sorted(counted[n], key=lambda r: r["cell"]):
            if s.rank <= before + r["rows"]:
                break
            before += r["rows"]
        k, ws = len(s.found), words[s.out]
        low, high = (r["r_low"], r["r_high"]) if ws[k].real else (r["i_low"], r["i_high"])
        rank = s.rank - before
        if rank == r["rows"] or (low == high and k + 1 == len(ws)):
            bounds[s.out].append((*s.found, high))
        elif low == high:
            span = (r["nr_low"], r["nr_high"]) if ws[k + 1].real else (r["ni_low"], r["ni_high"])
            left.append(_Search(s.out, rank, (*s.found, low), *span))
        else:
            left.append(_Search(s.out, rank, s.found, low, high))
    return left
