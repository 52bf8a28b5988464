"""String cleaning, slugs, word counts and token sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import as_column

# Texts that stand for a missing key in uploaded files.
NULL_TOKENS = ("", "none", "nan", "null")


def blank_to_null(value) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(as_column(value)), F.lit(""))


def trimmed_or(value, default: str) -> Column:
    return F.coalesce(blank_to_null(value), F.lit(default))


def has_key(value) -> Column:
    """True for a usable key: present, not blank and not a textual null token."""
    col = as_column(value).cast("string")
    return col.isNotNull() & ~F.lower(F.trim(col)).isin(*NULL_TOKENS)


def has_text(value) -> Column:
    col = as_column(value)
    return col.isNotNull() & (F.trim(col) != "")


def slug(value) -> Column:
    return F.lower(F.replace(as_column(value), F.lit(" "), F.lit("-")))


def word_count(value) -> Column:
    """Number of pieces between single spaces of the trimmed text."""
    return F.size(F.split(F.trim(as_column(value)), " ", -1))


def prefix(value, length: int) -> Column:
    return F.substring(as_column(value), 1, length)


def full_name(first, last) -> Column:
    return F.concat(as_column(first), F.lit(" "), as_column(last))


def token_set(value) -> Column:
    """Distinct lower-cased tokens split on white space."""
    return F.array_remove(F.array_distinct(F.split(F.lower(as_column(value)), r"\s+")), "")


def matches(tokens: Column, words: Sequence[str]) -> Column:
    """How many of the given words occur in a token set."""
    return F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in words])))


def null_tokens_to_null(value, tokens: Sequence[str]) -> Column:
    col = as_column(value)
    return F.when(~col.isin(*tokens), col)


def prefixed_id(tag: str, *parts) -> Column:
    """Id that is a function of the natural key, so a replay gives the same id; the whole digest, so that keys don't meet."""
    joined = F.concat_ws("\u0001", *[as_column(p).cast("string") for p in parts])
    return F.concat(F.lit(tag + "-"), F.upper(F.sha2(joined, 256)))


def random_id(tag: str | None = None) -> Column:
    uuid = F.expr("uuid()")
    if tag is None:
        return uuid
    return F.concat(F.lit(tag + "-"), F.upper(uuid))
