"""Scalar column helpers for dirty text. All of them are built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import presets


def force_null(col: str | Column, words: Iterable[str] = presets.NULL_WORDS) -> Column:
    """Trimmed text; NULL where the trimmed, lower-cased text is one of ``words``."""
    text = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.when(~F.lower(text).isin(*words), text)


def null_tokens(df: DataFrame, tokens: Iterable[str] = presets.NULL_TOKENS) -> DataFrame:
    """Exact-match null-token replacement on every string column."""
    return map_string_columns(df, lambda text: F.when(~text.isin(*tokens), text))


def map_string_columns(df: DataFrame, fn) -> DataFrame:
    """Apply ``fn`` to each string column and leave the others alone."""
    return df.select(
        *[fn(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes]
    )


def first_of(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-null value among the aliases that ``df`` really has."""
    present = [F.col(f"`{n}`") for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def recode(df: DataFrame, col: str, mapping: Mapping[str, str]) -> DataFrame:
    return df.replace(dict(mapping), subset=[col])


def token_bool(col: str, true: str, false: str) -> Column:
    """TRUE / FALSE for the two tokens, NULL for anything else."""
    return F.when(F.col(col) == true, True).when(F.col(col) == false, False)


def to_int(text: str | Column) -> Column:
    """Integer in a text, NULL if there is none.

    A failed cast raises and catches an exception per row. Words are the usual misfits, and
    no integer starts with a letter, so they are turned away before the cast sees them.
    """
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.trim(text).between("\x01", "@"), text.try_cast("int"))


def leading_int(col: str, sep: str = ":") -> Column:
    """Integer before ``sep``. A NULL input counts as 0, unreadable text stays NULL."""
    return to_int(F.substring_index(F.coalesce(F.col(col), F.lit("0")), sep, 1))


def number_in(col: str, pattern: str, dtype: str) -> Column:
    """First match of ``pattern`` inside text with units, as a number or NULL."""
    found = F.regexp_extract(F.col(col), pattern, 1)
    return F.when(found != "", found.try_cast(dtype))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def proper(col: str | Column) -> Column:
    return F.initcap(F.trim(F.col(col) if isinstance(col, str) else col))


def to_ts(col: Column, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)
