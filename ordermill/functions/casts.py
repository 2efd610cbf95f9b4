"""Casts of loaded text. A value that does not fit becomes NULL instead of an error."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_text(value: Column) -> Column:
    return value.cast("string")


def to_whole(value: Column) -> Column:
    """Whole number, halves rounded away from zero."""
    return value.try_cast("decimal(38,0)")


def to_count(value: Column) -> Column:
    return to_whole(value).try_cast("bigint")


def to_money(value: Column) -> Column:
    return value.try_cast("decimal(10,2)")


def to_whole_money(value: Column) -> Column:
    """Whole number kept in a column with two decimals."""
    return to_whole(value).try_cast("decimal(10,2)")


def to_date(value: Column) -> Column:
    return value.try_cast("date")


def tokens_to_null(value: Column, tokens: Iterable[str]) -> Column:
    """NULL where the text is one of the given tokens."""
    return F.when(~value.isin(*tokens), value)


CASTS: dict[str, Callable[[Column], Column]] = {
    "text": to_text,
    "count": to_count,
    "whole": to_whole,
    "money": to_money,
    "whole_money": to_whole_money,
    "date": to_date,
}
