"""Row filters. A row for which a test is null is dropped, as `where` does."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..rules import LIVE_STATUS, contains_any


def exclude_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def keep_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def keep_containing(df: DataFrame, column: str, *words: str) -> DataFrame:
    return df.where(contains_any(F.col(column), words))


def is_live() -> Column:
    deleted = F.col("deleted_date")
    return (F.col("match_status") == LIVE_STATUS) & (deleted.isNull() | (deleted == ""))


def _present(column: str, strict: bool) -> Column:
    """Not null *or* not blank, so a blank passes; strict asks for both."""
    value = F.col(column)
    return value.isNotNull() & (value != "") if strict else value.isNotNull() | (value != "")


def is_deleted(strict: bool = False) -> Column:
    return _present("deleted_date", strict)


def has_text(column: str = "comp_sku", strict: bool = False) -> Column:
    return _present(column, strict)


def live_rows(df: DataFrame) -> DataFrame:
    return df.where(is_live())


def deleted_rows(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rows with a deletion date; a blank one counts too unless strict."""
    return df.where(is_deleted(strict))


def non_blank(df: DataFrame, column: str = "comp_sku", strict: bool = False) -> DataFrame:
    return df.where(has_text(column, strict))
