"""Operators that add, drop, rename or fill columns. None of them shuffles."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import product_uuid, uuid_parts
from ..functions.ids import key_from_parts, store_from_parts
from ..schema import ID_COLUMNS, LOAD_DATE


def drop_cols(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def rename_cols(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def tag(df: DataFrame, **constants: Any) -> DataFrame:
    """Set columns to constants, e.g. `tag(df, type="exact_match")`."""
    return df.withColumns({c: F.lit(v) for c, v in constants.items()})


def fill_blank(df: DataFrame, columns: Iterable[str] = ID_COLUMNS) -> DataFrame:
    return df.fillna("", subset=list(columns))


def lower_cols(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.lower(c) for c in names})


def load_date_parts(day: datetime.date | str) -> dict[str, str]:
    """Year, month and day as zero-padded text, by column."""
    if isinstance(day, str):
        day = datetime.date.fromisoformat(day)
    return dict(zip(LOAD_DATE, (str(day.year), f"{day:%m}", f"{day:%d}")))


def stamp_load_date(df: DataFrame, day: datetime.date | str) -> DataFrame:
    """Add the day's parts as columns. The day is given, so a rerun repeats."""
    return tag(df, **load_date_parts(day))


def add_uuids(df: DataFrame) -> DataFrame:
    """uuid_a of the base product and uuid_b of the compared one."""
    return df.withColumns({
        uuid: product_uuid(f"{side}_upc", f"{side}_sku", f"{side}_source_store")
        for uuid, side in (("uuid_a", "base"), ("uuid_b", "comp"))
    })


def _from_parts(df: DataFrame, build) -> DataFrame:
    """Columns built from the uuids' parts, each uuid being split once in a step of its own."""
    parts = {"_parts_a": uuid_parts("uuid_a"), "_parts_b": uuid_parts("uuid_b")}
    return (df.withColumns(parts)
            .withColumns(build(F.col("_parts_a"), F.col("_parts_b")))
            .drop(*parts))


def _keys(a: Column, b: Column, prefer: str | Column) -> dict[str, Column]:
    return {"sku_uuid_a": key_from_parts(a, prefer), "sku_uuid_b": key_from_parts(b, prefer)}


def _stores(a: Column, b: Column) -> dict[str, Column]:
    return {"base_source_store": store_from_parts(a), "comp_source_store": store_from_parts(b)}


def add_join_keys(df: DataFrame, prefer: str | Column = "upc") -> DataFrame:
    """Join keys of both uuids; `prefer` as in `functions.join_key`."""
    return _from_parts(df, lambda a, b: _keys(a, b, prefer))


def add_stores(df: DataFrame) -> DataFrame:
    """`source<>store` of both uuids, in place of any raw store columns."""
    return _from_parts(df, _stores)


def add_keys(df: DataFrame, prefer: str | Column = "upc") -> DataFrame:
    """Join keys and stores together."""
    return _from_parts(df, lambda a, b: {**_keys(a, b, prefer), **_stores(a, b)})
