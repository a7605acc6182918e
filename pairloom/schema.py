"""Fixed schemas, and the casts that bring a frame to one of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


#: One directed pair of products.
PAIR = StructType(
    _strings("uuid_a", "uuid_b", "sku_uuid_a", "sku_uuid_b", "score",
             "base_source_store", "comp_source_store")
    + [StructField("match_timestamp", LongType())]
    + _strings("match_source", "type", "segment")
)

#: A pair on its way to the warehouse; a lower priority survives de-duplication.
LABELLED = StructType(PAIR.fields + [StructField("priority", IntegerType())])

#: Columns the warehouse table is partitioned by, text with padded month and day.
LOAD_DATE = ("year", "month", "day")

WAREHOUSE = StructType(PAIR.fields + _strings(*LOAD_DATE))

#: Labelled pairs that are kept by load date.
DATED_LABELLED = StructType(LABELLED.fields + _strings(*LOAD_DATE))

#: Raw id and store columns of library and review rows.
ID_COLUMNS = ("base_upc", "base_sku", "comp_upc", "comp_sku",
              "base_source_store", "comp_source_store")

LIBRARY = StructType(
    _strings(*ID_COLUMNS, "company_code", "match_status", "customer_review_state",
             "deleted_date", "match", "active", "model_used", "score")
    + [StructField("match_date", IntegerType())]
)

REVIEW = StructType(
    _strings(*ID_COLUMNS, "score")
    + [StructField("match_date", IntegerType())]
    + _strings("queue_name", "answer", "workflow")
)

FEED = StructType(_strings("uuid_a", "uuid_b", "day", "month", "year", "score", "domain"))

#: The column pairs that change places when a pair is turned around.
SIDES = (("uuid_a", "uuid_b"),
         ("sku_uuid_a", "sku_uuid_b"),
         ("base_source_store", "comp_source_store"))

JOIN_KEYS = ("sku_uuid_a", "sku_uuid_b")


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def conform(df: DataFrame, schema: StructType = PAIR) -> DataFrame:
    """The columns of `schema`, in its order and types; unreadable values become null."""
    have = {f.name: f.dataType for f in df.schema.fields}
    if list(have.items()) == [(f.name, f.dataType) for f in schema.fields]:
        return df
    return df.selectExpr(*[
        quoted(f.name) if have.get(f.name) == f.dataType
        else f"try_cast({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
        for f in schema.fields
    ])


def resolve_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Settle the named columns on one type each; unreadable values become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def union_conformed(frames: Sequence[DataFrame], schema: StructType) -> DataFrame:
    """All rows of all frames, each brought to the schema first so that no type widens."""
    return reduce(DataFrame.unionByName, [conform(f, schema) for f in frames])
