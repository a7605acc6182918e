"""Product ids, join keys, stores and dates as column expressions.

A product uuid is the text `upc<>sku<>source<>store`. `F.get` is used throughout for list
access: a missing part is null, where an index past the end would raise.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from ..rules import PLACEHOLDERS

SEPARATOR = "<>"
_PARTS = 4
_SECONDS_PER_DAY = 86400


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _joined(*parts: Column) -> Column:
    """Parts with separators between them; null if any part is."""
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(SEPARATOR), part]
    return F.concat(*pieces)


def uuid_parts(uuid: Column | str) -> Column:
    """The first four parts; those that are missing are null.

    They are cut out by position: `F.split` would compile its pattern anew for every row. The array
    goes through a slice of all of it, so that it is made once to a row. The optimizer puts the elements
    of a plain array in the place of each use, where they would be cut again.
    """
    return F.slice(F.array(*_cut(uuid, _PARTS)), 1, _PARTS)


def _cut(uuid: Column | str, count: int) -> list[Column]:
    """The first `count` parts; those that are missing are null."""
    uuid = _column(uuid)
    heads = [F.substring_index(uuid, SEPARATOR, n) for n in range(1, count + 1)]
    ends = [F.octet_length(head) for head in heads]
    return [heads[0], *[
        F.when(ends[i] > ends[i - 1], F.substring_index(heads[i], SEPARATOR, -1))
        for i in range(1, count)]]


def product_uuid(upc: Column | str, sku: Column | str, source_store: Column | str) -> Column:
    """`upc<>sku<>source<>store`, source and store being the last two `_` parts.

    Null if the store has no two parts.
    """
    store = _column(source_store)
    tail = F.replace(F.substring_index(store, "_", -2), F.lit("_"), F.lit(SEPARATOR))
    return _joined(_column(upc).cast("string"), _column(sku).cast("string"),
                   F.when(store.contains("_"), tail))


def is_placeholder(value: Column | str) -> Column:
    """Whether an id is one of the texts that stand for "no id"."""
    return _column(value).isin(*PLACEHOLDERS)


def _cleaned(upc: Column, sku: Column) -> tuple[Column, Column]:
    """UPC without leading zeros, and SKU, both lower-cased."""
    return F.lower(F.ltrim(upc, F.lit("0"))), F.lower(sku)


def _key_ids(parts: Column) -> tuple[Column, Column]:
    return _cleaned(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))


def key_from_parts(parts: Column, prefer: str | Column = "upc") -> Column:
    upc, sku = _key_ids(parts)
    if isinstance(prefer, Column):
        favourite = F.when(prefer, sku).otherwise(upc)
    else:
        favourite = {"upc": upc, "sku": sku}[prefer]
    chosen = (F.when(is_placeholder(sku), upc)
              .when(is_placeholder(upc), sku)
              .otherwise(favourite))
    return _joined(chosen, *(F.lower(F.get(parts, F.lit(i))) for i in (2, 3)))


def store_from_parts(parts: Column) -> Column:
    return _joined(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)))


def join_key(uuid: Column | str, prefer: str | Column = "upc") -> Column:
    """Lower-case `id<>source<>store`.

    The id is the UPC when the SKU is a placeholder (even if both are), else the SKU when the
    UPC is one, else the one preferred: "upc", "sku", or a boolean column that is true where
    the SKU goes first. Leading zeros are dropped from the UPC only.
    """
    return key_from_parts(uuid_parts(uuid), prefer)


def lacks_ids(uuid: Column | str) -> Column:
    """Whether both ids are placeholders, so that the join key names a store, not a product.

    Only the two ids are cut out, and the SKU only where the UPC is a placeholder. A filter on this is
    moved to the sources, where each use of the uuid builds it anew; with all parts that would outgrow
    a method of the virtual machine.
    """
    upc, sku = _cleaned(*_cut(uuid, 2))
    return is_placeholder(upc) & is_placeholder(sku)


def store_key(uuid: Column | str) -> Column:
    """`source<>store` of a uuid, case kept."""
    return store_from_parts(uuid_parts(uuid))


def store_from_uuid(uuid: Column | str) -> Column:
    """Last `_` part, doubled: `x_x`."""
    tail = F.substring_index(_column(uuid), "_", -1)
    return F.concat(tail, F.lit("_"), tail)


def parts_to_epoch(day: Column | str, month: Column | str, year: Column | str) -> Column:
    """Seconds from 1970 to midnight UTC of a date in text parts, null if it is no date.

    Days are counted instead of asking for the timestamp's seconds, which would depend on the
    session time zone.
    """
    text = F.concat_ws("-", _column(day), _column(month), _column(year))
    date = F.try_to_timestamp(text, F.lit("d-M-yyyy")).cast("date")
    return F.unix_date(date).cast("bigint") * _SECONDS_PER_DAY


def to_epoch_int(value: Column | str) -> Column:
    return _column(value).try_cast("int")


def canonical(a: Column | str, b: Column | str) -> tuple[Column, Column]:
    """The two values in order. A null counts as absent: both results are the other value."""
    return F.least(a, b), F.greatest(a, b)


def turned(a: Column | str, b: Column | str) -> Column:
    """Whether (a, b) must change places to be in order, nulls first. Never null."""
    a, b = _column(a), _column(b)
    return F.coalesce(a > b, a.isNotNull() & b.isNull())


def replace_all(value: Column | str, replacements: Mapping[str, str]) -> Column:
    """Every occurrence of each literal text replaced, in the mapping's order."""
    out = _column(value)
    for old, new in replacements.items():
        out = F.replace(out, F.lit(old), F.lit(new))
    return out
