"""The curated match library: live rows become matches, deleted rows rejected pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.filters import has_text, is_deleted, is_live
from ..operators.projections import add_keys, add_uuids, fill_blank
from ..operators.routing import route
from ..rules import (
    DROPPED_COMPANY,
    GROCERY,
    MATCH_FAMILIES,
    OFFICE,
    PETS,
    REJECT,
    REJECT_FAMILIES,
    Rule,
    Track,
    grocery_tracks,
    office_tracks,
    pets_tracks,
    reject_source_tracks,
    segment_tracks,
)
from ..schema import LABELLED, LIBRARY, PAIR, conform


def _only(track: Track, condition: Column, **labels) -> Track:
    return [rule.only(condition).with_labels(**labels) for rule in track]


def _match_tracks(strict: bool) -> list[Track]:
    """The segments have different companies, so rules of all three may share a track."""
    live, with_sku = is_live(), has_text("comp_sku", strict)
    pets = [_only(t, live, priority=MATCH_FAMILIES.index(PETS)) for t in pets_tracks()]
    grocery = [_only(t, live & with_sku, priority=MATCH_FAMILIES.index(GROCERY))
               for t in grocery_tracks()]
    first_office, *other_office = [
        _only(t, live & with_sku, priority=MATCH_FAMILIES.index(OFFICE)) for t in office_tracks()]
    return [sum(pets + grocery, []) + first_office, *other_office]


def _reject_tracks(strict: bool) -> list[Track]:
    deleted = is_deleted(strict)
    (by_company,) = segment_tracks()
    return [[Rule(deleted & source.when & company.when,
                  {**company.labels, **source.labels, "type": REJECT,
                   "priority": REJECT_FAMILIES.index("library")})
             for source in track for company in by_company]
            for track in reject_source_tracks()]


def _labelled(library: DataFrame, tracks: list[Track], prefer: str | Column) -> DataFrame:
    rows = conform(library, LIBRARY).where(F.col("company_code") != DROPPED_COMPANY)
    routed = route(fill_blank(rows), tracks)
    keyed = add_keys(add_uuids(routed), prefer)
    return conform(keyed.withColumnRenamed("match_date", "match_timestamp"), LABELLED)


def library_pairs(library: DataFrame, prefer: str | Column = "upc",
                  strict: bool = False) -> DataFrame:
    """Matches and rejects together, labelled, in one pass over the library.

    A row with a blank deletion date may be both; strict takes it for live only, and asks
    grocery and office matches for a SKU on the compared side.
    """
    return _labelled(library, _match_tracks(strict) + _reject_tracks(strict), prefer)


def library_matches(library: DataFrame, prefer: str | Column = "upc",
                    strict: bool = False) -> DataFrame:
    return conform(_labelled(library, _match_tracks(strict), prefer), PAIR)


def library_rejects(library: DataFrame, prefer: str | Column = "upc",
                    strict: bool = False) -> DataFrame:
    return conform(_labelled(library, _reject_tracks(strict), prefer), PAIR)
