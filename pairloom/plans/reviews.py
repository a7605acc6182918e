"""Human review answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import to_epoch_int
from ..operators.filters import exclude_values
from ..operators.pairs import dedupe_pairs
from ..operators.projections import add_keys, add_uuids, fill_blank, tag
from ..operators.routing import route_reviews
from ..rules import (
    ALIASES,
    DROPPED_WORKFLOWS,
    MATCH_FAMILIES,
    REJECT,
    REJECT_FAMILIES,
    REVIEW_SOURCE,
)
from ..schema import LABELLED, PAIR, REVIEW, conform, union_conformed


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Review sources brought to one column list."""
    return union_conformed(sources, REVIEW)


def review_pairs(sources: Sequence[DataFrame], prefer: str | Column = "upc",
                 dropped_workflows: Sequence[str] = DROPPED_WORKFLOWS) -> DataFrame:
    """Matches and rejects together, labelled, not yet de-duplicated."""
    reviews = exclude_values(fill_blank(union_sources(sources)), "workflow", dropped_workflows)
    keyed = add_keys(add_uuids(route_reviews(reviews)), prefer)
    stamped = tag(keyed, match_source=REVIEW_SOURCE).withColumns({
        "match_timestamp": to_epoch_int("match_date"),
        "priority": F.when(F.col("type") == REJECT, REJECT_FAMILIES.index("reviews"))
                     .otherwise(MATCH_FAMILIES.index("reviews")),
    })
    return conform(stamped, LABELLED)


def review_matches(sources: Sequence[DataFrame], prefer: str | Column = "upc",
                   dropped_workflows: Sequence[str] = DROPPED_WORKFLOWS,
                   aliases: Mapping[str, str] | None = ALIASES) -> DataFrame:
    """Matches, one per join-key pair; ties are broken as if the aliases were rewritten."""
    pairs = review_pairs(sources, prefer, dropped_workflows).where(F.col("type") != REJECT)
    return dedupe_pairs(conform(pairs, PAIR), aliases=aliases)


def review_rejects(sources: Sequence[DataFrame], prefer: str | Column = "upc",
                   dropped_workflows: Sequence[str] = DROPPED_WORKFLOWS,
                   aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Rejects, one per join-key pair. `aliases`: those that rejects will be rewritten by."""
    pairs = review_pairs(sources, prefer, dropped_workflows).where(F.col("type") == REJECT)
    return dedupe_pairs(conform(pairs, PAIR), aliases=aliases)
