"""Pair feeds: UPC, exact-description and transitive matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import parts_to_epoch
from ..operators.filters import keep_values
from ..operators.pairs import canonical_pair, dedupe_pairs
from ..operators.projections import add_keys, rename_cols, tag
from ..rules import DOMAIN_FEEDS, DOMAINS, EXACT, FEED_SOURCES, MATCH_FAMILIES
from ..schema import FEED, LABELLED, PAIR, conform


def _edges(pairs: DataFrame, feed: str, domains: Sequence[str] | None,
           drop_half_null: bool) -> DataFrame:
    """Pairs in canonical order with their date in seconds; nothing else is carried along."""
    if "scores" in pairs.columns:
        pairs = rename_cols(pairs, {"scores": "score"})
    if domains is None and feed in DOMAIN_FEEDS:
        domains = DOMAINS
    if domains is not None:
        pairs = keep_values(pairs, "domain", domains)
    ordered = canonical_pair(conform(pairs, FEED), drop_half_null=drop_half_null)
    return ordered.select("uuid_a", "uuid_b",
                          parts_to_epoch("day", "month", "year").alias("match_timestamp"),
                          "score", F.col("domain").alias("segment"))


def _described(edges: DataFrame, feed: str, prefer: str | Column) -> DataFrame:
    return tag(add_keys(edges, prefer), match_source=FEED_SOURCES[feed], type=EXACT)


def feed_pairs(pairs: DataFrame, feed: str, prefer: str | Column = "upc",
               domains: Sequence[str] | None = None, drop_half_null: bool = False) -> DataFrame:
    """Labelled matches of a feed.

    `domains` limits the rows read; by default the feeds in DOMAIN_FEEDS are limited to DOMAINS.
    A column as preference may differ between rows of one uuid pair, and with it their join keys;
    then, and only then, the rows are de-duplicated on uuid pairs first.
    """
    edges = _edges(pairs, feed, domains, drop_half_null)
    if isinstance(prefer, Column):
        edges = dedupe_pairs(edges, keys=("uuid_a", "uuid_b"))
    described = _described(edges, feed, prefer)
    return conform(tag(described, priority=MATCH_FAMILIES.index(feed)), LABELLED)


def feed_matches(pairs: DataFrame, feed: str, prefer: str | Column = "upc",
                 domains: Sequence[str] | None = None, drop_half_null: bool = False) -> DataFrame:
    """Matches of a feed, one per unordered uuid pair. Keys are built after the shuffle."""
    edges = _edges(pairs, feed, domains, drop_half_null)
    unique = dedupe_pairs(edges, keys=("uuid_a", "uuid_b"))
    return conform(_described(unique, feed, prefer), PAIR)
