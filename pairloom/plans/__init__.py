"""Whole flows: library, reviews, pair feeds, and the warehouse made of them."""

from .feeds import feed_matches, feed_pairs
from .job import load_warehouse, split_bare
from .library import library_matches, library_pairs, library_rejects
from .reviews import review_matches, review_pairs, review_rejects, union_sources
from .warehouse import (
    bare_pairs,
    build_warehouse,
    labelled_pairs,
    warehouse_from_labelled,
    warehouse_from_sources,
)

__all__ = [
    "bare_pairs", "build_warehouse", "feed_matches", "feed_pairs", "labelled_pairs",
    "library_matches", "library_pairs", "library_rejects", "load_warehouse", "review_matches",
    "review_pairs", "review_rejects", "split_bare", "union_sources",
    "warehouse_from_labelled", "warehouse_from_sources",
]
