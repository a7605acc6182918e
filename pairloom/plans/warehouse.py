"""The match warehouse: all families combined, settled, dated and mirrored."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import lacks_ids
from ..operators.pairs import combine, mirror_pairs, rewrite_alias, settle_pairs
from ..operators.projections import stamp_load_date
from ..rules import ALIASES, DROPPED_WORKFLOWS, REJECT
from ..schema import WAREHOUSE, conform
from .feeds import feed_pairs
from .library import library_pairs
from .reviews import review_pairs

_SEPARATOR = "<>"


def _finish(labelled: DataFrame, day: datetime.date | str, prune: bool, undirected: bool,
            aliases: Mapping[str, str], alias_rejects: bool,
            derive_stores: bool = False) -> DataFrame:
    """Aliases are rewritten ahead of the aggregation, so one pass replaces a first one on the
    old keys and a second on the new."""
    where = None if alias_rejects else F.col("type") != REJECT
    settled = settle_pairs(rewrite_alias(labelled, aliases=aliases, where=where),
                           prune=prune, undirected=undirected, derive_stores=derive_stores)
    # Stamped last, the date stays a constant of the plan: a write by date sorts nothing.
    return conform(stamp_load_date(mirror_pairs(settled), day), WAREHOUSE)


def build_warehouse(matches: DataFrame, rejects: DataFrame, day: datetime.date | str, *,
                    prune: bool = False, undirected: bool = False,
                    aliases: Mapping[str, str] = ALIASES,
                    alias_rejects: bool = False) -> DataFrame:
    """Warehouse rows from labelled matches and rejects (see `combine_matches`).

    Rejected pairs stay in the result next to the matches; `prune` takes away matches that are
    also rejected, in either direction. To have pruning see through store aliases, set
    `alias_rejects`. `undirected` keeps one row per unordered pair before mirroring.
    """
    return _finish(combine([matches, rejects]), day, prune, undirected, aliases, alias_rejects)


def is_bare() -> Column:
    """Whether a product of the pair has no id, so that its key names only a store."""
    return F.coalesce(lacks_ids("uuid_a") | lacks_ids("uuid_b"), F.lit(False))


def labelled_pairs(library: DataFrame, reviews: Sequence[DataFrame],
                   feeds: Mapping[str, DataFrame],
                   *, prefer: str | Column = "upc", strict: bool = False,
                   domains: Sequence[str] | None = None, drop_half_null: bool = False,
                   dropped_workflows: Sequence[str] = DROPPED_WORKFLOWS) -> DataFrame:
    """All labelled pairs of the sources, matches and rejects, one scan of each source."""
    parts = [library_pairs(library, prefer, strict),
             review_pairs(reviews, prefer, dropped_workflows)]
    parts += [feed_pairs(pairs, feed, prefer, domains, drop_half_null)
              for feed, pairs in feeds.items()]
    return combine(parts)


def warehouse_from_sources(library: DataFrame, reviews: Sequence[DataFrame],
                           feeds: Mapping[str, DataFrame], day: datetime.date | str, *,
                           prefer: str | Column = "upc", strict: bool = False,
                           domains: Sequence[str] | None = None, drop_half_null: bool = False,
                           dropped_workflows: Sequence[str] = DROPPED_WORKFLOWS,
                           drop_bare: bool = False,
                           prune: bool = False, undirected: bool = False,
                           aliases: Mapping[str, str] = ALIASES,
                           alias_rejects: bool = False) -> DataFrame:
    """Warehouse rows from the raw sources: one scan of each, and a single shuffle.

    The families are not de-duplicated one by one first. Their survivors are least rows under
    the same order as the final ones, so the final aggregation alone gives the same rows. Only a
    column as `prefer` needs the feeds' own step (see `feed_pairs`).

    `domains` and `drop_half_null` are those of `feed_pairs`, `dropped_workflows` that of
    `review_pairs`. `drop_bare` leaves out pairs with a product that has no id: they share a few
    keys that name a store; `bare_pairs` shows them.
    """
    labelled = labelled_pairs(library, reviews, feeds, prefer=prefer, strict=strict,
                              domains=domains, drop_half_null=drop_half_null,
                              dropped_workflows=dropped_workflows)
    if drop_bare:
        labelled = labelled.where(~is_bare())
    return warehouse_from_labelled(labelled, day, prune=prune, undirected=undirected,
                                   aliases=aliases, alias_rejects=alias_rejects)


def warehouse_from_labelled(labelled: DataFrame, day: datetime.date | str, *,
                            prune: bool = False, undirected: bool = False,
                            aliases: Mapping[str, str] = ALIASES,
                            alias_rejects: bool = False) -> DataFrame:
    """Warehouse rows from `labelled_pairs`, or those of them that are wanted."""
    # The stores here are parts of the uuids, also after aliases that lie within such a part.
    whole = any(_SEPARATOR in text for pair in aliases.items() for text in pair)
    return _finish(labelled, day, prune, undirected, aliases, alias_rejects,
                   derive_stores=not whole)


def bare_pairs(library: DataFrame, reviews: Sequence[DataFrame], feeds: Mapping[str, DataFrame],
               *, prefer: str | Column = "upc", strict: bool = False,
               domains: Sequence[str] | None = None, drop_half_null: bool = False,
               dropped_workflows: Sequence[str] = DROPPED_WORKFLOWS) -> DataFrame:
    """The labelled pairs that `drop_bare` leaves out, for quarantine."""
    return labelled_pairs(library, reviews, feeds, prefer=prefer, strict=strict, domains=domains,
                          drop_half_null=drop_half_null,
                          dropped_workflows=dropped_workflows).where(is_bare())
