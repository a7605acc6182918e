"""DataFrame operators."""

from .filters import (
    deleted_rows,
    exclude_values,
    keep_containing,
    keep_values,
    live_rows,
    non_blank,
)
from .pairs import (
    canonical_pair,
    combine,
    combine_matches,
    combine_rejects,
    dedupe_pairs,
    earliest_per_pair,
    mirror_pairs,
    orient_pairs,
    prune_rejected,
    rewrite_alias,
    settle_pairs,
)
from .projections import (
    add_join_keys,
    add_keys,
    add_stores,
    add_uuids,
    drop_cols,
    fill_blank,
    lower_cols,
    rename_cols,
    stamp_load_date,
    tag,
)
from .routing import (
    route,
    route_grocery,
    route_office,
    route_pets,
    route_reject_source,
    route_reviews,
    route_segment,
)

__all__ = [
    "add_join_keys", "add_keys", "add_stores", "add_uuids", "canonical_pair", "combine",
    "combine_matches", "combine_rejects", "dedupe_pairs", "deleted_rows", "drop_cols",
    "earliest_per_pair", "exclude_values", "fill_blank", "keep_containing", "keep_values",
    "live_rows", "lower_cols", "mirror_pairs", "non_blank", "orient_pairs", "prune_rejected",
    "rename_cols", "rewrite_alias", "route", "route_grocery", "route_office", "route_pets",
    "route_reject_source", "route_reviews", "route_segment", "settle_pairs",
    "stamp_load_date", "tag",
]
