"""Column functions."""

from .ids import (
    canonical,
    is_placeholder,
    join_key,
    lacks_ids,
    parts_to_epoch,
    product_uuid,
    replace_all,
    store_from_uuid,
    store_key,
    to_epoch_int,
    turned,
    uuid_parts,
)

__all__ = [
    "canonical",
    "is_placeholder",
    "join_key",
    "lacks_ids",
    "parts_to_epoch",
    "product_uuid",
    "replace_all",
    "store_from_uuid",
    "store_key",
    "to_epoch_int",
    "turned",
    "uuid_parts",
]
