"""Scalar Column functions (all JVM-side, no Python UDFs)."""

from driftlog.functions.geohash import GEOHASH_ALPHABET, geohash, geohash5, with_geohash
from driftlog.functions.text import (
    date_part,
    empty_to_null,
    hour_folder,
    json_text_field,
    null_or_empty,
    split_drop_trailing,
)

__all__ = [
    "GEOHASH_ALPHABET", "geohash", "geohash5", "with_geohash", "date_part", "empty_to_null", "hour_folder",
    "json_text_field", "null_or_empty", "split_drop_trailing",
]
