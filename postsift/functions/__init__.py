"""Column -> Column functions."""

from postsift.functions.distance import edit_distance, edit_distance_within
from postsift.functions.filler import looks_like_filler
from postsift.functions.registration import registration_age_days
from postsift.functions.routing import best_mx, mail_status, match_provider, mx_host
from postsift.functions.text import (
    has_valid_syntax,
    iso_instant,
    list_values,
    normalize_email,
    split_email,
    trim_edges,
)

__all__ = [
    "best_mx",
    "edit_distance",
    "edit_distance_within",
    "has_valid_syntax",
    "iso_instant",
    "list_values",
    "looks_like_filler",
    "mail_status",
    "match_provider",
    "mx_host",
    "normalize_email",
    "registration_age_days",
    "split_email",
    "trim_edges",
]
