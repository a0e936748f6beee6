"""Column-level functions: keyed draws and feature expressions."""

from .features import (
    clip_hour,
    day_code,
    hour_cos,
    hour_intensity,
    hour_sin,
    in_domain,
    is_number,
    keyed_day,
    literal_map,
    normalize_day,
    ordinal_code,
    pair_label,
    time_band,
    time_code,
)
from .hashing import keyed_bits, keyed_choice, keyed_int, keyed_range, keyed_uniform

__all__ = [
    "clip_hour",
    "day_code",
    "hour_cos",
    "hour_intensity",
    "hour_sin",
    "in_domain",
    "is_number",
    "keyed_bits",
    "keyed_choice",
    "keyed_day",
    "keyed_int",
    "keyed_range",
    "keyed_uniform",
    "literal_map",
    "normalize_day",
    "ordinal_code",
    "pair_label",
    "time_band",
    "time_code",
]
