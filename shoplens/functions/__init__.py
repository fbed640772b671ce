"""Column-expression helpers: everything here returns a ``Column``."""

from shoplens.functions.dates import as_utc_ts, floor_days, shift_days
from shoplens.functions.scalar import (
    age_group,
    clip_upper,
    flag,
    map_encode,
    ordinal_encode,
    safe_ratio,
    exact_avg,
    exact_sum,
)

__all__ = [
    "age_group",
    "as_utc_ts",
    "clip_upper",
    "exact_avg",
    "exact_sum",
    "flag",
    "floor_days",
    "map_encode",
    "ordinal_encode",
    "safe_ratio",
    "shift_days",
]
