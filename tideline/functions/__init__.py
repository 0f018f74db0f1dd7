"""Column expressions; everything here stays inside Catalyst."""

from tideline.functions.keys import surrogate_key, version_key
from tideline.functions.labels import is_sentinel, label_or_unknown, unknown_label
from tideline.functions.periods import month_anchor, months_back, period_of
from tideline.functions.times import duration_minutes, instant, local_parts, local_to_instant

__all__ = [
    "duration_minutes",
    "instant",
    "is_sentinel",
    "label_or_unknown",
    "local_parts",
    "local_to_instant",
    "month_anchor",
    "months_back",
    "period_of",
    "surrogate_key",
    "unknown_label",
    "version_key",
]
