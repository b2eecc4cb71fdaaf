"""Column functions: dates and exact money arithmetic."""

from lapsewise.functions.dates import day_sequence, lookback_start, midnight, order_value
from lapsewise.functions.numeric import from_cents, percentage, ratio, round_half_up, to_cents

__all__ = [
    "day_sequence",
    "from_cents",
    "lookback_start",
    "midnight",
    "order_value",
    "percentage",
    "ratio",
    "round_half_up",
    "to_cents",
]
