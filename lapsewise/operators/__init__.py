"""Building blocks that Spark has no single operator for."""

from lapsewise.operators.asof import asof_join
from lapsewise.operators.cumulative import running_totals
from lapsewise.operators.horizon import (
    customer_spine,
    distinct_customers,
    last_order_to_date,
    next_order_labels,
    order_date_range,
    order_gaps,
)
from lapsewise.operators.latest import latest_by_rank, latest_per_key
from lapsewise.operators.selection import CutPoint, cut_after, cuts_after, nth_smallest
from lapsewise.operators.trailing import daily_snapshots, item_facts, order_facts

__all__ = [
    "CutPoint",
    "asof_join",
    "customer_spine",
    "cut_after",
    "cuts_after",
    "daily_snapshots",
    "distinct_customers",
    "item_facts",
    "last_order_to_date",
    "latest_by_rank",
    "latest_per_key",
    "next_order_labels",
    "nth_smallest",
    "order_facts",
    "order_date_range",
    "order_gaps",
    "running_totals",
]
