"""Source views, and reading and writing of tables."""

from lapsewise.sources.tables import (
    build_report,
    path_exists,
    read_split,
    read_table,
    replace_bucketed_table,
    replace_table,
    replace_view,
    scratch_path,
    stage,
    unstage,
    write_splits,
    write_sidecar,
)
from lapsewise.sources.versions import CommitConflict, VersionedTable, open_table
from lapsewise.sources.views import (
    completed_order_items,
    completed_orders,
    customers,
    date_spine,
    label_date_spine,
    sample_customers,
)

__all__ = [
    "CommitConflict",
    "VersionedTable",
    "build_report",
    "completed_order_items",
    "completed_orders",
    "customers",
    "date_spine",
    "label_date_spine",
    "open_table",
    "path_exists",
    "read_split",
    "read_table",
    "replace_bucketed_table",
    "replace_table",
    "replace_view",
    "sample_customers",
    "scratch_path",
    "stage",
    "unstage",
    "write_sidecar",
    "write_splits",
]
