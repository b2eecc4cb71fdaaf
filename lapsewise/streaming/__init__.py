"""Incremental sync of the serving table."""

from lapsewise.streaming.sync import incremental_sync

__all__ = ["incremental_sync"]
