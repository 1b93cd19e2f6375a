"""Incremental (streaming) form of the month-by-month batch processing."""

from aerolake.streaming.monthly_batches import incremental_aggregate, refresh_months, run_incremental, run_monthly

__all__ = ["incremental_aggregate", "refresh_months", "run_incremental", "run_monthly"]
