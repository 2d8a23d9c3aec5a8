from tidewater.streaming.run import run_available, start
from tidewater.streaming.times import interval_join, with_event_time
from tidewater.streaming.windows import (
    action_stats,
    daily_totals,
    order_stats,
    payment_stats,
    refund_stats,
    visit_stats,
    window_stats,
)

__all__ = [
    "action_stats", "daily_totals", "interval_join", "order_stats", "payment_stats", "refund_stats", "run_available",
    "start", "visit_stats", "window_stats", "with_event_time",
]
