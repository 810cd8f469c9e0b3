"""Names and constants shared by the library.

Everything here is plain data; no Spark session is touched at import time.
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# Fixed values (must stay as they are for results to match the reference job)
# ---------------------------------------------------------------------------
# Order statuses, in their natural order.
STATUS_PLACED = "placed"
STATUS_COMPLETED = "completed"
STATUS_CANCELLED = "cancelled"
STATUSES = ("placed", "completed", "cancelled")
# "No mark yet" is the Unix epoch.
EPOCH = _dt.datetime(1970, 1, 1)
# Default progress key of a job.
DEFAULT_PIPELINE_ID = "daily_metrics_etl"
# Metric date text format and its contract pattern.
DATE_TEXT_FORMAT = "yyyy-MM-dd"
DATE_TEXT_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
# Length of a country code.
COUNTRY_CODE_LENGTH = 2
# Synthetic order generator: countries, restaurants, status weights in
# percent (placed, completed, cancelled), amount range, day span, start,
# and the share (percent) of non-placed orders changed later.
SYNTH_COUNTRIES = ("IN", "US", "UK", "AE", "SG", "AU")
SYNTH_RESTAURANTS = 500
SYNTH_STATUS_WEIGHTS = (20, 70, 10)
SYNTH_DAYS = 91  # offsets 0..90 inclusive
SYNTH_START = _dt.datetime(2024, 1, 1)
SYNTH_LATE_PERCENT = 15
# ---------------------------------------------------------------------------

# Group key of a daily metric: restaurant, calendar day of creation, country.
KEY_COLS = ("restaurant_id", "date", "country")

ORDER_COLS = (
    "order_id",
    "restaurant_id",
    "user_id",
    "status",
    "amount",
    "country",
    "created_at",
    "updated_at",
)

METRIC_VALUE_COLS = (
    "total_orders",
    "completed_orders",
    "cancelled_orders",
    "gross_revenue",
)

# Revenue precision: that of a sum of DECIMAL(12,2), so nothing is cut.
REVENUE_TYPE = "decimal(22,2)"

# Upper bound on the number of group keys shipped to every task with a
# broadcast. Above it the recompute aggregates first and joins by shuffle.
DEFAULT_BROADCAST_KEY_LIMIT = 1_000_000
