"""Business constants of the inventory-risk models.

FIXED VALUES: thresholds, labels and scores below must equal the published
model definitions for results to match. They are kept together, in the order
the rules apply them.
"""

# --- FIXED VALUES: rolling usage window ------------------------------------
# "7d" means the current snapshot and the six before it (rows, not days).
USAGE_WINDOW_ROWS = 7

# --- FIXED VALUES: stock status (days until stockout, inclusive upper edges)
STATUS_CRITICAL = "CRITICAL"
STATUS_LOW = "LOW"
STATUS_MEDIUM = "MEDIUM"
STATUS_HEALTHY = "HEALTHY"
CRITICAL_MAX_DAYS = 7
LOW_MAX_DAYS = 14
MEDIUM_MAX_DAYS = 30
REORDER_MAX_DAYS = 14
STOCK_STATUSES = [STATUS_CRITICAL, STATUS_LOW, STATUS_MEDIUM, STATUS_HEALTHY]
# Simple CASE on the status: CRITICAL 1, LOW 2, MEDIUM 3, anything else 4.
STATUS_SORT_ORDER = {STATUS_CRITICAL: 1, STATUS_LOW: 2, STATUS_MEDIUM: 3}
STATUS_SORT_ORDER_OTHER = 4
AT_RISK_STATUSES = [STATUS_CRITICAL, STATUS_LOW]

# --- FIXED VALUES: stockout horizon buckets (first match wins) -------------
NO_USAGE_BUCKET = "No usage signal"
HORIZON_BUCKETS = [(3, "0-3 days"), (7, "4-7 days"), (14, "8-14 days"), (30, "15-30 days")]
HORIZON_BUCKET_OTHER = "31+ days"
HORIZON_LABELS = ["0-3 days", "4-7 days", "8-14 days", "15-30 days", "31+ days", "No usage signal"]

# --- FIXED VALUES: risk priority score (first match wins) ------------------
SCORE_ZERO_STOCK = 100
SCORE_NO_USAGE = 5
SCORE_BY_DAYS = [(3, 95), (7, 85), (14, 70), (30, 40)]
SCORE_OTHER = 15

# --- FIXED VALUES: risk priority band (score lower bounds) -----------------
PRIORITY_BANDS = [(90, "P1 - Immediate"), (70, "P2 - Urgent"), (40, "P3 - Watch")]
PRIORITY_BAND_OTHER = "P4 - Healthy"
PRIORITY_BAND_LABELS = ["P1 - Immediate", "P2 - Urgent", "P3 - Watch", "P4 - Healthy"]

# --- FIXED VALUES: ranking ------------------------------------------------
# Missing days sort after every real horizon in the priority ranks.
RANK_MISSING_DAYS = 999999

# --- FIXED VALUES: text formats --------------------------------------------
# Raw load dates are month/day/year without zero padding, e.g. 1/5/2025.
LOAD_DATE_FORMAT = "M/d/yyyy"
REPORT_KEY_SEPARATOR = "|"
# Full English month name, e.g. January.
MONTH_NAME_FORMAT = "MMMM"

# --- Key performance indicators ---------------------------------------------
DEFAULT_TOP_N = 10
