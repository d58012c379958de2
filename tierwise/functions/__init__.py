"""Column-level helpers: every one returns a built-in Spark expression."""

from tierwise.functions.casts import (  # noqa: F401
    safe_date, safe_money, safe_timestamp, strict_date, strict_money,
)
from tierwise.functions.metrics import (  # noqa: F401
    avg_exact, days_between, pct_ratio, stamp,
)
