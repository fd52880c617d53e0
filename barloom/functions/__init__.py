"""Column functions. All of them are built-in Spark expressions."""

from barloom.functions.exact import ExactSum
from barloom.functions.time import (
    calendar_bucket,
    epoch_date,
    epoch_text,
    epoch_timestamp,
    local_date,
    month_of,
    run_key,
    trailing_interval,
)

__all__ = [
    "ExactSum",
    "calendar_bucket",
    "epoch_date",
    "epoch_text",
    "epoch_timestamp",
    "local_date",
    "month_of",
    "run_key",
    "trailing_interval",
]
