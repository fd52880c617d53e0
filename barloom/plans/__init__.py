"""Jobs: operators composed from storage to storage."""

from barloom.plans.lake import Lake
from barloom.plans.ledger import sweep
from barloom.plans.medallion import (
    bronze_to_silver,
    changed_months,
    compact_silver,
    fragmented_months,
    read_quarantine,
    read_silver,
    read_trailing,
    refresh_gold,
    silver_to_gold,
    update_gold,
)

__all__ = [
    "Lake",
    "bronze_to_silver",
    "changed_months",
    "compact_silver",
    "fragmented_months",
    "read_quarantine",
    "read_silver",
    "read_trailing",
    "refresh_gold",
    "silver_to_gold",
    "sweep",
    "update_gold",
]
