"""Operators: plain functions from DataFrame to DataFrame."""

from barloom.operators.bars import (
    coarsen,
    explode_bars,
    explode_metadata,
    newest_copy,
    resample,
    with_local_date,
    with_month,
    with_processed_at,
)
from barloom.operators.filters import (
    for_symbol,
    on_date,
    preview,
    row_count,
    symbol_on_date,
    symbol_series,
    trailing,
)
from barloom.operators.metrics import (
    daily_metrics,
    daily_rollup,
    market_metrics,
    mean_of_daily_close,
    merge_rollups,
    rollup,
    symbol_metrics,
    weighted_close,
)
from barloom.operators.pack import pack_documents
from barloom.operators.quality import accepted, quarantined, with_reason

__all__ = [
    "accepted",
    "coarsen",
    "daily_metrics",
    "daily_rollup",
    "explode_bars",
    "explode_metadata",
    "for_symbol",
    "market_metrics",
    "mean_of_daily_close",
    "merge_rollups",
    "newest_copy",
    "on_date",
    "pack_documents",
    "preview",
    "quarantined",
    "resample",
    "rollup",
    "row_count",
    "symbol_metrics",
    "symbol_on_date",
    "symbol_series",
    "trailing",
    "weighted_close",
    "with_local_date",
    "with_month",
    "with_processed_at",
    "with_reason",
]
