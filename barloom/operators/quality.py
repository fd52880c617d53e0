"""Which documents become bars, and which are set aside, and why.

``malformed``  the line is not a document of the declared schema
``error``      the document carries an error instead of data
``timestamp``  a timestamp lies outside the years 1 to 9999
``length``     a value array is shorter or longer than the timestamps
``value``      a price is not a finite number

The first two give no bars. The others are reports: their bars stay in
silver, with NULL where a value or a valid time is missing.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.time import MAX_EPOCH, MIN_EPOCH
from barloom.schemas import PRICE_COLUMNS, RAW_TEXT

REJECTED = ("malformed", "error")
REPORTED = ("timestamp", "length", "value")


def is_accepted() -> Column:
    return F.col(RAW_TEXT).isNull() & F.col("chart.error").isNull()


def accepted(documents: DataFrame) -> DataFrame:
    """Documents whose bars go to silver."""
    return documents.where(is_accepted())


def _bad_timestamps(result: Column) -> Column:
    times = result.getField("timestamp")
    return (F.array_min(times) < MIN_EPOCH) | (F.array_max(times) > MAX_EPOCH)


def _bad_lengths(result: Column) -> Column:
    """A list that is absent is not short: only present arrays are compared."""
    expected = F.coalesce(F.size(result.getField("timestamp")), F.lit(0))
    quote = F.get(result["indicators"]["quote"], F.lit(0))
    adjusted = F.get(result["indicators"]["adjclose"], F.lit(0))
    arrays = [quote[name] for name in (*PRICE_COLUMNS, "volume")] + [adjusted["adjclose"]]
    return reduce(or_, (F.coalesce(F.size(a) != expected, F.lit(False)) for a in arrays))


def _bad_values(result: Column) -> Column:
    quote = F.get(result["indicators"]["quote"], F.lit(0))
    adjusted = F.get(result["indicators"]["adjclose"], F.lit(0))
    arrays = [quote[name] for name in PRICE_COLUMNS] + [adjusted["adjclose"]]
    # No number is above infinity but NaN, and NULLs are no defect.
    wrong = (F.exists(a, lambda v: F.abs(v) >= F.lit(float("inf"))) for a in arrays)
    return reduce(or_, (F.coalesce(w, F.lit(False)) for w in wrong))


def with_reason(documents: DataFrame) -> DataFrame:
    """Add ``reason``: the first defect of the document, NULL for a good one."""
    results = F.col("chart.result")
    return documents.withColumn(
        "reason",
        F.when(F.col(RAW_TEXT).isNotNull(), "malformed")
        .when(F.col("chart.error").isNotNull(), "error")
        .when(F.exists(results, _bad_timestamps), "timestamp")
        .when(F.exists(results, _bad_lengths), "length")
        .when(F.exists(results, _bad_values), "value"),
    )


def quarantined(documents: DataFrame) -> DataFrame:
    """One row per defective document, with what is needed to find and fix it."""
    tagged = documents if "reason" in documents.columns else with_reason(documents)
    symbol = F.get(F.col("chart.result"), F.lit(0))["meta"]["symbol"]
    return tagged.where(F.col("reason").isNotNull()).select(
        "reason",
        symbol.alias("symbol"),
        F.col("chart.error").alias("error"),
        RAW_TEXT,
        "source_file",
        "ingested_at",
    )
