"""Selections the serving layer makes, written so that scans can use them."""

from __future__ import annotations

import datetime
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.time import trailing_interval

if TYPE_CHECKING:
    import pandas as pd


def for_symbol(df: DataFrame, symbol: str) -> DataFrame:
    return df.where(F.col("symbol") == symbol)


def on_date(df: DataFrame, date: datetime.date) -> DataFrame:
    """Rows of one date. A table with a ``month`` partition reads only that month."""
    condition = F.col("date") == F.lit(date)
    if "month" in df.columns:
        condition = condition & (F.col("month") == F.lit(date.replace(day=1)))
    return df.where(condition)


def symbol_on_date(df: DataFrame, symbol: str, date: datetime.date) -> DataFrame:
    return for_symbol(on_date(df, date), symbol)


def symbol_series(df: DataFrame, symbol: str, *, order_by: str = "date") -> DataFrame:
    """One symbol in time order: filter first, then sort what is left."""
    return for_symbol(df, symbol).orderBy(order_by)


def trailing(
    df: DataFrame, code: str, *, time: str = "datetime", newest: Column | None = None
) -> DataFrame:
    """The last ``code`` ("5d", "1mo", "1y") of the data, counted from its newest row.

    Unless given, the newest time is a scalar subquery, not a join: it reads one column,
    and its result is pushed into the scan of the filtered read. A table with a
    ``month`` partition reads only the months from the start of the range on.
    """
    if newest is None:
        newest = df.select(F.max(time)).scalar()
    start = newest - trailing_interval(code)
    condition = F.col(time) >= start
    if "month" in df.columns:
        condition = condition & (F.col("month") >= F.trunc(start.cast("date"), "MM"))
    return df.where(condition)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def preview(df: DataFrame, n: int = 5, *, order_by: str | Column | list | None = None) -> pd.DataFrame:
    """A few rows on the driver; give an order for the same rows every time."""
    ordered = df if order_by is None else df.orderBy(order_by)
    return ordered.limit(n).toPandas()
