"""Bars back to chart documents: the inverse of ``explode_bars``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.schemas import META_COLUMNS, META_DDL, PRICE_COLUMNS, VALUE_COLUMNS

# Part number given to rows of groups that are not split.
WHOLE = -1


def _null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def _with_part(bars: DataFrame, keys: Sequence[str], max_bars: int) -> DataFrame:
    """Number the parts of groups that are too large for one document.

    Groups are counted first. Where none is too large, that is all: no row is sorted or
    joined. Rows of the large ones are cut by ranges of time that Spark samples, whatever
    their layout, and within such a range by their place, counted in steps of
    ``max_bars``. So a part never has more rows than that, and the parts of a group
    follow each other in time. The source partition is the last range key, so that even
    equal rows are spread; it and the places are the same when a task runs again.
    """
    counts = bars.groupBy(*keys).agg(F.count("*").alias("_bars"))
    hot = counts.where(F.col("_bars") > max_bars).select(*keys).alias("h")
    whole = F.struct(F.lit(WHOLE).alias("source"), F.lit(WHOLE).cast("bigint").alias("step"))
    if hot.isEmpty():
        return bars.withColumn("_part", whole)
    large = _null_safe("b", "h", keys)
    cold = bars.alias("b").join(hot, large, "left_anti").withColumn("_part", whole)
    rest = [name for name in bars.columns if name not in keys]
    order = [*keys, *rest, "_from"]
    placed = (
        bars.alias("b")
        .join(hot, large, "left_semi")
        .withColumn("_from", F.spark_partition_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    step = F.call_function("div", place, F.lit(max_bars))
    split = F.struct(F.spark_partition_id().alias("source"), step.alias("step"))
    return cold.unionByName(placed.withColumn("_part", split).drop("_from"))


def _meta(available: Sequence[str]) -> Column:
    """The document's ``meta``; fields the bars do not carry are NULL."""
    sources = {"symbol": "symbol", **{field: name for name, field in META_COLUMNS.items()}}
    fields = [field.strip().split(": ") for field in META_DDL.split(",")]
    return F.struct(
        *(
            (F.col(sources[name]) if sources[name] in available else F.lit(None))
            .cast(kind)
            .alias(name)
            for name, kind in fields
        )
    )


def pack_documents(
    bars: DataFrame, *, by: Sequence[str] = (), max_bars: int = 100_000
) -> DataFrame:
    """Chart documents of at most ``max_bars`` bars each, in time order.

    A group with more bars becomes several documents, whose times follow each other.
    Groups are counted when this is called, so ``bars`` are read once more than written.

    A document holds one symbol with one set of metadata, and one value of each
    ``by`` column (a landing run, say), which is returned beside ``chart``.
    Documents keep whole seconds. Every bar is in exactly one document.
    """
    meta = [name for name in META_COLUMNS if name in bars.columns]
    keys = ["symbol", *meta, *by]
    values = [name for name in VALUE_COLUMNS if name in bars.columns]
    rows = bars.select(*keys, F.unix_seconds("datetime").alias("epoch"), *values)
    pieces = (
        _with_part(rows, keys, max_bars)
        .groupBy(*keys, "_part")
        .agg(F.sort_array(F.collect_list(F.struct("epoch", *values))).alias("bars"))
    )
    quote = F.struct(
        *(
            F.col("bars").getField(name).alias(name)
            for name in (*PRICE_COLUMNS, "volume")
            if name in values
        )
    )
    adjusted = [F.struct(F.col("bars.adjclose").alias("adjclose"))] if "adjclose" in values else []
    result = F.struct(
        _meta(keys).alias("meta"),
        F.col("bars.epoch").alias("timestamp"),
        F.struct(F.array(quote).alias("quote"), F.array(*adjusted).alias("adjclose")).alias(
            "indicators"
        ),
    )
    chart = F.struct(F.array(result).alias("result"), F.lit(None).cast("string").alias("error"))
    return pieces.select(*{"symbol": None, **dict.fromkeys(by)}, chart.alias("chart"))
