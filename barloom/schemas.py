"""Declared schemas. Nothing is inferred from data."""

from pyspark.sql.types import StructType

# Field names and types of the chart document.
META_DDL = (
    "currency: string, symbol: string, exchangeName: string, "
    "instrumentType: string, firstTradeDate: bigint, regularMarketTime: bigint, "
    "timezone: string, exchangeTimezoneName: string"
)
QUOTE_DDL = (
    "open: array<double>, high: array<double>, low: array<double>, "
    "close: array<double>, volume: array<bigint>"
)
CHART_DDL = (
    f"chart struct<result: array<struct<meta: struct<{META_DDL}>, "
    "timestamp: array<bigint>, "
    f"indicators: struct<quote: array<struct<{QUOTE_DDL}>>, "
    "adjclose: array<struct<adjclose: array<double>>>>>>, error: string>"
)

# The reader fills this column with the text of a line it could not parse.
RAW_TEXT = "raw_text"
DOCUMENT_DDL = f"{CHART_DDL}, {RAW_TEXT} string"

# Silver as it is stored; the last two are partition folders.
SILVER_DDL = (
    "symbol string, datetime timestamp, date date, open double, high double, low double, "
    "close double, volume bigint, adjclose double, currency string, exchange string, "
    "exchange_timezone string, source_file string, ingested_at timestamp, local_date date, "
    "processed_at timestamp, ingest_batch int, month date"
)

QUARANTINE_DDL = (
    "reason string, symbol string, error string, raw_text string, source_file string, "
    "ingested_at timestamp, processed_at timestamp, ingest_batch int"
)

PRICE_COLUMNS = ("open", "high", "low", "close")
VALUE_COLUMNS = PRICE_COLUMNS + ("volume", "adjclose")

# Silver metadata column -> name of the field inside the document's ``meta``.
META_COLUMNS = {
    "currency": "currency",
    "exchange": "exchangeName",
    "instrument_type": "instrumentType",
    "first_trade": "firstTradeDate",
    "market_time": "regularMarketTime",
    "timezone": "timezone",
    "exchange_timezone": "exchangeTimezoneName",
}


def chart_schema() -> StructType:
    """The chart document as a ``StructType`` (needs a running session)."""
    return StructType.fromDDL(CHART_DDL)
