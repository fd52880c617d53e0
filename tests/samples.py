"""Small invented documents and bars."""

from __future__ import annotations

import datetime
import json
from pathlib import Path

DAY1, DAY2 = datetime.date(2011, 11, 8), datetime.date(2011, 11, 9)

SILVER_DDL = (
    "symbol string, date date, open double, high double, low double, close double, "
    "volume bigint, adjclose double"
)
SILVER = [
    ("OAK", DAY1, 12.5, 14.25, 11.75, 13.5, 4000, 13.25),
    ("OAK", DAY2, 13.75, 15.5, 13.0, 14.75, 6000, 14.5),
    ("ELM", DAY1, 40.0, 41.5, 38.25, 39.0, 900, 39.0),
    ("ELM", DAY2, 39.25, 42.0, 39.0, 41.25, 1100, 41.25),
    ("YEW", DAY1, 700.5, 720.0, 690.25, 712.5, 75, 700.0),
    ("YEW", DAY2, 712.0, 715.75, 680.5, 690.0, 125, 677.5),
]


# 2011-11-08 23:30:00 UTC, which is the next day in Oslo and Helsinki, and a day later.
TIMES = (1320795000, 1320881400)


def result(symbol="OAK", times=TIMES, zone="Europe/Helsinki", **arrays):
    """One chart result; values default to the row number times ten."""
    values = {
        name: [10.0 * (i + 1) + k for i in range(len(times))]
        for k, name in enumerate(("open", "high", "low", "close"))
    }
    values["volume"] = [100 * (i + 1) for i in range(len(times))]
    adjusted = arrays.pop("adjclose", [{"adjclose": values["close"]}])
    values.update(arrays)
    return {
        "meta": {
            "currency": "EUR",
            "symbol": symbol,
            "exchangeName": "HEL",
            "instrumentType": "WOOD",
            "firstTradeDate": 915170400,
            "regularMarketTime": 1320881400,
            "timezone": "EET",
            "exchangeTimezoneName": zone,
        },
        "timestamp": list(times),
        "indicators": {"quote": [values], "adjclose": adjusted},
    }


def document(*results, error=None):
    return {"chart": {"result": list(results) or None, "error": error}}


def land(folder, name, *documents):
    """Write documents one per line; text is written as it is."""
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = (d if isinstance(d, str) else json.dumps(d) for d in documents)
    path.write_text("\n".join(lines) + "\n")
    return str(path)
