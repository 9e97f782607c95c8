"""Hand-made candles."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from wickline import schemas

UTC = timezone.utc
START = date(2024, 1, 1)


def at(day: int, hour: int = 0) -> datetime:
    return datetime(2024, 1, 1, tzinfo=UTC) + timedelta(days=day, hours=hour)


def bronze_row(day=0, hour=0, symbol="AAA", closed=True, ingest=None, **over):
    opened = at(day, hour)
    row = {
        "open_time": opened, "close_time": opened + timedelta(days=1, milliseconds=-1),
        "open": 10.0, "high": 12.0, "low": 9.0, "close": 11.0, "volume": 5.0, "num_trades": 3,
        "is_closed": closed,
        "ingest_ts_utc": (ingest or opened + timedelta(days=1, hours=1)).isoformat()
        if not isinstance(ingest, str) else ingest,
        "symbol_raw": symbol,
    }
    row.update(over)
    return tuple(row[f] for f in schemas.BRONZE.fieldNames())


def bronze(spark, rows):
    return spark.createDataFrame(rows, schemas.BRONZE)


def silver(spark, closes, symbol="AAA", days=None, closed=True, volume=1.0, trades=2, highs=None):
    """Silver candles with the given closes on consecutive (or the given) day numbers."""
    days = list(range(len(closes))) if days is None else days
    rows = []
    for i, (n, c) in enumerate(zip(days, closes)):
        c = None if c is None else Decimal(str(c))
        high = c if highs is None else Decimal(str(highs[i]))
        day = START + timedelta(days=n)
        v = volume[i] if isinstance(volume, list) else volume
        rows.append((symbol, day, at(n), at(n + 1), c, high, c, c, Decimal(str(v)), trades, closed,
                     at(n, 1), None))
    return spark.createDataFrame(rows, schemas.SILVER)


def column(df, name, *order):
    order = order or ("day",)
    return [r[0] for r in df.orderBy(*[F.col(c) for c in order]).select(name).collect()]
