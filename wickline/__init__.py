"""wickline: market-candle analytics as Spark DataFrame operators."""
