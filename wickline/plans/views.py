"""Named views over one lake: what a report asks for by name."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wickline import schemas
from wickline.operators import monitor
from wickline.plans.lake import Lake
from wickline.plans.refresh import read_gold
from wickline.sources.glossary import glossary
from wickline.sources.history import load_history
from wickline.sources.tables import read_table


def create_views(spark: SparkSession, lake: Lake) -> list[str]:
    """Create or replace the session's views of ``lake``; their names.

    A gold view shows the rebuild that is current when it is created: call again after a refresh.
    """
    history = load_history(spark, lake.history)
    daily = monitor.volume_daily(history)
    frames = {
        "bronze": read_table(spark, lake.bronze, schemas.BRONZE),
        "silver": read_table(spark, lake.silver, schemas.SILVER),
        **{f"gold_{name}": read_gold(spark, lake, name) for name in monitor.GOLD_TABLES},
        "load_history": history,
        "history_silver": monitor.history_silver(history),
        "history_gold": monitor.history_gold(history),
        "volume_daily": monitor.latest_volumes(daily),
        "volume_monthly": monitor.latest_volumes(monitor.volume_monthly(daily), "month_start"),
        "glossary": glossary(spark).orderBy("position"),
    }
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)
