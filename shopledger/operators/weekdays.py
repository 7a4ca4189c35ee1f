"""The seven-day spine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.functions.calendar import weekday_name


def weekday_spine(spark: SparkSession) -> DataFrame:
    """``(1, Mon)`` to ``(7, Sun)``."""
    number = F.col("id").cast("int")
    return spark.range(1, 8, 1, 1).select(number.alias("day_num"), weekday_name(number).alias("day_name"))


def on_every_weekday(per_day: DataFrame) -> DataFrame:
    """``per_day`` (at most one row per ``day_num``) with the missing days added."""
    return weekday_spine(per_day.sparkSession).join(F.broadcast(per_day), "day_num", "left")
