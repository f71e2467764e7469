"""Completeness and comparisons of delivered bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_bars(securities: DataFrame, days: DataFrame, sources: tuple[str, ...], actual: DataFrame) -> DataFrame:
    """security_id, trade_date, source of every bar expected but not there.

    Expected are all securities on all days from all sources. Per security and source the days that are
    there are gathered (no more than the calendar has) and taken from the calendar, so the grid of
    expected bars is never built and no bar is shuffled that partial aggregation has seen before.
    """
    calendar = days.agg(F.array_sort(F.collect_set("trade_date")).alias("days"))
    wanted = securities.select("security_id").where("security_id IS NOT NULL").distinct()
    wanted = wanted.select("security_id", F.explode(F.array(*[F.lit(s) for s in sources])).alias("source"))
    there = actual.where("trade_date IS NOT NULL").groupBy("security_id", "source").agg(F.collect_set("trade_date").alias("there"))
    joined = wanted.join(there, ["security_id", "source"], "left")
    absent = F.array_except(calendar.scalar(), F.coalesce("there", F.array().cast("array<date>")))
    return joined.select("security_id", F.explode(absent).alias("trade_date"), "source")


def close_ratio(bars: DataFrame, first: str, second: str) -> DataFrame:
    """security_id, trade_date and the ratio of the two sources' closes, to two places; days with both only.

    One pass over the bars instead of a join of two halves.
    """
    closes = bars.groupBy("security_id", "trade_date").agg(
        F.max(F.when(F.col("source") == first, F.col("close"))).alias("a"),
        F.max(F.when(F.col("source") == second, F.col("close"))).alias("b"),
    )
    return closes.where("a IS NOT NULL AND b IS NOT NULL AND b <> 0").select(
        "security_id", "trade_date", F.round(F.col("a") / F.col("b"), 2).alias("ratio")
    )


def ratio_days(ratios: DataFrame, chosen: Column) -> DataFrame:
    """security_id, days, first_day, last_day of the days whose ratio is among those chosen."""
    return ratios.where(chosen).groupBy("security_id").agg(
        F.count(F.lit(1)).alias("days"), F.min("trade_date").alias("first_day"), F.max("trade_date").alias("last_day")
    )
