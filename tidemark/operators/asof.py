"""Attributes as they were known at the time of an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.skew import HOT_ROWS, broadcast_if_small, hot_keys

#: Order at equal times: a change first, so that an event at that instant sees it.
CHANGE, EVENT = 0, 1


def session_end(day: Column) -> Column:
    """16:00 in New York on a date, as an instant (also on days that close early)."""
    return F.to_utc_timestamp(day.cast("timestamp") + F.expr("INTERVAL 16 HOURS"), "America/New_York")


def as_known(
    events: DataFrame,
    at: Column,
    changes: DataFrame,
    key: str,
    attributes: Sequence[str],
    event_columns: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every event with the attributes of its entity in force at its time.

    events: ``key`` and ``event_columns``; ``at`` gives an event's time. changes: ``key``, valid_from,
    valid_to (null: until the next change) and ``attributes``. Result: event_columns, key, valid_from,
    the attributes, and ``is_latest``, whether that is the entity's latest version. An event without a
    time, without a key, before the first version or in a gap (the version's valid_to is at or before
    its time) has null valid_from and attributes. Every event row comes out once, repeated ones too.
    Of several versions that start together the greatest row counts, so repeats of a version add nothing.

    Union of both, sorted by entity, time and priority; the last version is carried forward. No values
    that became known later can reach an event. Entities with more than ``hot_rows`` rows are
    split into parts of that size by row number, and their versions (few, since they are deduplicated)
    are repeated for each part. Without such entities nothing is numbered or joined.
    """
    version = F.struct("valid_from", "valid_to", *attributes)
    distinct = (
        changes.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull())
        .groupBy(key, "valid_from")
        .agg(F.max(version).alias("version"))
        .select(key, F.col("valid_from").alias("_at"), "version")
    )
    latest = F.max("_at").over(Window.partitionBy(key)) == F.col("_at")
    distinct = distinct.withColumn("version", F.struct("version.*", latest.alias("is_latest")))

    rows = events.select(F.col(key), at.alias("_at"), F.struct(*event_columns).alias("event"))
    hot = hot_keys(events, key, hot_rows)
    if hot.isEmpty():
        rows, states = rows.withColumn("_part", F.lit(0)), distinct.withColumn("_part", F.lit(0))
    else:
        # numbered by the scan, so that even copies of one event spread
        numbered = rows.withColumn("_number", F.monotonically_increasing_id())
        hot = broadcast_if_small(hot)
        parts = F.coalesce(F.col("n_salts"), F.lit(1))
        rows = numbered.join(hot, numbered[key].eqNullSafe(hot[key]), "left").select(
            numbered[key], "_at", "event", F.pmod("_number", parts).cast("int").alias("_part")
        )
        states = distinct.join(hot, distinct[key] == hot[key], "left").select(
            distinct[key], "_at", "version", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part")
        )
    both = rows.withColumn("_kind", F.lit(EVENT)).unionByName(states.withColumn("_kind", F.lit(CHANGE)), allowMissingColumns=True)

    group = Window.partitionBy(key, "_part")
    in_time = group.orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    carried = both.withColumn("version", F.last("version", ignorenulls=True).over(in_time)).where(F.col("_kind") == EVENT)
    holds = F.col("_at").isNotNull() & (F.col("version.valid_to").isNull() | (F.col("version.valid_to") > F.col("_at")))
    held = carried.withColumn("version", F.when(holds, F.col("version")))
    return held.select(
        *[F.col(f"event.{c}") for c in event_columns],
        *([] if key in event_columns else [key]),
        *[F.col(f"version.{c}") for c in ("valid_from", *attributes, "is_latest")],
    )
