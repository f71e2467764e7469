"""History of entity attributes from periodic snapshots, by gaps and islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def state_hash(columns: Sequence[Column]) -> Column:
    """One hash of a version's attributes; null is a value of its own, and no value can imitate the separator."""
    return F.sha2(F.to_json(F.array(*[c.cast("string") for c in columns]), {"ignoreNullFields": "false"}), 256)


def last_open(master: DataFrame, key: str, attributes: dict[str, Column]) -> DataFrame:
    """Per key the version with the latest valid_from, whatever its other columns say.

    Pre-aggregated before the shuffle, so a key with any number of repeated rows costs one row per task.
    Rows without a key or a start are no versions. Of two rows with the same start the one with the
    greater attributes is taken, which makes the choice repeatable.
    """
    row = F.struct("valid_from", *[c.alias(n) for n, c in attributes.items()])
    best = master.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).groupBy(key).agg(F.max(row).alias("v"))
    return best.select(key, F.col("v.valid_from").alias("at"), *[F.col(f"v.{n}") for n in attributes])


def last_received(snapshots: DataFrame, key: str, attributes: dict[str, Column]) -> DataFrame:
    """Per snapshot and key the row received last; ties as in last_open."""
    row = F.struct("received_at", *[c.alias(n) for n, c in attributes.items()])
    usable = snapshots.where(F.col(key).isNotNull() & F.col("snapshot_at").isNotNull())
    best = usable.groupBy(key, "snapshot_at").agg(F.max(row).alias("v"))
    return best.select(key, F.col("snapshot_at").alias("at"), *[F.col(f"v.{n}") for n in attributes])


def extend_history(
    master: DataFrame, snapshots: DataFrame, key: str, attributes: dict[str, Column], keep: Sequence[str] = ()
) -> DataFrame:
    """The versions that snapshots close or open: key, valid_from, valid_to (null: still open) and ``keep``.

    master: versions so far (key, valid_from, attributes). snapshots: key, snapshot_at, received_at,
    attributes. attributes: name to expression, read on both sides; they decide what a change is.

    The key's open version and its snapshot states form one sequence in time. Where the attribute hash
    differs from the one before, an island begins; a running sum numbers the islands; an island's
    earliest time is its valid_from and the next island's start its valid_to. The master's version is an
    island of its own at the start (a key the master doesn't know begins with its first snapshot), and
    it is returned only if a snapshot closes it. A snapshot at or before the open version's start is not
    after it and is left out. A key absent from a snapshot stays as it is. Empty inputs give no rows.

    A key has one row per snapshot after pre-aggregation, so a window over a key is as long as the list
    of snapshot times, however often rows were repeated.
    """
    base = last_open(master, key, attributes).withColumn("known", F.lit(True))
    later = last_received(snapshots, key, attributes).withColumn("known", F.lit(False))
    by_key = Window.partitionBy(key)
    in_time = by_key.orderBy("at", F.desc("known"))
    states = (
        base.unionByName(later)
        .withColumn("started", F.max(F.when(F.col("known"), F.col("at"))).over(by_key))
        .where(F.col("known") | F.col("started").isNull() | (F.col("at") > F.col("started")))
        .withColumn("state", state_hash([F.col(n) for n in attributes]))
        .withColumn("before", F.lag("state").over(in_time))
        .withColumn("starts", (F.col("before").isNull() | (F.col("before") != F.col("state"))).cast("int"))
        .withColumn("island", F.sum("starts").over(in_time.rowsBetween(Window.unboundedPreceding, 0)))
    )
    islands = states.groupBy(key, "island").agg(
        F.min("at").alias("valid_from"),
        F.bool_or("known").alias("known"),
        *[F.min_by(n, "at").alias(n) for n in keep],
    )
    ended = islands.withColumn("valid_to", F.lead("valid_from").over(by_key.orderBy("island")))
    changed = ended.where(~F.col("known") | F.col("valid_to").isNotNull())
    return changed.select(key, "valid_from", "valid_to", *keep)
