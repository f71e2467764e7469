"""Slowly changing dimensions, type 2: merging a full snapshot, and reading at an instant."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.hashing import row_hash
from tidemark.session import cut
from tidemark.sources.schemas import with_scd2_fields
from tidemark.sources.versioned import VersionedTable

#: Intervals are half-open and not empty.
CONSTRAINTS = {"valid_interval": "valid_to IS NULL OR valid_to > valid_from"}


def transition(history: DataFrame, snapshot: DataFrame, key: str, observed_at: Column) -> DataFrame:
    """The history after a snapshot, with ``_change``: new, changed, unchanged, closed or null.

    Tracked are all of the snapshot's columns but the key, in their order. A new key opens a version; a
    key whose hash differs from its open version closes that at ``observed_at`` and opens another; keys
    missing from the snapshot stay open, since absence may be a failed read. One full outer join of the
    snapshot with the open versions; a joined row yields the old version, the new one, or both. ``closed``
    marks the old half of a change. The snapshot's keys must be unique (``duplicated_keys`` finds others).
    A null key never matches and is left to the table's NOT NULL check.
    """
    tracked = [c for c in snapshot.columns if c != key]
    columns = [key, *tracked, "row_hash", "valid_from", "valid_to", "is_current"]
    new = snapshot.select(F.struct(key, *tracked, row_hash(tracked).alias("row_hash")).alias("s"))
    past = history.where("NOT is_current").select(*columns, F.lit(None).cast("string").alias("_change"))
    old = history.where("is_current").select(F.struct(*columns).alias("t"))
    both = old.join(new, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    seen, held = F.col("s").isNotNull(), F.col("t").isNotNull()
    differs = F.col("t.row_hash") != F.col("s.row_hash")

    def version(side: str, valid_from: Column, valid_to: Column, current: Column, change: Column) -> Column:
        values = [F.col(f"{side}.{c}").alias(c) for c in [key, *tracked, "row_hash"]]
        return F.struct(
            *values,
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
            current.alias("is_current"),
            change.alias("_change"),
        )

    never = F.lit(None).cast("timestamp")
    closes = held & seen & differs
    kept = version(
        "t",
        F.col("t.valid_from"),
        F.when(closes, observed_at).otherwise(F.col("t.valid_to")),
        ~F.coalesce(closes, F.lit(False)),
        F.when(closes, "closed").when(seen, "unchanged"),
    )
    opened = version("s", observed_at, never, F.lit(True), F.when(held, "changed").otherwise("new"))
    opens = seen & (~held | differs)
    rows = F.array_compact(F.array(F.when(held, kept), F.when(opens, opened)))
    return past.unionByName(both.select(F.inline(rows)))


def duplicated_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def ensure_table(table: VersionedTable, attributes: T.StructType, key: str | None = None, parts: int = 1) -> bool:
    """The table with the fields and the check of this kind, in parts by the hash of ``key`` if it is given."""
    layout = None if key is None else f"pmod(hash(`{key}`), {parts})"
    return table.ensure(with_scd2_fields(attributes), CONSTRAINTS, layout)


def merge_snapshot(table: VersionedTable, snapshot: DataFrame, key: str, observed_at: datetime) -> dict[str, int]:
    """Merge a snapshot into a table as one commit; counts of new, changed and unchanged keys.

    Without a change nothing is published, and parts of the table without one aren't written. A time at or before an
    open version that changes breaks the table's check, and repeated keys raise ValueError; then nothing is written.
    """
    snapshot = cut(snapshot)
    twice = duplicated_keys(snapshot, key).limit(5).collect()
    if twice:
        raise ValueError(f"the snapshot repeats {key}, for instance: {[r[key] for r in twice]}")
    at = F.lit(observed_at).cast("timestamp")
    return table.merge(snapshot, lambda history: transition(history, snapshot, key, at), "MERGE SCD2", ("new", "changed", "unchanged"), ("new", "changed"))


def current(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def as_of(history: DataFrame, instant: Column | datetime | str) -> DataFrame:
    """The version of each key in force at an instant; text is read as UTC."""
    at = instant if isinstance(instant, Column) else F.lit(instant).cast("timestamp")
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def changed_keys(history: DataFrame, key: str) -> DataFrame:
    """Keys with more than one version, and how many."""
    return history.groupBy(key).agg(F.count(F.lit(1)).alias("n_versions")).where("n_versions > 1")


def broken_keys(history: DataFrame, key: str) -> DataFrame:
    """Keys that don't have exactly one open version, and how many they have; none at all counts as well."""
    return history.groupBy(key).agg(F.count_if("is_current").alias("n_open")).where("n_open <> 1")


def replay(snapshots: DataFrame, key: str, at: str, columns: Sequence[str]) -> DataFrame:
    """What merging snapshots one after the other would leave, in one pass.

    snapshots: one row per key and time. A version begins where the hash differs from the key's row before.
    Holds because absent keys are never closed and snapshots come in order.
    """
    by_time = Window.partitionBy(key).orderBy(at)
    hashed = snapshots.select(key, at, *columns, row_hash(columns).alias("row_hash"))
    begun = hashed.withColumn("_before", F.lag("row_hash").over(by_time)).where("_before IS NULL OR _before <> row_hash")
    until = F.lead(at).over(by_time)
    return begun.select(key, *columns, "row_hash", F.col(at).alias("valid_from"), until.alias("valid_to"), until.isNull().alias("is_current"))
