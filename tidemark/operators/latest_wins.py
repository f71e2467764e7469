"""Merging deliveries so that the latest wins, counting revisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.session import cut
from tidemark.sources.versioned import VersionedTable

LINEAGE = ("source_ingested_at", "source_run_id")
ORDER = ("source_ingested_at", "source_run_id", "value_hash")


def latest_per_key(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per key the newest delivery; of one run's rows the one with the greater value hash.

    The maximum of a struct, so rows are reduced before the shuffle and a key delivered very often is
    no problem. rows must have ``value_hash``.
    """
    rest = [c for c in columns if c not in (*keys, *ORDER)]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*ORDER, *rest)).alias("v"))
    return best.select(*keys, *[F.col(f"v.{c}") for c in columns if c not in keys])


def with_value_hash(rows: DataFrame, values: Sequence[str]) -> DataFrame:
    return rows.withColumn("value_hash", row_hash(values))


def batch_of(updates: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The newest delivery of each key, with its value hash."""
    return latest_per_key(with_value_hash(updates, values), keys, [*keys, *values, "value_hash", *LINEAGE])


def transition(state: DataFrame, updates: DataFrame, keys: Sequence[str], values: Sequence[str], strict: bool = False) -> DataFrame:
    """The state after a batch of deliveries, with ``_change``: inserted, revised or null.

    A new key is inserted with revision 0. A newer delivery with another hash replaces values and lineage
    and counts a revision; a newer one with the same hash, or an older one, does nothing, and lineage stays.
    first_seen_at and updated_at come from the deliveries, never from the clock. Of several deliveries in
    the batch the newest counts. strict: a newer delivery with the same hash advances the lineage, so that a
    late delivery from before it can't win afterwards; it counts no revision.
    """
    return _apply(state, batch_of(updates, keys, values), keys, values, strict)


def _apply(state: DataFrame, batch: DataFrame, keys: Sequence[str], values: Sequence[str], strict: bool) -> DataFrame:
    s, t = batch.select(F.struct("*").alias("s")), state.select(F.struct("*").alias("t"))
    both = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    held, given = F.col("t").isNotNull(), F.col("s").isNotNull()
    newer = given & held & (F.col("s.source_ingested_at") > F.col("t.source_ingested_at"))
    revises = newer & (F.col("s.value_hash") != F.col("t.value_hash"))
    advances = F.coalesce((newer if strict else revises) | ~held, F.lit(False))
    revised = F.coalesce(revises, F.lit(False))
    arrived = F.col("s.source_ingested_at")

    def pick(name: str):
        return F.when(advances, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    return both.select(
        *[F.coalesce(F.col(f"t.{k}"), F.col(f"s.{k}")).alias(k) for k in keys],
        *[pick(c) for c in (*values, "value_hash", *LINEAGE)],
        F.coalesce(F.col("t.first_seen_at"), arrived).alias("first_seen_at"),
        F.when(revised | ~held, arrived).otherwise(F.col("t.updated_at")).alias("updated_at"),
        F.when(held, F.col("t.revision_count") + revised.cast("int")).otherwise(F.lit(0)).alias("revision_count"),
        F.when(~held, "inserted").when(revised, "revised").alias("_change"),
    )


def merge_latest(table: VersionedTable, updates: DataFrame, keys: Sequence[str], values: Sequence[str], strict: bool = False) -> dict[str, int]:
    """Merge deliveries into a table as one commit; counts of inserted and revised keys. No change, no commit.

    Only parts of the table that a delivered key falls into are read, only those with a change written. Under
    strict an advanced lineage alone is published with its part's next change.
    """
    batch = cut(batch_of(updates, keys, values))
    changes = ("inserted", "revised")
    return table.merge(batch, lambda state: _apply(state, batch, keys, values, strict), "MERGE LATEST", changes, changes)


def replay(deliveries: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """What merging deliveries one after the other in their order would leave, in one pass.

    A revision is a delivery whose hash differs from the key's delivery before. Only for deliveries in
    order of time; equal times of one key count as one batch, of which the greatest row is taken.
    """
    hashed = with_value_hash(deliveries, values)
    once = latest_per_key(hashed, [*keys, "source_ingested_at"], [*keys, *values, "value_hash", *LINEAGE])
    by_time = Window.partitionBy(*keys).orderBy("source_ingested_at")
    before = F.lag("value_hash").over(by_time)
    marked = once.withColumn("_changes", F.when(before.isNull(), 0).otherwise((before != F.col("value_hash")).cast("int"))).withColumn(
        "_starts", before.isNull() | (before != F.col("value_hash"))
    )
    kept = F.struct("source_ingested_at", *values, "value_hash", "source_run_id")
    return marked.groupBy(*keys).agg(
        F.max(F.when(F.col("_starts"), kept)).alias("v"),
        F.min("source_ingested_at").alias("first_seen_at"),
        F.sum("_changes").cast("int").alias("revision_count"),
    ).select(
        *keys,
        *[F.col(f"v.{c}") for c in (*values, "value_hash", *LINEAGE)],
        "first_seen_at",
        F.col("v.source_ingested_at").alias("updated_at"),
        "revision_count",
    )
