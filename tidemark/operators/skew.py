"""Joins with groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut

#: Rows that one task should sort: a group beyond that is hot, and is split into parts of this size.
HOT_ROWS = 1_000_000
#: A list of groups is broadcast if it was counted to have no more rows than this.
BROADCAST_ROWS = 100_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Groups too large for one task: ``key`` and ``n_salts``, the number of parts of ``hot_rows`` rows each.

    One aggregation over the key column alone, with partial sums before its shuffle; counted once and
    kept. The size of a part doesn't grow with the data. A null key is a group like any other.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)
    return cut(counts.select(key, F.ceil(F.col("n") / hot_rows).cast("int").alias("n_salts")))


def broadcast_if_small(side: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The side with the hint to broadcast it, if it is counted to be small; else as it is.

    Beyond that the join is a shuffle join, of which adaptive execution splits skewed partitions.
    """
    return F.broadcast(side) if side.limit(most + 1).count() <= most else side


def lookup(rows: DataFrame, side: DataFrame, key: str, columns: Sequence[str], hot_rows: int = HOT_ROWS, most: int = BROADCAST_ROWS) -> DataFrame:
    """rows with ``columns`` of ``side`` (at most one row per key) or nulls, whatever share of rows one key has.

    A side counted to be small is broadcast. Beyond that only rows of keys that aren't hot are shuffled; of
    the hot keys, whose list is counted too, the side's rows are broadcast, and their rows stay where they are.
    A null key finds nothing. ``rows`` should be kept (see ``cut``): it is read more than once.
    """
    side = side.select(key, F.struct(*columns).alias("_found"))

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, key, "left").select(*[left[c] for c in left.columns], *[F.col(f"_found.{c}").alias(c) for c in columns])

    if side.limit(most + 1).count() <= most:
        return joined(rows, F.broadcast(side))
    hot = hot_keys(rows.where(F.col(key).isNotNull()), key, hot_rows).select(key)
    if hot.limit(most + 1).count() > most:
        return joined(rows, side)  # skewed partitions are split by adaptive execution
    hot = F.broadcast(hot)
    is_hot = rows.join(hot, key, "left_semi").select(*rows.columns)
    others = rows.join(hot, key, "left_anti").select(*rows.columns)
    return joined(is_hot, F.broadcast(side.join(hot, key, "left_semi"))).unionByName(joined(others, side))
