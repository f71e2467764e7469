"""Differences between two copies of the same data, field by field."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest(rows: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Per key the row with the greatest ``order``, with its ``fields``; pre-aggregated before the shuffle."""
    best = rows.groupBy(*keys).agg(F.max(F.struct(*order, *fields)).alias("v"))
    return best.select(*keys, *[F.col(f"v.{c}") for c in fields])


def compare_copies(
    rows: DataFrame,
    keys: Sequence[str],
    side: str,
    sides: tuple[str, str],
    fields: Sequence[str],
    differs: Mapping[str, Callable[[Column, Column], Column]],
) -> DataFrame:
    """``keys`` and ``field`` for every key missing on a side and every field that differs.

    rows: both copies in one frame, at most one row per key and side (see ``newest``), the column ``side``
    naming the copy. differs: name of a difference to a test of both rows as structs of ``fields``. field
    is ``missing_<side>`` when only the other copy has the key, else the name of each test that holds;
    a test that gives null doesn't hold. Keys may be null, nulls being equal. Rows of other sides are left
    out. Empty copies: every key of the other is missing.

    One range exchange gives both copies the same split points, each partition is sorted, and a merge
    walks it once: a row whose neighbour has the same key is a pair, any other is missing on one side.
    Range partitions never separate a key from its pair, so the window over the key finds its rows
    already together and adds neither a shuffle nor a sort.
    """
    left, right = sides
    first = F.col("_side") == left
    # the sort's last column puts the left copy's row before the right one's
    tagged = rows.where(F.col(side).isin(left, right)).select(
        *keys, F.col(side).alias("_side"), (F.col(side) != left).alias("_second"), F.struct(*fields).alias("_row")
    )
    sorted_ = tagged.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, "_second")
    walk = Window.partitionBy(*keys).orderBy("_second")
    merged = sorted_.withColumn("_next", F.lead("_row").over(walk)).withColumn("_n", F.row_number().over(walk))
    alone = (F.col("_n") == 1) & F.col("_next").isNull()
    paired = (F.col("_n") == 1) & F.col("_next").isNotNull()
    found = F.array_compact(
        F.array(
            F.when(alone & first, F.lit(f"missing_{right}")),
            F.when(alone & ~first, F.lit(f"missing_{left}")),
            *[F.when(paired & test(F.col("_row"), F.col("_next")), F.lit(name)) for name, test in differs.items()],
        )
    )
    return merged.select(*keys, F.explode(found).alias("field"))


def split_factors(actions: DataFrame) -> DataFrame:
    """``security_id`` and its splits as an array of (ex_date, value), each ex_date once.

    Of several values for one ex_date the one delivered last counts. As long as the list of a security's
    split days, however often rows were repeated. Rows without a security, day or value are no splits.
    """
    splits = actions.where(
        (F.col("action_type") == "split") & F.col("security_id").isNotNull() & F.col("ex_date").isNotNull() & F.col("value").isNotNull()
    )
    once = splits.groupBy("security_id", "ex_date").agg(F.max(F.struct("source_ingested_at", "value")).alias("v"))
    return once.groupBy("security_id").agg(F.collect_list(F.struct("ex_date", F.col("v.value").cast("double").alias("value"))).alias("splits"))


def later_product(splits: Column, day: Column) -> Column:
    """The product of the splits after a day; 1 without any."""
    after = F.filter(splits, lambda s: s["ex_date"] > day)
    # sorted, so that the product of doubles is the same wherever it is computed
    return F.coalesce(F.aggregate(F.array_sort(after), F.lit(1.0), lambda acc, s: acc * s["value"]), F.lit(1.0))


def beyond(a: Column, b: Column, share: float) -> Column:
    """Whether two numbers differ by more than a share of the larger absolute value."""
    return F.abs(a - b) > F.lit(share) * F.greatest(F.abs(a), F.abs(b))
