"""Filling of fixed-capacity containers by balanced cost."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut

CAPACITY = 2_048
#: Items packed together in one group: large enough that the last, partly filled containers don't matter.
GROUP_ITEMS = 20_000


@dataclass(frozen=True)
class Cost:
    """Estimated cost of a sequence: so much a token, and so much a pair of tokens of one document."""

    linear: float = 1.0
    quadratic: float = 1.0 / 1024

    def of(self, length: int) -> float:
        return self.linear * length + self.quadratic * length * length


class Containers:
    """Open containers by the room they have left; finds the cheapest with enough room.

    A tree over the amounts of room holds, per range of amounts, whether the range has containers and
    their least cost, so a search costs a few steps per item however many containers are open.
    """

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.width = 1 << capacity.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
        self.least = [(np.inf, -1)] * (2 * self.width)
        self.opened = 0

    def _update(self, room: int) -> None:
        heap, at = self.heaps[room], room + self.width
        self.least[at] = (heap[0][0], room) if heap else (np.inf, -1)
        at >>= 1
        while at:
            self.least[at] = min(self.least[2 * at], self.least[2 * at + 1])
            at >>= 1

    def add_empty(self, number: int) -> None:
        for _ in range(number):
            heapq.heappush(self.heaps[self.capacity], (0.0, self.opened))
            self.opened += 1
        self._update(self.capacity)

    def place(self, length: int, cost: float) -> tuple[int, int]:
        """The container that takes an item, and how much it held before; opens one if none has room."""
        low, high, best = length + self.width, 2 * self.width, (np.inf, -1)
        while low < high:
            if low & 1:
                best = min(best, self.least[low])
                low += 1
            if high & 1:
                high -= 1
                best = min(best, self.least[high])
            low >>= 1
            high >>= 1
        if best[1] < 0:
            self.add_empty(1)
            best = (0.0, self.capacity)
        room = best[1]
        spent, number = heapq.heappop(self.heaps[room])
        heapq.heappush(self.heaps[room - length], (spent + cost, number))
        self._update(room)
        self._update(room - length)
        return number, self.capacity - room


def pack(lengths: np.ndarray, capacity: int, cost: Cost) -> tuple[np.ndarray, np.ndarray]:
    """Container and offset of each item; lengths are from 1 to ``capacity``.

    As many containers are opened as the items need at least; items in descending order each go to the
    container of lowest cost that has room. Only where none has room is another one opened.
    """
    lengths = np.asarray(lengths, np.int64)
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    containers = Containers(capacity)
    containers.add_empty(-(-int(lengths.sum()) // capacity))
    price: dict[int, float] = {}
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        if length not in price:
            price[length] = cost.of(length)
        number[i], offset[i] = containers.place(length, price[length])
    return number, offset


def pack_items(items: DataFrame, capacity: int = CAPACITY, cost: Cost = Cost(), group_items: int = GROUP_ITEMS, identity: str = "doc_id") -> DataFrame:
    """``identity, part, n_tokens, container, position``: where each item, or part of one, lies.

    items: ``identity`` and ``n_tokens``. An item longer than the capacity is split into full parts and a
    rest, numbered from 0; no other item is split. Items of size 0, null or less are in no container and
    don't come out. container is ``group:number``; position is the part's first token in it. Rows with
    the same identity are separate items, each with room of its own.

    Parts are dealt to groups by a hash of what they are (identity, part, size) and, for parts that are alike, of
    a number from 0 up; so every group has the same mix of lengths, no key is hot, and
    groups are packed independently; a group wastes at most about what one container holds. Which group a part
    is in, and its place among that group's parts, follow from the set of items alone: the same items give the
    same containers however they are partitioned or ordered.
    """
    sized = items.where(F.col("n_tokens") > 0).select(F.col(identity), F.col("n_tokens").cast("long").alias("size"))
    # parts that are alike are counted, before the shuffle too, and told apart by a number
    alike = cut(sized.groupBy(identity, "size").agg(F.count(F.lit(1)).alias("copies")))
    pieces = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(capacity).cast("long"))
    total = alike.agg(F.coalesce(F.sum(F.col("copies") * F.ceil(F.col("size") / capacity)), F.lit(0)).cast("long")).first()[0]
    groups = max(1, -(-total // group_items))
    split = alike.select(identity, "size", "copies", F.posexplode(pieces).alias("part", "start"))
    parts = split.select(
        identity,
        "part",
        F.least(F.col("size") - F.col("start"), F.lit(capacity)).cast("int").alias("n_tokens"),
        "size",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    )
    dealt = parts.withColumn("group", F.pmod(F.xxhash64(identity, "part", "size", "copy"), F.lit(groups)).cast("int"))
    kind = dict(items.dtypes)[identity]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            group = pa.Table.from_batches(held)
            number, offset = pack(group.column("n_tokens").to_numpy(), capacity, cost)
            prefix = f"{group.column('group')[0].as_py()}:"
            names = pa.array([prefix + str(i) for i in number.tolist()], pa.string())
            out = group.select([identity, "part", "n_tokens"]).append_column("container", names)
            yield from out.append_column("position", pa.array(offset.astype(np.int32))).combine_chunks().to_batches()

        for batch in batches:
            groups_ = batch.column("group").to_numpy()
            edges = [0, *(np.flatnonzero(groups_[1:] != groups_[:-1]) + 1).tolist(), len(groups_)]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if start == end:
                    continue
                if held and held[0].column("group")[0].as_py() != int(groups_[start]):
                    yield from flush()
                    held = []
                held.append(batch.slice(start, end - start))
        if held:
            yield from flush()

    ordered = dealt.repartition("group").sortWithinPartitions("group", "n_tokens", identity, "part", "size", "copy")
    return ordered.mapInArrow(run, f"`{identity}` {kind}, part int, n_tokens int, container string, position int")


def check_packing(packed: DataFrame, capacity: int = CAPACITY, identity: str = "doc_id", tightness: float = 0.02) -> DataFrame:
    """One row of what a packing must keep, from the packing alone.

    n_items; overfull: containers that hold more than the capacity; overlapping: parts
    that begin before the one before them in their container has ended; gaps: parts that begin after that; wrongly_split: items in several parts
    although they would fit, or with a part but the last that isn't full; well_filled: whether there are at most a share
    of ``tightness`` more containers than the tokens need at least, and one more for each group.

    A container's parts are sorted within it; it has no more than its capacity.
    """
    in_order = Window.partitionBy("container").orderBy("position")
    ends = F.lag(F.col("position") + F.col("n_tokens"), 1, 0).over(in_order)
    placed = packed.withColumn("_gap", F.col("position") - ends)
    containers = placed.groupBy("container").agg(
        F.sum("n_tokens").alias("used"), F.count_if(F.col("_gap") < 0).alias("overlapping"), F.count_if(F.col("_gap") > 0).alias("gaps")
    )
    by_container = containers.agg(
        F.count_if(F.col("used") > capacity).alias("overfull"),
        F.coalesce(F.sum("overlapping"), F.lit(0)).alias("overlapping"),
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("gaps"),
        F.count(F.lit(1)).alias("n_containers"),
        F.count_distinct(F.substring_index("container", ":", 1)).alias("n_groups"),
        F.coalesce(F.sum("used"), F.lit(0)).alias("n_tokens"),
    )
    items = packed.groupBy(identity).agg(F.sum("n_tokens").alias("size"), F.max("part").alias("last"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("n_tokens") == capacity).alias("full"))
    fits = F.col("size") <= capacity
    wrong = (fits & (F.col("n") > 1)) | (~fits & ((F.col("n") != F.ceil(F.col("size") / capacity)) | (F.col("last") != F.col("n") - 1) | (F.col("full") < F.col("n") - 1)))
    by_item = items.agg(F.count(F.lit(1)).alias("n_items"), F.count_if(wrong).alias("wrongly_split"))
    least = F.ceil(F.col("n_tokens") / capacity)
    filled = (F.col("n_containers") <= F.ceil(least * (1 + tightness)) + F.col("n_groups")).alias("well_filled")
    split = [by_item.select(c).scalar().alias(c) for c in ("n_items", "wrongly_split")]
    return by_container.select(*split, "overfull", "overlapping", "gaps", filled)
