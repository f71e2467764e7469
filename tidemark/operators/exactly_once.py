"""One copy of every message that was delivered at least once.

A ``MessageStore`` remembers the identifiers of all messages accepted so far: on disk, by span of arrival
(a bucket) and by hash (a shard), with a Bloom filter for each. A delivery is screened by the filters alone;
an identifier that none of them knows is definitely new. The few that some filter may know are looked up
exactly, in the storage of just the buckets whose filters answered.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import broadcast_if_small
from tidemark.session import file_system, staging_path
from tidemark.sources.log import CommitLog

#: Days of arrival that share a bucket.
BUCKET_DAYS = 90
#: Bits an identifier takes at least, and probes: at most one false alarm in some two thousand per filter.
BITS, PROBES = 16, 8
#: Rows of a delivery that one shard should screen, on average. A task holds its shard's filters (16 to 32 bits for
#: every identifier accepted) and 8 bytes for each new one of the bucket now filling; identifiers themselves never.
SHARD_ROWS = 2_000_000

#: Kinds of rows: filters come first in a task; the others say what screening found.
FILTER, ROW, NEW, SUSPECT, REPEAT = range(5)
_COLUMNS = {
    "kind": pa.int32(), "bucket": pa.int64(), "id": pa.int64(), "arrival": pa.int64(), "hash": pa.int64(),
    "key": pa.string(), "hits": pa.list_(pa.int64()), "bits": pa.binary(),
}
_SCHEMA = "kind int, bucket long, id long, arrival long, hash long, key string, hits array<long>, bits binary"


class Bloom:
    """A Bloom filter over 64-bit hashes, whole arrays at a time."""

    def __init__(self, items: int = 0, content: bytes | None = None, bits: int = BITS, probes: int = PROBES):
        size = max(8192, 1 << int(np.ceil(np.log2(max(items, 1) * bits))))
        self.bits = np.zeros(size >> 3, np.uint8) if content is None else np.frombuffer(content, np.uint8)
        self.size, self.probes = len(self.bits) << 3, probes

    def _places(self, hashes: np.ndarray, probe: int) -> np.ndarray:
        step = (hashes >> np.uint64(33)) | np.uint64(1)
        return (hashes + np.uint64(probe) * step) & np.uint64(self.size - 1)

    def add(self, hashes: np.ndarray) -> None:
        for probe in range(self.probes):
            at = self._places(hashes, probe)
            np.bitwise_or.at(self.bits, at >> np.uint64(3), (1 << (at & np.uint64(7))).astype(np.uint8))

    def might_contain(self, hashes: np.ndarray) -> np.ndarray:
        """A flag per hash; the places still undecided shrink with every probe."""
        left = np.arange(len(hashes))
        for probe in range(self.probes):
            at = self._places(hashes[left], probe)
            left = left[(self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            if not len(left):
                break
        out = np.zeros(len(hashes), bool)
        out[left] = True
        return out


class Screen:
    """One shard's filters by bucket, while the rows of a delivery pass in order of arrival."""

    def __init__(self, bits: int = BITS, probes: int = PROBES) -> None:
        self.made = {"bits": bits, "probes": probes}
        self.filters: dict[int, list[Bloom]] = {}
        self.bucket: int | None = None
        self.hashes: list[np.ndarray] = []
        self.filling: list[Bloom] = []
        self.room = 0

    def know(self, bucket: int, content: bytes) -> None:
        self.filters.setdefault(bucket, []).append(Bloom(content=content, **self.made))

    def check(self, hashes: np.ndarray) -> tuple[np.ndarray, dict[int, list[int]]]:
        """Rows of the open bucket that are definitely new, and of every other row the buckets that may know it."""
        hits: dict[int, list[int]] = {}
        repeated = np.ones(len(hashes), bool)
        repeated[np.unique(hashes, return_index=True)[1]] = False  # the same hash further up
        for bucket in self.filters.keys() | {self.bucket}:
            known = repeated.copy() if bucket == self.bucket else np.zeros(len(hashes), bool)
            for one in self.filters.get(bucket, []) + (self.filling if bucket == self.bucket else []):
                known |= one.might_contain(hashes)
            for row in np.flatnonzero(known).tolist():
                hits.setdefault(row, []).append(bucket)
        fresh = np.ones(len(hashes), bool)
        fresh[list(hits)] = False
        self._add(hashes[fresh])
        return np.flatnonzero(fresh), hits

    def _add(self, hashes: np.ndarray) -> None:
        """Into filters of growing size; ``close`` puts one of the right size in their place."""
        self.hashes.append(hashes)
        if len(hashes) > self.room:
            self.room = max(1 << 14, len(hashes), 2 * sum(map(len, self.hashes)))
            self.filling.append(Bloom(self.room, **self.made))
        if len(hashes):
            self.filling[-1].add(hashes)
        self.room -= len(hashes)

    def close(self) -> tuple[int, int, bytes] | None:
        """Finish the open bucket; its number, one of its hashes and its filter, if anything new was in it."""
        hashes = np.concatenate(self.hashes) if self.hashes else np.zeros(0, np.uint64)
        bucket, self.bucket, self.hashes, self.filling, self.room = self.bucket, None, [], [], 0
        if bucket is None or not len(hashes):
            return None
        whole = Bloom(len(hashes), **self.made)
        whole.add(hashes)
        self.filters.setdefault(bucket, []).append(whole)
        return bucket, hashes[:1].view(np.int64)[0].item(), whole.bits.tobytes()


def _rows(n: int, **columns: object) -> pa.RecordBatch:
    """A batch with all columns, those not given null."""
    arrays = []
    for name, kind in _COLUMNS.items():
        value = columns.get(name)
        if isinstance(value, int):
            value = np.full(n, value)
        arrays.append(pa.nulls(n, kind) if value is None else value if isinstance(value, pa.Array) else pa.array(value, kind))
    return pa.RecordBatch.from_arrays([a.cast(k) for a, k in zip(arrays, _COLUMNS.values(), strict=True)], names=list(_COLUMNS))


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each run of equal values."""
    if not len(values):
        return
    edges = np.flatnonzero(values[1:] != values[:-1]) + 1
    yield from zip([0, *edges.tolist()], [*edges.tolist(), len(values)], strict=True)


def _screened(batches: Iterator[pa.RecordBatch], bits: int, probes: int) -> Iterator[pa.RecordBatch]:
    """What the filters say of each row of a shard; filters come first, then rows in order of arrival.

    Results are gathered over batches, since what is found in one is little.
    """
    screen, held = Screen(bits, probes), []

    def finished() -> Iterator[pa.RecordBatch]:
        done = screen.close()
        if done is not None:
            yield _rows(1, kind=FILTER, bucket=done[0], hash=done[1], bits=[done[2]])

    for batch in batches:
        for start, end in _runs(batch.column("kind").to_numpy()):
            part = batch.slice(start, end - start)
            kind = part.column("kind")[0].as_py()
            if kind == FILTER:
                # a filter comes as text in place of a key: null columns of lists and bytes beside every row cost more than all else
                for bucket, content in zip(part.column("bucket").to_pylist(), part.column("key").to_pylist(), strict=True):
                    screen.know(bucket, base64.b64decode(content))
                continue
            if kind == REPEAT:
                held.append(_rows(len(part), kind=REPEAT, bucket=-1, id=part.column("id")))
                continue
            for first, last in _runs(part.column("bucket").to_numpy()):
                stretch = part.slice(first, last - first)
                number = stretch.column("bucket")[0].as_py()
                if number != screen.bucket:
                    held += finished()
                    screen.bucket = number
                fresh, hits = screen.check(stretch.column("hash").to_numpy().view(np.uint64))
                taken = stretch.take(pa.array(fresh))
                held.append(_rows(len(fresh), kind=NEW, bucket=taken.column("bucket"), key=taken.column("key")))
                if hits:
                    taken = stretch.take(pa.array(list(hits)))
                    again = {c: taken.column(c) for c in ("id", "arrival", "hash", "key")}
                    held.append(_rows(len(hits), kind=SUSPECT, bucket=-1, hits=list(hits.values()), **again))
        if sum(map(len, held)) > 20_000:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    held += finished()
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _gathered(batches: Iterator[pa.RecordBatch], bits: int, probes: int) -> Iterator[pa.RecordBatch]:
    """A shard's stored identifiers, sorted by bucket, again, and one filter for each bucket."""
    bucket, hashes = None, []

    def finished() -> Iterator[pa.RecordBatch]:
        if hashes:
            own = np.concatenate(hashes)
            whole = Bloom(len(own), bits=bits, probes=probes)
            whole.add(own)
            yield _rows(1, kind=FILTER, bucket=bucket, hash=own[:1].view(np.int64)[0].item(), bits=[whole.bits.tobytes()])

    for batch in batches:
        for start, end in _runs(batch.column("bucket").to_numpy()):
            part = batch.slice(start, end - start)
            number = part.column("bucket")[0].as_py()
            if number != bucket:
                yield from finished()
                bucket, hashes = number, []
            hashes.append(part.column("hash").to_numpy().view(np.uint64))
            yield _rows(len(part), kind=NEW, bucket=part.column("bucket"), key=part.column("key"))
    yield from finished()


def _local_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a key, each marked if the same batch holds an earlier one of its key."""
    for batch in batches:
        batch = batch.filter(batch.column("key").is_valid())
        table = pa.Table.from_batches([batch]).append_column("row", pa.array(np.arange(len(batch), dtype=np.int64)))
        order = np.lexsort((batch.column("id").to_numpy(), batch.column("arrival").to_numpy()))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        table = table.append_column("rank", pa.array(rank))
        first = table.group_by("key").aggregate([("rank", "min")]).column("rank_min").to_numpy()
        kept = np.zeros(len(order), bool)
        kept[order[first]] = True
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(~kept)], names=[*batch.schema.names, "repeated"])


class MessageStore:
    """The identifiers accepted so far, in a folder all executors see.

    ``<delivery>/kind=<kind>/bucket=<bucket>/part-*.parquet``, a file per shard, for every delivery the log lists. The number of
    shards is set when the store is made and must suit all it will ever hold: 16 to 32 bits for each
    identifier of a shard are read by one task. It is kept with the store, and so is how filters are made, since a filter
    must be asked as it was filled.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int = 64, bucket_days: int = BUCKET_DAYS, bits: int = BITS, probes: int = PROBES):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/_log")
        if not self.log.versions():
            self.log.create()
            self.log.publish(0, {"shards": shards, "bucket_days": bucket_days, "bits": bits, "probes": probes, "folders": []})
        made = self.log.entry(0)
        self.shards, self.bucket_days, self.bits, self.probes = (made[k] for k in ("shards", "bucket_days", "bits", "probes"))
        #: What the last delivery did: buckets whose storage was read.
        self.buckets_read: list[int] = []

    def _read(self, folders: Sequence[str], kind: int, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Staged rows of a kind, of some buckets only; None if there are none. Only folders that hold them are listed."""
        paths = []
        for folder in folders:
            fs, at = file_system(self.spark, f"{folder}/kind={kind}")
            if fs.exists(at):
                held = [int(f.getPath().getName().removeprefix("bucket=")) for f in fs.listStatus(at)]
                paths += [f"{folder}/kind={kind}/bucket={b}" for b in held if buckets is None or b in buckets]
        if not paths:
            return None
        schema = ", ".join(c for c in _SCHEMA.split(", ") if c.split()[0] not in ("kind", "bucket"))
        bucket = F.regexp_extract("_metadata.file_path", r"/bucket=(-?\d+)/", 1).cast("long")
        return self.spark.read.schema(schema).parquet(*paths).withColumn("bucket", bucket)

    def deliver(self, rows: DataFrame, key: Column, arrival: Column, identity: str) -> DataFrame:
        """The ``identity`` of every row that is a copy of a message accepted before, in this delivery or an earlier one.

        rows: one row per delivered copy; ``identity`` is a unique long column. key: a string expression that
        is equal exactly for copies of one message; a null key is a message of its own, never a repeat.
        arrival: a timestamp; within the delivery the earliest row, then the one with the smallest identity,
        is kept (a null arrival counts as the latest). What an earlier delivery kept stays kept. Extra
        columns don't matter; an empty delivery gives no rows.

        1. Within each Arrow batch of the scan, every row of a message but the earliest is known to be a
           repeat; it goes on without its key, so a message delivered any number of times sends at most one
           row per batch to its shard.
        2. Rows are partitioned by hash, one shard a task, behind the shard's filters, and sorted by arrival. A
           row that no filter knows is new: its identifier is stored, its hash goes into the filter of the
           bucket now filling. The others are suspects and take the numbers of the buckets that answered.
        3. Only those buckets' storage, nothing but identifiers, is read, and suspects are looked up in it.
           One that isn't there was a false alarm: the earliest row of its message is kept and stored
           in a bucket that answered, where it will be found from now on.
        The delivery becomes part of the store when its log entry is published; a delivery that fails leaves
        the store as it was and can be repeated. Of two at once one gets ConcurrentCommit.
        """
        version = self.log.versions()[-1]
        known = self.log.entry(version)["folders"]
        folder = f"{self.path}/{uuid.uuid4().hex}"
        try:
            self._screen(rows, key, arrival, identity, known, folder)
            found, late = self._verify(known, folder)
            self.log.publish(version + 1, {"folders": [*known, folder, *late]})
        except Exception:
            for made in (folder, f"{folder}-late"):
                fs, at = file_system(self.spark, made)
                fs.delete(at, True)
            raise
        return found.select(F.col("id").alias(identity))

    def consolidate(self) -> None:
        """Rewrite the store as if all had come in one delivery: one filter and one file for each bucket and shard.

        Many small deliveries leave many small filters, each of which every row is checked against. False alarms stored late
        become part of the filter of their bucket. What was there before stays until the new state is published, then
        it is removed.
        """
        version = self.log.versions()[-1]
        known = self.log.entry(version)["folders"]
        stored = self._read(known, NEW)
        if stored is None:
            return
        folder, bits, probes = f"{self.path}/{uuid.uuid4().hex}", self.bits, self.probes
        rows = stored.select("bucket", F.xxhash64("key").alias("hash"), "key").repartition(self.shards, "hash").sortWithinPartitions("bucket")
        rows.mapInArrow(lambda batches: _gathered(batches, bits, probes), _SCHEMA).write.partitionBy("kind", "bucket").parquet(folder)
        self.log.publish(version + 1, {"folders": [folder]})
        for old in known:
            fs, at = file_system(self.spark, old)
            fs.delete(at, True)

    def _screen(self, rows: DataFrame, key: Column, arrival: Column, identity: str, known: list[str], folder: str) -> None:
        micros = F.coalesce(F.unix_micros(arrival), F.lit(2**62))
        # rows without a key are left out in Python: a filter here would compute the key twice
        narrow = rows.select(F.col(identity).cast("long").alias("id"), key.alias("key"), micros.alias("arrival"))
        marked = narrow.mapInArrow(_local_repeats, "id long, key string, arrival long, repeated boolean")
        settled = F.col("repeated")
        routed = marked.select(
            F.when(settled, F.lit(REPEAT)).otherwise(F.lit(ROW)).alias("kind"),
            F.floor(F.col("arrival") / (self.bucket_days * 86_400_000_000)).cast("long").alias("bucket"),
            "id",
            "arrival",
            F.xxhash64(F.when(settled, F.col("id").cast("string")).otherwise(F.col("key"))).alias("hash"),
            F.when(~settled, F.col("key")).alias("key"),
        )
        filters = self._read(known, FILTER)
        if filters is not None:  # routed by one of their own hashes, so each meets the rows of its shard
            routed = routed.unionByName(filters.select(F.lit(FILTER).alias("kind"), "bucket", "id", "arrival", "hash", F.base64("bits").alias("key")))
        ordered = routed.repartition(self.shards, "hash").sortWithinPartitions("kind", "arrival", "id")
        bits, probes = self.bits, self.probes
        ordered.mapInArrow(lambda batches: _screened(batches, bits, probes), _SCHEMA).write.partitionBy("kind", "bucket").parquet(folder)

    def _verify(self, known: list[str], folder: str) -> tuple[DataFrame, list[str]]:
        repeats, suspects = self._read([folder], REPEAT), self._read([folder], SUSPECT)
        none = self.spark.createDataFrame([], "id long")
        repeats = none if repeats is None else repeats.select("id")
        self.buckets_read = []
        if suspects is None:
            return repeats, []
        # as many as there are spans of time
        answered = [r[0] for r in suspects.select(F.explode("hits").alias("b")).distinct().collect()]
        self.buckets_read = sorted(answered)
        stored = self._read([*known, folder], NEW, answered)
        asked = suspects.groupBy("key").agg(F.min(F.struct("arrival", "id", F.array_min("hits").alias("bucket"))).alias("first"))
        if stored is not None:
            there = stored.select("key").join(broadcast_if_small(asked.select("key")), "key", "left_semi")
            asked = asked.join(there, "key", "left_anti")
        late = f"{folder}-late"
        alarms = asked.select(F.lit(NEW).alias("kind"), F.col("first.bucket").alias("bucket"), F.col("first.id").alias("id"), "key")
        alarms.write.partitionBy("kind", "bucket").parquet(late)
        kept = self._read([late], NEW)
        if kept is None:
            return repeats.union(suspects.select("id")), []
        return repeats.union(suspects.select("id").join(broadcast_if_small(kept.select("id")), "id", "left_anti")), [late]


def repeats(rows: DataFrame, key: Column, arrival: Column, identity: str, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """The ``identity`` of every row that is not the first of its message: one delivery to a store of its own.

    The store has as many shards as the rows need; see ``MessageStore.deliver`` for everything else.
    """
    spark = rows.sparkSession
    wanted = -(-rows.count() // SHARD_ROWS)  # answered from the files' footers or a narrow scan
    shards = max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")) if wanted > 1 else spark.sparkContext.defaultParallelism)
    return MessageStore(spark, staging_path(spark, "messages"), shards, bucket_days).deliver(rows, key, arrival, identity)


def message_key(response_id: Column, source: Column, without: list[Column]) -> Column:
    """The identity of a delivered message as text.

    Of a source, rows whose response_id agrees but for case, hyphens and outer blanks are one message;
    where it is null or blank, rows that agree in all of ``without`` are, nulls being equal.
    """
    spelled = F.lower(F.regexp_replace(response_id, r"^\s+|\s+$|-", ""))
    given = F.coalesce(spelled, F.lit("")) != ""
    options = {"ignoreNullFields": "false"}
    by_id = F.to_json(F.array(source, spelled), options)
    by_request = F.to_json(F.array(source, F.lit(None).cast("string"), *[c.cast("string") for c in without]), options)
    return F.when(given, by_id).otherwise(by_request)
