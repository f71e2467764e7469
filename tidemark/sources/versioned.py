"""A Parquet table with a commit log: declared schema, constraints, atomic commits, history, time travel.

Layout: ``data/<uuid>/part__=<part>/*.parquet`` and ``_log/<version>.json``. Which part a row lies in is an SQL
expression over its keys, fixed when the table is made. A log entry lists the folders of every part; a commit
writes new folders for the parts it changes and takes over the others' as they are. It becomes visible by an
operation that fails if the version exists; so readers see a whole version or none of it, and of two
writers at once one gets ConcurrentCommit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut, file_system
from tidemark.sources.log import CommitLog, ConcurrentCommit
from tidemark.sources.schemas import drift

__all__ = ["ConcurrentCommit", "ConstraintViolation", "SchemaMismatch", "VersionExpired", "VersionedTable", "find_tables"]

PART = "part__"
#: The only part of a table without a layout.
WHOLE = "all"


class SchemaMismatch(ValueError):
    """The table has a different schema."""


class ConstraintViolation(ValueError):
    """Rows to be committed break the table's contract; nothing was published."""


class VersionExpired(ValueError):
    """The version is in the log, but its rows were given up by ``expire``."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/_log")

    # the log

    def exists(self) -> bool:
        return self.log.exists()

    def versions(self) -> list[int]:
        return self.log.versions()

    def entry(self, version: int | None = None) -> dict:
        """The log entry of a version, the latest unless given; its number is under ``version``."""
        held = self.versions()
        if not held:
            raise FileNotFoundError(f"no table at {self.path}")
        version = held[-1] if version is None else version
        if version not in held:
            raise ValueError(f"{self.path} has no version {version}")
        return self.log.entry(version) | {"version": version}

    # reading

    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.entry()["schema"]))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the latest unless given; raises VersionExpired if some of them are gone."""
        entry = self.entry(version)
        for folder in (f for held in entry["parts"].values() for f in held) if version is not None else ():
            fs, at = file_system(self.spark, f"{self.path}/{folder}")
            if not fs.exists(at):
                raise VersionExpired(f"version {version} of {self.path} has expired")
        return self._rows(entry)

    def _rows(self, entry: dict, parts: Iterable[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        folders = [f for part, held in entry["parts"].items() if parts is None or part in parts for f in held]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def history(self) -> DataFrame:
        """version, timestamp, operation and metrics of every commit, read by Spark from the log itself."""
        kind = "timestamp timestamp, operation string, metrics map<string,long>"
        entries = self.spark.read.schema(kind).json(self.log.folder)
        version = F.regexp_extract("_metadata.file_name", r"^(\d+)\.json$", 1).cast("long")
        return entries.select(version.alias("version"), "timestamp", "operation", "metrics")

    def detail(self) -> DataFrame:
        """Number and size of the latest version's files."""
        entry, files, size = self.entry(), 0, 0
        for folder in (f for held in entry["parts"].values() for f in held):
            fs, at = file_system(self.spark, f"{self.path}/{folder}")
            for f in fs.listStatus(at):
                if f.getPath().getName().endswith(".parquet"):
                    files, size = files + 1, size + f.getLen()
        row = (self.path, entry["version"], len(entry["parts"]), files, size, datetime.fromisoformat(entry["timestamp"]))
        return self.spark.createDataFrame([row], "path string, version long, num_parts long, num_files long, size_in_bytes long, last_modified timestamp")

    def properties(self) -> DataFrame:
        """The table's constraints as key and value."""
        pairs = [(f"constraints.{k}", v) for k, v in self.entry()["constraints"].items()]
        return self.spark.createDataFrame(pairs, "key string, value string")

    # writing

    def ensure(self, schema: T.StructType, constraints: Mapping[str, str] | None = None, layout: str | None = None) -> bool:
        """Create the table in one commit with its schema, constraints and layout; False if it is there already.

        layout: an SQL expression that gives a row's part; it may use only columns that no merge changes for a
        key, so the keys themselves. An existing table with other columns or types raises SchemaMismatch.
        """
        if self.exists() and self.versions():
            held = drift(schema, self.schema())
            if held:
                raise SchemaMismatch(f"{self.path} has a different schema: {held}")
            return False
        self.log.create()
        self.log.publish(0, self._entry({"schema": schema.json(), "constraints": dict(constraints or {}), "layout": layout}, {}, "CREATE", {}))
        return True

    @staticmethod
    def _entry(kept: Mapping, parts: Mapping[str, Sequence[str]], operation: str, metrics: Mapping[str, int]) -> dict:
        now = datetime.now(UTC).replace(tzinfo=None).isoformat()
        return {"timestamp": now, **{k: kept[k] for k in ("schema", "constraints", "layout")}, "parts": dict(parts), "operation": operation, "metrics": dict(metrics)}

    @staticmethod
    def _part(entry: dict) -> Column:
        """A row's part, as a name that can stand in a path."""
        if entry["layout"] is None:
            return F.lit(WHOLE)
        return F.regexp_replace(F.coalesce(F.expr(entry["layout"]).cast("string"), F.lit("null")), "[^A-Za-z0-9.-]", "-")

    def _stage(self, rows: DataFrame, entry: dict) -> tuple[dict[str, str], int, str]:
        """Write rows to folders nothing refers to yet, by part, and check what was written.

        Rebalanced on the way: adaptive execution joins small partitions and splits large ones, so the number of
        files follows from their size, and what computes the rows keeps its own parallelism.
        """
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        held = drift(schema, rows.schema)
        if held:
            raise SchemaMismatch(f"rows for {self.path}: {held}")
        folder = f"data/{uuid.uuid4().hex}"
        placed = rows.select(*[f.name for f in schema.fields], self._part(entry).alias(PART))
        placed.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        fs, at = file_system(self.spark, f"{self.path}/{folder}")
        names = [f.getPath().getName() for f in fs.listStatus(at) if f.isDirectory()]
        parts = {n.removeprefix(f"{PART}="): f"{folder}/{n}" for n in names}
        written = self._rows(entry | {"parts": {p: [f] for p, f in parts.items()}})
        # counted over the files themselves, so a retried task counts once
        checks = {f"NOT NULL {f.name}": F.col(f.name).isNull() for f in schema.fields if not f.nullable}
        # as in SQL, a check that gives null is not violated
        checks |= {f"CHECK {name}": ~F.expr(text) for name, text in entry["constraints"].items()}
        found = written.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(c, 1)).alias(f"c{i}") for i, c in enumerate(checks.values())]).first()
        broken = [f"{name} ({found[f'c{i}']} rows)" for i, name in enumerate(checks) if found[f"c{i}"]]
        if broken:
            fs.delete(at, True)
            raise ConstraintViolation(f"{self.path}: " + ", ".join(broken))
        return parts, found["n"], folder

    def _commit(self, entry: dict, parts: Mapping[str, Sequence[str]], operation: str, metrics: Mapping[str, int], staged: str) -> int:
        """Publish the version after ``entry``'s; fails if anyone has published since that was read."""
        version = entry["version"] + 1
        try:
            self.log.publish(version, self._entry(entry, parts, operation, metrics))
        except ConcurrentCommit:
            fs, at = file_system(self.spark, f"{self.path}/{staged}")
            fs.delete(at, True)
            raise
        return version

    def append(self, rows: DataFrame, operation: str = "APPEND") -> int:
        """Add rows as one commit; returns their number. No rows, no commit."""
        entry = self.entry()
        made, n, staged = self._stage(rows, entry)
        if n:
            parts = {p: [*entry["parts"].get(p, []), *([made[p]] if p in made else [])] for p in entry["parts"].keys() | made.keys()}
            self._commit(entry, parts, operation, {"rows": n}, staged)
        else:
            fs, at = file_system(self.spark, f"{self.path}/{staged}")
            fs.delete(at, True)
        return n

    def merge(self, updates: DataFrame, transition: Callable[[DataFrame], DataFrame], operation: str, counted: Sequence[str], publishing: Sequence[str]) -> dict[str, int]:
        """Merge ``updates`` (with the table's key columns) as one commit; returns how often each change was made.

        transition: from the present rows to all rows that are to be, with ``_change`` naming what became of
        each (null: nothing). Only the parts that updates fall into are read, and only those in which a
        change of ``publishing`` was made are written; all other folders stay. Without any such change there is no
        commit. Lists of parts come to the driver, as long as the layout makes them. updates should be
        kept (see ``cut``), since it is read more than once.
        """
        entry = self.entry()
        part = self._part(entry)
        met = [r[0] for r in updates.select(part.alias("p")).distinct().collect()]
        after = cut(transition(self._rows(entry, met)))
        changes = after.where(F.col("_change").isNotNull()).groupBy(part.alias("p"), "_change").agg(F.count(F.lit(1)).alias("n")).collect()
        counts = {c: sum(r["n"] for r in changes if r["_change"] == c) for c in counted}
        touched = sorted({r["p"] for r in changes if r["_change"] in publishing})
        if touched:
            rows = after.drop("_change").where(part.isin(touched)) if len(touched) < len(met) else after.drop("_change")
            made, n, staged = self._stage(rows, entry)
            parts = {p: f for p, f in entry["parts"].items() if p not in touched} | {p: [f] for p, f in made.items()}
            self._commit(entry, parts, operation, {"rows": n, "parts": len(made), **counts}, staged)
        return counts


    def expire(self, keep: int = 1) -> int:
        """Remove the folders that only versions before the last ``keep`` use; returns their number.

        The log stays whole. Readers of an expired version fail, those of kept ones don't notice. Folders of commits that
        failed half-way, or are under way, aren't in the log and aren't touched.
        """
        versions = self.versions()
        folders = lambda some: {f for v in some for held in self.log.entry(v)["parts"].values() for f in held}
        kept = max(1, keep)
        gone = folders(versions[:-kept]) - folders(versions[-kept:])
        removed = 0
        for folder in sorted(gone):
            fs, at = file_system(self.spark, f"{self.path}/{folder}")
            removed += bool(fs.delete(at, True))
        return removed


def find_tables(spark: SparkSession, root: str) -> DataFrame:
    """name and path of every table under a folder; tables aren't searched for further tables."""
    fs, _ = file_system(spark, root)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    found, waiting = [], [root.rstrip("/")]
    while waiting:
        folder = waiting.pop()
        if not fs.exists(hadoop(folder)):
            continue
        if fs.exists(hadoop(f"{folder}/_log")):
            found.append((folder[len(root.rstrip("/")) + 1 :], folder))
            continue
        waiting += [f"{folder}/{f.getPath().getName()}" for f in fs.listStatus(hadoop(folder)) if f.isDirectory()]
    return spark.createDataFrame(sorted(found), "name string, path string")
