"""Consolidation of very many small files into a few well-sized ones."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import folded
from tidemark.session import cut, file_system, staging_path

#: Below this a file is small.
SMALL_BYTES = 49_152
#: Size to aim at for the files written.
TARGET_BYTES = 128 * 1024 * 1024
#: What opening a file costs, in bytes that could be read meanwhile.
OPEN_COST = 4 * 1024 * 1024


@dataclass(frozen=True)
class Packing:
    """How the engine should combine input splits and how many files to write."""

    max_partition_bytes: int
    open_cost: int
    files_out: int


def file_list(files: DataFrame, rows_per_file: DataFrame) -> DataFrame:
    """``file_id, size_bytes, n_rows`` of the files a dataset consists of; rows_per_file: ``file_id, n_rows``.

    Those are the files that committed (case and outer blanks of ``status`` don't matter) and hold at
    least one row; one row per file, the largest size of a file listed more than once.
    """
    committed = files.where(folded(F.col("status")) == "committed").groupBy("file_id").agg(F.max("size_bytes").alias("size_bytes"))
    return committed.join(rows_per_file, "file_id").select("file_id", "size_bytes", "n_rows")


def small_files(listed: DataFrame, small_bytes: int = SMALL_BYTES) -> DataFrame:
    return listed.where(F.col("size_bytes") < small_bytes)


def packing(n_files: int, total_bytes: int, cores: int, target: int = TARGET_BYTES, open_cost: int = OPEN_COST) -> Packing:
    """Split packing by the engine's own rule, tuned to the files at hand.

    The engine fills a split until its bytes plus an open cost per file reach max_partition_bytes. With
    the default open cost a split of 4 KB files would hold 32 of them; so the cost is lowered to the
    files' mean size (64 KB at least), and the split may be as large as the file to be written, but not so
    large that cores stay idle.
    """
    mean = total_bytes // max(n_files, 1)
    cost = max(64 * 1024, min(open_cost, mean))
    padded = total_bytes + n_files * cost
    split = max(1024 * 1024, min(target, math.ceil(padded / max(cores, 1))))
    return Packing(split, cost, max(1, math.ceil(total_bytes / target)))


def _tuned(spark: SparkSession, plan: Packing) -> SparkSession:
    """A session of the same application with the split settings; the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.files.maxPartitionBytes", str(plan.max_partition_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(plan.open_cost))
    return own


def _sums(rows: DataFrame) -> list[Column]:
    """Number of rows and sums over a hash of them that any lost, added or changed row alters, whatever the order."""
    columns = [F.col(f"`{c}`") for c in sorted(rows.columns)]
    # the hash passes over nulls, so where they are is hashed too
    hashed = F.xxhash64(*columns, F.array(*[c.isNull() for c in columns]))
    # summed in halves as decimals, which don't overflow
    halves = {"high": F.shiftright(hashed, 32), "low": hashed.bitwiseAND(0xFFFFFFFF)}
    return [F.count(F.lit(1)).alias("n"), *[F.sum(h.cast("decimal(38,0)")).alias(name) for name, h in halves.items()]]


def fingerprint(rows: DataFrame) -> dict:
    return rows.agg(*_sums(rows)).first().asDict()


class VerificationError(RuntimeError):
    """The files written don't hold exactly the rows read."""


def compact(
    spark: SparkSession,
    source: str,
    target: int = TARGET_BYTES,
    open_cost: int = OPEN_COST,
    destination: str | None = None,
    counted_by: Sequence[str] = (),
    also: Mapping[str, Column] | None = None,
) -> tuple[str, dict, DataFrame | None]:
    """Rewrite the Parquet dataset at ``source`` as few well-sized files; returns their folder, figures and counts.

    Two passes. Combined splits are read with settings from ``packing``, joined by coalesce without a shuffle and
    written to a staging folder; the number of rows and an order-free hash over all columns are taken of the
    rows on their way. Then what was written is read back, and its number and hash must be the same, else
    VerificationError is raised and the staged files are removed. That pass also counts rows by
    ``counted_by`` (None without): as many counts as there are values. ``also`` names further sums for each.

    Without ``destination`` the copy is staged and goes with the application; with it, it stays, and a reader switches
    by taking that folder. The source is never touched. Repeated rows are rows like any other. An empty
    source gives one empty file.
    """
    fs, path = file_system(spark, source)
    summary = fs.getContentSummary(path)
    total, n_files = summary.getLength(), summary.getFileCount()
    plan = packing(n_files, total, spark.sparkContext.defaultParallelism, target, open_cost)
    own = _tuned(spark, plan)
    rows = own.read.parquet(source)
    staged = destination or staging_path(spark, "compacted")
    splits = rows.rdd.getNumPartitions()
    seen = Observation()
    rows.observe(seen, *_sums(rows)).coalesce(max(1, min(plan.files_out, splits))).write.parquet(staged)
    before = seen.get

    written = own.read.parquet(staged)
    counts = None
    if counted_by:
        more = also or {}
        per_value = cut(written.groupBy(*counted_by).agg(*_sums(written), *[c.alias(f"_{name}") for name, c in more.items()]))
        counts = per_value.select(*counted_by, F.col("n").alias("n_rows"), *[F.col(f"_{name}").alias(name) for name in more])
        # a group's sums add up to those of the whole
        after = per_value.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("high", "low")]).first().asDict()
    else:
        after = fingerprint(written)
    out_fs, out_path = file_system(spark, staged)
    if before != after:
        out_fs.delete(out_path, True)
        raise VerificationError(f"read {before}, wrote {after}")
    parts = [f for f in out_fs.listStatus(out_path) if f.getPath().getName().endswith(".parquet")]
    figures = {"rows": after["n"], "files_in": n_files, "files_out": len(parts), "bytes_in": total, "splits": splits}
    return staged, figures | {"bytes_out": sum(f.getLen() for f in parts)}, counts
