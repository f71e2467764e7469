"""Command-line jobs over a lake folder; each returns its exit code.

    python -m tidemark.jobs JOB --root FOLDER [options]
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import symbology
from tidemark.functions.sessions import default_range, session_days, sessions
from tidemark.operators import latest_wins, payload, quality, reconcile, scd2
from tidemark.session import cut, get_spark
from tidemark.sources import schemas, vendors
from tidemark.sources.vendors import Manner, RecordedFolder, Transport
from tidemark.sources.versioned import VersionedTable

SOURCES = ("alpaca", "yahoo")


class Lake:
    """The tables under one root: reference, bronze and silver."""

    def __init__(self, spark: SparkSession, root: str, shares: int = 1, master_parts: int = 16):
        """shares, master_parts: parts that a month of bars and the master are made of, set when the tables are."""
        self.spark, self.root, self.shares, self.master_parts = spark, root, shares, master_parts

    def at(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}")

    @property
    def master(self) -> VersionedTable:
        return self.at("reference/security_master")

    def bronze(self, source: str) -> VersionedTable:
        return self.at(f"bronze/{source}_bars")

    @property
    def bars(self) -> VersionedTable:
        return self.at("silver/daily_bars")

    @property
    def actions(self) -> VersionedTable:
        return self.at("silver/corporate_actions")


def _now() -> datetime:
    return datetime.now(UTC).replace(microsecond=0, tzinfo=None)


def gather(spark: SparkSession, figis: DataFrame, sec_content: DataFrame, transports: dict[str, Transport], manner: Manner | None = None) -> dict[str, DataFrame]:
    """The four frames of a build: every FIGI looked up, then yfinance and alpaca asked about those that were found.

    figis: security_id. transports: ``mapping``, ``yfinance`` and perhaps ``alpaca``; without one for alpaca every
    lookup there has failed, which leaves what is known of it as it was.
    """
    ask_with = {} if manner is None else {"manner": manner}
    jobs = figis.select("security_id", vendors.figi_job(F.col("security_id")).alias("job"))
    figi = cut(reconcile.figi_lookup(vendors.map_jobs(jobs, transports["mapping"], **ask_with)))
    known = reconcile.resolvable(figi)

    def questions(source: str, symbol: Column) -> DataFrame:
        return known.select(F.lit(source).alias("source"), "security_id", symbol.alias("vendor_symbol"), F.create_map(F.lit("symbol"), symbol).alias("params"))

    t = F.col("exchange_ticker")
    yahoo = reconcile.yahoo_info(vendors.ask(questions("yfinance", symbology.to_yahoo(t)), transports["yfinance"], **ask_with))
    if "alpaca" in transports:
        alpaca = reconcile.alpaca_assets(vendors.ask(questions("alpaca", symbology.to_alpaca(t)), transports["alpaca"], **ask_with))
    else:
        alpaca = known.select("security_id", F.lit("no API key configured").alias("alpaca_error"))
    return {"figi": figi, "sec": reconcile.sec_tickers(sec_content), "yfinance": cut(yahoo), "alpaca": cut(alpaca)}


def build_security_master(lake: Lake, frames: dict[str, DataFrame], observed_at: datetime | None = None) -> int:
    """Reconcile figi, sec, yfinance and alpaca frames and merge the result; 1 if anything was quarantined.

    Entries of sec that fold to one key stop the build. Before the first build there is no previous version.
    """
    table = lake.master
    scd2.ensure_table(table, schemas.MASTER_ATTRIBUTES, "security_id", lake.master_parts)
    previous = read_current(lake)
    resolved, quarantined = reconcile.build_snapshot(frames["figi"], reconcile.distinct_sec_tickers(frames["sec"]), frames["yfinance"], frames["alpaca"], previous)
    resolved, quarantined = cut(resolved), cut(quarantined)
    print(scd2.merge_snapshot(table, resolved, "security_id", observed_at or _now()))
    for name, rows in reconcile.report(resolved, quarantined, frames["yfinance"], frames["alpaca"]).items():
        for row in rows.toLocalIterator():  # all of them, a partition at a time
            print(name, *row)
    return int(not quarantined.isEmpty())


def read_current(lake: Lake) -> DataFrame | None:
    """The open versions of the master, None before the first build."""
    table = lake.master
    if not table.exists() or not table.entry()["parts"]:
        return None
    return scd2.current(table.read())


def inspect_security_master(lake: Lake) -> int:
    """Counts of the master, and whether every security has exactly one open version."""
    history = lake.master.read()
    history.agg(F.count(F.lit(1)).alias("versions"), F.count_distinct("security_id").alias("securities"), F.count_distinct("issuer_id").alias("issuers")).show()
    scd2.changed_keys(history, "security_id").orderBy(F.desc("n_versions"), "security_id").show()
    code = 0
    for row in scd2.broken_keys(history, "security_id").toLocalIterator():  # all of them, a partition at a time
        print("broken", row["security_id"], row["n_open"])
        code = 1
    return code


def load_bronze(lake: Lake, source: str, start: date, end: date, transport: Transport, run_id: str | None = None, manner: Manner | None = None) -> int:
    """Append the vendor's responses for the securities of the master; 0 without a session, 1 on an empty master or a failure.

    Every security is asked about once; answers and failures are of the same pass.
    """
    if not session_days(start, end):
        print("no sessions")
        return 0
    master = read_current(lake)
    if master is None or master.isEmpty():
        print("the master is empty")
        return 1
    at = _now()
    securities = master.select("security_id", reconcile.vendor_symbol(source).alias("vendor_symbol"))
    requests = vendors.bar_requests(securities, source, start, end)
    fetched = cut(vendors.fetch(requests, transport, manner or Manner()))
    table = lake.bronze(source)
    table.ensure(schemas.BRONZE)
    print(table.append(vendors.responses(fetched, at, run_id or f"manual__{at:%Y%m%dT%H%M%S}")), "responses")
    code = 0
    for row in vendors.failures(fetched).toLocalIterator():
        print("failed", row["security_id"], row["error"])
        code = 1
    return code


def build_silver(lake: Lake, start: date, end: date) -> int:
    """Parse the deliveries whose range meets start..end and merge bars and actions of those dates."""
    first, last = F.lit(start), F.lit(end)
    lake.bars.ensure(schemas.BARS, layout=schemas.BAR_LAYOUT.format(shares=lake.shares))
    lake.actions.ensure(schemas.ACTIONS)
    for source in SOURCES:
        table = lake.bronze(source)
        if not table.exists():
            continue
        numbered = payload.overlapping(table.read(), first, last).withColumn("bronze_id", F.monotonically_increasing_id())
        delivered = payload.delivered_bars(numbered)
        rows = payload.in_range(payload.bars(delivered), "trade_date", first, last)
        print(source, "bars", latest_wins.merge_latest(lake.bars, rows, schemas.BAR_KEYS, schemas.BAR_VALUES))
        found = payload.in_range(payload.actions(delivered), "ex_date", first, last)
        print(source, "actions", latest_wins.merge_latest(lake.actions, found, schemas.ACTION_KEYS, ["value"]))
    return 0


def check_completeness(lake: Lake, start: date, end: date) -> int:
    """1 if a bar of a current security is missing on a session of the range."""
    days = sessions(lake.spark, start, end)
    if not session_days(start, end):
        return 0
    there = payload.in_range(lake.bars.read(), "trade_date", F.lit(start), F.lit(end))
    master = read_current(lake)
    if master is None:
        print("the master is empty")
        return 1
    missing = quality.missing_bars(master, days, SOURCES, there)
    counts = missing.groupBy("trade_date", "source").agg(F.count(F.lit(1)).alias("n_missing")).orderBy("trade_date", "source")
    found = counts.collect()  # as many as the calendar has sessions, times the sources
    for row in found:
        print(row["trade_date"], row["source"], row["n_missing"], "missing")
    return int(bool(found))


def load_reorganizations(lake: Lake, filings: DataFrame) -> int:
    """Merge filings (security_id, effective_date, accession, accepted_at) as actions; running it again changes nothing."""
    lake.actions.ensure(schemas.ACTIONS)
    rows = filings.select(
        "security_id",
        F.col("effective_date").alias("ex_date"),
        F.lit("reorg").alias("action_type"),
        F.lit("sec_edgar").alias("source"),
        F.lit(None).cast("decimal(18,6)").alias("value"),
        F.col("accepted_at").alias("source_ingested_at"),
        F.col("accession").alias("source_run_id"),
    )
    print(latest_wins.merge_latest(lake.actions, rows, schemas.ACTION_KEYS, ["value"]))
    return 0


def backfill(steps: list[tuple[str, Callable[[], int]]]) -> int:
    """Run all steps, whatever becomes of one; 1 if any failed."""
    failed = []
    for name, step in steps:
        try:
            code = step()
        except Exception as error:  # noqa: BLE001 - a step must not stop the next ones
            print(name, type(error).__name__, error)
            code = 1
        if code:
            failed.append(name)
    print("failed:", *failed or ["none"])
    return int(bool(failed))


def resolve(answers: DataFrame) -> int:
    """Print what tickers stand for, as the mapping service answered; 1 if one needs a human."""
    code = 0
    for row in reconcile.resolved_tickers(answers).toLocalIterator():
        if row["problem"]:
            print(row["ticker"], row["problem"], file=sys.stderr)
            code = 1
        else:
            print(row["composite_figi"], row["ticker"], row["security_name"])
    return code


def check_labels(answers: DataFrame, labels: DataFrame) -> int:
    """Print labels that no longer hold, as the mapping service answered about their FIGIs; 1 if there are any."""
    code = 0
    for row in reconcile.stale_labels(answers, labels).toLocalIterator():
        print(row["security_id"], row["label"], row["problem"], row["current_ticker"] or "", file=sys.stderr)
        code = 1
    return code


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["inspect_security_master", "build_security_master", "load_bronze", "build_silver", "check_completeness", "load_reorganizations", "backfill", "resolve", "check_labels"])
    parser.add_argument("--root", required=True)
    parser.add_argument("--source", choices=SOURCES)
    parser.add_argument("--start", type=date.fromisoformat)
    parser.add_argument("--end", type=date.fromisoformat)
    parser.add_argument("--recordings", help="folder of recorded vendor responses")
    parser.add_argument("--frames", help="folder with figi, sec, yfinance, alpaca, reorganizations, answers or labels as Parquet")
    args = parser.parse_args(argv)
    spark = get_spark()
    lake = Lake(spark, args.root)
    start, end = default_range(datetime.now(UTC).date())
    start, end = args.start or start, args.end or end
    frame = lambda name: spark.read.parquet(os.path.join(args.frames, f"{name}.parquet"))
    jobs: dict[str, Callable[[], int]] = {
        "inspect_security_master": lambda: inspect_security_master(lake),
        "build_security_master": lambda: build_security_master(lake, {n: frame(n) for n in ("figi", "sec", "yfinance", "alpaca")}),
        "load_bronze": lambda: load_bronze(lake, args.source, start, end, RecordedFolder(args.recordings)),
        "build_silver": lambda: build_silver(lake, start, end),
        "check_completeness": lambda: check_completeness(lake, start, end),
        "load_reorganizations": lambda: load_reorganizations(lake, frame("reorganizations")),
        "resolve": lambda: resolve(frame("answers")),
        "check_labels": lambda: check_labels(frame("answers"), frame("labels")),
    }
    loads = [(f"load_bronze {s}", lambda s=s: load_bronze(lake, s, start, end, RecordedFolder(args.recordings))) for s in SOURCES]
    rest = [(n, jobs[n]) for n in ("build_silver", "load_reorganizations", "check_completeness")]
    jobs["backfill"] = lambda: backfill([*loads, *rest])
    return jobs[args.job]()


if __name__ == "__main__":
    sys.exit(main())
