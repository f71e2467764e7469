"""Queries of the lake's own operators, and the same in SQL."""

from __future__ import annotations

import io
from contextlib import redirect_stdout
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.functions import sessions, symbology
from tidemark.functions.hashing import row_hash
from tidemark.functions.text import folded, iso_seconds
from tidemark.operators import compaction, exactly_once, history, latest_wins, payload, quality, reconcile, scd2
from tidemark.plans.repair import _P3_STAMPS, _UTC
from tidemark.session import cut, staging_path
from tidemark.sources import schemas, vendors
from tidemark.sources.tables import table
from tidemark.sources.versioned import VersionedTable, find_tables
from tidemark.streaming import deliveries

SOURCES = ("alpaca", "yahoo")
TRACKED = ("issuer_id", "exchange_ticker", "security_name", "yfinance_sector", "alpaca_tradable")
#: An instant inside the data's time, to read and to split deliveries at.
INSTANT = "2025-07-01 00:00:00"
#: When the master is taken to have been built, before its first snapshot.
BUILT = "2026-04-01 00:00:00"
FIRST_DAY, LAST_DAY = date(2024, 3, 1), date(2024, 5, 31)


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "security_master").distinct()


def _snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return history.last_received(table(spark, folder, "master_snapshots"), "security_id", {c: F.col(c) for c in TRACKED})


def _current(spark: SparkSession, folder: str) -> DataFrame:
    """The latest version of each security, whatever is_current says."""
    columns = [c for c in table(spark, folder, "security_master").columns if c != "security_id"]
    return history.last_open(table(spark, folder, "security_master"), "security_id", {c: F.col(c) for c in columns if c != "valid_from"})


def _bars(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "daily_bars").withColumn("source", folded(F.col("source")))


def _as_text(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: iso_seconds(F.col(c)) for c in columns})


def scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    """All versions that the snapshots alone make."""
    return _as_text(scd2.replay(_snapshots(spark, folder), "security_id", "at", TRACKED), "valid_from", "valid_to")


def scd2_merge(spark: SparkSession, folder: str) -> DataFrame:
    """The master after merging the first snapshot."""
    latest = _current(spark, folder).withColumnRenamed("at", "valid_from")
    versions = latest.select(
        "security_id", *TRACKED, row_hash(TRACKED).alias("row_hash"), "valid_from", F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current")
    )
    snapshots = _snapshots(spark, folder)
    first = snapshots.agg(F.min("at").alias("at"))
    snapshot = snapshots.where(F.col("at") == first.scalar()).select("security_id", *TRACKED)
    after = scd2.transition(versions, snapshot, "security_id", first.scalar())
    return _as_text(after, "valid_from", "valid_to").withColumnRenamed("_change", "change")


def scd2_current(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.current(_versions(spark, folder)).select("security_id", "exchange_ticker", iso_seconds(F.col("valid_from")).alias("valid_from"))


def scd2_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.as_of(_versions(spark, folder), INSTANT).select("security_id", "exchange_ticker", iso_seconds(F.col("valid_from")).alias("valid_from"))


def scd2_changed_keys(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.changed_keys(_versions(spark, folder), "security_id")


def scd2_invariant(spark: SparkSession, folder: str) -> DataFrame:
    return scd2.broken_keys(_versions(spark, folder), "security_id")


def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = latest_wins.latest_per_key(_bars(spark, folder), schemas.BAR_KEYS, [*schemas.BAR_KEYS, *latest_wins.ORDER, "close", "volume"])
    return _as_text(rows, "source_ingested_at")


def latest_wins_history(spark: SparkSession, folder: str) -> DataFrame:
    """Bars after all deliveries came one by one."""
    rows = latest_wins.replay(_bars(spark, folder), schemas.BAR_KEYS, schemas.BAR_VALUES)
    return _as_text(rows, "source_ingested_at", "first_seen_at", "updated_at")


def latest_wins_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries from an instant on, as one batch, merged into what the earlier ones left."""
    rows = _bars(spark, folder)
    late = F.col("source_ingested_at") >= F.lit(INSTANT).cast("timestamp")
    state = latest_wins.replay(rows.where(~late), schemas.BAR_KEYS, schemas.BAR_VALUES)
    after = latest_wins.transition(state, rows.where(late), schemas.BAR_KEYS, schemas.BAR_VALUES)
    return _as_text(after, "source_ingested_at", "first_seen_at", "updated_at").withColumnRenamed("_change", "change")


def row_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "daily_bars").select("bar_id", row_hash(schemas.BAR_VALUES).alias("value_hash"))


def payload_bars(spark: SparkSession, folder: str) -> DataFrame:
    rows = payload.delivered_bars(table(spark, folder, "bronze"))
    return rows.select(
        "bronze_id", "bar_no", "security_id", "source", "price_basis", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"),
        "open", "high", "low", "close", "volume", "vwap", "trade_count",
    )


def _frames(spark: SparkSession, folder: str) -> DataFrame:
    """corporate_actions as frames a vendor would deliver, one per security and day, as rows of bronze."""
    value = lambda kind: F.max(F.when(F.col("action_type") == kind, F.col("value").cast("double")))
    days = table(spark, folder, "corporate_actions").groupBy("security_id", "ex_date").agg(value("dividend").alias("dividend"), value("split").alias("split"))
    numbers = [F.lit(1.0)] * 5 + [F.coalesce(c, F.lit(0.0)) for c in ("dividend", "split")]
    frame = F.struct(
        F.array(*[F.lit(payload.COLUMNS[c]) for c in ("open", "high", "low", "close", "volume", "dividend", "split")]).alias("columns"),
        F.array(F.col("ex_date").cast("string")).alias("index"),
        F.array(F.array(*numbers)).alias("data"),
    )
    return days.select(
        F.monotonically_increasing_id().alias("bronze_id"), "security_id", F.lit("x").alias("vendor_symbol"), F.lit(" Yahoo").alias("source"),
        F.lit(INSTANT).cast("timestamp").alias("ingested_at"), F.lit("run").alias("run_id"), F.to_json(frame).alias("payload"),
    )


def payload_actions(spark: SparkSession, folder: str) -> DataFrame:
    """The corporate actions, written as frames and read from them again."""
    rows = payload.actions(payload.delivered_bars(_frames(spark, folder)))
    return rows.select("security_id", F.date_format("ex_date", "yyyy-MM-dd").alias("ex_date"), "action_type", "source", "value")


def payload_counts(spark: SparkSession, folder: str) -> DataFrame:
    return payload.record_counts(table(spark, folder, "bronze"))


def actions_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries of actions before an instant and from it on, merged into a table one after the other."""
    held = VersionedTable(spark, staging_path(spark, "actions"))
    held.ensure(schemas.ACTIONS, layout="date_format(ex_date, 'yyyy')")
    rows = table(spark, folder, "corporate_actions")
    late = F.col("source_ingested_at") >= F.lit(INSTANT).cast("timestamp")
    for part in (rows.where(~late), rows.where(late)):
        latest_wins.merge_latest(held, part, schemas.ACTION_KEYS, ["value"])
    return _as_text(held.read(), "source_ingested_at", "first_seen_at", "updated_at")


def payload_unparsed(spark: SparkSession, folder: str) -> DataFrame:
    return payload.unparsed(table(spark, folder, "bronze"))


def silver_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Bars of all payloads merged into an empty table as one batch."""
    empty = spark.createDataFrame([], schemas.BARS)
    rows = payload.bars(payload.delivered_bars(table(spark, folder, "bronze"))).where("trade_date IS NOT NULL")
    after = latest_wins.transition(empty, rows, schemas.BAR_KEYS, schemas.BAR_VALUES)
    return after.select(*schemas.BAR_KEYS, "close", "volume", "value_hash", "source_run_id", "revision_count")


def bronze_range_overlap(spark: SparkSession, folder: str) -> DataFrame:
    start, end = F.lit("2024-03-01").cast("date"), F.lit("2024-03-31").cast("date")
    rows = payload.overlapping(table(spark, folder, "bronze"), start, end)
    return rows.select("bronze_id", "source", "security_id", "request_start", "request_end")


def empty_responses(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "bronze").where("record_count = 0").select("bronze_id", "security_id", "vendor_symbol", "request_start", "run_id")


def request_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Request parameters read from JSON and written again with sorted keys and without blanks."""
    p = F.from_json("request_params", "struct<adjustment: string, feed: string, timeframe: string, interval: string, start: string>")
    read = table(spark, folder, "bronze").select("bronze_id", p.alias("p"))
    params = payload.request_params(**{c: F.col(f"p.{c}") for c in ("timeframe", "feed", "adjustment", "start")})
    return read.select("bronze_id", F.col("p.interval").alias("interval"), params.alias("params"))


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "bronze").groupBy("source", "run_id", "request_start", "request_end").agg(
        F.count(F.lit(1)).alias("responses"),
        F.count_distinct("security_id").alias("securities"),
        F.sum(F.col("record_count").cast("long")).alias("bars"),
        iso_seconds(F.min("ingested_at")).alias("ingested_at"),
    )


def completeness_missing(spark: SparkSession, folder: str) -> DataFrame:
    missing = quality.missing_bars(_current(spark, folder), table(spark, folder, "trading_days"), SOURCES, _bars(spark, folder))
    return missing.withColumn("trade_date", F.date_format("trade_date", "yyyy-MM-dd"))


def completeness_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return completeness_missing(spark, folder).groupBy("trade_date", "source").agg(F.count(F.lit(1)).alias("n_missing"))


def vendor_ratio_histogram(spark: SparkSession, folder: str) -> DataFrame:
    latest = latest_wins.latest_per_key(_bars(spark, folder), schemas.BAR_KEYS, [*schemas.BAR_KEYS, "close"])
    ratios = quality.close_ratio(latest, *SOURCES)
    return ratios.groupBy(F.col("ratio").cast("decimal(18,2)").alias("ratio")).agg(F.count(F.lit(1)).alias("n_days"))


def vendor_pivot_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return _bars(spark, folder).groupBy(F.year("trade_date").alias("year")).pivot("source", list(SOURCES)).agg(F.count(F.lit(1))).na.fill(0)


def bars_overview(spark: SparkSession, folder: str) -> DataFrame:
    return _bars(spark, folder).groupBy("source", "price_basis").agg(
        F.count(F.lit(1)).alias("bars"),
        F.count_distinct("security_id").alias("securities"),
        F.count_distinct("trade_date").alias("sessions"),
        F.min("trade_date").alias("first_day"),
        F.max("trade_date").alias("last_day"),
    )


def bars_total(spark: SparkSession, folder: str) -> DataFrame:
    return _bars(spark, folder).agg(F.count(F.lit(1)).alias("bars"))


def bars_in_range(spark: SparkSession, folder: str) -> DataFrame:
    rows = payload.in_range(_bars(spark, folder), "trade_date", F.lit(FIRST_DAY), F.lit(LAST_DAY))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("bars"), F.count_distinct("trade_date").alias("sessions"))


def ratio_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days on which the vendors' closes are in another ratio than one, by security."""
    latest = latest_wins.latest_per_key(_bars(spark, folder), schemas.BAR_KEYS, [*schemas.BAR_KEYS, "close"])
    return quality.ratio_days(quality.close_ratio(latest, *SOURCES), F.col("ratio") != 1)


def revision_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return latest_wins_history(spark, folder).groupBy("source", "revision_count").agg(F.count(F.lit(1)).alias("n_bars"))


def top_recent_bars(spark: SparkSession, folder: str) -> DataFrame:
    """The newest bars of the latest day, a report of ten rows."""
    rows = _bars(spark, folder).orderBy(F.desc("trade_date"), "source", "bar_id").limit(10)
    return rows.select("bar_id", "security_id", "trade_date", "source", "close")


def exact_price_sum(spark: SparkSession, folder: str) -> DataFrame:
    sums = _bars(spark, folder).groupBy("source").agg(F.sum("close").alias("s"), F.sum("volume").alias("volume"))
    return sums.select("source", F.col("s").cast("decimal(28,4)").alias("close_sum"), "volume")


def actions_by_type(spark: SparkSession, folder: str) -> DataFrame:
    master = _current(spark, folder).select("security_id", "exchange_ticker")
    rows = table(spark, folder, "corporate_actions").join(master, "security_id")
    return rows.groupBy("action_type", "source").agg(F.count(F.lit(1)).alias("n_actions"), F.count_distinct("exchange_ticker").alias("n_tickers"))


def symbol_spellings(spark: SparkSession, folder: str) -> DataFrame:
    t = F.col("exchange_ticker")
    return table(spark, folder, "master_snapshots").select(
        t, symbology.match_key(t).alias("match_key"), symbology.to_figi(t).alias("figi"), symbology.to_yahoo(t).alias("yahoo"),
        symbology.from_figi(symbology.to_figi(t)).alias("back"),
    ).distinct()


def match_key_collisions(spark: SparkSession, folder: str) -> DataFrame:
    spelled = table(spark, folder, "security_master").select("sec_ticker", "issuer_id").distinct().where("sec_ticker IS NOT NULL")
    return reconcile.collisions(spelled.select(symbology.match_key(F.col("sec_ticker")).alias("match_key")))


def ticker_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    flag = symbology.spellings_differ(*[F.col(c) for c in reconcile.SPELLINGS])
    return _current(spark, folder).select("security_id", flag.alias("ticker_mismatch"))


def issuer_shared(spark: SparkSession, folder: str) -> DataFrame:
    master = _current(spark, folder)
    shared = master.groupBy("issuer_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return master.join(shared, "issuer_id", "left_semi").select("issuer_id", "security_id", "exchange_ticker")


def issuer_ids(spark: SparkSession, folder: str) -> DataFrame:
    ids = table(spark, folder, "security_master").select("cik").distinct()
    return ids.select("cik", symbology.issuer_id(F.col("cik")).alias("issuer_id"))


def vendor_symbols(spark: SparkSession, folder: str) -> DataFrame:
    return _current(spark, folder).select("security_id", *[reconcile.vendor_symbol(s).alias(f"{s}_symbol") for s in SOURCES])


def vendor_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests to both vendors for the bars of a range, their parameters as JSON."""
    master = _current(spark, folder)
    asked = [vendors.bar_requests(master.select("security_id", reconcile.vendor_symbol(s).alias("vendor_symbol")), s, FIRST_DAY, LAST_DAY) for s in SOURCES]
    sorted_ = F.map_from_entries(F.array_sort(F.map_entries("params")))
    return asked[0].union(asked[1]).select("source", "security_id", F.to_json(sorted_).alias("params"))


def _figi_answers(spark: SparkSession, folder: str) -> DataFrame:
    """What a mapping service would say of the master's securities.

    Share classes have two matches, securities of no sector aren't found, and those without a tradable flag are found as another listing.
    """
    master = _current(spark, folder)
    composite = F.when(F.col("alpaca_tradable").isNull(), F.col("share_class_figi")).otherwise(F.col("security_id"))
    match = F.struct(
        F.col("security_id").alias("figi"), composite.alias("compositeFIGI"), F.col("figi_ticker").alias("ticker"), F.col("security_name").alias("name"),
        F.col("security_type").alias("securityType2"), F.col("share_class_figi").alias("shareClassFIGI"),
    )
    found = F.when(F.col("exchange_ticker").like("%.%"), F.array(match, match)).otherwise(F.array(match))
    answer = F.when(F.col("yfinance_sector").isNull(), F.lit('{"warning":"No identifier found."}')).otherwise(F.to_json(F.struct(found.alias("data"))))
    return master.select("security_id", answer.alias("answer"))


def figi_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.figi_lookup(_figi_answers(spark, folder))


def stale_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Tickers of the securities' first versions that the mapping service no longer gives."""
    first = table(spark, folder, "security_master").groupBy("security_id").agg(F.min(F.struct("valid_from", "exchange_ticker")).alias("v"))
    return reconcile.stale_labels(_figi_answers(spark, folder), first.select("security_id", F.col("v.exchange_ticker").alias("label")))


def _sec_content(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of tradable securities as the register publishes them, those of one match key once."""
    known = _current(spark, folder).where("sec_ticker IS NOT NULL AND alpaca_tradable")
    once = known.groupBy(symbology.match_key(F.col("sec_ticker")).alias("match_key")).agg(F.max(F.struct("cik", "sec_ticker", "sec_company_name")).alias("s"))
    entry = F.struct(F.col("s.cik").alias("cik_str"), F.col("s.sec_ticker").alias("ticker"), F.col("s.sec_company_name").alias("title"))
    return once.select(F.to_json(F.create_map(F.lit("0"), entry)).alias("content"))


def sec_tickers(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.distinct_sec_tickers(reconcile.sec_tickers(_sec_content(spark, folder)))


def _vendor_answers(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both vendors' answers about the master's securities; none where the name or the tradable flag is missing."""
    master = _current(spark, folder)
    info = F.struct(
        F.col("yfinance_symbol").alias("symbol"), F.when(F.col("yfinance_sector").isNull(), "").otherwise(F.col("yfinance_name")).alias("longName"),
        F.col("security_name").alias("shortName"), F.col("yfinance_exchange").alias("exchange"), F.col("yfinance_sector").alias("sector"),
    )
    asset = F.struct(
        F.col("alpaca_asset_id").alias("id"), F.col("alpaca_symbol").alias("symbol"), F.col("alpaca_exchange").alias("exchange"), F.col("alpaca_tradable").alias("tradable"),
    )

    def answers(missing: Column, error: str, body: Column) -> DataFrame:
        return master.select("security_id", F.when(~missing, F.to_json(body)).alias("answer"), F.when(missing, error).alias("error"))

    yahoo = answers(F.col("yfinance_name").isNull(), "timeout", info)
    return reconcile.yahoo_info(yahoo), reconcile.alpaca_assets(answers(F.col("alpaca_tradable").isNull(), "no API key configured", asset))


def vendor_lookups(spark: SparkSession, folder: str) -> DataFrame:
    yahoo, alpaca = _vendor_answers(spark, folder)
    return yahoo.join(alpaca, "security_id")


def _reconciled(spark: SparkSession, folder: str) -> DataFrame:
    """The current master as its sources would give it, read and reconciled again; the first version of each security is the previous build."""
    yahoo, alpaca = _vendor_answers(spark, folder)
    carried = [c for columns in reconcile.VENDOR_COLUMNS.values() for c in columns]
    first = table(spark, folder, "security_master").groupBy("security_id").agg(F.min(F.struct("valid_from", *carried)).alias("v"))
    previous = first.select("security_id", *[F.col(f"v.{c}") for c in carried])
    return reconcile.reconciled(figi_lookup(spark, folder), reconcile.sec_tickers(_sec_content(spark, folder)), yahoo, alpaca, previous)


def reconcile_resolved(spark: SparkSession, folder: str) -> DataFrame:
    resolved, _ = reconcile.split(_reconciled(spark, folder))
    return resolved.select("security_id", "issuer_id", "exchange_ticker", "sec_ticker", "yfinance_sector", "alpaca_tradable", "ticker_mismatch")


def reconcile_quarantined(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.split(_reconciled(spark, folder))[1]


def quarantine_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile_quarantined(spark, folder).groupBy("quarantine_reason").agg(F.count(F.lit(1)).alias("n_securities"))


def build_report(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows each part of a build's report has, and failed lookups by message."""
    parts = reconcile.report(*reconcile.split(_reconciled(spark, folder)), *_vendor_answers(spark, folder))
    counts = [rows.agg(F.lit(name).alias("part"), F.lit("").alias("error"), F.count(F.lit(1)).alias("n")) for name, rows in parts.items() if not name.endswith("failures")]
    failed = [rows.select(F.lit(name).alias("part"), "error", F.col("n_securities").alias("n")) for name, rows in parts.items() if name.endswith("failures")]
    out = counts[0]
    for rows in [*counts[1:], *failed]:
        out = out.union(rows)
    return out


def last_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """For every session but the first the one before it, and the start of five years up to that, from the calendar's rules."""
    days = [r[0] for r in table(spark, folder, "trading_days").select("trade_date").orderBy("trade_date").collect()]  # a calendar
    rows = [(str(d), *map(str, reversed(sessions.default_range(d)))) for d in days[1:]]
    return spark.createDataFrame(rows, "trade_date string, last_session string, range_start string")


def session_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """First and last second of every session's day, from the calendar's rules over the days of the table."""
    ends = table(spark, folder, "trading_days").agg(F.min("trade_date"), F.max("trade_date")).first()
    days = sessions.sessions(spark, *ends)
    first, last = sessions.day_bounds(F.col("trade_date"), F.col("trade_date"))
    return days.select(F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"), iso_seconds(first).alias("first_second"), iso_seconds(last).alias("last_second"))


_MADE: dict[tuple[str, str], tuple[str, list[int]]] = {}


def _lake(spark: SparkSession, folder: str) -> tuple[str, list[int]]:
    """A lake of the folder's data, made once in an application: its root, and the master's version after every merge.

    The whole current master and then all snapshots in turn are merged into one table; bronze is appended to two.
    """
    made_for = (spark.sparkContext.applicationId, folder)
    if made_for not in _MADE:
        root = staging_path(spark, "lake")
        master = VersionedTable(spark, f"{root}/reference/security_master")
        optional = "issuer_id string, exchange_ticker string, security_name string, yfinance_sector string, alpaca_tradable boolean"
        scd2.ensure_table(master, schemas.schema(schemas.fields("security_id string"), schemas.fields(optional=optional)), "security_id", 4)
        scd2.merge_snapshot(master, _current(spark, folder).select("security_id", *TRACKED), "security_id", BUILT)
        versions = [master.versions()[-1]]
        snapshots = cut(_snapshots(spark, folder))
        times = [r[0] for r in snapshots.select(iso_seconds(F.col("at")).alias("at")).distinct().orderBy("at").collect()]  # of snapshots
        for at in times:
            rows = snapshots.where(F.col("at") == F.lit(at).cast("timestamp")).select("security_id", *TRACKED)
            scd2.merge_snapshot(master, rows, "security_id", at)
            versions.append(master.versions()[-1])
        for source in SOURCES:
            rows = table(spark, folder, "bronze").where(folded(F.col("source")) == source)
            held = VersionedTable(spark, f"{root}/bronze/{source}_bars")
            held.ensure(rows.schema)
            held.append(rows)
        _MADE[made_for] = root, versions
    return _MADE[made_for]


def _master_table(spark: SparkSession, folder: str) -> VersionedTable:
    return VersionedTable(spark, f"{_lake(spark, folder)[0]}/reference/security_master")


def table_time_travel(spark: SparkSession, folder: str) -> DataFrame:
    """The master after its third snapshot, read after all."""
    version = _lake(spark, folder)[1][3]
    return _as_text(_master_table(spark, folder).read(version).select("security_id", *TRACKED, "valid_from", "valid_to", "is_current"), "valid_from", "valid_to")


def table_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The master after the whole of it and all snapshots were merged in turn."""
    return _as_text(_master_table(spark, folder).read().select("security_id", *TRACKED, "row_hash", "valid_from", "valid_to", "is_current"), "valid_from", "valid_to")


def table_history(spark: SparkSession, folder: str) -> DataFrame:
    """The commits of the master; a merge without a change makes none."""
    metrics = F.col("metrics")
    return _master_table(spark, folder).history().select("version", "operation", metrics["new"].alias("n_new"), metrics["changed"].alias("n_changed"))


def table_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The tables of the lake with what their metadata and their rows say."""
    out = None
    for name, path in find_tables(spark, _lake(spark, folder)[0]).collect():
        held = VersionedTable(spark, path)
        detail = held.detail().select(F.lit(name).alias("name"), (F.col("num_files") > 0).alias("has_files"), (F.col("size_in_bytes") > 0).alias("has_bytes"))
        counted = held.read().agg(F.count(F.lit(1)).alias("n_rows"))
        rows = detail.select("*", counted.scalar().alias("n_rows"), F.coalesce(held.properties().agg(F.max("value")).scalar(), F.lit("")).alias("constraint"))
        out = rows if out is None else out.union(rows)
    return out


def tiny_files(spark: SparkSession, folder: str) -> DataFrame:
    """bronze written as one file for each run and more for the large ones, and what its consolidation holds."""
    rows = table(spark, folder, "bronze")
    source = staging_path(spark, "tiny")
    rows.withColumn("run", F.coalesce("run_id", F.lit("none"))).repartition(spark.sparkContext.defaultParallelism, "run").write.partitionBy("run").parquet(source)
    path, figures, counts = compaction.compact(spark, source, counted_by=["run_id"])
    wanted = max(1, -(-figures["bytes_in"] // compaction.TARGET_BYTES))
    held = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("bronze_id").alias("sum_ids"), F.count_distinct("payload").alias("payloads"))
    return held.select(
        counts.agg(F.count(F.lit(1))).scalar().alias("n_runs"), "n_rows", "sum_ids", "payloads", F.lit(figures["files_out"] <= wanted).alias("few_files"),
        (F.lit(figures["files_in"]) >= counts.agg(F.count(F.lit(1))).scalar()).alias("many_before"),
    )


def job_silver(spark: SparkSession, folder: str) -> DataFrame:
    """The bars that the job makes of the bronze tables for a range of days, run twice: the second run changes nothing."""
    lake = jobs.Lake(spark, staging_path(spark, "job"))
    for source in SOURCES:
        rows = table(spark, folder, "bronze").where(folded(F.col("source")) == source)
        held = lake.bronze(source)
        held.ensure(rows.schema)
        held.append(rows)
    with redirect_stdout(io.StringIO()):  # what a job says isn't part of a query
        for _ in range(2):
            jobs.build_silver(lake, FIRST_DAY, LAST_DAY)
    return lake.bars.read().select(*schemas.BAR_KEYS, "close", "volume", "value_hash", "source_run_id", "revision_count", F.lit(len(lake.bars.versions())).alias("n_versions"))


def stream_window_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = deliveries.window_counts(deliveries.read_stream(spark, f"{folder}/bronze.parquet"))
    return _as_text(deliveries.run_to_end(counts, "counts", ["window_start", "source"]), "window_start")


def stream_once(spark: SparkSession, folder: str) -> DataFrame:
    """Messages by source in the stream of deliveries, each once."""
    without = [F.col(c) for c in ("security_id", "request_start", "request_end", "page", "run_id")]
    key = exactly_once.message_key(F.col("response_id"), F.col("source"), without)
    kept = deliveries.run_to_end(deliveries.once(deliveries.read_stream(spark, f"{folder}/bronze.parquet"), key), "once")
    return kept.groupBy(folded(F.col("source")).alias("source")).agg(F.count(F.lit(1)).alias("n_messages"))


def stream_bars(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of deliveries merged into a table of bars."""
    root = staging_path(spark, "stream")
    held = VersionedTable(spark, f"{root}/bars")
    held.ensure(schemas.BARS, layout=schemas.BAR_LAYOUT.format(shares=1))
    usable = deliveries.read_stream(spark, f"{folder}/bronze.parquet")
    deliveries.follow(usable, held, f"{root}/state")
    return held.read().select(*schemas.BAR_KEYS, "close", "volume", "value_hash", "source_run_id")


_PRICES = ("open", "high", "low", "close", "vwap", "trade_count")
#: Columns given as text: dates, exact decimals, and whole numbers that may be null, which engines show differently.
SHOWN = {
    "latest_per_key": ("trade_date", "close"),
    "latest_wins_history": ("trade_date", *_PRICES),
    "latest_wins_merge": ("trade_date", *_PRICES),
    "payload_bars": _PRICES,
    "payload_actions": ("value",),
    "silver_bars": ("trade_date", "close"),
    "bronze_range_overlap": ("request_start", "request_end"),
    "empty_responses": ("request_start",),
    "run_summary": ("request_start", "request_end"),
    "vendor_ratio_histogram": ("ratio",),
    "bars_overview": ("first_day", "last_day"),
    "top_recent_bars": ("trade_date", "close"),
    "exact_price_sum": ("close_sum",),
    "table_history": ("n_new", "n_changed"),
    "actions_merged": ("ex_date", "value"),
    "ratio_days": ("first_day", "last_day"),
    "stream_bars": ("trade_date", "close"),
    "job_silver": ("trade_date", "close"),
}


def _shown(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        rows = query(spark, folder)
        return rows.withColumns({c: F.col(c).cast("string") for c in SHOWN.get(query.__name__, ())})

    run.__name__ = query.__name__
    return run


QUERIES = {
    f.__name__: _shown(f)
    for f in (
        scd2_history, scd2_merge, scd2_current, scd2_as_of, scd2_changed_keys, scd2_invariant,
        latest_per_key, latest_wins_history, latest_wins_merge, row_hashes,
        payload_bars, payload_actions, payload_counts, payload_unparsed, actions_merged, silver_bars, bronze_range_overlap, empty_responses, request_fields, run_summary,
        completeness_missing, completeness_by_day, vendor_ratio_histogram, ratio_days, vendor_pivot_by_year, bars_overview, bars_total, bars_in_range, revision_histogram,
        top_recent_bars, exact_price_sum, actions_by_type,
        issuer_ids, vendor_symbols, vendor_requests, figi_lookup, stale_labels, sec_tickers, vendor_lookups, build_report, last_sessions,
        symbol_spellings, match_key_collisions, ticker_mismatch, issuer_shared, reconcile_resolved, reconcile_quarantined, quarantine_reasons,
        session_bounds, table_time_travel, table_merged, table_history, table_catalog, tiny_files, job_silver, stream_window_counts, stream_once, stream_bars,
    )
}


def _hash(*columns: str) -> str:
    return "sha256(concat_ws(chr(31), " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in columns) + "))"


def _utc(column: str) -> str:
    return _UTC.format(column)


_CURRENT = "cur AS (SELECT * FROM (SELECT DISTINCT * FROM security_master) QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY valid_from DESC) = 1)"
_SNAPS = """snaps AS (
  SELECT * FROM master_snapshots QUALIFY row_number() OVER (PARTITION BY security_id, snapshot_at
    ORDER BY received_at DESC, issuer_id DESC, exchange_ticker DESC, security_name DESC, yfinance_sector DESC, alpaca_tradable DESC) = 1)"""
_TRACKED = ", ".join(TRACKED)
_BARS = f"bars AS (SELECT * EXCLUDE (source, value_hash), lower(trim(source)) AS source, {_hash(*schemas.BAR_VALUES)} AS value_hash, value_hash AS given_hash FROM daily_bars)"
_VALUES = ", ".join(schemas.BAR_VALUES)
_REPLAY = """
  once_{name} AS (SELECT * FROM bars WHERE {where}
    QUALIFY row_number() OVER (PARTITION BY security_id, trade_date, source, source_ingested_at ORDER BY source_run_id DESC, value_hash DESC) = 1),
  marked_{name} AS (SELECT *, lag(value_hash) OVER w AS before, min(source_ingested_at) OVER (PARTITION BY security_id, trade_date, source) AS seen FROM once_{name}
    WINDOW w AS (PARTITION BY security_id, trade_date, source ORDER BY source_ingested_at)),
  replayed_{name} AS (SELECT *, sum(CASE WHEN before IS NOT NULL AND before <> value_hash THEN 1 ELSE 0 END) OVER (PARTITION BY security_id, trade_date, source) AS revisions
    FROM marked_{name}
    QUALIFY row_number() OVER (PARTITION BY security_id, trade_date, source ORDER BY (before IS NULL OR before <> value_hash) DESC, source_ingested_at DESC) = 1)
"""
_ALL_STAMPS = _P3_STAMPS.replace(r"WHERE raw IS NULL OR NOT regexp_full_match(raw, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z')", "")
_DELIVERED = (
    _ALL_STAMPS[: _ALL_STAMPS.rindex("SELECT bronze_id, bar_no, strftime")].rstrip()
    + r"""
, docs AS (
  SELECT bronze_id, security_id, lower(trim(source)) AS source, vendor_symbol, ingested_at, run_id, CAST(payload AS JSON) AS j FROM bronze WHERE json_valid(payload)
), items AS (
  SELECT *, CASE WHEN json_type(j, '$.bars') = 'OBJECT' THEN json_extract(j, '$.bars.*[*]') ELSE json_extract(j, '$.data[*]') END AS list,
    CAST(json_extract_string(j, '$.columns[*]') AS VARCHAR[]) AS names
  FROM docs
), listed_items AS (
  SELECT bronze_id, security_id, source, ingested_at, run_id, names, CAST(unnest(range(len(list))) AS INTEGER) AS bar_no, unnest(list) AS bar FROM items
), valued AS (
  SELECT *, source = 'alpaca' AS mapped, CASE WHEN source <> 'alpaca' THEN CAST(bar AS DOUBLE[]) END AS v FROM listed_items
), typed AS (
  SELECT bronze_id, bar_no, security_id, source, ingested_at, run_id,
    CASE source WHEN 'alpaca' THEN 'raw' WHEN 'yahoo' THEN 'vendor_adjusted' END AS price_basis,
    CAST(CASE WHEN mapped THEN CAST(bar->>'o' AS DOUBLE) ELSE v[list_position(names, 'Open')] END AS DECIMAL(18,4)) AS open,
    CAST(CASE WHEN mapped THEN CAST(bar->>'h' AS DOUBLE) ELSE v[list_position(names, 'High')] END AS DECIMAL(18,4)) AS high,
    CAST(CASE WHEN mapped THEN CAST(bar->>'l' AS DOUBLE) ELSE v[list_position(names, 'Low')] END AS DECIMAL(18,4)) AS low,
    CAST(CASE WHEN mapped THEN CAST(bar->>'c' AS DOUBLE) ELSE v[list_position(names, 'Close')] END AS DECIMAL(18,4)) AS close,
    CAST(trunc(CASE WHEN NOT mapped THEN v[list_position(names, 'Volume')] WHEN CAST(bar->>'v' AS DOUBLE) = trunc(CAST(bar->>'v' AS DOUBLE)) THEN CAST(bar->>'v' AS DOUBLE) END) AS BIGINT) AS volume,
    CAST(CASE WHEN mapped THEN CAST(bar->>'vw' AS DOUBLE) END AS DECIMAL(18,6)) AS vwap,
    CAST(CASE WHEN mapped AND CAST(bar->>'n' AS DOUBLE) = trunc(CAST(bar->>'n' AS DOUBLE)) THEN CAST(bar->>'n' AS DOUBLE) END AS BIGINT) AS trade_count,
    CASE WHEN NOT mapped THEN v[list_position(names, 'Dividends')] END AS dividend,
    CASE WHEN NOT mapped THEN v[list_position(names, 'Stock Splits')] END AS split
  FROM valued
), delivered AS (
  SELECT t.*, strftime(timezone('America/New_York', s.moment), '%Y-%m-%d') AS trade_date FROM typed t JOIN settled s USING (bronze_id, bar_no)
)
"""
)
_FOUND = "c.yfinance_sector IS NOT NULL AND c.exchange_ticker NOT LIKE '%.%' AND c.alpaca_tradable IS NOT NULL"
_FIGI_ERROR = """CASE WHEN c.yfinance_sector IS NULL THEN 'No identifier found.' WHEN c.exchange_ticker LIKE '%.%' THEN '2 matches'
      WHEN c.alpaca_tradable IS NULL THEN 'not a composite FIGI (composite is ' || coalesce(c.share_class_figi, 'none') || ')' END"""
_SEC = """sec AS (
  SELECT translate(upper(trim(sec_ticker)), '-/ ', '...') AS match_key, max(struct_pack(c := cik, t := sec_ticker, n := sec_company_name)) AS s
  FROM cur WHERE sec_ticker IS NOT NULL AND alpaca_tradable GROUP BY 1
)"""
_YAHOO_NAME = "CASE WHEN c.yfinance_sector IS NOT NULL THEN coalesce(nullif(c.yfinance_name, ''), nullif(c.security_name, '')) ELSE nullif(c.security_name, '') END"
_RECONCILED = f"""
WITH {_CURRENT}, {_SEC}, prev AS (
  SELECT * FROM (SELECT DISTINCT * FROM security_master) QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY valid_from) = 1
), looked AS (
  SELECT c.security_id, {_FIGI_ERROR} AS figi_error, CASE WHEN {_FOUND} THEN replace(c.figi_ticker, '/', '.') END AS exchange_ticker,
    CASE WHEN {_FOUND} THEN c.figi_ticker END AS figi_ticker, c.yfinance_name IS NULL AS no_yahoo, c.alpaca_tradable IS NULL AS no_alpaca,
    c.yfinance_symbol, c.yfinance_sector, c.alpaca_symbol, c.alpaca_tradable
  FROM cur c
), joined AS (
  SELECT c.security_id, c.exchange_ticker, c.figi_ticker, CASE WHEN s.s IS NOT NULL THEN 'CIK' || lpad(CAST(s.s.c AS VARCHAR), 10, '0') END AS issuer_id, s.s.t AS sec_ticker,
    CASE WHEN c.figi_error IS NOT NULL THEN 'OpenFIGI: ' || c.figi_error WHEN s.s IS NULL THEN 'no SEC match' END AS quarantine_reason,
    CASE WHEN no_yahoo THEN p.yfinance_symbol ELSE c.yfinance_symbol END AS yfinance_symbol,
    CASE WHEN no_yahoo THEN p.yfinance_sector ELSE c.yfinance_sector END AS yfinance_sector,
    CASE WHEN no_alpaca THEN p.alpaca_symbol ELSE c.alpaca_symbol END AS alpaca_symbol,
    CASE WHEN no_alpaca THEN p.alpaca_tradable ELSE c.alpaca_tradable END AS alpaca_tradable
  FROM looked c LEFT JOIN sec s ON s.match_key = translate(upper(trim(c.exchange_ticker)), '-/ ', '...') LEFT JOIN prev p ON p.security_id = c.security_id
)
"""
_DIFFER = "len(list_distinct(list_filter([figi_ticker, sec_ticker, yfinance_symbol, alpaca_symbol], lambda x: x IS NOT NULL AND x <> ''))) > 1"
_MASTER = f"""
WITH {_CURRENT}, {_SNAPS}, states AS (
  SELECT security_id, {_TRACKED}, TIMESTAMPTZ '{BUILT}+00' AS moment FROM cur UNION ALL BY NAME SELECT security_id, {_TRACKED}, snapshot_at AS moment FROM snaps
), hashed AS (
  SELECT *, {_hash(*TRACKED)} AS row_hash FROM states
), begun AS (
  SELECT * FROM (SELECT *, lag(row_hash) OVER (PARTITION BY security_id ORDER BY moment) AS before FROM hashed) WHERE before IS NULL OR before <> row_hash
)
"""


def _master_versions(where: str, more: str = "") -> str:
    return f"""
        SELECT security_id, {_TRACKED}, {more} {_utc("moment")} AS valid_from, {_utc("lead(moment) OVER w")} AS valid_to, lead(moment) OVER w IS NULL AS is_current
        FROM begun WHERE {where} WINDOW w AS (PARTITION BY security_id ORDER BY moment)
    """


_NOON = "timezone('America/New_York', TIMESTAMP '{0} 12:00:00')"


def _offset(day: date) -> str:
    """New York's offset on a day, from its distance to UTC at noon."""
    return f"(CASE epoch(timezone('UTC', {_NOON.format(day)})) - epoch(TIMESTAMP '{day} 12:00:00') WHEN 18000 THEN '-05:00' ELSE '-04:00' END)"


SQL = {
    "scd2_history": f"""
        WITH {_SNAPS}, h AS (SELECT *, {_hash(*TRACKED)} AS row_hash FROM snaps), b AS (
          SELECT *, lag(row_hash) OVER (PARTITION BY security_id ORDER BY snapshot_at) AS before FROM h)
        SELECT security_id, {_TRACKED}, row_hash, {_utc("snapshot_at")} AS valid_from,
          {_utc("lead(snapshot_at) OVER w")} AS valid_to, lead(snapshot_at) OVER w IS NULL AS is_current
        FROM b WHERE before IS NULL OR before <> row_hash WINDOW w AS (PARTITION BY security_id ORDER BY snapshot_at)
    """,
    "scd2_merge": f"""
        WITH {_CURRENT}, {_SNAPS}, t AS (SELECT security_id, {_TRACKED}, {_hash(*TRACKED)} AS row_hash, valid_from FROM cur),
        s AS (SELECT security_id, {_TRACKED}, {_hash(*TRACKED)} AS row_hash, snapshot_at FROM snaps WHERE snapshot_at = (SELECT min(snapshot_at) FROM master_snapshots))
        SELECT t.*EXCLUDE (valid_from), {_utc("t.valid_from")} AS valid_from, CASE WHEN s.row_hash <> t.row_hash THEN {_utc("s.snapshot_at")} END AS valid_to,
          coalesce(s.row_hash = t.row_hash, true) AS is_current, CASE WHEN s.row_hash <> t.row_hash THEN 'closed' WHEN s.row_hash = t.row_hash THEN 'unchanged' END AS change
        FROM t LEFT JOIN s USING (security_id)
        UNION ALL BY NAME
        SELECT s.*EXCLUDE (snapshot_at), {_utc("s.snapshot_at")} AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current,
          CASE WHEN t.row_hash IS NULL THEN 'new' ELSE 'changed' END AS change
        FROM s LEFT JOIN t USING (security_id) WHERE t.row_hash IS NULL OR t.row_hash <> s.row_hash
    """,
    "scd2_current": f"SELECT DISTINCT security_id, exchange_ticker, {_utc('valid_from')} AS valid_from FROM security_master WHERE is_current",
    "scd2_as_of": f"""
        SELECT DISTINCT security_id, exchange_ticker, {_utc("valid_from")} AS valid_from FROM security_master
        WHERE valid_from <= TIMESTAMPTZ '{INSTANT}+00' AND (valid_to IS NULL OR valid_to > TIMESTAMPTZ '{INSTANT}+00')
    """,
    "scd2_changed_keys": "SELECT security_id, count(*) AS n_versions FROM (SELECT DISTINCT * FROM security_master) GROUP BY security_id HAVING count(*) > 1",
    "scd2_invariant": """
        SELECT security_id, count(*) FILTER (WHERE is_current) AS n_open FROM (SELECT DISTINCT * FROM security_master)
        GROUP BY security_id HAVING count(*) FILTER (WHERE is_current) <> 1
    """,
    "latest_per_key": f"""
        WITH {_BARS} SELECT security_id, trade_date, source, {_utc("source_ingested_at")} AS source_ingested_at, source_run_id, given_hash AS value_hash, close, volume
        FROM bars QUALIFY row_number() OVER (PARTITION BY security_id, trade_date, source
          ORDER BY source_ingested_at DESC, source_run_id DESC, given_hash DESC, close DESC, volume DESC) = 1
    """,
    "latest_wins_history": f"""
        WITH {_BARS}, {_REPLAY.format(name="all", where="true")}
        SELECT security_id, trade_date, source, {_VALUES}, value_hash, {_utc("source_ingested_at")} AS source_ingested_at, source_run_id,
          {_utc("seen")} AS first_seen_at, {_utc("source_ingested_at")} AS updated_at, CAST(revisions AS INTEGER) AS revision_count
        FROM replayed_all
    """,
    "latest_wins_merge": f"""
        WITH {_BARS}, {_REPLAY.format(name="old", where=f"source_ingested_at < TIMESTAMPTZ '{INSTANT}+00'")},
        s AS (SELECT * FROM bars WHERE source_ingested_at >= TIMESTAMPTZ '{INSTANT}+00'
          QUALIFY row_number() OVER (PARTITION BY security_id, trade_date, source ORDER BY source_ingested_at DESC, source_run_id DESC, value_hash DESC) = 1),
        both_ AS (SELECT t, s, t.security_id IS NOT NULL AS held, coalesce(s.value_hash <> t.value_hash AND s.source_ingested_at > t.source_ingested_at, false) AS revises
          FROM replayed_old t FULL JOIN s ON t.security_id = s.security_id AND t.trade_date = s.trade_date AND t.source = s.source)
        SELECT coalesce(t.security_id, s.security_id) AS security_id, coalesce(t.trade_date, s.trade_date) AS trade_date, coalesce(t.source, s.source) AS source,
          {", ".join(f"CASE WHEN revises OR NOT held THEN s.{c} ELSE t.{c} END AS {c}" for c in (*schemas.BAR_VALUES, "value_hash", "source_run_id"))},
          {_utc("CASE WHEN revises OR NOT held THEN s.source_ingested_at ELSE t.source_ingested_at END")} AS source_ingested_at,
          {_utc("coalesce(t.seen, s.source_ingested_at)")} AS first_seen_at,
          {_utc("CASE WHEN revises OR NOT held THEN s.source_ingested_at ELSE t.source_ingested_at END")} AS updated_at,
          CAST(CASE WHEN held THEN t.revisions + CASE WHEN revises THEN 1 ELSE 0 END ELSE 0 END AS INTEGER) AS revision_count,
          CASE WHEN NOT held THEN 'inserted' WHEN revises THEN 'revised' END AS change
        FROM both_
    """,
    "row_hashes": f"SELECT bar_id, {_hash(*schemas.BAR_VALUES)} AS value_hash FROM daily_bars",
    "payload_bars": _DELIVERED
    + "SELECT bronze_id, bar_no, security_id, source, price_basis, trade_date, open, high, low, close, volume, vwap, trade_count FROM delivered",
    "payload_actions": """
        SELECT security_id, strftime(ex_date, '%Y-%m-%d') AS ex_date, action_type, 'yahoo' AS source, max(value) AS value
        FROM corporate_actions WHERE action_type IN ('dividend', 'split') AND value <> 0 GROUP BY ALL
    """,
    "payload_counts": """
        SELECT bronze_id, CAST(CASE WHEN NOT coalesce(json_valid(payload), false) THEN 0
          WHEN json_type(payload, '$.bars') = 'OBJECT' THEN coalesce(json_array_length(payload, '$.bars."' || vendor_symbol || '"'), 0)
          ELSE coalesce(json_array_length(payload, '$.index'), 0) END AS INTEGER) AS n_records FROM bronze
    """,
    "actions_merged": f"""
        WITH acts AS (SELECT * EXCLUDE (value_hash), {_hash("value")} AS value_hash FROM corporate_actions),
        t AS (SELECT * FROM acts WHERE source_ingested_at < TIMESTAMPTZ '{INSTANT}+00'
          QUALIFY row_number() OVER (PARTITION BY security_id, ex_date, action_type, source ORDER BY source_ingested_at DESC, source_run_id DESC, value_hash DESC) = 1),
        s AS (SELECT * FROM acts WHERE source_ingested_at >= TIMESTAMPTZ '{INSTANT}+00'
          QUALIFY row_number() OVER (PARTITION BY security_id, ex_date, action_type, source ORDER BY source_ingested_at DESC, source_run_id DESC, value_hash DESC) = 1),
        both_ AS (SELECT t, s, t.security_id IS NULL OR coalesce(t.value_hash <> s.value_hash, false) AS takes, t.security_id IS NOT NULL AND s.security_id IS NOT NULL AS met
          FROM t FULL JOIN s ON t.security_id = s.security_id AND t.ex_date = s.ex_date AND t.action_type = s.action_type AND t.source = s.source)
        SELECT coalesce(t.security_id, s.security_id) AS security_id, coalesce(t.ex_date, s.ex_date) AS ex_date, coalesce(t.action_type, s.action_type) AS action_type,
          coalesce(t.source, s.source) AS source, CASE WHEN takes THEN s.value ELSE t.value END AS value, CASE WHEN takes THEN s.value_hash ELSE t.value_hash END AS value_hash,
          {_utc("CASE WHEN takes THEN s.source_ingested_at ELSE t.source_ingested_at END")} AS source_ingested_at, CASE WHEN takes THEN s.source_run_id ELSE t.source_run_id END AS source_run_id,
          {_utc("coalesce(t.source_ingested_at, s.source_ingested_at)")} AS first_seen_at, {_utc("CASE WHEN takes THEN s.source_ingested_at ELSE t.source_ingested_at END")} AS updated_at,
          CAST(CASE WHEN met AND takes THEN 1 ELSE 0 END AS INTEGER) AS revision_count
        FROM both_
    """,
    "payload_unparsed": """
        WITH r AS (SELECT lower(trim(source)) AS source, CASE WHEN payload IS NULL THEN 'null' WHEN trim(payload) = '' THEN 'blank' WHEN NOT json_valid(payload) THEN 'malformed'
          WHEN coalesce(json_array_length(payload, '$.index'), len(json_extract(payload, '$.bars.*'))) = 0 THEN 'empty' END AS reason FROM bronze)
        SELECT source, reason, count(*) AS n_payloads FROM r WHERE reason IS NOT NULL GROUP BY source, reason
    """,
    "silver_bars": _DELIVERED
    + f"""
        , hashed AS (SELECT *, {_hash(*schemas.BAR_VALUES)} AS value_hash FROM delivered)
        SELECT security_id, CAST(trade_date AS DATE) AS trade_date, source, close, volume, value_hash, run_id AS source_run_id, 0 AS revision_count
        FROM hashed WHERE trade_date IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY security_id, hashed.trade_date, source ORDER BY ingested_at DESC, run_id DESC, value_hash DESC) = 1
    """,
    "bronze_range_overlap": """
        SELECT bronze_id, source, security_id, request_start, request_end FROM bronze
        WHERE request_end >= DATE '2024-03-01' AND request_start <= DATE '2024-03-31'
    """,
    "empty_responses": "SELECT bronze_id, security_id, vendor_symbol, request_start, run_id FROM bronze WHERE record_count = 0",
    "request_fields": """
        SELECT bronze_id, request_params->>'interval' AS interval,
          CAST(json_merge_patch('{}', json_object('adjustment', request_params->>'adjustment', 'feed', request_params->>'feed',
            'start', request_params->>'start', 'timeframe', request_params->>'timeframe')) AS VARCHAR) AS params
        FROM bronze
    """,
    "run_summary": f"""
        SELECT source, run_id, request_start, request_end, count(*) AS responses, count(DISTINCT security_id) AS securities,
          CAST(sum(record_count) AS BIGINT) AS bars, {_utc("min(ingested_at)")} AS ingested_at
        FROM bronze GROUP BY source, run_id, request_start, request_end
    """,
    "completeness_missing": """
        SELECT m.security_id, strftime(t.trade_date, '%Y-%m-%d') AS trade_date, s.source
        FROM (SELECT DISTINCT security_id FROM security_master) m, trading_days t, (VALUES ('alpaca'), ('yahoo')) s(source)
        WHERE NOT EXISTS (SELECT 1 FROM daily_bars b WHERE b.security_id = m.security_id AND b.trade_date = t.trade_date AND lower(trim(b.source)) = s.source)
    """,
    "completeness_by_day": """
        SELECT strftime(t.trade_date, '%Y-%m-%d') AS trade_date, s.source, count(*) AS n_missing
        FROM (SELECT DISTINCT security_id FROM security_master) m, trading_days t, (VALUES ('alpaca'), ('yahoo')) s(source)
        WHERE NOT EXISTS (SELECT 1 FROM daily_bars b WHERE b.security_id = m.security_id AND b.trade_date = t.trade_date AND lower(trim(b.source)) = s.source)
        GROUP BY t.trade_date, s.source
    """,
    "vendor_ratio_histogram": f"""
        WITH {_BARS}, l AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY security_id, trade_date, source
          ORDER BY source_ingested_at DESC, source_run_id DESC, given_hash DESC, close DESC) = 1)
        SELECT CAST(floor(abs(CAST(a.close AS DECIMAL(38,10)) * 10000 / CAST(y.close AS DECIMAL(38,10)) + 50 * sign(a.close * y.close)) / 100) / 100
            * sign(a.close * y.close) AS DECIMAL(18,2)) AS ratio, count(*) AS n_days
        FROM l a JOIN l y ON a.security_id = y.security_id AND a.trade_date = y.trade_date
        WHERE a.source = 'alpaca' AND y.source = 'yahoo' AND y.close <> 0 GROUP BY 1
    """,
    "vendor_pivot_by_year": """
        SELECT CAST(year(trade_date) AS INTEGER) AS year, count(*) FILTER (WHERE lower(trim(source)) = 'alpaca') AS alpaca,
          count(*) FILTER (WHERE lower(trim(source)) = 'yahoo') AS yahoo FROM daily_bars GROUP BY 1
    """,
    "bars_overview": """
        SELECT lower(trim(source)) AS source, price_basis, count(*) AS bars, count(DISTINCT security_id) AS securities, count(DISTINCT trade_date) AS sessions,
          min(trade_date) AS first_day, max(trade_date) AS last_day FROM daily_bars GROUP BY 1, 2
    """,
    "bars_total": "SELECT count(*) AS bars FROM daily_bars",
    "bars_in_range": f"""
        SELECT lower(trim(source)) AS source, count(*) AS bars, count(DISTINCT trade_date) AS sessions FROM daily_bars
        WHERE trade_date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' GROUP BY 1
    """,
    "ratio_days": f"""
        WITH {_BARS}, l AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY security_id, trade_date, source
          ORDER BY source_ingested_at DESC, source_run_id DESC, given_hash DESC, close DESC) = 1), r AS (
        SELECT a.security_id, a.trade_date, CAST(floor(abs(CAST(a.close AS DECIMAL(38,10)) * 10000 / CAST(y.close AS DECIMAL(38,10)) + 50 * sign(a.close * y.close)) / 100) / 100
            * sign(a.close * y.close) AS DECIMAL(18,2)) AS ratio
        FROM l a JOIN l y ON a.security_id = y.security_id AND a.trade_date = y.trade_date
        WHERE a.source = 'alpaca' AND y.source = 'yahoo' AND y.close <> 0)
        SELECT security_id, count(*) AS days, min(trade_date) AS first_day, max(trade_date) AS last_day FROM r WHERE ratio <> 1 GROUP BY 1
    """,
    "issuer_ids": "SELECT DISTINCT cik, 'CIK' || lpad(CAST(cik AS VARCHAR), 10, '0') AS issuer_id FROM security_master",
    "vendor_symbols": f"WITH {_CURRENT} SELECT security_id, coalesce(alpaca_symbol, exchange_ticker) AS alpaca_symbol, replace(exchange_ticker, '.', '-') AS yahoo_symbol FROM cur",
    "vendor_requests": f"""
        WITH {_CURRENT}, asked AS (
          SELECT 'alpaca' AS source, security_id, '{{"adjustment":"raw","end":"{LAST_DAY}T23:59:59' || {_offset(LAST_DAY)} || '","feed":"sip","limit":"10000","start":"{FIRST_DAY}T00:00:00' || {_offset(FIRST_DAY)}
            || '","symbols":"' || coalesce(alpaca_symbol, exchange_ticker) || '","timeframe":"1Day"}}' AS params FROM cur
          UNION ALL SELECT 'yahoo', security_id, '{{"actions":"true","auto_adjust":"false","end":"' || strftime(DATE '{LAST_DAY}' + 1, '%Y-%m-%d')
            || '","interval":"1d","start":"{FIRST_DAY}","symbol":"' || replace(exchange_ticker, '.', '-') || '"}}' FROM cur)
        SELECT * FROM asked
    """,
    "figi_lookup": f"""
        WITH {_CURRENT} SELECT security_id, CASE WHEN {_FOUND} THEN figi_ticker END AS figi_ticker, CASE WHEN {_FOUND} THEN replace(figi_ticker, '/', '.') END AS exchange_ticker,
          CASE WHEN {_FOUND} THEN security_name END AS security_name, CASE WHEN {_FOUND} THEN security_type END AS security_type,
          CASE WHEN {_FOUND} THEN share_class_figi END AS share_class_figi, {_FIGI_ERROR} AS figi_error FROM cur c
    """,
    "stale_labels": f"""
        WITH {_CURRENT}, prev AS (
          SELECT * FROM (SELECT DISTINCT * FROM security_master) QUALIFY row_number() OVER (PARTITION BY security_id ORDER BY valid_from) = 1
        ), now AS (SELECT p.security_id, p.exchange_ticker AS label, CASE WHEN c.yfinance_sector IS NOT NULL THEN replace(c.figi_ticker, '/', '.') END AS current_ticker
          FROM prev p JOIN cur c USING (security_id))
        SELECT *, CASE WHEN current_ticker IS NULL THEN 'no longer resolves' ELSE 'renamed' END AS problem FROM now WHERE current_ticker IS DISTINCT FROM label
    """,
    "sec_tickers": f"""
        WITH {_CURRENT}, {_SEC} SELECT match_key, 'CIK' || lpad(CAST(s.c AS VARCHAR), 10, '0') AS issuer_id, s.c AS cik, s.t AS sec_ticker, s.n AS sec_company_name FROM sec
    """,
    "vendor_lookups": f"""
        WITH {_CURRENT} SELECT security_id, CASE WHEN yfinance_name IS NOT NULL THEN yfinance_symbol END AS yfinance_symbol, CASE WHEN yfinance_name IS NOT NULL THEN {_YAHOO_NAME} END AS yfinance_name,
          CASE WHEN yfinance_name IS NOT NULL THEN yfinance_exchange END AS yfinance_exchange, CASE WHEN yfinance_name IS NOT NULL THEN yfinance_sector END AS yfinance_sector,
          CASE WHEN yfinance_name IS NULL THEN 'timeout' END AS yfinance_error, CASE WHEN alpaca_tradable IS NOT NULL THEN alpaca_asset_id END AS alpaca_asset_id,
          CASE WHEN alpaca_tradable IS NOT NULL THEN alpaca_symbol END AS alpaca_symbol, CASE WHEN alpaca_tradable IS NOT NULL THEN alpaca_exchange END AS alpaca_exchange,
          alpaca_tradable, CASE WHEN alpaca_tradable IS NULL THEN 'no API key configured' END AS alpaca_error FROM cur c
    """,
    "last_sessions": """
        WITH d AS (SELECT trade_date, lag(trade_date) OVER (ORDER BY trade_date) AS before FROM trading_days)
        SELECT strftime(trade_date, '%Y-%m-%d') AS trade_date, strftime(before, '%Y-%m-%d') AS last_session, strftime(before - INTERVAL 5 YEAR, '%Y-%m-%d') AS range_start
        FROM d WHERE before IS NOT NULL
    """,
    "revision_histogram": f"""
        WITH {_BARS}, {_REPLAY.format(name="all", where="true")}
        SELECT source, CAST(revisions AS INTEGER) AS revision_count, count(*) AS n_bars FROM replayed_all GROUP BY 1, 2
    """,
    "top_recent_bars": """
        SELECT bar_id, security_id, trade_date, lower(trim(source)) AS source, close FROM daily_bars
        ORDER BY trade_date DESC, lower(trim(source)), bar_id LIMIT 10
    """,
    "exact_price_sum": """
        SELECT lower(trim(source)) AS source, CAST(sum(close) AS DECIMAL(28,4)) AS close_sum, CAST(sum(volume) AS BIGINT) AS volume FROM daily_bars GROUP BY 1
    """,
    "actions_by_type": f"""
        WITH {_CURRENT} SELECT action_type, source, count(*) AS n_actions, count(DISTINCT exchange_ticker) AS n_tickers
        FROM corporate_actions JOIN cur USING (security_id) GROUP BY action_type, source
    """,
    "symbol_spellings": """
        SELECT DISTINCT exchange_ticker, translate(upper(regexp_replace(exchange_ticker, '^\\s+|\\s+$', '', 'g')), '-/ ', '...') AS match_key,
          replace(exchange_ticker, '.', '/') AS figi, replace(exchange_ticker, '.', '-') AS yahoo, replace(replace(exchange_ticker, '.', '/'), '/', '.') AS back
        FROM master_snapshots
    """,
    "match_key_collisions": """
        SELECT translate(upper(trim(sec_ticker)), '-/ ', '...') AS match_key, count(*) AS n_entries
        FROM (SELECT DISTINCT sec_ticker, issuer_id FROM security_master WHERE sec_ticker IS NOT NULL) GROUP BY 1 HAVING count(*) > 1
    """,
    "ticker_mismatch": f"WITH {_CURRENT} SELECT security_id, {_DIFFER} AS ticker_mismatch FROM cur",
    "issuer_shared": f"""
        WITH {_CURRENT} SELECT issuer_id, security_id, exchange_ticker FROM cur
        WHERE issuer_id IN (SELECT issuer_id FROM cur GROUP BY issuer_id HAVING count(*) > 1)
    """,
    "reconcile_resolved": _RECONCILED
    + f"""
        SELECT security_id, issuer_id, exchange_ticker, sec_ticker, yfinance_sector, alpaca_tradable, {_DIFFER} AS ticker_mismatch
        FROM joined WHERE quarantine_reason IS NULL
    """,
    "reconcile_quarantined": _RECONCILED + "SELECT security_id, exchange_ticker, quarantine_reason FROM joined WHERE quarantine_reason IS NOT NULL",
    "quarantine_reasons": _RECONCILED
    + "SELECT quarantine_reason, count(*) AS n_securities FROM joined WHERE quarantine_reason IS NOT NULL GROUP BY quarantine_reason",
    "session_bounds": f"""
        SELECT strftime(trade_date, '%Y-%m-%d') AS trade_date, {_utc("timezone('America/New_York', CAST(trade_date AS TIMESTAMP))")} AS first_second,
          {_utc("timezone('America/New_York', CAST(trade_date AS TIMESTAMP) + INTERVAL 1 DAY) - INTERVAL 1 SECOND")} AS last_second FROM trading_days
    """,
    "build_report": _RECONCILED
    + f"""
        , resolved AS (SELECT *, {_DIFFER} AS mismatch FROM joined WHERE quarantine_reason IS NULL)
        SELECT 'mismatches' AS part, '' AS error, count(*) FILTER (WHERE mismatch) AS n FROM resolved
        UNION ALL SELECT 'shared', '', count(*) FROM resolved WHERE issuer_id IN (SELECT issuer_id FROM resolved GROUP BY issuer_id HAVING count(*) > 1)
        UNION ALL SELECT 'quarantined', '', count(*) FROM joined WHERE quarantine_reason IS NOT NULL
        UNION ALL SELECT 'yfinance_failures', 'timeout', count(*) FROM looked WHERE no_yahoo HAVING count(*) > 0
        UNION ALL SELECT 'alpaca_failures', 'no API key configured', count(*) FROM looked WHERE no_alpaca HAVING count(*) > 0
    """,
    "table_time_travel": _MASTER + _master_versions("moment <= (SELECT DISTINCT snapshot_at FROM master_snapshots ORDER BY 1 LIMIT 1 OFFSET 2)"),
    "table_merged": _MASTER + _master_versions("true", "row_hash,"),
    "table_history": _MASTER
    + """
        , merges AS (SELECT moment, count(*) FILTER (WHERE before IS NULL) AS n_new, count(*) FILTER (WHERE before IS NOT NULL) AS n_changed FROM begun GROUP BY moment)
        SELECT row_number() OVER (ORDER BY moment) AS version, 'MERGE SCD2' AS operation, n_new, n_changed FROM merges
        UNION ALL SELECT 0, 'CREATE', NULL, NULL
    """,
    "table_catalog": _MASTER
    + """
        SELECT 'reference/security_master' AS name, true AS has_files, true AS has_bytes, count(*) AS n_rows, 'valid_to IS NULL OR valid_to > valid_from' AS constraint FROM begun
        UNION ALL SELECT 'bronze/' || lower(trim(source)) || '_bars', true, true, count(*), '' FROM bronze GROUP BY lower(trim(source))
    """,
    "tiny_files": """
        SELECT count(DISTINCT coalesce(run_id, '')) AS n_runs, count(*) AS n_rows, CAST(sum(bronze_id) AS BIGINT) AS sum_ids, count(DISTINCT payload) AS payloads,
          true AS few_files, true AS many_before FROM bronze
    """,
    "job_silver": _DELIVERED
    + f"""
        , hashed AS (SELECT d.*, {_hash(*schemas.BAR_VALUES)} AS value_hash FROM delivered d JOIN bronze b USING (bronze_id)
          WHERE b.request_end >= DATE '{FIRST_DAY}' AND b.request_start <= DATE '{LAST_DAY}')
        SELECT security_id, CAST(trade_date AS DATE) AS trade_date, source, close, volume, value_hash, run_id AS source_run_id, 0 AS revision_count, 3 AS n_versions
        FROM hashed WHERE CAST(trade_date AS DATE) BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'
        QUALIFY row_number() OVER (PARTITION BY security_id, hashed.trade_date, source ORDER BY ingested_at DESC, run_id DESC, value_hash DESC) = 1
    """,
    "stream_once": """
        SELECT lower(trim(source)) AS source, count(DISTINCT CASE WHEN r IS NOT NULL THEN r ELSE concat_ws('|', '', coalesce(security_id, '~'), coalesce(CAST(request_start AS VARCHAR), '~'),
          coalesce(CAST(request_end AS VARCHAR), '~'), coalesce(CAST(page AS VARCHAR), '~'), coalesce(run_id, '~')) END) AS n_messages
        FROM (SELECT *, nullif(replace(lower(trim(response_id)), '-', ''), '') AS r FROM bronze) GROUP BY 1
    """,
    "stream_window_counts": f"""
        SELECT {_utc("time_bucket(INTERVAL 7 DAY, ingested_at, TIMESTAMPTZ '1970-01-01 00:00:00+00')")} AS window_start, lower(trim(source)) AS source,
          count(*) AS n_deliveries, CAST(sum(record_count) AS BIGINT) AS n_records FROM bronze GROUP BY 1, 2
    """,
    "stream_bars": _DELIVERED
    + f"""
        , hashed AS (SELECT *, {_hash(*schemas.BAR_VALUES)} AS value_hash FROM delivered)
        SELECT security_id, CAST(trade_date AS DATE) AS trade_date, source, close, volume, value_hash, run_id AS source_run_id
        FROM hashed WHERE trade_date IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY security_id, hashed.trade_date, source ORDER BY ingested_at DESC, run_id DESC, value_hash DESC) = 1
    """,
}

for _name, _columns in SHOWN.items():
    _texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _columns)
    SQL[_name] = f"SELECT * REPLACE ({_texts}) FROM ({SQL[_name]})"
