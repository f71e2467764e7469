"""Queries of the data-repair operators, and the same in SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import folded, iso_seconds, strip
from tidemark.operators import asof, compaction, copydiff, exactly_once, history, spikes, timestamps
from tidemark.sources.tables import table

KEYS = ("security_id", "trade_date")
SIDES = ("alpaca", "yahoo")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return spikes.flag_bars(table(spark, folder, "daily_bars"), table(spark, folder, "corporate_actions")).select("bar_id")


def p1_kinds(spark: SparkSession, folder: str) -> DataFrame:
    flagged = spikes.flag_bars(table(spark, folder, "daily_bars"), table(spark, folder, "corporate_actions"))
    kinds = {"impossible": spikes.IMPOSSIBLE, "excursion": spikes.EXCURSION, "stuck": spikes.STUCK}
    return flagged.select("bar_id", *[(F.col("kinds").bitwiseAND(bit) != 0).alias(name) for name, bit in kinds.items()])


def _p1_kind(spark: SparkSession, folder: str, bit: int) -> DataFrame:
    flagged = spikes.flag_bars(table(spark, folder, "daily_bars"), table(spark, folder, "corporate_actions"))
    return flagged.where(F.col("kinds").bitwiseAND(bit) != 0).select("bar_id")


def p1_impossible(spark: SparkSession, folder: str) -> DataFrame:
    return _p1_kind(spark, folder, spikes.IMPOSSIBLE)


def p1_stuck(spark: SparkSession, folder: str) -> DataFrame:
    return _p1_kind(spark, folder, spikes.STUCK)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Small files that the compaction took up: counted in the verified result, not in the input."""
    _, _, held = compaction.compact(spark, f"{folder}/bronze.parquet", counted_by=["file_id"])
    return compaction.small_files(compaction.file_list(table(spark, folder, "bronze_files"), held)).select("file_id")


def p2_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Figures of the compacted dataset by source and run, from the pass that verifies it."""
    sums = {"sum_ids": F.sum("bronze_id"), "payload_bytes": F.sum(F.octet_length("payload").cast("long"))}
    return compaction.compact(spark, f"{folder}/bronze.parquet", counted_by=["source", "run_id"], also=sums)[2]


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return timestamps.rewritten(timestamps.bar_stamps(table(spark, folder, "bronze")))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    attributes = {
        "issuer_id": F.col("issuer_id"),
        "exchange_ticker": F.upper(strip(F.col("exchange_ticker"))),
        "security_name": F.col("security_name"),
        "yfinance_sector": F.col("yfinance_sector"),
        "alpaca_tradable": F.col("alpaca_tradable"),
    }
    versions = history.extend_history(
        table(spark, folder, "security_master"), table(spark, folder, "master_snapshots"), "security_id", attributes, ["exchange_ticker"]
    )
    return versions.select(
        "security_id",
        iso_seconds(F.col("valid_from")).alias("valid_from"),
        F.coalesce(iso_seconds(F.col("valid_to")), F.lit("open")).alias("valid_to"),
        "exchange_ticker",
    )


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    without = [F.col(c) for c in ("security_id", "request_start", "request_end", "page", "run_id")]
    key = exactly_once.message_key(F.col("response_id"), F.col("source"), without)
    return exactly_once.repeats(table(spark, folder, "bronze"), key, F.col("ingested_at"), "bronze_id")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    known = asof.as_known(
        table(spark, folder, "daily_bars"),
        asof.session_end(F.col("trade_date")),
        table(spark, folder, "security_master"),
        "security_id",
        [],
        ["bar_id"],
    )
    other = known.where(F.col("valid_from").isNull() | ~F.col("is_latest"))
    return other.select("bar_id", F.coalesce(iso_seconds(F.col("valid_from")), F.lit("none")).alias("valid_from"))


def p6_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """Every bar with the ticker and sector in force at the end of its session."""
    return asof.as_known(
        table(spark, folder, "daily_bars"),
        asof.session_end(F.col("trade_date")),
        table(spark, folder, "security_master"),
        "security_id",
        ["exchange_ticker", "yfinance_sector"],
        ["bar_id"],
    ).select("bar_id", "security_id", iso_seconds(F.col("valid_from")).alias("valid_from"), "exchange_ticker", "yfinance_sector")


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    bars = table(spark, folder, "daily_bars").withColumn("source", folded(F.col("source")))
    keyed = bars.where(F.col("source").isin(*SIDES))
    latest = copydiff.newest(keyed, [*KEYS, "source"], ["source_ingested_at", "bar_id"], ["close", "volume", "price_basis"])
    factors = copydiff.split_factors(table(spark, folder, "corporate_actions"))
    factor = F.when(folded(F.col("price_basis")) == "raw", copydiff.later_product(F.col("splits"), F.col("trade_date"))).otherwise(1.0)
    comparable = (
        latest.join(factors, "security_id", "left")
        .withColumn("factor", factor)
        .select(
            *KEYS,
            "source",
            folded(F.col("price_basis")).alias("price_basis"),
            (F.col("close").cast("double") / F.col("factor")).alias("close"),
            (F.col("volume").cast("double") * F.col("factor")).alias("volume"),
        )
    )
    tests = {
        "price_basis": lambda a, y: ~a["price_basis"].eqNullSafe("raw") | ~y["price_basis"].eqNullSafe("vendor_adjusted"),
        "close": lambda a, y: copydiff.beyond(a["close"], y["close"], 0.001),
        "volume": lambda a, y: copydiff.beyond(a["volume"], y["volume"], 0.02),
    }
    found = copydiff.compare_copies(comparable, KEYS, "source", SIDES, ["price_basis", "close", "volume"], tests)
    return found.select("security_id", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"), "field")


QUERIES = {
    f.__name__: f for f in (p1_found, p1_kinds, p1_impossible, p1_stuck, p2_found, p2_compacted, p3_found, p4_found, p5_found, p6_found, p6_attributes, p7_found)
}

_P3_STAMPS = r"""
WITH body AS (
  SELECT bronze_id, CAST(payload AS JSON) AS j FROM bronze WHERE json_valid(payload)
), listed AS (
  SELECT bronze_id, CASE WHEN json_type(j, '$.bars') = 'OBJECT' THEN json_extract_string(j, '$.bars.*[*].t')
                         ELSE json_extract_string(j, '$.index[*]') END AS stamps
  FROM body
), stamped AS (
  SELECT bronze_id, CAST(unnest(range(len(stamps))) AS INTEGER) AS bar_no, unnest(stamps) AS raw FROM listed
), odd AS (
  SELECT bronze_id, bar_no, upper(trim(raw)) AS s FROM stamped
  WHERE raw IS NULL OR NOT regexp_full_match(raw, '\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z')
), split AS (
  SELECT *, regexp_extract(s, '^(\d{4}-\d{2}-\d{2})[T ]?(\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?)?\d* ?(Z|UTC|GMT|[ECMP][SD]T|[+-]\d{2}:?\d{2})?(\[.*\])?$', ['d', 't', 'x', 'y', 'z']) AS iso,
    regexp_extract(s, '^([A-Z]{3}, )?(\d{2})[ -]([A-Z]{3})[ -](\d{4}) ?(\d{2}:\d{2}(:\d{2})?)? ?(Z|UTC|GMT|[ECMP][SD]T|[+-]\d{2}:?\d{2})?$', ['w', 'd', 'm', 'y', 't', 'x', 'z']) AS named,
    regexp_extract(s, '^(\d{2}/\d{2}/\d{4}) ?(\d{2}:\d{2}:\d{2})? ?([AP]M)?$', ['d', 't', 'h']) AS us,
    regexp_extract(s, '^(\d{8})(T(\d{6}))?(Z)?$', ['d', 'x', 't', 'z']) AS basic
  FROM odd
), walls AS (
  SELECT bronze_id, bar_no, s,
    CASE WHEN iso.d <> '' THEN iso.z WHEN named.d <> '' THEN named.z WHEN basic.d <> '' THEN basic.z ELSE '' END AS z,
    CASE WHEN iso.d <> '' THEN try_cast(iso.d || ' ' || CASE WHEN iso.t = '' THEN '00:00:00' WHEN length(iso.t) = 5 THEN iso.t || ':00' ELSE iso.t END AS TIMESTAMP)
         WHEN named.d <> '' THEN try_strptime(named.d || ' ' || named.m || ' ' || named.y || ' ' || CASE WHEN named.t = '' THEN '00:00:00' WHEN length(named.t) = 5 THEN named.t || ':00' ELSE named.t END, '%d %b %Y %H:%M:%S')
         WHEN us.d <> '' AND us.h <> '' THEN try_strptime(us.d || ' ' || us.t || ' ' || us.h, '%m/%d/%Y %I:%M:%S %p')
         WHEN us.d <> '' THEN try_strptime(us.d || ' ' || CASE WHEN us.t = '' THEN '00:00:00' ELSE us.t END, '%m/%d/%Y %H:%M:%S')
         WHEN basic.d <> '' THEN try_strptime(basic.d || CASE WHEN basic.t = '' THEN '000000' ELSE basic.t END, '%Y%m%d%H%M%S')
    END AS wall
  FROM split
), timed AS (
  SELECT bronze_id, bar_no,
    CASE WHEN wall IS NOT NULL AND z = '' THEN timezone('America/New_York', wall)
         WHEN wall IS NOT NULL THEN timezone('UTC', wall - to_minutes(CAST(
           CASE WHEN z IN ('Z', 'UTC', 'GMT') THEN 0 WHEN z = 'EST' THEN -300 WHEN z = 'EDT' THEN -240
                WHEN z = 'CST' THEN -360 WHEN z = 'CDT' THEN -300 WHEN z = 'MST' THEN -420 WHEN z = 'MDT' THEN -360 WHEN z = 'PST' THEN -480 WHEN z = 'PDT' THEN -420
                ELSE CAST(z[1] || '1' AS INTEGER) * (CAST(z[2:3] AS INTEGER) * 60 + CAST(right(z, 2) AS INTEGER)) END AS INTEGER)))
         WHEN try_cast(s AS DOUBLE) IS NOT NULL AND NOT regexp_full_match(s, '\d{8}') THEN make_timestamptz(
           CASE WHEN abs(CAST(s AS DOUBLE)) < 1e11 THEN CAST(round(CAST(s AS DOUBLE) * 1e6) AS BIGINT)
                WHEN abs(CAST(s AS DOUBLE)) < 1e14 THEN CAST(round(CAST(s AS DOUBLE) * 1e3) AS BIGINT)
                WHEN abs(CAST(s AS DOUBLE)) < 1e17 THEN coalesce(try_cast(s AS BIGINT), CAST(CAST(s AS DOUBLE) AS BIGINT))
                ELSE coalesce(try_cast(s AS BIGINT) // 1000, CAST(floor(CAST(s AS DOUBLE) / 1e3) AS BIGINT)) END)
    END AS moment, wall, z
  FROM walls
), settled AS (
  SELECT bronze_id, bar_no,
    CASE WHEN z = '' AND timezone('America/New_York', moment - INTERVAL 1 HOUR) = wall THEN moment - INTERVAL 1 HOUR ELSE moment END AS moment
  FROM timed
)
SELECT bronze_id, bar_no, strftime(timezone('UTC', moment), '%Y-%m-%dT%H:%M:%S.%gZ') AS utc_stamp,
  strftime(timezone('America/New_York', moment), '%Y-%m-%d') AS trade_date
FROM settled
"""

_UTC = "strftime(timezone('UTC', {0}), '%Y-%m-%d %H:%M:%S')"

_IN_FORCE = """
WITH ends AS (
  SELECT bar_id, security_id, timezone('America/New_York', CAST(trade_date AS TIMESTAMP) + INTERVAL 16 HOUR) AS moment FROM daily_bars
), versions AS (
  SELECT security_id, valid_from, valid_to, exchange_ticker, yfinance_sector,
    max(valid_from) OVER (PARTITION BY security_id) AS newest
  FROM (SELECT DISTINCT security_id, valid_from, valid_to, exchange_ticker, yfinance_sector FROM security_master)
), met AS (
  SELECT e.bar_id, e.security_id, e.moment, v.*EXCLUDE (security_id)
  FROM ends e ASOF LEFT JOIN versions v ON e.security_id = v.security_id AND e.moment >= v.valid_from
), held AS (
  SELECT *, valid_from IS NOT NULL AND (valid_to IS NULL OR valid_to > moment) AS holds FROM met
)
"""

SQL = {
    "p1_impossible": """
        SELECT bar_id FROM daily_bars
        WHERE coalesce(open <= 0, false) OR coalesce(high <= 0, false) OR coalesce(low <= 0, false) OR coalesce(close <= 0, false) OR coalesce(volume < 0, false)
          OR coalesce(high < low, false) OR coalesce(close > high, false) OR coalesce(close < low, false)
    """,
    "p1_stuck": """
        WITH placed AS (
          SELECT bar_id, security_id, lower(trim(source)) AS side, open, high, low, close, volume,
            dense_rank() OVER (PARTITION BY security_id, lower(trim(source)) ORDER BY trade_date) AS session
          FROM daily_bars WHERE security_id IS NOT NULL AND source IS NOT NULL AND trade_date IS NOT NULL
        ), readings AS (
          SELECT DISTINCT security_id, side, open, high, low, close, volume, session FROM placed
          WHERE volume > 0 AND open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
        ), runs AS (
          SELECT *, session - row_number() OVER (PARTITION BY security_id, side, open, high, low, close, volume ORDER BY session) AS run FROM readings
        ), stuck AS (
          SELECT security_id, side, open, high, low, close, volume, min(session) AS first, max(session) AS last FROM runs
          GROUP BY security_id, side, open, high, low, close, volume, run HAVING count(*) >= 4
        )
        SELECT bar_id FROM placed p JOIN stuck s USING (security_id, side, open, high, low, close, volume)
        WHERE p.session > s.first AND p.session <= s.last
    """,
    "p2_found": """
        SELECT DISTINCT file_id FROM bronze_files
        WHERE lower(trim(status)) = 'committed' AND size_bytes < 49152 AND file_id IN (SELECT file_id FROM bronze)
    """,
    "p2_compacted": """
        SELECT source, run_id, count(*) AS n_rows, CAST(sum(bronze_id) AS BIGINT) AS sum_ids,
          CAST(sum(strlen(payload)) AS BIGINT) AS payload_bytes
        FROM bronze GROUP BY source, run_id
    """,
    "p3_found": _P3_STAMPS,
    "p4_found": f"""
        WITH base AS (
          SELECT security_id, max_by(struct_pack(i := issuer_id, t := upper(trim(exchange_ticker)), n := security_name, y := yfinance_sector, a := alpaca_tradable), valid_from) AS s,
            max(valid_from) AS moment
          FROM security_master GROUP BY security_id
        ), snap AS (
          SELECT security_id, snapshot_at AS moment, struct_pack(i := issuer_id, t := upper(trim(exchange_ticker)), n := security_name, y := yfinance_sector, a := alpaca_tradable) AS s,
            row_number() OVER (PARTITION BY security_id, snapshot_at ORDER BY received_at DESC) AS r
          FROM master_snapshots
        ), states AS (
          SELECT security_id, moment, s, true AS known FROM base
          UNION ALL SELECT snap.security_id, snap.moment, snap.s, false FROM snap LEFT JOIN base USING (security_id)
          WHERE r = 1 AND (base.moment IS NULL OR snap.moment > base.moment)
        ), starts AS (
          SELECT *, lag(s) OVER w IS DISTINCT FROM s OR lag(moment) OVER w IS NULL AS begins FROM states
          WINDOW w AS (PARTITION BY security_id ORDER BY moment)
        ), versions AS (
          SELECT security_id, moment, s.t AS exchange_ticker, known, lead(moment) OVER (PARTITION BY security_id ORDER BY moment) AS until
          FROM starts WHERE begins
        )
        SELECT security_id, {_UTC.format("moment")} AS valid_from, coalesce({_UTC.format("until")}, 'open') AS valid_to, exchange_ticker
        FROM versions WHERE NOT known OR until IS NOT NULL
    """,
    "p5_found": """
        SELECT bronze_id FROM (
          SELECT bronze_id, row_number() OVER (
            PARTITION BY source, r, CASE WHEN r IS NULL THEN struct_pack(a := security_id, b := request_start, c := request_end, d := page, e := run_id) END
            ORDER BY ingested_at, bronze_id) AS n
          FROM (SELECT *, nullif(replace(lower(trim(response_id)), '-', ''), '') AS r FROM bronze))
        WHERE n > 1
    """,
    "p6_found": _IN_FORCE
    + f"""
        SELECT bar_id, CASE WHEN holds THEN {_UTC.format("valid_from")} ELSE 'none' END AS valid_from
        FROM held WHERE NOT holds OR valid_from <> newest
    """,
    "p6_attributes": _IN_FORCE
    + f"""
        SELECT bar_id, security_id, CASE WHEN holds THEN {_UTC.format("valid_from")} END AS valid_from,
          CASE WHEN holds THEN exchange_ticker END AS exchange_ticker, CASE WHEN holds THEN yfinance_sector END AS yfinance_sector
        FROM held
    """,
    "p7_found": """
        WITH latest AS (
          SELECT *, lower(trim(source)) AS side, lower(trim(price_basis)) AS basis FROM daily_bars
          QUALIFY row_number() OVER (PARTITION BY security_id, trade_date, side ORDER BY source_ingested_at DESC, bar_id DESC) = 1
        ), splits AS (
          SELECT security_id, ex_date, CAST(max_by(value, source_ingested_at) AS DOUBLE) AS value
          FROM corporate_actions WHERE action_type = 'split' GROUP BY security_id, ex_date
        ), factors AS (
          SELECT l.bar_id, product(s.value) AS f FROM latest l JOIN splits s ON s.security_id = l.security_id AND s.ex_date > l.trade_date
          WHERE l.basis = 'raw' GROUP BY l.bar_id
        ), ready AS (
          SELECT security_id, trade_date, side, basis, CAST(close AS DOUBLE) / coalesce(f, 1) AS c, CAST(volume AS DOUBLE) * coalesce(f, 1) AS v
          FROM latest LEFT JOIN factors USING (bar_id)
        ), pairs AS (
          SELECT coalesce(a.security_id, y.security_id) AS security_id, coalesce(a.trade_date, y.trade_date) AS d,
            a.side AS sa, y.side AS sy, a.basis AS ba, y.basis AS by_, a.c AS ca, y.c AS cy, a.v AS va, y.v AS vy
          FROM (SELECT * FROM ready WHERE side = 'alpaca') a FULL JOIN (SELECT * FROM ready WHERE side = 'yahoo') y
            ON a.security_id = y.security_id AND a.trade_date = y.trade_date
        ), found AS (
          SELECT security_id, d, 'missing_alpaca' AS field FROM pairs WHERE sa IS NULL
          UNION ALL SELECT security_id, d, 'missing_yahoo' FROM pairs WHERE sy IS NULL
          UNION ALL SELECT security_id, d, 'price_basis' FROM pairs WHERE sa IS NOT NULL AND sy IS NOT NULL AND (ba IS DISTINCT FROM 'raw' OR by_ IS DISTINCT FROM 'vendor_adjusted')
          UNION ALL SELECT security_id, d, 'close' FROM pairs WHERE abs(ca - cy) > 0.001 * greatest(abs(ca), abs(cy))
          UNION ALL SELECT security_id, d, 'volume' FROM pairs WHERE abs(va - vy) > 0.02 * greatest(abs(va), abs(vy))
        )
        SELECT security_id, strftime(d, '%Y-%m-%d') AS trade_date, field FROM found
    """,
}
