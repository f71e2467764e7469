"""One row per security from sources that spell and know it differently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import symbology
from tidemark.sources.schemas import MASTER_ATTRIBUTES

# The columns that each vendor fills.
VENDOR_COLUMNS = {
    "yfinance": ("yfinance_symbol", "yfinance_name", "yfinance_exchange", "yfinance_sector"),
    "alpaca": ("alpaca_asset_id", "alpaca_symbol", "alpaca_exchange", "alpaca_tradable"),
}
SPELLINGS = ("figi_ticker", "sec_ticker", "yfinance_symbol", "alpaca_symbol")


class FanOut(ValueError):
    """A join found several rows for one security."""


class Collision(ValueError):
    """Several entries of one source fold to one match key."""


def sec_tickers(content: DataFrame) -> DataFrame:
    """match_key, issuer_id, cik, sec_ticker, sec_company_name from a JSON object of numbered entries, in ``content``."""
    entries = F.from_json(F.col("content"), "map<string, struct<cik_str: long, ticker: string, title: string>>")
    rows = content.select(F.explode(F.map_values(entries)).alias("e"))
    return rows.select(
        symbology.match_key(F.col("e.ticker")).alias("match_key"),
        symbology.issuer_id(F.col("e.cik_str")).alias("issuer_id"),
        F.col("e.cik_str").alias("cik"),
        F.col("e.ticker").alias("sec_ticker"),
        F.col("e.title").alias("sec_company_name"),
    )


def collisions(sec: DataFrame) -> DataFrame:
    """Match keys that more than one entry folds to."""
    return sec.groupBy("match_key").agg(F.count(F.lit(1)).alias("n_entries")).where("n_entries > 1")


def distinct_sec_tickers(sec: DataFrame) -> DataFrame:
    """sec again; raises Collision if folding made several of its entries look the same, since a security could pick up the wrong issuer."""
    several = collisions(sec).orderBy("match_key").limit(5).collect()
    if several:
        raise Collision(f"entries share a match key, for instance: {[r['match_key'] for r in several]}")
    return sec


_MATCH = "struct<figi: string, compositeFIGI: string, ticker: string, name: string, securityType: string, securityType2: string, shareClassFIGI: string>"
_MAPPED = f"struct<data: array<{_MATCH}>, error: string, warning: string>"


def _matches(answers: DataFrame) -> tuple[DataFrame, Column, Column, Column]:
    """answers with ``a`` (the answer read) and, as expressions: number of matches, the first one, what the service says went wrong."""
    frame = answers if "error" in answers.columns else answers.withColumn("error", F.lit(None).cast("string"))
    read = frame.withColumn("a", F.from_json("answer", _MAPPED))
    says = F.coalesce(F.col("error"), F.col("a.warning"), F.col("a.error"))
    return read, F.coalesce(F.size("a.data"), F.lit(0)), F.try_element_at(F.col("a.data"), F.lit(1)), says


def figi_lookup(answers: DataFrame) -> DataFrame:
    """security_id, figi_ticker, exchange_ticker, figi_error and more from mapping answers (``security_id``, ``answer`` JSON, perhaps ``error``).

    Exactly one match that is the composite asked for gives a ticker; anything else gives an error. An answer that
    can't be read has no matches.
    """
    read, n, match, says = _matches(answers)
    error = (
        F.when(n != 1, F.coalesce(says, F.concat(n.cast("string"), F.lit(" matches"))))
        .when(~match["compositeFIGI"].eqNullSafe(F.col("security_id")), F.concat(F.lit("not a composite FIGI (composite is "), F.coalesce(match["compositeFIGI"], F.lit("none")), F.lit(")")))
    )
    ok = error.isNull()
    return read.select(
        "security_id",
        F.when(ok, match["ticker"]).alias("figi_ticker"),
        F.when(ok, symbology.from_figi(match["ticker"])).alias("exchange_ticker"),
        F.when(ok, match["name"]).alias("security_name"),
        F.when(ok, F.coalesce(match["securityType2"], match["securityType"])).alias("security_type"),
        F.when(ok, match["shareClassFIGI"]).alias("share_class_figi"),
        error.alias("figi_error"),
    )


def resolved_tickers(answers: DataFrame) -> DataFrame:
    """ticker, composite_figi, security_name, problem for answers to jobs by ticker (``security_id`` holds the ticker asked for).

    Of several matches none is picked: a guess is how a list ends up with the wrong security.
    """
    read, n, match, says = _matches(answers)
    problem = F.when(n == 0, F.concat(F.lit("no match ("), F.coalesce(says, F.lit("no answer")), F.lit(")"))).when(n > 1, F.concat(n.cast("string"), F.lit(" matches, not picking one")))
    return read.select(
        F.col("security_id").alias("ticker"),
        F.when(n == 1, match["compositeFIGI"]).alias("composite_figi"),
        F.when(n == 1, match["name"]).alias("security_name"),
        problem.alias("problem"),
    )


def stale_labels(answers: DataFrame, labels: DataFrame) -> DataFrame:
    """security_id, label, current_ticker, problem of labels (``security_id``, ``label``) that no longer hold, by answers to jobs by FIGI."""
    read, n, match, _ = _matches(answers)
    now = read.select("security_id", F.when(n > 0, symbology.from_figi(match["ticker"])).alias("current_ticker"))
    held = labels.join(now, "security_id", "left")
    problem = F.when(F.col("current_ticker").isNull(), "no longer resolves").when(F.col("current_ticker") != F.col("label"), "renamed")
    return held.select("security_id", "label", "current_ticker", problem.alias("problem")).where("problem IS NOT NULL")


def first_given(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def yahoo_info(answers: DataFrame) -> DataFrame:
    """The yfinance columns per security from its info as JSON; the long name unless it is missing or empty. error goes on as yfinance_error."""
    read = answers.withColumn("i", F.from_json("answer", "struct<symbol: string, longName: string, shortName: string, exchange: string, sector: string>"))
    return read.select(
        "security_id",
        F.col("i.symbol").alias("yfinance_symbol"),
        first_given(F.col("i.longName"), F.col("i.shortName")).alias("yfinance_name"),
        F.col("i.exchange").alias("yfinance_exchange"),
        F.col("i.sector").alias("yfinance_sector"),
        _failed("i").alias("yfinance_error"),
    )


def alpaca_assets(answers: DataFrame) -> DataFrame:
    """The alpaca columns per security from its asset as JSON; error goes on as alpaca_error."""
    read = answers.withColumn("i", F.from_json("answer", "struct<id: string, symbol: string, exchange: string, tradable: boolean>"))
    return read.select(
        "security_id",
        F.col("i.id").alias("alpaca_asset_id"),
        F.col("i.symbol").alias("alpaca_symbol"),
        F.col("i.exchange").alias("alpaca_exchange"),
        F.col("i.tradable").alias("alpaca_tradable"),
        _failed("i").alias("alpaca_error"),
    )


def _failed(read: str) -> Column:
    """Why there is no answer: the failure given, or that what came can't be read."""
    return F.coalesce(F.col("error"), F.when(F.col(read).isNull() | F.to_json(read).isin("{}"), "unreadable answer"))


def resolvable(figi: DataFrame) -> DataFrame:
    """Securities the mapping service found, the only ones vendors can be asked about: security_id, exchange_ticker."""
    return figi.where("exchange_ticker IS NOT NULL").select("security_id", "exchange_ticker")


def reconciled(figi: DataFrame, sec: DataFrame, yahoo: DataFrame, alpaca: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """Every attribute of the master per security, and ``quarantine_reason``.

    figi: security_id and exchange_ticker, perhaps more attributes and figi_error. sec is joined by match
    key, the others by security_id, all from the left; a null key joins nothing. The reason is the FIGI
    error, else that there is no SEC match, else null. A vendor that failed on a security (its error column
    is set) keeps the columns of the previous version, if there is one; a good read overwrites, nulls
    included. The spellings are compared after that, as they are and not folded. Attributes that no
    source gives are null. ``fanned_out`` finds securities with several rows.
    """
    left = _with(figi, {"exchange_ticker": "string", "figi_error": "string"}).withColumn("match_key", symbology.match_key(F.col("exchange_ticker")))
    joined = left.join(sec, "match_key", "left")
    for vendor, frame in (("yfinance", yahoo), ("alpaca", alpaca)):
        joined = joined.join(_with(frame, {f"{vendor}_error": "string"}), "security_id", "left")
    error = F.concat(F.lit("OpenFIGI: "), F.col("figi_error"))
    joined = joined.withColumn("quarantine_reason", F.coalesce(error, F.when(F.col("issuer_id").isNull(), "no SEC match")))
    joined = _with(joined, {f.name: f.dataType for f in MASTER_ATTRIBUTES.fields})
    if previous is not None:
        carried = [c for columns in VENDOR_COLUMNS.values() for c in columns]
        held = previous.select(F.col("security_id"), F.struct(*carried).alias("_held"))
        joined = joined.join(held, "security_id", "left")
        for vendor, columns in VENDOR_COLUMNS.items():
            keeps = F.col(f"{vendor}_error").isNotNull() & F.col("_held").isNotNull()
            joined = joined.withColumns({c: F.when(keeps, F.col(f"_held.{c}")).otherwise(F.col(c)) for c in columns})
    flagged = joined.withColumn("ticker_mismatch", symbology.spellings_differ(*[F.col(c) for c in SPELLINGS]))
    return flagged.select(*MASTER_ATTRIBUTES.fieldNames(), "quarantine_reason")


def _with(frame: DataFrame, columns: dict[str, str | T.DataType]) -> DataFrame:
    return frame.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in frame.columns})


def fanned_out(rows: DataFrame) -> DataFrame:
    return rows.groupBy("security_id").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Resolved rows with the master's attributes, and quarantined ones with their reason."""
    resolved = rows.where("quarantine_reason IS NULL").select(*MASTER_ATTRIBUTES.fieldNames())
    return resolved, rows.where("quarantine_reason IS NOT NULL").select("security_id", "exchange_ticker", "quarantine_reason")


def build_snapshot(figi, sec, yahoo, alpaca, previous=None) -> tuple[DataFrame, DataFrame]:
    """Resolved and quarantined rows; raises FanOut where a join found several rows for a security."""
    rows = reconciled(figi, sec, yahoo, alpaca, previous)
    several = fanned_out(rows).limit(5).collect()
    if several:
        raise FanOut(f"several rows for {[r['security_id'] for r in several]}")
    return split(rows)


def vendor_symbol(source: str) -> Column:
    """A vendor's spelling of a security of the master."""
    if source == "alpaca":
        return F.coalesce("alpaca_symbol", symbology.to_alpaca(F.col("exchange_ticker")))
    return symbology.to_yahoo(F.col("exchange_ticker"))


def report(resolved: DataFrame, quarantined: DataFrame, yahoo: DataFrame, alpaca: DataFrame) -> dict[str, DataFrame]:
    """What a build has to say: ``mismatches`` of spellings, ``shared`` issuers, failed lookups by message, ``quarantined``."""
    by_issuer = resolved.where("issuer_id IS NOT NULL").groupBy("issuer_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")

    def failed(frame: DataFrame, vendor: str) -> DataFrame:
        column = f"{vendor}_error"
        return _with(frame, {column: "string"}).where(f"{column} IS NOT NULL").groupBy(F.col(column).alias("error")).agg(F.count(F.lit(1)).alias("n_securities"))

    return {
        "mismatches": resolved.where("ticker_mismatch").select("exchange_ticker", *SPELLINGS),
        "shared": resolved.join(by_issuer, "issuer_id", "left_semi").select("issuer_id", "security_id", "exchange_ticker"),
        "yfinance_failures": failed(yahoo, "yfinance"),
        "alpaca_failures": failed(alpaca, "alpaca"),
        "quarantined": quarantined,
    }
