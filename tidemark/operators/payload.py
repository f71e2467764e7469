"""Typed rows from raw vendor payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stamps import instant, new_york_date
from tidemark.functions.text import folded
from tidemark.operators.timestamps import STRICT, source_zone
from tidemark.session import spread

#: Both layouts in one schema, so one parse serves bars and actions.
BODY = (
    "array<struct<"
    "bars: map<string, array<struct<t: string, o: double, h: double, l: double, c: double, v: double, n: double, vw: double>>>,"
    "columns: array<string>, index: array<string>, data: array<array<double>>>>"
)
# Names of the columns of the split layout.
COLUMNS = {"open": "Open", "high": "High", "low": "Low", "close": "Close", "volume": "Volume", "dividend": "Dividends", "split": "Stock Splits"}
#: Without one of these a frame is no frame of bars, which stops the job; the columns of actions may be missing.
REQUIRED = ("open", "high", "low", "close", "volume")
BASIS = {"alpaca": "raw", "yahoo": "vendor_adjusted"}


def parsed(bronze: DataFrame) -> DataFrame:
    """bronze with ``body``: its payload as a struct, null unless it is exactly one valid JSON document."""
    body = F.from_json(F.concat(F.lit("["), F.col("payload"), F.lit("]")), BODY, STRICT)
    return bronze.withColumn("body", F.when(F.size(body) == 1, F.try_element_at(body, F.lit(1))))


def _price(value: Column) -> Column:
    return value.try_cast("decimal(18,4)")


def _whole(value: Column) -> Column:
    """A whole number; null if the value isn't one."""
    return F.when(value == F.floor(value), value.try_cast("long"))


def _mapped_bar(bar: Column) -> Column:
    return F.struct(
        bar["t"].alias("stamp"),
        *[_price(bar[k[0]]).alias(k) for k in ("open", "high", "low", "close")],
        _whole(bar["v"]).alias("volume"),
        bar["vw"].try_cast("decimal(18,6)").alias("vwap"),
        _whole(bar["n"]).alias("trade_count"),
        F.lit(None).cast("double").alias("dividend"),
        F.lit(None).cast("double").alias("split"),
    )


def _framed_bar(columns: Column, stamp: Column, row: Column) -> Column:
    def value(name: str) -> Column:
        # by name, wherever the column stands; null where the row's value is missing
        place = F.nullif(F.array_position(columns, COLUMNS[name]), F.lit(0))
        if name in REQUIRED:
            place = F.coalesce(place, F.raise_error(F.concat(F.lit(f"no column {COLUMNS[name]} in "), F.to_json(columns))).cast("long"))
        return F.try_element_at(row, place.cast("int"))

    return F.struct(
        stamp.alias("stamp"),
        *[_price(value(k)).alias(k) for k in ("open", "high", "low", "close")],
        value("volume").try_cast("long").alias("volume"),
        F.lit(None).cast("decimal(18,6)").alias("vwap"),
        F.lit(None).cast("long").alias("trade_count"),
        value("dividend").alias("dividend"),
        value("split").alias("split"),
    )


def delivered_bars(bronze: DataFrame) -> DataFrame:
    """One row per bar of every payload, with what it was delivered with.

    Columns: bronze_id, bar_no, security_id, source, price_basis, trade_date, open, high, low, close
    (decimal(18,4), half up), volume, vwap (decimal(18,6)), trade_count, dividend, split,
    source_ingested_at, source_run_id. A map payload's bars are those under the row's own vendor_symbol;
    a frame's columns are found by name, and a frame with rows but without one of ``REQUIRED`` is an error. Null, empty or malformed
    payloads and a missing symbol give no rows (``unparsed`` counts them); a value of a wrong type, a count with a fraction
    in a map payload too, is null and is left to the table's NOT NULL check; a frame's volumes are
    doubles and lose their fraction. bar_no counts the bars of the payload from 0.
    """
    body = F.col("body")
    mapped = F.transform(F.try_element_at(body["bars"], F.col("vendor_symbol")), _mapped_bar)
    pairs = F.arrays_zip(body["index"].alias("index"), body["data"].alias("data"))
    framed = F.transform(pairs, lambda p: _framed_bar(body["columns"], p["index"], p["data"]))
    needed = bronze.select("bronze_id", "security_id", "vendor_symbol", "source", "ingested_at", "run_id", "payload")
    rows = parsed(spread(needed)).select(
        "bronze_id",
        "security_id",
        folded(F.col("source")).alias("source"),
        F.col("ingested_at").alias("source_ingested_at"),
        F.col("run_id").alias("source_run_id"),
        F.posexplode(F.when(body["bars"].isNotNull(), mapped).otherwise(framed)).alias("bar_no", "bar"),
    )
    basis = F.create_map(*[F.lit(x) for pair in BASIS.items() for x in pair])
    at = instant(F.col("bar.stamp"), source_zone(F.col("source")))
    return rows.select(
        "bronze_id",
        "bar_no",
        "security_id",
        "source",
        F.try_element_at(basis, F.col("source")).alias("price_basis"),
        new_york_date(at).alias("trade_date"),
        *[F.col(f"bar.{c}") for c in ("open", "high", "low", "close", "volume", "vwap", "trade_count", "dividend", "split")],
        "source_ingested_at",
        "source_run_id",
    )


def bars(delivered: DataFrame) -> DataFrame:
    return delivered.drop("bronze_id", "bar_no", "dividend", "split")


def actions(delivered: DataFrame) -> DataFrame:
    """Dividends and splits as rows; one date may have both, and zeros and nulls are none.

    Only bars that have one are turned from columns into rows.
    """
    kept = ["bronze_id", "security_id", "trade_date", "source", "source_ingested_at", "source_run_id"]
    with_any = delivered.where(F.greatest(F.abs("dividend"), F.abs("split")) > 0)
    rows = with_any.unpivot(kept, ["dividend", "split"], "action_type", "amount").where(F.col("amount") != 0)
    return rows.withColumnRenamed("trade_date", "ex_date").withColumn("value", F.col("amount").try_cast("decimal(18,6)")).drop("amount")


def record_counts(bronze: DataFrame) -> DataFrame:
    """bronze_id and n_records: bars of the symbol asked for in each payload; 0 where there are none or the payload is malformed."""
    body = F.col("body")
    mapped = F.size(F.coalesce(F.try_element_at(body["bars"], F.col("vendor_symbol")), F.expr("array()")))
    framed = F.size(F.coalesce(body["index"], F.expr("array()")))
    rows = parsed(spread(bronze.select("bronze_id", "vendor_symbol", "payload")))
    return rows.select("bronze_id", F.when(body["bars"].isNotNull(), mapped).otherwise(framed).alias("n_records"))


def unparsed(bronze: DataFrame) -> DataFrame:
    """Payloads without rows, by source and reason: null, blank, malformed or empty."""
    body = F.col("body")
    reason = (
        F.when(F.col("payload").isNull(), "null")
        .when(F.trim("payload") == "", "blank")
        .when(body.isNull() | (body["bars"].isNull() & body["index"].isNull()), "malformed")
        .when(F.coalesce(F.size(body["index"]), F.size(F.map_keys(body["bars"]))) == 0, "empty")
    )
    rows = parsed(bronze).select(folded(F.col("source")).alias("source"), reason.alias("reason"))
    return rows.where("reason IS NOT NULL").groupBy("source", "reason").agg(F.count(F.lit(1)).alias("n_payloads"))


def in_range(rows: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Dates from start to end, both included; rows without a date drop out."""
    return rows.where(F.col(column).between(start, end))


def overlapping(bronze: DataFrame, start: Column, end: Column) -> DataFrame:
    """Deliveries whose requested range meets the range asked for."""
    return bronze.where((F.col("request_end") >= start) & (F.col("request_start") <= end))


def request_params(**params: Column) -> Column:
    """Request parameters as JSON with sorted keys."""
    return F.to_json(F.struct(*[params[k].alias(k) for k in sorted(params)]))
