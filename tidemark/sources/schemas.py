"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE, VWAP = T.DecimalType(18, 4), T.DecimalType(18, 6)


_TYPES = {
    "string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "price": PRICE, "vwap": VWAP,
}


def fields(required: str = "", optional: str = "") -> list[T.StructField]:
    """Fields from ``name type`` pairs between commas, the required ones not null."""
    pairs = [(*pair.split(), nullable) for text, nullable in ((required, False), (optional, True)) for pair in text.split(",") if pair.strip()]
    return [T.StructField(name, _TYPES[kind], nullable) for name, kind, nullable in pairs]


def schema(*parts: list[T.StructField]) -> T.StructType:
    return T.StructType([f for part in parts for f in part])


SCD2_FIELDS = [
    *fields("row_hash string, valid_from timestamp"),
    *fields(optional="valid_to timestamp"),
    *fields("is_current boolean"),
]
LINEAGE_FIELDS = fields(
    "value_hash string, source_ingested_at timestamp, source_run_id string, first_seen_at timestamp, updated_at timestamp, revision_count int"
)

MASTER_ATTRIBUTES = schema(
    fields("security_id string, issuer_id string, cik long"),
    fields(optional="share_class_figi string"),
    fields("exchange_ticker string"),
    fields(
        optional="security_name string, security_type string, figi_ticker string, sec_ticker string, sec_company_name string,"
        "yfinance_symbol string, yfinance_name string, yfinance_exchange string, yfinance_sector string,"
        "alpaca_asset_id string, alpaca_symbol string, alpaca_exchange string, alpaca_tradable boolean"
    ),
    fields("ticker_mismatch boolean"),
)
BRONZE = schema(
    fields(
        "source string, security_id string, vendor_symbol string, request_start date, request_end date, request_params string,"
        "page int, payload string, record_count int, ingested_at timestamp, run_id string"
    )
)
BAR_KEYS = ("security_id", "trade_date", "source")
BAR_VALUES = ("price_basis", "open", "high", "low", "close", "volume", "vwap", "trade_count")
BARS = schema(
    fields("security_id string, trade_date date, source string, price_basis string"),
    fields("open price, high price, low price, close price, volume long"),
    fields(optional="vwap vwap, trade_count long"),
    LINEAGE_FIELDS,
)
#: Parts of a table of bars: a month's bars lie together, so a day's delivery meets one part for each share of the securities.
BAR_LAYOUT = "concat(date_format(trade_date, 'yyyyMM'), '-', pmod(hash(security_id), {shares}))"
ACTION_KEYS = ("security_id", "ex_date", "action_type", "source")
ACTIONS = schema(
    fields("security_id string, ex_date date, action_type string, source string"),
    fields(optional="value vwap"),
    LINEAGE_FIELDS,
)


def with_scd2_fields(attributes: T.StructType) -> T.StructType:
    return T.StructType(attributes.fields + SCD2_FIELDS)


def with_lineage_fields(attributes: T.StructType) -> T.StructType:
    return T.StructType(attributes.fields + LINEAGE_FIELDS)


def drift(declared: T.StructType, actual: T.StructType) -> str | None:
    """What two schemas disagree in, or None: columns missing, unexpected, or of another type."""
    want, have = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (declared, actual))
    missing, unexpected = sorted(want.keys() - have.keys()), sorted(have.keys() - want.keys())
    types = sorted(f"{c} is {have[c]}, not {want[c]}" for c in want.keys() & have.keys() if want[c] != have[c])
    if not (missing or unexpected or types):
        return None
    return f"missing {missing}, unexpected {unexpected}, types {types}"
