"""One UTC instant and one trade date for every bar of a delivered payload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.stamps import instant, new_york_date
from tidemark.functions.text import folded
from tidemark.session import spread

#: Zone of stamps that carry none, by source; the lookup's default is last.
SOURCE_ZONES = {"alpaca": "America/New_York", "yahoo": "America/New_York"}
DEFAULT_ZONE = "America/New_York"

#: A stamp that needs no work.
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"

#: Both layouts of a payload; stamps as text whether they are JSON strings or numbers.
PAYLOAD = "array<struct<bars: map<string, array<struct<t: string>>>, index: array<string>>>"
STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def source_zone(source: Column, zones: dict[str, str] | None = None, default: str = DEFAULT_ZONE) -> Column:
    """The default zone of a source; case and outer blanks of its name don't matter."""
    zones = SOURCE_ZONES if zones is None else zones
    if not zones:
        return F.lit(default)
    lookup = F.create_map(*[F.lit(x) for pair in zones.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, folded(source)), F.lit(default))


def bar_stamps(bronze: DataFrame, zones: dict[str, str] | None = None, **policy: str) -> DataFrame:
    """``bronze_id, bar_no, stamp, at, trade_date`` of every bar in bronze's payloads.

    bar_no is the bar's place in its payload from 0, over all symbols in the order written. A payload
    that is null, empty or not exactly one valid JSON document has no bars (the brackets put around it
    make anything after the document an error). A stamp that no pattern reads has null ``at`` and
    ``trade_date``, and stays. Repeated bronze rows give repeated bars. Extra columns are dropped.

    One pass without a shuffle (only an input smaller than the cluster is spread first): parse, explode, cascade.
    """
    body = F.from_json(F.concat(F.lit("["), F.col("payload"), F.lit("]")), PAYLOAD, STRICT)
    one = F.when(F.size(body) == 1, F.try_element_at(body, F.lit(1)))
    parsed = spread(bronze.select("bronze_id", "source", "payload")).select("bronze_id", source_zone(F.col("source"), zones).alias("zone"), one.alias("body"))
    mapped = F.transform(F.flatten(F.map_values("body.bars")), lambda bar: bar["t"])
    stamps = parsed.select("bronze_id", "zone", F.posexplode(F.coalesce(mapped, F.col("body.index"))).alias("bar_no", "stamp"))
    timed = stamps.withColumn("at", instant(F.col("stamp"), F.col("zone"), **policy))
    return timed.select("bronze_id", "bar_no", "stamp", "at", new_york_date(F.col("at")).alias("trade_date"))


def rewritten(stamps: DataFrame) -> DataFrame:
    """Bars whose stamp was not already written canonically, with the canonical spelling to milliseconds."""
    odd = stamps.where(F.col("stamp").isNull() | ~F.col("stamp").rlike(CANONICAL))
    return odd.select(
        "bronze_id",
        "bar_no",
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("utc_stamp"),
        F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"),
    )
