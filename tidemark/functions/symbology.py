"""Spellings of tickers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip


def match_key(ticker: Column) -> Column:
    """For joins only: stripped, in capitals, every separator a point; separators are never deleted."""
    return F.translate(F.upper(strip(ticker)), "-/ ", "...")


def to_figi(ticker: Column) -> Column:
    return F.translate(ticker, ".", "/")


def from_figi(ticker: Column) -> Column:
    return F.translate(ticker, "/", ".")


def to_yahoo(ticker: Column) -> Column:
    return F.translate(ticker, ".", "-")


def to_alpaca(ticker: Column) -> Column:
    return ticker


def issuer_id(cik: Column) -> Column:
    """CIK and at least ten digits; longer numbers keep all of theirs."""
    return F.when(cik.isNotNull(), F.format_string("CIK%010d", cik.cast("long")))


def spellings_differ(*spellings: Column) -> Column:
    """Whether the raw spellings that are given, neither null nor empty, are more than one."""
    return F.size(F.array_distinct(F.filter(F.array(*spellings), lambda s: s.isNotNull() & (s != "")))) > 1
