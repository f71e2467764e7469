"""String expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(col: Column) -> Column:
    """Without white space of any kind at either end; SQL's trim removes only spaces."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def folded(col: Column) -> Column:
    """For names whose case and outer blanks don't matter."""
    return F.lower(strip(col))


def iso_seconds(col: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` in the session's zone."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
