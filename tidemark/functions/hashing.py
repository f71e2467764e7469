"""Row hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands between two columns and for a null.
SEPARATOR, NULL = "\u001f", "\u0000"


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns' text, in the order given; null differs from the empty string.

    A value that holds the separator or equals the null mark can collide; ``history.state_hash`` has no
    such values and is used where no stored hash must be met.
    """
    return F.sha2(F.concat_ws(SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit(NULL)) for c in columns]), 256)
