"""Reading of timestamps in many notations as one instant, with built-in expressions only.

An ordered cascade of anchored patterns: the first that matches the whole stamp decides, and what it
then holds is parsed strictly, so a thirteenth month gives null instead of another reading. The
session's zone must be UTC; a wall time is carried as the timestamp that reads so in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

# Offsets of the zone abbreviations that vendors write.
ABBREVIATIONS = {
    "Z": "+00:00", "UTC": "+00:00", "GMT": "+00:00",
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00",
    "MST": "-07:00", "MDT": "-06:00", "PST": "-08:00", "PDT": "-07:00",
}

_CLOCK = r"(\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?)"
_ZONE = r"(Z|UTC|GMT|[ECMP][SD]T|[+-]\d{2}:?\d{2})?"

#: (anchored pattern, rewriting as ISO wall time with the month as written, as zone, as half of the day)
CASCADE = (
    # 2023-10-05T13:58:30.250-04:00[America/New_York], blank or T, any fraction, zone or none; 2023-10-02
    (rf"^(\d{{4}}-\d{{2}}-\d{{2}})(?:[T ]{_CLOCK} ?{_ZONE}(?:\[[A-Z_/+-]+\])?)?$", "$1 $2", "$3", ""),
    # Tue, 03 Oct 2023 11:41:00 GMT; 03-Oct-2023 00:00
    (
        rf"^(?:[A-Z]{{3}}, )?(\d{{2}})[ -]([A-Z]{{3}})[ -](\d{{4}})(?: {_CLOCK} ?{_ZONE})?$",
        "$3-$2-$1 $4", "$5", "",
    ),
    # 10/03/2023 11:12:00 AM, the month first
    (rf"^(\d{{2}})/(\d{{2}})/(\d{{4}})(?: {_CLOCK}(?: ([AP]M))?)?$", "$3-$1-$2 $4", "", "$5"),
    # 20231002T112715Z; 20231002
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})(?:T(\d{{2}})(\d{{2}})(\d{{2}}){_ZONE})?$", "$1-$2-$3 $4:$5:$6", "$7", ""),
)

# English month names, in upper case like the stamp being read.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

#: A bare number counts from 1970; below the limit its unit is so many microseconds.
EPOCH = r"^-?\d+(?:\.\d+)?(?:E\+?\d+)?$"
EPOCH_UNITS = ((1e11, 1_000_000), (1e14, 1_000), (1e17, 1))
#: A number that counts nanoseconds beyond this is no stamp.
MOST_NANOS = 9.2e18


def wall_to_utc(wall: Column, zone: Column, ambiguous: str = "earlier", nonexistent: str = "forward") -> Column:
    """The instant of a wall time in a named zone.

    A wall time that occurs twice is the ``earlier`` or the ``later`` of the two; one that doesn't
    exist moves ``forward`` by the gap or gives ``null``.
    """
    first = F.to_utc_timestamp(wall, zone)
    out = first
    if ambiguous == "later":
        second = first + F.expr("INTERVAL 1 HOUR")
        out = F.when(F.from_utc_timestamp(second, zone) == wall, second).otherwise(first)
    elif ambiguous != "earlier":
        raise ValueError("ambiguous must be earlier or later")
    if nonexistent == "null":
        out = F.when(F.from_utc_timestamp(first, zone) == wall, out)
    elif nonexistent != "forward":
        raise ValueError("nonexistent must be forward or null")
    return out


def instant(
    stamp: Column, default_zone: Column | str = "America/New_York", ambiguous: str = "earlier", nonexistent: str = "forward"
) -> Column:
    """A stamp in any notation of CASCADE, or a number since 1970, as a timestamp; null if it is none of them.

    stamp: a string column (a JSON number as its text). default_zone: for stamps without a zone.
    Eight digits are a date; other bare numbers count seconds, milli-, micro- or nanoseconds by size.
    """
    zone = F.lit(default_zone) if isinstance(default_zone, str) else default_zone
    read = F.transform(F.array(F.upper(strip(stamp))), lambda s: _one(s, zone, ambiguous, nonexistent))
    return F.element_at(read, 1)


def _pick(value: Column, choices: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in choices.items() for x in pair]), value)


def _one(s: Column, zone: Column, ambiguous: str, nonexistent: str) -> Column:
    """The instant of one stripped stamp.

    Inside a lambda, where each step is bound to a name by a one-element transform: the steps are used
    several times, and neither evaluated again nor copied into one method too long to compile.
    """
    parts = None
    for pattern, wall, named, half in CASCADE:
        row = F.struct(
            F.regexp_replace(s, pattern, wall).alias("wall"),
            (F.regexp_replace(s, pattern, named) if named else F.lit("")).alias("named"),
            (F.regexp_replace(s, pattern, half) if half else F.lit("")).alias("half"),
        )
        parts = F.when(s.rlike(pattern), row) if parts is None else parts.when(s.rlike(pattern), row)
    from_text = F.element_at(F.transform(F.array(parts), lambda p: _from_parts(p, zone, ambiguous, nonexistent)), 1)
    return F.when(s.rlike(EPOCH) & ~s.rlike(CASCADE[-1][0]), _from_number(s)).otherwise(from_text)


def _from_parts(p: Column, zone: Column, ambiguous: str, nonexistent: str) -> Column:
    text = p["wall"]
    month = _pick(F.substring(text, 6, 3), {m: f"{i:02d}" for i, m in enumerate(MONTHS, 1)})
    lettered = F.when(text.rlike("^.{5}[A-Z]"), F.concat(F.substring(text, 1, 5), month, F.substr(text, F.lit(9)))).otherwise(text)
    dated = F.regexp_replace(F.regexp_replace(lettered, r"[ :]+$", " 00:00:00"), r"( \d{2}:\d{2})$", "$1:00")
    read = F.transform(F.array(dated.try_cast("timestamp")), lambda wall: _from_wall(wall, p, zone, ambiguous, nonexistent))
    return F.element_at(read, 1)


def _from_wall(wall: Column, p: Column, zone: Column, ambiguous: str, nonexistent: str) -> Column:
    hour = F.hour(wall)
    hours = F.when(p["half"] == "", 0).when(hour.between(1, 12), F.when(p["half"] == "PM", 12).otherwise(0) - F.when(hour == 12, 12).otherwise(0))
    full = F.timestamp_micros(F.unix_micros(wall) + hours.cast("long") * 3_600_000_000)
    offset = F.regexp_replace(F.coalesce(_pick(p["named"], ABBREVIATIONS), p["named"]), ":", "")
    minutes = F.substring(offset, 2, 2).cast("int") * 60 + F.substring(offset, 4, 2).cast("int")
    ahead = F.when(F.startswith(offset, F.lit("-")), -minutes).otherwise(minutes)
    zoned = F.timestamp_micros(F.unix_micros(full) - ahead.cast("long") * 60_000_000)
    return F.when(p["named"] == "", wall_to_utc(full, zone, ambiguous, nonexistent)).otherwise(zoned)


def _from_number(s: Column) -> Column:
    number, whole = s.try_cast("double"), s.try_cast("long")
    size = F.abs(number)
    micros = None
    for limit, unit in EPOCH_UNITS:
        # a whole number exactly, since a double doesn't hold all digits
        value = F.coalesce(whole * unit, F.round(number * unit).cast("long"))
        micros = F.when(size < limit, value) if micros is None else micros.when(size < limit, value)
    # nanoseconds divided as whole numbers and rounded down; a double would move them by up to a millisecond
    below = F.call_function("div", whole - F.pmod(whole, F.lit(1_000)), F.lit(1_000))
    written_as_power = F.when(size < MOST_NANOS, F.floor(number / 1_000))
    return F.timestamp_micros(micros.otherwise(F.coalesce(below, written_as_power)))


def new_york_date(at: Column) -> Column:
    """The calendar date of an instant in New York."""
    return F.to_date(F.from_utc_timestamp(at, "America/New_York"))
