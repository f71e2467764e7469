import random
import re
from datetime import UTC, date, datetime
from zoneinfo import ZoneInfo

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.stamps import instant
from tidemark.operators import timestamps

NY = ZoneInfo("America/New_York")
CASES = [
    ("2023-10-02T14:32:00Z", "2023-10-02 14:32:00"),
    ("2023-10-02t14:32:00z", "2023-10-02 14:32:00"),
    ("2023-10-05T13:58:30-04:00", "2023-10-05 17:58:30"),
    ("2023-10-03T00:00:00-04:00[America/New_York]", "2023-10-03 04:00:00"),
    ("2023-10-04 00:25:00+0530", "2023-10-03 18:55:00"),
    ("2023-10-02 10:10:30 UTC", "2023-10-02 10:10:30"),
    ("2023-10-02 10:10:30 EDT", "2023-10-02 14:10:30"),
    ("Tue, 03 Oct 2023 11:41:00 GMT", "2023-10-03 11:41:00"),
    ("10/03/2023 12:12:00 AM", "2023-10-03 04:12:00"),
    ("10/03/2023 12:12:00 PM", "2023-10-03 16:12:00"),
    ("03-Oct-2023 00:00", "2023-10-03 04:00:00"),
    ("20231002T112715Z", "2023-10-02 11:27:15"),
    ("20231018", "2023-10-18 04:00:00"),
    ("2023-10-02", "2023-10-02 04:00:00"),
    (" 2023-10-02\t", "2023-10-02 04:00:00"),
    ("2023-10-02 09:30", "2023-10-02 13:30:00"),
    ("1696621215", "2023-10-06 19:40:15"),
    ("1696270215000", "2023-10-02 18:10:15"),
    ("1696630020000000", "2023-10-06 22:07:00"),
    ("1696630020000000123", "2023-10-06 22:07:00"),
    ("1697169600.000000", "2023-10-13 04:00:00"),
    ("2023-11-05 01:30:00", "2023-11-05 05:30:00"),  # twice: the first
    ("2023-03-12 02:30:00", "2023-03-12 07:30:00"),  # not at all: forward
    ("2023-13-02 00:00:00", None),
    ("2023-02-30", None),
    ("10/03/2023 13:12:00 PM", None),
    ("yesterday", None),
    ("", None),
    (None, None),
]


def test_every_notation(spark):
    frame = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    got = frame.select("i", F.date_format(instant(F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("t")).collect()
    assert {r["i"]: r["t"] for r in got} == {i: t for i, (_, t) in enumerate(CASES)}


def test_numbers_keep_every_digit(spark):
    """Whole numbers of each unit, with odd milliseconds, before 1970 too, against whole-number arithmetic."""
    rng = random.Random(7)
    cases = []
    for unit, low, high in ((1, -(10**10), 10**11 - 1), (1_000, 10**11, 10**14 - 1), (1_000_000, 10**14, 10**17 - 1), (1_000_000_000, 10**17, 4 * 10**18)):
        cases += [(str(n), n * 1_000_000 // unit) for n in (rng.randint(low, high) for _ in range(500))]
    cases += [("1706668798898000000", 1706668798898000), ("-1706668798898000001", -1706668798898001), ("1.706668798E18", 1706668798000000), ("9.9E18", None), ("1" * 30, None)]
    cases = [c for c in cases if not re.fullmatch(r"\d{8}", c[0])]
    frame = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(cases)], "i int, s string")
    got = {r["i"]: r["t"] for r in frame.select("i", F.unix_micros(instant(F.col("s"))).alias("t")).collect()}
    assert [(cases[i][0], t) for i, t in sorted(got.items())] == cases


def test_policies(spark):
    frame = spark.createDataFrame([("2023-11-05 01:30:00",), ("2023-03-12 02:30:00",), ("2023-06-01 10:00:00",)], "s string")
    got = frame.select(F.date_format(instant(F.col("s"), ambiguous="later", nonexistent="null"), "HH:mm").alias("t")).collect()
    assert [r["t"] for r in got] == ["06:30", None, "14:00"]
    with pytest.raises(ValueError):
        instant(F.col("s"), ambiguous="either")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(datetime(2001, 1, 1), datetime(2037, 1, 1)).map(lambda d: d.replace(microsecond=0)), min_size=50, max_size=50))
def test_local_times_agree_with_the_zone_database(spark, walls):
    """fold=0 is the first of two, and the zone database moves a time in a gap forward."""
    frame = spark.createDataFrame([(i, w.isoformat(" ")) for i, w in enumerate(walls)], "i int, s string")
    got = {r["i"]: r["t"] for r in frame.select("i", F.unix_seconds(instant(F.col("s"))).alias("t")).collect()}
    assert got == {i: int(w.replace(tzinfo=NY).astimezone(UTC).timestamp()) for i, w in enumerate(walls)}


def _bronze(spark, payloads):
    return spark.createDataFrame([(i, " Alpaca ", p, "clash", 7) for i, p in enumerate(payloads)], "bronze_id long, source string, payload string, stamp string, bar_no int")


def test_bars_of_payloads(spark, rows):
    payloads = [
        '{"bars":{"A":[{"t":"2023-10-02T14:32:00Z"},{"t":1696621215},{"t":null}]},"next_page_token":null}',
        '{"columns":["Open"],"index":["20231018","nothing"],"data":[[1.0],[2.0]]}',
        '{"bars":{}}',
        '{"bars":{"A":[{"t":"2023-1',
        '{"index":["2023-10-02"]} {"index":["2023-10-02"]}',
        "",
        None,
        "[]",
        "{'index':['2023-10-02']}",
    ]
    got = timestamps.bar_stamps(_bronze(spark, payloads)).select("bronze_id", "bar_no", "stamp", "trade_date")
    assert rows(got) == sorted(
        [
            (0, 0, "2023-10-02T14:32:00Z", date(2023, 10, 2)),
            (0, 1, "1696621215", date(2023, 10, 6)),
            (0, 2, None, None),
            (1, 0, "20231018", date(2023, 10, 18)),
            (1, 1, "nothing", None),
        ],
        key=repr,
    )
    odd = timestamps.rewritten(timestamps.bar_stamps(_bronze(spark, payloads)))
    assert (0, 1, "2023-10-06T19:40:15.000Z", "2023-10-06") in rows(odd)
    assert odd.count() == 4


def test_no_payloads_and_a_very_long_one(spark):
    assert timestamps.bar_stamps(_bronze(spark, []).limit(0)).count() == 0
    many = ",".join(f'"{1_600_000_000 + i}"' for i in range(50_000))
    assert timestamps.bar_stamps(_bronze(spark, ['{"index":[' + many + "]}"])).where("at IS NOT NULL").count() == 50_000


def test_source_zones(spark):
    bronze = spark.createDataFrame([(1, "tokyo", '{"index":["2023-10-02 09:00:00"]}')], "bronze_id long, source string, payload string")
    got = timestamps.bar_stamps(bronze, {"tokyo": "Asia/Tokyo"}).select(F.date_format("at", "HH:mm")).first()[0]
    assert got == "00:00"
