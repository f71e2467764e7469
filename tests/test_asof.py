from datetime import date, datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import asof, skew

EVENTS = "event_id long, k string, at timestamp, version string, n_salts int, valid_from string"
CHANGES = "k string, valid_from timestamp, valid_to timestamp, sector string, event string, n long"


def t(n):
    return datetime(2026, 1, 1) + timedelta(hours=n)


def run(spark, events, changes, **more):
    e = spark.createDataFrame([(i, k, None if at is None else t(at), "clash", 5, "clash") for i, k, at in events], EVENTS)
    c = spark.createDataFrame([(k, t(a), None if b is None else t(b), s, "clash", 1) for k, a, b, s in changes], CHANGES)
    out = asof.as_known(e, F.col("at"), c, "k", ["sector"], ["event_id"], **more)
    return sorted(((r["event_id"], r["valid_from"], r["sector"], r["is_latest"]) for r in out.collect()), key=repr)


def test_boundaries_gaps_and_unknowns(spark):
    changes = [("A", 0, 10, "one"), ("A", 10, 20, "two"), ("A", 30, None, "three"), ("A", 0, 10, "one"), ("B", 5, None, None)]
    events = [(1, "A", 0), (2, "A", 9), (3, "A", 10), (4, "A", 20), (5, "A", 29), (6, "A", 30), (7, "A", -1), (8, "B", 6), (9, "Z", 1), (10, None, 1), (11, "A", None), (3, "A", 10)]
    assert run(spark, events, changes) == sorted(
        [
            (1, t(0), "one", False), (2, t(0), "one", False), (3, t(10), "two", False), (3, t(10), "two", False),
            (4, None, None, None), (5, None, None, None), (6, t(30), "three", True), (7, None, None, None),
            (8, t(5), None, True), (9, None, None, None), (10, None, None, None), (11, None, None, None),
        ],
        key=repr,
    )


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert run(spark, [(1, "A", 0)], []) == [(1, None, None, None)]
    assert run(spark, [], [("A", 0, None, "x")]) == []


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 12)), max_size=30),
    st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 12), st.sampled_from([None, 2, 30])), max_size=8, unique_by=lambda c: c[:2]),
)
def test_split_hot_keys_against_brute_force(spark, events, changes):
    events = [(i, k, at) for i, (k, at) in enumerate(events)]
    changes = [(k, a, None if d is None else a + d, f"s{a}") for k, a, d in changes]
    want = []
    for i, k, at in events:
        before = [c for c in changes if c[0] == k and c[1] <= at]
        best = max(before, key=lambda c: c[1], default=None)
        if best is None or (best[2] is not None and best[2] <= at):
            want.append((i, None, None, None))
        else:
            want.append((i, t(best[1]), best[3], best[1] == max(c[1] for c in changes if c[0] == k)))
    assert run(spark, events, changes, hot_rows=3) == sorted(want, key=repr)


def test_session_end(spark):
    days = spark.createDataFrame([(date(2026, 1, 5),), (date(2026, 7, 6),), (None,)], "d date")
    got = [r[0] for r in days.select(F.date_format(asof.session_end(F.col("d")), "HH:mm")).collect()]
    assert got == ["21:00", "20:00", None]


def test_parts_keep_their_size_however_many_rows(spark, rows):
    """More than a thousand times the limit in all: the parts don't grow with the total."""
    frame = spark.range(60_000).selectExpr("CASE WHEN id < 45000 THEN 'A' WHEN id < 55000 THEN NULL ELSE concat('k', id) END AS k")
    assert rows(skew.hot_keys(frame, "k", 20)) == [("A", 2250), (None, 500)]
    events = spark.range(30_000).selectExpr("id AS event_id", "if(id % 3 = 0, 'B', 'A') AS k", "timestamp'2026-01-01 05:00:00' AS at")
    changes = spark.createDataFrame([("A", t(0), None, "x"), ("B", t(6), None, "y")], "k string, valid_from timestamp, valid_to timestamp, sector string")
    out = asof.as_known(events, F.col("at"), changes, "k", ["sector"], ["event_id"], hot_rows=20)
    assert rows(out.groupBy("k", "sector").count()) == [("A", "x", 20_000), ("B", None, 10_000)]


def test_lookup_of_hot_keys(spark, rows):
    left = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 7}", "clash") for i in range(60)] + [(99, None, "c")], "id long, k string, x string")
    side = spark.createDataFrame([("hot", 1, 7), ("k0", 2, 8), ("none", 3, 9), (None, 4, 9)], "k string, v int, id int")
    want = sorted(((i, {"hot": 1, "k0": 2}.get(k)) for i, k, _ in map(tuple, left.collect())), key=repr)
    for limits in ({}, {"most": 3, "hot_rows": 10}, {"most": 0, "hot_rows": 10}):
        got = skew.lookup(left, side, "k", ["v"], **limits)
        assert got.columns == ["id", "k", "x", "v"] and rows(got.select("id", "v")) == want
    assert skew.lookup(left.limit(0), side, "k", ["v"]).count() == 0 and skew.lookup(left, side.limit(0), "k", ["v"]).where("v IS NULL").count() == 61
