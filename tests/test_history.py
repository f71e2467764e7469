from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import history

MASTER = "security_id string, valid_from timestamp, valid_to timestamp, is_current boolean, ticker string, sector string"
SNAPSHOT = "security_id string, snapshot_at timestamp, received_at timestamp, ticker string, sector string, known string, island int"


def day(n):
    return datetime(2026, 1, 1) + timedelta(days=n)


def run(spark, master, snapshots):
    out = history.extend_history(spark.createDataFrame(master, MASTER), spark.createDataFrame(snapshots, SNAPSHOT), "security_id", {c: F.col(c) for c in ("ticker", "sector")}, ["ticker"])
    return sorted((tuple(r) for r in out.select("security_id", "valid_from", "valid_to", "ticker").collect()), key=repr)


def snap(key, at, ticker, sector="x", received=0):
    return (key, day(at), day(at + received), ticker, sector, "clash", 9)


def test_closes_opens_and_leaves(spark):
    master = [
        ("A", day(0), None, False, "A", "x"),
        ("A", day(-9), None, True, "OLD", "x"),
        ("A", day(0), None, False, "A", "x"),
        ("B", day(0), day(1), False, "B", None),
        ("C", day(0), None, True, "C", "x"),
        (None, day(0), None, True, "N", "x"),
    ]
    snapshots = [
        snap("A", 10, "A"), snap("A", 20, "A2"), snap("A", 20, "A3", received=5), snap("A", 30, "A3"), snap("A", 40, "A"), snap("A", 40, "A"),
        snap("B", 10, "B", None), snap("B", 20, "B", "x"),
        snap("D", 20, "D"), snap("D", 30, None),
        snap(None, 10, "Z"),
    ]
    assert run(spark, master, snapshots) == sorted(
        [
            ("A", day(0), day(20), "A"),
            ("A", day(20), day(40), "A3"),
            ("A", day(40), None, "A"),
            ("B", day(0), day(20), "B"),
            ("B", day(20), None, "B"),
            ("D", day(20), day(30), "D"),
            ("D", day(30), None, None),
        ],
        key=repr,
    )


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert run(spark, [("A", day(0), None, True, "A", "x")], []) == []
    assert run(spark, [], [snap("A", 1, "A")]) == [("A", day(1), None, "A")]


def brute(master, snapshots):
    out, state = [], {}
    for key, at, _, _, ticker, sector in sorted(master, key=lambda r: r[1]):
        state[key] = (at, (ticker, sector), False)
    last = {}
    for key, at, received, ticker, sector, *_ in snapshots:
        last[key, at] = max(last.get((key, at), ((datetime.min,),))[0], (received, (ticker is not None, ticker or ""), (sector is not None, sector or ""), ticker, sector), key=lambda r: r[:3]), at
    for (key, at), (row, _) in sorted(last.items(), key=lambda x: x[0][1]):
        values = row[3:5]
        if key in state and (at <= state[key][0] or state[key][1] == values):
            continue
        if key in state:
            out.append((key, state[key][0], at, state[key][1][0]))
        state[key] = (at, values, True)
    out += [(key, at, None, v[0]) for key, (at, v, new) in state.items() if new]
    return sorted(out, key=repr)


value = st.sampled_from(["a", "b", None])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("KLM"), st.integers(1, 6), value, value, st.integers(0, 2)), max_size=25), st.sets(st.sampled_from("KL")))
def test_against_applying_snapshots_one_by_one(spark, states, known):
    master = [(k, day(0), None, True, "a", "a") for k in known]
    snapshots = [snap(k, at, t, s, r) for k, at, t, s, r in states]
    assert run(spark, master, snapshots) == brute(master, snapshots)
