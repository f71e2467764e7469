from dataclasses import replace
from datetime import date, datetime, timedelta

import numpy as np
import pytest

from tidemark.operators import spikes
from tidemark.operators.spikes import EXCURSION, IMPOSSIBLE, STUCK

BARS = (
    "bar_id long, security_id string, source string, trade_date date, open double, high double, low double, close double, volume long,"
    "source_ingested_at timestamp, splits string, factor double, n long"
)
ACTIONS = "security_id string, ex_date date, action_type string, value double, source_ingested_at timestamp, close double"


def series(n=60, seed=0, level=100.0, volume=100_000):
    """A quiet series: open, high, low, close, volume per session."""
    rng = np.random.default_rng(seed)
    close = level * np.exp(np.cumsum(rng.normal(0, 0.01, n)))
    out = []
    for c in np.round(close, 4):
        out.append([c * 1.001, c * 1.004, c * 0.996, c, int(volume * rng.uniform(0.7, 1.4))])
    return out


def kinds(spark, rows, actions=(), source="alpaca"):
    """Kinds by bar_id for (bar_id, day, reading, delivery) rows of one security."""
    data = [
        (i, "S", source, date(2025, 1, 1) + timedelta(days=d), *map(float, r[:4]), None if r[4] is None else int(r[4]), datetime(2025, 1, 1) + timedelta(days=d, hours=at), "clash", 1.0, 2)
        for i, d, r, at in rows
    ]
    a = [("S", date(2025, 1, 1) + timedelta(days=d), "split", v, datetime(2025, 1, 1), 1.0) for d, v in actions]
    out = spikes.flag_bars(spark.createDataFrame(data, BARS), spark.createDataFrame(a, ACTIONS))
    return {r["bar_id"]: r["kinds"] for r in out.collect()}


def plain(readings):
    return [(i, i, r, 0) for i, r in enumerate(readings)]


def scaled(reading, by):
    return [x * by for x in reading[:4]] + [reading[4]]


def test_quiet_series_and_real_changes_are_no_cases(spark):
    assert kinds(spark, plain(series())) == {}
    split = [scaled(r, 0.1) if i >= 30 else r for i, r in enumerate(series())]
    assert kinds(spark, plain(split), [(30, 10.0)]) == {}
    assert kinds(spark, plain(split)) == {}  # not announced: a level shift
    early = [scaled(r, 0.5) if i >= 3 else r for i, r in enumerate(series())]
    assert kinds(spark, plain(early)) == {}


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_excursions_up_to_three_sessions(spark, length):
    readings = [scaled(r, 1.35) if 20 <= i < 20 + length else r for i, r in enumerate(series())]
    assert kinds(spark, plain(readings)) == ({i: EXCURSION for i in range(20, 20 + length)} if length <= 3 else {})


def test_excursions_of_one_field_near_shifts_and_each_other(spark):
    readings = series()
    readings[10][1] *= 1.4  # the high alone
    readings[25][2] *= 0.6  # the low alone
    readings[28] = scaled(readings[28], 0.7)
    readings = [scaled(r, 0.2) if i >= 40 else r for i, r in enumerate(readings)]
    readings[41] = scaled(readings[41], 1.5)
    readings[38] = scaled(readings[38], 1.5)
    assert kinds(spark, plain(readings)) == dict.fromkeys([10, 25, 28, 38, 41], EXCURSION)


def test_volume_and_halts(spark):
    readings = series()
    readings[15][4] *= 100
    for i in (30, 31, 32, 33, 34):  # halted
        readings[i] = [*readings[29][:4], 0]
    readings[45][4] *= 15
    assert kinds(spark, plain(readings)) == {15: EXCURSION}


def test_impossible_values(spark):
    readings = series()
    readings[5][3] = 0.0
    readings[8] = [readings[8][0], readings[8][2], readings[8][1], readings[8][3], readings[8][4]]
    readings[11][4] = -5
    readings[14][3] = readings[14][1] * 1.01
    assert kinds(spark, plain(readings)) == dict.fromkeys([5, 8, 11, 14], IMPOSSIBLE)


def test_stuck_runs(spark):
    readings = series()
    for i in (21, 22, 23):
        readings[i] = list(readings[20])
    for i in (41, 42):  # three sessions aren't enough
        readings[i] = list(readings[40])
    assert kinds(spark, plain(readings)) == dict.fromkeys([21, 22, 23], STUCK)


def _prices(values, **changed):
    """Flagged sessions of one price field by the tests alone."""
    values = np.array(values, float)
    series = np.zeros(len(values), np.int64)
    move = np.array([np.median(np.abs(np.diff(np.log(values))))])
    return np.flatnonzero(spikes.price_tests(values, series, move, 1, replace(spikes.Limits(), **changed))[0]).tolist()


def _shift_near_an_outlier():
    close = [r[3] for r in series(60, seed=4)]
    close = [c * (1.5 if i >= 30 else 1.0) for i, c in enumerate(close)]
    close[31] *= 1.6  # one session into the new level
    return close


def test_the_outlier_test_decides(monkeypatch):
    close = [r[3] for r in series(60, seed=1)]
    close[20] *= 1.4
    assert _prices(close) == [20]
    assert _prices(close, outlier=1e9) == []
    monkeypatch.setattr(spikes.Model, "outlier", lambda self, values, *rest: np.zeros(len(values)))
    assert _prices(close) == []


def test_the_level_shift_test_decides(monkeypatch):
    close = _shift_near_an_outlier()
    assert _prices(close) == [31]
    monkeypatch.setattr(spikes.Model, "shift", lambda self, at, longest: np.zeros(len(at)))
    assert _prices(close) != [31]


def test_found_outliers_leave_the_fit_and_more_are_found(monkeypatch):
    """The last one is hidden as long as the run before it makes the level."""
    close = [r[3] for r in series(60, seed=2)]
    for i in (20, 21, 22, 24):
        close[i] *= 1.5
    true, fitted = spikes.Model.__init__, []

    def fit(self, x, own, clean, part, n):
        fitted.append(np.flatnonzero(~clean).tolist())
        true(self, x, own, clean, part, n)

    monkeypatch.setattr(spikes.Model, "__init__", fit)
    assert _prices(close) == [20, 21, 22, 24]
    assert fitted[:3] == [[], [20, 21, 22], [20, 21, 22, 24]]


def test_the_fit_resists_outliers():
    rng = np.random.default_rng(5)
    x = np.zeros(4000)
    for i in range(1, len(x)):
        x[i] = 0.7 * x[i - 1] + rng.normal(0, 0.02)
    x[rng.choice(len(x), 80, replace=False)] += 3
    one = np.zeros(len(x), np.int64)
    model = spikes.Model(x + 5, one, np.ones(len(x), bool), one, 1)
    assert np.corrcoef(x[1:], x[:-1])[0, 1] < 0.1  # what least squares would say
    assert abs(model.phi[0] - 0.7) < 0.12 and abs(model.sigma[0] - 0.02) < 0.004 and abs(model.centre[0] - 5) < 0.01


def test_superseded_and_repeated_rows_are_judged(spark):
    readings = series()
    rows = plain(readings)
    rows += [(100, 20, scaled(readings[20], 1.5), -1), (101, 20, scaled(readings[20], 1.5), -1), (102, 20, readings[20], 1), (103, 30, readings[30], 0)]
    assert kinds(spark, rows) == {100: EXCURSION, 101: EXCURSION}


def test_nulls_empty_and_tiny(spark):
    assert kinds(spark, []) == {}
    assert kinds(spark, plain(series(1))) == {}
    assert kinds(spark, plain(series(3))) == {}
    readings = series()
    readings[7][4] = None
    assert kinds(spark, plain(readings)) == {}
    bare = spark.createDataFrame([(1, None, None, None, 1.0, 1.0, 1.0, -1.0, None, None, "x", 1.0, 1), (2, "S", "a", None, None, None, None, None, None, None, "x", 1.0, 1)], BARS)
    out = spikes.flag_bars(bare, spark.createDataFrame([], ACTIONS)).collect()
    assert [(r["bar_id"], r["kinds"]) for r in out] == [(1, IMPOSSIBLE)]


def test_many_series_in_small_batches(spark):
    """Series that straddle batches are judged as a whole."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        data, want = [], set()
        for s in range(20):
            readings = series(seed=s)
            readings[10 + s] = scaled(readings[10 + s], 1.6)
            want.add(s * 100 + 10 + s)
            data += [(s * 100 + i, f"S{s}", "x", date(2025, 1, 1) + timedelta(days=i), *map(float, r[:4]), int(r[4]), datetime(2025, 1, 1), "c", 1.0, 1) for i, r in enumerate(readings)]
        out = spikes.flag_bars(spark.createDataFrame(data, BARS), spark.createDataFrame([], ACTIONS))
        assert {r["bar_id"] for r in out.collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_series_are_judged_alike(spark):
    """Series too large for a task take another way to the same kinds: superseded readings, stuck ones, repeats, all three kinds."""
    rng = np.random.default_rng(9)
    data, number = [], 0
    for s in range(4):
        readings = series(80, seed=s)
        for i in (23, 24, 25):
            readings[i] = list(readings[22])
        readings[50] = scaled(readings[50], 1.5)
        readings[60][4] *= 90
        for i, r in enumerate(readings):
            for k in range(int(rng.integers(1, 5))):  # earlier deliveries of the session, some wrong
                wrong = scaled(r, rng.choice([1.0, 1.001, 1.6, 0.5, -1.0])) if k else r
                if k == 3:
                    wrong = [*r[:4], r[4] * 50]
                data.append((number, f"S{s}", "x", date(2025, 1, 1) + timedelta(days=i), *map(float, wrong[:4]), int(wrong[4]), datetime(2025, 6, 1) - timedelta(hours=k // 2), "c", 1.0, 1))
                number += 1
    frame, none = spark.createDataFrame(data, BARS), spark.createDataFrame([], ACTIONS)
    kinds_ = lambda **o: sorted(map(tuple, spikes.flag_bars(frame, none, **o).collect()))
    plain_ = kinds_()
    assert {k for _, k in plain_} >= {IMPOSSIBLE, EXCURSION, STUCK} and len(plain_) > 100
    assert kinds_(hot_rows=10) == plain_ and kinds_(hot_rows=195) == plain_
