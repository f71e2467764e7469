"""Readings that can't be real, relative to what is normal for their series.

A series is one security in one source. Three kinds of cases are kept apart:

- ``impossible``: a price that is zero or negative, a negative volume, a high below the low, a close
  outside of both;
- ``excursion``: at most three sessions away from the levels before and after, on the same side, or a
  volume far above what is usual around it;
- ``stuck``: one reading repeated over four or more successive delivered sessions, with volume.

Excursions are found by a robust autoregression with iterated additive-outlier and level-shift tests: fit, test
the standardised residuals, take out what is found, fit again. All tests are array operations over many series at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import folded
from tidemark.operators.copydiff import later_product, split_factors
from tidemark.operators.skew import HOT_ROWS, broadcast_if_small, hot_keys
from tidemark.session import cut

PRICES = ("close", "high", "low")
READING = ("open", "high", "low", "close", "volume")
IMPOSSIBLE, EXCURSION, STUCK = 1, 2, 4


@dataclass(frozen=True)
class Limits:
    """Parameters of the tests."""

    share: float = 0.2  #: distance from the level, as a share of it
    moves: float = 10.0  #: the same in usual daily moves of the series
    longest: int = 3  #: sessions of an excursion
    volume_times: float = 20.0  #: volume over what is usual around it
    stuck_sessions: int = 4  #: sessions from which a repeated reading is stuck
    level_window: int = 5  #: clean sessions on either side that make a level
    volume_window: int = 10  #: the same for volume
    outlier: float = 3.0  #: standard deviations from which a residual makes an outlier or a shift possible
    volume_outlier: float = 3.0  #: the same for the logarithm of volume


#: Rounds of reweighting in one fit.
ROUNDS = 4
#: A series that hardly moves has residuals of at least this scale, as a share.
LEAST_SIGMA = 1e-4



def _segment_median(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    """Median per group, ignoring nan; nan for a group without values. Groups are in order."""
    ok = ~np.isnan(values)
    v, g = values[ok], group[ok]
    counts = np.bincount(g, minlength=n)
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.full(n, np.nan)
    has = np.flatnonzero(counts > 0)
    widest = counts.max(initial=0)
    if len(has) * widest <= 4 * len(v):  # groups much alike: a row for each, sorted by itself
        rows = np.full((len(has), widest), np.inf)
        rows[np.repeat(np.arange(len(has)), counts[has]), np.arange(len(v)) - np.repeat(starts[has], counts[has])] = v
        rows.sort(axis=1)
        at = np.arange(len(has))
        out[has] = (rows[at, (counts[has] - 1) // 2] + rows[at, counts[has] // 2]) / 2
        return out
    v = v[np.lexsort((v, g))]
    out[has] = (v[starts[has] + (counts[has] - 1) // 2] + v[starts[has] + counts[has] // 2]) / 2
    return out


def _row_median(window: np.ndarray) -> np.ndarray:
    """Median of each row, ignoring nan."""
    ordered = np.sort(window, axis=1)  # nan last
    count = window.shape[1] - np.isnan(ordered).sum(axis=1)
    rows = np.arange(len(window))
    low, high = np.maximum((count - 1) // 2, 0), np.minimum(count // 2, window.shape[1] - 1)
    return np.where(count > 0, (ordered[rows, low] + ordered[rows, high]) / 2, np.nan)


def _levels(values: np.ndarray, clean: np.ndarray, part: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The last and the next ``width`` clean values of the same part before and after every place, nan where fewer."""
    n = len(values)
    at = np.flatnonzero(clean)
    before = np.searchsorted(at, np.arange(n), "left")
    after = np.searchsorted(at, np.arange(n), "right")
    padded = np.concatenate([at, [0]])
    out = []
    for base, step in ((before - 1, -1), (after, 1)):
        index = base[:, None] + step * np.arange(width)[None, :]
        inside = (index >= 0) & (index < len(at))
        place = padded[np.where(inside, index, len(at))]
        inside &= part[place] == part[:, None]
        out.append(np.where(inside, values[place], np.nan))
    return out[0], out[1]


class Model:
    """A robust first-order autoregression of each series, around a level of its own in every part.

    values: one per session, nan where there is none. clean: sessions to fit to. part: number of the stretch
    between two lasting changes of level. Fitted by reweighted least squares to pairs of neighbouring clean
    sessions; ``sigma`` is the robust scale of its residuals.
    """

    def __init__(self, x: np.ndarray, series: np.ndarray, clean: np.ndarray, part: np.ndarray, n: int):
        self.x, self.series, self.part = x, series, part
        first = part - part[0] if len(part) else part
        self.centre = _segment_median(np.where(clean, x, np.nan), first, int(first[-1]) + 1 if len(first) else 0)[first]
        y = x - self.centre
        pair = np.flatnonzero((part[1:] == part[:-1]) & clean[1:] & clean[:-1])
        prev, now, group = y[pair], y[pair + 1], series[pair]
        # a pair counts less the further its first session is from the level (leverage), and the further the second from its forecast
        usual = 3 * 1.4826 * _segment_median(np.abs(prev), group, n)
        leverage = np.minimum(1.0, np.maximum(usual[group], 1e-12) / np.maximum(np.abs(prev), 1e-12))
        phi, scale = np.ones(n), np.zeros(n)
        for _ in range(ROUNDS):
            error = now - phi[group] * prev
            scale = 1.4826 * _segment_median(np.abs(error), group, n)
            bound = 2 * np.maximum(scale[group], 1e-12)
            weight = leverage * np.minimum(1.0, bound / np.maximum(np.abs(error), 1e-12))
            weight[np.isnan(weight)] = 0
            cross = np.bincount(group, weight * prev * now, n)
            square = np.bincount(group, weight * prev * prev, n)
            phi = np.clip(np.where(square > 0, cross / np.maximum(square, 1e-300), 1.0), 0.0, 0.9999)
        self.phi = phi[series]
        self.sigma = np.maximum(np.nan_to_num(scale), LEAST_SIGMA)[series]
        # the nearest clean session of the same part before and after each, and how far it is
        places = np.arange(len(x))
        before = np.maximum.accumulate(np.where(clean, places, -1)) if len(x) else places
        after = np.minimum.accumulate(np.where(clean, places, len(x))[::-1])[::-1] if len(x) else places
        self._last, self._next = np.concatenate([[-1], before[:-1]]), np.concatenate([after[1:], [len(x)]])

    def _neighbour(self, at: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Deviation from the level at places ``at``, and their distance from ``of``; nan outside of the part."""
        inside = (at >= 0) & (at < len(self.x))
        place = np.where(inside, at, 0)
        inside &= self.part[place] == self.part[of]
        return np.where(inside, self.x[place] - self.centre[place], np.nan), np.abs(place - of).astype(float)

    def between(self, at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What to expect in sessions ``at`` of the runs ``starts`` .. ``ends``, and its standard deviation.

        Between the last clean session before the run and the next one after it; nan without both.
        """
        left, a = self._neighbour(self._last[starts], at)
        right, b = self._neighbour(self._next[ends], at)
        phi, before, after = self.phi[at], self.phi[at] ** a, self.phi[at] ** b
        whole = 1 - (before * after) ** 2
        expected = (before * (1 - after**2) * left + after * (1 - before**2) * right) / whole
        deviation = self.sigma[at] * np.sqrt((1 - before**2) * (1 - after**2) / whole / (1 - phi**2))
        return self.centre[at] + expected, deviation

    def outlier(self, values: np.ndarray, at: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Additive-outlier statistic of values in sessions ``at``: their residual over its standard deviation."""
        expected, deviation = self.between(at, starts, ends)
        return (values - expected) / deviation

    def forecasts(self, at: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """What to expect in sessions ``at`` after the last clean session before, and before the next one after, with deviations."""
        out = []
        for places in (self._last[at], self._next[at]):
            near, distance = self._neighbour(places, at)
            phi, reach = self.phi[at], self.phi[at] ** distance
            out.append((self.centre[at] + reach * near, self.sigma[at] * np.sqrt((1 - reach**2) / (1 - phi**2))))
        return out

    def shift(self, at: np.ndarray, longest: int) -> np.ndarray:
        """Level-shift statistic of sessions ``at``: the least surprise among each and its ``longest`` next ones.

        They are compared with the forecast from the last clean session before the first of them; 0 if they
        don't lie on one side, nan where the part is too short to tell.
        """
        left, a = self._neighbour(self._last[at], at)
        out = None
        for k in range(longest + 1):
            value, _ = self._neighbour(at + k, at)
            reach = self.phi[at] ** (a + k)
            z = (value - reach * left) / (self.sigma[at] * np.sqrt((1 - reach**2) / (1 - self.phi[at] ** 2)))
            out = z if out is None else np.where(np.sign(z) == np.sign(out), np.sign(out) * np.minimum(np.abs(out), np.abs(z)), 0 * z * out)
        return out


def _away(value: np.ndarray, level: np.ndarray, move: np.ndarray, limits: Limits) -> np.ndarray:
    """+1 or -1 where a price is away from a level by more than a share of it and by more usual moves than allowed; else 0."""
    far = np.abs(value - level) > np.maximum(limits.share, limits.moves * move) * level
    return np.where(np.isnan(level) | np.isnan(value), 0.0, np.where(far, np.sign(value - level), 0.0))


def _surprise(values: np.ndarray, forecasts: Sequence[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The greater of the standardised residuals from several forecasts."""
    return np.fmax.reduce([(values - expected) / deviation for expected, deviation in forecasts])


def _starts(series: np.ndarray) -> np.ndarray:
    """Where a new series begins."""
    out = np.ones(len(series), bool)
    out[1:] = series[1:] != series[:-1]
    return out


def price_tests(value: np.ndarray, series: np.ndarray, move: np.ndarray, n: int, limits: Limits = Limits()) -> tuple[np.ndarray, np.ndarray, Model]:
    """Excursions of one price field, one value per session: flagged sessions, clean ones, and the model at the end.

    Repeated until nothing new is found: the autoregression is fitted to the sessions that are clean so far;
    its residuals are tested for additive outliers, runs of up to ``longest`` sessions, and for level shifts,
    which last longer. Both tests only raise candidates; one is taken if the distance from the levels
    confirms it: an outlier is away from the level before and from that after, on the same side, and what
    surrounds it is not; a shift is away from the level before for longer than any excursion. Outliers then
    leave the fit and the windows that make levels, and neither reaches across a shift. Both sets only grow, so it ends.
    """
    valid = value > 0
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.where(valid, np.log(value), np.nan)
    flagged, shift = np.zeros(len(value), bool), _starts(series)
    left = np.arange(len(value))  # sessions of series that aren't settled; series are judged each by itself
    while len(left):
        new, lasting = _price_pass(value[left], x[left], series[left], flagged[left], shift[left], move, n, limits)
        own = series[left]
        lasting &= ~np.isin(own, own[new])  # outliers of a series first: levels that still hold them can look like a shift
        flagged[left[new]], shift[left[lasting]] = True, True
        left = left[np.isin(own, own[new | lasting])]
    clean = valid & ~flagged
    return flagged, clean, Model(x, series, clean, np.cumsum(shift), n)


def _price_pass(
    value: np.ndarray, x: np.ndarray, series: np.ndarray, flagged: np.ndarray, shift: np.ndarray, move: np.ndarray, n: int, limits: Limits
) -> tuple[np.ndarray, np.ndarray]:
    """One round of ``price_tests``: sessions newly found to be outliers, and those where a shift is new."""
    clean, part = (value > 0) & ~flagged, np.cumsum(shift)
    model = Model(x, series, clean, part, n)
    windows = _levels(value, clean, part, limits.level_window)
    level_b, level_a = _row_median(windows[0]), _row_median(windows[1])

    def side_of(at: np.ndarray, level: np.ndarray, of: np.ndarray) -> np.ndarray:
        """On which side of a level sessions lie; 0 outside of the part of ``of``."""
        inside = (at >= 0) & (at < len(value))
        place = np.where(inside, at, 0)
        return np.where(inside & (part[place] == part[of]), _away(value[place], level, move[series[of]], limits), 0.0)

    every = np.arange(len(value))
    held = side_of(every, level_b, every)
    starts = np.flatnonzero(held != 0)
    side, before = held[starts], level_b[starts]
    new = np.zeros(len(value), bool)
    # a run of sessions from each start on, judged by the model and the level before it and those after its end
    for length in range(1, limits.longest + 1):
        ends = np.minimum(starts + length - 1, len(value) - 1)
        run = (starts + length <= len(value)) & (part[ends] == part[starts])
        for k in range(length):
            at = np.minimum(starts + k, len(value) - 1)
            z = model.outlier(x[at], at, starts, ends)
            run &= (np.abs(z) > limits.outlier) & (np.sign(z) == side)
            run &= (side_of(at, before, starts) == side) & (side_of(at, level_a[ends], starts) == side)
        # its neighbours must be back at the level, or the change is a longer one
        run &= (side_of(starts - 1, before, starts) != side) & (side_of(starts + length, level_a[ends], starts) != side)
        for k in range(length):
            new[starts[run] + k] = True
    new &= ~flagged

    stat = model.shift(starts, limits.longest)
    lasts = (np.abs(stat) > limits.outlier) & (np.sign(stat) == side) & clean[starts] & ~shift[starts]
    for k in range(1, limits.longest + 1):
        lasts &= side_of(starts + k, before, starts) == side
    lasts &= side_of(starts - 1, before, starts) != side
    lasting = np.zeros(len(value), bool)
    lasting[starts[lasts]] = True
    return new, lasting


def volume_tests(value: np.ndarray, series: np.ndarray, n: int, limits: Limits = Limits()) -> tuple[np.ndarray, np.ndarray, Model]:
    """Sessions of too high a volume (nan where none was traded), what is usual around each, and the model at the end.

    As ``price_tests``: surprises of the autoregression of the logarithm are candidates, the ratio to
    what is usual around them confirms them, and they leave the fit before the next round. A run of any length is
    found session by session.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.log(value)
    high = np.zeros(len(value), bool)
    while True:
        clean = ~np.isnan(value) & ~high
        windows = _levels(np.where(np.isnan(value), 0.0, value), clean, series, limits.volume_window)
        around = _row_median(np.concatenate(windows, axis=1))
        model = Model(x, series, clean, series, n)
        with np.errstate(invalid="ignore"):
            new = (_surprise(x, model.forecasts(np.arange(len(value)))) > limits.volume_outlier) & (value > limits.volume_times * around) & ~high
        if not new.any():
            return high, around, model
        high |= new


#: What a session's other readings are judged by: levels and expectations of each price, and of the volume.
CONTEXT = (
    "move",
    *(f"{k}_{what}" for k in PRICES for what in ("before", "after", "expected", "deviation")),
    "usual_volume", "forward", "forward_deviation", "backward", "backward_deviation",
)


def impossible(readings: dict[str, np.ndarray]) -> np.ndarray:
    o, h, low, c, v = (readings[k] for k in READING)
    with np.errstate(invalid="ignore"):
        return (o <= 0) | (h <= 0) | (low <= 0) | (c <= 0) | (v < 0) | (h < low) | (c > h) | (c < low)


def session_tests(
    series: np.ndarray, n: int, readings: dict[str, np.ndarray], factor: np.ndarray, at: np.ndarray, limits: Limits
) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Excursions among sessions, one reading each, and the ``CONTEXT`` of sessions ``at``."""
    adjusted = {k: readings[k] / factor for k in PRICES}
    with np.errstate(divide="ignore", invalid="ignore"):
        x = np.where(impossible(readings), np.nan, np.log(adjusted["close"]))
    # the usual move of the close
    step = np.abs(x[1:] - x[:-1])
    step[series[1:] != series[:-1]] = np.nan
    move = _segment_median(step, series[1:], n) if len(series) > 1 else np.full(n, np.nan)
    move = np.where(np.isnan(move), 0.0, move)

    found, context = np.zeros(len(series), bool), {"move": move[series[at]]}
    for k in PRICES:
        value = np.where(adjusted[k] > 0, adjusted[k], np.nan)
        flagged, clean, model = price_tests(value, series, move, n, limits)
        found |= flagged
        windows = _levels(np.where(np.isnan(value), 0.0, value), clean, model.part, limits.level_window)
        context[f"{k}_before"], context[f"{k}_after"] = (_row_median(w[at]) for w in windows)
        context[f"{k}_expected"], context[f"{k}_deviation"] = model.between(at, at, at)
    traded = readings["volume"] * factor
    high, around, model = volume_tests(np.where(traded > 0, traded, np.nan), series, n, limits)
    (forward, f_dev), (backward, b_dev) = model.forecasts(at)
    context |= {"usual_volume": around[at], "forward": forward, "forward_deviation": f_dev, "backward": backward, "backward_deviation": b_dev}
    return found | high, context


def superseded_tests(readings: dict[str, np.ndarray], factor: np.ndarray, context: dict[str, np.ndarray], limits: Limits) -> np.ndarray:
    """Excursions among readings that a later delivery superseded, each judged in the place of its session's last one."""
    out = np.zeros(len(factor), bool)
    with np.errstate(divide="ignore", invalid="ignore"):
        for k in PRICES:
            value = readings[k] / factor
            before, after = (_away(value, context[f"{k}_{side}"], context["move"], limits) for side in ("before", "after"))
            z = (np.log(value) - context[f"{k}_expected"]) / context[f"{k}_deviation"]
            out |= (before != 0) & (before == after) & (np.sign(z) == before) & (np.abs(z) > limits.outlier)
        traded = readings["volume"] * factor
        z = _surprise(np.log(traded), [(context["forward"], context["forward_deviation"]), (context["backward"], context["backward_deviation"])])
        return out | ((traded > limits.volume_times * context["usual_volume"]) & (z > limits.volume_outlier))


def detect(series: np.ndarray, day: np.ndarray, readings: dict[str, np.ndarray], factor: np.ndarray, limits: Limits = Limits()) -> np.ndarray:
    """Kinds of cases of each row as a bit set.

    Rows are sorted by series, day and delivery; a series may have several rows a day, of which the last
    makes the series and every one is judged. readings: columns READING as floats, nan for null. factor:
    product of the splits after the day that the series isn't adjusted for.
    """
    out = np.zeros(len(series), np.int32)
    if not len(series):
        return out
    out[impossible(readings)] |= IMPOSSIBLE
    last = np.ones(len(series), bool)
    last[:-1] = (series[1:] != series[:-1]) | (day[1:] != day[:-1])
    session = np.cumsum(np.concatenate([[0], last[:-1].astype(np.int64)]))
    old = np.flatnonzero(~last)
    found, context = session_tests(series[last], int(series[-1]) + 1, {k: readings[k][last] for k in READING}, factor[last], session[old], limits)
    out[last] |= np.where(found, EXCURSION, 0).astype(np.int32)
    out[old[superseded_tests({k: readings[k][old] for k in READING}, factor[old], context, limits)]] |= EXCURSION

    # stuck: the same reading in successive sessions of a series, whether or not a later delivery differs
    columns = [readings[k] for k in READING]
    order = np.lexsort((session, *columns, series))
    same = np.ones(len(order) - 1, bool)
    for values in (series, *columns):
        same &= values[order][1:] == values[order][:-1]
    gap = np.diff(session[order])
    start = np.concatenate([[True], ~(same & (gap <= 1))])
    run = np.cumsum(start) - 1
    first = session[order][start]
    length = np.maximum.reduceat(session[order], np.flatnonzero(start)) - first + 1
    stuck = (length[run] >= limits.stuck_sessions) & (session[order] > first[run]) & (readings["volume"][order] > 0)
    out[order[stuck]] |= STUCK
    return out


def _numbers(table: pa.Table) -> tuple[dict[str, np.ndarray], np.ndarray]:
    return {k: table.column(k).to_numpy().astype(float) for k in READING}, table.column("factor").to_numpy().astype(float)


def _series_numbers(table: pa.Table) -> np.ndarray:
    codes = np.concatenate([c.indices.to_numpy() for c in table.column("series").dictionary_encode().unify_dictionaries().chunks])
    return np.concatenate([[0], np.cumsum(codes[1:] != codes[:-1])])


def _by_series(flush: Callable[[pa.Table], list[pa.RecordBatch]]):
    """A mapInArrow function over rows sorted by series, which gives ``flush`` whole series, many at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            names = batch.column("series")
            final = names[len(names) - 1]
            held.append(batch)
            # rows of the last series stay until the next batch shows that it is complete
            cutoff = pa.compute.index(names, final).as_py()
            if cutoff == 0 and (len(held) == 1 or held[-2].column("series")[-1] == final):
                continue
            done = pa.Table.from_batches([*held[:-1], batch.slice(0, cutoff)])
            held = [batch.slice(cutoff)]
            yield from flush(done)
        if held:
            yield from flush(pa.Table.from_batches(held))

    return run


def _flagged(table: pa.Table, kinds: np.ndarray) -> list[pa.RecordBatch]:
    hit = np.flatnonzero(kinds)
    return table.select(["reading", "n", "bar_id"]).take(pa.array(hit)).append_column("kinds", pa.array(kinds[hit], pa.int32())).combine_chunks().to_batches()


def _flag_series(limits: Limits):
    """Rows sorted by series, day and delivery: the flagged ones and their kinds."""

    def flush(table: pa.Table) -> list[pa.RecordBatch]:
        return _flagged(table, detect(_series_numbers(table), table.column("day").to_numpy(), *_numbers(table), limits))

    return _by_series(flush)


def _session_contexts(limits: Limits):
    """One row per session, sorted by series and day: its place, whether it is an excursion, and its context."""

    def flush(table: pa.Table) -> list[pa.RecordBatch]:
        series, every = _series_numbers(table), np.arange(table.num_rows)
        found, context = session_tests(series, int(series[-1]) + 1, *_numbers(table), every, limits)
        out = table.select(["series", "day", "bar_id"]).rename_columns(["series", "day", "last_id"])
        out = out.append_column("session", pa.array(every - np.flatnonzero(_starts(series))[series])).append_column("excursion", pa.array(found))
        for name in CONTEXT:
            out = out.append_column(name, pa.array(context[name].astype(float)))
        return out.combine_chunks().to_batches()

    return _by_series(flush)


def _flag_by_context(limits: Limits):
    """Rows with their session's context: impossible ones and excursions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            readings, factor = _numbers(table)
            context = {name: table.column(name).to_numpy().astype(float) for name in CONTEXT}
            is_last = table.column("bar_id").to_numpy() == table.column("last_id").to_numpy()
            away = np.where(is_last, table.column("excursion").to_numpy(), superseded_tests(readings, factor, context, limits))
            yield from _flagged(table, (np.where(impossible(readings), IMPOSSIBLE, 0) | np.where(away, EXCURSION, 0)).astype(np.int32))

    return run


#: Flagged readings: keys as JSON where a reading stands for ``n`` > 1 rows, else null.
_FLAGGED = "reading string, n long, bar_id long, kinds int"


def _flag_hot(rows: DataFrame, limits: Limits) -> DataFrame:
    """``reading, n, bar_id, kinds`` of the flagged rows of series with more readings than one task should hold.

    Only the last reading of each session goes into the series' task, no more than the calendar has days; what it
    makes of them, the context of each session, goes to that session's other readings wherever they are. Readings
    repeated over sessions are found by gaps and islands among equal readings.
    """
    fields = ("bar_id", *READING, "factor")
    lasts = rows.groupBy("series", "day").agg(F.max(F.struct("at", *fields)).alias("v")).select("series", "day", *[F.col(f"v.{c}") for c in fields])
    columns = "series string, day int, last_id long, session long, excursion boolean, " + ", ".join(f"{c} double" for c in CONTEXT)
    contexts = cut(lasts.repartition("series").sortWithinPartitions("series", "day").mapInArrow(_session_contexts(limits), columns))
    placed = rows.join(broadcast_if_small(contexts), ["series", "day"])
    away = placed.mapInArrow(_flag_by_context(limits), _FLAGGED)

    whole = placed.where(" AND ".join(["volume > 0", *[f"{c} IS NOT NULL" for c in READING]])).select("series", *READING, "session", "reading", "n", "bar_id")
    alike = Window.partitionBy("series", *READING)
    runs = whole.withColumn("run", F.col("session") - F.row_number().over(alike.orderBy("session")))
    in_run = Window.partitionBy("series", *READING, "run")
    stuck = runs.withColumn("length", F.count(F.lit(1)).over(in_run)).withColumn("first", F.min("session").over(in_run))
    stuck = stuck.where((F.col("length") >= limits.stuck_sessions) & (F.col("session") > F.col("first")))
    both = away.unionByName(stuck.select("reading", "n", "bar_id", F.lit(STUCK).alias("kinds")))
    return both.groupBy("bar_id").agg(F.first("reading").alias("reading"), F.first("n").alias("n"), F.bit_or("kinds").alias("kinds")).select("reading", "n", "bar_id", "kinds")


def flag_bars(bars: DataFrame, actions: DataFrame, unadjusted: tuple[str, ...] = ("alpaca",), limits: Limits = Limits(), hot_rows: int = HOT_ROWS) -> DataFrame:
    """``bar_id`` and ``kinds`` (a bit set of IMPOSSIBLE, EXCURSION, STUCK) of every flagged row of ``bars``.

    Source names are compared without case and outer blanks. Sources in ``unadjusted`` are divided by the
    splits in ``actions``, so a real split is no excursion; a change of level without one is found by the
    level-shift test. A null in a field leaves out the tests that need it. Rows without a security, source
    or day can't be placed in a series and are only tested for impossible values. The last delivery of a
    session (by source_ingested_at, then bar_id) stands for it in the series; every row is judged.
    Excursions that touch the end of a series have no level behind them and aren't flagged.

    Equal readings of a session are first aggregated to one row with a count, map-side too: a series has
    one row per session and distinct reading, however often it was delivered. A series with more than ``hot_rows`` rows
    isn't brought into one task (``_flag_hot``); its rows get the same kinds. Flagged readings that stand for
    several rows are turned into their rows by a join at the end.
    """
    reading = F.struct("security_id", folded(F.col("source")).alias("source"), "trade_date", *READING)
    rows = bars.select("bar_id", "source_ingested_at", reading.alias("r")).select("bar_id", "source_ingested_at", "r.*")
    keys = ["security_id", "source", "trade_date", *READING]
    grouped = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.struct(F.coalesce(F.col("source_ingested_at"), F.timestamp_seconds(F.lit(0))).alias("at"), "bar_id")).alias("newest"),
    )
    factors = split_factors(actions)
    joined = grouped.join(factors, "security_id", "left")
    factor = F.when(F.col("source").isin(*unadjusted), later_product(F.col("splits"), F.col("trade_date"))).otherwise(F.lit(1.0))
    # a row that can't be placed is a series of its own
    placed = F.col("security_id").isNotNull() & F.col("source").isNotNull() & F.col("trade_date").isNotNull()
    series = F.concat(F.lit("s"), "security_id", F.lit("\u0000"), "source")
    name = F.when(placed, series).otherwise(F.concat(F.lit("b"), F.col("newest.bar_id").cast("string")))
    arranged = joined.select(
        name.alias("series"),
        F.coalesce(F.datediff("trade_date", F.lit("1970-01-01")), F.lit(0)).alias("day"),
        F.unix_micros("newest.at").alias("at"),
        F.col("newest.bar_id").alias("bar_id"),
        F.col("n"),
        *[F.col(k).cast("double").alias(k) for k in READING],
        factor.cast("double").alias("factor"),
        # as text: most are null, and a null struct costs more on the way to Python than all other columns
        F.when(F.col("n") > 1, F.to_json(F.struct(*keys))).alias("reading"),
    )
    hot = hot_keys(rows.where(placed).select(series.alias("series")), "series", hot_rows).select("series")
    usual = arranged
    if not hot.isEmpty():
        arranged, hot = cut(arranged), broadcast_if_small(hot)
        usual = arranged.join(hot, "series", "left_anti")
    ordered = usual.repartition("series").sortWithinPartitions("series", "day", "at", "bar_id")
    flagged = ordered.mapInArrow(_flag_series(limits), _FLAGGED)
    if usual is not arranged:
        flagged = flagged.unionByName(_flag_hot(arranged.join(hot, "series", "left_semi"), limits))
    flagged = cut(flagged)

    alone = flagged.where("n = 1").select("bar_id", "kinds")
    read = F.from_json("reading", rows.select(*keys).schema).alias("reading")
    several = flagged.where("n > 1").select(read, "kinds").select(*[F.col(f"reading.{k}").alias(f"r_{k}") for k in keys], "kinds")
    several = broadcast_if_small(several)
    same = [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in keys]
    return alone.union(rows.join(several, same).select("bar_id", "kinds"))
