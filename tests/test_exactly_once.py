import tracemalloc
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import exactly_once

SCHEMA = "bronze_id long, source string, response_id string, run_id string, page int, ingested_at timestamp, key string, hash long, repeated boolean"


def run(spark, deliveries, **more):
    data = [(i, s, r, run, 0, None if at is None else datetime(2026, 1, 1) + timedelta(days=at), "clash", 1, True) for i, s, r, run, at in deliveries]
    frame = spark.createDataFrame(data, SCHEMA)
    key = exactly_once.message_key(F.col("response_id"), F.col("source"), [F.col("run_id"), F.col("page")])
    return sorted(r[0] for r in exactly_once.repeats(frame, key, F.col("ingested_at"), "bronze_id", **more).collect())


def test_spellings_ties_and_nulls(spark):
    deliveries = [
        (1, "a", "AB-cd", "r1", 5), (2, "a", " abcd\n", "r2", 40), (3, "a", "ABCD", "r9", 400), (4, "b", "abcd", "r1", 5),
        (5, "a", None, "r1", 1), (6, "a", " ", "r1", 1), (7, "a", "", "r2", 1),
        (8, "a", "x", "r", 3), (9, "a", "x", "r", 3), (10, "a", "x", "r", 2),
        (11, "a", "y", "r", None), (12, "a", "y", "r", 900), (13, None, "z", "r", 1), (14, None, "Z", "q", 2), (15, "a", "--", None, 1), (16, "a", None, None, 2),
    ]
    assert run(spark, deliveries) == [2, 3, 6, 8, 9, 11, 14, 16]


def test_empty_and_one_message_only(spark):
    assert run(spark, []) == []
    assert run(spark, [(i, "a", "same", "r", i % 7) for i in range(3000)]) == sorted(set(range(3000)) - {0})


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from(["m1", "m2", "M-1", "m3", None]), st.sampled_from("rs"), st.integers(0, 200)), max_size=60), st.integers(1, 90))
def test_against_brute_force(spark, messages, bucket_days):
    deliveries = [(i, *m) for i, m in enumerate(messages)]
    first, repeats = {}, []
    for i, s, r, run_id, at in sorted(deliveries, key=lambda d: (d[4], d[0])):
        key = (s, r.lower().replace("-", "")) if r else (s, None, run_id)
        if key in first:
            repeats.append(i)
        first.setdefault(key, i)
    assert run(spark, deliveries, bucket_days=bucket_days) == sorted(repeats)


def _deliver(spark, store, deliveries):
    data = [(i, k, datetime(2026, 1, 1) + timedelta(days=at)) for i, k, at in deliveries]
    frame = spark.createDataFrame(data, "id long, k string, at timestamp")
    return sorted(r[0] for r in store.deliver(frame, F.col("k"), F.col("at"), "id").collect())


def test_a_later_delivery_reads_only_storage_that_may_know_it(spark, tmp_path):
    path = str(tmp_path / "store")
    store = exactly_once.MessageStore(spark, path, shards=3, bucket_days=30)
    first = [(d * 100 + i, f"m{d}-{i}", d) for d in (0, 40, 80, 120) for i in range(50)]
    assert _deliver(spark, store, first) == [] and store.buckets_read == []
    bucket = lambda day: (datetime(2026, 1, 1) + timedelta(days=day) - datetime(1970, 1, 1)) // timedelta(days=30)
    again = exactly_once.MessageStore(spark, path)  # as another run finds it
    assert (again.shards, again.bucket_days) == (3, 30)
    assert _deliver(spark, again, [(900, "m40-7", 200), (901, "new", 201), (902, "new", 202), (903, "m40-8", 1)]) == [900, 902, 903]
    assert again.buckets_read == sorted({bucket(40), bucket(202)})
    read = again._read(again.log.entry(2)["folders"], exactly_once.NEW, again.buckets_read).inputFiles()
    assert read and not any(f"bucket={bucket(d)}/" in f for f in read for d in (0, 80, 120))
    assert _deliver(spark, again, [(910, "new", 300), (911, None, 300), (912, None, 300)]) == [910]
    assert _deliver(spark, again, []) == []


def test_false_alarms_are_kept_once_and_found_later(spark, tmp_path):
    """Filters of so few bits that most answers are false; the result must not change."""
    store = exactly_once.MessageStore(spark, str(tmp_path / "store"), shards=2, bucket_days=10, bits=1, probes=1)
    seen, want = set(), []
    for batch in range(3):
        rows = [(batch * 100_000 + i, f"k{(i * 7 + batch * 2000) % 9000}", batch * 15 + i // 400) for i in range(6000)]
        want = []
        for i, k, _ in sorted(rows, key=lambda r: (r[2], r[0])):
            if k in seen:
                want.append(i)
            seen.add(k)
        assert _deliver(spark, store, rows) == sorted(want)
    late = [f for f in store.log.entry(3)["folders"] if f.endswith("-late")]
    assert sum(spark.read.parquet(f).count() for f in late) > 500  # false alarms there were


def test_many_deliveries_become_one(spark, tmp_path):
    store = exactly_once.MessageStore(spark, str(tmp_path / "store"), shards=2, bucket_days=30, bits=1, probes=1)
    store.consolidate()  # nothing there yet
    for n in range(4):
        assert _deliver(spark, store, [(n * 10_000 + i, f"d{n}-{i}", 40 * (n % 2) + n) for i in range(3000)]) == []
    filters = lambda: store._read(store.log.entry(store.log.versions()[-1])["folders"], exactly_once.FILTER).count()
    before = filters()
    store.consolidate()
    assert before == 8 and filters() == 4 and len(list((tmp_path / "store").iterdir())) == 2
    assert store._read(store.log.entry(5)["folders"], exactly_once.NEW).count() == 12_000
    again = exactly_once.MessageStore(spark, str(tmp_path / "store"))
    assert _deliver(spark, again, [(n, f"d{n % 4}-{n}", 200) for n in range(2000)] + [(9000, "other", 201)]) == list(range(2000))


def test_a_failed_delivery_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    store = exactly_once.MessageStore(spark, str(tmp_path / "store"), shards=2)
    monkeypatch.setattr(store, "_verify", lambda known, folder: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _deliver(spark, store, [(1, "a", 1)])
    monkeypatch.undo()
    assert [p.name for p in (tmp_path / "store").iterdir()] == ["_log"]
    assert _deliver(spark, store, [(1, "a", 1)]) == [] and _deliver(spark, store, [(1, "a", 1)]) == [1]


def test_memory_of_a_shard():
    """Two million identifiers: their filter and hashes, not the identifiers."""
    screen = exactly_once.Screen()
    screen.bucket = 1
    rng = np.random.default_rng(2)
    tracemalloc.start()
    for _ in range(200):
        screen.check(rng.integers(0, 2**63, 10_000).astype(np.uint64))
    most = tracemalloc.get_traced_memory()[1]
    number, _, bits = screen.close()
    tracemalloc.stop()
    assert number == 1 and len(bits) <= 8_388_608 and most < 64_000_000


def test_the_filter_forgets_nothing_and_seldom_errs():
    rng = np.random.default_rng(1)
    inside, outside = rng.integers(0, 2**63, 20_000).astype(np.uint64), rng.integers(0, 2**63, 20_000).astype(np.uint64)
    bloom = exactly_once.Bloom(len(inside))
    bloom.add(inside)
    assert bloom.might_contain(inside).all()
    assert bloom.might_contain(outside).mean() < 0.02
    assert exactly_once.Bloom(0).might_contain(outside).sum() == 0
