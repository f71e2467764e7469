from datetime import date, datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import latest_wins, scd2
from tidemark.sources import schemas
from tidemark.sources.schemas import fields, schema
from tidemark.sources.versioned import PART, ConcurrentCommit, ConstraintViolation, SchemaMismatch, VersionedTable, VersionExpired, find_tables

ATTRIBUTES = schema(fields("k string"), fields(optional="ticker string"))


def day(n):
    return datetime(2026, 10, n, 12)


@pytest.fixture
def master(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "master"))
    scd2.ensure_table(table, ATTRIBUTES)
    return table


def snap(spark, **rows):
    return spark.createDataFrame(list(rows.items()), "k string, ticker string")


def merge(spark, table, n, **rows):
    return scd2.merge_snapshot(table, snap(spark, **rows), "k", day(n))


def test_scd2_from_opening_to_reopening(spark, master, rows):
    """A lab moves rooms and back; another one is missing from a snapshot and later loses its room."""
    assert merge(spark, master, 2, lab1="north", lab2="cellar") == {"new": 2, "changed": 0, "unchanged": 0}
    assert merge(spark, master, 5, lab1="north", lab2="cellar") == {"new": 0, "changed": 0, "unchanged": 2}
    assert master.versions() == [0, 1]  # nothing changed, nothing published
    assert merge(spark, master, 8, lab1="attic", lab3="annex") == {"new": 1, "changed": 1, "unchanged": 0}
    assert merge(spark, master, 13, lab1="north", lab2=None) == {"new": 0, "changed": 2, "unchanged": 0}
    history = master.read()
    held = {}
    for r in history.orderBy("valid_from").collect():
        held.setdefault(r["k"], []).append((r["ticker"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day, r["is_current"]))
    assert held == {
        "lab1": [("north", 2, 8, False), ("attic", 8, 13, False), ("north", 13, None, True)],
        "lab2": [("cellar", 2, 13, False), (None, 13, None, True)],
        "lab3": [("annex", 8, None, True)],
    }
    room = lambda at: dict(scd2.as_of(history, at).select("k", "ticker").collect())
    assert room("2026-10-01") == {} and room("2026-10-07 23:59:59") == {"lab1": "north", "lab2": "cellar"}
    assert room(day(8)) == {"lab1": "attic", "lab2": "cellar", "lab3": "annex"}  # the boundary belongs to the new version
    assert scd2.broken_keys(history, "k").count() == 0
    assert rows(scd2.changed_keys(history, "k")) == [("lab1", 3), ("lab2", 2)]


def test_scd2_refusals_leave_nothing_behind(spark, master):
    merge(spark, master, 5, A="x")
    for n in (4, 5):
        with pytest.raises(ConstraintViolation, match="valid_interval"):
            merge(spark, master, n, A="y")
    with pytest.raises(ValueError, match="repeats"):
        scd2.merge_snapshot(master, snap(spark, A="p").union(snap(spark, A="q")), "k", day(9))
    with pytest.raises(ConstraintViolation, match="NOT NULL k"):
        scd2.merge_snapshot(master, spark.createDataFrame([(None, "z")], "k string, ticker string"), "k", day(9))
    assert master.versions() == [0, 1] and master.read().count() == 1


values = st.dictionaries(st.sampled_from("ABC"), st.sampled_from(["x", "y", None]))


@settings(max_examples=4, deadline=None)
@given(st.lists(values, min_size=1, max_size=4))
def test_scd2_fold_is_the_replay(spark, snapshots):
    empty = spark.createDataFrame([], schemas.with_scd2_fields(ATTRIBUTES))
    state = empty
    for n, s in enumerate(snapshots, 1):
        frame = spark.createDataFrame(list(s.items()), "k string, ticker string")
        state = spark.createDataFrame(scd2.transition(state, frame, "k", F.lit(day(n))).drop("_change").collect(), empty.schema)
    every = [(k, day(n), v) for n, s in enumerate(snapshots, 1) for k, v in s.items()]
    replayed = scd2.replay(spark.createDataFrame(every, "k string, at timestamp, ticker string"), "k", "at", ["ticker"])
    columns = ["k", "ticker", "row_hash", "valid_from", "valid_to", "is_current"]
    assert sorted(map(tuple, state.select(columns).collect()), key=repr) == sorted(map(tuple, replayed.select(columns).collect()), key=repr)


UPDATES = "k string, v string, source_ingested_at timestamp, source_run_id string"
STATE = schema(fields("k string"), fields(optional="v string"), schemas.LINEAGE_FIELDS)


def arrived(spark, *rows):
    return spark.createDataFrame([(k, v, day(n), f"load-{n:02d}") for k, v, n in rows], UPDATES)


def deliveries(spark, *rows):
    return arrived(spark, *[("gauge", v, n) for v, n in rows])


def fold(spark, *batches, strict=False):
    state, counts = spark.createDataFrame([], STATE), []
    for batch in batches:
        after = latest_wins.transition(state, deliveries(spark, *batch), ["k"], ["v"], strict).collect()
        counts.append([r["_change"] for r in after])
        state = spark.createDataFrame([tuple(r)[:-1] for r in after], STATE)
    return state.first(), counts


@pytest.mark.parametrize(
    ("batches", "value", "revisions", "seen", "updated", "last_change"),
    [
        ([[("7 bar", 3)]], "7 bar", 0, 3, 3, "inserted"),
        ([[("7 bar", 3)], [("7 bar", 9)]], "7 bar", 0, 3, 3, None),  # read again, the same
        ([[("7 bar", 3)], [("6 bar", 9)]], "6 bar", 1, 3, 9, "revised"),
        ([[("6 bar", 9)], [("7 bar", 3)]], "6 bar", 0, 9, 9, None),  # came late
        ([[("7 bar", 3), ("6 bar", 9), ("5 bar", 4)]], "6 bar", 0, 9, 9, "inserted"),  # one batch, the newest counts
        ([[("7 bar", 3)], [("6 bar", 9)], [("7 bar", 11)], [("7 bar", 12)]], "7 bar", 2, 3, 11, None),
    ],
)
def test_latest_wins(spark, batches, value, revisions, seen, updated, last_change):
    row, counts = fold(spark, *batches)
    assert (row["v"], row["revision_count"], row["first_seen_at"], row["updated_at"]) == (value, revisions, day(seen), day(updated))
    assert counts[-1] == [last_change]


def test_the_refetch_hole_and_its_strict_closing(spark):
    late = [[("x", 1)], [("x", 3)], [("y", 2)]]
    assert fold(spark, *late)[0]["v"] == "y"
    row, _ = fold(spark, *late, strict=True)
    assert (row["v"], row["revision_count"]) == ("x", 0)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.sampled_from(["x", "y", None]), min_size=1, max_size=5))
def test_latest_wins_fold_is_the_replay(spark, seen):
    row, _ = fold(spark, *[[(v, n)] for n, v in enumerate(seen, 1)])
    replayed = latest_wins.replay(deliveries(spark, *[(v, n) for n, v in enumerate(seen, 1)]), ["k"], ["v"]).first()
    assert {c: replayed[c] for c in STATE.fieldNames()} == row.asDict()


def test_merge_latest_commits_only_changes(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "bars"))
    table.ensure(STATE)
    assert latest_wins.merge_latest(table, deliveries(spark, ("a", 1), ("a", 1)), ["k"], ["v"]) == {"inserted": 1, "revised": 0}
    assert latest_wins.merge_latest(table, deliveries(spark, ("a", 2)), ["k"], ["v"]) == {"inserted": 0, "revised": 0}
    assert latest_wins.merge_latest(table, deliveries(spark, ("b", 3)), ["k"], ["v"]) == {"inserted": 0, "revised": 1}
    assert table.versions() == [0, 1, 2]
    assert table.read(1).first()["v"] == "a" and table.read().first()["v"] == "b"


def _folders(table):
    return {p: tuple(f) for p, f in table.entry()["parts"].items()}


def test_merges_rewrite_only_parts_that_change(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "ticks"))
    table.ensure(STATE, layout="substring(k, 1, 1)")
    assert latest_wins.merge_latest(table, arrived(spark, ("a1", "p", 1), ("a2", "q", 1), ("b1", "p", 1), ("c/1", "p", 1)), ["k"], ["v"]) == {"inserted": 4, "revised": 0}
    before = _folders(table)
    assert sorted(before) == ["a", "b", "c"]
    # a is met without a change, b changes, d is new, c isn't met
    assert latest_wins.merge_latest(table, arrived(spark, ("a1", "p", 2), ("b1", "z", 2), ("d1", "p", 2)), ["k"], ["v"]) == {"inserted": 1, "revised": 1}
    after = _folders(table)
    assert after["a"] == before["a"] and after["c"] == before["c"] and after["b"] != before["b"] and sorted(after) == ["a", "b", "c", "d"]
    assert rows(table.read().select("k", "v")) == [("a1", "p"), ("a2", "q"), ("b1", "z"), ("c/1", "p"), ("d1", "p")]
    assert rows(table.read(1).select("k", "v")) == [("a1", "p"), ("a2", "q"), ("b1", "p"), ("c/1", "p")]
    assert table.history().where("version = 2").first()["metrics"]["parts"] == 2
    read = table._rows(table.entry(), ["b"]).inputFiles()
    assert len(read) == 1 and f"{PART}=b" in read[0]


def test_expired_versions(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.ensure(STATE, layout="substring(k, 1, 1)")
    for n, v in enumerate(["p", "q", "r"], 1):
        latest_wins.merge_latest(table, arrived(spark, ("a", v, n), ("b", "p", n)), ["k"], ["v"])
    assert table.expire(keep=2) == 1  # a's first folder; b's is still used
    assert rows(table.read().select("k", "v")) == [("a", "r"), ("b", "p")] and rows(table.read(2).select("k", "v")) == [("a", "q"), ("b", "p")]
    with pytest.raises(VersionExpired):
        table.read(1)
    assert table.history().count() == 4 and table.expire(keep=2) == 0 and table.expire() == 1


def test_scd2_parts(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "dim"))
    scd2.ensure_table(table, ATTRIBUTES, "k", 8)
    scd2.merge_snapshot(table, snap(spark, **{f"k{i}": "x" for i in range(40)}), "k", day(1))
    before = _folders(table)
    assert len(before) > 4
    assert scd2.merge_snapshot(table, snap(spark, **{f"k{i}": "y" if i == 7 else "x" for i in range(40)}), "k", day(2)) == {"new": 0, "changed": 1, "unchanged": 39}
    after = _folders(table)
    assert sum(after[p] != before[p] for p in before) == 1 and table.read().count() == 41 and scd2.broken_keys(table.read(), "k").count() == 0


def test_a_merge_over_a_version_published_meanwhile_fails(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.ensure(STATE)
    latest_wins.merge_latest(table, arrived(spark, ("a", "p", 1)), ["k"], ["v"])
    batch = latest_wins.batch_of(arrived(spark, ("b", "p", 2)), ["k"], ["v"])

    def slow(state):
        latest_wins.merge_latest(table, arrived(spark, ("c", "p", 2)), ["k"], ["v"])
        return latest_wins.transition(state, arrived(spark, ("b", "p", 2)), ["k"], ["v"])

    with pytest.raises(ConcurrentCommit):
        table.merge(batch, slow, "MERGE LATEST", ("inserted",), ("inserted",))
    assert sorted(r["k"] for r in table.read().collect()) == ["a", "c"]  # nothing is lost


def test_files_follow_from_their_size(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.ensure(schema(fields("k string")))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        table.append(spark.range(200_000).repartition(40).selectExpr("sha1(string(id)) AS k"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.detail().first()["num_files"] > 4
    table.append(spark.range(100).repartition(40).selectExpr("string(id) AS k"))
    held = table.entry()["parts"]["all"]
    assert len([f for f in (tmp_path / "t" / held[-1]).iterdir() if f.suffix == ".parquet"]) == 1


def test_table_contract_history_and_catalog(spark, tmp_path, rows):
    table = VersionedTable(spark, str(tmp_path / "lake/bronze/b"))
    declared = schema(fields("k string, page int"), fields(optional="day date"))
    assert table.ensure(declared, {"page_not_negative": "page >= 0"}) and not table.ensure(declared)
    with pytest.raises(SchemaMismatch, match="day is date, not string"):
        table.ensure(schema(fields("k string, page int"), fields(optional="day string")))
    good = spark.createDataFrame([("a", 0, date(2026, 1, 1)), ("b", 1, None)], "k string, page int, day date")
    assert table.append(good.repartition(4)) == 2 and table.append(good) == 2 and table.append(good.limit(0)) == 0
    assert table.read().count() == 4 and table.read(1).count() == 2 and table.read(0).count() == 0
    with pytest.raises(ConstraintViolation, match="page_not_negative"):
        table.append(spark.createDataFrame([("a", -1, None)], "k string, page int, day date"))
    with pytest.raises(ConstraintViolation, match="NOT NULL"):
        table.append(spark.createDataFrame([(None, 1, None)], "k string, page int, day date"))
    with pytest.raises(SchemaMismatch, match="unexpected"):
        table.append(good.withColumn("more", F.lit(1)))
    assert rows(table.history().select("version", "operation")) == [(0, "CREATE"), (1, "APPEND"), (2, "APPEND")]
    detail = table.detail().first()
    assert detail["num_files"] == 2 and detail["version"] == 2  # one file per append
    assert rows(table.properties()) == [("constraints.page_not_negative", "page >= 0")]
    assert [r["name"] for r in find_tables(spark, str(tmp_path / "lake")).collect()] == ["bronze/b"]
    assert find_tables(spark, str(tmp_path / "nowhere")).count() == 0
    with pytest.raises(ValueError, match="no version 9"):
        table.read(9)
    entry = table.entry()
    with pytest.raises(ConcurrentCommit):
        table.log.publish(2, entry)
    assert table.versions() == [0, 1, 2]
