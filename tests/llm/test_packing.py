import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

pytest.importorskip("tidemark.llm")
from tidemark.llm.packing import Containers, Cost, check_packing, pack, pack_items  # noqa: E402


def brute(lengths, capacity, cost):
    """The rule by trying every container: the cheapest with room, of equal ones that with the least room."""
    held = [[0.0, 0] for _ in range(-(-sum(lengths) // capacity))]
    out = []
    for length in sorted(lengths, reverse=True):
        fits = [c for c in held if capacity - c[1] >= length]
        if not fits:
            held.append([0.0, 0])
            fits = [held[-1]]
        best = min(fits, key=lambda c: (c[0], capacity - c[1]))
        best[0] += cost.of(length)
        best[1] += length
        out.append((length, round(best[0], 9)))
    return len(held), out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_items_go_to_the_cheapest_container_with_room(lengths):
    cost = Cost(1.0, 0.01)
    number, offset = pack(np.array(lengths, np.int64), 50, cost)
    used = {}
    for i in np.argsort(-np.array(lengths, np.int64), kind="stable"):
        assert offset[i] == used.get(number[i], 0)
        used[number[i]] = offset[i] + lengths[i]
    assert all(u <= 50 for u in used.values())
    spent = {}
    got = []
    for i in np.argsort(-np.array(lengths, np.int64), kind="stable"):
        spent[number[i]] = spent.get(number[i], 0.0) + cost.of(lengths[i])
        got.append((lengths[i], round(spent[number[i]], 9)))
    assert got == brute(lengths, 50, cost)[1]


def test_little_room_is_wasted_and_costs_are_even():
    lengths = np.clip(np.random.default_rng(0).lognormal(4.5, 1, 20_000).astype(int), 1, 2048)
    number, _ = pack(lengths, 2048, Cost())
    used = np.bincount(number, lengths)
    assert lengths.sum() / (2048 * len(used)) > 0.995 and used.max() <= 2048


def test_containers_open_when_nothing_fits():
    held = Containers(10)
    assert [held.place(6, 6.0)[0], held.place(6, 6.0)[0], held.place(4, 4.0)[0]] == [0, 1, 0]


def test_corpus_of_items(spark):
    sizes = {1: 10, 2: 0, 3: None, 4: 5000, 5: 2048, 6: 2049, 7: -3, 8: 1}
    frame = spark.createDataFrame([(i, n, "clash", 3) for i, n in sizes.items()], "doc_id long, n_tokens long, container string, part int")
    rows = pack_items(frame).collect()
    parts = sorted((r["doc_id"], r["part"], r["n_tokens"]) for r in rows)
    assert parts == [(1, 0, 10), (4, 0, 2048), (4, 1, 2048), (4, 2, 904), (5, 0, 2048), (6, 0, 2048), (6, 1, 1), (8, 0, 1)]
    used = {}
    for r in rows:
        used.setdefault(r["container"], []).append((r["position"], r["n_tokens"]))
    for spans in used.values():
        at = 0
        for position, n in sorted(spans):
            assert position == at
            at += n
        assert at <= 2048
    assert pack_items(frame.limit(0)).count() == 0


def test_many_groups_and_repeated_rows(spark):
    frame = spark.range(4000).selectExpr("id % 3 AS doc_id", "id % 90 + 1 AS n_tokens")
    rows = pack_items(frame, capacity=256, group_items=500).collect()
    assert len(rows) == 4000 and sum(r["n_tokens"] for r in rows) == sum(i % 90 + 1 for i in range(4000))
    fill = {}
    for r in rows:
        fill[r["container"]] = fill.get(r["container"], 0) + r["n_tokens"]
    assert max(fill.values()) <= 256 and len({c.split(":")[0] for c in fill}) > 4
    assert sum(fill.values()) / (256 * len(fill)) > 0.95


def test_the_same_items_give_the_same_containers(spark):
    """Whatever the partitioning and the order, with repeated rows and items of the same size."""
    frame = spark.range(9000).selectExpr("id % 4000 AS doc_id", "hash(id % 4000) % 300 + 301 AS n_tokens")
    pack_ = lambda f: sorted(map(tuple, pack_items(f, capacity=512, group_items=700).collect()))
    first = pack_(frame.repartition(3))
    assert len(first) > 9000 and first == pack_(frame.repartition(11, "n_tokens")) == pack_(frame.orderBy("n_tokens").coalesce(1))


def test_what_a_packing_must_keep(spark):
    columns = "doc_id long, part int, n_tokens int, container string, position int"
    check = lambda rows: check_packing(spark.createDataFrame(rows, columns), capacity=10).first().asDict()
    good = [(1, 0, 10, "0:0", 0), (1, 1, 5, "0:1", 0), (2, 0, 5, "0:1", 5)]
    fine = {"n_items": 2, "wrongly_split": 0, "overfull": 0, "overlapping": 0, "gaps": 0, "well_filled": True}
    assert check(good) == fine
    assert check([*good[:2], (2, 0, 5, "0:1", 4)])["overlapping"] == 1
    assert check([*good[:2], (2, 0, 4, "0:1", 6)])["gaps"] == 1
    assert check([*good, (3, 0, 1, "0:1", 10)])["overfull"] == 1
    assert check([(1, 0, 4, "0:0", 0), (1, 1, 4, "0:0", 4)])["wrongly_split"] == 1
    assert check([(1, 0, 7, "0:0", 0), (1, 1, 7, "0:1", 0)])["wrongly_split"] == 1
    assert not check([(i, 0, 1, f"0:{i}", 0) for i in range(20)])["well_filled"]
    assert check([]) == fine | {"n_items": 0}
    frame = spark.range(3000).selectExpr("id AS doc_id", "id % 700 AS n_tokens")
    assert check_packing(pack_items(frame, capacity=256, group_items=500), capacity=256).first().asDict() == fine | {"n_items": 2995}
