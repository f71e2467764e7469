from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.operators import copydiff

ROWS = "k string, d date, side string, v double, s string, _next string, field string"
TESTS = {"v": lambda a, b: copydiff.beyond(a["v"], b["v"], 0.1), "s": lambda a, b: a["s"] != b["s"]}
D = date(2026, 1, 5)


def run(spark, data):
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in data], ROWS)
    out = copydiff.compare_copies(frame, ["k", "d"], "side", ("L", "R"), ["v", "s"], TESTS)
    return sorted(((r["k"], r["d"], r["field"]) for r in out.collect()), key=repr)


def test_missing_and_unequal(spark):
    data = [
        ("A", D, "L", 1.0, "x"), ("A", D, "R", 1.05, "x"),
        ("B", D, "L", 1.0, "x"), ("B", D, "R", 2.0, "y"),
        ("C", D, "L", 1.0, "x"), ("E", D, "R", 1.0, "x"),
        ("F", None, "L", 1.0, "x"), ("F", None, "R", None, "z"), (None, D, "R", 1.0, "x"), ("G", D, "other", 1.0, "x"),
    ]
    assert run(spark, data) == sorted(
        [("B", D, "v"), ("B", D, "s"), ("C", D, "missing_R"), ("E", D, "missing_L"), ("F", None, "s"), (None, D, "missing_L")], key=repr
    )


def test_empty_copies(spark):
    assert run(spark, []) == []
    assert run(spark, [("A", D, "L", 1.0, "x")]) == [("A", D, "missing_R")]


def test_many_keys_over_many_partitions(spark):
    data = [(f"k{i:04}", D, side, float(i), "x") for i in range(2000) for side in "LR" if (i % 7 or side == "L")]
    assert run(spark, data) == [(f"k{i:04}", D, "missing_R") for i in range(0, 2000, 7)]


def test_one_exchange_serves_both_copies(spark):
    frame = spark.createDataFrame([("A", D, "L", 1.0, "x", "c", "c")], ROWS)
    plan = copydiff.compare_copies(frame, ["k", "d"], "side", ("L", "R"), ["v", "s"], TESTS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_newest_breaks_ties(spark):
    at = datetime(2026, 1, 1)
    frame = spark.createDataFrame([("A", at, 1, "old"), ("A", at, 2, "new"), ("A", None, 3, "null")], "k string, at timestamp, id long, v string")
    assert [r["v"] for r in copydiff.newest(frame, ["k"], ["at", "id"], ["v"]).collect()] == ["new"]


def test_splits(spark):
    actions = spark.createDataFrame(
        [("A", date(2026, 2, 1), "split", 2.0), ("A", date(2026, 2, 1), "split", 2.0), ("A", date(2026, 3, 1), "split", 5.0), ("A", date(2026, 4, 1), "dividend", 9.0), ("A", None, "split", 7.0), ("A", date(2026, 5, 1), "split", None)],
        "security_id string, ex_date date, action_type string, value double",
    ).withColumn("source_ingested_at", F.lit(datetime(2026, 1, 1)))
    factors = copydiff.split_factors(actions)
    days = spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 2, 1),), (date(2026, 3, 1),), (None,)], "d date")
    got = days.crossJoin(factors).select(copydiff.later_product(F.col("splits"), F.col("d"))).collect()
    assert [r[0] for r in got] == [10.0, 5.0, 1.0, 1.0]
