import pytest
from pyspark.sql import functions as F

from tidemark.operators import compaction


def _write(spark, path, n, files):
    frame = spark.range(n).selectExpr("id", "id % 7 AS file_id", "if(id % 3 = 0, null, concat('t', id)) AS `a.b`", "cast(null AS string) AS nothing")
    frame.repartition(files).write.parquet(path)


def test_same_rows_in_fewer_files(spark, tmp_path):
    source = str(tmp_path / "source")
    _write(spark, source, 5000, 40)
    out, figures, _ = compaction.compact(spark, source, destination=str(tmp_path / "out"))
    assert figures["files_in"] >= 40 and figures["files_out"] == 1 and figures["rows"] == 5000
    a, b = spark.read.parquet(source), spark.read.parquet(out)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_repeated_rows_stay_and_empty_datasets_work(spark, tmp_path):
    twice = str(tmp_path / "twice")
    spark.sql("SELECT 1 AS x UNION ALL SELECT 1 AS x").write.parquet(twice)
    assert compaction.compact(spark, twice)[1]["rows"] == 2
    none = str(tmp_path / "none")
    spark.sql("SELECT 1 AS x WHERE false").write.parquet(none)
    out, figures, _ = compaction.compact(spark, none)
    assert figures["rows"] == 0 and spark.read.parquet(out).columns == ["x"]


@pytest.mark.parametrize("counted_by", [(), ("file_id",)])
def test_a_lost_or_altered_row_is_noticed(spark, tmp_path, monkeypatch, counted_by):
    source = str(tmp_path / "source")
    _write(spark, source, 100, 3)
    true, calls = compaction._sums, []

    def sums(rows):
        calls.append(rows)
        if len(calls) == 1:
            return true(rows)
        # over what was written, as if one row held something else
        hashed = F.xxhash64(F.expr("if(id = 5, 6, id)"))
        return [true(rows)[0], F.sum(hashed.cast("decimal(38,0)")).alias("high"), F.sum(F.lit(1).cast("decimal(38,0)")).alias("low")]

    monkeypatch.setattr(compaction, "_sums", sums)
    with pytest.raises(compaction.VerificationError):
        compaction.compact(spark, source, destination=str(tmp_path / "bad"), counted_by=counted_by)
    assert not (tmp_path / "bad").exists()


def test_thousands_of_files(spark, tmp_path):
    """As many files as ids; counts come from what was written."""
    source = str(tmp_path / "source")
    spark.range(9000).selectExpr("id", "id % 2000 AS file", "id % 2000 AS file_id", "concat('x', id) AS t").repartition(4, "file").write.partitionBy("file").parquet(source)
    out, figures, counts = compaction.compact(spark, source, destination=str(tmp_path / "out"), counted_by=["file_id"])
    assert figures["files_in"] > 2000 and figures["files_out"] == 1 and figures["splits"] < 100
    assert counts.count() == 2000 and counts.where("n_rows = if(file_id < 1000, 5, 4)").count() == 2000
    assert spark.read.parquet(out).exceptAll(spark.read.parquet(source)).count() == 0


def test_fingerprint(spark):
    one = spark.sql("SELECT 1 AS a, cast(null AS int) AS b")
    other = spark.sql("SELECT cast(null AS int) AS a, 1 AS b")
    assert compaction.fingerprint(one) != compaction.fingerprint(other)
    assert compaction.fingerprint(one.union(other)) == compaction.fingerprint(other.union(one))


def test_packing_rule():
    tiny = compaction.packing(1_000_000, 4_000_000_000, cores=100)
    assert tiny.open_cost == 64 * 1024 and tiny.files_out == 30
    assert tiny.max_partition_bytes <= compaction.TARGET_BYTES
    assert compaction.packing(0, 0, 8).files_out == 1


def test_which_files_are_small(spark):
    files = spark.createDataFrame(
        [(1, " Committed ", 10, 1), (2, "removed", 10, 1), (3, "committed", 60_000, 1), (4, "COMMITTED", None, 1), (5, None, 10, 1), (6, "committed", 10, 1), (1, "committed", 10, 1), (None, "committed", 1, 1)],
        "file_id long, status string, size_bytes long, n_rows long",
    )
    counts = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, 1), (5, 1), (None, 1)], "file_id long, n_rows long")
    listed = compaction.file_list(files, counts)
    assert sorted(r["file_id"] for r in compaction.small_files(listed).collect()) == [1]
    assert {r["file_id"]: r["n_rows"] for r in listed.collect()} == {1: 2, 3: 1, 4: 1}


def test_callers_settings_stay(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    _write(spark, str(tmp_path / "s"), 10, 2)
    compaction.compact(spark, str(tmp_path / "s"))
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
