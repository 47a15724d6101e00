"""CSV scans, snapshot tables and the time axis."""

from datetime import date

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from monthmill.sources import snapshots as s
from monthmill.sources.ledger import Ledger, Snapshot


def test_csv_keeps_text_and_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,age\n1,"""""""Johne""",41_\n2,"Smith, A",7\n')
    got = s.read_csv(spark, str(tmp_path / "a.csv"))
    assert got.dtypes == [("id", "string"), ("name", "string"), ("age", "string")]
    assert [tuple(r) for r in got.collect()] == [("1", '"""Johne"', "41_"), ("2", "Smith, A", "7")]


def test_csv_header_is_checked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\n")
    (tmp_path / "empty.csv").write_text("id,name\n")
    assert s.read_csv(spark, str(tmp_path / "empty.csv")).count() == 0
    assert s.read_csv(spark, str(tmp_path / "a.csv"), ["id", "name"]).first()["name"] == "x"
    with pytest.raises(Py4JJavaError, match="CSV header does not conform"):
        s.read_csv(spark, str(tmp_path / "a.csv"), ["name", "id"]).collect()


@pytest.mark.parametrize(
    "start, end, months",
    [("2023-11-15", "2024-02-01", ["2023-11-01", "2023-12-01", "2024-01-01", "2024-02-01"]), ("2023-01-01", "2023-01-31", ["2023-01-01"]), ("2023-02-01", "2023-01-01", [])],
)
def test_month_spine(spark, start, end, months):
    assert s.snapshot_dates(start, end) == months
    if months:
        assert [str(r[0]) for r in s.month_spine(spark, start, end).collect()] == months


def frame(spark, rows):
    return spark.createDataFrame([(v, date.fromisoformat(d)) for v, d in rows], "v int, snapshot_date date")


def stored(spark, root):
    return sorted((r["v"], str(r["snapshot_date"])) for r in s.read_snapshots(spark, root).collect())


@pytest.mark.parametrize("rebalance", [True, False])
def test_write_replaces_only_the_given_snapshots(spark, tmp_path, rebalance):
    root = str(tmp_path / "t")
    assert s.write_snapshots(frame(spark, [(1, "2023-01-01"), (2, "2023-02-01")]), root, rebalance=rebalance) == 2
    s.write_snapshots(frame(spark, [(3, "2023-02-01")]), root, rebalance=rebalance)
    assert stored(spark, root) == [(1, "2023-01-01"), (3, "2023-02-01")]
    # A snapshot without rows now leaves nothing of its former rows.
    wanted = ["2023-01-01", "2023-02-01"]
    s.write_snapshots(frame(spark, [(4, "2023-01-01")]), root, wanted, rebalance=rebalance)
    assert stored(spark, root) == [(4, "2023-01-01")]
    assert s.read_snapshots(spark, root, wanted).count() == 1
    assert s.read_snapshots(spark, root, ["2023-02-01"]).count() == 0
    assert s.snapshots_in(spark, root) == wanted and s.snapshots_in(spark, str(tmp_path / "none")) == []
    with pytest.raises(s.MissingSnapshot):
        s.read_snapshots(spark, str(tmp_path / "none"))


def test_csv_table(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([('"""Johne', date(2023, 1, 1)), ("a, b", date(2023, 2, 1))], "name string, snapshot_date date")
    s.write_snapshots(df, root, format="csv")
    assert sorted(r["name"] for r in s.read_csv(spark, root).collect()) == ['"""Johne', "a, b"]
    one = s.read_snapshots(spark, root, ["2023-02-01"], format="csv", columns=["name", "snapshot_date"])
    assert [tuple(r) for r in one.collect()] == [("a, b", date(2023, 2, 1))]


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    root = str(tmp_path / "t")
    s.write_snapshots(frame(spark, [(i, f"2023-0{i}-01") for i in range(1, 7)]), root)
    picked = s.at_snapshots(s.read_snapshots(spark, root), ["2023-02-01"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and picked.count() == 1


def test_ingest_filters_and_types_the_date(spark):
    raw = spark.createDataFrame([("a", "2023-01-01"), ("b", "2023-02-01"), ("c", "junk"), ("d", None)], "v string, snapshot_date string")
    assert [r["v"] for r in s.ingest(raw, ["2023-02-01"]).collect()] == ["b"]
    everything = s.ingest(raw)
    assert dict(everything.dtypes)["snapshot_date"] == "date" and everything.count() == 2


def test_columns_that_drift_are_kept(spark, tmp_path):
    root = str(tmp_path / "t")
    s.write_snapshots(frame(spark, [(1, "2023-01-01")]).withColumn("a", F.lit(1)), root)
    s.write_snapshots(frame(spark, [(2, "2023-02-01")]).withColumn("b", F.lit(2)), root)
    got = s.read_snapshots(spark, root)
    assert sorted((r["v"], r["a"], r["b"]) for r in got.collect()) == [(1, 1, None), (2, None, 2)]


def test_staging_leaves_nothing_behind(spark, tmp_path):
    from monthmill.session import stage, staging

    with pytest.raises(ZeroDivisionError), staging(spark, str(tmp_path)) as root:
        assert stage(spark.range(3), root, "x").count() == 3
        assert list(tmp_path.iterdir())
        1 / 0
    assert not list(tmp_path.iterdir())


def test_jobs_at_once_keep_the_job_group(spark):
    from monthmill.session import at_once

    spark.sparkContext.setJobGroup("mine", "jobs")
    at_once(lambda: spark.range(5).count(), lambda: spark.range(6).collect())
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("mine")) >= 2
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# The ledger


def test_failed_write_leaves_the_table_as_it_was(spark, tmp_path):
    root = str(tmp_path / "t")
    s.write_snapshots(frame(spark, [(1, "2023-01-01"), (2, "2023-02-01")]), root)
    before = sorted(p.name for p in (tmp_path / "t").iterdir())
    broken = frame(spark, [(3, "2023-01-01"), (4, "2023-02-01")]).withColumn("v", F.when(F.col("v") == 4, F.raise_error(F.lit("no")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="no"):
        s.write_snapshots(broken, root)
    assert stored(spark, root) == [(1, "2023-01-01"), (2, "2023-02-01")]
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == before


def test_first_write_that_fails_leaves_no_table(spark, tmp_path):
    root = str(tmp_path / "t")
    broken = frame(spark, [(3, "2023-01-01")]).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        s.write_snapshots(broken, root)
    with pytest.raises(s.MissingSnapshot):
        s.read_snapshots(spark, root)


def test_reader_keeps_what_it_began_with_until_vacuum(spark, tmp_path):
    root = str(tmp_path / "t")
    s.write_snapshots(frame(spark, [(1, "2023-01-01"), (2, "2023-02-01")]), root)
    begun = s.read_snapshots(spark, root)
    s.write_snapshots(frame(spark, [(3, "2023-02-01")]), root)
    assert sorted(r["v"] for r in begun.collect()) == [1, 2]
    s.write_snapshots(frame(spark, [(4, "2023-02-01")]), root)
    # Only the second version is not named any more.
    assert len(Ledger(spark, root).vacuum()) == 1 and Ledger(spark, root).vacuum() == []
    assert stored(spark, root) == [(1, "2023-01-01"), (4, "2023-02-01")]
    assert Ledger(spark, str(tmp_path / "none")).vacuum() == []


def test_two_writers_lose_nothing(spark, tmp_path):
    from monthmill.session import at_once

    root = str(tmp_path / "t")
    at_once(*[lambda i=i: s.write_snapshots(frame(spark, [(i, f"2023-0{i}-01")]), root) for i in range(1, 7)])
    assert stored(spark, root) == [(i, f"2023-0{i}-01") for i in range(1, 7)]


def test_entry_appears_once(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "t"))
    schema = frame(spark, []).drop("snapshot_date").schema.json()
    assert ledger.current() is None
    assert ledger._put(0, {"2023-01-01": Snapshot("a", schema, 1, 1)})
    assert not ledger._put(0, {"2023-01-01": Snapshot("b", schema, 1, 1)})
    assert ledger.current()["2023-01-01"].version == "a"
    assert [p.name for p in (tmp_path / "t" / "_ledger").iterdir() if p.suffix != ".crc"] == ["00000000.json"]


def test_counts_are_those_of_the_write(spark, tmp_path):
    rows = [(1, None, "2023-01-01"), (None, None, "2023-01-01"), (2, "x", "2023-02-01"), (3, "y", None)]
    df = spark.createDataFrame([(v, w, d and date.fromisoformat(d)) for v, w, d in rows], "v int, `w w` string, snapshot_date date")
    written = s.publish_snapshots(df, str(tmp_path / "t"), ["2023-02-01", "2023-03-01"], count_nulls=True)
    assert written.rows == {"2023-01-01": 2, "2023-02-01": 1, "2023-03-01": 0} and written.total == 3
    assert written.nulls == {"2023-01-01": {"v": 1, "w w": 2}, "2023-02-01": {}, "2023-03-01": {}}
    assert s.read_snapshots(spark, str(tmp_path / "t")).columns == ["v", "w w", "snapshot_date"]
    nothing = s.publish_snapshots(df.where("false"), str(tmp_path / "u"), ["2023-03-01"], count_nulls=True)
    assert nothing.rows == {"2023-03-01": 0} and s.read_snapshots(spark, str(tmp_path / "u")).count() == 0


def test_no_job_before_the_scan(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(1, 5):
        s.write_snapshots(frame(spark, [(i, f"2023-0{i}-01")]).withColumn(f"c{i}", F.lit(i)), root)
    spark.sparkContext.setJobGroup("reading", "")
    got = s.read_snapshots(spark, root)
    assert got.columns == ["v", "c1", "c2", "c3", "c4", "snapshot_date"]
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("reading")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((r["v"], r["c1"], r["c4"]) for r in got.collect()) == [(1, 1, None), (2, None, None), (3, None, None), (4, None, 4)]


def test_changed_type_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    s.write_snapshots(frame(spark, [(1, "2023-01-01")]), root)
    s.write_snapshots(frame(spark, [(1, "2023-02-01")]).withColumn("v", F.lit("x")), root)
    with pytest.raises(TypeError, match="v is int in some snapshots and string in others"):
        s.read_snapshots(spark, root)
    assert s.read_snapshots(spark, root, ["2023-02-01"]).first()["v"] == "x"


# Rejected lines

TORN = 'a,b,snapshot_date\n1,2,2023-01-01\n4,5\n6,7,2023-01-01,9\n"x\ny",1,2023-02-01\n"q""r",",",2023-02-01\n5"" pipe,1,2023-02-01\n8,9,soon\n1,,\n'


def test_torn_lines_are_kept_apart(spark, tmp_path):
    (tmp_path / "in put").mkdir()
    (tmp_path / "in put" / "a.csv").write_text(TORN)
    (tmp_path / "in put" / "b.csv").write_text("a,b,snapshot_date\n1,2,2023-01-01\n4\n")
    columns, path = ["a", "b", "snapshot_date"], str(tmp_path / "in put")
    raw = s.read_csv(spark, path, columns, keep_rejects=True, multi_line=None)
    good = sorted(tuple(r)[:2] for r in s.ingest(raw).collect())
    assert good == sorted([("1", "2"), ("1", "2"), ("x\ny", "1"), ('q"r', ","), ('5"" pipe', "1")])
    lost = s.rejects(raw).collect()
    assert sorted((r["reason"], r["record"]) for r in lost) == sorted(
        [("cells", "4,5"), ("cells", "6,7,2023-01-01,9"), ("cells", "4"), ("date", "8,9,soon"), ("date", "1,,")]
    )
    assert {r["record"] for r in lost if r["file"].endswith("b.csv")} == {"4"}
    # Good and rejected rows are all records of the files: 8 and 2 under their headers.
    assert len(good) + len(lost) == 10


def test_only_files_with_open_cells_are_read_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a\n"x\ny"\n')
    (tmp_path / "b.csv").write_text('a\n"x ""y"", z"\n1"\n')
    found = s._files_with_open_cells(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in found] == ["a.csv"]
    got = s.read_csv(spark, str(tmp_path), ["a"], keep_rejects=True, multi_line=None)
    assert sorted(r["a"] for r in got.collect()) == ['1"', "x\ny", 'x "y", z']


def test_bronze_keeps_its_rejects_until_there_are_none(spark, tmp_path):
    from monthmill.plans import stores

    columns, out = ["a", "b", "snapshot_date"], str(tmp_path / "bronze")
    (tmp_path / "a.csv").write_text(TORN)
    raw = s.read_csv(spark, str(tmp_path / "a.csv"), columns, keep_rejects=True, multi_line=None)
    built = stores.build_bronze(spark, raw, out, ["2023-01-01", "2023-02-01"])
    assert (built.rows, built.rejected, built.months) == (4, 4, {"2023-01-01": 1, "2023-02-01": 3})
    assert spark.read.parquet(f"{out}_rejects").count() == 4
    (tmp_path / "c.csv").write_text("a,b,snapshot_date\n1,2,2023-01-01\n")
    clean = s.read_csv(spark, str(tmp_path / "c.csv"), columns, keep_rejects=True, multi_line=None)
    assert stores.build_bronze(spark, clean, out, ["2023-01-01"]).rejected == 0
    assert not (tmp_path / "bronze_rejects").exists() and s.read_snapshots(spark, out).count() == 4


def test_a_lookup_opens_few_row_groups(spark, tmp_path):
    def read(root):
        got = s.read_snapshots(spark, root).where("c = 'c4321'")
        assert got.count() == 20 and {r["c"] for r in got.collect()} == {"c4321"}
        scan = got._jdf.queryExecution().executedPlan().collectLeaves().head()
        got.collect()
        return scan.metrics().apply("numOutputRows").value()

    rows = spark.range(200_000).selectExpr("concat('c', id % 10000) as c", "id as v", "uuid() as u", "date'2023-01-01' as snapshot_date")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(256 * 1024))
    try:
        s.publish_snapshots(rows, str(tmp_path / "plain"))
        s.publish_snapshots(rows, str(tmp_path / "sorted"), lookup="c")
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    assert read(str(tmp_path / "plain")) > 150_000
    assert read(str(tmp_path / "sorted")) < 40_000


def test_gathered_rows_lie_by_snapshot(spark, tmp_path, monkeypatch):
    rows = [(i, f"2023-0{1 + i % 4}-01") for i in range(400)] + [(None, "2023-04-01")] * 3
    df = frame(spark, rows).repartition(5).selectExpr("v", "cast(v % 7 as string) as `a b`", "if(v = 1, '', null) as t", "snapshot_date")
    monkeypatch.setattr(s, "GATHERED", 1)
    apart = s.gathered(df, str(tmp_path / "apart"))
    monkeypatch.setattr(s, "GATHERED", 1 << 30)
    together = s.gathered(df, str(tmp_path / "together"))
    assert together.rdd.getNumPartitions() <= 2 and apart.rdd.getNumPartitions() >= 4
    for got in (apart, together):
        assert got.dtypes == df.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, df.collect()))
    # No task has rows of two snapshots.
    assert all(len(set(p)) <= 1 for p in apart.select("snapshot_date").rdd.map(lambda r: r[0]).glom().collect())
    assert s.gathered(df.where("v < 0"), str(tmp_path / "none")).count() == 0


def test_read_by_snapshot_gathers_the_small_files_of_a_snapshot(spark, tmp_path, monkeypatch):
    rows, root = [(i, f"2023-0{1 + i % 3}-01") for i in range(300)], str(tmp_path)
    s.write_snapshots(frame(spark, rows).repartition(10), root, rebalance=False)
    s.write_snapshots(frame(spark, [(7, "2023-02-01"), (None, "2023-02-01")]), root, ["2023-02-01", "2023-04-01"])
    monkeypatch.setattr(s, "GATHERED", 1 << 30)
    for dates in (None, ["2023-01-01", "2023-02-01"], ["2023-04-01"]):
        got, want = s.read_by_snapshot(spark, root, dates), s.read_snapshots(spark, root, dates)
        assert got.dtypes == want.dtypes and (got.isEmpty() or got.rdd.getNumPartitions() <= 2)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    monkeypatch.setattr(s, "GATHERED", 1)
    apart = s.read_by_snapshot(spark, root).select("snapshot_date").rdd.map(lambda r: r[0]).glom().collect()
    assert all(len(set(p)) <= 1 for p in apart)
    with pytest.raises(s.MissingSnapshot):
        s.read_by_snapshot(spark, root, ["2024-01-01"])
