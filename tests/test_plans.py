"""The tables of both stores on hand-written rows, and whole runs from CSV."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from monthmill.checks import views
from monthmill.plans import stores
from monthmill.plans.attributes import silver_attributes
from monthmill.plans.clickstream import silver_clickstream
from monthmill.plans.features import gold_features, join_features, silver_aggregated
from monthmill.plans.financials import FINANCIAL_RENAMES, clean_financials, silver_financials
from monthmill.plans.loans import bad_rate_by_mob, gold_labels, silver_loans
from monthmill.schemas import FIXED_CAPS, LOAN_KINDS, QUANTILE_CLIPPED
from monthmill.functions.text import snake_case
from monthmill.session import stage
from monthmill.sources.snapshots import gathered, read_csv, read_snapshots, snapshot_versions, write_snapshots

D = date(2023, 3, 31)
SF = "/root/testdata/sf0.001"


def loan_rows(spark, rows, **fixed):
    """Text rows as in a raw file; unnamed columns get a plain value."""
    base = {
        "loan_id": "L", "Customer_ID": "C", "loan_start_date": "2022-12-31", "tenure": "10", "installment_num": "6",
        "loan_amt": "100", "due_amt": "10", "paid_amt": "0", "overdue_amt": "0", "balance": "50",
        "snapshot_date": "2023-03-31",
    }
    full = [{**base, **fixed, **r} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in base) for r in full], ", ".join(f"{c} string" for c in base))


def test_days_past_due(spark, ansi):
    cases = [
        # overdue, due -> missed, first missed, dpd, label at 30 days
        ("5", "0", 0, None, None, 0),
        ("0", "0", 0, None, 0, 0),
        (None, "10", 0, None, 0, 0),
        ("-15", "10", -1, None, 0, 0),
        ("10", "10", 1, date(2023, 2, 28), 31, 1),
        ("2130.3", "710.1", 4, date(2022, 11, 30), 121, 1),
        ("junk", "10", 0, None, 0, 0),
        # More months missed than a date, or an int, can hold: the worst loan, not the best.
        ("100000", "0.00001", 2**31 - 1, None, 2**31 - 1, 1),
    ]
    raw = loan_rows(spark, [{"loan_id": str(i), "overdue_amt": c[0], "due_amt": c[1]} for i, c in enumerate(cases)])
    silver = silver_loans(raw)
    got = {r["loan_id"]: r for r in silver.collect()}
    labels = {r["loan_id"]: r for r in gold_labels(silver).collect()}
    for i, (_, _, missed, first, dpd, label) in enumerate(cases):
        r = got[str(i)]
        assert (r["installments_missed"], r["first_missed_date"], r["dpd"]) == (missed, first, dpd), cases[i]
        assert labels[str(i)]["label"] == label and labels[str(i)]["label_def"] == "30dpd_6mob"
    assert dict(silver.dtypes)["dpd"] == "int" and dict(silver.dtypes)["loan_amt"] == "float"


def test_numeric_nulls_of_loans_become_zero(spark, ansi):
    raw = loan_rows(spark, [{"installment_num": None, "tenure": "", "balance": None}])
    r = silver_loans(raw).first()
    assert (r["installment_num"], r["mob"], r["tenure"], r["balance"]) == (0, 0, 0, 0.0)


def test_labels_keep_the_spelling_they_are_given(spark):
    silver = silver_loans(loan_rows(spark, [{}]), renames={})
    assert gold_labels(silver).columns == ["loan_id", "Customer_ID", "label", "label_def", "snapshot_date"]


def test_bad_rate(spark):
    raw = loan_rows(spark, [{"overdue_amt": "20"}, {}, {"installment_num": "7"}, {"loan_start_date": "2024-01-01"}])
    got = [tuple(r) for r in bad_rate_by_mob(silver_loans(raw)).collect()]
    assert got == [(6, 0.5), (7, 0.0)]
    assert bad_rate_by_mob(silver_loans(raw), installment=7).count() == 1


def click_rows(spark, keys):
    return spark.createDataFrame([(str(i), c, d) for i, (c, d) in enumerate(keys)], "fe_1 string, Customer_ID string, snapshot_date string")


def test_clickstream_keeps_loan_start_months(spark, ansi):
    start = {"loan_start_date": "2023-03-01", "snapshot_date": "2023-03-01"}
    loans = silver_loans(loan_rows(spark, [
        {"loan_id": "1", "Customer_ID": "a", **start},
        {"loan_id": "2", "Customer_ID": "a", **start},
        {"loan_id": "3", "Customer_ID": "b", **start, "snapshot_date": "2023-04-01"},
        {"loan_id": "4", "Customer_ID": None, **start},
    ]))
    clicks = click_rows(spark, [("a", "2023-03-01"), ("a", "2023-04-01"), ("b", "2023-03-01"), ("b", "2023-04-01"), (None, "2023-03-01")])
    got = silver_clickstream(clicks, loans)
    assert sorted(tuple(r) for r in got.collect()) == [(0, "a", date(2023, 3, 1), "1"), (0, "a", date(2023, 3, 1), "2")]
    without = silver_clickstream(clicks, None)
    assert without.count() == 5 and without.where("loan_id is not null").count() == 0


def test_attributes(spark, ansi):
    rows = [
        ("a", '"""Johne', "41_", "230-22-9583", "Media_Manager"),
        ("b", "Smith, A", "-500", "#F%$D@*&8", "_______"),
        ("c", "N", "abc", " ", "!!!"),
        ("d", "N", "", None, "Lawyer"),
        ("d", "N", "", None, "Doctor"),
    ]
    raw = spark.createDataFrame([(*r, date(2023, 1, 1)) for r in rows], "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date date")
    got = {r["customer_id"]: r.asDict() for r in silver_attributes(raw, ["Doctor", "Lawyer", "MediaManager", "Writer"]).collect()}
    assert [(got[k]["age"], got[k]["ssn"]) for k in "abcd"] == [(41, "230-22-9583"), (-500, None), (None, None), (None, None)]
    on = {k: sorted(c for c, v in r.items() if c.startswith("occupation_") and v) for k, r in got.items()}
    assert on == {"a": ["occupation_mediamanager"], "b": [], "c": [], "d": ["occupation_doctor", "occupation_lawyer"]}
    assert silver_attributes(raw).columns[5:] == ["occupation_doctor", "occupation_lawyer", "occupation_mediamanager"]


def financial_rows(spark, rows):
    names = [*FINANCIAL_RENAMES, "snapshot_date"]
    full = [{**{c: None for c in names}, "Customer_ID": str(i), "snapshot_date": "2023-01-01", **r} for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in full], ", ".join(f"{c} string" for c in names))


def test_financials(spark, ansi):
    raw = financial_rows(spark, [
        {"Annual_Income": "_100_", "Monthly_Balance": "5", "Interest_Rate": "41", "Credit_Mix": "Good", "Type_of_Loan": "Auto Loan, and Payday Loan"},
        {"Annual_Income": "300", "Interest_Rate": "-3", "Credit_Mix": "_", "Type_of_Loan": "Auto Loan, Auto Loan"},
        {"Annual_Income": "200", "Interest_Rate": "7", "Changed_Credit_Limit": "_", "Type_of_Loan": " "},
        {"Annual_Income": "", "Monthly_Balance": "__-333333333333333333333333333__", "Type_of_Loan": "Spaceship Loan"},
        {"Annual_Income": "NaN", "Payment_Behaviour": "!@9#%8", "Credit_History_Age": "22 Years and 9 Months"},
    ])
    got = [r.asDict() for r in silver_financials(raw).orderBy("customer_id").collect()]
    # Ranks 100, 200, 300, NaN: median at rank 2, cap at rank 4, which is NaN.
    assert [r["annual_income"] for r in got[:4]] == [100.0, 300.0, 200.0, 200.0]
    assert [r["interest_rate"] for r in got] == [40, 0, 7, 7, 7]
    assert [r["credit_mix"] for r in got[:2]] == ["Good", None] and got[0]["credit_mix_encoded"] == 3
    assert [r["num_of_loan"] for r in got] == [1, 1, 1, 0, 1]
    assert got[0]["payday_loan"] == 0 and got[2]["not_specified"] == 1 and got[4]["not_specified"] == 1
    assert [r["monthly_balance"] for r in got] == [5, 0, 0, 0, 0] and got[3]["outstanding_debt"] == 0
    assert got[4]["credit_history_months_total"] == 273 and got[4]["payment_behaviour"] == ""
    assert silver_financials(raw, strip_and=True).where("customer_id = '0'").first()["payday_loan"] == 1


def test_statistics_are_those_of_each_snapshot(spark):
    raw = financial_rows(spark, [
        {"Annual_Income": "10", "snapshot_date": "2023-01-01"}, {"snapshot_date": "2023-01-01"},
        {"Annual_Income": "99", "snapshot_date": "2023-02-01"}, {"snapshot_date": "2023-02-01"},
    ])
    got = {r["customer_id"]: r["annual_income"] for r in silver_financials(raw).collect()}
    assert got == {"0": 10.0, "1": 10.0, "2": 99.0, "3": 99.0}


def test_financial_invariants(spark):
    out = silver_financials(views.financials(spark, SF)).cache()
    bad = [F.col(c) < 0 for c in QUANTILE_CLIPPED] + [~F.col(c).between(0, cap) for c, cap in FIXED_CAPS.items()]
    bad.append(sum(F.col(snake_case(k)) for k in LOAN_KINDS) != F.col("num_of_loan"))
    for condition in bad:
        assert out.where(condition).count() == 0
    raw = views.financials(spark, SF)
    month = raw.agg(F.max("snapshot_date")).first()[0]
    one = silver_financials(raw.where(F.col("snapshot_date") == month))
    assert sorted(map(str, one.collect())) == sorted(map(str, out.where(F.col("snapshot_date") == month).collect()))
    out.unpersist()


def test_aggregated_and_gold(spark):
    day = date(2023, 1, 1)
    attributes = spark.createDataFrame([("a", "n", 30, "s", day), ("b", "n", 31, "s", day)], "customer_id string, name string, age int, ssn string, snapshot_date date")
    financials = spark.createDataFrame(
        [("a", day, None, 2, 3, 5, "x"), ("b", day, 1, None, 3, None, "x"), ("c", day, 9, 9, 9, 9, "x")],
        "customer_id string, snapshot_date date, credit_mix_encoded int, spending_level_encoded int, transaction_value_encoded int, num_credit_inquiries int, credit_mix string",
    )
    clicks = spark.createDataFrame([("a", day, 1, "l1"), ("a", day, 1, "l2"), ("b", day, 2, "l3")], "customer_id string, snapshot_date date, fe_1 int, loan_id string")
    aggregated = silver_aggregated(join_features(attributes, financials, clicks))
    got = {r["loan_id"]: r for r in aggregated.collect()}
    assert set(got) == {"l1", "l2", "l3"}
    # NULL is the most frequent credit mix, so it stays; the others are filled.
    assert [got[k]["credit_mix_encoded"] for k in sorted(got)] == [None, None, 1]
    assert got["l3"]["spending_level_encoded"] == 2 and got["l3"]["num_credit_inquiries"] == 5
    gold = gold_features(aggregated)
    assert not {"name", "ssn", "credit_mix"} & set(gold.columns) and "age" in gold.columns
    assert gold.agg(F.max("high_value_customer_flag")).first()[0] == 0
    assert gold_features(aggregated, spending_level=2).agg(F.min("high_value_customer_flag")).first()[0] == 1


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("mart")
    raw = {}
    for source in stores.SOURCES:
        raw[source] = str(root / "raw" / source)
        getattr(views, source)(spark, SF).write.option("header", True).option("escape", '"').csv(raw[source])
    gold = stores.run_feature_store(spark, raw, str(root / "mart"), "1996-01-15", "1996-04-01")
    return raw, stores.Mart(str(root / "mart")), gold


def test_feature_store_run(spark, mart):
    raw, m, gold = mart
    months = [date(1996, i, 1) for i in (1, 2, 3, 4)]
    for table in (m.bronze("loans"), m.silver("financials"), m.gold("labels")):
        found = read_snapshots(spark, table).select("snapshot_date").distinct()
        assert sorted(r[0] for r in found.collect()) == months
    dates = [str(d) for d in months]
    lazy = silver_financials(views.financials(spark, SF).where(F.col("snapshot_date").isin(months)))
    written = read_snapshots(spark, m.silver("financials")).select(*lazy.columns)
    assert written.count() == lazy.count() and written.exceptAll(lazy).count() == 0
    assert gold.count() == read_snapshots(spark, m.silver("aggregated")).count() > 0
    # A rerun replaces, it does not add.
    before = read_snapshots(spark, m.gold("labels")).count()
    assert stores.build_gold_labels(spark, m.silver("loans"), m.gold("labels"), dates) == stores.Built(before)
    assert read_snapshots(spark, m.gold("labels")).count() == before


def test_missing_tables(spark, mart, tmp_path):
    _, m, _ = mart
    out, day = str(tmp_path / "out"), ["1996-02-01"]
    missing = str(tmp_path / "missing")
    none = stores.Built(0, day)
    assert stores.build_silver_aggregated(spark, m.silver("clickstream"), missing, m.silver("financials"), out, day) == none
    assert stores.build_gold_features(spark, missing, out, day) == none
    assert stores.build_gold_features(spark, m.silver("aggregated"), out, ["2020-01-01"]) == stores.Built(0, ["2020-01-01"])
    assert stores.build_silver_clickstream(spark, m.bronze("clickstream"), missing, out, day) == none
    assert not (tmp_path / "out").exists()


def test_one_absent_month_costs_that_month_only(spark, mart, tmp_path):
    _, m, gold = mart
    dates = ["1996-01-01", "1996-02-01", "2020-01-01", "1996-03-01"]
    built = stores.build_gold_features(spark, m.silver("aggregated"), str(tmp_path / "g"), dates)
    assert built.skipped == ["2020-01-01"]
    assert built.rows == gold.where(F.col("snapshot_date") < date(1996, 4, 1)).count()
    # The report of NULLs stands beside the table.
    report = read_snapshots(spark, str(tmp_path / "g_nulls"))
    assert set(report.columns) == {"snapshot_date", "column_name", "null_count", "null_pct"}


def test_vocabulary_grows_from_month_to_month(spark, tmp_path):
    def bronze(day, occupation):
        row = [("c", "n", "30", "230-22-9583", occupation, date.fromisoformat(day))]
        raw = spark.createDataFrame(row, "Customer_ID string, Name string, Age string, SSN string, Occupation string, snapshot_date date")
        stores.build_bronze(spark, raw, str(tmp_path / "b"), [day])
        stores.build_silver_attributes(spark, str(tmp_path / "b"), str(tmp_path / "s"), [day])

    bronze("2023-01-01", "Doctor")
    bronze("2023-02-01", "Engineer")
    got = stores.read_attributes(spark, str(tmp_path / "s")).orderBy("snapshot_date").select("occupation_doctor", "occupation_engineer")
    assert [tuple(r) for r in got.collect()] == [(1, 0), (0, 1)]


def test_a_run_refuses_files_whose_columns_are_in_another_order(spark, tmp_path):
    raw = views.loans(spark, SF)
    raw.write.option("header", True).csv(str(tmp_path / "raw"))
    swapped = raw.limit(1).select("Customer_ID", "loan_id", *raw.columns[2:])
    swapped.write.option("header", True).mode("append").csv(str(tmp_path / "raw"))
    with pytest.raises(Exception, match="CSV header does not conform"):
        stores.run_label_store(spark, str(tmp_path / "raw"), str(tmp_path / "m"), "1996-01-01", "1996-01-01")


def test_one_snapshot_jobs(spark, mart, tmp_path):
    from monthmill.jobs import parser, run

    raw, m, gold = mart
    args = ["--snapshot-date", "1996-02-01"]
    run(spark, parser().parse_args(["bronze", *args, "--raw", raw["loans"], "--out", str(tmp_path / "b")]))
    day = date(1996, 2, 1)
    assert read_snapshots(spark, str(tmp_path / "b")).count() == views.loans(spark, SF).where(F.col("snapshot_date") == day).count()
    tables = [x for t in ("clickstream", "attributes", "financials") for x in (f"--{t}", m.silver(t))]
    run(spark, parser().parse_args(["aggregate", *args, *tables, "--out", str(tmp_path / "a")]))
    run(spark, parser().parse_args(["gold-features", *args, "--aggregated", str(tmp_path / "a"), "--out", str(tmp_path / "g")]))
    one = read_snapshots(spark, str(tmp_path / "g"))
    assert one.select(*gold.columns).exceptAll(gold).count() == 0
    assert one.count() == gold.where(F.col("snapshot_date") == day).count()


def test_only_changed_months_are_built_again(spark, tmp_path):
    """One month's raw rows change: it is new in every layer, all other months stay the versions they were."""
    def run(name, change=False):
        loans = views.loans(spark, SF)
        if change:
            other = F.col("snapshot_date") == date(1996, 2, 1)
            loans = loans.withColumn("overdue_amt", F.when(other, F.lit(0).cast("float")).otherwise(F.col("overdue_amt")))
        loans.write.option("header", True).csv(str(tmp_path / name))
        stores.run_label_store(spark, str(tmp_path / name), str(tmp_path / "m"), "1996-01-01", "1996-04-01", only_changed=True)
        return {t: snapshot_versions(spark, t) for t in (m.bronze("loans"), m.silver("loans"), m.gold("labels"))}

    m = stores.Mart(str(tmp_path / "m"))
    first, same, changed = run("a"), run("b"), run("c", change=True)
    assert same == first and all(len(v) == 4 for v in first.values())
    for table, versions in changed.items():
        assert [d for d, v in versions.items() if v != first[table][d]] == ["1996-02-01"], table
    # Other parameters are another input.
    dates = list(first[m.gold("labels")])
    again = stores.build_gold_labels(spark, m.silver("loans"), m.gold("labels"), dates, dpd=60, only_changed=True)
    assert sorted(again.months) == dates
    # What is gone from a month is gone from all layers: the rebuilt gold month is that of a build from scratch.
    stores.build_gold_labels(spark, m.silver("loans"), str(tmp_path / "g"), dates, dpd=60)
    ours, theirs = read_snapshots(spark, m.gold("labels")), read_snapshots(spark, str(tmp_path / "g"))
    assert ours.count() == theirs.count() > 0 and ours.exceptAll(theirs).count() == 0


def test_null_report_is_that_of_the_table(spark, mart):
    from monthmill.operators.profile import null_report

    _, m, _ = mart
    for table in (m.silver("aggregated"), m.gold("features")):
        want = null_report(read_snapshots(spark, table), ["snapshot_date"])
        got = read_snapshots(spark, f"{table}_nulls").select(*want.columns)
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def _csv(folder, lines):
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


@pytest.mark.parametrize("only_changed", [True, False])
def test_bronze_of_large_raw_files_is_not_shuffled(spark, tmp_path, monkeypatch, only_changed):
    lines = ["id,snapshot_date"] + [f"{i},2023-0{1 + i % 3}-01" for i in range(90)] + ["7,soon", "8", ""]
    dates = ["2023-01-01", "2023-02-01", "2023-03-01", "2023-04-01"]
    path = _csv(tmp_path / "raw", lines)
    raw = lambda: read_csv(spark, path, ["id", "snapshot_date"], keep_rejects=True, multi_line=None)
    plain = stores.build_bronze(spark, raw(), str(tmp_path / "plain"), dates, only_changed)
    asked = []
    monkeypatch.setattr(stores, "MOST_SHUFFLED", 0)
    monkeypatch.setattr(stores, "gathered", lambda df, path, f=stores.gathered: asked.append(path) or f(df, path))
    built = stores.build_bronze(spark, raw(), str(tmp_path / "large"), dates, only_changed)
    assert asked and built == plain and built.months == plain.months and built.rejected == 2
    tables = [sorted(map(str, read_snapshots(spark, str(tmp_path / t), dates).collect())) for t in ("plain", "large")]
    assert tables[0] == tables[1] and len(tables[0]) == 90
    assert not (tmp_path / "large_stage").exists() or not list((tmp_path / "large_stage").iterdir())


def test_rejects_cost_no_scan_of_their_own_where_there_are_none(spark, tmp_path, monkeypatch):
    raw = lambda path: read_csv(spark, path, ["id", "snapshot_date"], keep_rejects=True, multi_line=None)
    torn, clean = _csv(tmp_path / "torn", ["id,snapshot_date", "1,2023-01-01", "2"]), _csv(tmp_path / "clean", ["id,snapshot_date", "1,2023-01-01"])
    root, dates = str(tmp_path / "t"), ["2023-01-01"]
    assert stores.build_bronze(spark, raw(torn), root, dates).rejected == 1 and (tmp_path / "t_rejects").exists()
    scans = []
    monkeypatch.setattr(stores, "rejects", lambda df, f=stores.rejects: scans.append(df) or f(df))
    assert stores.build_bronze(spark, raw(clean), root, dates).rejected == 0
    assert not scans and not (tmp_path / "t_rejects").exists()
    # Also where no month is built.
    assert stores.build_bronze(spark, raw(torn), root, []).rejected == 1 and len(scans) == 1
    assert stores.build_bronze(spark, raw(clean), root, dates, only_changed=True).rejected == 0
    assert stores.build_bronze(spark, raw(clean), root, dates, only_changed=True) == stores.Built()


def test_bronze_of_very_large_raw_files_is_written_once(spark, tmp_path, monkeypatch):
    lines = ["id,snapshot_date"] + [f"{i},2023-0{1 + i % 3}-01" for i in range(90)] + ["7,soon", "8"]
    dates = ["2023-01-01", "2023-02-01", "2023-03-01", "2023-04-01"]
    path = _csv(tmp_path / "raw", lines)
    raw = lambda: read_csv(spark, path, ["id", "snapshot_date"], keep_rejects=True, multi_line=None)
    plain = stores.build_bronze(spark, raw(), str(tmp_path / "plain"), dates)
    monkeypatch.setattr(stores, "MOST_SHUFFLED", 0)
    monkeypatch.setattr(stores, "MOST_GATHERED", 0)
    monkeypatch.setattr(stores, "gathered", lambda df, path: pytest.fail("written twice"))
    built = stores.build_bronze(spark, raw(), str(tmp_path / "large"), dates)
    assert built == plain and built.months == plain.months and built.rejected == 2
    tables = [sorted(map(str, read_snapshots(spark, str(tmp_path / t), dates).collect())) for t in ("plain", "large")]
    assert tables[0] == tables[1] and len(tables[0]) == 90


def test_a_changed_month_is_read_again_from_its_own_files(spark, tmp_path, monkeypatch):
    """The first build takes fingerprints from what it wrote; later ones from all raw rows, of which only the changed files are read again."""
    folder, dates, root = tmp_path / "raw", ["2023-01-01", "2023-02-01", "2023-03-01", "2023-04-01"], str(tmp_path / "t")
    folder.mkdir()

    def drop(name, month, value, lost=()):
        lines = ["id,loan_amt,snapshot_date", *(f"{i},{value + i},2023-0{month}-01" for i in range(40)), *lost]
        (folder / f"{name} %.csv").write_text("\n".join(lines) + "\n")

    def build():
        raw = read_csv(spark, str(folder), ["id", "loan_amt", "snapshot_date"], keep_rejects=True, multi_line=None)
        return raw, stores.build_bronze(spark, raw, root, dates, only_changed=True)

    scanned, read = [], []
    monkeypatch.setattr(stores, "_parts", lambda rows, file, f=stores._parts: scanned.append(rows.inputFiles()) or f(rows, file))
    monkeypatch.setattr(stores, "_publish_bronze", lambda spark, raw, *more, f=stores._publish_bronze: read.append(raw.collect()) or f(spark, raw, *more))
    for month in (1, 2, 3):
        drop(f"m{month}", month, 0, ["7,soon"] if month == 1 else [])
    raw, built = build()
    assert built.rows == 120
    assert built.rejected == 1 and len(scanned) == 1 and all("/t/version=" in f for f in scanned[0])
    # The fingerprint is that of the raw rows: their number and two sums of their hashes.
    wide = raw.where("_corrupt_record is null and snapshot_date = '2023-02-01'").selectExpr("id", "loan_amt", "cast(snapshot_date as date) as d")
    sums = [wide.agg(F.sum(F.xxhash64(F.lit(i), "id", "loan_amt", "d").cast("decimal(38,0)"))).first()[0] for i in range(2)]
    assert stores.Ledger(spark, root).current()["2023-02-01"].inputs == {"contents": f"40 {sums[0]} {sums[1]}"}
    assert stores.Ledger(spark, root).current()["2023-04-01"].inputs == {"contents": "0"}
    assert build()[1] == stores.Built(rejected=1) and len(read) == 1 and len(scanned[1]) == 3
    drop("m2", 2, 1000)
    drop("m4", 4, 0, ["8"])
    raw, built = build()
    assert built.months == {"2023-02-01": 40, "2023-04-01": 40} and built.rejected == 2 and len(scanned[2]) == 4
    assert {str(r["snapshot_date"]) for r in read[1] if r["_corrupt_record"] is None} == {"2023-02-01", "2023-04-01"}
    (folder / "m3 %.csv").unlink()
    raw, built = build()
    assert built.months == {"2023-03-01": 0} and not read[2]
    stores.build_bronze(spark, raw, str(tmp_path / "new"), dates)
    ours, theirs = (sorted(map(str, read_snapshots(spark, t, dates).collect())) for t in (root, str(tmp_path / "new")))
    assert ours == theirs and len(ours) == 120


def test_fingerprints_of_raw_rows_that_lie_in_no_file(spark, tmp_path):
    rows = [(float("nan"), "2023-01-01"), (-0.0, "2023-01-01"), (None, "2023-02-01"), (1.5, None), (2.0, "soon")]
    raw, root, dates = spark.createDataFrame(rows, "x double, snapshot_date string"), str(tmp_path / "t"), ["2023-01-01", "2023-02-01"]
    assert stores.build_bronze(spark, raw, root, dates, only_changed=True).months == {"2023-01-01": 2, "2023-02-01": 1}
    assert stores.build_bronze(spark, raw, root, dates, only_changed=True) == stores.Built()
    more = raw.unionAll(spark.createDataFrame([(3.0, "2023-02-01")], raw.schema))
    assert stores.build_bronze(spark, more, root, dates, only_changed=True).months == {"2023-02-01": 2}


def test_seldom_repeated_columns_are_written_without_a_dictionary(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(1000).selectExpr("cast(id % 500 as string) as loan_id", "cast(id % 500 as float) as balance", "12 as tenure", "date'2023-01-01' as snapshot_date")
    tables = {"published": lambda p: write_snapshots(rows, p), "gathered": lambda p: gathered(rows, p), "staged": lambda p: stage(rows, p, "x")}
    for name, write in tables.items():
        write(str(tmp_path / name))
        files = list((tmp_path / name).rglob("*.parquet"))
        assert files
        for file in files:
            group = pq.ParquetFile(file).metadata.row_group(0)
            found = {group.column(i).path_in_schema: group.column(i).has_dictionary_page for i in range(group.num_columns)}
            assert not found["loan_id"] and not found["balance"] and found["tenure"], name
        got = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / name)).selectExpr("loan_id", "balance", "tenure").distinct()
        assert got.count() == 500


def _shuffles(df):
    """Exchanges of a plan, those by which a write gathers its rows too."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_silver_rows_by_snapshot_cost_one_shuffle(spark, tmp_path):
    raw = views.financials(spark, SF).where("snapshot_date < date'1996-01-01'").localCheckpoint()
    kept = {}
    keep = lambda df, name: kept.setdefault(name, stage(df, str(tmp_path), name))
    laid, plain = silver_financials(raw, keep=keep, by_snapshot=True), silver_financials(raw)
    assert {"cleaned", "statistics", "ranges_0_0"} == set(kept)
    assert laid.exceptAll(plain).count() == 0 and plain.exceptAll(laid).count() == 0
    # The other exchange is that of the broadcast statistics.
    assert _shuffles(laid) <= 2 and "rangepartitioning" in laid._jdf.queryExecution().executedPlan().toString()
    months = [[r[0] for r in p] for p in laid.select("snapshot_date").rdd.map(lambda r: [r[0]]).glom().collect()]
    ends = [(min(p), max(p)) for p in months if p]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    raw = views.attributes(spark, SF).where("snapshot_date < date'1996-01-01'").localCheckpoint()
    some = ["BUILDING", "MediaManager"]
    laid, plain = silver_attributes(raw, some, by_snapshot=True), silver_attributes(raw, some)
    assert laid.exceptAll(plain).count() == 0 and plain.exceptAll(laid).count() == 0 and _shuffles(laid) == 1
