"""Every operator as a query on the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import snake_case
from ..operators import profile, sketches
from ..operators.encode import one_hot, vocabulary
from ..operators.joins import lay_by_keys
from ..operators.modes import fill_with_modes, modes
from ..operators.quantiles import quantiles
from ..operators.shape import column_info, rename, rows_equal
from ..plans.attributes import clean_attributes, silver_attributes
from ..plans.clickstream import loan_start_keys, silver_clickstream
from ..plans.features import gold_features, join_features, silver_aggregated
from ..plans.financials import (
    NUMERIC,
    clean_financials,
    count_loan_types,
    encode_financials,
    financial_statistics,
    impute_and_clip,
    silver_financials,
)
from ..plans.loans import bad_rate_by_mob, gold_labels, silver_loans
from ..plans import stores
from ..plans.stores import run_feature_store, run_label_store
from ..schemas import KEYS, LOAN_KINDS, RAW_COLUMNS, SNAPSHOT, SSN_FORMAT
from ..session import at_once, stage
from ..sources.snapshots import (
    ingest,
    publish_snapshots,
    read_csv,
    read_snapshots,
    snapshot_dates,
    snapshot_versions,
    snapshots_in,
    spine_between,
    write_snapshots,
)
from . import views

Query = Callable[[SparkSession, str], DataFrame]

# The window of the backfill queries: 24 months inside the given tables.
START, END = "1996-01-01", "1997-12-01"
# All months of the given tables' orders and of their ten installments.
FIRST, LAST = "1995-01-01", "2002-08-01"
# The month that one source lacks, and the one of the one-snapshot jobs.
ABSENT, ONE_MONTH = "1996-06-01", "1997-03-01"
# Occupations of the attribute view.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "MediaManager"]

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _scratch(spark: SparkSession) -> str:
    """A folder for what a query writes before its result is read; it goes when the session's JVM ends."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/checks-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    return path


def _drop_raw(df: DataFrame, path: str, codec: str = "gzip") -> None:
    """Raw files as a source delivers them: compressed CSV, of so many rows that one task reads a file."""
    options = {"header": True, "escape": '"', "compression": codec}
    df.write.options(**options).option("maxRecordsPerFile", 1_000_000).csv(path)


def _doubles(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[f"cast({c} as double) as {c}" if t == "float" else c for c, t in df.dtypes])


def _silver_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The three silver tables of the feature join, written as in a real run."""
    root = _scratch(spark)

    def clicks():
        return silver_clickstream(views.clickstream(spark, sf_dir), silver_loans(views.loans(spark, sf_dir)))

    def financials():
        return silver_financials(views.financials(spark, sf_dir), keep=lambda df, name: stage(df, root, name))

    return at_once(
        lambda: stage(silver_attributes(views.attributes(spark, sf_dir), SEGMENTS), root, "attributes"),
        lambda: stage(financials(), root, "financials"),
        lambda: stage(clicks(), root, "clickstream"),
    )


def _aggregated(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _scratch(spark)
    return silver_aggregated(join_features(*_silver_tables(spark, sf_dir)), keep=lambda df, name: stage(df, root, name))


# Sources, time axis and snapshot tables


@query
def month_spine(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    bounds = orders.agg(
        F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last")
    )
    return spine_between(bounds, "first", "last")


@query
def bronze_backfill(spark, sf_dir):
    return _doubles(ingest(views.loans(spark, sf_dir), snapshot_dates(START, END)))


@query
def bronze_counts(spark, sf_dir):
    return profile.row_counts(ingest(views.loans(spark, sf_dir)), [SNAPSHOT])


@query
def multi_snapshot_scan(spark, sf_dir):
    root = _scratch(spark)
    write_snapshots(ingest(views.loans(spark, sf_dir)), root)
    return _doubles(read_snapshots(spark, root))


@query
def csv_scan(spark, sf_dir):
    raw = f"{_scratch(spark)}/raw"
    views.attributes(spark, sf_dir).write.option("header", True).option("escape", '"').csv(raw)
    return read_csv(spark, raw, RAW_COLUMNS["attributes"])


@query
def csv_quarantine(spark, sf_dir):
    """Bronze attributes from files with torn and too long lines, line feeds in cells and no dates; and all that was rejected."""
    root = _scratch(spark)
    lines = views.attribute_lines(spark, sf_dir).repartition("file").sortWithinPartitions("file", "place")
    lines.select("file", "line").write.partitionBy("file").text(f"{root}/raw")
    raw = read_csv(spark, f"{root}/raw/*", RAW_COLUMNS["attributes"], keep_rejects=True, multi_line=None)
    built = stores.build_bronze(spark, raw, f"{root}/bronze", snapshot_dates(FIRST, LAST))
    lost = spark.read.parquet(f"{root}/bronze_rejects")
    if built.rejected != lost.count():
        raise ValueError(f"{built.rejected} rows rejected")
    return read_snapshots(spark, f"{root}/bronze").unionByName(lost.select("reason", "record"), allowMissingColumns=True)


@query
def csv_bronze(spark, sf_dir):
    """A bronze table kept as CSV, read back by date."""
    root = _scratch(spark)
    dates = snapshot_dates(FIRST, LAST)
    write_snapshots(views.attributes(spark, sf_dir), root, dates, format="csv")
    return read_snapshots(spark, root, dates, format="csv", columns=RAW_COLUMNS["attributes"])


@query
def rerun_over_snapshots(spark, sf_dir):
    """All months written, then those of one window again with other values."""
    root, raw = _scratch(spark), views.loans(spark, sf_dir)
    write_snapshots(ingest(raw), root)
    again = ingest(raw, snapshot_dates(START, END)).withColumn("tenure", F.col("tenure") + 1)
    write_snapshots(again, root, snapshot_dates(START, END))
    return _doubles(read_snapshots(spark, root))


@query
def read_during_rebuild(spark, sf_dir):
    """All months as a reader sees them that began before a rebuild of one window, and reads after it."""
    root, raw = _scratch(spark), views.loans(spark, sf_dir)
    write_snapshots(ingest(raw), root)
    begun = read_snapshots(spark, root)
    write_snapshots(ingest(raw, snapshot_dates(START, END)).withColumn("tenure", F.lit(-1)), root, snapshot_dates(START, END))
    return _doubles(begun)


@query
def read_after_failed_rebuild(spark, sf_dir):
    """All months after a rebuild of all of them that broke off while it wrote."""
    root, raw = _scratch(spark), views.loans(spark, sf_dir)
    write_snapshots(ingest(raw), root)
    broken = F.when(F.col("loan_id").cast("long") % 97 == 5, F.raise_error(F.lit("broken off")).cast("int")).otherwise(-1)
    try:
        write_snapshots(ingest(raw).withColumn("tenure", broken), root)
    except (PySparkException, Py4JJavaError) as error:
        if "broken off" not in str(error):
            raise
    return _doubles(read_snapshots(spark, root))


@query
def rows_of_builds(spark, sf_dir):
    """Rows of every month as the ledger has them, counted while they were written."""
    written = publish_snapshots(ingest(views.loans(spark, sf_dir)), _scratch(spark))
    rows = [(date.fromisoformat(d), n) for d, n in written.rows.items()]
    return spark.createDataFrame(rows, f"{SNAPSHOT} date, row_count long")


@query
def first_rows(spark, sf_dir):
    """The first rows of the raw attributes in a defined order; the number is the feature."""
    return profile.first_rows(views.attributes(spark, sf_dir), 20, ["Customer_ID", SNAPSHOT, "Occupation"])


# Loans and labels


@query
def silver_loan_snapshots(spark, sf_dir):
    return _doubles(silver_loans(views.loans(spark, sf_dir)))


@query
def gold_label_store(spark, sf_dir):
    return gold_labels(silver_loans(views.loans(spark, sf_dir)))


@query
def gold_label_store_keep_spelling(spark, sf_dir):
    return gold_labels(silver_loans(views.loans(spark, sf_dir), renames={}), dpd=60, mob=8)


@query
def label_counts(spark, sf_dir):
    return profile.value_counts(gold_labels(silver_loans(views.loans(spark, sf_dir))), "label")


@query
def bad_rate(spark, sf_dir):
    return bad_rate_by_mob(silver_loans(views.loans(spark, sf_dir)), started_before="1999-01-01")


@query
def bad_rate_at_installment(spark, sf_dir):
    return bad_rate_by_mob(silver_loans(views.loans(spark, sf_dir)), started_before="1999-01-01", installment=10)


@query
def label_store_run(spark, sf_dir):
    root = _scratch(spark)
    _drop_raw(views.loans(spark, sf_dir), f"{root}/raw")
    return run_label_store(spark, f"{root}/raw", f"{root}/mart", START, END)


@query
def label_store_all_months(spark, sf_dir):
    root = _scratch(spark)
    _drop_raw(views.loans(spark, sf_dir), f"{root}/raw")
    return run_label_store(spark, f"{root}/raw", f"{root}/mart", FIRST, LAST)


@query
def changed_months_only(spark, sf_dir):
    """The label store of all months, run again after the raw rows of one month changed: labels, and which months are new.

    The source delivers that month apart, so only its files are written anew; both runs read all raw rows. Their files are lz4, which
    is written and read in a fraction of gzip's time, for twice its bytes.
    """
    root, loans = _scratch(spark), views.loans(spark, sf_dir)
    other = F.col(SNAPSHOT).eqNullSafe(F.lit(ABSENT).cast("date"))

    def run(*names):
        return run_label_store(spark, [f"{root}/{name}" for name in names], f"{root}/mart", FIRST, LAST, only_changed=True)

    _drop_raw(loans.where(~other), f"{root}/rest", "lz4")
    _drop_raw(loans.where(other), f"{root}/month", "lz4")
    run("rest", "month")
    gold = stores.Mart(f"{root}/mart").gold("labels")
    before = snapshot_versions(spark, gold)
    _drop_raw(loans.where(other).withColumn("overdue_amt", F.lit(0).cast("float")), f"{root}/again", "lz4")
    labels = run("rest", "again")
    rebuilt = [d for d, version in snapshot_versions(spark, gold).items() if version != before[d]]
    return labels.withColumn("rebuilt", F.col(SNAPSHOT).cast("string").isin(rebuilt).cast("int"))


@query
def silver_loans_tiny_due(spark, sf_dir):
    """Amounts due so small that the missed installments leave the range of int and the first missed date that of dates."""
    loans = views.loans(spark, sf_dir)
    tiny = F.when(F.col("loan_id").cast("long") % 19 == 0, F.lit(1e-30).cast("float")).otherwise(F.col("due_amt"))
    out = silver_loans(loans.withColumn("due_amt", tiny))
    return out.select("loan_id", "installment_num", "installments_missed", "first_missed_date", "dpd")


# Clickstream


@query
def loan_keys(spark, sf_dir):
    return loan_start_keys(silver_loans(views.loans(spark, sf_dir)))


@query
def clickstream_at_loan_start(spark, sf_dir):
    return silver_clickstream(views.clickstream(spark, sf_dir), silver_loans(views.loans(spark, sf_dir)))


@query
def clickstream_without_loans(spark, sf_dir):
    return silver_clickstream(views.clickstream(spark, sf_dir), None)


# Attributes


@query
def cleaned_attributes(spark, sf_dir):
    return clean_attributes(views.attributes(spark, sf_dir))


@query
def occupation_vocabulary(spark, sf_dir):
    cleaned = clean_attributes(views.attributes(spark, sf_dir))
    return cleaned.select("occupation").where(F.col("occupation").isNotNull()).distinct()


@query
def one_hot_occupation(spark, sf_dir):
    raw = views.attributes(spark, sf_dir)
    return silver_attributes(raw, vocabulary(clean_attributes(raw), "occupation"))


@query
def one_hot_any_case(spark, sf_dir):
    """Values that differ in case only share a column."""
    customers = views.table(spark, sf_dir, "customer")
    segment = F.when(F.col("c_custkey") % 3 == 0, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    rows = customers.select("c_nationkey", "c_acctbal", segment.alias("segment"))
    return one_hot(rows, "segment", vocabulary(rows, "segment"), "segment_")


@query
def attributes_month_by_month(spark, sf_dir):
    """Silver attributes, the first six months each by a build of its own, with the vocabulary that grows."""
    root, dates = _scratch(spark), snapshot_dates(FIRST, LAST)
    write_snapshots(views.attributes(spark, sf_dir), f"{root}/bronze", dates)
    for some in [*([d] for d in dates[:6]), dates[6:]]:
        stores.build_silver_attributes(spark, f"{root}/bronze", f"{root}/silver", some)
    return stores.read_attributes(spark, f"{root}/silver")


# Financials


@query
def cleaned_financials(spark, sf_dir):
    return _doubles(clean_financials(views.financials(spark, sf_dir)))


@query
def snapshot_statistics(spark, sf_dir):
    return _doubles(financial_statistics(clean_financials(views.financials(spark, sf_dir))))


@query
def order_statistics(spark, sf_dir):
    """Medians and caps of a bigint and a decimal, each in its own type."""
    orders = views.table(spark, sf_dir, "orders")
    scaled = orders.select("o_orderpriority", (F.col("o_orderkey") + 2**60).alias("key"), F.col("o_totalprice").cast("decimal(30,10)").alias("price"))
    found = quantiles(scaled, {c: {"median": 0.5, "cap": 0.999} for c in ("key", "price")}, ["o_orderpriority"])
    return found.select("o_orderpriority", *(F.col(c).cast("string").alias(c) for c in found.columns[1:]))


@query
def window_quantile_sketches(spark, sf_dir):
    """Medians and caps over the twelve months up to each month, from a stored sketch per month.

    ``within`` says whether the rank that the value has among the window's rows is off by at most twice the stated error.
    """
    wanted = {c: {"median": 0.5, "cap": 0.999} for c in ("annual_income", "monthly_inhand_salary")}
    rows, root = clean_financials(views.financials(spark, sf_dir)).select(SNAPSHOT, *wanted), _scratch(spark)
    until = F.explode(F.sequence(F.col(SNAPSHOT), F.add_months(SNAPSHOT, 11), F.expr("interval 1 month"))).alias("until")
    write_snapshots(sketches.quantile_sketches(rows, list(wanted), [SNAPSHOT]), root)
    merged = sketches.merge_sketches(read_snapshots(spark, root).select("*", until), list(wanted), ["until"])
    found = stage(sketches.sketch_quantiles(merged, wanted, ["until"]), root, "_found")

    places = [(c, name, p) for c, named in wanted.items() for name, p in named.items()]
    below, upto = (lambda c, name: F.count_if(F.col(c) < F.col(f"{c}_{name}"))), (lambda c, name: F.count_if(F.col(c) <= F.col(f"{c}_{name}")))
    ranks = rows.select(*wanted, until).join(found, "until").groupBy("until").agg(
        *[F.first(f"{c}_n").alias(f"{c}_n") for c in wanted],
        *[f(c, name).alias(f"{c}_{name}_{i}") for c, name, _ in places for i, f in enumerate((below, upto))],
    )
    error = 2 * sketches.rank_error()

    def row(c, name, p):
        n, low, high = F.col(f"{c}_n"), F.col(f"{c}_{name}_0"), F.col(f"{c}_{name}_1")
        within = (low <= (p + error) * n) & (high >= (p - error) * n)
        return F.struct(F.lit(f"{c}_{name}").alias("name"), n.alias("n"), within.cast("int").alias("within"))

    return ranks.select("until", F.inline(F.array(*(row(*place) for place in places))))


@query
def imputed_and_clipped(spark, sf_dir):
    cleaned = clean_financials(views.financials(spark, sf_dir))
    clipped = impute_and_clip(cleaned, financial_statistics(cleaned))
    return _doubles(clipped.select("customer_id", SNAPSHOT, *NUMERIC))


@query
def multi_hot_loan_types(spark, sf_dir):
    cleaned = clean_financials(views.financials(spark, sf_dir)).select(*KEYS, "num_of_loan", "type_of_loan")
    return count_loan_types(cleaned)


@query
def multi_hot_loan_types_strip_and(spark, sf_dir):
    cleaned = clean_financials(views.financials(spark, sf_dir), strip_and=True)
    return count_loan_types(cleaned.select(*KEYS, "num_of_loan", "type_of_loan"))


@query
def ordinal_scales(spark, sf_dir):
    encoded = encode_financials(clean_financials(views.financials(spark, sf_dir)))
    return encoded.select(
        *KEYS, "credit_mix", "credit_mix_encoded", "payment_behaviour", "spending_level_encoded",
        "transaction_value_encoded",
    )


@query
def credit_history(spark, sf_dir):
    encoded = encode_financials(clean_financials(views.financials(spark, sf_dir)))
    return encoded.select(
        *KEYS, "credit_history_age", "credit_history_years", "credit_history_months", "credit_history_months_total"
    )


@query
def silver_financial_features(spark, sf_dir):
    return _doubles(silver_financials(views.financials(spark, sf_dir)))


# Joined features and the feature store


@query
def feature_join(spark, sf_dir):
    return _doubles(join_features(*_silver_tables(spark, sf_dir)))


@query
def feature_join_of_buckets(spark, sf_dir):
    """The feature join over silver tables that lie in buckets of its keys."""
    root, number = _scratch(spark), int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables = zip(("attributes", "financials", "clickstream"), _silver_tables(spark, sf_dir), strict=True)
    names = {name: f"{name}_{uuid.uuid4().hex}" for name in ("attributes", "financials", "clickstream")}
    laid = [lay_by_keys(df, names[name], f"{root}/{name}", KEYS, number) for name, df in tables]
    return _doubles(join_features(*laid))


@query
def snapshot_modes(spark, sf_dir):
    encoded = encode_financials(clean_financials(views.financials(spark, sf_dir)))
    return modes(encoded, ["credit_mix_encoded", "spending_level_encoded", "transaction_value_encoded"], [SNAPSHOT])


@query
def mode_imputed(spark, sf_dir):
    encoded = encode_financials(clean_financials(views.financials(spark, sf_dir)))
    columns = ["credit_mix_encoded", "spending_level_encoded", "transaction_value_encoded"]
    filled = fill_with_modes(encoded, modes(encoded, columns, [SNAPSHOT]), columns, [SNAPSHOT])
    return filled.select(*KEYS, *columns)


@query
def aggregated_features(spark, sf_dir):
    return _doubles(_aggregated(spark, sf_dir))


@query
def gold_feature_store(spark, sf_dir):
    return _doubles(gold_features(_aggregated(spark, sf_dir)))


@query
def gold_feature_store_reachable_flag(spark, sf_dir):
    return _doubles(gold_features(_aggregated(spark, sf_dir), spending_level=2))


@query
def feature_store_run(spark, sf_dir):
    root = _scratch(spark)
    raw = {s: f"{root}/raw/{s}" for s in ("loans", "clickstream", "attributes", "financials")}
    for source, path in raw.items():
        _drop_raw(getattr(views, source)(spark, sf_dir), path)
    return _doubles(run_feature_store(spark, raw, f"{root}/mart", START, END, SEGMENTS))


@query
def feature_store_all_months(spark, sf_dir):
    root = _scratch(spark)
    raw = {s: f"{root}/raw/{s}" for s in stores.SOURCES}
    at_once(*[lambda s=s: _drop_raw(getattr(views, s)(spark, sf_dir), raw[s]) for s in stores.SOURCES])
    return _doubles(run_feature_store(spark, raw, f"{root}/mart", FIRST, LAST, SEGMENTS))


@query
def feature_store_missing_month(spark, sf_dir):
    """Both last layers over all months, of which one is absent from the financials: only that one is left out."""
    mart, dates = stores.Mart(_scratch(spark)), snapshot_dates(FIRST, LAST)
    attributes, financials, clicks = _silver_tables(spark, sf_dir)
    write_snapshots(attributes, mart.silver("attributes"), dates)
    kept = [d for d in dates if d != ABSENT]
    write_snapshots(financials.where(F.col(SNAPSHOT) != F.lit(ABSENT).cast("date")), mart.silver("financials"), kept)
    write_snapshots(clicks, mart.silver("clickstream"), dates)
    aggregated = mart.silver("aggregated")
    built = stores.build_silver_aggregated(spark, mart.silver("clickstream"), mart.silver("attributes"), mart.silver("financials"), aggregated, dates)
    gold = stores.build_gold_features(spark, aggregated, mart.gold("features"), dates)
    if built.skipped != [ABSENT] or gold.skipped != [ABSENT]:
        raise ValueError(f"skipped {built.skipped} and {gold.skipped}")
    return _doubles(read_snapshots(spark, mart.gold("features")))


@query
def one_snapshot_jobs(spark, sf_dir):
    """One month from raw files to gold features, by the jobs of the command line; the month is the jobs' argument."""
    from ..jobs import parser, run

    root = _scratch(spark)
    raw, mart = {s: f"{root}/raw/{s}" for s in stores.SOURCES}, stores.Mart(f"{root}/mart")
    spark.createDataFrame([(v,) for v in SEGMENTS], "value string").write.parquet(f"{mart.silver('attributes')}_occupations")

    def job(name, **options):
        args = [name, "--snapshot-date", ONE_MONTH, *(x for k, v in options.items() for x in (f"--{k}", v))]
        run(spark, parser().parse_args(args))

    for s, path in raw.items():
        _drop_raw(getattr(views, s)(spark, sf_dir), path)
        job("bronze", raw=path, out=mart.bronze(s), source=s)
    job("silver-loans", bronze=mart.bronze("loans"), out=mart.silver("loans"))
    job("gold-labels", silver=mart.silver("loans"), out=mart.gold("labels"))
    job("silver-clickstream", bronze=mart.bronze("clickstream"), loans=mart.silver("loans"), out=mart.silver("clickstream"))
    for s in ("attributes", "financials"):
        job(f"silver-{s}", bronze=mart.bronze(s), out=mart.silver(s))
    job("aggregate", **{s: mart.silver(s) for s in ("clickstream", "attributes", "financials")}, out=mart.silver("aggregated"))
    job("gold-features", aggregated=mart.silver("aggregated"), out=mart.gold("features"))
    labels = read_snapshots(spark, mart.gold("labels"), [ONE_MONTH]).select("loan_id", "label").alias("l")
    features = read_snapshots(spark, mart.gold("features"), [ONE_MONTH])
    counts = features.agg(F.count(F.lit(1)).alias("features"), F.coalesce(F.sum("fe_1"), F.lit(0)).alias("fe_1"))
    return labels.agg(F.count(F.lit(1)).alias("labels"), F.sum("label").alias("bad")).select(
        "labels", "bad", *(counts.select(c).scalar().alias(c) for c in counts.columns)
    )


@query
def null_report_of_builds(spark, sf_dir):
    """The report that the gold build leaves beside its table."""
    root = _scratch(spark)
    write_snapshots(_aggregated(spark, sf_dir), f"{root}/aggregated")
    dates = snapshots_in(spark, f"{root}/aggregated")
    stores.build_gold_features(spark, f"{root}/aggregated", f"{root}/gold", dates)
    return read_snapshots(spark, f"{root}/gold_nulls", dates)


# Reports


@query
def null_report(spark, sf_dir):
    return profile.null_report(clean_financials(views.financials(spark, sf_dir)))


@query
def null_report_by_snapshot(spark, sf_dir):
    return profile.null_report(clean_financials(views.financials(spark, sf_dir)), [SNAPSHOT])


@query
def null_report_gold(spark, sf_dir):
    return profile.null_report(gold_features(_aggregated(spark, sf_dir)), [SNAPSHOT])


@query
def clickstream_snapshot_counts(spark, sf_dir):
    return profile.value_counts(views.clickstream(spark, sf_dir), SNAPSHOT, ascending=True)


@query
def clickstream_snapshot_range(spark, sf_dir):
    return profile.value_range(views.clickstream(spark, sf_dir), [SNAPSHOT])


@query
def clickstream_latest(spark, sf_dir):
    return rename(profile.latest_rows(views.clickstream(spark, sf_dir), SNAPSHOT), {"Customer_ID": "customer_id"})


@query
def attribute_info(spark, sf_dir):
    return column_info(clean_attributes(views.attributes(spark, sf_dir)))


@query
def customer_lookup(spark, sf_dir):
    return rows_equal(clean_attributes(views.attributes(spark, sf_dir)), "customer_id", "7")


@query
def customer_lookup_of_sorted(spark, sf_dir):
    """The same customer in a table that is sorted by customer and has Bloom filters."""
    root = _scratch(spark)
    publish_snapshots(clean_attributes(views.attributes(spark, sf_dir)), root, lookup="customer_id")
    return rows_equal(read_snapshots(spark, root), "customer_id", "7")


@query
def age_range(spark, sf_dir):
    return profile.value_range(_ages(spark, sf_dir), ["age"])


@query
def age_counts(spark, sf_dir):
    return profile.value_counts(_ages(spark, sf_dir), "age")


@query
def occupation_counts(spark, sf_dir):
    return profile.value_counts(rename(views.attributes(spark, sf_dir), {"Occupation": "occupation"}), "occupation")


@query
def invalid_ssn_rows(spark, sf_dir):
    return profile.rows_not_matching(views.attributes(spark, sf_dir), "SSN", SSN_FORMAT)


@query
def invalid_ssn_counts(spark, sf_dir):
    return profile.value_counts(invalid_ssn_rows(spark, sf_dir), "SSN")


def _ages(spark, sf_dir):
    return clean_attributes(views.attributes(spark, sf_dir)).select("customer_id", F.col("age").try_cast("int").alias("age"))


@query
def age_outliers(spark, sf_dir):
    return profile.iqr_outliers(_ages(spark, sf_dir), "age")


@query
def value_outliers(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return profile.iqr_outliers(events, "value")


@query
def age_bins(spark, sf_dir):
    return profile.bin_counts(_ages(spark, sf_dir), "age")


@query
def age_histogram(spark, sf_dir):
    return profile.histogram(_ages(spark, sf_dir), "age")


@query
def age_histogram_25(spark, sf_dir):
    return profile.histogram(_ages(spark, sf_dir), "age", 25)


@query
def price_histogram_auto(spark, sf_dir):
    return profile.histogram(views.table(spark, sf_dir, "orders"), "o_totalprice", "auto")


@query
def age_density(spark, sf_dir):
    points = profile.density(_ages(spark, sf_dir), "age")
    return points.select("point", F.round("x", 6).alias("x"), F.round("density", 9).alias("density"))


@query
def price_density(spark, sf_dir):
    points = profile.density(views.table(spark, sf_dir, "orders"), "o_totalprice")
    return points.select("point", F.round("x", 4).alias("x"), F.round("density", 12).alias("density"))


LOAN_KIND_COLUMNS = [snake_case(k) for k in LOAN_KINDS]
