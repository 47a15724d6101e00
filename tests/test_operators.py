"""Statistics, joins, encodings and reports against brute force on small tables."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from monthmill.operators import profile
from monthmill.operators.encode import multi_hot, one_hot, vocabulary
from monthmill.operators.joins import join_all
from monthmill.operators.modes import fill_with_modes, modes
from monthmill.operators.quantiles import quantiles
from monthmill.operators.shape import column_info, drop_columns, enforce, rename


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Quantiles

NASTY = [0.0, -0.0, 1e-45, -1e-45, 3.4e38, -3.4e38, float("inf"), float("-inf"), float("nan"), 1.0, 1.0, 1.0000001]


def disc(sorted_values, p):
    return sorted_values[max(math.ceil(p * len(sorted_values)), 1) - 1]


def order(v):
    return (v != v, v)


@pytest.mark.parametrize("kind", ["float", "double", "int"])
def test_discrete_quantiles_are_exact(spark, kind):
    rng = random.Random(7)
    data = []
    for group in range(4):
        for i in range(700):
            if kind == "int":
                v = rng.choice([rng.randint(-(2**31), 2**31 - 1), rng.randint(-5, 5)])
            else:
                v = rng.choice([rng.gauss(0, 1), rng.gauss(1e6, 1), rng.choice(NASTY), rng.expovariate(1) * 1e-3])
                v = float(np.float32(v)) if kind == "float" else v
            data.append((group, None if i % 50 == 0 else v))
    data += [(9, None)]
    df = spark.createDataFrame(data, f"g int, v {kind}")
    wanted = {f"p{i}": p for i, p in enumerate([0.0, 0.001, 0.25, 0.5, 0.9, 0.999, 1.0])}
    got = {r["g"]: r for r in quantiles(df, {"v": wanted}, ["g"]).collect()}
    assert set(got) == {0, 1, 2, 3}
    for group, row in got.items():
        ranked = sorted((v for g, v in data if g == group and v is not None), key=order)
        for name, p in wanted.items():
            assert order(row[f"v_{name}"]) == order(disc(ranked, p)) or (row[f"v_{name}"] != row[f"v_{name}"])


def test_quantiles_keep_bigints_and_decimals_whole(spark):
    from decimal import Decimal

    data = [(g, 2**60 + 2 * i + 1, Decimal(f"{10**15 + i}.0000000{i % 10}01"), float(i)) for g in (None, 1) for i in range(101)]
    df = spark.createDataFrame(data, "g int, b bigint, d decimal(30,10), x float")
    wanted = {c: {"low": 0.01, "median": 0.5, "top": 1.0} for c in ("b", "d", "x")}
    got = {r["g"]: r for r in quantiles(df, wanted, ["g"]).collect()}
    for i, name in ((1, "low"), (50, "median"), (100, "top")):
        for g in (None, 1):
            assert (got[g][f"b_{name}"], got[g][f"d_{name}"], got[g][f"x_{name}"]) == data[i][1:], (g, name)
    assert dict(quantiles(df, wanted).dtypes)["d_median"] == "decimal(30,10)"
    assert quantiles(df, wanted).first()["b_median"] == 2**60 + 101
    signs = spark.createDataFrame([(v,) for v in (-(2**63), -1, 0, 2**63 - 1)], "v bigint")
    assert tuple(quantiles(signs, {"v": {f"q{i}": i / 4 for i in (1, 2, 3, 4)}}).first()) == (-(2**63), -1, 0, 2**63 - 1)


def test_linear_quantiles_match_numpy(spark):
    rng = random.Random(3)
    data = [rng.gauss(50, 20) for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    row = quantiles(df, {"v": {"q1": 0.25, "q3": 0.75}}, linear=True).first()
    assert np.allclose([row[0], row[1]], np.percentile(data, [25, 75]), rtol=1e-14)


def test_first_rows_are_always_the_same(spark):
    df = spark.createDataFrame([(2, "x"), (1, "b"), (1, "a"), (3, None)], "k int, v string")
    assert [tuple(r) for r in profile.first_rows(df, 2, ["k"]).collect()] == [(1, "a"), (1, "b")]


def test_quantiles_with_most_rows_in_one_group_and_value(spark):
    df = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(99).alias("g"),
        F.when(F.col("id") % 2 == 0, 5.0).otherwise(F.col("id").cast("double")).cast("float").alias("v"),
    )
    got = {r[0]: (r[1], r[2]) for r in quantiles(df, {"v": {"median": 0.5, "cap": 0.999}}, ["g"]).collect()}
    ref = {
        r[0]: (r[1], r[2])
        for r in df.groupBy("g").agg(
            F.expr("percentile_disc(0.5) within group (order by v)"),
            F.expr("percentile_disc(0.999) within group (order by v)"),
        ).collect()
    }
    assert got == ref


# Modes


def test_mode_counts_null_and_breaks_ties_by_least_value(spark):
    data = [("a", 3, 1), ("a", 3, 1), ("a", 1, None), ("a", 1, None), ("a", None, None),
            ("b", None, None), ("b", None, 2), ("b", 2, 2), ("c", None, None)]
    df = spark.createDataFrame(data, "g string, x int, y int")
    table = modes(df, ["x", "y"], ["g"])
    assert rows(table) == [("a", 1, None), ("b", None, 2), ("c", None, None)]
    filled = fill_with_modes(df, table, ["x", "y"], ["g"])
    assert rows(filled.where("g = 'b'")) == [("b", 2, 2), ("b", None, 2), ("b", None, 2)]
    assert filled.columns == df.columns and filled.count() == df.count()


# Joins


def no_jobs(spark, build):
    """What ``build`` returns, and that it started no Spark job."""
    spark.sparkContext.setJobGroup("plan", "plan building")
    built = build()
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return built


def test_join_all_is_the_inner_join_of_all_sides(spark):
    left = spark.range(60).select((F.col("id") % 7).alias("k"), F.col("id").alias("l"))
    middle = spark.range(9).select((F.col("id") % 3).alias("k"), F.col("id").alias("m"))
    right = spark.createDataFrame([(0, 1), (1, 2), (None, 3)], "k long, r long")
    joined = no_jobs(spark, lambda: join_all([left, middle, right], ["k"]))
    assert joined.columns == ["k", "l", "m", "r"]
    assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, left.join(middle, "k").join(right, "k").collect()))


def test_a_key_with_half_of_the_rows_on_both_sides_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    }
    before = {k: spark.conf.get(k) for k in settings}

    def side(n, name):
        key = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
        return spark.range(0, n, 1, 16).select(key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias(name))

    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        joined = join_all([side(6000, "a"), side(600, "b")], ["k"])
        n = joined.select(F.count(F.lit(1)).alias("n"), F.bit_xor(F.hash("a", "b")))
        assert n.collect()[0][0] == 3000 * 300 + 300
        assert "SortMergeJoin(skew=true)" in n._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


# Encodings and shape


def test_one_hot_merges_rows_equal_but_for_the_value(spark):
    df = spark.createDataFrame([("a", "X"), ("a", "Y"), ("b", None), ("c", "Z")], "id string, o string")
    assert vocabulary(df, "o") == ["X", "Y", "Z"]
    assert rows(one_hot(df, "o", ["X", "Y"], "o_")) == [("a", 1, 1), ("b", 0, 0), ("c", 0, 0)]
    many = spark.range(1500).select(F.col("id").cast("string").alias("o"))
    assert len(vocabulary(many, "o")) == 1500


def test_one_hot_joins_values_that_differ_in_case(spark):
    df = spark.createDataFrame([("a", "Cook"), ("b", "cook"), ("b", "COOK"), ("c", None)], "id string, o string")
    got = one_hot(df, "o", vocabulary(df, "o"), "o_")
    assert got.columns == ["id", "o_cook"] and rows(got) == [("a", 1), ("b", 1), ("c", 0)]


def test_multi_hot(spark):
    data = [("a", "Auto Loan, and Home Loan"), ("b", "Auto Loan, Auto Loan"), ("c", "Other"), ("d", "Home Loan"), ("d", "Auto Loan")]
    df = spark.createDataFrame(data, "id string, t string")
    got = multi_hot(df, "t", ["Auto Loan", "Home Loan"])
    assert got.columns == ["id", "auto_loan", "home_loan"]
    assert rows(got) == [("a", 1, 0), ("b", 1, 0), ("c", 0, 0), ("d", 1, 1)]


def test_shape(spark, ansi):
    df = spark.createDataFrame([("1", "x", "keep")], "A string, b string, c string")
    renamed = rename(df, {"A": "a", "absent": "z"})
    assert renamed.columns == ["a", "b", "c"]
    assert enforce(renamed, {"b": "int", "a": "int", "z": "int"}).collect()[0][:] == (1, None, "keep")
    strict = enforce(renamed, {"b": "int", "z": "int", "a": "int"}, strict=True)
    assert strict.dtypes == [("b", "int"), ("a", "int")]
    assert drop_columns(df, ["a", "b"]).columns == ["A", "c"]
    assert rows(column_info(strict)) == [(0, "b", "int", 0), (1, "a", "int", 1)]


# Reports


def test_null_report(spark):
    df = spark.createDataFrame([("m", 1, None), ("m", None, None), ("n", 1, 2)], "s string, x int, y int")
    assert rows(profile.null_report(df, ["s"])) == [("m", "x", 1, 50.0), ("m", "y", 2, 100.0)]
    assert rows(profile.null_report(df.where("s = 'n'"))) == []
    assert rows(profile.null_report(df.where("s = 'q'"))) == []


def test_value_counts_leave_null_out(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "v int")
    assert [tuple(r) for r in profile.value_counts(df, "v").collect()] == [(2, 2), (1, 1)]
    assert [tuple(r) for r in profile.value_counts(df, "v", ascending=True).collect()] == [(1, 1), (2, 2)]
    assert rows(profile.value_range(df, ["v"])) == [(1, 2)]
    assert rows(profile.latest_rows(df, "v")) == [(2,), (2,)]
    assert rows(profile.rows_not_matching(df, "v", "^1$")) == [(2,), (2,), (None,)]


def test_a_value_on_the_bound_is_no_outlier(spark):
    data = [0, 1, 2, 3, 4, 7, 8]
    q1, q3 = np.percentile(data, [25, 75])
    k = (data[-1] - q3) / (q3 - q1)
    df = spark.createDataFrame([(v,) for v in data], "v int")
    assert rows(profile.iqr_outliers(df, "v", float(k))) == []
    assert rows(profile.iqr_outliers(df, "v", float(k) - 0.01)) == [(8,)]


def test_bins(spark):
    df = spark.createDataFrame([(0,), (9,), (10,), (119,), (120,), (-1,), (None,)], "v int")
    got = {r["bin"]: r["row_count"] for r in profile.bin_counts(df, "v").collect()}
    assert list(got)[:2] == ["0-9", "10-19"] and list(got)[-1] == "Others"
    assert (got["0-9"], got["10-19"], got["20-29"], got["110-119"], got["Others"]) == (2, 1, 0, 1, 3)
    empty = profile.bin_counts(df.where("v > 1000"), "v").collect()
    assert len(empty) == 13 and not any(r["row_count"] for r in empty)


@pytest.mark.parametrize("bins", [10, 25, "auto"])
def test_histogram_matches_numpy(spark, bins):
    rng = random.Random(5)
    data = [rng.gauss(0, 1) for _ in range(500)]
    counts, edges = np.histogram(data, bins=bins)
    got = profile.histogram(spark.createDataFrame([(v,) for v in data], "v double"), "v", bins).collect()
    assert [r["row_count"] for r in got] == counts.tolist()
    assert np.allclose([r["bin_low"] for r in got], edges[:-1])


def test_histogram_of_one_value_and_of_none(spark):
    got = profile.histogram(spark.createDataFrame([(3,), (3,)], "v int"), "v").collect()
    assert [r["row_count"] for r in got] == [0, 0, 0, 0, 0, 2, 0, 0, 0, 0]
    assert profile.histogram(spark.createDataFrame([], "v int"), "v").collect() == []


def test_density_matches_the_definition(spark):
    data = [1.0, 2.0, 2.0, 5.0, 9.0]
    got = profile.density(spark.createDataFrame([(v,) for v in data], "v double"), "v", points=20).collect()
    h = np.std(data, ddof=1) * len(data) ** -0.2
    x = np.linspace(1, 9, 20)
    want = np.exp(-(((x[:, None] - np.array(data)) / h) ** 2) / 2).sum(1) / (len(data) * h * math.sqrt(2 * math.pi))
    assert np.allclose([r["x"] for r in got], x) and np.allclose([r["density"] for r in got], want)


def test_buckets_of_the_same_keys_join_without_a_shuffle(spark, tmp_path):
    from monthmill.operators.joins import join_all, lay_by_keys

    sides = [spark.range(2000).selectExpr("id % 500 as k", "id % 3 as m", f"id as v{i}") for i in range(3)]
    laid = [lay_by_keys(df, f"laid_{i}", str(tmp_path / f"t{i}"), ["k", "m"], 4) for i, df in enumerate(sides)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_all(laid, ["k", "m"])
        counted = joined.groupBy("k", "m").count()
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SelectedBucketsCount: 4 out of 4" in plan
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, join_all(sides, ["k", "m"]).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for i in range(3):
            spark.sql(f"drop table laid_{i}")


def test_sketches_stay_within_their_error(spark):
    from monthmill.operators.sketches import merge_sketches, quantile_sketches, rank_error, sketch_quantiles

    # Values are their own ranks, so a value's distance from the wanted rank can be read off.
    n = 200_000
    rows = spark.range(n).selectExpr("id % 24 as month", "cast((id * 7919) % 200000 as double) as v", "cast(null as double) as w")
    odd = spark.createDataFrame([(0, float("nan"), None), (1, None, None)], "month long, v double, w double")
    by_month = quantile_sketches(rows.unionByName(odd), ["v", "w"], ["month"], 1024).cache()
    wanted = {"v": {f"q{i}": i / 100 for i in (0, 1, 50, 99, 100)}, "w": {"q": 0.5}}
    got = sketch_quantiles(merge_sketches(by_month, ["v", "w"], [], 1024), wanted, []).first()
    assert got["v_n"] == n and got["w_n"] == 0 and got["w_q"] is None
    for i in (0, 1, 50, 99, 100):
        assert abs(got[f"v_q{i}"] / n - i / 100) <= 3 * rank_error(1024)
    assert max(len(r["v_sketch"]) for r in by_month.collect()) < 64 * 1024


def test_density_of_few_and_far_values(spark):
    import math

    from monthmill.operators.profile import density

    values = [-500.0, 0.0, 1.0, 1.0, 2.5, 8678.0, 17.25]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double")
    mean = sum(values) / 7
    h = math.sqrt(sum((v - mean) ** 2 for v in values) / 6) * 7**-0.2
    got = density(df, "v", 50, cut=2.0).collect()
    assert len(got) == 50 and abs(got[0]["x"] - (-500 - 2 * h)) < 1e-6
    for r in got:
        want = sum(math.exp(-(((r["x"] - v) / h) ** 2) / 2) for v in values) / (7 * h * math.sqrt(2 * math.pi))
        assert abs(r["density"] - want) <= 1e-10 * max(want, 1e-6)
    assert density(df.where("v = 1"), "v").collect() == [] and density(df.where("false"), "v").collect() == []


def test_a_vocabulary_too_large_is_refused(spark):
    from monthmill.operators.encode import vocabulary

    df = spark.range(50).selectExpr("cast(id % 20 as string) as v")
    assert len(vocabulary(df, "v", 20)) == 20
    with pytest.raises(ValueError, match="v has more than 19 values"):
        vocabulary(df, "v", 19)
