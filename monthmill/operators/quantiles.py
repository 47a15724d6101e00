"""Exact quantiles of many columns per group, without a large final task.

``percentile`` keeps every distinct value of a group in one task, and
``percentile_approx`` merges one sketch per input task in it. With a third
of a large table in one snapshot either is the whole job's bottleneck. Here
the wanted rank is found by counting. The first pass counts values in narrow
buckets on a logarithmic scale and picks the bucket that holds the rank; each
further pass cuts the picked range into a million slots. Every pass is a map-side
combined count, a group never has more buckets than the scale has, and equal
values collapse before the shuffle. For 4-byte floats two passes are exact,
for int three, for double and bigint four, for decimals as many as their digits need.
Values keep their own type: only the choice of a bucket or slot goes through
double, which never reverses an order. The picked ranges come as one row per group and meet the
rows before these are taken apart by column, so a pass shuffles narrow rows at most
once, and the optimizer broadcasts the ranges if they are small.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS_PER_OCTAVE = 16
SLOTS = 1 << 20
# Passes after which a slot is narrower than the gap between two values of the type.
PASSES = {"float": 2, "tinyint": 2, "smallint": 2, "int": 3}
EXACT_IN_DOUBLE = {"float", "double", "tinyint", "smallint", "int"}

LOWER, UPPER, DISCRETE = 0, 1, 2
ONE_GROUP = "_all"


def quantiles(
    df: DataFrame,
    wanted: dict[str, dict[str, float]],
    by: list[str] | None = None,
    linear: bool = False,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
) -> DataFrame:
    """One row per group with a column ``<column>_<name>`` per wanted quantile.

    ``wanted`` maps a column to ``{name: p}``. The discrete form returns the
    value at rank ``ceil(p * n)``; ``linear`` interpolates between the values
    next to ``p * (n - 1)``. NULLs are ignored and NaN ranks highest. ``keep`` may write the picked ranges, one row per group,
    and read them back, so that the optimizer knows their size before it plans the pass over the rows: they are broadcast if
    they are small, where an estimate from the rows would have it shuffle these.
    """
    by = by or []
    types = dict(df.select(*wanted).dtypes)
    # Columns whose values double holds exactly are counted in one scan; each other type is counted as it is.
    families: dict[str, dict[str, dict[str, float]]] = {}
    for c, named in wanted.items():
        families.setdefault("double" if types[c] in EXACT_IN_DOUBLE else types[c], {})[c] = named
    keys = by or [ONE_GROUP]
    rows = df if by else df.withColumn(ONE_GROUP, F.lit(0))
    found = [
        _of_one_type(rows, family, named, keys, linear, types, lambda df, name, i=i: keep(df, f"ranges_{i}_{name}"))
        for i, (family, named) in enumerate(families.items())
    ]
    out = found[0]
    for i, more in enumerate(found[1:]):
        more = more.withColumnsRenamed({k: f"_{i}_{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_{i}_{k}")) for k in keys]
        out = out.join(more, same, "full").withColumns({k: F.coalesce(k, f"_{i}_{k}") for k in keys})
    return out.select(*by, *(f"{c}_{name}" for c, named in wanted.items() for name in named))


def _passes(kind: str) -> int:
    if kind.startswith("decimal"):
        digits = int(kind[len("decimal(") :].split(",")[0])
        return 1 + ceil((digits * 3.33 - 4) / 20)
    return PASSES.get(kind, 4)


def _of_one_type(df: DataFrame, family: str, wanted, by: list[str], linear: bool, types: dict[str, str], keep) -> DataFrame:
    values = df.select(*by, F.expr(_arrays(f"cast(`{c}` as {family})" for c in wanted)).alias("_values"))
    long = values.select(*by, F.posexplode("_values").alias("column", "value")).where(F.col("value").isNotNull())
    picked = _first_pick(long, wanted, by, linear)
    for i in range(max(_passes(types[c]) for c in wanted) - 1):
        picked = _narrow(values, picked, by, lambda df, i=i: keep(df, str(i)))
    return _wide(picked, wanted, by, linear, types)


def _bucket(v: Column) -> Column:
    """A number that never falls as ``v`` rises, at most 70,000 of them."""
    v = v.cast("double")
    magnitude = (F.floor(F.log2(F.abs(v)) * STEPS_PER_OCTAVE) + 20_000).cast("int")
    return (
        F.when(F.isnan(v), 2_000_000)
        .when(v == 0, 0)
        .when(v == float("inf"), 1_000_000)
        .when(v == float("-inf"), -1_000_000)
        .when(v > 0, magnitude)
        .otherwise(-magnitude)
    )


def _slot(v: Column, low: Column, high: Column) -> Column:
    # The difference of two bigints of one bucket fits, as they share their sign.
    share = F.try_divide((v - low).cast("double"), (high - low).cast("double"))
    return F.when(low == high, 0).otherwise(F.least(F.floor(share * SLOTS).cast("int"), F.lit(SLOTS - 1)))


def _counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys, "slot").agg(
        F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
    )


def _target(name: str, p: float, end: int) -> str:
    return f"named_struct('name', '{name}', 'p', {float(p)}D, 'end', {end})"


def _arrays(items) -> str:
    return f"array({', '.join(items)})"


def _first_pick(long: DataFrame, wanted, by: list[str], linear: bool) -> DataFrame:
    keys = [*by, "column"]
    group = Window.partitionBy(*keys)
    so_far = group.orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (
        _counts(long.withColumn("slot", _bucket(F.col("value"))), keys)
        .withColumn("upto", F.sum("rows").over(so_far))
        .withColumn("total", F.sum("rows").over(group))
    )
    ends = [LOWER, UPPER] if linear else [DISCRETE]
    targets = F.expr(_arrays(_arrays(_target(n, p, e) for n, p in named.items() for e in ends) for named in wanted.values()))
    place = F.col("t.p") * (F.col("total") - 1)
    rank = (
        F.when(F.col("t.end") == LOWER, F.floor(place) + 1)
        .when(F.col("t.end") == UPPER, F.ceil(place) + 1)
        .otherwise(F.greatest(F.ceil(F.col("t.p") * F.col("total")), F.lit(1)))
    )
    return (
        counts.withColumn("t", F.explode(F.get(targets, F.col("column"))))
        .withColumn("rank", rank)
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("rows")))
        .select(
            *keys,
            F.col("t.name").alias("name"),
            F.col("t.end").alias("end"),
            (place - F.floor(place)).alias("share"),
            (F.col("rank") - F.col("upto") + F.col("rows")).alias("rank"),
            "low",
            "high",
        )
    )


def _narrow(values: DataFrame, picked: DataFrame, by: list[str], keep) -> DataFrame:
    """Find each rank again within its picked range, now cut into slots."""
    keys = [*by, "column", "name", "end", "share", "rank"]
    so_far = (
        Window.partitionBy(*keys).orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # As many ranges per group as there are wanted quantiles.
    pick = F.struct("column", "name", "end", "share", "rank", F.col("low").alias("from"), F.col("high").alias("to"))
    ranges = picked.groupBy(*[F.col(b).alias(f"_{b}") for b in by]).agg(F.collect_list(pick).alias("_picks"))
    ranges = keep(ranges)
    if by == [ONE_GROUP]:  # a single row
        ranges = F.broadcast(ranges)
    joined = values.join(ranges, [F.col(b).eqNullSafe(F.col(f"_{b}")) for b in by])
    value = F.get("_values", F.col("p.column"))
    inside = (
        joined.select(*by, "_values", F.explode("_picks").alias("p"))
        .select(*by, "p.*", value.alias("value"))
        .where(F.col("value").between(F.col("from"), F.col("to")))
        .withColumn("slot", _slot(F.col("value"), F.col("from"), F.col("to")))
    )
    return (
        _counts(inside, keys)
        .withColumn("upto", F.sum("rows").over(so_far))
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("rows")))
        .withColumn("rank", F.col("rank") - F.col("upto") + F.col("rows"))
        .drop("slot", "rows", "upto")
    )


def _wide(picked: DataFrame, wanted, by: list[str], linear: bool, types: dict[str, str]) -> DataFrame:
    def pick(i, name, end, what="low"):
        return f"max(case when column = {i} and name = '{name}' and end = {end} then {what} end)"

    out = []
    for i, (c, named) in enumerate(wanted.items()):
        for name in named:
            if linear:
                low, high, share = pick(i, name, LOWER), pick(i, name, UPPER), pick(i, name, LOWER, "share")
                value = f"cast({low} as double) + (cast({high} as double) - cast({low} as double)) * {share}"
            else:
                value = f"cast({pick(i, name, DISCRETE)} as {types[c]})"
            out.append(F.expr(f"{value} as `{c}_{name}`"))
    return picked.groupBy(*by).agg(*out)
