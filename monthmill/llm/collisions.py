"""Embedding near-duplicates by collision counting over sorted one-dimensional projections.

Vectors are brought to length one and projected on many random directions. On each direction they are sorted, and a window
around a vector's own place holds those it collides with; pairs that collide on enough directions are verified by their
cosine. The count is calibrated: it is the largest that the wanted share of pairs right at the threshold reaches, found by
simulating such pairs. As directions are a random rotation, the share holds for any data, and closer pairs do better.

Shards. A window of one direction holds a fixed share of all rows, so collisions are only counted within shards. A vector
lies at its nearest poles (the ends of the axes of another random rotation), and pairs meet where they share one; how many
poles it takes is calibrated on the same simulated pairs. Each level multiplies the number of shards, and there are as many
levels as keep shards small, so that work grows little faster than the rows. A shard above `shard_rows` is cut into parts
and each pair of parts is a task's group. A pair that shares several shards counts in the first of them only.

Equal vectors are one class from the start. A group gives sums per vector and a star per component, never its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import staged
from monthmill.llm.simhash import components

#: Simulated pairs, and levels of shards at most.
PAIRS, LEVELS = 4000, 4


@dataclass(frozen=True)
class Plan:
    """What vectors of one length need; every task works it out for itself, alike."""

    rotations: tuple[np.ndarray, ...]
    poles: int
    directions: np.ndarray
    reach: float
    least: int

    def nearest_poles(self, unit: np.ndarray) -> np.ndarray:
        """Per row and level the numbers of its nearest poles, sorted: (rows, levels, poles)."""
        found = []
        for turn in self.rotations:
            along = unit @ turn
            ends = np.hstack([along, -along])
            found.append(np.sort(np.argsort(-ends, axis=1, kind="stable")[:, : self.poles], axis=1))
        return np.stack(found, axis=1) if found else np.zeros((len(unit), 0, self.poles), int)


def _rotation(rng: np.random.Generator, dim: int) -> np.ndarray:
    return np.linalg.qr(rng.normal(size=(dim, dim)))[0]


def _pairs_at(rng: np.random.Generator, dim: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors with exactly that cosine; in one dimension equal ones."""
    x, u = rng.normal(size=(2, PAIRS, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dim == 1:
        return x, x
    u -= (u * x).sum(1, keepdims=True) * x
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    return x, cosine * x + np.sqrt(1 - cosine * cosine) * u


@lru_cache(maxsize=8)
def plan(dim: int, rows: int, threshold: float, recall: float, directions: int, window: float, shard_rows: int, seed: int) -> Plan:
    """`window` is the share of threshold pairs that collide on one direction; half of the lost recall goes to each step."""
    rng = np.random.default_rng([seed, dim])
    x, y = _pairs_at(rng, dim, threshold)
    turns = np.hstack([_rotation(rng, dim) for _ in range(-(-directions // dim))])[:, :directions]
    apart = np.abs((x - y) @ turns)
    reach = float(np.quantile(apart, window)) if dim > 1 else 1.0
    each = 1 - (1 - recall) / 2
    hits = (apart <= reach).sum(1)
    least = max(n for n in range(directions + 1) if (hits >= n).mean() >= each)

    rotations = [_rotation(rng, dim) for _ in range(LEVELS)]
    near = []
    for turn in rotations:
        place = [np.argsort(np.argsort(-np.hstack([v @ turn, -(v @ turn)]), axis=1), axis=1) for v in (x, y)]
        near.append(np.maximum(*place).min(1))  # with so many poles and one more the pair meets
    for levels in range(LEVELS + 1):
        met = np.max(near[:levels], axis=0) if levels else np.zeros(PAIRS, int)
        poles = next(n for n in range(1, 2 * dim + 1) if (met < n).mean() >= each)
        if levels == LEVELS or poles * 2 > dim or rows * (poles / (2 * dim)) ** levels <= shard_rows:
            break
    return Plan(tuple(rotations[:levels]), poles, turns, reach, least)


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, without overflow on the way."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def candidates(a: np.ndarray, b: np.ndarray, reach: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the pairs of rows of `a` and `b` (projections) that lie within reach on at least so many directions."""
    hits = np.zeros(len(a) * len(b), np.uint16)
    for d in range(a.shape[1]):
        order = np.argsort(b[:, d], kind="stable")
        line = b[order, d]
        low, high = np.searchsorted(line, a[:, d] - reach), np.searchsorted(line, a[:, d] + reach, "right")
        sizes = high - low
        begins = np.cumsum(sizes) - sizes
        # Each query's window, one after another: no pair comes twice for one direction.
        at = np.arange(sizes.sum()) + np.repeat(low - begins, sizes)
        hits[np.repeat(np.arange(len(a)) * len(b), sizes) + order[at]] += 1
    return np.divmod(np.flatnonzero(hits >= least), len(b))


def _joined(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`roots` with the components of each pair joined under their smallest member."""
    while True:
        x, y = roots[a], roots[b]
        if (x == y).all():
            return roots
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while (roots[roots] != roots).any():
            roots = roots[roots]


def group_links(rows: pd.DataFrame, of: Plan, threshold: float, block: int = 512) -> pd.DataFrame:
    """cls, links and root of the vectors of one group (part i against part j of a shard) that have a link in it."""
    # In the order of cls a component's root is its smallest class.
    rows = rows.sort_values("cls", ignore_index=True)
    unit, cls, copies = np.stack(rows["unit"].to_numpy()), rows["cls"].to_numpy(), rows["copies"].to_numpy()
    poles = np.stack(rows["poles"].to_numpy()).reshape(len(rows), len(of.rotations), of.poles)
    cell, i, j = (int(rows[c].iloc[0]) for c in ("cell", "i", "j"))
    here = [cell // (2 * unit.shape[1]) ** level % (2 * unit.shape[1]) for level in range(len(of.rotations))]
    part = rows["part"].to_numpy()
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    line = unit @ of.directions
    links, roots = np.zeros(len(rows), np.int64), np.arange(len(rows))
    for begin in range(0, len(left), block):
        some = left[begin : begin + block]
        a, b = candidates(line[some], line[right], of.reach, of.least)
        a, b = some[a], right[b]
        if i == j:
            a, b = a[a < b], b[a < b]
        for cut in range(0, len(a), 1 << 16):
            x, y = a[cut : cut + (1 << 16)], b[cut : cut + (1 << 16)]
            near = (unit[x] * unit[y]).sum(1) >= threshold
            x, y = x[near], y[near]
            roots = _joined(roots, x, y)
            own = np.ones(len(x), bool)
            for level, pole in enumerate(here):
                p, q = poles[x, level], poles[y, level]
                shared = np.where((p[:, :, None] == q[:, None, :]).any(2), p, 2 * unit.shape[1])
                own &= shared.min(1) == pole
            np.add.at(links, x[own], copies[y[own]])
            np.add.at(links, y[own], copies[x[own]])
    linked = np.zeros(len(rows), bool)
    moved = np.flatnonzero(roots != np.arange(len(rows)))
    linked[moved] = linked[roots[moved]] = True
    return pd.DataFrame({"cls": cls[linked], "links": links[linked], "root": cls[roots[linked]]})


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.9,
    recall: float = 0.99,
    directions: int = 16,
    window: float = 0.85,
    shard_rows: int = 2048,
    seed: int = 13,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row: links join rows whose cosine is at least `threshold`.

    n_links counts the other rows linked to a row, component_id is the smallest vec_id that links reach, itself included, and
    kept says whether that is the row's own. Every link given is verified in double precision; of pairs right at the threshold
    the share `recall` is found, of closer ones more, of equal vectors all. Vectors that are null, empty, zero, or hold null or
    non-finite numbers link with nothing, and vectors of different lengths do not link. Rows that share a vec_id are rows of
    their own. A NULL vec_id takes part, but names a component only where no other can (component_id NULL, and kept, as both
    are NULL). Other columns are ignored.
    """
    v = F.col("embedding").cast("array<double>")
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # Equal vectors have one digest, of all their digits.
    digest = F.sha2(F.array_join(F.col("v").cast("array<string>"), ","), 256)
    rows = given.where(usable).select("vec_id", "v", digest.alias("digest"))
    classes = rows.groupBy("digest").agg(F.first("v").alias("v"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    classes = staged(classes.withColumn("cls", F.monotonically_increasing_id()), "vectors")
    n = classes.count()

    def fitted(dim: int) -> Plan:
        return plan(dim, n, threshold, recall, directions, window, shard_rows, seed)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, some in batch.groupby(batch["v"].map(len)):
                of, unit = fitted(dim), unit_vectors(np.stack(some["v"].to_numpy()))
                poles = of.nearest_poles(unit)
                base = [(2 * dim) ** level for level in range(len(of.rotations))]
                cells = [[sum(p * b for p, b in zip(chosen, base, strict=True)) for chosen in product(*row.tolist())] for row in poles]
                yield pd.DataFrame({"cls": some["cls"], "copies": some["copies"], "dim": dim, "unit": list(unit), "poles": list(poles.reshape(len(some), -1)), "cells": cells})

    schema = "cls long, copies long, dim int, unit array<double>, poles array<int>, cells array<long>"
    placed_rows = staged(classes.select("cls", "copies", "v").mapInPandas(placed, schema), "cells")
    shard = ["dim", "cell"]
    met = placed_rows.select("cls", "dim", F.explode("cells").alias("cell"))
    sizes = met.groupBy(*shard).count().where("count > 1").select(*shard, F.ceil(F.col("count") / shard_rows).cast("int").alias("parts"))
    members = placed_rows.select("*", F.explode("cells").alias("cell")).drop("cells").join(sizes, shard)
    members = members.withColumn("part", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda other: F.struct(F.least("part", other).alias("i"), F.greatest("part", other).alias("j")))
    grouped = members.select("*", F.explode(pairs).alias("p")).select("*", "p.i", "p.j").drop("p", "parts")

    def linked(group: pd.DataFrame) -> pd.DataFrame:
        return group_links(group, fitted(int(group["dim"].iloc[0])), threshold)

    found = staged(grouped.groupBy(*shard, "i", "j").applyInPandas(linked, "cls long, links long, root long"), "links")
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    edges = found.where("cls <> root").select(F.col("cls").alias("u"), F.col("root").alias("v"))
    named = classes.select("digest", "cls", "copies", "least").join(counts, "cls", "left")
    tops = components(edges).withColumnRenamed("u", "cls")
    named = named.join(tops, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    named = named.select("digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    alone = given.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = rows.select("vec_id", "digest").join(named, "digest").drop("digest").unionByName(alone)
    return out.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
