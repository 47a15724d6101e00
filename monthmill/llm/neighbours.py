"""Approximate nearest neighbours by inner product: inverted lists, scanned by dimension blocks with early abandoning.

Every vector gets one more number that makes all of one length, so that the largest inner product is the smallest
distance. Vectors are turned by a random rotation; then a distance over the first d dimensions, scaled up, estimates the
whole one, and a candidate whose estimate exceeds the query's bound by more than chance allows is given up.

Fit. Centroids come from a sample of at most `sample` rows (those whose ids hash smallest), and so does the number of lists
to probe: the fewest that hold the wanted share of the sample's own neighbours. Its first `seeds` rows give each query its
first finds and their bound. All rows are indexed. Lists are cut into blocks and their queries into parts, and each pair of block and part is a
task's group, so a list that holds a third of all rows is no larger a group than others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.common import staged


@dataclass
class Index:
    """What the driver fits and every task needs; its size is bounded by the sample."""

    top: float
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    seed_ids: np.ndarray
    seeds: np.ndarray

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        """Candidates: scaled to at most length one, lengthened to one, and rotated."""
        scaled = vectors / self.top
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(1)))
        return np.hstack([scaled, rest[:, None]]) @ self.rotation

    def turned_queries(self, vectors: np.ndarray) -> np.ndarray:
        """Queries: of length one, which keeps the order of their inner products, and rotated."""
        unit = vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))
        return np.hstack([unit, np.zeros((len(unit), 1))]) @ self.rotation

    def nearest_lists(self, turned: np.ndarray) -> np.ndarray:
        """Per row the numbers of all lists, nearest first."""
        return np.argsort(-(2 * turned @ self.centroids.T - (self.centroids**2).sum(1)), axis=1, kind="stable")

    def first_found(self, ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest seeds of each query but itself, as numbers of seeds, and the squared distance to the last.

        With too few seeds there are none, and the distance is infinite.
        """
        if len(self.seeds) <= k:
            return np.zeros((len(ids), 0), int), np.full(len(ids), np.inf)
        turned, seeds = self.turned_queries(queries), self.turned(self.seeds)
        near, bound = np.empty((len(ids), k), int), np.empty(len(ids))
        for a in range(0, len(ids), 256):
            some = slice(a, a + 256)
            distance = np.maximum(0, 2 - 2 * turned[some] @ seeds.T)
            distance[ids[some, None] == self.seed_ids] = np.inf
            near[some] = np.argpartition(distance, k - 1, axis=1)[:, :k]
            bound[some] = np.take_along_axis(distance, near[some], axis=1).max(1)
        return near, bound


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding as doubles, one row per id: none that is null, zero, or holds null or non-finite numbers.

    Of several vectors of one id the smallest counts. Rows without an id, and vectors of another length than most have,
    take no part.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def fit(rows: DataFrame, k: int, recall: float, list_rows: int, max_lists: int, sample: int, seeds: int, seed: int = 7) -> Index | None:
    """An index over `rows`, or None if there are none."""
    count, top = rows.agg(F.count("*"), F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)))).first()
    if not count:
        return None
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
    vectors, rng = np.stack(got["embedding"].to_numpy()), np.random.default_rng(seed)
    rotation = np.linalg.qr(rng.normal(size=(vectors.shape[1] + 1,) * 2))[0]
    index = Index(float(top), rotation, np.zeros((0, 0)), 1, got["vec_id"].to_numpy(np.int64)[:seeds], vectors[:seeds])
    turned = index.turned(vectors)
    lists = max(1, min(max_lists, len(turned) // 16, -(-count // list_rows)))
    centroids = turned[rng.choice(len(turned), lists, replace=False)]
    for _ in range(12):
        of = (2 * turned @ centroids.T - (centroids**2).sum(1)).argmax(1)
        sizes = np.bincount(of, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, of, turned)
        # An empty list moves to a row of the sample, so that no list is wasted.
        fresh = turned[rng.choice(len(turned), lists)]
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], fresh)
    index.centroids = centroids
    asked = rng.choice(len(turned), min(400, len(turned)), replace=False)
    queries = index.turned_queries(vectors[asked])
    distance = -queries @ turned.T
    distance[np.arange(len(asked)), asked] = np.inf
    near = np.argpartition(distance, min(k, len(turned) - 1) - 1, axis=1)[:, : min(k, len(turned) - 1)] if len(turned) > 1 else np.zeros((len(asked), 0), int)
    of = index.nearest_lists(turned)[:, 0]
    place = np.argsort(index.nearest_lists(queries), axis=1)
    if near.size:
        ranks = np.sort(np.take_along_axis(place, of[near], axis=1).ravel())
        index.probes = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1
    return index


def scan(index: Index, ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, cand_ids: np.ndarray, cands: np.ndarray, k: int, width: int, doubt: float) -> tuple[np.ndarray, ...]:
    """Query number, candidate number and inner product of each query's k best among the candidates it didn't give up.

    Partial distances grow by one block of `width` dimensions at a time. While many pairs are alive a block is one matrix
    product over the queries and candidates that have any; once few are, it is summed pair by pair.
    """
    q, c = index.turned_queries(queries), index.turned(cands)
    dims = q.shape[1]
    who, whom, score = np.zeros(0, int), np.zeros(0, int), np.zeros(0)

    def limit(seen: int) -> float:
        return (1 if seen == dims else (1 + doubt / np.sqrt(seen)) ** 2 * seen / dims) * (1 + 1e-9)

    for begin in range(0, len(c), 2048):
        rows, cols = np.arange(len(q)), np.arange(begin, min(begin + 2048, len(c)))
        so_far, pairs = np.where(ids[:, None] == cand_ids[cols], np.inf, 0.0), None
        for d in range(0, dims, width):
            block, seen = slice(d, d + width), min(d + width, dims)
            if pairs is None:
                qb, cb = q[rows, block], c[cols, block]
                so_far += (qb * qb).sum(1)[:, None] + (cb * cb).sum(1) - 2 * qb @ cb.T
                alive = so_far <= (bounds[rows] * limit(seen) + 1e-9)[:, None]
                if alive.mean() < 0.05:
                    a, b = np.nonzero(alive)
                    pairs, so_far = (rows[a], cols[b]), so_far[a, b]
                else:
                    so_far[~alive] = np.inf  # given up for good
                    r, x = alive.any(1), alive.any(0)
                    if not (r.all() and x.all()):
                        rows, cols, so_far = rows[r], cols[x], so_far[r][:, x]
            else:
                a, b = pairs
                so_far = so_far + ((q[a, block] - c[b, block]) ** 2).sum(1)
                alive = so_far <= bounds[a] * limit(seen) + 1e-9
                pairs, so_far = (a[alive], b[alive]), so_far[alive]
        if pairs is None:
            a, b = np.nonzero(np.isfinite(so_far))
            pairs = rows[a], cols[b]
        a, b = pairs
        # The measure itself, in double precision on the given vectors.
        a, b, s = np.concatenate([who, a]), np.concatenate([whom, b]), np.concatenate([score, (queries[a] * cands[b]).sum(1)])
        order = np.lexsort((cand_ids[b], -s, a))
        a, b, s = a[order], b[order], s[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        # The k-th best so far bounds what is still worth a look.
        last = place == k - 1
        far = ((q[a[last]] - c[b[last]]) ** 2).sum(1)
        bounds[a[last]] = np.minimum(bounds[a[last]], far)
        best = place < k
        who, whom, score = a[best], b[best], s[best]
    return who, whom, score


def search(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    recall: float = 0.97,
    list_rows: int = 2048,
    max_lists: int = 1024,
    sample: int = 20_000,
    seeds: int = 4096,
    block_rows: int = 4096,
    part_rows: int = 1024,
    width: int = 16,
    doubt: float = 2.5,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for each row whose vec_id is divisible by `every`.

    See `usable` for the rows that take part. Nearest first, ties to the smaller vec_id; a query without candidates has no
    row. Columns beside vec_id and embedding are ignored.
    """
    spark = vectors.sparkSession
    rows = staged(usable(vectors), "vectors")
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("embedding") == (lengths["n"] if lengths else 0))
    index = fit(rows, k, recall, list_rows, max_lists, sample, seeds)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(index)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(list=shared.value.nearest_lists(shared.value.turned(np.stack(batch["embedding"].to_numpy())))[:, 0])

    held = staged(rows.mapInPandas(listed, "vec_id long, embedding array<double>, list int"), "lists")
    # One number per list, at most max_lists.
    sizes = np.zeros(len(index.centroids), np.int64)
    for number, count in held.groupBy("list").count().collect():
        sizes[number] = count

    def probing(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            found, ids = shared.value, batch["vec_id"].to_numpy(np.int64)
            queries = np.stack(batch["embedding"].to_numpy())
            order = found.nearest_lists(found.turned_queries(queries))
            # As many lists as the index asks for, and more until they hold k candidates beside the query itself.
            wanted = np.maximum(found.probes, (np.cumsum(sizes[order], axis=1) <= k).sum(1) + 1)
            lists = [row[:n][sizes[row[:n]] > 0].tolist() for row, n in zip(order, wanted, strict=True)]
            near, bound = found.first_found(ids, queries, k)
            scores = [(q * found.seeds[n]).sum(1) for q, n in zip(queries, near, strict=True)]
            yield pd.DataFrame({"query_id": ids, "query": batch["embedding"], "bound": bound, "lists": lists, "vec_ids": list(found.seed_ids[near]), "scores": scores})

    of_query = "query_id long, query array<double>, bound double, lists array<int>, vec_ids array<long>, scores array<double>"
    asked = rows.where(F.col("vec_id") % every == 0).mapInPandas(probing, of_query)
    asked = staged(asked, "queries")
    loads = np.zeros(len(sizes), np.int64)
    for number, count in asked.select(F.explode("lists").alias("list")).groupBy("list").count().collect():
        loads[number] = count

    blocks = F.array(*(F.lit(max(1, int(-(-n // block_rows)))) for n in sizes))
    parts = F.array(*(F.lit(max(1, int(-(-n // part_rows)))) for n in loads))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    of_list = lambda xs: F.get(xs, F.col("list"))
    left = held.withColumn("block", F.pmod(F.xxhash64("vec_id"), of_list(blocks)).cast("int")).withColumn("part", numbers(of_list(parts)))
    right = asked.select("query_id", "query", "bound", F.explode("lists").alias("list"))
    right = right.withColumn("part", F.pmod(F.xxhash64("query_id"), of_list(parts)).cast("int")).withColumn("block", numbers(of_list(blocks)))

    def scanned(cands: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if cands.empty or queries.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, cand_ids = queries["query_id"].to_numpy(np.int64), cands["vec_id"].to_numpy(np.int64)
        out = []
        for a in range(0, len(ids), 256):
            some = slice(a, a + 256)
            q = np.stack(queries["query"].to_numpy()[some])
            who, whom, score = scan(shared.value, ids[some], q, queries["bound"].to_numpy(float, copy=True)[some], cand_ids, np.stack(cands["embedding"].to_numpy()), k, width, doubt)
            out.append(pd.DataFrame({"query_id": ids[some][who], "vec_id": cand_ids[whom], "score": score}))
        return pd.concat(out)

    key = ["list", "block", "part"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(scanned, "query_id long, vec_id long, score double")
    first = asked.select("query_id", F.explode(F.arrays_zip("vec_ids", "scores")).alias("s")).select("query_id", F.col("s.vec_ids").alias("vec_id"), F.col("s.scores").alias("score"))
    found = found.unionByName(first).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
