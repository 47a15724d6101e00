"""SimHash near-duplicates: 64-bit fingerprints, BK-trees per shard, connected components.

Shards. Two fingerprints that differ in at most `radius` of 64 bits agree on at least `blocks - radius` of `blocks`
bit blocks. Each fingerprint therefore goes to one shard per choice of that many blocks, keyed by their bits, and
every link lies within a shard. A shard's BK-tree meets its queries by a shuffle instead of a broadcast, because the
trees of all shards grow with the corpus. A shard above `shard_rows` is cut into parts and each pair of parts becomes
a task of its own, so no task holds more than two parts and no link is lost. A task gives a star per linked group, never
its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import checkpointed, staged

SEED = 42


def shingles(text: str | None, size: int) -> Iterator[bytes]:
    """Runs of `size` words, lower-cased in A-Z and joined by a space; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if len(words) <= size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))


def fingerprint(text: str | None, size: int = 3) -> int:
    """The majority of each bit over the XXH64 of all shingles, repeats included; no words give zero."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles(text, size), repeat(SEED)), np.uint64)
    if not len(hashes):
        return 0
    set_bits = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 65536 + 1):
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, size: int = 3, text: str = "text") -> Column:
    """Column with the fingerprint of `text` as a bigint."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return of(docs[text])


class BKTree:
    """Distinct integers; a child's key is its Hamming distance to its parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        at = 0
        while self.values:
            distance = (value ^ self.values[at]).bit_count()
            if distance == 0:
                return
            child = self.children[at].get(distance)
            if child is None:
                self.children[at][distance] = len(self.values)
                break
            at = child
        self.values.append(value)
        self.children.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """All members at most `radius` bits from `value`, by the edges that can lead to one."""
        found, open_nodes = [], [0] if self.values else []
        while open_nodes:
            at = open_nodes.pop()
            distance = (value ^ self.values[at]).bit_count()
            if distance <= radius:
                found.append(self.values[at])
            edges = self.children[at]
            if len(edges) <= 2 * radius + 1:
                open_nodes += [child for edge, child in edges.items() if abs(edge - distance) <= radius]
            else:
                open_nodes += [edges[e] for e in range(distance - radius, distance + radius + 1) if e in edges]
        return found


def _stars(tree_values: list[int], queries: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, smallest member) of each group that links form between the tree and the queries."""
    tree, root = BKTree(), {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for value in tree_values:
        tree.add(value)
    for value in queries:
        for other in tree.within(value, radius):
            a, b = find(value), find(other)
            if a != b:
                root[max(a, b)] = min(a, b)
    return [(x, r) for x in list(root) if (r := find(x)) != x]


def _links_in_shards(radius: int):
    """Batches sorted by shard (key, i, j) to star edges. Rows of part i are the tree, rows of part j its queries."""

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in batches:
            batch = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            if batch.empty:
                continue
            ids = batch[["key", "i", "j"]].to_numpy()
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1
            last = cuts[-1] if len(cuts) else 0
            kept = batch.iloc[last:]
            if last:
                yield batch.iloc[:last]
        if kept is not None:
            yield kept

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in runs(batches):
            ids = rows[["key", "i", "j"]].to_numpy()
            bounds = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1).tolist(), len(rows)]
            prints, parts = rows["fp"].to_numpy().view(np.uint64).tolist(), rows["part"].tolist()
            firsts, seconds = rows["i"].tolist(), rows["j"].tolist()
            edges: list[tuple[int, int]] = []
            for a, b in zip(bounds, bounds[1:], strict=False):
                if firsts[a] == seconds[a]:
                    edges += _stars(prints[a:b], prints[a:b], radius)
                else:
                    tree = [x for x, p in zip(prints[a:b], parts[a:b], strict=True) if p == firsts[a]]
                    edges += _stars(tree, [x for x, p in zip(prints[a:b], parts[a:b], strict=True) if p == seconds[a]], radius)
            both = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"u": both[:, 0], "v": both[:, 1]})

    return search


def _block_keys(fp: Column, blocks: int, radius: int) -> Column:
    """One key per choice of blocks - radius bit blocks: the choice's number and a hash of its bits."""
    edges = [64 * b // blocks for b in range(blocks + 1)]
    masks = [(1 << hi) - (1 << lo) for lo, hi in zip(edges, edges[1:], strict=False)]
    keys = []
    for n, chosen in enumerate(combinations(masks, blocks - radius)):
        mask = sum(chosen)
        keys.append(F.xxhash64(F.lit(n), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))))
    return F.array(*keys)


def links(prints: DataFrame, radius: int = 3, blocks: int = 5, shard_rows: int = 2048) -> DataFrame:
    """Star edges (u, v) between the distinct fingerprints `fp`, whose components are those of all links."""
    keyed = prints.select("fp", F.explode(_block_keys(F.col("fp"), blocks, radius)).alias("key"))
    sizes = keyed.groupBy("key").count().where(F.col("count") > 1)
    parts = F.ceil(F.col("count") / shard_rows).cast("int")
    part = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts")).cast("int")
    members = keyed.join(sizes, "key").select("key", "fp", parts.alias("parts")).select("key", "fp", "parts", part.alias("part"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.struct(F.least("part", other).alias("i"), F.greatest("part", other).alias("j")),
    )
    shards = members.select("key", "fp", "part", F.explode(pairs).alias("p")).select("key", "p.i", "p.j", "fp", "part")
    n = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = shards.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
    return shards.mapInPandas(_links_in_shards(radius), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root) for every vertex of the edges, by alternating large and small stars until nothing changes.

    Each round is joins and mergeable aggregates over the edges, checkpointed in the shared folder; the driver sees
    only a count and a checksum.
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    down = F.col("u") > F.col("v")
    edges = checkpointed(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(down).distinct())
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(down).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        edges = checkpointed(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where(down).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select("u", F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 3, blocks: int = 5, shard_rows: int = 2048) -> DataFrame:
    """doc_id, fp (bigint), root (a fingerprint that names the component) and component_id of every document.

    Documents link when their fingerprints differ in at most `radius` bits; component_id is the smallest doc_id that
    links reach. Equal fingerprints are one class from the start, so copies are never expanded into pairs. NULL and
    empty texts have fingerprint zero and link like any other. Documents without doc_id take part, but name a
    component only where no other can: its component_id is then NULL. Other columns are ignored.
    """
    prints = staged(docs.select("doc_id", fingerprints(docs, size).alias("fp")), "simhash")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = components(links(classes.select("fp"), radius, blocks, shard_rows))
    rooted = classes.join(linked, classes.fp == linked.u, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, size: int = 3, **how) -> DataFrame:
    """`docs` with one document of each component: the one of its smallest doc_id, repeated rows once.

    Of rows that share that doc_id the smallest by text, lang, source and n_chars stays. Where no document of a
    component has a doc_id, the smallest of its rows stays. Columns and their order are those of `docs`.
    """
    found = near_duplicates(docs, size, **how)
    order = F.struct(*(F.col(c) for c in ("text", "lang", "source", "n_chars") if c in docs.columns))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    smallest = F.min_by(row, order).alias("row")

    ids = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("kept_id")).distinct()
    named = docs.join(ids, docs.doc_id == ids.kept_id, "left_semi").groupBy("doc_id").agg(smallest).select("row.*")
    roots = found.where(F.col("component_id").isNull()).select("fp", "root").distinct()
    nameless = docs.where(F.col("doc_id").isNull())
    nameless = nameless.select(row.alias("row"), order.alias("order"), fingerprints(nameless, size).alias("fp")).join(roots, "fp")
    return named.unionByName(nameless.groupBy("root").agg(F.min_by("row", "order").alias("row")).select("row.*"))
