"""Phrase collocations, importance resampling and embedding near-duplicates against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import frame, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from monthmill.llm import collisions, collocations, resampling

# Collocations


def pieces_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counted(rows, longest):
    f, n = Counter(), Counter()
    for text, lang in rows:
        for words in pieces_of(text):
            n[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang or "und", tuple(words[i : i + m])] += 1
    return f, n


def brute_collocations(rows, longest, least, percent, first):
    f, n = counted(rows, longest)
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), a in found.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                inner = (lang, words[i : i + m])
                if 100 * a >= percent * found[inner]:
                    gone.add(inner)
    out = {}
    for (lang, words), a in found.items():
        if (lang, words) in gone:
            continue
        cuts = [(1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        row = (-score, -a, " ".join(words).encode(), lang, f[lang, words[:k]], f[lang, words[k:]])
        out.setdefault(lang, []).append(row)
    rows = []
    for lang, some in out.items():
        for rank, (score, a, phrase, _, l, r) in enumerate(sorted(some)[:first], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(rows)


def langs(spark, rows):
    full = [(i, t, lang, "s", 1, "x", 2.0) for i, (t, lang) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n long, phrase string, score double")


CORPUS = [
    ("New York is big. new york IS new!\tNew York, york New\x0bNEW york is", "en"), ("new york is big new york is big", "en"), ("a a a a a a a", None),
    ("a a b a a b a a b", "und"), ("É é É é. É é;é É 中文 中文 中文:中文 中文 x", "fr"), (None, "en"), ("", None), (" \t . ,,\n", "xx"), ("one", "one"),
    ("new york is big", "fr"), ("big " * 40, "de"), ("one two " * 20, "a\t%09 b%"),
]


@pytest.mark.parametrize("longest, least, percent, first", [(3, 2, 50, 2000), (2, 2, 50, 3), (4, 2, 30, 2000), (3, 1, 100, 5)])
def test_collocations_equal_brute_force(spark, longest, least, percent, first):
    rng = random.Random(longest)
    words = ["new", "york", "is", "Big", "a", "b,", "c."]
    rows = CORPUS + [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), rng.choice(["en", "fr", None])) for _ in range(80)]
    got = collocations.collocations(langs(spark, rows * 2).repartition(5), longest, least, percent, first).collect()
    assert sorted(map(tuple, got)) == brute_collocations(rows * 2, longest, least, percent, first)


def test_collocations_of_long_and_odd_texts(spark, edges, empty):
    got = collocations.collocations(edges, 3, 5)
    rows = [(r["text"], r["lang"]) for r in edges.collect()]
    assert sorted(map(tuple, got.collect())) == brute_collocations(rows, 3, 5, 50, 2000)
    assert collocations.collocations(empty).collect() == []
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *((c, "bigint") for c in ("a", "l", "r", "n", "score"))]


def test_scores_beyond_64_bits(spark):
    """a * a * 1000000 passes 2^63 where a is 4 million; the same arithmetic on counts of that size."""
    a, l, r = 4_000_000_007, 5_000_000_029, 4_900_000_009
    wide = "decimal(19,0)"
    got = spark.sql(f"select (cast({a}L as {wide}) * cast({a}L as {wide}) * 1000000) div (cast({l}L as {wide}) * cast({r}L as {wide}))").first()[0]
    assert got == 1000000 * a * a // (l * r)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB .,\t\n\x0bé中", max_size=30), min_size=1, max_size=6), st.integers(2, 4))
def test_windows_of_any_text(texts, order):
    known, collocations.STRETCH = collocations.STRETCH, 8
    try:
        found = collocations._counted_windows(pa.array(texts), pa.array(["a\t%b"] * len(texts)), order).to_pylist()
    finally:
        collocations.STRETCH = known
    want = Counter()
    for text in texts:
        for words in pieces_of(text):
            for i in range(len(words)):
                some = [*words[i : i + order], *[None] * order][:order]
                want[" ".join(w for w in some[:2] if w) + "\ta%09%25b", *some[2:]] += 1
    assert {(r["pair"], *(r[f"w{k}"] for k in range(3, order + 1))): r["n"] for r in found} == want and len(found) == len(want)


# Resampling


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=20).filter(lambda w: b" " not in w), max_size=12), st.integers(1, 4))
def test_crcs_of_runs(words, order):
    for k, found in enumerate(resampling.run_crcs(words, order), 1):
        assert found.tolist() == [zlib.crc32(b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)]


def test_crcs_of_long_words():
    words = [b"x" * n for n in (1, 70_000, 3, 1 << 20, 5)]
    for k, found in enumerate(resampling.run_crcs(words, 3), 1):
        assert found.tolist() == [zlib.crc32(b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)]


def features(text, buckets):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return words, [zlib.crc32(r.encode()) % buckets for r in runs]


def brute_resample(docs, target, buckets, percent, min_words):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text, buckets)[1])
    for text in target:
        t.update(features(text, buckets)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    rows = []
    for i, text in docs:
        words, found = features(text, buckets)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(words), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = len(long) * percent // 100
    return sorted(map(str, [(*r, k if k <= drawn else None) for k, r in enumerate(long, 1)] + [(*r, None) for r in rows if r[1] < min_words]))


@pytest.mark.parametrize("block", [(1 << 19, 1 << 22), (7, 16)])
def test_resampling_equals_brute_force(spark, edges, monkeypatch, block):
    # The workers read these from the module, so small blocks are tested on the functions themselves below.
    target = [prose(30, 5), None, "", "seven maps were drawn by hand", prose(12, 8).upper()]
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()] + [(1000 + i, prose(10 + i % 25, i)) for i in range(150)]
    goal = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, weight int")
    got = resampling.resample(frame(spark, rows).repartition(6), goal, buckets=512, percent=20).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_resample(rows, target, 512, 20, 20)
    monkeypatch.setattr(resampling, "BLOCK_WORDS", block[0])
    monkeypatch.setattr(resampling, "BLOCK_BYTES", block[1])
    texts = [None if t is None else t.encode() for _, t in rows[:40]]
    for number, text in enumerate(texts):
        found = Counter(b for owner, bs, _ in resampling.text_features(texts, 3, 512) for b in bs[owner == number].tolist()) if number in (0, 8, 9, 20) else None
        if found is not None:
            assert found == Counter(features(None if text is None else text.decode(), 512)[1])


def test_resampling_of_nothing(spark, edges, empty):
    goal = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(empty, goal).count() == 0
    got = resampling.resample(edges, goal.where("false")).collect()
    assert len(got) == edges.count() and sum(r["rank"] is not None for r in got) == 0


def test_ranks_are_those_of_one_sort(spark):
    df = spark.range(5000).selectExpr("id % 7 as a", "id % 100 as b", "id")
    got = resampling.ranked(df.repartition(9), ["a", "b", "id"]).orderBy("a", "b", "id").collect()
    assert [r["rank"] for r in got] == list(range(1, 5001))


# Embedding near-duplicates


def brute_links(rows, threshold):
    x = [None if v is None or any(c is None or not math.isfinite(c) for c in v) or not any(v) else np.array(v) / max(map(abs, v)) for _, v in rows]
    x = [None if v is None else v / np.linalg.norm(v) for v in x]
    near = [[j for j, b in enumerate(x) if j != i and a is not None and b is not None and len(a) == len(b) and a @ b >= threshold] for i, a in enumerate(x)]
    out = []
    for i, (key, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            todo += [j for j in near[todo.pop()] if j not in seen and not seen.add(j)]
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((key, len(near[i]), least, key == least))
    return sorted(map(str, out))


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, 1, "x") for k, v in rows], "vec_id long, embedding array<double>, label int, cls string")


def planted(rng, n, dim, groups, spread):
    """n random vectors, and groups of near copies around some of them."""
    x = rng.normal(size=(n, dim))
    for g in range(groups):
        size = int(rng.integers(2, 25))
        at = rng.choice(n, size, replace=False)
        x[at] = x[at[0]] + rng.normal(size=(size, dim)) * spread * rng.random((size, 1))
    return x


@pytest.mark.parametrize("dim, shard_rows", [(64, 2048), (64, 40), (16, 50), (3, 30), (2, 10), (1, 10)])
def test_links_equal_brute_force(spark, dim, shard_rows):
    x = planted(np.random.default_rng(dim), 400, dim, 12, 0.25)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = collisions.near_duplicates(vectors(spark, rows), shard_rows=shard_rows).collect()
    have, want = sorted(str(tuple(r)) for r in got), brute_links(rows, 0.9)
    links = lambda found: sum(int(r.split(",")[1]) for r in found)
    assert len(have) == len(want)
    # No link is made up, and of all links nearly all are found.
    assert 0.985 * links(want) <= links(have) <= links(want)
    least = {r["vec_id"]: r["n_links"] for r in got}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    most = (unit @ unit.T >= 0.9).sum(1) - 1
    assert all(least[i] <= most[i] for i in least)


def test_recall_right_at_the_threshold(spark):
    """Pairs whose cosine is just above 0.9, over several levels of shards."""
    rng = np.random.default_rng(3)
    x, y = collisions._pairs_at(rng, 32, 0.9005)
    rows = [(2 * i, v.tolist()) for i, v in enumerate(x[:1500])] + [(2 * i + 1, v.tolist()) for i, v in enumerate(y[:1500])]
    got = {r["vec_id"]: r for r in collisions.near_duplicates(vectors(spark, rows), shard_rows=20).collect()}
    assert sum(got[2 * i + 1]["component_id"] == 2 * i for i in range(1500)) / 1500 >= 0.97


def test_odd_vectors_and_copies(spark):
    x, big = [1.0, 2.0, 0.5], [1e200, 2e200, 0.5e200]
    rows = [(7, x), (3, x), (3, x), (None, x), (9, [2.0, 4.0, 1.0]), (10, [-1.0, 0.0, 0.0]), (4, [0.0, 0.0, 0.0]), (5, None), (6, [1.0, None, 2.0]), (8, [1.0, math.nan, 1.0]),
            (11, [math.inf, 1.0, 1.0]), (12, []), (13, [1.0, 2.0]), (14, big), (15, [1e-300, 2e-300, 0.5e-300]), (None, [0.0, 1.0, -1.0]), (16, [-0.0, 0.0, -1.0]), (17, [0.0, 0.0, -1.0])]
    got = sorted(str(tuple(r)) for r in collisions.near_duplicates(vectors(spark, rows)).collect())
    assert got == brute_links(rows, 0.9)
    assert collisions.near_duplicates(vectors(spark, rows).where("false")).count() == 0
    assert [tuple(r) for r in collisions.near_duplicates(vectors(spark, rows).where("vec_id = 4")).collect()] == [(4, 0, 4, True)]


def test_one_large_group_of_near_copies(spark):
    """Parts of one shard against each other: every link between different vectors counts once."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=16) + rng.normal(size=(500, 16)) * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, x[0].tolist()) for i in range(300)]
    got = collisions.near_duplicates(vectors(spark, rows), shard_rows=64).collect()
    assert {r["n_links"] for r in got} == {799} and {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_candidates_count_windows():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(40, 8)), rng.normal(size=(70, 8))
    i, j = collisions.candidates(a, b, 0.6, 4)
    want = np.argwhere((np.abs(a[:, None] - b[None]) <= 0.6).sum(2) >= 4)
    assert np.array_equal(np.stack([i, j], 1), want)
