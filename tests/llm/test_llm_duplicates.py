"""SimHash, line dedup and fingerprints: brute force, and rows at the edges."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from conftest_llm import frame, prose
from pyspark.sql import functions as F

from monthmill.llm import line_templates, simhash, winnow


def fingerprint(text):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=3):
    """The smallest class of each print, by comparing all with all."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= radius:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in prints}


def test_fingerprints_and_components_equal_brute_force(spark, edges):
    got = simhash.near_duplicates(edges).collect()
    assert len(got) == edges.count()
    texts = Counter((r["doc_id"], fingerprint(r["text"])) for r in edges.collect())
    assert Counter((r["doc_id"], r["fp"] & (1 << 64) - 1) for r in got) == texts
    of = components({p for _, p in texts})
    for r in got:
        mine = of[r["fp"] & (1 << 64) - 1]
        ids = [i for i, p in texts if of[p] == mine and i is not None]
        assert r["component_id"] == (min(ids) if ids else None)


@pytest.mark.parametrize("shard_rows", [3, 2048])
def test_links_lose_none_also_in_cut_shards(spark, shard_rows):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints)[:25]:
        for _ in range(6):
            for bit in rng.sample(range(64), rng.randint(1, 3)):
                p ^= 1 << bit  # chains drift away from their start
            prints.add(p)
    signed = [(np.uint64(p).astype(np.int64).item(),) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), shard_rows=shard_rows)
    found = {r["u"]: r["root"] for r in simhash.components(edges).collect()}
    want = components(prints)
    groups = lambda of: sorted(Counter(of.values()).values())
    mine = {s: found.get(s, s) for (s,) in signed}
    assert groups(mine) == groups(want)
    unsigned = {s: s & (1 << 64) - 1 for (s,) in signed}
    assert all((want[unsigned[a]] == want[unsigned[b]]) == (mine[a] == mine[b]) for a in mine for b in mine)


def test_tree_finds_all_within_the_radius():
    rng = random.Random(2)
    values = [rng.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:40]:
        assert sorted(tree.within(q, 3)) == sorted({v for v in values if (v ^ q).bit_count() <= 3})


def test_one_document_of_each_group_stays(spark, edges, empty):
    kept = simhash.keep_one(edges)
    assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {1, 4, 5, 7}.issubset(ids) and not {2, 3, 6, 2**60 + 1} & set(ids)
    assert ids.count(None) == 1  # only that text has no document with an id
    assert simhash.keep_one(empty).count() == 0 and simhash.near_duplicates(empty).count() == 0


# Line dedup


def test_lines_of_earlier_documents_go(spark):
    shared, other = prose(60, 1), prose(12, 4)
    near = shared.split()
    near[30] = "changed"
    rows = [
        (1, f"{prose(20, 11)}\n{shared}\nshort line here\n{other} 17"),
        (2, f"{shared}\n{prose(20, 12)}\nshort line here"),
        (3, f"{prose(20, 13)}\n{' '.join(near)}\n{other} 4711"),
        (4, f"{prose(9, 14)}\n{prose(9, 14)}"),
        (None, f"{shared}\n{prose(21, 15)}"),
    ]
    got = {r["doc_id"]: r for r in line_templates.dedup(frame(spark, rows)).collect()}
    assert got[1]["text"] == rows[0][1] and got[1]["n_dropped"] == 0
    assert got[2]["text"] == f"{prose(20, 12)}\nshort line here"
    # One word of 60 and a number are variable fields of the same templates.
    assert got[3]["text"] == prose(20, 13) and got[3]["n_dropped"] == 2
    assert got[4]["text"] == rows[3][1]  # within a document nothing repeats another
    assert got[None]["text"] == prose(21, 15)


def test_line_dedup_keeps_odd_rows(spark, edges, empty):
    out = line_templates.dedup(edges)
    assert out.columns == [*edges.columns, "n_lines", "n_dropped"] and out.count() == edges.count()
    got = Counter((r["doc_id"], r["n_dropped"]) for r in out.collect())
    # The greatest id and the row without id come after document 4; its own copies don't count; 6 repeats 5.
    assert got[4, 0] == 2 and got[2**60 + 1, 1] == 1 and got[None, 1] == 1 and got[None, 0] == 1 and got[6, 1] == 1 and got[5, 0] == 1
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[1] is None and texts[2] == "" and texts[9] == "a\n\n\na" and texts[6] == ""
    assert line_templates.dedup(empty).count() == 0


def test_the_pipeline_drops_short_lines(spark):
    rows = [
        (1, f"{prose(9, 1)}\nAll rights reserved.\nPage 3\n\n版权所有\n42"),
        (2, f"{prose(9, 2)}\n\nAll  rights reserved.\npage 4\n42\n17"),
        (3, f"版权所有\n{prose(9, 3)}\nPage 5 \n\n版权2024\n3 4\nMenu"),
        (4, f"版权2023\n{prose(9, 4)}\n3 5\nMenu\nMenu"),
    ]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, frame(spark, rows), "").collect()}
    # Equal lines and templates with a word go; lines that are all numbers go only as equal ones; blank lines stay.
    assert got == {1: rows[0][1], 2: f"{prose(9, 2)}\n\npage 4\n17", 3: f"{prose(9, 3)}\n\n版权2024\n3 4\nMenu", 4: f"版权2023\n{prose(9, 4)}\n3 5"}


# Fingerprints


def winnowed(text, k=4, w=4):
    turn = lambda x, n: (x << n | x >> (64 - n)) & (1 << 64) - 1
    words = [xxhash.xxh64_intdigest(x.encode(), 42) for x in (text or "").lower().split()]
    runs = [0] * max(0, len(words) - k + 1)
    for i in range(len(runs)):
        for j in range(k):
            runs[i] ^= turn(words[i + j], k - 1 - j) if k - 1 - j else words[i + j]
    if not runs:
        return None
    windows = [range(i, i + w) for i in range(len(runs) - w + 1)] or [range(len(runs))]
    return [(runs[p], p) for p in sorted({min(x, key=lambda i: (runs[i] >> 33, -i)) for x in windows})]


@pytest.mark.parametrize("k, w", [(4, 4), (2, 5), (1, 1), (4, 7)])
def test_winnowing_equals_brute_force(spark, k, w):
    texts = [prose(n, n) for n in (1, 3, 4, 5, 7, 8, 40, 300)] + ["a b a b a b a b a b a b a b", "", None]
    out = winnow.with_winnowed(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), F.col("t"), "f", k, w)
    for r in out.collect():
        want = winnowed(texts[r["i"]], k, w)
        got = [(x["hash"] & (1 << 64) - 1, x["pos"]) for x in r["f"]]
        assert got == want if want else len(got) == (1 if (texts[r["i"]] or "").split() else 0)


def test_a_shared_run_of_words_is_always_found(spark):
    for at in range(5):
        both = [(0, f"{prose(30 + at, 1)} {prose(7, 50)} {prose(20, 2)}"), (1, f"{prose(13, 3)} {prose(7, 50)} {prose(9, 4)}")]
        rows = winnow.with_winnowed(spark.createDataFrame(both, "i int, t string"), F.col("t"), "f").select(winnow.hashes(F.col("f"))).collect()
        assert set(rows[0][0]) & set(rows[1][0])


@pytest.mark.parametrize("order", [[5, 1, 9, 7], [3]])
def test_edited_texts_and_the_next_document(spark, order):
    rows = [(i, prose(40 + i, i)) for i in order]
    got = {r["doc_id"]: r for r in winnow.edited_fingerprints(frame(spark, rows)).collect()}
    text, down = dict(rows), sorted(order, reverse=True)
    for i, after in zip(down, down[1:] + down[:1]):
        n = len(text[i])
        edited = text[i][: n - n // 3] + text[after][: n // 3]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == n
        if i != after:
            assert got[i]["near_edited"] > got[i]["near_next"]


def test_fingerprints_of_odd_rows(spark, edges, empty):
    got = winnow.edited_fingerprints(edges).collect()
    assert len(got) == edges.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert len({r["fingerprint"] for i in (4, 2**60 + 1) for r in by[i]}) == 1 and by[5][0]["fingerprint"] == by[6][0]["fingerprint"]
    assert by[6][0]["near_next"] == 1.0 and by[1][0]["fingerprint"] == by[2][0]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert winnow.edited_fingerprints(empty).count() == 0


def test_texts_without_spaces_have_more_than_one_run(spark):
    rng = random.Random(3)
    made = lambda alphabet: "".join(rng.choice(alphabet) for _ in range(300))
    for alphabet in ([chr(0x4E00 + i) for i in range(500)], [chr(0xE01 + i) for i in range(46)], [chr(0x20000 + i) for i in range(99)], list("abcdefghij0123456789+/")):
        rows = [(i, made(alphabet)) for i in (1, 2)]
        got = winnow.edited_fingerprints(frame(spark, rows)).collect()
        # Two thirds of a text stay.
        assert len(got) == 2 and all(r["near_edited"] > 0.3 and r["near_next"] < 0.1 for r in got)
