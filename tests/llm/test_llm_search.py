"""Nearest neighbours, URL rules and the pipeline."""

import math
import random
from urllib.parse import quote

import numpy as np
import pytest
from conftest_llm import frame, prose
from pyspark.sql import functions as F

from monthmill.llm import neighbours, url_rules


def exact(rows, k, every):
    out = {}
    for q, x in rows.items():
        if q % every == 0:
            scored = sorted(((-float((np.array(x) * np.array(y)).sum()), i) for i, y in rows.items() if i != q))[:k]
            out[q] = [i for _, i in scored]
    return out


def ranked(got):
    out = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_search_finds_nearly_all(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(12, 24))
    vectors = {i: (centers[i % 12] + rng.normal(size=24) * 0.7).tolist() for i in range(2000)}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = neighbours.search(df, k=10, list_rows=100, block_rows=60, part_rows=5, seeds=50).collect()
    found, want = ranked(got), exact(vectors, 10, 20)
    assert set(found) == set(want) and all(len(v) == 10 for v in found.values())
    hits = sum(len(set(found[q]) & set(want[q])) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9
    for r in got:
        assert r["score"] == float((np.array(vectors[r["query_id"]]) * np.array(vectors[r["vec_id"]])).sum())


def test_search_with_odd_vectors(spark):
    x = [1.0, 2.0, 0.5]
    rows = [(0, x), (20, x), (3, x), (3, x), (4, [0.0, 0.0, 0.0]), (5, None), (6, [1.0, None, 2.0]), (7, [1.0, math.nan, 1.0]), (8, [math.inf, 1.0, 1.0]),
            (None, x), (9, [2.0, 4.0, 1.0]), (10, [-1.0, 0.0, 0.0]), (40, [1.0, 2.0]), (11, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, list int")
    got = neighbours.search(df).collect()
    # Fewer than 20 candidates: all of them; ties go to the smaller id.
    assert ranked(got) == {0: [9, 3, 20, 10], 20: [9, 0, 3, 10]}
    assert neighbours.search(df.where("vec_id = 20")).count() == 0
    assert neighbours.search(df.where("vec_id < 0")).count() == 0 and neighbours.search(df.where("vec_id = 4")).count() == 0


def test_many_equal_vectors(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0] if i % 3 else [float(i), 1.0]) for i in range(600)], "vec_id long, embedding array<double>")
    rows = {r["vec_id"]: r["embedding"] for r in df.collect()}
    got = ranked(neighbours.search(df, list_rows=50, block_rows=32, part_rows=4, seeds=40).collect())
    want = exact(rows, 20, 20)
    scores = lambda q, ids: [sum(a * b for a, b in zip(rows[q], rows[i])) for i in ids]
    assert all(scores(q, got[q]) == scores(q, want[q]) for q in want)


# URL rules

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("a.b.net", "/x/y", "block"), ("net", "", "block"), ("net", "", "allow")]


def judged(url):
    at = (url or "").find("://")
    rest = url[at + 3 :] if url and at >= 0 else ""
    host = rest[: min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))]
    path = rest[len(host) :]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [(len(h + p), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[2], max(fits)[1]) if fits else (host, path, None, "allow")


def test_urls_equal_brute_force(spark):
    rng = random.Random(6)
    urls = [None, "", "no scheme", "://", "http://", "http://com", "http://com/", "HTTP://WWW.Example.COM/en/a/b?x=/en/#y", "http://example.com/EN/", "http://É.example.com/en/",
            "http://xexample.com/en/", "http://example.com?/en/", "http://a.b.net/x/yz", "http://a.b.net/x/", "http://c.a.b.net/x/y/z", "http://a..net//", "http://u:p@example.com:80/en/",
            "x://" + "a." * 300 + "com/" + "b/" * 300, "http://example.com./en/", "http://exa\nmple.com/en/"]
    for _ in range(200):
        host = ".".join(rng.choice(["a", "b", "www", "example", "com", "net"]) for _ in range(rng.randint(1, 4)))
        urls.append(f"http://{host}/{'/'.join(rng.choice(['en', 'x', 'y', quote('ü')]) for _ in range(rng.randint(0, 3)))}{rng.choice(['', '/', '?q', '#f'])}")
    pages = spark.createDataFrame([(i if i % 7 else None, u, "h", 1, "w") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string, row int, rule string")
    got = url_rules.judge(pages, url_rules.rules_frame(spark, RULES)).collect()
    want = [(i if i % 7 else None, *judged(u)) for i, u in enumerate(urls)] * 2
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_urls_without_pages_or_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    none = url_rules.rules_frame(spark, [])
    assert [tuple(r) for r in url_rules.judge(pages, none).collect()] == [(1, "a.com", "/", None, "allow")]
    assert url_rules.judge(pages.where("page_id = 2"), url_rules.rules_frame(spark, RULES)).count() == 0


# Pipeline


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean, bad and copied documents, with labels, as the given tables."""
    folder = str(tmp_path_factory.mktemp("sf"))
    passage = prose(60, 77)
    rows = [(i, f"{prose(40 + i % 9, i)}\n{prose(25, i + 400)}") for i in range(200)]
    rows += [(200 + i, " ".join(f"{w}$$$" for w in prose(60, i).split())) for i in range(60)]
    rows += [(300 + i, rows[i][1]) for i in range(10)]
    rows += [(400 + i, f"{prose(50, 600 + i)}\n{passage}") for i in range(5)]
    rows += [(500, None), (501, ""), (None, prose(50, 900))]
    frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(200)] + [(200 + i, 0, 0) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, rows, passage


def test_stages(spark, corpus):
    import corpus_pipeline
    from monthmill.llm import packing

    folder, rows, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, counts = docs.columns, []
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        counts.append({r["doc_id"]: r["text"] for r in docs.collect()})
    quality, lines, near = counts
    assert not {200 + i for i in range(60)} & set(quality) and set(range(200)) <= set(quality)
    assert not {300 + i for i in range(10)} & set(lines) and set(range(200)) <= set(lines)
    assert [passage in lines[400 + i] for i in range(5)] == [True, False, False, False, False]
    assert set(range(200)) <= set(near) and None in near
    assert docs.where(F.col("text").isNotNull() & (F.col("n_chars") != F.length("text"))).count() == 0
    packed = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in packed.collect()} == set(near)
    pieces = packing.pieces(docs, corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    assert packed.select(*pieces.columns).exceptAll(pieces).count() == 0 and packed.count() == pieces.count()


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
