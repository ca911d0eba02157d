"""URL rules and exact top-k against brute force, the registered queries against their SQL."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tabforge.llm import bitslice, queries, urlfilter

FOLDER = "/root/testdata/sf0.001"
ALLOW, BLOCK = ["com/", "www.a.com/en/", "b.org/x/y"], ["a.com/en/", "net/es/", "net/fr/", "com/", "b.org/x", "co.uk", "/only"]


def slow_match(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        for c in "?#":
            rest = rest.split(c)[0]
        host, slash, path = rest.partition("/")
        host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + path
    best = (-1, -1, "", None, "allow")
    for verdict, rules in (("allow", ALLOW), ("block", BLOCK)):
        for rule in rules:
            h, slash, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
                best = max(best, (len(h), len(slash + p), verdict, rule, verdict))
    return host, path, best[3], best[4]


def test_urls(spark):
    rnd = random.Random(1)
    hosts = ["a.com", "www.a.com", "x.www.A.com", "b.org", "n.net", "net", "com", "acom", "x.co.uk", "É.Com", "a..com", "", "u@a.com:80"]
    paths = ["", "/", "/en", "/en/", "/en/7", "/EN/", "/es/1", "/fr/", "/x/y", "/x/yz/1", "/xy", "/only", "//en/", "?q=/en/", "#/en/", "/x?y#z"]
    urls = [f"{rnd.choice(['http', 'https', ''])}://{rnd.choice(hosts)}{rnd.choice(paths)}" for _ in range(600)]
    urls += [None, "", "no scheme", "a://b://c/d", "http://a.com/\nen/", "http://a.com/" + "x" * 100_000, urls[0]]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string").repartition(3)
    found = urlfilter.filter_urls(df, ALLOW, BLOCK).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [slow_match(u) for u in urls]
    assert urlfilter.filter_urls(df.limit(0), ALLOW, BLOCK).collect() == []


def test_rule_limit(monkeypatch):
    monkeypatch.setattr(urlfilter, "MAX_RULES", 2)
    with pytest.raises(ValueError):
        urlfilter.UrlTrie(["a/", "b/", "c/"])


def slow_top(rows, k, ask):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, w in dict((i, v) for i, v in good if ask(i)).items():
        scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in good if i != q and len(v) == len(w))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [16, 16_384])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", block)
    monkeypatch.setattr(bitslice, "QUERY_ROWS", max(4, block // 64))
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(150)]
    rows += [(200 + i, rows[5][1]) for i in range(60)]  # a hot vector: ties at the boundary
    rows += [(300, None), (301, [0.1, None] * 3), (302, [math.nan] * 6), (303, [math.inf] + [0.0] * 5), (304, []), (305, [])]
    rows += [(None, rows[0][1]), (306, [1.0, 2.0]), (307, [0.5, -2.0]), (320, [0.0] * 6), (10, rows[10][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int").repartition(4)
    asks = F.col("vec_id") % 5 == 0
    found = bitslice.top_k(df, asks, 20)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == slow_top(rows, 20, lambda i: i % 5 == 0)
    assert bitslice.top_k(df.limit(0), asks, 20).collect() == []


def test_sums_of_slices():
    rng = np.random.default_rng(4)
    for dims, n in ((1, 1), (3, 70), (64, 200)):
        vectors, query = rng.integers(-40, 40, (n, dims)), rng.integers(-40, 40, dims)
        block = bitslice.SlicedBlock(np.arange(n), vectors)
        sums = np.zeros(n, np.int64)
        for weight, plane in enumerate(block.score_slices(query)):
            sums += np.unpackbits(plane.view(np.uint8), bitorder="little")[:n].astype(np.int64) << weight
        true = vectors @ query
        assert len(set(sums - true)) == 1


def tables():
    con = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(queries.SQL))
def test_queries_match_sql(spark, key):
    df = queries.QUERIES[key](spark, FOLDER)
    columns = sorted(df.columns)
    want = tables().execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[key]})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in df.select(*columns).collect()))) == sorted(map(repr, want))


def test_all_ten_are_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 11))


def test_pipeline(spark):
    """Every stage on what the one before kept, with a column of its own."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumn("kept", F.lit("mine"))
    ids = [r.doc_id for r in docs.collect()]
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        docs = out.cache()
        left = [r.doc_id for r in docs.collect()]
        assert len(set(left)) == len(left) and set(left) <= set(ids)
        ids = left
    mixed = corpus_pipeline.mixed(spark, docs, FOLDER)
    assert mixed.columns == docs.columns
    packed = corpus_pipeline.packed(spark, mixed, FOLDER)
    assert packed.where("piece = 0").count() == mixed.count()
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0
