import random

import corpus_pipeline
from pyspark.sql import functions as F

from strideframe.llm import graph as G
from strideframe.llm import warc_revisit as W


def test_components(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1060)] + \
        [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    alone = {5} - {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.root for r in G.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if x not in alone}
    assert G.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_linked_components_lose_no_link(spark):
    rnd = random.Random(8)
    groups = [(g, rnd.randrange(60)) for g in range(12) for _ in range(12)]
    groups = sorted(set(groups))
    true = {(a, b) for a in range(60) for b in range(a + 1, 60) if rnd.random() < 0.06}
    share = {(a, b) for g in range(12) for x, a in groups if x == g for y, b in groups if y == g and a < b}
    links = spark.createDataFrame(sorted(true), "a long, b long")
    root = list(range(60))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in true & share:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    got = {r.node: r.root for r in G.linked_components(spark.createDataFrame(groups, "g long, node long"),
                                                       lambda p: p.join(links, ["a", "b"])).collect()}
    for x in range(60):
        assert got.get(x, x) == find(x)


RECORDS = "record_id long, url string, ts long, kind string, status int, headers map<string,string>, digest string, base int"


def brute(rows):
    out = []
    for rid, url, ts, kind, status, h, _, _ in rows:
        if kind != "revisit":
            continue
        h = {k: v for k, v in (h or {}).items()}
        best = max(((t, i, b or {}, d) for i, u, t, k, s, b, d, _ in rows
                    if k == "response" and s == 200 and u == url and t is not None and ts is not None and t < ts and u is not None),
                   key=lambda x: x[:2], default=None)
        if best is None:
            out.append((rid, None, "orphan", None, None))
            continue
        _, base, bh, digest = best
        tag = lambda x: x[2:] if x and x.startswith("W/") else x
        if h.get("etag"):
            ok = tag(h["etag"]) == tag(bh.get("etag"))
        elif h.get("last-modified"):
            ok = h["last-modified"] == bh.get("last-modified")
        else:
            ok = None if bh.get("etag") or bh.get("last-modified") else True
        merged = bh | {k: v for k, v in h.items() if k in W.PERMITTED}
        out.append((rid, base, {True: "resolved", False: "mismatch", None: "unverified"}[ok],
                    tuple(sorted(merged.items())) if ok else None, digest if ok else None))
    return sorted(out, key=repr)


def test_revisits_against_brute_force(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(400):
        url = "a.org/hot" if rnd.random() < 0.4 else f"a.org/{rnd.randrange(20)}"
        h = {k: v for k, v in (("etag", rnd.choice(['"1"', 'W/"1"', '"2"', None])), ("last-modified", rnd.choice(["x", "y", None])),
                               ("server", "s%d" % i), ("date", "d%d" % i)) if v and rnd.random() < 0.9}
        rows.append((i, url if i % 50 else None, rnd.randrange(100) if i % 37 else None, rnd.choice(["response", "revisit"]),
                     rnd.choice([200, 200, 404]), h if i % 41 else None, f"digest{i}", 1))
    rows = [("http://" + r[1] if r[1] else None) and (r[0], "http://" + r[1], *r[2:]) or r for r in rows]
    df = spark.createDataFrame(rows, RECORDS).repartition(5)
    for per_range in (20, 100_000):
        got = W.resolve_revisits(df, rows_per_range=per_range).collect()
        assert sorted(((r.record_id, r.base_id, r.outcome, tuple(sorted(r.headers.items())) if r.headers is not None else None,
                        r.digest) for r in got), key=repr) == brute(rows)
    assert W.resolve_revisits(df.limit(0)).count() == 0


def test_canonical_url(spark):
    cases = {
        "HTTP://WWW.Example.com:80/a/?b=2&a=1&utm_source=x#frag": "example.com/a?a=1&b=2",
        "https://example.com/a?a=1&b=2&ref=q": "example.com/a?a=1&b=2", "//example.com": "example.com",
        "https://example.com:443/": "example.com", "no host#x": "no host", "http://e.org/?": "e.org",
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "url string, want string")
    for r in df.select("url", "want", W.canonical_url(F.col("url")).alias("got")).collect():
        assert r.got == r.want, r.url


def test_records_from_pages_edges(spark):
    pages = spark.createDataFrame([(0, None, "x"), (7, "http://a.org/x", None), (8, "http://a.org/x?b#c", ""), (8, "http://a.org/x?b#c", "")],
                                  "page_id long, url string, html string")
    got = W.resolve_revisits(W.records_from_pages(pages)).collect()
    assert len(got) == 3 + 3 + 2 + 2
    assert {r.outcome for r in got if r.record_id in (1, 2, 3)} == {"orphan"}


def test_pipeline_stages(spark):
    """Every stage keeps the columns and acts on what the one before kept."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, docs.count()
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf).cache()
        assert (out.columns == columns) == (k < 4), name
        assert 0 < out.count() <= seen, name
        docs, seen = out, out.count()
    assert corpus_pipeline.run(spark, sf).count() == seen
    empty = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0
