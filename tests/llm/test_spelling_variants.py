"""Spelling variants against plain edit distance over all pairs."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from strideframe.llm import spelling_variants as V

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(docs, drop=31):
    n = collections.Counter()
    for i, t in docs:
        for run in RUN.findall(t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % drop == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if k >= 2 and len(w) >= 7}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(n):
    out, form = {}, {}
    by = collections.defaultdict(set)
    for w in n:
        by[w].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1:]].add(w)
            by[w[:i] + "?" + w[i + 1:]].add(w)
    near = collections.defaultdict(set)
    for ws in by.values():
        for a in ws:
            near[a] |= {b for b in ws if one_edit(a, b)}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    for w in n:
        r = w
        while form[r] is not None:
            r = form[r]
        out[w] = (form[w], r, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def got(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_checksum_of_spans():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    s = rng.integers(0, 4000, 300)
    e = s + rng.integers(0, 900, 300)
    seed = rng.integers(0, 1 << 32, 300).astype(np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(s, e, seed)]
    assert V.crc32_spans(data, s, e, seed).tolist() == want
    assert V.crc32_spans(data, s[:0], e[:0], seed[:0]).tolist() == []


@pytest.mark.parametrize("block", [40, 4096])
def test_groups_equal_brute_force(spark, block):
    rng = random.Random(block)
    n = {}
    for _ in range(60):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(7, 12)))
        n[w] = rng.choice([2, 5, 40, 700, 9000])
        for _ in range(12):     # chains of edits: near words of near words
            i, kind = rng.randrange(len(w) + 1), rng.randrange(3)
            w = w[:i] + ("" if kind == 0 else rng.choice("abéÿ")) + w[i + (kind != 1):]
            if len(w) >= 7:
                n.setdefault(w, rng.choice([2, 3, 30, 400, 6000, 80000]))
    for i in range(300):        # one group with a third of all words
        n["abcdefg" + "".join(rng.choice("ab") for _ in range(7))] = i + 2
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    assert got(V.variant_groups(words, block=block)) == brute_groups(n)


def test_texts_and_edges(spark):
    rng = random.Random(5)
    stem = ["wonderful", "cafétérias", "×÷ÿÀàbcd", "aaaaaaaaaa"]
    docs = [(i, " ".join(rng.choice(stem).upper() if rng.random() < .2 else rng.choice(stem) for _ in range(200)) + "! x")
            for i in range(40)]
    docs += [(None, "wonderful " * 500), (50, None), (51, ""), (52, "z" * 5000 + " " + "z" * 4999), (52, "z" * 5000 + "-" + "z" * 4999),
             (53, "short words only 日本語")]
    df = spark.createDataFrame([(*d, 1, "n") for d in docs], "doc_id long, text string, n int, word string")
    words = {r.word: r.n for r in V.count_words(df).collect()}
    assert words == brute_words(docs)
    assert got(V.variant_groups(V.count_words(df))) == brute_groups(words)
    assert got(V.variant_groups(V.count_words(df.limit(0)))) == {}


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(V.op12_spelling_variants(spark, sf)) == brute_groups(brute_words(docs))
