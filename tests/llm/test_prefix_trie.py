"""Prefix trie against a dictionary of all prefixes."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from strideframe.llm import prefix_trie as P

COLS = "conv_id long, turn long, role string, text string, depth int, key string, part int"


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t))


def rebuild(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = seqs.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(seqs):
    members, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(seqs):
        s = tuple(seqs[c])
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
        ends[s].append(c)
    kids = collections.defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) if kids[k] else 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * words(k[-1][1]) if k else 0)
    return sorted((members[k][0], len(k), members[k[:-1]][0] if k else -1, len(members[k]), len(kids[k]), leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()) for k in members)


def as_rows(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children,
                   r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], COLS)


def turns_of(rows):
    seqs = collections.defaultdict(list)
    for c, n, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        seqs[c].append((role or "", text or ""))
    return seqs


def test_extents():
    rng = np.random.default_rng(0)
    v = rng.integers(0, 5, 300)
    v[0] = -1
    t = P.SparseTable(v)
    for row, d in zip(rng.integers(0, 300, 400), rng.integers(0, 6, 400)):
        lo = hi = row
        while v[lo] >= d and lo > 0:
            lo -= 1
        while hi + 1 < 300 and v[hi + 1] >= d:
            hi += 1
        at, depth = np.array([row]), np.array([d])
        assert (t.left(at, depth)[0], t.right(at, depth)[0]) == (lo, hi)
        assert t.minimum(np.array([lo]), np.array([hi]))[0] == v[lo:hi + 1].min()


def test_equals_brute_force_over_many_partitions(spark):
    rng = random.Random(3)
    rows = []
    for c in range(400):
        if c % 3 == 0:        # a third of all conversations are one text
            seq = [("user", "same words here"), ("assistant", "the same reply")]
        else:
            seq = [(rng.choice(["user", "assistant"]), " ".join(["w"] * rng.randrange(4)) + rng.choice("ab"))
                   for _ in range(rng.randrange(1, 6))]
        rows += [(c, k, *t) for k, t in enumerate(seq)]
    rows += [(1000, k, "user", f"turn {k}") for k in range(300)]        # a long conversation and its first half
    rows += [(1001, k, "user", f"turn {k}") for k in range(150)]
    seqs = turns_of(rows)
    convs = P.sequences(table(spark, rows).repartition(5))
    want = brute(seqs)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "37", "90"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        assert as_rows(P.prefix_trie(convs)) == want
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert as_rows(P.prefix_trie(P.rebuilt(convs))) == brute(rebuild(seqs))


def test_edges(spark):
    rows = [(5, None, None, "b c"), (5, 0, "user", None), (5, 1, "user", ""), (6, 0, None, None), (6, 0, None, None),
            (40, 0, "user", "hello there you"), (41, 0, "user", "x"), (41, 1, "user", "y"), (-7, 0, "user", "x")]
    seqs = turns_of(rows)
    df = table(spark, rows + [(None, 0, "user", "lost")])
    convs = P.sequences(df)
    got = P.prefix_trie(convs)
    assert as_rows(got) == brute(seqs)
    texts = {(r.conv_id, r.depth): (r.role, r.text) for r in P.node_turns(got, df).collect()}
    assert texts[(5, 1)] == ("", "b c") and texts[(41, 2)] == ("user", "y") and texts[(-7, 0)] == (None, None)
    assert as_rows(P.prefix_trie(P.rebuilt(convs))) == brute(rebuild(seqs))
    assert as_rows(P.prefix_trie(convs.limit(0))) == []
    turnless = convs.select("conv_id", F.slice("turns", 1, 0).alias("turns"))
    assert as_rows(P.prefix_trie(turnless)) == brute({c: [] for c in seqs})


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert as_rows(P.op13_prefix_trie(spark, sf)) == brute(rebuild(turns_of(rows)))
