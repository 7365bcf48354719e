"""Operators on texts against brute force, library results and edge cases."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strideframe.llm import decontaminate as D
from strideframe.llm import license_scan as LS
from strideframe.llm import lz_fingerprint as Z
from strideframe.llm import near_dup as N
from strideframe.llm import piece_codec as P
from strideframe.llm import quality as Q
from strideframe.llm import suffix_dedup as S
from strideframe.llm import toxicity as X

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EDGE = [
    (1, None, "en"), (2, "", None), (3, " \n\t", "en"), (4, "one", "en"), (5, "Mit MIT license, apache license mit", "en"),
    (6, "x" * 90_000, "en"), (7, "a b " * 20_000, "en"), (7, "a b " * 20_000, "en"), (None, "No id here at all, really none.", "en"),
    (8, "日本語 é😀 \x00 ▁ <s>", "ja"), (9, "No id here at all, really none.", "en"),
]


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def edge(spark):
    # extra columns have the names of results and helpers
    cols = "doc_id long, text string, lang string, score string, text_key int, n_bytes int, _starts int, words int, h int"
    return spark.createDataFrame([(*r, "s", 1, 2, 3, 4, 5) for r in EDGE], cols)


# -- license scan ---------------------------------------------------------------

def brute_base(text):
    words = WORD.findall(lower(text))
    at = [(i, t.label) for t in LS.BASE for i in range(len(words)) if words[i:i + len(t.words())] == t.words()]
    places = [i for i, _ in at]
    return (len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at})))


def test_license_scan(spark, docs, texts, edge):
    for df, rows in ((docs, list(texts.items())), (edge, [r[:2] for r in EDGE])):
        got = LS.license_scan(df).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == \
            sorted([(i, *brute_base(t)) for i, t in rows], key=repr)
        assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_license_repeated_rows_and_long_templates(spark):
    """Rows that repeat id and text each give a row with the counts of one; templates longer than a block's stride are met."""
    text = "mit license and " + "word " * 40 + "gnu general public license"
    rows = [(1, text)] * 3 + [(1, "mit license")] + [(None, text)] * 2 + [(2, None)] * 2
    got = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                              for r in LS.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == {(1, 47, 2, 0, 44, "gpl,mit"): 3, (1, 2, 1, 0, 0, "mit"): 1, (None, 47, 2, 0, 44, "gpl,mit"): 2,
                   (2, 0, 0, None, None, ""): 2}
    words = [f"clause{k}" for k in range(100)]
    long = [LS.Template("long", " ".join(words))]
    rows = [(k, " ".join(["filler"] * k + words + ["filler"] * 7)) for k in range(0, 210, 11)] + [
        (1000, " ".join(words[:79])), (1001, " ".join(words[:80]))]
    got = {r.doc_id: r.labels for r in LS.license_scan(spark.createDataFrame(rows, "doc_id long, text string"), templates=long).collect()}
    assert got == {k: "" if k == 1000 else "long" for k, _ in rows}


def test_license_templates_over_block_edges(spark):
    filler = ["w%d" % i for i in range(200)]
    rows = []
    for k in range(0, 100, 9):
        rows.append((k, " ".join(filler[:k] + "licensed under the new apache license version 2".split() + filler[k:])))
    rows.append((999, " ".join(x + " " + y for x, y in zip("licensed under the apache license version 2 0".split(), filler))))
    got = {r.doc_id: r for r in LS.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("apache" in got[k].labels and got[k].first_word == k + 4 for k in range(0, 100, 9))
    assert got[999].labels == "apache" and got[999].n_base == 0     # spread over one block: the template, not the phrase
    assert LS.license_scan(spark.createDataFrame(rows, "doc_id long, text string").limit(0)).count() == 0


# -- decontamination --------------------------------------------------------------

def brute_hits(docs, items, window=10):
    wins = collections.defaultdict(set)
    for item, text in items:
        w = WORD.findall(lower(text))
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[i:i + window])].add(str(item))
    sizes = {len(w) for w in wins}
    out = set()
    for doc, text in docs:
        w, hit, found = WORD.findall(lower(text)), set(), set()
        for i in range(len(w)):
            for n in sizes:
                key = tuple(w[i:i + n])
                if len(key) == n and key in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[key]
        out.add((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def test_decontamination(spark, docs, texts, edge):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, "one"), (901, "A b, a b"), (902, None), (903, "..."), (904, "no id here at all really none"), (905, "one")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, at int")
    for df, rows in ((docs, texts.items()), (edge, [r[:2] for r in EDGE])):
        got = D.decontaminate(df, bench).drop("text_key").collect()
        assert {tuple(r) for r in got} == brute_hits(rows, items)
    assert D.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert D.decontaminate(docs.limit(0), bench).count() == 0


def test_decontamination_stage_judges_id_and_text(spark):
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").filter(F.length("text") > 60).first().text
    rows = [(None, "clean one"), (None, f"before {leak} after"), (None, "clean two"), (None, None), (7, "clean three"),
            (7, leak), (7, ""), (8, "clean four"), (8, "clean four"), (9, leak), (9, leak)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = D.decontamination_stage(spark, df, SF)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([r for r in rows if leak not in (r[1] or "")], key=repr)


# -- fingerprints -------------------------------------------------------------------

def parse(data):
    known, phrase, out = set(), b"", []
    for b in data:
        phrase += bytes([b])
        if phrase not in known:
            known.add(phrase)
            out.append(phrase)
            phrase = b""
    return out + [phrase] if phrase else out


def test_phrases_are_those_of_the_definition():
    rnd = random.Random(2)
    for _ in range(100):
        data = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 60)))
        p = Z.Parser()
        p.feed(data)
        ends = p.ends if not data or (p.ends and p.ends[-1] == len(data)) else [*p.ends, len(data)]
        assert [data[a:b] for a, b in zip([0, *ends], ends)] == parse(data)
        cut = rnd.randint(0, len(data))
        q, other = Z.Parser(), bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 30)))
        q.feed(data[:cut])
        a, b = q.fork(data[cut:], other)
        r = Z.Parser()
        r.feed(data[:cut] + other)
        assert (a, b) == (p.ends, r.ends)


@pytest.mark.parametrize("per_range", [3, 1_000])
def test_fingerprints_follow_the_next_document(spark, texts, per_range):
    rows = sorted(texts.items())[:60] + [(10_000, None), (10_001, ""), (10_002, "é" * 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in Z.compare_with_next(df, rows_per_range=per_range).collect()}
    assert len(got) == len(rows)
    own = [(t or "") for _, t in rows]
    for k, (i, _) in enumerate(rows):
        t, nxt = own[k], own[(k + 1) % len(own)]
        n = len(t)
        edited = t[:n - n // 4] + nxt[:n // 4]
        r, after = got[i], got[rows[(k + 1) % len(rows)][0]]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        alike = lambda a, b: sum(a[j:j + 8] == b[j:j + 8] for j in range(0, 512, 8)) / 64
        assert r.near_edited == alike(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == alike(r.fingerprint, after.fingerprint)
    p = Z.fingerprint(df).withColumn("other", F.col("fingerprint"))
    assert p.filter(Z.alike("fingerprint", "other") < 1).count() == 0


def test_fingerprint_edges(spark, edge):
    got = Z.compare_with_next(edge).collect()
    assert len(got) == len(EDGE)
    assert len({r.fingerprint for r in got if r.doc_id == 7}) == 1
    single = Z.compare_with_next(edge.filter("doc_id = 4")).collect()
    assert single[0].near_next == 1.0
    assert Z.compare_with_next(edge.limit(0)).count() == 0


# -- substrings ----------------------------------------------------------------------

def brute_substrings(rows, n):
    raw = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(b[i:i + n] for b in raw for i in range(len(b) - n + 1))
    out = collections.Counter()
    for (doc, _), b in zip(rows, raw):
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if seen[b[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[doc, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)] += 1
    return out


@pytest.mark.parametrize("part_blocks", [2, 4096])
def test_substrings(spark, part_blocks):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    passages = [" ".join(word() for _ in range(rnd.randint(20, 60))) for _ in range(8)]
    rows = []
    for d in range(60):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else " ".join(word() for _ in range(rnd.randint(3, 30)))
                 for _ in range(rnd.randint(1, 5))]
        t = " ".join(parts)
        if rnd.random() < 0.4:
            k = rnd.randrange(len(t))
            t = t[:k] + word() + t[k + 3:]
        rows.append((d, t))
    rows += [(100, None), (101, ""), (102, "ab" * 300), (103, "x" * 200), (104, "x" * 99), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = S.dedup_substrings(df, length=100, part_blocks=part_blocks).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_substrings(rows, 100)


@pytest.mark.parametrize("part_blocks", [1, 4, 64])
def test_passage_with_many_surroundings(spark, part_blocks):
    """One bucket far larger than a task takes: a passage, cut off at either end, in other texts each time."""
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abc ") for _ in range(n))
    passage = text(130)
    rows = []
    for d in range(150):
        own = passage[rnd.choice([0, 0, 5, 20]):len(passage) - rnd.choice([0, 0, 7, 25])]
        rows.append((d, text(rnd.randint(0, 40)) + own + text(rnd.randint(0, 40))))
    rows += [(d + 200, t) for d, t in rows[:20]] + [(300, passage * 4), (301, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = S.dedup_substrings(df, length=100, part_blocks=part_blocks).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_substrings(rows, 100)


def test_substring_edges(spark, edge):
    got = {r.doc_id: r for r in S.dedup_substrings(edge).collect()}
    assert got[6].n_removed == 90_000 and got[7].n_removed == 80_000 and got[1].n_bytes == 0 and got[9].n_removed == 0
    assert S.dedup_substrings(edge.limit(0)).count() == 0


# -- codec ---------------------------------------------------------------------------

def test_codec_equals_the_library(texts):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = P._model(None)
    sp, c = sentencepiece.SentencePieceProcessor(model_proto=model), P.Codec(model)
    rnd = random.Random(1)
    odd = [" ", "  ", "a", "b", "the", "\n", "é", "▁", "日", "\x00", "😀", "12", "!!", "ing", "<s>", "\t", "ﬁ"]
    cases = ["".join(rnd.choice(odd) for _ in range(rnd.randint(0, 14))) for _ in range(1500)]
    cases += [" " * k for k in (1, 2, 15, 16, 17, 33, 100)] + ["a" + " " * k + "b" for k in (1, 2, 16, 17, 333)]
    cases += ["a" * 3000, "ab" * 2000, *list(texts.values())[:60]]
    for t in cases:
        ids = c.encode(t)
        assert ids == sp.encode(t), t[:50]
        assert c.decode([*ids, c.end]) == sp.decode([*ids, c.end]), t[:50]
        assert [i for w in c._split(t) for i in map(int, c.remembered(w)[1].split())] == ids


def test_codec_frames(spark, edge):
    sentencepiece = pytest.importorskip("sentencepiece")
    sp = sentencepiece.SentencePieceProcessor(model_proto=P._model(None))
    got = collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in P.round_trip(edge).collect())
    want = collections.Counter()
    for i, t, _ in EDGE:
        ids = [*sp.encode(t or ""), 2]
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
             hashlib.sha256(sp.decode(ids).encode()).hexdigest()] += 1
    assert got == want
    back = P.decode_texts(P.encode_texts(edge)).select("text", "decoded").collect()
    assert all(r.decoded == sp.decode(sp.encode(r.text or "")) for r in back)
    assert P.round_trip(edge.limit(0)).count() == 0


# -- near duplicates -------------------------------------------------------------------

def brute_near(rows, k, t=80):
    sets, ids = [], [i for i, _ in rows]
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= t * len(x | y):
                p, q = sorted((find(ids[a]), find(ids[b])))
                root[q] = p
    return {(i, len(s), find(i)) for i, s in zip(ids, sets)}


def test_near_duplicates(spark):
    rnd = random.Random(9)
    vocab = ["w%d" % i for i in range(400)]
    rows = []
    for f in range(6):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(1, 90))]
        for _ in range(25):
            w = list(base)
            for _ in range(rnd.randint(0, 1 + len(w) // 9)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two three four")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for k in (2, 5):
        got = N.near_duplicates(df, shingle=k).collect()
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == brute_near(rows, k)
        assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicate_edges(spark, edge):
    got = N.near_duplicates(edge).collect()
    assert len(got) == len(EDGE)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)]
    assert all(r.component_id == r.doc_id for r in got)
    assert N.near_duplicates(edge.limit(0)).count() == 0


def test_index_guarantee():
    index = N.Index()
    assert index.distance == 19


# -- classifiers ------------------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = Q.op2_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    r = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert r.n > 40 and r.a > 0.95


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    got = X.op3_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    r = got.agg(F.avg((F.col("predicted") == F.col("toxic")).cast("int")).alias("a"), F.count("*").alias("n")).first()
    assert r.n > 40 and r.a > 0.9


def test_obfuscated_words_are_restored(spark):
    plain = "you idiot and clown you moron loser trash " * 30
    df = spark.createDataFrame([(0, plain), (1, "1d10t cl0wn m0r0n l0ser tr@sh idiooooot i d i o t 2024-10-11"), (2, None), (3, "")],
                               "doc_id long, text string")
    costs = X.log_costs(X.char_trigrams(df))
    got = {r.doc_id: r.restored for r in X.deobfuscate(df, costs).collect()}
    assert got[1].split() == "idiot clown moron loser trash idiot idiot 2024-10-11".split()
    assert got[2] == "" and got[3] == ""


def test_classifier_edges(spark, edge):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (99, 1, 1), (3, None, None), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    every = F.lit(True)
    w = Q.train_quality(edge, labels, lambda c: every)
    got = Q.score_quality(edge, w)
    assert got.columns == [*[c for c in edge.columns if c != "score"], "score"]
    assert all(0 <= r.score <= 1 for r in got.collect()) and got.count() == len(EDGE)
    none = Q.train_quality(edge, labels.limit(0), lambda c: every)
    assert {r.score for r in Q.score_quality(edge, none).collect()} == {0.5}
    costs = X.log_costs(X.char_trigrams(edge))
    v = X.train_toxicity(edge, labels, costs, lambda c: every)
    assert all(0 <= r.score <= 1 for r in X.score_toxicity(edge, costs, v).collect())
    assert X.score_toxicity(edge.limit(0), costs, v).count() == 0
    assert X.char_trigrams(edge.limit(0)).sum() == 0


@pytest.mark.parametrize("place", [0, 31, 32, 366, 367, 368, 399])
def test_sort_bucket_compares_every_byte(place):
    rnd = random.Random(place)
    for ahead in range(S.LENGTH // 2 + 1):
        one = bytes(rnd.randrange(256) for _ in range(S.LENGTH))
        two = one[:place] + bytes([one[place] ^ 1]) + one[place + 1:]
        at = np.array([ahead, ahead])
        assert not S.sort_bucket([one, two], at, S.LENGTH).any(), ahead
        assert S.sort_bucket([one, one], at, S.LENGTH).all()


# -- near-duplicate stage --------------------------------------------------------------

def test_near_dup_stage_equals_plain_python(spark):
    """Kept rows of the stage: null and repeated ids, copies, near copies, no words, clashing names."""
    rnd = random.Random(12)
    words = lambda n: [f"w{rnd.randrange(5000)}" for _ in range(n)]
    a, b, c = words(60), words(60), words(45)
    near = a[:-1] + ["changed"]
    rows = [(1, a), (1, a), (2, a), (None, a), (None, a), (3, near), (None, b), (None, b), (4, c), (4, words(50)),
            (5, c + ["more"]), (6, []), (6, []), (None, []), (7, words(3)), (8, None), (8, None)]
    rows += [(100 + i, words(40)) for i in range(20)]
    rows = [(i, None if w is None else " ".join(w), k, "x") for k, (i, w) in enumerate(rows)]

    sets = {}
    for i, t, *_ in rows:
        w = (t or "").split()
        sets[i, t or ""] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {x: x for x in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = lambda x: (x[0] is not None, x[0] or 0)
    for x, y in itertools.combinations(sorted(sets, key=order), 2):
        both = len(sets[x] & sets[y])
        if sets[x] and both * 100 >= len(sets[x] | sets[y]) * 80:
            p, q = sorted((find(x), find(y)), key=order)
            root[q] = p
    want = collections.Counter()
    for i, t, *_ in rows:
        x = (i, t or "")
        if not sets[x]:
            want[i, t] += 1
        elif find(x) == x:
            want[i, t] = 1
    df = spark.createDataFrame(rows, "doc_id long, text string, _document int, _of string")
    out = N.near_dup_stage(spark, df.repartition(4), "")
    assert out.columns == df.columns
    assert collections.Counter((r.doc_id, r.text) for r in out.collect()) == want
    assert N.near_dup_stage(spark, df.limit(0), "").count() == 0
