"""Benchmark decontamination: prefix-filtered set join of documents and
item-sized windows of benchmark texts.

A window is ``window`` consecutive item words (a shorter item is one window).
Its set is its word shingles (``shingle`` words, or the whole window if
shorter); the threshold is full containment, so one shingle, the rarest, is
the necessary prefix.

1. One scan of the documents keeps the runs of words around places where a
   shingle of some window may stand.  The test is a bitmap of fixed size; runs
   are written to the shared folder and everything later reads only them.
2. Shingles are ordered by their number of occurrences in all documents; each
   window keeps the rarest.  A window with a shingle that never occurs is out.
3. Runs and windows are joined on that shingle (an equi-join on its words; the
   planner broadcasts or splits).  Length and position filter: a window starts
   ``offset`` words before the shingle and must end within the run.
4. The survivors are verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm import textscan as ts
from strideframe.llm.common import append_columns, bitmap, fresh, in_bitmap, read_table, reliable_checkpoint
from strideframe.llm.license_scan import text_words

WINDOW = 10
SHINGLE = 5
FILTER_BITS = 24
#: Longer runs are cut into overlapping pieces of so many words, which bounds a row.
RUN_WORDS = 1024


def _shingle_hash(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the shingles of ``size`` consecutive word hashes, by their start."""
    n = max(0, len(h) - size + 1)
    out = np.zeros(n, dtype=ts.U)
    for k in range(size):
        out = ts.mix64(out * ts.U(0x100000001B3) + h[k:k + n])
    return out


def benchmark_windows(items: DataFrame, item_id: str, text: str, window: int, shingle: int) -> DataFrame:
    """Distinct (item_id, window words, shingle size)."""
    w = items.select(F.col(item_id).cast("string").alias("item_id"), text_words(F.col(text)).alias("words"))
    w = w.filter(F.size("words") > 0).withColumn(
        "at", F.explode(F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))))
    return w.select("item_id", F.expr(f"slice(words, at + 1, {window})").alias("window")).distinct().withColumn(
        "k", F.least(F.size("window"), F.lit(shingle)))


def _shingles(words: str, size: str) -> str:
    """SQL: the shingles of a word array as (place, words) structs."""
    return (f"transform(sequence(0, size({words}) - {size}), "
            f"p -> struct(p AS p, array_join(slice({words}, p + 1, {size}), ' ') AS s))")


def _filter_of(windows: DataFrame, bits: int) -> np.ndarray:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [np.zeros(0, dtype=ts.U)]
            for _, _, data, offsets in ts.text_chunks(b.column(0)):
                s, e = ts.runs(ts.WORD[data], offsets)
                h = ts.FIRST.spans(ts.FIRST.prefix(data), s, e)
                first, _ = ts.rows_of(s, offsets)
                for lo, hi in zip(first[:-1], first[1:]):
                    out.append(_shingle_hash(h[lo:hi], int(hi - lo)))
            yield pa.RecordBatch.from_arrays([pa.array(ts.as_long(np.concatenate(out)))], names=["h"])

    parts = windows.select(F.explode(F.expr(_shingles("window", "k"))).alias("x")).select("x.s").distinct()
    return bitmap(parts.mapInArrow(hashed, "h long"), "h", bits)


def _cut(a: np.ndarray, z: np.ndarray, size: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges a..z in pieces of at most ``size`` that overlap by ``overlap``."""
    step = size - overlap
    n = np.maximum(1, -(-(z - a - overlap) // step))
    start = np.repeat(a, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * step
    return start, np.minimum(start + size, np.repeat(z, n))


def _text_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return ts.as_long(ts.FIRST.spans(ts.FIRST.prefix(data), offsets[:-1], offsets[1:]))


def candidate_runs(docs: DataFrame, bm: np.ndarray, sizes: list[int], window: int, doc_id: str,
                   text: str) -> DataFrame:
    """(doc_id, text_key, n_words, start, words): the runs of words of each
    text that may hold a window, and one row with null words per text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in ts.text_chunks(b.column(1)):
                low = ts.LOWER[data]
                s, e = ts.runs(ts.WORD[low], offsets)
                prefix = ts.FIRST.prefix(low)
                h = ts.FIRST.spans(prefix, s, e)
                key = _text_keys(data, offsets)
                first, row = ts.rows_of(s, offsets)
                edge = np.zeros(len(s) + 1, dtype=np.int64)     # +1 where a kept range opens, -1 where it closes
                for k in sizes:
                    g = _shingle_hash(h, k)
                    at = np.flatnonzero(in_bitmap(bm, g))
                    at = at[row[at] == row[at + k - 1]]
                    np.add.at(edge, np.maximum(at - (window - k), first[row[at]]), 1)
                    np.add.at(edge, np.minimum(at + window, first[row[at] + 1]), -1)
                kept = np.cumsum(edge[:-1]) > 0
                # ranges of two texts may touch: a run ends with its text
                a, z = ts.runs(kept.astype(np.uint8), first)
                a, z = _cut(a, z, max(RUN_WORDS, 2 * window), window - 1)
                raw = low.tobytes()
                text_of = [" ".join(raw[s[i]:e[i]].decode("utf-8") for i in range(p, q)) for p, q in zip(a, z)]
                r = np.concatenate([np.arange(hi - lo), row[a]])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo).take(pa.array(r)), pa.array(key[r]),
                     pa.array(np.diff(first)[r]), pa.array(np.concatenate([np.full(hi - lo, -1), a - first[row[a]]])),
                     pa.array([None] * (hi - lo) + text_of, pa.string())],
                    names=["doc_id", "text_key", "n_words", "start", "words"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(scan, f"doc_id {kind}, text_key long, n_words long, start long, words string")


def decontaminate(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
                  filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, n_hit, n_items,
    items_sha256, contaminated.

    A word is hit when it lies inside any occurrence of any window.  Null,
    empty and wordless texts have no words; items without words have no
    window; without items nothing is hit.  Rows that repeat both id and text
    give one row, and equal ids with different texts stay apart (text_key, a
    hash of the text, tells them).  Repeated items count by their id.  Other
    columns are not read.  An empty document table gives no rows.
    """
    windows = reliable_checkpoint(benchmark_windows(items, item_id, item_text, window, shingle), "windows")
    sizes = sorted(r.k for r in windows.select("k").distinct().collect())
    runs = reliable_checkpoint(
        candidate_runs(docs, _filter_of(windows, filter_bits), sizes, window, doc_id, text), "runs")
    key = ["doc_id", "text_key", "n_words"]
    # repeated rows (same id and text) hold the same runs: one of each goes on
    held = (runs.filter("words IS NOT NULL").distinct()
                .select(*key, "start", F.split("words", " ").alias("words")))
    if not sizes:
        held = held.limit(0)
    # each shingle with the words around it that a window can cover, not with its whole run
    around = f"slice(words, greatest(p - {window - 1}, 0) + 1, {2 * window})"
    shingles = [f"if(size(words) >= {k}, transform(sequence(0, size(words) - {k}), p -> struct(p AS p, "
                f"array_join(slice(words, p + 1, {k}), ' ') AS s, {around} AS near)), "
                "cast(array() as array<struct<p:int,s:string,near:array<string>>>))" for k in sizes or [1]]
    pieces = held.select(*key, "start", F.explode(F.concat(*map(F.expr, shingles))).alias("x")).select(
        *key, "start", "x.*")

    parts = windows.select("window", "item_id", F.explode(F.expr(_shingles("window", "k"))).alias("x")).select(
        "window", "item_id", F.col("x.p").alias("off"), F.col("x.s").alias("s"))
    counts = pieces.join(parts.select("s").distinct(), "s").groupBy("s").agg(F.count("*").alias("n"))
    rarest = (parts.groupBy("window", "off", "s").agg(F.count("*").alias("_"))
                   .join(counts, "s", "left")
                   .groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "s", "off")).alias("x"))
                   .filter("x.n > 0").select("window", "x.s", "x.off"))

    hits = (pieces.join(rarest, "s")
                  .withColumn("at", F.col("p") - F.col("off"))
                  .withColumn("i", F.expr(f"at - greatest(p - {window - 1}, 0)"))
                  .filter("at >= 0 AND i + size(window) <= size(near)")
                  .filter("slice(near, i + 1, size(window)) = window")
                  .select(*key, "window", (F.col("start") + F.col("at")).alias("a"),
                          (F.col("start") + F.col("at") + F.size("window")).alias("z")))
    # words covered: each occurrence adds what lies beyond the reach of those before it
    spans = hits.groupBy(*key).agg(F.array_sort(F.collect_set(F.struct("a", "z"))).alias("spans")).select(
        *key, F.expr("aggregate(spans, struct(0L AS n, 0L AS reach), (acc, x) -> struct("
                     "acc.n + greatest(x.z - greatest(x.a, acc.reach), 0L) AS n, "
                     "greatest(acc.reach, x.z) AS reach)).n").alias("n_hit"))
    of_items = (hits.select(*key, "window").distinct().join(windows.select("window", "item_id"), "window")
                    .groupBy(*key).agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    found = spans.withColumn("items", F.lit(None).cast("array<string>")).unionByName(
        of_items.withColumn("n_hit", F.lit(None).cast("long")))
    every = runs.filter("words IS NULL").select(*key).withColumns(
        {"n_hit": F.lit(None).cast("long"), "items": F.lit(None).cast("array<string>")})
    out = every.unionByName(found).groupBy(*key).agg(F.max("n_hit").alias("n_hit"), F.max("items").alias("items"))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(*key, n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """Query: ``decontaminate`` of every document against every item."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark")).drop("text_key")


def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents without a hit word, with the columns of
    ``docs``.  Rows are judged by id and text: others with the same id, or
    also without one, stay."""
    key, hit_id, hit_key = fresh(docs, "_text_key", "_hit", "_hit_key")
    hit = decontaminate(docs, read_table(spark, sf_dir, "benchmark")).filter("contaminated").select(
        F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key))

    def compute(batch: pa.RecordBatch):
        keys = [_text_keys(data, offsets) for _, _, data, offsets in ts.text_chunks(batch.column("text"))]
        return [pa.array(np.concatenate(keys))]

    keyed = append_columns(docs, [(key, "long")], compute)
    return keyed.join(hit, F.col("doc_id").eqNullSafe(F.col(hit_id)) & (F.col(key) == F.col(hit_key)),
                      "left_anti").select(*docs.columns)
