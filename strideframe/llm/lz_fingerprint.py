"""Lempel-Ziv phrase fingerprints.

A text's UTF-8 bytes are parsed into dictionary phrases (each phrase is the
longest known one plus a byte, and becomes known).  The set of its phrases is
hashed and summarised by ``LANES`` minimum hashes: two texts are as alike as
lanes agree, an estimate of the similarity of the phrase sets, which is high
when one text compresses well given the other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm import textscan as ts
from strideframe.llm.common import append_columns, read_table

LANES = 64
ROWS_PER_RANGE = 4_000

_FACTOR = ts.mix64(np.arange(1, LANES + 1, dtype=ts.U)) | ts.U(1)
_BLOCK = 4096


class Parser:
    """Incremental phrase parsing; ``fork`` parses another ending of the same
    text without parsing the beginning again."""

    def __init__(self):
        self.known: dict[int, int] = {}
        self.node = 0
        self.ends: list[int] = []
        self.size = 0

    def feed(self, data: bytes) -> None:
        known, node, ends, i = self.known, self.node, self.ends, self.size
        for b in data:
            i += 1
            key = node << 8 | b
            node = known.get(key, 0)
            if not node:
                known[key] = len(known) + 1
                ends.append(i)
        self.node, self.size = node, i

    def fork(self, first: bytes, second: bytes) -> tuple[list[int], list[int]]:
        """Phrase ends after ``first``, and after ``second`` instead of it."""
        node, size, n_ends, n_known = self.node, self.size, len(self.ends), len(self.known)
        self.feed(first)
        ends = self.ends
        for key in list(self.known)[n_known:] if len(self.known) > n_known else ():
            del self.known[key]
        self.node, self.size, self.ends = node, size, ends[:n_ends]
        self.feed(second)
        return ends, self.ends


def signature(data: bytes, ends: list[int]) -> np.ndarray:
    """Minimum hashes of the phrases that end at ``ends`` (and of an unfinished last one)."""
    out = np.full(LANES, 0xFFFFFFFF, dtype=np.uint32)
    if not data:
        return out
    if not ends or ends[-1] < len(data):
        ends = [*ends, len(data)]
    e = np.array(ends, dtype=np.int64)
    s = np.concatenate([[0], e[:-1]])
    prefix = ts.FIRST.prefix(np.frombuffer(data, dtype=np.uint8))
    h = ts.FIRST.spans(prefix, s, e)
    for lo in range(0, len(h), _BLOCK):
        lanes = ((h[lo:lo + _BLOCK, None] * _FACTOR) >> ts.U(32)).min(axis=0).astype(np.uint32)
        out = np.minimum(out, lanes)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the hexadecimal fingerprint of each whole text (null:
    empty).  Equal texts have equal fingerprints; ``alike`` compares two."""

    def compute(batch: pa.RecordBatch):
        prints = []
        for t in batch.column(text):
            data = (t.as_py() or "").encode()
            p = Parser()
            p.feed(data)
            prints.append(signature(data, p.ends).tobytes().hex())
        return [pa.array(prints, pa.string())]

    return append_columns(docs, [(out, "string")], compute)


def alike(a: str, b: str):
    """Column: share of equal lanes of two fingerprint columns."""
    return F.expr(f"size(filter(sequence(0, {LANES - 1}), "
                  f"k -> substr({a}, 8 * k + 1, 8) = substr({b}, 8 * k + 1, 8))) / {LANES}D")


def _ranges(ids: DataFrame, rows_per_range: int) -> list:
    """Bounds that split the ids into ranges of about ``rows_per_range`` rows."""
    n = ids.count()
    k = math.ceil(n / rows_per_range)
    if k < 2:
        return []
    q = ids.agg(F.percentile_approx("id", [i / k for i in range(1, k)], 100 * k)).first()[0]
    return sorted(set(q or []))


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next larger doc_id, after the last
    the first.  The edited text has the last floor(n_chars / 4) code points
    replaced by the first as many, or all, of the next.  Null texts count as
    empty; a single document is its own next.  Null ids come first, and rows
    that repeat an id follow each other by a hash of their text.  Other
    columns are not read; an empty table gives no rows.

    Ids are split into ranges; each text moves once, to its range, and the
    first of a range also to the range before it, as the next of its last.
    Ids must be integers.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    bounds = _ranges(own.select("id"), rows_per_range)
    ranged = own.withColumn("r", _range_of("id", bounds))
    heads = sorted((r.r, r.first_id, r.n_null) for r in ranged.groupBy("r").agg(
        F.min("id").alias("first_id"), F.sum(F.col("id").isNull().cast("int")).alias("n_null")).collect())
    # (range, id of its first row, the range before it); the first follows the last
    back = own.sparkSession.createDataFrame(
        [(r, None if n else i, heads[k - 1][0], k == 0) for k, (r, i, n) in enumerate(heads)],
        "h int, head long, before int, wraps boolean")
    lead = (ranged.join(F.broadcast(back), (F.col("r") == F.col("h")) & F.col("id").eqNullSafe(F.col("head")))
                  .select(F.col("before").alias("r"), "id", "t", F.lit(True).alias("lead")))
    rows = ranged.select("r", "id", "t", F.lit(False).alias("lead")).unionByName(lead)
    ordered = (rows.withColumn("h", F.xxhash64("t")).repartition("r")
                   .sortWithinPartitions("r", "lead", F.col("id").asc_nulls_first(), "h")
                   .select("r", "lead", "id", "t"))
    return ordered.mapInArrow(_compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                        "edited_fingerprint string, near_edited double, near_next double")


def _range_of(column: str, bounds: list):
    """Number of bounds at or below the id: bisection over a literal array."""
    out = F.lit(0)
    if not bounds:
        return out

    def bisect(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(column) < bounds[mid], bisect(lo, mid)).otherwise(bisect(mid + 1, hi))

    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(bisect(0, len(bounds)))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    out: list[tuple] = []
    held = None     # the row that waits for its next: (range, id, text)
    waiting = None  # result waiting for the fingerprint of the next

    def finish(row, nxt_text):
        """Parse ``row`` and its edited text: (doc_id, n, sha, signature, edited signature)."""
        _, doc, text = row
        n = len(text)
        cut = n - n // 4
        keep, tail, new = text[:cut].encode(), text[cut:].encode(), nxt_text[:n // 4].encode()
        p = Parser()
        p.feed(keep)
        a, b = p.fork(tail, new)
        whole, edited = keep + tail, keep + new
        x, y = signature(whole, a), signature(edited, b)
        return (doc, n, hashlib.sha256(edited).hexdigest(), x, y)

    def emit(done, nxt):
        doc, n, sha, x, y = done
        out.append((doc, n, sha, x.tobytes().hex(), y.tobytes().hex(), likeness(x, y), likeness(x, nxt)))

    def batch():
        cols = list(zip(*out)) if out else [[]] * len(names)
        b = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=names)
        out.clear()
        return b

    for b in batches:
        for r, lead, doc, text in zip(*(c.to_pylist() for c in b.columns)):
            if held is not None and held[0] == r:
                done = finish(held, text)
                if waiting is not None:
                    emit(waiting, done[3])
                waiting = done
            if lead:
                if held is not None and held[0] == r:   # the range ends: its last row meets the next range's first
                    p = Parser()
                    data = text.encode()
                    p.feed(data)
                    emit(waiting, signature(data, p.ends))
                held = waiting = None
                continue
            if held is None or held[0] != r:
                waiting = None
            held = (r, doc, text)
        yield batch()
    yield batch()


def op5_lz_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Query: ``compare_with_next`` of all documents."""
    return compare_with_next(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
