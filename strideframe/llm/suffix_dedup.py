"""Exact substring dedup by blockwise suffix sorting.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is removed.  Sorting all suffixes would move many times the corpus, so
the suffixes are dealt to buckets first, and only buckets in which two may be
equal are sorted, one at a time, to the depth ``length``.

1. Cover: in every string of ``length`` bytes the half-length piece with the
   smallest hash is its anchor (the leftmost of equals).  Equal strings have
   equal anchors at equal places, so the anchors, about 1 % of all positions,
   meet any two equal suffixes at the same distance, which is what the sample
   of a difference cover is for.  Consecutive starts share an anchor and form a
   block: the bytes of all their strings.
2. Anchors that occur once (a count over the corpus) hold no repeat.  A second
   scan counts the blocks of the others by a 128-bit hash; equal blocks repeat
   in full.  Two fixed-size bitmaps, one of the repeated blocks and one of the
   single ones that the first lets pass, let the third scan name whole runs of
   repeated blocks at once; only blocks that are in both are joined.
3. The rest are suffix buckets: the differing blocks around one anchor.  A
   bucket's suffixes are sorted by the head of the string, the precomputed
   rank of the cover sample (every ``STEP``-th position from the anchor, to
   the depth that head and tail leave open) and the tail, so long ties cost one
   rank instead of a long comparison.
4. A bucket of more than ``PART_BLOCKS`` blocks is too large for one task.  The
   distances from start to anchor are halved: the strings of a half share the
   bytes between its outermost ones, so a 128-bit hash of those deals blocks to
   smaller groups in which equal strings always meet.  Groups that are still too
   large are halved again.  Of rows that are equal in the half one goes on, and
   groups of one end, so a step at most doubles the rows of large groups; at a
   single distance the shared bytes are the string and every group is one row.

A sample by position modulo a period (the textbook difference cover) would
have 5 to 20 % of all positions here and exceed the shuffle that anchors need.
"""

from __future__ import annotations

import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm import textscan as ts
from strideframe.llm.common import append_columns, bitmap, fresh, in_bitmap, passing, read_table, reliable_checkpoint

LENGTH = 400
#: Bytes compared directly at either end of a string, and distance of the cover sample.
STEP = 32
PART_BLOCKS = 4096
_RUN = ["doc_id", "text_key", "lo", "hi"]


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values, by block prefixes and suffixes."""
    n = len(v)
    pad = -n % w
    x = np.concatenate([v, np.full(pad, ~ts.U(0))]).reshape(-1, w)
    ahead = np.minimum.accumulate(x, axis=1).reshape(-1)
    behind = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """(row, lo, hi, anchor, anchor hash) of the blocks of a chunk: starts
    lo..hi of strings with one anchor, as positions in the chunk; and the
    prefix sums of the chunk.  The anchor's hash is scrambled once more: as the
    least of many it is small, and bitmaps go by the leading bits."""
    piece = length // 2
    prefix = ts.FIRST.prefix(data)
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none, none.astype(ts.U), prefix
    h = ts.FIRST.windows(prefix, piece)
    bits = max(8, int(len(h)).bit_length())
    mask = ts.U((1 << bits) - 1)
    least = _sliding_min((h & ~mask) | np.arange(len(h), dtype=ts.U), length - piece + 1)
    size = np.diff(offsets)
    rows = np.flatnonzero(size >= length)
    count = size[rows] - length + 1
    row = np.repeat(rows, count)                # a string lies within its row
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + offsets[row]
    anchor = (least[start] & mask).astype(np.int64)
    new = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(row) else none
    last = np.append(new[1:], len(row)) - 1 if len(row) else none
    return row[new], start[new], start[last], anchor[new], ts.mix64(h[anchor[new]]), prefix


def _anchor_counts(docs: DataFrame, text: str, length: int) -> DataFrame:
    """(anchor) hashes that occur more than once."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, offsets in ts.text_chunks(b.column(0)):
                g, n = np.unique(_anchors(data, offsets, length)[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ts.as_long(g)), pa.array(n)], names=["anchor", "n"])

    return (docs.select(text).mapInArrow(scan, "anchor long, n long")
                .groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1"))


def _text_key(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _hashes(data: np.ndarray, prefix: np.ndarray, first: np.ndarray, last: np.ndarray, length: int):
    """Two hashes of the bytes of each block."""
    if not len(first):
        return np.zeros(0, dtype=ts.U), np.zeros(0, dtype=ts.U)
    return (ts.FIRST.spans(prefix, first, last + length),
            ts.SECOND.spans(ts.SECOND.prefix(data), first, last + length))


def _place_hash(text_key: np.ndarray, place: np.ndarray) -> np.ndarray:
    return ts.mix64(text_key + ts.mix64(place.astype(ts.U)))


def _block_classes(docs: DataFrame, anchors: np.ndarray, text: str, length: int) -> DataFrame:
    """(b1, b2, anchor, n, place): the different blocks whose anchor passes
    the bitmap, how often each occurs, and the hash of one of its places."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(1).to_numpy(zero_copy_only=False).view(ts.U)
            for lo, hi, data, offsets in ts.text_chunks(b.column(0)):
                row, first, last, _, g, prefix = _anchors(data, offsets, length)
                keep = in_bitmap(anchors, g)
                row, first, last, g = row[keep], first[keep], last[keep], g[keep]
                b1, b2 = _hashes(data, prefix, first, last, length)
                place = _place_hash(keys[lo:hi][row], first - offsets[row])
                # equal blocks of the chunk, as in periodic text, count together
                _, at, n = np.unique(np.column_stack([b1, b2]).view("V16").reshape(-1), return_index=True,
                                     return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(ts.as_long(x[at])) for x in (b1, b2, g)), pa.array(n), pa.array(ts.as_long(place[at]))],
                    names=["b1", "b2", "anchor", "n", "place"])

    found = docs.select(text, _text_key(text).alias("k")).mapInArrow(
        scan, "b1 long, b2 long, anchor long, n long, place long")
    return found.groupBy("b1", "b2").agg(F.sum("n").alias("n"), F.min("anchor").alias("anchor"),
                                         F.min("place").alias("place"))


def _marked_blocks(docs: DataFrame, anchors: np.ndarray, whole: np.ndarray, doubt: np.ndarray, bodies: np.ndarray,
                   doc_id: str, text: str, length: int) -> DataFrame:
    """(doc_id, text_key, lo, hi, b1, b2, at, body): runs of starts of
    repeated blocks (b1 null), blocks in doubt (body null), and the bytes of
    the blocks whose place passes the bitmap."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(2).to_numpy(zero_copy_only=False).view(ts.U)
            for lo, hi, data, offsets in ts.text_chunks(b.column(1)):
                row, first, last, anchor, g, prefix = _anchors(data, offsets, length)
                # the same blocks as were counted: only of those does ``doubt`` know the single ones
                row, first, last, anchor = (x[in_bitmap(anchors, g)] for x in (row, first, last, anchor))
                b1, b2 = _hashes(data, prefix, first, last, length)
                maybe = in_bitmap(whole, b1)
                unsure = np.flatnonzero(maybe & in_bitmap(doubt, b2))
                sure = maybe.copy()
                sure[unsure] = False
                edge = np.flatnonzero(np.diff(np.concatenate([[0], sure.view(np.int8), [0]])))
                cut = np.flatnonzero(sure[1:] & sure[:-1] & (first[1:] != last[:-1] + 1)) + 1   # a gap ends a run
                head = np.union1d(edge[::2], cut)
                tail = np.union1d(edge[1::2], cut) - 1
                member = np.flatnonzero(in_bitmap(bodies, _place_hash(keys[lo:hi][row], first - offsets[row])))
                raw = data.tobytes()
                body = [raw[x:y] for x, y in zip(first[member].tolist(), (last[member] + length).tolist())]
                a, z = np.concatenate([head, unsure, member]), np.concatenate([tail, unsure, member])
                r, none = pa.array(row[a]), np.arange(len(a)) < len(head)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo).take(r), b.column(2).slice(lo, hi - lo).take(r),
                     pa.array(first[a] - offsets[row[a]]), pa.array(last[z] - offsets[row[a]]),
                     pa.array(ts.as_long(b1[a]), mask=none), pa.array(ts.as_long(b2[a]), mask=none),
                     pa.array(anchor[a] - first[a]), pa.array([None] * (len(head) + len(unsure)) + body, pa.binary())],
                    names=["doc_id", "text_key", "lo", "hi", "b1", "b2", "at", "body"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), _text_key(text).alias("text_key"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(scan, f"doc_id {kind}, text_key long, lo long, hi long, b1 long, b2 long, at long, body binary")


def sort_bucket(bodies: list[bytes], at: np.ndarray, length: int) -> np.ndarray:
    """Sorts the suffixes of a bucket to the depth ``length`` and returns, for
    every start of every block in order, whether an equal string starts at
    another.  ``at`` is the place of the anchor in each block; the strings of
    a block start at 0 .. len(body) - length."""
    sizes = np.array([len(x) for x in bodies], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    count = sizes - length + 1
    block = np.repeat(np.arange(len(bodies)), count)
    start = np.arange(len(block)) - np.repeat(np.cumsum(count) - count, count)
    ahead = at[block] - start                   # equal strings have the anchor equally far ahead
    pos = base[block] + start
    # the cover sample: from each start the next position a multiple of STEP before the anchor
    delta = ahead % STEP
    sample = pos + delta
    depth = length - STEP                       # reaches from any delta to the tail, and never past it
    places, which = np.unique(sample, return_inverse=True)
    rank = np.unique(_pieces(data, places, depth), return_inverse=True)[1].reshape(-1)[which]
    key = np.zeros(len(pos), dtype=[("ahead", np.int64), ("head", f"V{STEP}"), ("rank", np.int64),
                                    ("tail", f"V{STEP}")])
    key["ahead"], key["rank"] = ahead, rank
    key["head"], key["tail"] = _pieces(data, pos, STEP), _pieces(data, pos + length - STEP, STEP)
    rows = key.view(f"V{key.dtype.itemsize}")
    _, group, n = np.unique(rows, return_inverse=True, return_counts=True)
    return n[group.reshape(-1)] > 1


def _pieces(data: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes from each place as opaque values that compare by byte."""
    if not len(places):
        return np.zeros(0, dtype=f"V{size}")
    view = np.lib.stride_tricks.sliding_window_view(data, size)
    return np.ascontiguousarray(view[places]).view(f"V{size}").reshape(-1)


def _sort_groups(length: int):
    """Runs of repeated starts (doc_id, text_key, lo, hi) of the groups (g1, g2), each held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def flush() -> pa.RecordBatch:
            twice = sort_bucket([r["body"] for r in held], np.array([r["at"] for r in held]), length)
            out, i = {k: [] for k in _RUN}, 0
            for r in held:
                mine = twice[i:i + len(r["body"]) - length + 1]
                i += len(mine)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]])))
                for a, z in zip(edges[::2].tolist(), (edges[1::2] - 1).tolist()):
                    for k, v in zip(_RUN, (r["doc_id"], r["text_key"], r["lo"] + a, r["lo"] + z)):
                        out[k].append(v)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(out[k], kind[0] if k == "doc_id" else pa.int64()) for k in _RUN], names=_RUN)

        kind = [None]
        for b in batches:
            kind[0] = b.schema.field("doc_id").type
            for r in b.to_pylist():
                if held and (r["g1"], r["g2"]) != (held[0]["g1"], held[0]["g2"]):
                    yield flush()
                held.append(r)
        if held:
            yield flush()

    return run


def _digest(*parts) -> tuple[int, int]:
    h = hashlib.blake2b(digest_size=16)
    for x in parts:
        h.update(x if isinstance(x, bytes) else struct.pack("<q", x))
    return struct.unpack("<qq", h.digest())


def _split_groups(length: int):
    """Both halves of the range ``near .. far`` of distances from start to anchor:
    of each block the bytes of its strings in the half, keyed by the bytes that
    all strings of the half share, and a hash (s1, s2) that equal rows share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[dict] = []
            for r in b.to_pylist():
                body, at, mid = r["body"], r["at"], (r["near"] + r["far"]) // 2
                least = at - (len(body) - length)       # the block's own distances are least .. at
                for near, far in ((r["near"], mid), (mid + 1, r["far"])):
                    lo, hi = max(near, least), min(far, at)
                    if lo > hi:
                        continue
                    own = body[at - hi:at - lo + length]
                    g1, g2 = _digest(r["g1"], r["g2"], near, body[at - near:at - far + length])
                    s1, s2 = _digest(g1, g2, hi, own)
                    start = r["lo"] + at - hi
                    out.append({**r, "g1": g1, "g2": g2, "near": near, "far": far, "at": hi, "body": own,
                                "lo": start, "hi": start + hi - lo, "s1": s1, "s2": s2})
            schema = b.schema.append(pa.field("s1", pa.int64())).append(pa.field("s2", pa.int64()))
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _solve(groups: DataFrame, length: int, name: str) -> DataFrame:
    kind = groups.schema["doc_id"].dataType.simpleString()
    rows = groups.select("g1", "g2", "at", "doc_id", "text_key", "lo", "body")
    return reliable_checkpoint(rows.repartition("g1", "g2").sortWithinPartitions("g1", "g2").mapInArrow(
        _sort_groups(length), f"doc_id {kind}, text_key long, lo long, hi long"), name)


def _sort_large(rows: DataFrame, length: int, part_blocks: int) -> list[DataFrame]:
    """Repeated starts of the buckets ``rows`` (g1, g2, near, far, at, doc_id,
    text_key, lo, hi, body) that are too large for one task."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    fields = (f"g1 long, g2 long, near int, far int, at long, doc_id {kind}, text_key long, lo long, hi long, body binary, "
              "s1 long, s2 long")
    out = []
    for _ in range(length.bit_length()):
        halves = reliable_checkpoint(rows.mapInArrow(_split_groups(length), fields), "halves")
        # equal rows repeat in full; one of them stays, for what it shares with the others of its group
        equal = halves.groupBy("s1", "s2").agg(F.count("*").alias("n")).filter("n > 1")
        out.append(reliable_checkpoint(halves.join(equal, ["s1", "s2"], "left_semi").select(*_RUN), "sorted"))
        size = reliable_checkpoint(halves.select("g1", "g2", "s1", "s2").distinct().groupBy("g1", "g2").agg(
            F.count("*").alias("n")).filter("n > 1"), "sizes")
        kept = reliable_checkpoint(halves.dropDuplicates(["s1", "s2"]).drop("s1", "s2").join(size, ["g1", "g2"]), "groups")
        out.append(_solve(kept.filter(F.col("n") <= part_blocks), length, "sorted"))
        rows = kept.filter(F.col("n") > part_blocks).drop("n")
        if rows.isEmpty():
            break
    return out


def repeated_starts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                    part_blocks: int = PART_BLOCKS) -> DataFrame:
    """(doc_id, text_key, lo, hi): starts of the repeated strings, as ranges."""
    anchors = bitmap(_anchor_counts(docs, text, length), "anchor")
    classes = reliable_checkpoint(_block_classes(docs, anchors, text, length), "classes")
    whole = classes.filter("n > 1")
    seen = bitmap(whole, "b1")
    doubt = bitmap(passing(classes.filter("n = 1"), "b1", seen), "b2")
    # a bucket: the different blocks around one anchor, with at least one that is not repeated in full
    buckets = reliable_checkpoint(classes.groupBy("anchor").agg(F.count("*").alias("m"), F.min("n").alias("least")).filter(
        "m > 1 AND least = 1").select("anchor", "m"), "buckets")
    members = reliable_checkpoint(passing(classes, "anchor", bitmap(buckets, "anchor")).join(buckets, "anchor"), "members")
    marked = reliable_checkpoint(
        _marked_blocks(docs, anchors, seen, doubt, bitmap(members, "place"), doc_id, text, length), "marked")
    runs = marked.filter("b1 IS NULL").select(*_RUN)
    unsure = marked.filter("b1 IS NOT NULL AND body IS NULL").join(whole.select("b1", "b2"), ["b1", "b2"], "left_semi")

    bodies = marked.filter("body IS NOT NULL").dropDuplicates(["b1", "b2"])

    def blocks(of: DataFrame) -> DataFrame:
        return bodies.join(of.select("b1", "b2", "anchor"), ["b1", "b2"]).select(
            F.col("anchor").alias("g1"), F.lit(0).cast("long").alias("g2"), F.lit(0).alias("near"),
            F.lit(length - length // 2).alias("far"), "at", *_RUN, "body")

    found = [runs, unsure.select(*_RUN), _solve(blocks(members.filter(F.col("m") <= part_blocks)), length, "sorted")]
    large = members.filter(F.col("m") > part_blocks)
    if not large.isEmpty():
        found += _sort_large(blocks(large), length, part_blocks)
    return functools.reduce(DataFrame.unionByName, found)


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
                     part_blocks: int = PART_BLOCKS) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept (binary): the size
    of each text in UTF-8, the bytes covered by repeated strings, the number
    of maximal removed runs, and the remaining bytes.

    Null and empty texts have 0 bytes; texts shorter than ``length`` lose
    nothing.  Strings are judged on the input: of equal texts both lose their
    repeated bytes, and rows that repeat both id and text are two texts.
    Other columns pass through (columns with the names of the new ones are
    replaced); an empty table stays empty.
    """
    at, at_id, at_key, key = fresh(docs, "_starts", "_starts_id", "_starts_key", "_text_key")
    starts = (repeated_starts(docs, doc_id, text, length, part_blocks)
              .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("lo", "hi")).alias(at))
              .select(F.col("doc_id").alias(at_id), F.col("text_key").alias(at_key), at))
    keyed = docs.withColumn(key, _text_key(text))
    joined = keyed.join(starts, F.col(doc_id).eqNullSafe(F.col(at_id)) & (F.col(key) == F.col(at_key)),
                      "left").drop(at_id, at_key, key)

    def compute(batch: pa.RecordBatch):
        sizes, removed, spans, kept = [], [], [], []
        lists = batch.column(at)
        for i, t in enumerate(batch.column(text)):
            raw = (t.as_py() or "").encode()
            n = k = 0
            if lists[i].is_valid:
                own = np.array([(x["lo"], x["hi"] + length) for x in lists[i].as_py()], dtype=np.int64)
                own = own[np.argsort(own[:, 0], kind="stable")]
                reach = np.maximum.accumulate(own[:, 1])
                new = np.append(True, own[1:, 0] > reach[:-1])
                first = own[new, 0]
                end = np.append(reach[np.flatnonzero(new)[1:] - 1], reach[-1])
                n, k = int((end - first).sum()), len(first)
                rest, pos = [], 0
                for a, z in zip(first.tolist(), end.tolist()):
                    rest.append(raw[pos:a])
                    pos = z
                kept.append(b"".join([*rest, raw[pos:]]))
            else:
                kept.append(raw)
            sizes.append(len(raw))
            removed.append(n)
            spans.append(k)
        return [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                pa.array(kept, pa.binary())]

    return append_columns(joined, [("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"),
                                   ("kept", "binary")], compute).drop(at)


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the
    remaining bytes of every document."""
    out = dedup_substrings(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
