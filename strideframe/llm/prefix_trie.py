"""Conversation prefix trie: every shared beginning of conversations as a node.

Conversations are sequences of turns; a node is a distinct sequence of first
turns, its members are the conversations that start with it.

1. A turn becomes a 16-byte key (MD5 of role and text), a conversation the
   concatenation of its keys.  In the order of these sequences the members of
   a node stand together, and a prefix stands before what extends it.
2. The sequences are range-partitioned and sorted by (sequence, id); with the
   id in the range key even equal conversations spread over partitions.
3. Each partition takes the lengths of the common prefixes (LCP) of
   neighbours and a sparse table of their minima over power-of-two spans.
   Every candidate prefix (row, depth) binary-searches its left and right
   extent in it, independently of all others.  Members, leaves and saved words
   of the interval [l, r] are differences of prefix sums, the smallest id a
   range minimum.
4. Only nodes that touch the first or last row of a partition can go on in
   another one.  They carry a digest of their prefix and are summed up over
   partitions, with what the pairs of rows at the borders add (one small row
   per partition).  All others are final where they were found.

One conversation's keys and word counts stand in one row, and a partition
(about ``TURNS_PER_PARTITION`` turns) is worked on whole; nothing else is
gathered.  The ids that end at a touching node are hashed as a stream of
pieces in order: a SHA-256 cannot be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strideframe.llm.common import read_table, reliable_checkpoint

KEY = 16
TURNS_PER_PARTITION = 250_000
#: Ids in a piece of a touching node's list of ends.
ENDS_PIECE = 4_096
#: Conversations whose ids have the same quotient by this share a beginning in the query.
REBUILD_GROUP, REBUILD_TURNS = 20, 4

_NODE = ("kind int, part int, depth long, digest binary, touches boolean, conv_id long, parent_conv_id long, "
         "parent_digest binary, n_convs long, n_children long, n_leaves long, saved_tokens long, turn_key binary, "
         "ends string, piece long, first_key binary, first_words array<long>, last_key binary")
_NAMES = [c.strip().split()[0] for c in _NODE.split(",")]
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def lcp(a: bytes, b: bytes) -> int:
    """Number of common first keys of two sequences."""
    m = min(len(a), len(b))
    if a[:m] == b[:m]:
        return m // KEY
    lo, hi = 0, m // KEY
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[KEY * lo:KEY * mid] == b[KEY * lo:KEY * mid]:
            lo = mid
        else:
            hi = mid
    return lo


class SparseTable:
    """Minima of all spans of 2**k values, k = 0, 1, ..."""

    def __init__(self, values: np.ndarray):
        self.n, self.levels = len(values), [values]
        while 2 << (len(self.levels) - 1) <= self.n:
            v, half = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(v[:-half], v[half:]))

    def minimum(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Least value of each span lo..hi (both included)."""
        k = np.floor(np.log2(hi - lo + 1)).astype(np.int64)
        out = np.empty(len(lo), dtype=self.levels[0].dtype)
        for level in np.unique(k):
            at = k == level
            out[at] = np.minimum(self.levels[level][lo[at]], self.levels[level][hi[at] - (1 << level) + 1])
        return out

    def right(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Last row reached from ``row`` over values >= depth."""
        pos = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(pos + (1 << k) < self.n)
            go = fits[self.levels[k][pos[fits] + 1] >= depth[fits]]
            pos[go] += 1 << k
        return pos

    def left(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """First row from which ``row`` is reached over values >= depth."""
        pos = row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = np.flatnonzero(pos + 1 - (1 << k) >= 0)
            go = fits[self.levels[k][pos[fits] + 1 - (1 << k)] >= depth[fits]]
            pos[go] -= 1 << k
        return pos


def _prefix_digests(key: bytes, depth: int) -> list[bytes]:
    """A digest of each prefix of 0 to ``depth`` turns."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for at in range(0, KEY * depth, KEY):
        h.update(key[at:at + KEY])
        out.append(h.digest())
    return out


def _binary(values, n: int | None = None) -> pa.Array:
    return pa.array(values, pa.binary()) if values is not None else pa.nulls(n, pa.binary())


def _batch(n: int, **columns) -> pa.RecordBatch:
    """A batch of the node schema; columns not given are null."""
    kinds = {"digest": pa.binary(), "parent_digest": pa.binary(), "turn_key": pa.binary(), "first_key": pa.binary(),
             "last_key": pa.binary(), "ends": pa.string(), "touches": pa.bool_(), "kind": pa.int32(), "part": pa.int32(),
             "first_words": pa.list_(pa.int64())}
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, kinds.get(c, pa.int64()))) for c in _NAMES], names=_NAMES)


def _partition_nodes(keys: list[bytes], ids: np.ndarray, words: np.ndarray, size: np.ndarray,
                     part: int) -> Iterator[pa.RecordBatch]:
    """Nodes of sorted sequences: ``size`` turns each, their words one after another in ``words``."""
    n = len(keys)
    first = np.cumsum(size) - size                      # of each row in words
    total = np.concatenate([[0], np.cumsum(words)])     # words before a turn
    common = np.full(n, -1, dtype=np.int64)
    common[1:] = [lcp(keys[i - 1], keys[i]) for i in range(1, n)]
    table, smallest = SparseTable(common), SparseTable(ids)

    # candidates: each row's prefixes that the row before does not have
    new = size - common
    row = np.repeat(np.arange(n), new)
    start = np.cumsum(new) - new
    depth = np.arange(len(row)) - start[row] + common[row] + 1
    lo, hi = table.left(row, depth), table.right(row, depth)

    def node_of(at: np.ndarray, d: np.ndarray) -> np.ndarray:
        """The node of the first d turns of each row."""
        head = table.left(at, d)
        return start[head] + d - common[head] - 1

    conv = smallest.minimum(lo, hi)
    shared = np.zeros(n, dtype=np.int64)                # words that a row shares with the one before
    shared[1:] = total[first[1:] + common[1:]] - total[first[1:]]
    shared = np.cumsum(shared)
    own = total[first[lo] + np.maximum(depth - 1, 0)] - total[first[lo]]
    saved = shared[hi] - shared[lo] - (hi - lo) * own
    leaf = np.append(common[1:] < size[:-1], True)
    leaves = np.concatenate([[0], np.cumsum(leaf)])
    has_parent = np.flatnonzero(depth > 0)
    parent = np.full(len(row), -1, dtype=np.int64)
    parent[has_parent] = node_of(row[has_parent], depth[has_parent] - 1)
    children = np.bincount(parent[has_parent], minlength=len(row))
    touches = (lo == 0) | (hi == n - 1)

    ends_at = node_of(np.arange(n), size)               # rows of one node are neighbours, ids ascending
    cut = np.flatnonzero(np.append(True, ends_at[1:] != ends_at[:-1]))
    ends, pieces = [_EMPTY_SHA] * len(row), []
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), n]):
        k = int(ends_at[a])
        if touches[k]:
            pieces += [(k, p // ENDS_PIECE, ",".join(map(str, ids[a + p:min(b, a + p + ENDS_PIECE)].tolist())))
                       for p in range(0, b - a, ENDS_PIECE)]
        else:
            ends[k] = hashlib.sha256(",".join(map(str, ids[a:b].tolist())).encode()).hexdigest()

    digest: list[bytes | None] = [None] * len(row)
    known = [_prefix_digests(keys[i], int(size[i])) for i in (0, -1)]
    for k in np.flatnonzero(touches).tolist():      # beginnings of the first or of the last row
        digest[k], ends[k] = known[int(lo[k] > 0)][depth[k]], None
    turn_key = [keys[r][KEY * (d - 1):KEY * d] if d else None for r, d in zip(row.tolist(), depth.tolist())]
    open_parent = [digest[p] if p >= 0 else None for p in parent.tolist()]
    const = lambda v, m: pa.array(np.full(m, v, dtype=np.int32))
    m = len(row)
    yield _batch(m, kind=const(0, m), part=const(part, m), depth=pa.array(depth), digest=_binary(digest),
                 touches=pa.array(touches), conv_id=pa.array(conv), parent_conv_id=pa.array(conv[parent], mask=parent < 0),
                 parent_digest=_binary(open_parent), n_convs=pa.array(hi - lo + 1), n_children=pa.array(children),
                 n_leaves=pa.array(leaves[hi + 1] - leaves[lo]), saved_tokens=pa.array(saved), turn_key=_binary(turn_key),
                 ends=pa.array(ends, pa.string()))
    yield _batch(1, kind=const(1, 1), part=const(part, 1), first_key=_binary([keys[0]]), last_key=_binary([keys[-1]]),
                 first_words=pa.array([words[:size[0]].tolist()], pa.list_(pa.int64())))
    m = len(pieces)
    if m:
        k = [p[0] for p in pieces]
        yield _batch(m, kind=const(2, m), part=const(part, m), depth=pa.array(depth[k]), digest=_binary([digest[i] for i in k]),
                     piece=pa.array([p[1] for p in pieces], pa.int64()), ends=pa.array([p[2] for p in pieces], pa.string()))


def _find_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, ids, words, size = [], [], [], []
    for b in batches:
        keys += b.column(0).to_pylist()
        ids.append(b.column(1).to_numpy(zero_copy_only=False))
        words.append(b.column(2).flatten().to_numpy(zero_copy_only=False))
        size.append(b.column(2).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    if keys:
        yield from _partition_nodes(keys, np.concatenate(ids), np.concatenate(words).astype(np.int64),
                                    np.concatenate(size), TaskContext.get().partitionId())


def _border_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the last row of a partition and the first row of the next add to
    the nodes of their common prefixes, which both partitions have counted."""
    for b in batches:
        for prev, key, words in zip(*(b.column(i).to_pylist() for i in range(3))):
            both = lcp(prev, key)
            cum = np.concatenate([[0], np.cumsum(np.array(words[:both], dtype=np.int64))])
            d = np.arange(both + 1)
            yield _batch(both + 1, depth=pa.array(d), digest=_binary(_prefix_digests(key, both)),
                         n_convs=pa.array(np.zeros(both + 1, dtype=np.int64)),
                         saved_tokens=pa.array(cum[both] - cum[np.maximum(d - 1, 0)]),
                         n_children=pa.array(-(d < both).astype(np.int64)),
                         n_leaves=pa.array(np.full(both + 1, -int(len(prev) // KEY <= both), dtype=np.int64)))


def _ends_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, digest, ends): SHA-256 of each node's pieces, which come one after another."""
    node, state = None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([node[0]], pa.int64()), _binary([node[1]]),
                                           pa.array([state.hexdigest()])], names=["depth", "digest", "ends"])

    for b in batches:
        for d, g, text in zip(*(b.column(i).to_pylist() for i in range(3))):
            if (d, g) != node:
                if node is not None:
                    yield done()
                node, state = (d, g), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
    if node is not None:
        yield done()


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes for a turn; null role or text counts as empty."""
    r, t = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.md5(F.concat_ws(":", F.octet_length(r).cast("string"), r, t)))


def word_count(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sequences(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation as array<struct<key,
    words>>, by turn number (null first; equal numbers by key; rows that
    repeat stay turns of their own).  Rows without an id belong to no
    conversation and are left out."""
    t = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), turn_key(F.col(role), F.col(text)).alias("key"),
                 word_count(F.col(text)).alias("words")).alias("x"))
    return t.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: F.struct(
        x["key"].alias("key"), x["words"].alias("words"))).alias("turns"))


def prefix_trie(convs: DataFrame) -> DataFrame:
    """The nodes of sequences (conv_id, turns) as ``sequences`` makes them,
    ids distinct.

    Per node: conv_id (smallest member), depth, turn_key (last turn; null for
    the root), parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256 of the ids of the members that end
    there.  A null array counts as no turns.  Without any conversation there
    is no node, not even a root.
    """
    spark = convs.sparkSession
    turns = F.coalesce("turns", F.expr("CAST(array() AS array<struct<key: binary, words: bigint>>)"))
    seq = reliable_checkpoint(convs.select(
        F.aggregate(turns, F.lit(b""), lambda a, x: F.concat(a, x["key"])).alias("key"), "conv_id",
        F.transform(turns, lambda x: x["words"]).alias("words")), "sequences")
    size = seq.agg(F.sum(F.size("words") + 1).alias("n")).first().n or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TURNS_PER_PARTITION))
    ranged = seq.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    found = reliable_checkpoint(ranged.mapInArrow(_find_nodes, _NODE), "nodes")

    border = found.filter("kind = 1").select("part", "first_key", "first_words", "last_key")
    pairs = (border.withColumn("prev", F.lag("last_key").over(Window.orderBy("part"))).filter("prev IS NOT NULL")
                   .select("prev", "first_key", "first_words"))
    sums = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    touching = found.filter("kind = 0 AND touches").unionByName(pairs.mapInArrow(_border_rows, _NODE))
    merged = touching.groupBy("depth", "digest").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_digest").alias("parent_digest"),
        F.max("turn_key").alias("turn_key"), *[F.sum(c).alias(c) for c in sums])
    ends = (found.filter("kind = 2").select("depth", "digest", "ends", "part", "piece")
                 .repartition("depth", "digest").sortWithinPartitions("depth", "digest", "part", "piece")
                 .select("depth", "digest", "ends").mapInArrow(_ends_digests, "depth long, digest binary, ends string"))
    merged = reliable_checkpoint(merged.join(ends, ["depth", "digest"], "left")
                                       .withColumn("ends", F.coalesce("ends", F.lit(_EMPTY_SHA))), "touching")

    cols = ["conv_id", "depth", "turn_key", "parent_conv_id", *sums, F.col("ends").alias("ends_sha256")]
    inner = found.filter("kind = 0 AND NOT touches")
    up = merged.select((F.col("depth") + 1).alias("depth"), F.col("digest").alias("parent_digest"),
                       F.col("conv_id").alias("parent_conv_id"))
    loose = inner.filter("parent_digest IS NOT NULL").drop("parent_conv_id").select(
        "depth", "parent_digest", "conv_id", "turn_key", *sums, "ends").unionByName(
        merged.select("depth", "parent_digest", "conv_id", "turn_key", *sums, "ends"))
    return (inner.filter("parent_digest IS NULL").select(*cols)
            .unionByName(loose.join(up, ["depth", "parent_digest"], "left").select(*cols)))


def node_turns(nodes: DataFrame, conversations: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """``nodes`` with the role and text of each one's last turn (null for the root)."""
    known = conversations.select(turn_key(F.col(role), F.col(text)).alias("turn_key"),
                                 F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    return nodes.join(known.groupBy("turn_key").agg(F.first("role").alias("role"), F.first("text").alias("text")),
                      "turn_key", "left")


def rebuilt(convs: DataFrame) -> DataFrame:
    """Sequences with beginnings shared on purpose: the first h turns of the
    conversation that opens the group of ids (all if fewer, none if absent),
    then the own turns after the first h; h = crc32(id as text) % 4."""
    h = (F.crc32(F.col("conv_id").cast("string")) % REBUILD_TURNS).cast("int")
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(REBUILD_GROUP))
    opening = convs.filter(F.pmod("conv_id", F.lit(REBUILD_GROUP)) == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, REBUILD_TURNS - 1).alias("opening"))
    none = F.slice("turns", 1, 0)
    return convs.withColumn("base", base).join(opening, "base", "left").select(
        "conv_id", F.concat(F.coalesce(F.slice("opening", F.lit(1), h), none),
                            F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Query: every node of the rebuilt conversations."""
    convs = reliable_checkpoint(sequences(read_table(spark, sf_dir, "conversations")), "conversations")
    return prefix_trie(rebuilt(convs)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                              "saved_tokens", "ends_sha256")
