"""MinHash near-duplicates by a multi-index Hamming join.

A document's set holds its distinct word shingles.  Its signature has
``chunks * lanes`` lanes, each the low ``BITS`` bits of a minimum hash; two
signatures are as far apart as lanes differ.  By the pigeonhole principle a
pair at most ``chunks * (errors + 1) - 1`` lanes apart has a chunk with at most
``errors`` differing lanes, so every chunk is indexed once for each choice of
``errors`` lanes left out (the enumerated errors): all pairs within that
distance share an index key.  With the defaults a pair of similarity 0.8 is
missed with probability 2e-6.

* Documents with equal sets are one class; signatures are joined per class.
* Pairs are not enumerated inside an index group: first each group's members
  are compared with one of them (see ``linked_components``).  Groups that then
  still hold several components, texts that share much but not enough, are
  joined exactly on the rarest members of their sets (prefix, length and
  positional filters), which leaves out almost all pairs below the similarity.
* A pair is linked only if the full sets reach the similarity.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strideframe.llm import textscan as ts
from strideframe.llm.common import bitmap, fresh, in_bitmap, passing, read_table, reliable_checkpoint
from strideframe.llm.graph import linked_components

BITS = 12


@dataclass(frozen=True)
class Index:
    chunks: int = 10
    lanes: int = 5
    errors: int = 1

    @property
    def distance(self) -> int:
        """All pairs of signatures at most this far apart become candidates."""
        return self.chunks * (self.errors + 1) - 1


def _sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles of each row, ordered by row and hash."""
    low = ts.LOWER[data]
    s, e = ts.runs(ts.NONSPACE[low], offsets)
    h = ts.FIRST.spans(ts.FIRST.prefix(low), s, e)
    first, row = ts.rows_of(s, offsets)
    n = max(0, len(h) - shingle + 1)
    g = np.full(n, 17, dtype=ts.U)
    for k in range(shingle):
        g = ts.mix64(g * ts.U(0x100000001B3) + h[k:k + n])
    whole = row[:n] == row[shingle - 1:]
    g, r = g[whole], row[:n][whole]
    count = np.diff(first)
    for i in np.flatnonzero((count > 0) & (count < shingle)):   # the whole sequence as one shingle
        x = np.full(1, 17 + count[i], dtype=ts.U)
        for k in range(first[i], first[i + 1]):
            x = ts.mix64(x * ts.U(0x100000001B3) + h[k])
        g, r = np.append(g, x), np.append(r, i)
    order = np.lexsort((g, r))
    g, r = g[order], r[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    return g[new], r[new]


def signatures(docs: DataFrame, shingle: int, index: Index, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, lanes): s1 and s2 identify the set (sums
    of two hashes of its members), lanes is the signature; null for an empty set."""
    lanes = index.chunks * index.lanes
    factor = ts.mix64(np.arange(1, lanes + 1, dtype=ts.U)) | ts.U(1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, data, offsets in ts.text_chunks(b.column(1)):
                g, r = _sets(data, offsets, shingle)
                n = np.bincount(r, minlength=hi - lo)
                first = np.concatenate([[0], np.cumsum(n)])
                s1, s2 = ts.sums(g, first), ts.sums(ts.mix64(g + ts.U(1)), first)
                some = np.flatnonzero(n)
                sig = np.zeros((len(some), lanes), dtype=np.uint16)
                if len(some):
                    for k in range(lanes):
                        low = np.minimum.reduceat((g * factor[k]) >> ts.U(16), first[some])
                        sig[:, k] = (ts.mix64(low) & ts.U((1 << BITS) - 1)).astype(np.uint16)
                packed = np.full(hi - lo, None, dtype=object)
                packed[some] = [x.tobytes() for x in sig]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(ts.as_long(s1)),
                     pa.array(ts.as_long(s2)), pa.array(packed, pa.binary())],
                    names=["doc_id", "n_shingles", "s1", "s2", "lanes"])

    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"))
    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(scan, f"doc_id {kind}, n_shingles long, s1 long, s2 long, lanes binary")


def index_keys(classes: DataFrame, index: Index) -> DataFrame:
    """(g, node) for every class, chunk and choice of lanes left out."""
    kept = list(itertools.combinations(range(index.lanes), index.lanes - index.errors))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype=np.uint16).astype(ts.U)
            sig = sig.reshape(b.num_rows, index.chunks, index.lanes)
            out = np.empty((b.num_rows, index.chunks, len(kept)), dtype=ts.U)
            for j, cols in enumerate(kept):
                v = np.full(sig.shape[:2], j, dtype=ts.U) + np.arange(index.chunks, dtype=ts.U) * ts.U(len(kept))
                for c in cols:
                    v = ts.mix64(v * ts.U(0x100000001B3) + sig[:, :, c])
                out[:, :, j] = v
            per = index.chunks * len(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ts.as_long(out.reshape(-1))), b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), per)))],
                names=["g", "node"])

    src = classes.select("node", "lanes")
    return src.mapInArrow(keys, f"g long, node {src.schema['node'].dataType.simpleString()}")


def shared_groups(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` (g, ...) whose group g has two rows or more, with
    their number n.  The groups are found by a count; a fixed-size bitmap of
    them thins the rows before the join."""
    many = reliable_checkpoint(keys.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1"), "groups")
    return passing(keys, "g", bitmap(many, "g")).join(many, "g")


def _class_sets(docs: DataFrame, shingle: int, wanted: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """(node, s1, s2, members): full sets of the rows whose id passes the bitmap."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(in_bitmap(wanted, b.column(2).to_numpy(zero_copy_only=False).view(ts.U))))
            for lo, hi, data, offsets in ts.text_chunks(b.column(1)):
                g, r = _sets(data, offsets, shingle)
                first = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=hi - lo))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(ts.as_long(ts.sums(g, first))),
                     pa.array(ts.as_long(ts.sums(ts.mix64(g + ts.U(1)), first))),
                     pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ts.as_long(g)))],
                    names=["node", "s1", "s2", "members"])

    src = docs.select(F.col(doc_id).alias("node"), F.col(text).alias("t"), F.xxhash64(doc_id).alias("h"))
    kind = src.schema["node"].dataType.simpleString()
    return src.mapInArrow(scan, f"node {kind}, s1 long, s2 long, members array<long>")


def _prefix_pairs(nodes: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of nodes (node, r, members) with different r that hold
    every pair of the similarity, by an exact prefix-filtered set join.

    Members are ordered by the number of sets that hold them, rarest first.
    Two sets x and y, x the larger, that need an overlap of o share one of the
    first |x| - o + 1 members of x and |y| - o + 1 of y; the place of the first
    shared one bounds the overlap.  Members that no other set holds take the
    first places and need no sort."""
    t = similarity / 100
    each = nodes.select("node", "r", F.size("members").alias("n"), F.explode("members").alias("m"))
    held = each.groupBy("m").agg(F.count("*").alias("k")).filter("k > 1")
    shared = reliable_checkpoint(each.join(held, "m"), "shared")
    # places of the members held by one set only come first
    alone = shared.groupBy("node", "n").agg(F.count("*").alias("s")).select(
        "node", (F.col("n") - F.col("s")).alias("alone")).filter(
        F.col("alone") <= F.col("n") - F.ceil(t * F.col("n") - 1e-9))
    order = Window.partitionBy("node").orderBy("k", "m")
    prefix = reliable_checkpoint(
        shared.join(alone, "node").withColumn("at", F.col("alone") + F.row_number().over(order) - 1)
        .filter(F.col("at") <= F.col("n") - F.ceil(t * F.col("n") - 1e-9)).select("m", "node", "r", "n", "at"), "prefix")
    main = prefix.groupBy("m").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).filter("lo < hi").select("m", "lo")
    # one of a pair is outside the smallest component of the member's sets
    out = prefix.join(main, "m").filter("r <> lo").select(
        "m", F.col("node").alias("a"), F.col("r").alias("ra"), F.col("n").alias("na"), F.col("at").alias("ia"))
    need = F.ceil(t / (1 + t) * (F.col("n") + F.col("na")) - 1e-9)
    return (prefix.withColumnRenamed("node", "b").join(out, "m")
                  .filter((F.col("ra") != F.col("r"))
                          & (F.least("n", "na") * 100 >= F.greatest("n", "na") * similarity)
                          & (F.col("n") - F.col("at") >= need) & (F.col("na") - F.col("ia") >= need))
                  .select("a", "b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5,
                    similarity: int = 80, index: Index = Index()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= ``similarity`` * union of
    their full shingle sets (words between white space, A-Z in lower case); a
    text of fewer words than a shingle is one shingle; without words or text
    the set is empty and the document linked with nothing.  component_id is
    the smallest doc_id reachable over links.  Rows with a null doc_id stay
    alone (component_id null, kept true); rows that repeat a doc_id each give
    a row and count as one document for links.  Other columns are not read; an
    empty table gives no rows.
    """
    sig = reliable_checkpoint(signatures(docs, shingle, index, doc_id, text), "signatures")
    one = ["s1", "s2", "n_shingles"]
    classes = reliable_checkpoint(
        sig.filter("lanes IS NOT NULL AND doc_id IS NOT NULL").groupBy(*one)
           .agg(F.min("doc_id").alias("node"), F.first("lanes").alias("lanes")), "classes")
    groups = reliable_checkpoint(shared_groups(index_keys(classes, index)), "members")

    wanted = bitmap(groups.select(F.xxhash64("node").alias("h")).distinct(), "h")
    members = classes.join(groups.select("node").distinct(), "node").select("node", "s1", "s2")
    sets = reliable_checkpoint(
        _class_sets(docs, shingle, wanted, doc_id, text).join(members, ["node", "s1", "s2"])
        .dropDuplicates(["node", "s1", "s2"]).select("node", "members"), "sets")

    def confirm(pairs: DataFrame) -> DataFrame:
        side = lambda c: sets.select(F.col("node").alias(c), F.col("members").alias(f"{c}_set"))
        n_a, n_b = F.size("a_set"), F.size("b_set")
        # the sizes alone rule a pair out before its sets are compared
        fits = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * similarity
        both = F.size(F.array_intersect("a_set", "b_set"))
        return (pairs.join(side("b"), "b").join(side("a"), "a").filter(fits)
                     .filter(both * 100 >= (n_a + n_b - both) * similarity))

    def rest(several: DataFrame) -> DataFrame:
        return _prefix_pairs(several.select("node", "r").distinct().join(sets, "node"), similarity)

    placed = classes.select(*one, "node").join(linked_components(groups, confirm, rest=rest), "node", "left")
    found = placed.select(*one, F.coalesce("root", "node").alias("component")).groupBy(*one).agg(
        F.min("component").alias("component"))
    own = [F.col(f"d.{c}") == F.col(f"c.{c}") for c in one]
    out = sig.alias("d").join(found.alias("c"), [*own, F.col("d.doc_id").isNotNull()], "left").select(
        "d.doc_id", "d.n_shingles", F.coalesce("c.component", "d.doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op9_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Query: ``near_duplicates`` of all documents on 2-word shingles."""
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=2)


def near_dup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each near-duplicate group (five words,
    similarity 0.8), the one with the smallest id (null first; of equal ids
    one text), with the columns of ``docs``.

    A document is an id, which may be null, and a text: rows without an id and
    texts that share one are judged apart, rows that repeat both are copies,
    of which one stays.  Documents without words always stay, repeated or not.
    Documents are told apart by a 64-bit hash.
    """
    key, other = fresh(docs, "_document", "_of")
    own = docs.withColumn(key, F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.coalesce("text", F.lit(""))))
    rows = near_duplicates(own.select(F.col(key).alias("doc_id"), "text")).filter("n_shingles > 0")
    found = rows.groupBy(F.col("doc_id").alias("document")).agg(
        F.min("component_id").alias("component"), F.count("*").alias("n"))
    ids = own.select(F.col(key).alias("document"), F.col("doc_id").alias("id")).distinct()
    placed = reliable_checkpoint(found.join(ids, "document"), "placed")
    keepers = placed.groupBy("component").agg(F.min(F.struct("id", "document")).alias("keeper"))
    judged = placed.join(keepers, "component").select(
        F.col("document").alias(other), "n", (F.col("document") == F.col("keeper.document")).alias("stays"))
    kept = own.join(judged.filter("NOT stays").select(other), F.col(key) == F.col(other), "left_anti")
    copies = reliable_checkpoint(judged.filter("stays AND n > 1").select(other), "copies")
    if not copies.isEmpty():
        same = F.col(key) == F.col(other)
        kept = kept.join(copies, same, "left_anti").unionByName(kept.join(copies, same, "left_semi").dropDuplicates([key]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
