"""Spelling variants: words one edit apart, grouped under their frequent form.

1. A scan takes the letter runs of whole texts, applies the dropped letters
   that the query plants and counts words per batch; an aggregate adds them up.
2. Two words one edit apart (inserted, deleted or replaced code point) share
   a half: with L the length of the shorter one and h = L // 2, either their
   first h letters are equal, or the last L - h are and the first h are not.
   So each pair meets once, in a group (L, which half, its letters) of words
   of L and L + 1 letters.
3. Within a block of such words a bit-sliced index holds a bitset over the
   block's words for every (position, letter).  A query word of L letters runs
   through it letter by letter, for all words of the block at a time: one
   bitset of words that agree so far, one of those with a replaced letter, and
   one, read at the next position, of those with an inserted letter.  What is
   left at the end are the near words; the agreement after h letters tells
   which half a pair belongs to.  Small groups that are neighbours in the sort
   order share a block.
4. A group beyond ``BLOCK`` words is dealt to several blocks by a hash; each of
   its query words visits all of them, so no task holds a group.  The work of
   a group still grows with the square of its words, 64 of them at a time.
5. Per word only the number of near words and the best one leave a block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm import textscan as ts
from strideframe.llm.common import read_table, reliable_checkpoint

MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10
#: A run whose checksum this divides loses a letter.
DROP = 31
#: Words that share an index at most, and at least where small groups are packed together.
BLOCK, PACK = 4_096, 256
_SCAN_BYTES = 1 << 22
#: 64-bit words of a block's working bitsets.
_BITSET_WORDS = 1 << 18

_ALPHA = np.zeros(256, dtype=np.uint8)
_ALPHA[97:123] = 1


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def crc32_spans(data: np.ndarray, s: np.ndarray, e: np.ndarray, start: np.ndarray) -> np.ndarray:
    """crc32 of each span of bytes, carried on from a checksum per span."""
    order = np.argsort(s - e, kind="stable")                # longest first
    at, size = s[order], (e - s)[order]
    crc = start[order].astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    active = len(at)
    for k in range(int(size[0]) if len(size) else 0):
        while active and size[active - 1] <= k:
            active -= int(active - np.searchsorted(-size[:active], -k, side="left"))
        c = crc[:active]
        crc[:active] = _CRC[(c ^ data[at[:active] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def letter_runs(data: np.ndarray, offsets: np.ndarray):
    """(lower-cased bytes, starts, ends) of the maximal runs of a-z, A-Z and U+00C0 to U+00FF."""
    low = ts.LOWER[data]
    latin = low == 0xC3                     # the lead byte of just these code points
    cls = _ALPHA[low] | latin
    cls[1:] |= latin[:-1]
    return low, *ts.runs(cls, offsets)


def count_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, drop: int = DROP) -> DataFrame:
    """(word, n): the words of whole texts with at least so many code points
    and occurrences.

    A run whose crc32 of ``<id>:<run>`` is h loses its code point number h %
    length if ``drop`` divides h.  A null text has no words; a null id counts
    as empty text; rows that repeat count as often as they come.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seed = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in b.column(0).to_pylist()], dtype=np.uint32)
            for lo, hi, data, offsets in ts.text_chunks(b.column(1), _SCAN_BYTES):
                low, s, e = letter_runs(data, offsets)
                _, row = ts.rows_of(s, offsets)
                chars = np.concatenate([[0], np.cumsum((low & 0xC0) != 0x80)])
                size = chars[e] - chars[s]
                long = np.flatnonzero(size >= min_length)
                s, e, row, size = s[long], e[long], row[long], size[long]
                crc = crc32_spans(low, s, e, seed[lo:hi][row])
                hit = crc % np.uint32(drop) == 0
                raw, less = low.tobytes(), {}
                for x, y, h, n in zip(s[hit].tolist(), e[hit].tolist(), crc[hit].tolist(), size[hit].tolist()):
                    if n > min_length:
                        w = raw[x:y].decode("utf-8")
                        w = w[:h % n] + w[h % n + 1:]
                        less[w] = less.get(w, 0) + 1
                s, e = s[~hit], e[~hit]
                _, at, n = np.unique(ts.FIRST.spans(ts.FIRST.prefix(low), s, e), return_index=True, return_counts=True)
                words = pa.concat_arrays([ts.strings(low, s[at], e[at]), pa.array(less, pa.string())])
                yield pa.RecordBatch.from_arrays([words, pa.array(np.append(n, list(less.values())).astype(np.int64))],
                                                 names=["word", "n"])

    found = docs.select(F.col(doc_id).cast("string"), F.col(text)).mapInArrow(scan, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class SlicedIndex:
    """Bitsets over words of L or L + 1 letters (latin-1 bytes), one for every position and letter."""

    def __init__(self, words: list[bytes], base: int):
        self.base, self.count, self.width = base, len(words), -(-len(words) // 64)
        size = np.array([len(w) for w in words])
        letters = np.frombuffer(b"".join(words), dtype=np.uint8)
        word = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(letters)) - np.repeat(np.cumsum(size) - size, size)
        used = np.unique(letters)
        self.code = np.full(256, len(used))                 # the last row: a letter that no word has
        self.code[used] = np.arange(len(used))
        self.sets = np.zeros((base + 1, len(used) + 1, self.width), dtype=np.uint64)
        bit = np.uint64(1) << (word & 63).astype(np.uint64)
        np.bitwise_or.at(self.sets, (place, self.code[letters], word >> 6), bit)
        self.same, self.longer = self._bitset(size == base), self._bitset(size == base + 1)

    def _bitset(self, mask: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width * 64, dtype=bool)
        out[:len(mask)] = mask
        return np.packbits(out, bitorder="little").view(np.uint64)

    def near(self, queries: np.ndarray, first_half: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, word) pairs with a replaced letter and (query, word) pairs
        whose word has one letter more.  ``queries``: rows of L letters."""
        shape = (len(queries), self.width)
        exact = np.full(shape, ~np.uint64(0))
        replaced, inserted = np.zeros(shape, dtype=np.uint64), exact.copy()
        half = exact
        for p in range(self.base):
            c = self.code[queries[:, p]]
            here, ahead = self.sets[p][c], self.sets[p + 1][c]
            replaced = (replaced & here) | (exact & ~here)
            exact = exact & here
            inserted = (inserted & ahead) | exact
            if p + 1 == self.base // 2:
                half = exact
        keep = half if first_half else ~half
        return *self._pairs(replaced & keep & self.same), *self._pairs(inserted & keep & self.longer)

    def _pairs(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q, w = np.nonzero(bits)
        inner = np.unpackbits(bits[q, w].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        i, j = np.nonzero(inner)
        return q[i], w[i] * 64 + j


def _block_rows(base: int, first_half: bool, words: list[bytes], n: np.ndarray, own: np.ndarray) -> pa.RecordBatch | None:
    """Per word of a block its near words there: how many, the best one and its count."""
    kept = np.flatnonzero(own)
    asks = np.array([i for i, w in enumerate(words) if len(w) == base], dtype=np.int64)
    if not len(kept) or not len(asks) or len(words) < 2:
        return None
    index = SlicedIndex([words[i] for i in kept], base)
    to, other = [], []
    step = max(1, _BITSET_WORDS // index.width)
    for at in range(0, len(asks), step):
        part = asks[at:at + step]
        letters = np.frombuffer(b"".join([words[i] for i in part]), dtype=np.uint8).reshape(len(part), base)
        q, w, q1, w1 = index.near(letters, first_half)
        to += [part[q], part[q1], kept[w1]]
        other += [kept[w], kept[w1], part[q1]]
    to, other = np.concatenate(to), np.concatenate(other)
    if not len(to):
        return None
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[other], -n[other], to))
    to, other = to[order], other[order]
    first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
    text = lambda at: pa.array([words[i].decode("latin-1") for i in at], pa.string())
    return pa.RecordBatch.from_arrays(
        [text(to[first]), pa.array(np.diff(np.append(first, len(to)))), text(other[first]), pa.array(n[other[first]])],
        names=["word", "n_near", "best", "best_n"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows sorted by (base, half, key, block): whole groups, packed up to ``PACK`` words."""
    kind, last, words, n, own = None, None, [], [], []

    def block():
        return _block_rows(kind[0], kind[1], words, np.array(n, dtype=np.int64), np.array(own, dtype=bool))

    for b in batches:
        for base, half, key, part, w, k, mine in zip(*(c.to_pylist() for c in b.columns)):
            if (base, half) != kind or (key, part) != last and (part or last[1] or len(words) * base >= PACK * MIN_LENGTH):
                if words and (out := block()) is not None:
                    yield out
                kind, words, n, own = (base, half), [], [], []
            last = (key, part)
            words.append(w.encode("latin-1"))
            n.append(k)
            own.append(mine)
    if words and (out := block()) is not None:
        yield out


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of the words (word, n; distinct, of code
    points below 256) that have another one edit apart: how many there are,
    and the one of largest n (ties: smallest in code-point order)."""
    size = F.length("word")
    groups = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("base")).filter(
        F.col("base") >= MIN_LENGTH).select("word", "n", "base", F.explode(F.array(F.lit(True), F.lit(False))).alias("half"))
    key = F.when(F.col("half"), F.expr("left(word, cast(floor(base / 2) AS int))")).otherwise(
        F.expr("right(word, base - cast(floor(base / 2) AS int))"))
    groups = groups.withColumn("key", key)
    by = ["base", "half", "key"]
    counts = groups.groupBy(*by).agg(F.count("*").alias("size"))
    hot = reliable_checkpoint(counts.filter(F.col("size") > block).select(
        *by, F.ceil(F.col("size") / block).cast("int").alias("blocks")), "hot-groups")
    dealt = groups.join(hot, by, "left")
    mine = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int") + 1
    every = F.when(size == F.col("base"), F.sequence(F.lit(1), F.col("blocks"))).otherwise(F.array(mine))
    rows = dealt.withColumn("mine", mine).withColumn("part", F.explode(
        F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(every)))
    rows = rows.select(*by, "part", "word", "n", F.coalesce(F.col("part") == F.col("mine"), F.lit(True)).alias("own"))
    found = (rows.repartition(*by, "part").sortWithinPartitions(*by, "part")
                 .mapInArrow(_compare, "word string, n_near long, best string, best_n long"))
    best = F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("x")).select(
        "word", "n_near", F.col("x.w").alias("best"), (-F.col("x.k")).alias("best_n"))


def variant_groups(words: DataFrame, ratio: int = RATIO, block: int = BLOCK) -> DataFrame:
    """``words`` (word, n) with their spelling groups: n_near, form and form_n
    (the best near word, if its n is at least ``ratio`` times the word's; else
    null) and root, where the chain of forms ends (the word itself if it has
    none).  An empty table stays empty; a null word is no word.
    """
    words = reliable_checkpoint(words.filter("word IS NOT NULL").select("word", "n"), "words")
    near = near_words(words, block)
    takes = F.col("best_n") >= F.lit(ratio) * F.col("n")
    out = reliable_checkpoint(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, F.col("best")).alias("form"),
        F.when(takes, F.col("best_n")).alias("form_n")), "forms")
    # each form is more frequent than its word, so chains end; a round doubles what they reach
    at = out.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        at = reliable_checkpoint(at.alias("a").join(at.alias("b"), F.col("a.root") == F.col("b.word"), "left").select(
            "a.word", F.coalesce("b.root", "a.root").alias("root"), F.col("b.root").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            break
        at = at.drop("moved")
    return out.join(at.select("word", F.col("root").alias("end")), "word", "left").select(
        "word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Query: word, form, root, n, n_near, form_n of every word of the documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return variant_groups(count_words(docs))
