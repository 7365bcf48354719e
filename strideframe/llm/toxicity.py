"""Toxicity of restored text: a noisy-channel decoder undoes leetspeak,
spacing and repetition under a character language model of the corpus, and a
hashed logistic regression scores the restored words.

1. Character trigrams of all documents are counted (per task, then summed):
   one table of at most 28**3 counts, whatever the size of the corpus.
2. Spans that look obfuscated (a leet sign before a letter, three equal
   letters, letters spaced out one by one) become lattices: each sign may be
   itself or a letter it imitates, a long repetition one or two letters, a
   separator nothing or a word break.  Viterbi decoding over the last two
   symbols picks the reading with the least channel plus language-model cost.
3. Words of the restored text and their beginnings are hashed; log counts are
   the features of a model trained with follow-the-regularised-leader updates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm import ftrl
from strideframe.llm import textscan as ts
from strideframe.llm.common import append_columns, fold, read_table

SETTINGS = ftrl.Settings(alpha=0.5, l1=4.0)
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
#: Lengths in bytes of the word beginnings that are features besides the word.
BEGINNINGS = (4, 5, 6, 7)

# Letters that a sign imitates.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou"}
#: Signs that may stand between the letters of a spaced-out word.
SEPARATORS = " .-_*"
# Channel costs in nats: a substitution, a literal sign before a letter or digit, a literal digit, @ or $
# after one, a shortened repetition, a removed separator.
SUBSTITUTE, LITERAL_BEFORE, LITERAL_AFTER, SHORTEN, UNSPACE = 1.5, 5.0, 2.5, 0.5, 0.2

#: Symbols of the language model: 0 break, 1..26 letters, 27 a byte of another script.
SYMBOLS = 28
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[128:] = 27
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LEET = np.isin(np.arange(256), [ord(c) for c in LEET])
_SEP = np.isin(np.arange(256), [ord(c) for c in SEPARATORS])


def char_trigrams(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of the symbol trigrams within all texts, as a 28 x 28 x 28 array."""
    size = SYMBOLS ** 3

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for b in batches:
            for _, _, data, offsets in ts.text_chunks(b.column(0)):
                c = _CLASS[ts.LOWER[data]]
                if len(c) < 3:
                    continue
                code = (c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:]
                inside = np.ones(len(code), dtype=bool)
                for back in (1, 2):     # a trigram never spans two texts
                    at = offsets[1:-1] - back
                    inside[at[(at >= 0) & (at < len(code))]] = False
                total += np.bincount(code[inside], minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["code", "n"])

    rows = (docs.select(F.col(text).alias("t")).mapInArrow(count, "code long, n long")
                .groupBy("code").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(size)
    for r in rows:
        out[r.code] = r.n
    return out.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def log_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log of the interpolated trigram probabilities."""
    one = counts.sum(axis=(0, 1)) + 1.0
    one /= one.sum()
    two = counts.sum(axis=0)
    two = (two + 5.0 * one) / (two.sum(axis=1, keepdims=True) + 5.0)
    three = (counts + 5.0 * two[None]) / (counts.sum(axis=2, keepdims=True) + 5.0)
    return -np.log(three)


class Decoder:
    """Viterbi decoding of character lattices, remembered by span."""

    MEMORY = 100_000

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()
        self.seen: dict[str, str] = {}

    def __call__(self, span: str) -> str:
        out = self.seen.get(span)
        if out is None:
            if len(self.seen) >= self.MEMORY:
                self.seen.clear()
            out = self.seen[span] = self._best(self._lattice(span))
        return out

    @staticmethod
    def _symbols(s: str) -> tuple[int, ...]:
        return tuple(int(x) for x in _CLASS[np.frombuffer(s.encode(), dtype=np.uint8)])

    def _lattice(self, span: str) -> list[list[tuple[float, tuple[int, ...], str]]]:
        """For each step its (channel cost, symbols, output) options."""
        steps, i, n = [], 0, len(span)
        spaced = sum(c in SEPARATORS for c in span) >= 2
        while i < n:
            c = span[i]
            j = i + 1
            while j < n and span[j] == c:
                j += 1
            run, letter = j - i, "a" <= c <= "z"
            before, after = j < n and span[j].isalnum(), i > 0 and span[i - 1].isalnum()
            literal = (0.0, self._symbols(c) if letter or c > "\x7f" else (0,), c)
            if letter and run >= 3:
                steps.append([(SHORTEN, literal[1] * k, c * k) for k in (1, 2)])
                i = j
                continue
            options = [literal]
            if c in LEET:
                plain = LITERAL_BEFORE if before else LITERAL_AFTER if after and (c.isdigit() or c in "@$") else 0.0
                options = [(plain, (0,), c)]
                options += [(SUBSTITUTE, self._symbols(x), x) for x in LEET[c]]
            if spaced and c in SEPARATORS:
                options = [(0.0, (0,), c), (UNSPACE, (), "")] + [o for o in options if o[1] != (0,)]
            steps.append(options)
            i += 1
        return steps

    def _best(self, steps) -> str:
        """Output of the cheapest path from break to break."""
        costs = self.costs
        # state (last two symbols) -> (cost, (previous node, output))
        front = {(0, 0): (0.0, None)}
        for options in steps:
            nxt: dict = {}
            for (a, b), (cost, node) in front.items():
                for channel, symbols, out in options:
                    x, y, total = a, b, cost + channel
                    for s in symbols:
                        if s or y:      # several breaks in a row count once
                            total += costs[x][y][s]
                            x, y = y, s
                    old = nxt.get((x, y))
                    if old is None or total < old[0] or (total == old[0] and out < old[1][1]):
                        nxt[(x, y)] = (total, (node, out))
            front = nxt
        ends = ((cost + (costs[a][b][0] if b else 0.0), (a, b)) for (a, b), (cost, _) in front.items())
        node = front[min(ends)[1]][1]
        parts = []
        while node is not None:
            node, out = node
            parts.append(out)
        return "".join(reversed(parts))


def suspicious_spans(low: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the spans of lower-cased bytes to decode."""
    n = len(low)
    if n < 2:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    letter, first = _LETTER[low], np.zeros(n + 1, dtype=bool)
    first[offsets] = True
    marks = np.zeros(n, dtype=bool)         # a leet sign before a letter
    marks[:-1] = _LEET[low[:-1]] & letter[1:] & ~first[1:n]
    if n >= 3:                              # three equal letters
        marks[:-2] |= letter[:-2] & (low[:-2] == low[1:-1]) & (low[1:-1] == low[2:]) & ~first[1:n - 1] & ~first[2:n]
    s, e = ts.runs(ts.NONSPACE[low], offsets)
    cum = np.concatenate([[0], np.cumsum(marks)])
    hit = cum[e] > cum[s]
    spans = np.column_stack([s[hit], e[hit]])
    if n >= 5:                              # letter, separator, letter, separator, letter
        sep, same = _SEP[low], ~first[1:n]
        alone = letter.copy()               # a letter without a letter on either side
        alone[1:] &= ~(letter[:-1] & same)
        alone[:-1] &= ~(letter[1:] & same)
        five = alone[:-4] & sep[1:-3] & alone[2:-2] & sep[3:-1] & alone[4:]
        for k in range(1, 5):
            five &= ~first[k:n - 4 + k]
        at = np.flatnonzero(five)
        if len(at):
            spans = np.concatenate([spans, np.column_stack([at, at + 5])])
            spans = spans[np.argsort(spans[:, 0], kind="stable")]
    if not len(spans):
        return spans[:, 0], spans[:, 1]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, (spans[1:, 0] >= reach[:-1]))
    starts = spans[new, 0]
    ends = np.append(reach[np.flatnonzero(new)[1:] - 1], reach[-1])
    return starts, ends


def restore_chunk(decoder: Decoder, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, row starts, changed spans per row) of a chunk in lower case
    with every suspicious span replaced by its decoded form."""
    low = ts.LOWER[data]
    starts, ends = suspicious_spans(low, offsets)
    changed = np.zeros(len(offsets) - 1, dtype=np.int64)
    if not len(starts):
        return low, offsets, changed
    row = np.searchsorted(offsets, starts, side="right") - 1
    raw, pieces, at, grown = low.tobytes(), [], 0, np.zeros(len(offsets) - 1, dtype=np.int64)
    for s, e, r in zip(starts.tolist(), ends.tolist(), row.tolist()):
        old = raw[s:e]
        new = decoder(old.decode("utf-8", "replace")).encode()
        if new != old:
            pieces += [raw[at:s], new]
            at = e
            grown[r] += len(new) - len(old)
            changed[r] += 1
    pieces.append(raw[at:])
    return (np.frombuffer(b"".join(pieces), dtype=np.uint8),
            offsets + np.concatenate([[0], np.cumsum(grown)]), changed)


def _features(low: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    s, e = ts.runs(ts.WORD[low], offsets)
    prefix = ts.FIRST.prefix(low)
    _, row = ts.rows_of(s, offsets)
    index, rows = [ts.FIRST.spans(prefix, s, e)], [row]
    for k in BEGINNINGS:
        long = e - s >= k
        index.append(ts.mix64(ts.FIRST.spans(prefix, s[long], s[long] + k) + ts.U(k)))
        rows.append(row[long])
    return (np.concatenate(index) >> ts.U(64 - bits)).astype(np.int64), np.concatenate(rows)


def _counted(index: np.ndarray, row: np.ndarray, bits: int):
    """(row, index, log count) of the distinct features of each row."""
    key, n = np.unique((row << bits) | index, return_counts=True)
    return key >> bits, key & ((1 << bits) - 1), np.log1p(n)


def train_toxicity(docs: DataFrame, labels: DataFrame, costs: np.ndarray, train_fold, doc_id: str = "doc_id",
                   text: str = "text", label: str = "toxic", settings: ftrl.Settings = SETTINGS) -> np.ndarray:
    """Weights learned from the restored texts of the labelled documents in
    the training fold (about ``settings.max_rows`` of them)."""

    def examples(texts):
        decoder, out = Decoder(costs), []
        for lo, hi, data, offsets in ts.text_chunks(pa.array(texts, pa.large_string())):
            low, off, _ = restore_chunk(decoder, data, offsets)
            row, index, value = _counted(*_features(low, off, settings.bits), settings.bits)
            ends = np.searchsorted(row, np.arange(1, hi - lo))
            out += [(i.astype(np.int32), v.astype(np.float32))
                    for i, v in zip(np.split(index, ends), np.split(value, ends))]
        return out

    rows, n = ftrl.sample(docs.select(doc_id, text), labels, doc_id, label, train_fold, settings)
    return ftrl.fit(rows, doc_id, text, "_label", examples, settings, n)


def score_toxicity(docs: DataFrame, costs: np.ndarray, weights: np.ndarray, text: str = "text",
                   score: str = "score", restored: str = "n_restored") -> DataFrame:
    """``docs`` with the toxicity ``score`` (0..1) of each whole restored
    text and the number of spans that the decoder changed.

    Null and empty texts get the score of the bias alone and 0 spans; repeated
    rows get equal results; other columns pass through (columns with the names
    of the two new ones are replaced); an empty table stays empty.
    """
    bits = (len(weights) - 1).bit_length() - 1
    w, bias = weights[:-1].astype(np.float64), float(weights[-1])

    def compute_with(decoder: Decoder):
        def compute(batch: pa.RecordBatch):
            z, spans = np.full(batch.num_rows, bias), np.zeros(batch.num_rows, dtype=np.int64)
            for lo, hi, data, offsets in ts.text_chunks(batch.column(text)):
                low, off, spans[lo:hi] = restore_chunk(decoder, data, offsets)
                index, row = _features(low, off, bits)
                used = w[index] != 0
                row, index, value = _counted(index[used], row[used], bits)
                z[lo:hi] += np.bincount(row, weights=w[index] * value, minlength=hi - lo)
            return [pa.array(ftrl.sigmoid(z)), pa.array(spans)]
        return compute

    return append_columns(docs, [(score, "double"), (restored, "long")], compute_with(Decoder(costs)))


def deobfuscate(docs: DataFrame, costs: np.ndarray, text: str = "text", out: str = "restored") -> DataFrame:
    """``docs`` with the restored lower-case text of each row (null: empty)."""
    decoder = Decoder(costs)

    def compute(batch: pa.RecordBatch):
        texts = []
        for lo, hi, data, offsets in ts.text_chunks(batch.column(text)):
            low, off, _ = restore_chunk(decoder, data, offsets)
            raw = low.tobytes()
            texts += [raw[a:b].decode("utf-8") for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        return [pa.array(texts, pa.string())]

    return append_columns(docs, [(out, "string")], compute)


def _in_training(doc_id):
    return F.coalesce(fold(doc_id, FOLDS) != HELD_OUT, F.lit(False))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Query: doc_id, held_out, score, predicted, n_restored for every
    document.  A null id counts as not held out (and is not learned from)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    costs = log_costs(char_trigrams(docs))
    w = train_toxicity(docs, read_table(spark, sf_dir, "labels"), costs, _in_training)
    out = score_toxicity(docs, costs, w)
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_restored")
