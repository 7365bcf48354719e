"""Quality classifier: hashed word n-grams, logistic regression trained with
follow-the-regularised-leader updates, scored as a sparse dot product.

Tokens are runs of word characters or of symbols.  A token equal to one of the
two before it becomes a back-reference, so that repetition is a feature of its
own; 1- and 2-grams of these tokens are hashed, and a text's vector holds
their relative frequencies.  Only the text is read for a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strideframe.llm import ftrl
from strideframe.llm import textscan as ts
from strideframe.llm.common import append_columns, fold, read_table

#: Relative frequencies are multiplied by this, which sets the step of training.
SCALE = 20.0
SETTINGS = ftrl.Settings(alpha=2.0, l1=0.05)
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

#: 1: letters, digits and bytes of other scripts, 2: symbols, 0: white space and control.
_CLASS = np.zeros(256, dtype=np.uint8)
_CLASS[33:127] = 2
_CLASS[48:58] = _CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 1
_SAME = ts.U(0x5EED)


def _features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, row) of every 1- and 2-gram of the chunk's rows."""
    low = ts.LOWER[data]
    s, e = ts.runs(_CLASS[low], offsets)
    h = ts.FIRST.spans(ts.FIRST.prefix(low), s, e)
    _, row = ts.rows_of(s, offsets)
    tok = h.copy()
    for back in (1, 2):
        same = (h[back:] == h[:-back]) & (row[back:] == row[:-back])
        tok[back:][same] = _SAME
    together = row[1:] == row[:-1]
    pairs = ts.mix64(tok[:-1] * ts.U(3) + tok[1:] * ts.U(5))[together]
    index = np.concatenate([ts.mix64(tok), pairs]) >> ts.U(64 - bits)
    return index.astype(np.int64), np.concatenate([row, row[:-1][together]])


def _examples(texts, bits: int = SETTINGS.bits) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for lo, hi, data, offsets in ts.text_chunks(pa.array(texts, pa.large_string())):
        index, row = _features(data, offsets, bits)
        order = np.argsort(row, kind="stable")
        for part in np.split(index[order], np.cumsum(np.bincount(row, minlength=hi - lo))[:-1]):
            i, n = np.unique(part, return_counts=True)
            out.append((i.astype(np.int32), (n * (SCALE / max(1, len(part)))).astype(np.float32)))
    return out


def train_quality(docs: DataFrame, labels: DataFrame, train_fold, doc_id: str = "doc_id", text: str = "text",
                  label: str = "quality", settings: ftrl.Settings = SETTINGS) -> np.ndarray:
    """Weights learned from the labelled documents of the training fold.

    ``train_fold`` maps the id column to a boolean column.  About
    ``settings.max_rows`` labelled rows are used (a hash of the id picks
    them); null labels and labels without a document are left out.
    """
    rows, n = ftrl.sample(docs.select(doc_id, text), labels, doc_id, label, train_fold, settings)
    return ftrl.fit(rows, doc_id, text, "_label", lambda t: _examples(t, settings.bits), settings, n)


def score_quality(docs: DataFrame, weights: np.ndarray, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with ``score`` in 0..1 for the whole text of every row.

    Null and empty texts, and texts without any token, get the score of the
    bias alone.  Repeated rows get equal scores; other columns pass through
    (one named like the score is replaced).  An empty table stays empty.
    """
    bits = (len(weights) - 1).bit_length() - 1
    w, bias = weights[:-1].astype(np.float64), float(weights[-1])

    def compute(batch: pa.RecordBatch):
        z = np.full(batch.num_rows, bias)
        for lo, hi, data, offsets in ts.text_chunks(batch.column(text)):
            index, row = _features(data, offsets, bits)
            n = np.bincount(row, minlength=hi - lo)
            z[lo:hi] += SCALE * np.bincount(row, weights=w[index], minlength=hi - lo) / np.maximum(n, 1)
        return [pa.array(ftrl.sigmoid(z))]

    return append_columns(docs, [(score, "double")], compute)


def _in_training(doc_id):
    return F.coalesce(fold(doc_id, FOLDS) != HELD_OUT, F.lit(False))


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Query: doc_id, held_out, score, predicted for every document.  A null
    id counts as not held out (and is not learned from)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    w = train_quality(docs, read_table(spark, sf_dir, "labels"), _in_training)
    out = score_quality(docs, w)
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def quality_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that the classifier accepts, with the
    columns of ``docs``."""
    w = train_quality(docs, read_table(spark, sf_dir, "labels"), _in_training)
    return score_quality(docs, w, score="_score").filter(F.col("_score") >= THRESHOLD).drop("_score")
