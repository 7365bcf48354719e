"""Logistic regression on hashed features, trained with per-coordinate
follow-the-regularised-leader updates.

Training runs on a sample of labelled rows whose size is bounded by a
documented parameter.  The sample is dealt to shards of about
``rows_per_shard`` rows, each trained in its own task, and the weights are
averaged; the model has
``2**bits + 1`` weights (the last is the bias), so what the driver gathers and
ships to the scoring tasks has a fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Examples as (indices, values, label); indices are distinct within one (held as 32 bits).
Example = tuple[np.ndarray, np.ndarray, float]


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.0
    epochs: int = 4
    rows_per_shard: int = 4_000
    #: Bound on the labelled rows used for training (expected size: hashed ids).
    max_rows: int = 16_000


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def train(examples: Sequence[Example], s: Settings) -> np.ndarray:
    """Weights after ``s.epochs`` passes over the examples in their order."""
    size = (1 << s.bits) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(zi, ni):
        lead = np.sign(zi) * s.l1 - zi
        return np.where(np.abs(zi) <= s.l1, 0.0, lead / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for i, x, y in examples:
            i, x = np.append(i, size - 1), np.append(x, 1.0)      # the bias
            zi, ni = z[i], n[i]
            w = weights(zi, ni)
            g = (sigmoid(w @ x) - y) * x
            root = np.sqrt(ni)
            n[i] = ni + g * g
            z[i] = zi + g - (np.sqrt(n[i]) - root) / s.alpha * w
    return weights(z, n).astype(np.float32)


def fit(labelled: DataFrame, key: str, text: str, label: str,
        examples: Callable[[Sequence[str]], list[tuple[np.ndarray, np.ndarray]]], s: Settings,
        n_rows: int) -> np.ndarray:
    """Averaged weights of the shards.  ``labelled`` holds the rows of the
    sample, ``n_rows`` of them as ``sample`` says; rows are ordered by key and text, so the result does not depend on
    how they arrive.  Without any row all weights are 0."""

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(h=pd.util.hash_array(pdf["key"].to_numpy().astype("int64")))
        pdf = pdf.sort_values(["h", "text"])
        feats = examples(pdf["text"].tolist())
        labels = pdf["label"].tolist()
        del pdf
        w = train([(i, v, y) for (i, v), y in zip(feats, labels)], s)
        return pd.DataFrame({"w": [w.tobytes()]})

    rows = labelled.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                           F.col(label).cast("double").alias("label")).dropna()
    shards = max(1, round(n_rows / s.rows_per_shard))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(shards)))
    parts = [np.frombuffer(r.w, dtype=np.float32)
             for r in dealt.groupBy("shard").applyInPandas(shard, "w binary").collect()]
    return np.mean(parts, axis=0) if parts else np.zeros((1 << s.bits) + 1, dtype=np.float32)


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, label: str, train_fold,
           s: Settings) -> tuple[DataFrame, int]:
    """(rows, expected number): rows of ``docs`` with a label, within the training fold, thinned by a
    hash of the id so that about ``s.max_rows`` remain.  Documents and labels
    meet on the id; an id with several labels counts with each of them."""
    lab = (labels.select(F.col(doc_id).alias("_id"), F.col(label).alias("_label")).dropna()
                 .filter(train_fold(F.col("_id"))))
    total = lab.count()
    if total > s.max_rows:
        share = int(s.max_rows / total * (1 << 30))
        lab = lab.filter(F.pmod(F.xxhash64(F.lit(11), "_id"), F.lit(1 << 30)) < share)
    return docs.join(lab, docs[doc_id] == lab["_id"]).drop("_id"), min(total, s.max_rows)
