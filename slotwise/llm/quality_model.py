"""Operator 5: quality classifier, hashed word n-grams and FTRL logistic regression.

Features of a text are word n-grams, hashed into ``2 ** BITS`` slots:

* one and two words as written;
* one and two word *shapes* (letters and digits replaced by a class, repeats
  shortened), which carry over to words never seen in training;
* a pair of equal words, and a three-word window that occurred before in the
  text, each as one feature of its own.

A slot's value is its share among the n-grams of its kind, so long and short texts
compare. Follow-the-regularised-leader (proximal, with L1 and L2) learns the
weights from labelled rows, at most ``TRAIN_ROWS`` of them; a text's score is the
logistic of a sparse dot product.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import quoted

BITS = 18
SLOTS = 1 << BITS
#: Bound of the training sample: so many labelled rows are read at most, chosen by a hash of their id.
TRAIN_ROWS = 8_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
CACHE_WORDS = 400_000

_CLASS_OF = bytes(
    65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in range(256)
)
_REPEATS = re.compile(rb"(.)\1+", re.S)


def shape(word: bytes) -> bytes:
    """``Reed***`` -> ``Aa*``: classes of characters (letters beyond ASCII count as lower case), runs shortened to one."""
    return _REPEATS.sub(rb"\1", word.translate(_CLASS_OF))[:8]


class WordHashes(dict):
    """``word bytes -> hash of the word in the low half, hash of its shape in the high half``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = zlib.crc32(word) | zlib.crc32(shape(word), 7) << 32
        if len(word) <= 64:
            self[word] = value
        return value


def _pair(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    x = (a * np.uint64(0x9E3779B1) + b * np.uint64(0x85EBCA6B) + np.uint64(seed)) & np.uint64(0xFFFFFFFF)
    x ^= x >> np.uint64(15)
    return x * np.uint64(0x2C1B3C6D) & np.uint64(0xFFFFFFFF)


def _slots(h: np.ndarray, kind: int) -> np.ndarray:
    h = (h ^ np.uint64(kind * 0x5BD1E995)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


SAME, SEEN = 0, 1  # slots of the two repetition features


def fields(text: str, hashes: WordHashes) -> list[tuple[np.ndarray, float]]:
    """``(slots, value per entry)`` for each kind of n-gram; nothing for a text without words."""
    words = text.encode("utf-8").split()
    if not words:
        return []
    both = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    w, s = both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)
    n = len(words)
    out = [(_slots(w, 1), 1 / n), (_slots(s, 2), 1 / n)]
    if n > 1:
        pairs = _pair(w[:-1], w[1:], 3)
        same = int((w[:-1] == w[1:]).sum())
        out += [(_slots(pairs, 3), 1 / (n - 1)), (_slots(_pair(s[:-1], s[1:], 5), 4), 1 / (n - 1))]
        out.append((np.array([SAME]), same / (n - 1)))
        if n > 2:
            windows = _pair(pairs[:-1], w[2:], 11)
            seen = 1 - len(np.unique(windows)) / (n - 2)
            out.append((np.array([SEEN]), seen))
    return out


def dot(weights: np.ndarray, parts: list[tuple[np.ndarray, float]]) -> float:
    return float(sum(weights[slots].sum() * value for slots, value in parts))


def train(rows: list[tuple[str, int]], epochs: int = EPOCHS) -> np.ndarray:
    """FTRL-proximal over labelled texts in the order given; the last entry is the bias. No rows: all zero."""
    hashes = WordHashes()
    sparse = []
    for text, label in rows:
        parts = fields(text, hashes)
        slots = np.concatenate([p for p, _ in parts]) if parts else np.zeros(0, np.int64)
        value = np.concatenate([np.full(len(p), v) for p, v in parts]) if parts else np.zeros(0)
        index, inverse = np.unique(slots, return_inverse=True)
        x = np.bincount(inverse.reshape(-1), value, len(index))
        sparse.append((np.append(index, SLOTS), np.append(x, 1.0), label))
    z, n, w = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for _ in range(epochs):
        for index, x, label in sparse:
            zi, ni = z[index], n[index]
            wi = np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            g = (1 / (1 + np.exp(-np.clip(wi @ x, -35, 35))) - label) * x
            z[index] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[index] += g * g
    w = np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 5 == 0


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, bound: int = TRAIN_ROWS) -> DataFrame:
    """``text, label`` of at most ``bound`` labelled ids outside the held-out fifth, with whole texts.

    Ids without a label, or with two different ones, are left out.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
        .where("label = other")
        .select(F.col("doc_id").alias("_id"), F.col("label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(bound)
    )
    texts = docs.select(quoted(id_col).alias("_id"), F.coalesce(quoted(text_col), F.lit("")).alias("_text"))
    return texts.join(F.broadcast(known), "_id").select("_id", "_text", "_label")  # bounded by `bound` rows


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = TRAIN_ROWS) -> np.ndarray:
    """The weights, learned in one task from the bounded sample; only non-zero ones reach the driver."""

    def learn(batches):
        import pyarrow as pa

        rows = [x for b in batches for x in zip(*(b.column(i).to_pylist() for i in range(3)))]
        rows = sorted(set(rows), key=lambda r: (zlib.crc32(str(r[0]).encode()), r))  # copies of a row count once
        w = train([(text, label) for _, text, label in rows])
        at = np.flatnonzero(w)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(w[at], pa.float64())], names=["slot", "weight"])

    sample = training_rows(docs, labels, id_col, text_col, bound).repartition(1)
    found = sample.mapInArrow(learn, "slot long, weight double").toPandas()
    weights = np.zeros(SLOTS + 1)
    weights[found["slot"].to_numpy()] = found["weight"].to_numpy()
    return weights


_HASHES = WordHashes()


def scorer(weights: np.ndarray, spark):
    """A column function ``text -> score``; null scores as the empty text, whose score is the bias alone."""
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))  # 2 ** BITS + 1 numbers

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        w = shared.value
        margin = [dot(w, fields(t or "", _HASHES)) + float(w[SLOTS]) for t in texts]
        return pd.Series(1 / (1 + np.exp(-np.clip(margin, -35, 35))), dtype="float64")

    return score


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """``docs`` plus ``held_out``, ``score`` and ``predicted``.

    Null and empty texts get the bias's score. Each row is scored alone, so
    repeated rows score alike. Input columns of those three names are replaced.
    A null id is not held out and is never trained on. An empty ``docs`` gives an
    empty table; without labels every score is 0.5.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("held_out", "score", "predicted")])
    score = scorer(fit(docs, labels, id_col, text_col), docs.sparkSession)
    return docs.withColumns(
        {"held_out": F.coalesce(held_out(quoted(id_col)), F.lit(False)), "score": score(quoted(text_col))}
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
