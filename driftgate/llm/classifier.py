"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

A text's features are its words and pairs of words, and the same of the words' shapes (letters and digits
by kind, runs of one kind as one, everything else as it is), all hashed into 2**``BITS`` buckets; a bucket weighs one plus the logarithm of its count,
and a text's weights have length one. A score is the logistic function of a sparse dot product with the model.

The model is trained online: row by row, each with the per-coordinate FTRL-proximal update, ``EPOCHS`` times over at most ``SAMPLE``
labelled documents, the ones with the least hashes of their ids, in that order. Their features are made by all tasks and
written once; an epoch streams them through one task, which holds two numbers per bucket and one batch of rows. The model travels between epochs, and to the
scoring tasks, as arrays of 2**``BITS`` numbers, whatever the corpus.

Defined results: a null text is empty; an empty text has the score of the intercept; labels without doc_id or with a quality
other than 0 and 1 are not used; one text is learnt from for each labelled doc_id (of several rows that with the least hash), with the mean of
its labels; repeated rows each give a row; without labels to learn from every score is 1/2; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, cut, fresh_name, slices, text_bytes
from .quality import _word_hashes

BITS = 18
#: Labelled documents that the model is fitted on, at most.
SAMPLE = 20_000
EPOCHS = 5
NGRAMS = 2
#: Rate and smoothing of the steps, and the penalties on weights.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-5
#: Scores from here on predict a good document.
THRESHOLD = 0.3
FOLDS = 5

_PIECE = 1 << 20
_FEATURES = "rank long, label double, at binary, weight binary"


def _shape_table() -> np.ndarray:
    """Bytes by kind: small letters (and all beyond ASCII), capitals, digits; the rest as it is."""
    kinds = np.arange(256, dtype=np.uint8)
    kinds[97:123] = kinds[128:] = ord("a")
    kinds[65:91] = ord("A")
    kinds[48:58] = ord("0")
    return kinds


_KINDS = _shape_table()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _buckets(buf: np.ndarray, owners: np.ndarray, salt: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every n-gram of ``buf``, words that each end with a space, and the text it belongs to."""
    ends = np.flatnonzero(buf == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    words = _mixed(_word_hashes(buf, starts, ends) + np.uint64(salt))
    found, texts, grams = [], [], np.zeros(0, np.uint64)
    for n in range(NGRAMS):
        if n >= len(words):
            break
        grams = words if n == 0 else _mixed(grams[:-1] * np.uint64(3) + words[n:])
        own = owners[: len(grams)] == owners[n:]
        found.append((grams[own] >> np.uint64(64 - bits)).astype(np.int64))
        texts.append(owners[: len(grams)][own])
    return np.concatenate(found), np.concatenate(texts)


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and weights of all texts, one text after the other, and where each text's begin (and the last ends)."""
    split = [t.split() for t in texts]
    owners = np.repeat(np.arange(len(split)), [len(w) for w in split])
    starts = np.zeros(len(texts) + 1, np.int64)
    if not len(owners):
        return np.zeros(0, np.int64), np.zeros(0), starts
    buf = np.frombuffer(b" ".join([b" ".join(w) for w in split if w]) + b" ", np.uint8)
    shapes = _KINDS[buf]
    runs = np.ones(len(shapes), bool)
    letter = (shapes == ord("a")) | (shapes == ord("A")) | (shapes == ord("0"))
    runs[1:] = (shapes[1:] != shapes[:-1]) | ~letter[1:]
    parts = [_buckets(buf, owners, 1, bits), _buckets(shapes[runs], owners, 2, bits)]
    found, whose = (np.concatenate(x) for x in zip(*parts, strict=True))
    keys = np.sort((whose << bits) | found)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    weight = 1 + np.log(np.diff(np.append(first, len(keys))))
    keys = keys[first]
    whose = keys >> bits
    lengths = np.sqrt(np.bincount(whose, weight**2, len(texts)))
    starts[1:] = np.cumsum(np.bincount(whose, minlength=len(texts)))
    return keys & ((1 << bits) - 1), weight / lengths[whose], starts


class Leader:
    """FTRL-proximal state: for each bucket, and for the intercept at the end, z and the sum of squared gradients."""

    def __init__(self, bits: int = BITS) -> None:
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: float) -> None:
        """One row: its buckets, the intercept's among them, and weights."""
        w = self.weights(at)
        gradient = (_logistic(w @ x) - label) * x
        before = self.n[at]
        after = before + gradient**2
        self.z[at] += gradient - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
        self.n[at] = after


def _logistic(x: float | np.ndarray) -> float | np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """rank, label, text: one text for each of at most ``sample`` labelled documents to learn from."""
    doc_id = column(labels, "doc_id").cast("long")
    known = (
        labels.select(doc_id.alias("doc_id"), column(labels, "quality").cast("double").alias("label"))
        .filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.avg("label").alias("label"))
    )
    rank = F.xxhash64("doc_id")
    texts = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    chosen = known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(rank, "doc_id").limit(sample)
    chosen = cut(chosen.select("doc_id", "label", rank.alias("rank")))
    # Sixteen bytes for each of ``sample`` rows, so that no text has to move but those to learn from.
    found = texts.join(F.broadcast(chosen), "doc_id")
    least = F.min_by("text", F.struct(F.xxhash64("text"), F.length("text"))).alias("text")
    return found.groupBy("rank", "doc_id", "label").agg(least).select("rank", "label", "text")


def _described(rows: DataFrame, bits: int) -> DataFrame:
    """The labelled texts as buckets and weights."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, _PIECE):
                at, weight, starts = features(texts[a:b], bits)
                at, weight = at.astype(np.int32), weight.astype(np.float32)
                cuts = list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))
                columns = [
                    batch.column("rank").slice(a, b - a), batch.column("label").slice(a, b - a),
                    pa.array([at[i:j].tobytes() for i, j in cuts], pa.binary()),
                    pa.array([weight[i:j].tobytes() for i, j in cuts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["rank", "label", "at", "weight"])

    return cut(rows.mapInArrow(describe, _FEATURES))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS, bits: int = BITS) -> np.ndarray:
    """The weights of all buckets, and of the intercept at the end."""
    spark = docs.sparkSession
    rows = _described(labelled(docs, labels, sample), bits)
    ordered = rows.coalesce(1).sortWithinPartitions("rank", "at")  # at most ``sample`` rows, spilled if need be
    leader = Leader(bits)
    for _ in range(epochs):
        sent = spark.sparkContext.broadcast((leader.z, leader.n))

        def epoch(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = Leader(bits)
            own.z, own.n = (x.copy() for x in sent.value)
            for batch in batches:
                for label, at, weight in zip(*(batch.column(c) for c in ("label", "at", "weight")), strict=True):
                    at = np.append(np.frombuffer(at.as_buffer(), np.int32), 1 << bits)
                    own.learn(at, np.append(np.frombuffer(weight.as_buffer(), np.float32), 1.0), label.as_py())
            for name, state in (("z", own.z), ("n", own.n)):
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([state.tobytes()])], ["name", "state"])

        found = {r["name"]: r["state"] for r in ordered.mapInArrow(epoch, "name string, state binary").collect()}
        if not found:
            break
        leader.z, leader.n = (np.frombuffer(found[c]) for c in ("z", "n"))
        sent.unpersist()
    return leader.weights(slice(None))


def scored(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` with a column ``score`` (or that name with underscores, the last column)."""
    bits = int(len(weights) - 1).bit_length() - 1
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        texts, model, out = text.tolist(), sent.value, np.empty(len(text))
        for a, b in slices(texts, _PIECE):
            at, weight, starts = features(texts[a:b], bits)
            products = np.concatenate([[0.0], np.cumsum(model[at] * weight)])
            out[a:b] = _logistic(products[starts[1:]] - products[starts[:-1]] + model[-1])
        return pd.Series(out)

    return docs.withColumn(fresh_name(docs, "score"), score(text_bytes()))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    own = docs.select(column(docs, "doc_id").alias("doc_id"), column(docs, "text").alias("text"))
    found = scored(own, fit(own, labels, sample))
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
