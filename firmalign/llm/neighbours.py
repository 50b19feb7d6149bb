"""Text quality by a vote of the nearest labelled texts in a latent semantic space.

A text is a vector of ``FEATURES`` shares: how much of it each hashed word and each hashed shape of
a token makes up, and how much is repeated words, repeated lines and words of a text of about this
length. Square roots of the shares have length near one whatever the length of the text, so neither
long nor short texts dominate. A truncated singular value decomposition of the labelled texts gives
``DIMENSIONS`` latent directions.

The labelled vectors, a table of fixed size, go to every task. There each text's cosine with each of
them is computed exactly, a block of texts at a time in one matrix product; the nearest
``NEIGHBOURS`` vote with their labels, weighted by a power of their similarity.

Labels are learnt from a bounded sample: the first ``MOST_PER_CLASS`` labelled ids of each class by
a hash of doc_id. Scoring reads every whole text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmalign.llm.common import cut_rows, map_arrow, table, texts_of
from firmalign.llm.toxicity import held_out

MOST_PER_CLASS = 2048
SHAPES, WORDS = 1024, 2048
#: After the hashed shapes and words: repeated words, lines, tokens; any text; none; length bands.
REPEATED, LINES, AGAIN, SOME, NONE, BANDS = range(SHAPES + WORDS, SHAPES + WORDS + 6)
FEATURES = 4096
DIMENSIONS, NEIGHBOURS, POWER = 48, 16, 8
LEAST_SCORE = 0.3
#: Texts multiplied with the labelled vectors at once.
BLOCK = 256
#: Similarities are compared in steps of this size, so that equal texts get equal votes anywhere.
STEPS = 1_000_000
_MOST_KEPT, _LONGEST_KEPT = 400_000, 64

_CLASSES = bytes(
    ord("X") if chr(c).isupper() else ord("x") if chr(c).isalpha() else
    ord("0") if chr(c).isdigit() else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)
_MARKS = ".,!?;:#%&*$|\"'()[]"


def token_code(token: str) -> int:
    """Shape and word of a token as one number: shape feature * 2048 + word feature."""
    shape = _RUN.sub(rb"\1", token.encode("latin-1", "replace").translate(_CLASSES))[:8]
    word = token.lower().strip(_MARKS)
    return zlib.crc32(shape) % SHAPES * WORDS + zlib.crc32(word.encode()) % WORDS


class _Codes(dict):
    """Codes of tokens; short ones are kept, up to a bound."""

    def __missing__(self, token: str) -> int:
        code = token_code(token)
        if len(token) <= _LONGEST_KEPT:
            if len(self) >= _MOST_KEPT:
                self.clear()
            self[token] = code
        return code


def _shares(texts: list[str], codes: _Codes) -> np.ndarray:
    """A row of square roots of shares for each text."""
    token_ids, weights, rows = [], [], []
    out = np.zeros((len(texts), FEATURES))
    for row, text in enumerate(texts):
        tokens = text.split()
        n = len(tokens)
        if not n:
            out[row, NONE] = 1
            continue
        counts = Counter(tokens)
        token_ids.append(np.fromiter(map(codes.__getitem__, counts), np.int64, len(counts)))
        weights.append(np.fromiter(counts.values(), float, len(counts)) / n)
        rows.append(row)
        out[row, REPEATED] = sum(map(eq, tokens, tokens[1:])) / n
        out[row, AGAIN] = 1 - len(counts) / n
        lines = [line for line in text.split("\n") if line.strip()]
        out[row, LINES] = 1 - len(set(lines)) / max(len(lines), 1)
        out[row, SOME] = 1 / n
        out[row, BANDS + min(n.bit_length(), 24)] = 0.5
    if rows:
        base = np.repeat(np.array(rows), [len(t) for t in token_ids]) * FEATURES
        code, weight = np.concatenate(token_ids), np.concatenate(weights)
        for at, part in ((0, code // WORDS), (SHAPES, code % WORDS)):
            out += np.bincount(base + at + part, weight, out.size).reshape(out.shape)
    return np.sqrt(out)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in cut_rows(batches):
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


# ---------------------------------------------------------------- model
@dataclass
class Model:
    """Latent directions, labelled vectors of length one, and their labels."""
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, shares: np.ndarray) -> np.ndarray:
        found = shares.astype(np.float32) @ self.directions
        length = np.sqrt((found ** 2).sum(1, keepdims=True))
        return np.where(length > 1e-6, found / np.maximum(length, 1e-6), 0)

    def votes(self, latent: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors."""
        n = len(self.labels)
        if not n:
            return np.full(len(latent), 0.5)
        steps = np.rint((latent @ self.vectors.T).astype(float) * STEPS).astype(np.int64)
        k = min(NEIGHBOURS, n)
        # Of equally similar vectors the first ones count.
        order = -(steps * n + np.arange(n, 0, -1) - 1)
        near = np.argpartition(order, k - 1, axis=1)[:, :k]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(order, near, 1), 1), 1)
        weight = np.maximum(np.take_along_axis(steps, near, 1) / STEPS, 1e-3) ** POWER
        return (weight * self.labels[near]).sum(1) / weight.sum(1)


def train(shares: np.ndarray, labels: np.ndarray, dimensions: int = DIMENSIONS) -> Model:
    """Truncated SVD of the labelled rows by a randomised range finder with fixed numbers."""
    if not len(labels):
        return Model(np.zeros((FEATURES, 0), np.float32), np.zeros((0, 0), np.float32),
                     np.zeros(0))
    shares = shares.astype(np.float32)
    width = min(dimensions + 10, len(labels))
    probe = np.random.default_rng(0).standard_normal((FEATURES, width)).astype(np.float32)
    basis = np.linalg.qr(shares @ probe)[0]
    for _ in range(2):
        basis = np.linalg.qr(shares @ (shares.T @ basis))[0]
    directions = np.linalg.svd(basis.T @ shares, full_matrices=False)[2][:dimensions].T
    model = Model(np.ascontiguousarray(directions), np.zeros((0, 0), np.float32), labels.astype(float))
    model.vectors = model.latent(shares)
    return model


def fit(documents: DataFrame, labels: DataFrame, most: int = MOST_PER_CLASS) -> Model:
    """Learn from at most ``most`` labelled documents of each class.

    Ids are chosen by their hash from rows that aren't held out. An id labelled both ways is left
    out; of an id with several texts the smallest text counts. The texts are turned into vectors by
    Spark; the driver gets one row of at most 4,096 numbers for each id chosen.
    """
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_most"))
             .where("label = _most").drop("_most"))
    present = documents.select("doc_id").where("doc_id IS NOT NULL").distinct()
    known = known.join(present, "doc_id", "left_semi").select(
        "doc_id", (F.col("label") > 0).cast("int").alias("label"), F.xxhash64("doc_id").alias("place"))
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy("place", "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most twice ``most`` ids, so they may go to every task.
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy(
        "doc_id", "label", "place").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]):
        codes = _Codes()
        for part in _blocks(batches):
            shares = _shares(texts_of(part.column(3)), codes)
            row, feature = np.nonzero(shares)
            ends = np.searchsorted(row, np.arange(len(shares) + 1)).astype(np.int32)
            yield [part.column(0), part.column(1), part.column(2),
                   pa.ListArray.from_arrays(ends, feature.astype(np.int32)),
                   pa.ListArray.from_arrays(ends, shares[row, feature])]

    rows = map_arrow(texts, run, "doc_id bigint, label int, place bigint, features array<int>, "
                                 "shares array<double>").toArrow()
    order = np.lexsort((rows["doc_id"].to_numpy(), rows["place"].to_numpy()))
    features, shares = (rows[c].combine_chunks() for c in ("features", "shares"))
    dense = np.zeros((len(order), FEATURES), np.float32)
    row = np.repeat(np.arange(len(order)), features.value_lengths().to_numpy())
    dense[row, features.flatten().to_numpy()] = shares.flatten().to_numpy()
    return train(dense[order], rows["label"].to_numpy()[order])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): the likelier label 1 the higher, from 0 to 1.

    ``documents`` has doc_id and text; further columns are ignored. A row is scored by its whole
    text alone, however long, so repeated rows score alike. A missing text is an empty one; texts
    without words are near each other. Without any labelled text every score is 0.5; with labels of
    one class only, all scores are that label. Empty tables give no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        codes = _Codes()
        for part in _blocks(batches):
            latent = model.latent(_shares(texts_of(part.column(1)), codes))
            yield [part.column(0), model.votes(latent)]

    return map_arrow(documents.select("doc_id", "text"), run, "doc_id bigint, score double")


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scored = score(documents, fit(documents, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"))
