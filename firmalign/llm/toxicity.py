"""Toxicity scores by non-negative positive-unlabelled learning.

A linear model over hashed character n-grams of a text's distinct words is trained in numpy from
confirmed toxic texts and unlabelled ones. The share of toxic texts among the unlabelled, the class
prior, corrects the risk: what confirmed texts contribute is taken off the unlabelled texts' risk of
being clean, and where that difference falls below zero, the step goes the other way, so the model
can't fit it away. Labels of clean texts are used for the prior only.

Training uses a bounded sample of whole texts, chosen by a hash of doc_id: at most
``MOST_CONFIRMED`` and ``MOST_UNLABELLED`` texts and ``MOST_BYTES`` of each. Scoring reads every
whole text; the weights, a table of fixed size, are broadcast.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from firmalign.llm.common import cut_rows, map_arrow, table, texts_of

MOST_CONFIRMED, MOST_UNLABELLED, MOST_BYTES = 2000, 5000, 16 << 20
FEATURES, GRAMS = 1 << 20, (3, 4, 5, 6)
STEPS, RATE, MOMENTUM = 160, 20.0, 0.9
#: The class prior is only known within this factor on a small sample.
PRIOR_MARGIN = 1.2
#: Share of confirmed texts that the threshold may miss, and texts needed to set it by.
MISSED, LEAST_ASIDE = 0.02, 10
#: A feature counts from so many words of confirmed texts on: a hundredth of these texts, in bounds.
LEAST_SEEN, MOST_NEEDED = 3, 10
FOLDS = 5
_WORD = re.compile(r"\w+")
_MOST_KEPT = 200_000


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves no remainder."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(FOLDS)) == 0


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> list[int]:
    """Hashed n-grams of a word with its ends marked."""
    data = f"^{word}$".encode("utf-8", "replace")
    grams = {data[k:k + n] for n in GRAMS for k in range(len(data) - n + 1)}
    grams.add(data)
    return [zlib.crc32(g) & (FEATURES - 1) for g in grams]


@dataclass
class Model:
    """What a feature adds to a text's sum and to its squared length, and the bias."""
    adds: np.ndarray
    squares: np.ndarray
    bias: float

    def scorer(self):
        """Score of a text; what a word adds is kept in a bounded memo."""
        known: dict[str, complex] = {}
        both = self.adds + 1j * self.squares

        def value(word: str) -> complex:
            found = known.get(word)
            if found is None:
                if len(known) >= _MOST_KEPT:
                    known.clear()
                found = known[word] = complex(both[features_of(word)].sum())
            return found

        def score(text: str) -> float:
            total = sum(map(value, words_of(text)))
            z = self.bias + (total.real / total.imag ** 0.5 if total.imag > 0 else 0.0)
            return 1 / (1 + math.exp(-min(max(z, -500.0), 500.0)))
        return score


class _Sample:
    """Texts as their distinct words, and words as their features, both as flat lists."""

    def __init__(self, texts: list[str], n_confirmed: int):
        ids: dict[str, int] = {}
        words, sizes = array("i"), array("i")
        for text in texts:
            own = sorted(words_of(text))
            words.extend([ids.setdefault(w, len(ids)) for w in own])
            sizes.append(len(own))
        grams, counts = array("i"), array("i")
        for word in ids:
            own = features_of(word)
            grams.extend(own)
            counts.append(len(own))
        self.n_docs, self.n_words = len(texts), len(ids)
        self.words = np.frombuffer(words, np.int32)
        self.doc = np.repeat(np.arange(self.n_docs, dtype=np.int32), np.frombuffer(sizes, np.int32))
        self.grams = np.frombuffer(grams, np.int32)
        self.gram_word = np.repeat(np.arange(self.n_words, dtype=np.int32),
                                   np.frombuffer(counts, np.int32))
        seen = np.bincount(self.words, minlength=self.n_words).astype(float)
        own = np.bincount(self.words[self.doc < n_confirmed], minlength=self.n_words).astype(float)
        total = np.bincount(self.grams, seen[self.gram_word], FEATURES)
        confirmed = np.bincount(self.grams, own[self.gram_word], FEATURES)
        least = min(max(LEAST_SEEN, n_confirmed // 100), MOST_NEEDED)
        # Frequent features weigh less; those of few confirmed words could only be learnt by heart.
        self.scale = np.where(confirmed >= least, 1 / np.sqrt(1 + total), 0.0)
        used = self.scale[self.grams] > 0
        self.grams, self.gram_word = self.grams[used], self.gram_word[used]
        squares = np.bincount(self.gram_word, self.scale[self.grams] ** 2, self.n_words)
        length = np.bincount(self.doc, squares[self.words], self.n_docs)
        self.per_doc = np.where(length > 0, 1 / np.sqrt(np.maximum(length, 1e-300)), 0.0)

    def scores(self, weights: np.ndarray, bias: float) -> np.ndarray:
        word = np.bincount(self.gram_word, (weights * self.scale)[self.grams], self.n_words)
        return bias + np.bincount(self.doc, word[self.words], self.n_docs) * self.per_doc

    def gradient(self, by_doc: np.ndarray) -> tuple[np.ndarray, float]:
        word = np.bincount(self.words, (by_doc * self.per_doc)[self.doc], self.n_words)
        return (np.bincount(self.grams, word[self.gram_word], FEATURES) * self.scale,
                float(by_doc.sum()))


def train(confirmed: list[str], unlabelled: list[str], prior: float, steps: int = STEPS,
          rate: float = RATE) -> Model:
    """Minimise the non-negative risk with the logistic loss by gradient descent with momentum.

    Without confirmed or unlabelled texts nothing can be learnt and every score is near zero.
    """
    if not confirmed or not unlabelled:
        return Model(np.zeros(FEATURES, np.float32), np.zeros(FEATURES, np.float32), -20.0)
    sample = _Sample(confirmed + unlabelled, len(confirmed))
    known = np.arange(sample.n_docs) < len(confirmed)
    n_known, n_rest = len(confirmed), len(unlabelled)
    weights, bias = np.zeros(FEATURES), 0.0
    speed, bias_speed = np.zeros(FEATURES), 0.0
    for _ in range(steps):
        z = sample.scores(weights, bias)
        p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        as_clean = np.logaddexp(0, z)
        clean_risk = as_clean[~known].mean() - prior * as_clean[known].mean()
        clean = np.where(known, -prior / n_known, 1 / n_rest) * p
        toxic = np.where(known, -prior / n_known, 0.0) * (1 - p)
        grad, bias_grad = sample.gradient(toxic + clean if clean_risk >= 0 else -clean)
        speed = MOMENTUM * speed - rate * grad
        bias_speed = MOMENTUM * bias_speed - rate / 20 * bias_grad
        weights += speed
        bias += bias_speed
    return Model((weights * sample.scale).astype(np.float32),
                 (sample.scale ** 2).astype(np.float32), bias)


def calibrated(model: Model, confirmed: list[str], unlabelled: list[str], prior: float) -> Model:
    """Lower the threshold, on texts not trained on, to where it misses ``MISSED`` of the confirmed
    ones, but not so far that many more unlabelled ones than the class prior are called toxic."""
    if len(confirmed) < LEAST_ASIDE or len(unlabelled) < LEAST_ASIDE:
        return model
    score_of = model.scorer()
    logit = lambda texts: [math.log(p / (1 - p)) for p in (
        min(max(score_of(t), 1e-12), 1 - 1e-12) for t in texts)]
    cut = max(np.quantile(logit(confirmed), MISSED), np.quantile(
        logit(unlabelled), max(0.0, 1 - PRIOR_MARGIN * prior)))
    return replace(model, bias=model.bias - min(float(cut), 0.0))


def train_and_calibrate(confirmed: list[str], unlabelled: list[str], prior: float) -> Model:
    """Every fifth text is kept aside for the threshold."""
    model = train([t for k, t in enumerate(confirmed) if k % 5],
                  [t for k, t in enumerate(unlabelled) if k % 5], prior)
    return calibrated(model, confirmed[::5], unlabelled[::5], prior)


def _texts(docs: DataFrame, sizes: DataFrame, most: int) -> list[str]:
    """At most ``most`` whole texts and MOST_BYTES, by a hash of doc_id.

    A text that does not fit is passed over, and those above a twentieth of MOST_BYTES come last, so
    a few very long texts do not take the place of all others.
    The ids are picked from narrow rows; as there are few, they go to the texts, not texts to them.
    """
    order = F.xxhash64("doc_id")
    picked = sizes.groupBy("doc_id").agg(F.max("size").alias("size")).orderBy(
        F.col("size") > MOST_BYTES // 20, order, "doc_id").limit(most).collect()
    ids, total = [], 0
    for row in picked:
        if ids and total + row["size"] > MOST_BYTES:
            continue
        total += row["size"]
        ids.append((row["doc_id"],))
    if not ids:
        return []
    chosen = docs.sparkSession.createDataFrame(ids, "doc_id bigint")
    rows = docs.join(F.broadcast(chosen), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.max("text").alias("text")).orderBy(order, "doc_id").collect()
    return [r["text"] for r in rows]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on a bounded sample. Only labels of rows that aren't held out are read.

    Rows without a doc_id or a text are not trained on, and a repeated doc_id counts once.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.col("text").cast("string").alias("text")).where(
        "text IS NOT NULL AND doc_id IS NOT NULL")
    sizes = texts.select("doc_id", F.octet_length("text").alias("size"))
    learnt = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").where(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    share = learnt.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("prior")).first()["prior"]
    toxic = learnt.where("toxic = 1").select("doc_id").distinct()
    return train_and_calibrate(
        _texts(texts, sizes.join(toxic, "doc_id", "left_semi"), MOST_CONFIRMED),
        _texts(texts, sizes, MOST_UNLABELLED), share or 0.0)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every document; a missing text is an empty one.

    Repeated rows each give a row, a missing doc_id is kept, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches) -> Iterator[list]:
        score_of = shared.value.scorer()
        for batch in cut_rows(batches):
            yield [batch.column(0), [score_of(t) for t in texts_of(batch.column(1))]]

    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")),
                     run, "doc_id bigint, score double")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, with all their columns, that score below one half."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score_of = shared.value.scorer()
        for batch in cut_rows(batches):
            yield batch.filter(pa.array([score_of(t) < 0.5 for t in texts_of(batch.column(at))],
                                        pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
