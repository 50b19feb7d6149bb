"""Ranked lexical search over norm buckets of impact vectors.

A document is a vector of integer impacts, one for each term that some item asks for; an item is a
vector of term weights. A score is their inner product. Vectors are taken longest first, in
buckets. A bucket is passed over for an item whose length times the bucket's greatest length
can't reach the item's k-th best score so far (Cauchy-Schwarz). Inside a bucket the item's heaviest
coordinates are multiplied out, and Cauchy-Schwarz bounds the rest by the two vectors' remaining
lengths. What survives both is rescored in 64-bit integers.

Items are searched for in passes of at most ``PASS_BYTES`` of text, whose vocabulary goes to every
task; a task keeps the k best of each item, and these meet in two window steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from firmalign.llm.common import cut_lineage, cut_rows, map_arrow, table

PASS_BYTES = 8 << 20
#: Vectors sorted together, vectors of a bucket, items and terms compared with a bucket at once.
SORTED, BUCKET, GROUP_ITEMS, GROUP_TERMS = 16384, 256, 256, 4096
#: Coordinates of an item multiplied out before the rest is bounded.
FOCUS = 8
#: Room for the rounding of lengths, which are doubles; products of impacts and weights are exact.
SLACK = 1 + 1e-9

_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(
    range(0x7B, 0x80))
_TERMS = bytes.maketrans(_SEPARATORS + bytes(range(65, 91)),
                         b" " * len(_SEPARATORS) + bytes(range(97, 123)))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text in order, only A-Z lower-cased."""
    return text.translate(_TERMS).split()


@dataclass
class Items:
    """The items of a pass: their ids, the terms they ask for and how often."""
    ids: list
    counts: list[Counter]

    def __post_init__(self):
        self.vocabulary = {t: k for k, t in enumerate(dict.fromkeys(
            t for own in self.counts for t in own))}


# ---------------------------------------------------------------- vectors
def _vectors(documents: DataFrame, items: Items) -> DataFrame:
    """(doc_id, n, terms, tfs): number of terms, and the items' terms with their occurrences."""
    vocabulary = items.vocabulary
    size = max(len(vocabulary), 1)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in cut_rows(batches):
            found, ns = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                own = terms_of(text or b"")
                ns.append(len(own))
                found.append(np.array([k for k in map(vocabulary.get, own) if k is not None],
                                      np.int64))
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            keys, tfs = np.unique(rows * size + np.concatenate([*found, np.zeros(0, np.int64)]),
                                  return_counts=True)
            ends = np.searchsorted(keys, np.arange(len(found) + 1) * size).astype(np.int32)
            yield [batch.column(0), ns,
                   pa.ListArray.from_arrays(ends, (keys % size).astype(np.int32)),
                   pa.ListArray.from_arrays(ends, tfs.astype(np.int64))]

    return map_arrow(documents.select("doc_id", "text"), run,
                     "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2 df + 1))) for each document frequency."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1)))
                     for d in df], np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Integer impact of a term that occurs tf times among the n terms of a document."""
    m = 100 - 75 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


# ---------------------------------------------------------------- search inside a task
class _Group:
    """Some items, the terms they ask for as columns, and the best documents found so far."""

    def __init__(self, numbers: list[int], vectors: list[dict[int, int]], k: int, n_vocabulary: int):
        self.numbers, self.k = numbers, k
        used = sorted({t for v in vectors for t in v})
        self.column = np.full(n_vocabulary, -1, np.int64)
        self.column[used] = np.arange(len(used))
        self.exact = np.zeros((len(vectors), len(used)), np.int64)
        for row, v in enumerate(vectors):
            for t, w in v.items():
                self.exact[row, self.column[t]] = w
        # Impacts are never negative, so negative weights only lower a score.
        positive = np.maximum(self.exact, 0).astype(float)
        focus = np.zeros_like(positive)
        if used:
            top = np.argsort(-positive, axis=1, kind="stable")[:, :FOCUS]
            np.put_along_axis(focus, top, np.take_along_axis(positive, top, 1), 1)
        self.length = np.sqrt((positive ** 2).sum(1)) * SLACK
        self.rest = np.sqrt(((positive - focus) ** 2).sum(1)) * SLACK
        self.focused = np.flatnonzero(focus.any(0))
        self.focus = focus[:, self.focused]
        self.marks = (self.focus > 0).astype(float)
        self.best: list[list[tuple]] = [[] for _ in vectors]
        self.least = np.zeros(len(vectors))
        self.bucket = max(8, min(BUCKET, (1 << 20) // max(len(used), 1)))

    def search(self, ids: list, row: np.ndarray, term: np.ndarray, impact: np.ndarray) -> None:
        """Compare the vectors given as (row, term, impact) entries in the order of rows."""
        column = self.column[term]
        keep = column >= 0
        row, column, impact = row[keep], column[keep], impact[keep]
        square = np.bincount(row, impact.astype(float) ** 2, len(ids))
        order = np.argsort(-square, kind="stable")
        order = order[:np.count_nonzero(square)]
        begins = np.searchsorted(row, np.arange(len(ids) + 1))
        for at in range(0, len(order), self.bucket):
            docs = order[at:at + self.bucket]
            reach = self.length * math.sqrt(square[docs[0]]) * SLACK
            alive = np.flatnonzero((reach >= self.least) & (reach > 0))
            if not len(alive):      # lengths only fall from here on, and the k-th scores rise
                return
            sizes = begins[docs + 1] - begins[docs]
            entry = _ranges(begins[docs], sizes)
            local = np.repeat(np.arange(len(docs)), sizes)
            dense = np.zeros((len(docs), self.exact.shape[1]))
            dense[local, column[entry]] = impact[entry]
            near = dense[:, self.focused]
            partial = near @ self.focus[alive].T
            left = square[docs][:, None] * SLACK - (near ** 2) @ self.marks[alive].T
            bound = partial + self.rest[alive] * np.sqrt(np.maximum(left, 0)) * SLACK
            r, q = np.nonzero((bound >= self.least[alive]) & (bound > 0))
            self._rescore(ids, docs, alive[q], r, begins, sizes, column, impact)

    def _rescore(self, ids, docs, item, r, begins, sizes, column, impact) -> None:
        for at in range(0, len(item), 1 << 14):
            items, rows = item[at:at + (1 << 14)], r[at:at + (1 << 14)]
            n = sizes[rows]
            entry = _ranges(begins[docs[rows]], n)
            product = self.exact[np.repeat(items, n), column[entry]] * impact[entry]
            scores = np.add.reduceat(product, np.cumsum(n) - n)
            good = (scores > 0) & (scores >= self.least[items])
            touched = set()
            for i, doc, score in zip(items[good].tolist(), docs[rows[good]].tolist(),
                                     scores[good].tolist()):
                self.best[i].append((-score, ids[doc] is None, ids[doc]))
                touched.add(i)
            for i in touched:
                best = self.best[i] = sorted(self.best[i], key=_place)[:self.k]
                if len(best) == self.k:
                    self.least[i] = -best[-1][0]

    def rows(self) -> Iterator[tuple]:
        for number, best in zip(self.numbers, self.best):
            for score, _, doc_id in best:
                yield number, doc_id, -score


def _place(found: tuple) -> tuple:
    score, missing, doc_id = found
    return score, missing, 0 if missing else doc_id


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... for sizes[0] numbers, then on from begins[1]."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


def _groups(vectors: list[dict[int, int]], k: int, n_vocabulary: int) -> list[_Group]:
    groups, numbers, terms = [], [], set()
    for number, vector in enumerate(vectors):
        if numbers and (len(numbers) == GROUP_ITEMS or len(terms | set(vector)) > GROUP_TERMS):
            groups.append(_Group(numbers, [vectors[i] for i in numbers], k, n_vocabulary))
            numbers, terms = [], set()
        numbers.append(number)
        terms |= set(vector)
    if numbers:
        groups.append(_Group(numbers, [vectors[i] for i in numbers], k, n_vocabulary))
    return groups


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        kept.append(batch)
        if sum(b.num_rows for b in kept) >= rows:
            yield pa.concat_batches(kept)
            kept = []
    if kept:
        yield pa.concat_batches(kept)


def _best_of_tasks(vectors: DataFrame, queries: list[dict[int, int]], n_vocabulary: int,
                   n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best documents of each item among those of each task."""
    def run(batches: Iterator[pa.RecordBatch]):
        groups = _groups(queries, k, n_vocabulary)
        for batch in _gathered(batches, SORTED):
            lists = batch.column(2)
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            term = lists.flatten().to_numpy()
            tf = batch.column(3).flatten().to_numpy()
            n = batch.column(1).to_numpy()[row]
            impact, ids = impacts(tf, n, n_docs, n_terms), batch.column(0).to_pylist()
            for group in groups:
                group.search(ids, row, term, impact)
        found = [r for group in groups for r in group.rows()]
        yield [list(c) for c in zip(*found)] if found else [[], [], []]

    return map_arrow(vectors, run, "item int, doc_id bigint, score bigint")


# ---------------------------------------------------------------- whole search
def _passes(items: DataFrame) -> Iterator[list]:
    """Distinct (item_id, text) rows, about ``PASS_BYTES`` of text at a time."""
    items = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-size // PASS_BYTES)
    for number in range(n):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == number).collect()


def _ranked(df: DataFrame, k: int, *more: Column | str) -> DataFrame:
    order = Window.partitionBy("item", *more).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of highest score above 0 for each item.

    ``documents`` has doc_id and text, ``items`` item_id and text; further columns are ignored.
    Rows of one doc_id are documents of their own and may both be listed. Repeated (item_id, text)
    rows count once; one item_id with two texts is two searches. A missing or empty text has no
    terms: such an item has no rows, such a document is not counted and never found. Equal scores
    go by ascending doc_id, a missing one last. Empty tables give no rows. Texts of any length are
    read whole, a batch of about 8 MB (or one longer text) at a time.
    """
    spark, out, totals = documents.sparkSession, None, None
    for rows in _passes(items):
        pass_ = Items([r["item_id"] for r in rows],
                      [Counter(terms_of(r["text"].encode())) for r in rows])
        vectors = cut_lineage(_vectors(documents, pass_), "impact-vectors")
        if totals is None:
            totals = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"),
                                 F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if not totals["terms"]:
            break
        df = np.zeros(len(pass_.vocabulary), np.int64)
        for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r["t"]] = r["count"]
        weight = weights(df, totals["docs"]).tolist()
        queries = [{pass_.vocabulary[t]: n * weight[pass_.vocabulary[t]] for t, n in own.items()}
                   for own in pass_.counts]
        found = _best_of_tasks(vectors, queries, len(df), totals["docs"], totals["terms"], k)
        found = _ranked(found, k, F.pmod(F.xxhash64("doc_id"), F.lit(64))).drop("rank")
        names = spark.createDataFrame(
            list(enumerate(pass_.ids)), f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        best = _ranked(found, k).join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    if out is None:
        kind = items.schema["item_id"].dataType.simpleString()
        out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return out


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_TERMS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
              r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

ORACLE_SQL = f"""
with docs as (
    select row_number() over () as d, doc_id, {_SQL_TERMS} as terms from documents),
items as (
    select row_number() over () as q, item_id, {_SQL_TERMS} as terms
    from (select distinct item_id, coalesce(text, '') as text from benchmark)),
totals as (
    select cast(count(*) as bigint) as n_docs, cast(sum(len(terms)) as bigint) as n_terms
    from docs where len(terms) > 0),
asked as (
    select q, item_id, term, cast(count(*) as bigint) as qtf
    from (select q, item_id, unnest(terms) as term from items) group by all),
counted as (
    select d, doc_id, n, term, cast(count(*) as bigint) as tf
    from (select d, doc_id, cast(len(terms) as bigint) as n, unnest(terms) as term from docs)
    where term in (select term from asked) group by all),
weighed as (
    select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
    from counted, totals group by term, n_docs),
scored as (
    select q, item_id, d, doc_id, cast(sum(qtf * w * ((1000000000 * tf)
        // (1000 * tf + 8 * (100 - 75 + (75 * n * n_docs) // n_terms)))) as bigint) as score
    from asked join weighed using (term) join counted using (term), totals
    group by q, item_id, d, doc_id),
ranked as (
    select *, row_number() over (partition by q order by score desc, doc_id nulls last) as place
    from scored where score > 0)
select item_id, cast(place as integer) as rank, doc_id, score from ranked where place <= 10
"""
