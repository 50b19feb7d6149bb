"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test strings are the windows of consecutive words of the benchmark items. For test strings of one
length, a shift table says for each block of two words how far the search may jump: by the whole
length less one where the block is in no test string, so most words are never looked at. Where a
block ends some test string the shift is zero, its bucket holds those strings by their first
block, and they are compared word by word.

Distinct items are read in blocks of bounded size. One block at a time goes to the tasks and is
searched for in all documents; with more than one, the documents that hold some of its test strings are
written before the next is read, so neither the driver nor a task ever holds more than a block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from firmalign.llm.common import cut_lineage, cut_rows, map_arrow, table, texts_of

WINDOW = 10
#: Text of the benchmark that is searched for at once; its tables take about a hundred times that.
BLOCK_BYTES = 2 << 20

#: Lower-cases A-Z and blanks every other ASCII character that is neither a letter nor a digit.
_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
                  else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TO_WORDS).split()


class WuManber:
    """Search for test strings of one length, given as word tuple -> item ids."""

    def __init__(self, strings: dict[tuple, set]):
        self.length = len(next(iter(strings)))
        self.block = min(2, self.length)
        self.strings = strings
        self.jump = self.length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
        for string in strings:
            for end in range(self.block, self.length + 1):
                block = string[end - self.block:end]
                self.shift[block] = min(self.shift.get(block, self.jump), self.length - end)
            self.buckets[string[-self.block:]][string[:self.block]].append(string)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(start, item ids) of each occurrence, by start."""
        length, block, jump, shift = self.length, self.block, self.jump, self.shift.get
        end, n = length, len(words)
        while end <= n:
            key = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            far = shift(key, jump)
            if far:
                end += far
                continue
            start = end - length
            for string in self.buckets[key].get(tuple(words[start:start + block]), ()):
                if tuple(words[start:end]) == string:
                    yield start, self.strings[string]
            end += 1


class Matcher:
    """All test strings of some benchmark items, by length."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            words = words_of(text or "")
            size = min(window, len(words))
            for start in range(len(words) - size + 1 if size else 0):
                by_length[size][tuple(words[start:start + size])].add(item_id)
        self.searches = [WuManber(dict(strings)) for strings in by_length.values()]

    def search(self, text: str) -> tuple[int, list[int], set]:
        """Number of words, hit spans (start and end, merged, flat) and items found."""
        words, spans, items = words_of(text), [], set()
        for one in self.searches:
            for start, found in one.find(words):
                spans.append((start, start + one.length))
                items |= found
        return len(words), merged(spans), items


def merged(spans: list[tuple]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (start, end)
    return out


_matchers: dict[int, Matcher] = {}


def _matcher(shared, window: int) -> Matcher:
    """Built once by each worker process; only the latest is kept."""
    if shared.value[0] not in _matchers:
        _matchers.clear()
        _matchers[shared.value[0]] = Matcher(shared.value[1], window)
    return _matchers[shared.value[0]]


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator:
    """Distinct items as broadcasts of bounded size, one at a time: (a key of its own, items)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    keyed = items.withColumn("b", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    context = benchmark.sparkSession.sparkContext
    for k in range(n):
        rows = [(r["item_id"], r["text"]) for r in keyed.where(F.col("b") == k).collect()]
        yield context.broadcast((f"{context.applicationId}-{k}-{hash(tuple(rows))}", rows)), n


def _text_hash():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


STATE = "doc_id bigint, n_words bigint, spans array<bigint>, items array<string>"


def _hits(docs: DataFrame, first, rest: Iterator, window: int) -> DataFrame:
    """(doc_id, text_hash, spans, items) of documents with a test string, a row for each block."""
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"),
                        _text_hash().alias("text_hash"))
    out = None
    for shared in _chained(first, rest):
        found = cut_lineage(map_arrow(texts, _searching(shared, window, hits=True), (
            "doc_id bigint, text_hash bigint, spans array<bigint>, items array<string>")),
            "contaminated")
        shared.destroy()
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def _chained(first, rest: Iterator) -> Iterator:
    yield first
    for shared, _ in rest:
        yield shared


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, spans (hit words, flat pairs), items (sorted ids as strings).

    An item of fewer words than ``window`` is one test string; one without words is none. A missing
    text has no words. A missing item_id is listed as an empty string, repeated items count once,
    repeated documents each give a row, and other columns are ignored. Texts of any length are read
    whole. Without items nothing is hit; without documents there are no rows.
    """
    blocks = _blocks(benchmark, block_bytes)
    first, n = next(blocks)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    if n == 1:
        return map_arrow(texts, _searching(first, window), STATE)
    # Rows of one doc_id and text have the same hits, one row for each block at most.
    hits = _hits(docs, first, blocks, window).groupBy("doc_id", "text_hash").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans", "items")
    joined = texts.withColumn("text_hash", _text_hash()).join(
        hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")

    def run(batches) -> Iterator[list]:
        for batch in cut_rows(batches):
            spans = [merged([*zip(s[::2], s[1::2])]) if s else [] for s in batch.column(2).to_pylist()]
            yield [batch.column(0), [len(words_of(t)) for t in texts_of(batch.column(1))], spans,
                   [i or [] for i in batch.column(3).to_pylist()]]
    return map_arrow(joined.select("doc_id", "text", "spans", "items"), run, STATE)


def _searching(shared, window: int, hits: bool = False):
    """Search the texts; with ``hits`` only rows that have some are returned, with their text's hash."""
    def run(batches) -> Iterator[list]:
        matcher = _matcher(shared, window)
        for batch in cut_rows(batches):
            found = [matcher.search(text) for text in texts_of(batch.column(1))]
            if hits:
                keep = [k for k, (_, spans, _) in enumerate(found) if spans]
                yield [batch.column(0).take(pa.array(keep, pa.int64())),
                       batch.column(2).take(pa.array(keep, pa.int64())),
                       [found[k][1] for k in keep], [sorted(found[k][2]) for k in keep]]
            else:
                yield [batch.column(0), [n for n, _, _ in found], [s for _, s, _ in found],
                       [sorted(i) for _, _, i in found]]
    return run


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, with all their columns, in which no test string occurs.

    A missing or empty text holds none and stays, as does a row without a doc_id; repeated rows stay
    or go alike. Without items all stay. Columns may have any names.
    """
    blocks = _blocks(benchmark, block_bytes)
    first, n = next(blocks)
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(first, window)
        for batch in cut_rows(batches):
            yield batch.filter(pa.array([not matcher.search(t)[1]
                                         for t in texts_of(batch.column(at))], pa.bool_()))
    if n == 1:
        return docs.mapInArrow(clean, docs.schema)
    # Whether a text holds a test string depends on the text alone.
    longest = max(map(len, docs.columns)) * "_" + "hash"      # no column's name
    gone = _hits(docs, first, blocks, window).select(F.col("text_hash").alias(longest)).distinct()
    return docs.join(gone, _text_hash() == F.col(longest), "left_anti")


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))
    signed = F.transform("spans", lambda at, k: F.when(k % 2 == 0, -at).otherwise(at))
    n_hit = F.aggregate(signed, F.lit(0).cast("bigint"), lambda total, at: total + at)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))
