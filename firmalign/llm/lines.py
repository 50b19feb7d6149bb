"""Quality rules with cross-document line frequency.

Normalised lines are hashed and the distinct documents of each host that hold a line are counted;
documents with the same text count once, so exact copies do not make a line frequent. A line from
the limit on is removed and a document that loses too much is rejected. The limit grows with the
square root of the number of documents of the host, as a share it falls: what many of a large host's
documents hold by chance isn't removed, and what a hundredth of them holds is. Lines of few words,
which recur by chance more often, have a higher one. The plain counts of a document's own text come
first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from firmalign.llm import textwords
from firmalign.llm.common import cut_lineage, cut_rows, map_arrow, table, texts_of

#: A line is frequent in a host from so many distinct documents on, and from this many times the
#: square root of the host's documents on, raised in proportion for lines of fewer words than these.
LEAST_DOCS, ROOT_SHARE, FULL_LINE = 6, 0.4, 6
#: A document is depleted if more than this percentage of its words is in frequent lines.
MOST_LOST_PERCENT = 50
MIN_WORDS, MAX_REPEAT_PERCENT, RUN = 10, 20, 5
_SPACE = " \t\n\v\f\r"
_ONE_SPACE = str.maketrans(dict.fromkeys(_SPACE, " "))
_COUNT_SPACE = str.maketrans("", "", _SPACE)
_SYMBOLS = "#*$%&|<>"
FACTS = ("uid bigint, doc_id bigint, host string, text_hash bigint, n_words bigint, "
         "word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
         "lines array<bigint>, line_words array<int>")


def repeated_words(words: np.ndarray, bounds: np.ndarray, length: int = RUN) -> np.ndarray:
    """Per text, the words within runs of ``length`` words that occur twice or more in it."""
    hashes, at = textwords.run_hashes(words, bounds, length)
    hit = np.zeros(len(words) + 1, np.int64)
    if len(at):
        text = np.searchsorted(bounds, at, "right").astype(np.uint64)
        keyed = textwords.mix(hashes + text * np.uint64(0xD6E8FEB86659FD93))
        order = np.argsort(keyed)
        same = keyed[order][1:] == keyed[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(hit, at[twice], 1)
        np.add.at(hit, at[twice] + length, -1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(hit[:-1]) > 0)))
    return covered[bounds[1:]] - covered[bounds[:-1]]


def _signed(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def _facts(batches) -> Iterator[list]:
    uid = TaskContext.get().partitionId() << 33
    for batch in cut_rows(batches, 2 << 20):
        words, bounds = textwords.word_hashes(batch.column(2))
        rows = []
        for doc_id, host, text, n, repeat in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                texts_of(batch.column(2)), np.diff(bounds).tolist(),
                repeated_words(words, bounds).tolist(), strict=True):
            seen, dup, hashes, counts = set(), 0, [], []
            for line in text.split("\n"):
                parts = line.lower().translate(_ONE_SPACE).split(" ")
                parts = [p for p in parts if p]
                if not parts:
                    hashes.append(None)
                    counts.append(0)
                    continue
                dup += line in seen
                seen.add(line)
                hashes.append(_signed(" ".join(parts)))
                counts.append(len(parts))
            chars = len(text.translate(_COUNT_SPACE)) if n else 0
            rows.append((uid, doc_id, host, _signed(text), n, chars,
                         sum(map(text.count, _SYMBOLS)), dup, repeat, hashes, counts))
            uid += 1
        yield [list(c) for c in zip(*rows, strict=True)]


def line_quality(docs: DataFrame, host: str = "source", least_docs: int = LEAST_DOCS,
                 root_share: float = ROOT_SHARE,
                 most_lost_percent: float = MOST_LOST_PERCENT) -> DataFrame:
    """Counts, verdict and removed lines (numbers from 0) of every document.

    ``docs`` needs doc_id, text and the host column; others are ignored. A missing text has no
    words and fails, a missing host is a host of its own, a missing doc_id is kept, and repeated
    rows each get a row. Texts of any length are read whole. Without frequent lines
    ``removed_lines`` is empty; an empty table gives no rows. Words are what the base counts take
    for words, also in normalised lines.
    """
    facts = cut_lineage(map_arrow(docs.select(
        F.col("doc_id").cast("bigint"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.col("text").cast("string")), _facts, FACTS), "line-facts")
    held = facts.select("uid", "host", "text_hash", F.posexplode(F.arrays_zip(
        "lines", "line_words")).alias("at", "line")).select(
            "uid", "host", "text_hash", "at", F.col("line.lines").alias("line"),
            F.col("line.line_words").alias("words")).where("line IS NOT NULL")
    sizes = facts.select("host", "text_hash").distinct().groupBy("host").agg(
        F.count(F.lit(1)).alias("size"))
    often = held.select("host", "line", "words", "text_hash").distinct().groupBy("host", "line").agg(
        F.count(F.lit(1)).alias("docs"), F.min("words").alias("words")).where(
            F.col("docs") >= least_docs)
    limit = root_share * F.sqrt("size") * F.greatest(F.lit(1.0), FULL_LINE / F.col("words"))
    frequent = cut_lineage(often.join(sizes, "host").where(F.col("docs") >= limit).select(
        "host", "line"), "frequent-lines")
    removed = held.join(frequent, ["host", "line"]).groupBy("uid").agg(
        F.sum("words").alias("lost"), F.array_sort(F.collect_list("at")).alias("removed_lines"))
    lost = F.coalesce("lost", F.lit(0))
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    depleted = (lost * 100 > F.col("n_words") * most_lost_percent) | (
        (lost > 0) & (F.col("n_words") - lost < MIN_WORDS))
    return facts.join(removed, "uid", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), lost.cast("bigint").alias("lost_words"),
        F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
        (~failed & ~depleted).alias("kept"))


def without_lines(text: Column | str, removed: Column | str) -> Column:
    """The text without the lines of the given numbers."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line, k:
                                 ~F.array_contains(removed, k)), "\n")


def op10_line_quality(spark, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lost_words")
