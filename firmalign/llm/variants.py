"""Spelling variants by search schemes over a bidirectional FM-index.

Two words are near if they differ by one inserted, deleted or replaced code point. Then one of two
parts of the shorter one, cut at its middle, stands unchanged at the same end of the other. Words
are therefore dealt out by (shorter length, end, unchanged part), a word under its own length and
the next smaller one, so near words always meet in some group, and groups go to tasks by that key.

A task indexes the distinct words of its groups as one text, each between delimiters, in both
directions. A search matches the unchanged part from the middle outwards to the delimiter, which
keeps the interval of suffix ranks in both directions in step, and then extends across the other
part to the far delimiter, allowing one error. All searches of a kind advance together in numpy, and
letters that follow a pattern are read from its interval once for all searches that share it.

Groups of more than ``MOST_GROUP`` words are dealt out again, by the unchanged half of the part
that holds the error.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from firmalign.llm.common import cut_lineage, cut_rows, map_arrow, table

LEAST_LENGTH, LEAST_COUNT, FORM_FACTOR = 7, 2, 10
#: One run in so many loses a code point.
DELETED_EVERY = 31
#: Words of a group before it is dealt out again, and group members indexed together.
MOST_GROUP, MOST_INDEXED = 1 << 17, 40_000
#: Words of one length searched for at once.
MOST_SEARCHED = 1 << 15
#: Words and code points a task counts before it hands its counts on.
MOST_COUNTED, MOST_CHARS = 1 << 18, 1 << 24

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(0xC0, 0x100))
_RUNS = bytes((c + 32 if 65 <= c <= 90 else c) if c in _LETTERS else 32 for c in range(256))


# ---------------------------------------------------------------- words
def runs_of(text: str) -> list[bytes]:
    """Runs of letters up to U+00FF, only A-Z lower-cased, one Latin-1 byte a code point."""
    return text.encode("latin-1", "replace").translate(_RUNS).split()


def noisy(run: bytes, crc: int) -> bytes:
    """The run without one code point if its checksum, begun with the document's, says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), crc)
    if h % DELETED_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n) of all words of all documents, before any limit but the least length."""
    def run(batches: Iterator[pa.RecordBatch]):
        counts: Counter = Counter()
        chars = 0

        def flushed():
            return [[w.decode("latin-1") for w in counts], list(counts.values())]

        for batch in cut_rows(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                crc = zlib.crc32(f"{doc_id or ''}:".encode())
                own = Counter([w for w in runs_of(text or "") if len(w) >= LEAST_LENGTH])
                for w, n in own.items():
                    w = noisy(w, crc)
                    if len(w) >= LEAST_LENGTH:
                        counts[w] += n
                        chars += len(w)
                if len(counts) >= MOST_COUNTED or chars >= MOST_CHARS:
                    yield flushed()
                    counts.clear()
                    chars = 0
        yield flushed()

    rows = documents.select(F.col("doc_id").cast("string"), "text")
    return map_arrow(rows, run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- groups
def _searches(words: DataFrame) -> DataFrame:
    """(word, n, m, side, kept, until, other, key): the groups a word belongs to.

    A group holds words of m and m + 1 code points that agree in ``kept`` code points at one end,
    the left one if ``side`` is 'L'. Searched for is one error before position ``until``, counted
    from that end. A word that also agrees in ``other`` code points at the left end belongs to
    another group and isn't counted here.
    """
    length = F.length("word")
    lengths = F.filter(F.array(length, length - 1), lambda m: m >= LEAST_LENGTH)
    rows = words.withColumn("m", F.explode(lengths)).withColumn("a", F.floor(F.col("m") / 2).cast("int"))
    groups = F.expr("""inline(array(
        struct('L' AS side, a AS kept, m AS until, 0 AS other, left(word, a) AS part),
        struct('R' AS side, m - a AS kept, m AS until, a AS other, right(word, m - a) AS part)))""")
    return rows.select("word", "n", "m", groups).withColumn(
        "key", F.concat_ws(":", "side", "m", "part")).drop("part")


def _dealt_again(rows: DataFrame, most_group: int) -> DataFrame:
    """Groups of too many words split by the unchanged half of the part with the error.

    The unchanged end stays; of the part with the error either the inner or the outer half, next
    to or away from that end, is unchanged, too.
    """
    large = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"))
             .where(F.col("size") > most_group).select("key", F.lit(True).alias("large")))
    rows = rows.join(large, "key", "left")
    half = "((m - kept) div 2)"
    # Inner: that half adds to the end kept. Outer: the rest of the word at the other end is kept.
    again = rows.where("large").selectExpr("*", f"CAST({half} AS INT) AS h").selectExpr(
        "word", "n", "m", "side", "key AS outer_key", "kept", "other", "h",
        "inline(array(struct('i' AS kind), struct('o' AS kind)))")
    # Outer groups keep both ends: 'until' stops short of the far part.
    split = again.selectExpr(
        "word", "n", "m", "side",
        "IF(kind = 'i', kept + h, kept) AS kept",
        "IF(kind = 'i', m, kept + h) AS until",
        # Left groups give way to inner ones, right groups to outer ones: each pair counts once.
        "CASE WHEN side = 'L' THEN IF(kind = 'i', 0, kept + h) "
        "ELSE IF(kind = 'i', m - kept - h, other) END AS other",
        "concat_ws(':', outer_key, kind, CASE "
        "WHEN (side = 'L') = (kind = 'i') THEN left(word, IF(kind = 'i', kept + h, m - kept - h)) "
        "ELSE right(word, IF(kind = 'i', kept + h, m - kept - h)) END) AS key")
    return rows.where("large IS NULL").select(*split.columns).unionByName(split)


# ---------------------------------------------------------------- index
_STEP = 32
_PLACES = np.arange(_STEP, dtype=np.uint8)


class _Direction:
    """Backward search in a text given as symbols 1..; 1 is the delimiter, 0 ends the text."""

    def __init__(self, text: np.ndarray, n_symbols: int):
        self.text = np.append(text, 0).astype(np.uint8)
        self.suffixes = _suffix_array(self.text)
        last = self.text[self.suffixes - 1]
        n = len(last)
        padded = np.full(-(-(n + 1) // _STEP) * _STEP, 255, np.uint8)
        padded[:n] = last
        self.last = padded.reshape(-1, _STEP)
        each = np.repeat(np.arange(len(self.last)), _STEP)[:n]
        tallies = np.bincount(each * n_symbols + last, minlength=len(self.last) * n_symbols)
        tallies = tallies.reshape(-1, n_symbols)
        self.before = (np.cumsum(tallies, 0) - tallies).astype(np.int32)
        self.below = np.cumsum(self.before, 1, dtype=np.int32)
        self.first = np.append(0, np.cumsum(tallies.sum(0)))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often a symbol precedes one of the first ``at`` suffixes."""
        step, rest = at // _STEP, (at % _STEP).astype(np.uint8)
        hits = (self.last[step] == symbol.astype(np.uint8)[:, None]) & (_PLACES < rest[:, None])
        return self.before[step, symbol] + np.count_nonzero(hits, 1)

    def smaller(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` suffixes a smaller symbol precedes."""
        step, rest = at // _STEP, (at % _STEP).astype(np.uint8)
        hits = (self.last[step] < symbol.astype(np.uint8)[:, None]) & (_PLACES < rest[:, None])
        return self.below[step, symbol - 1] + np.count_nonzero(hits, 1)

    def extend(self, symbol: np.ndarray, low: np.ndarray, size: np.ndarray):
        """Interval of the patterns with a symbol put before them."""
        begin = self.rank(symbol, low)
        return self.first[symbol] + begin, self.rank(symbol, low + size) - begin


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes: eight symbols at first, then twice as many in each round."""
    n, width = len(text), 8
    padded = np.append(text, np.zeros(width, np.uint8))
    key = np.zeros(n, np.uint64)
    for k in range(width):
        key = key << np.uint64(8) | padded[k:k + n]
    while True:
        order = np.argsort(key, kind="stable")
        changes = np.append(0, np.cumsum(key[order][1:] != key[order][:-1]))
        if changes[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = changes
        after = np.zeros(n, np.int64)
        after[:-width or None] = rank[width:] + 1 if width < n else 0
        key = (rank.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64)
        width *= 2


class Index:
    """Both directions of a delimited vocabulary; ``turned`` swaps them, so that left is right."""

    def __init__(self, words: list[bytes]):
        self.words = words
        raw = np.frombuffer(b"\x01" + b"\x01".join(words) + b"\x01", np.uint8)
        self.code = np.zeros(256, np.uint8)
        used = np.unique(raw)
        self.code[used] = np.arange(1, len(used) + 1)     # the delimiter is smallest, so 1
        self.n_symbols = len(used) + 1
        text = self.code[raw]
        self.forward = _Direction(text, self.n_symbols)
        self.backward = _Direction(text[::-1], self.n_symbols)
        lengths = np.array([len(w) for w in words])
        starts = np.append(0, np.cumsum(lengths + 1)[:-1])    # of the delimiter before each word
        self.starts, self.size, self.is_turned = starts, len(raw), False

    def turned(self) -> "Index":
        other = object.__new__(Index)
        other.__dict__ = self.__dict__ | {
            "forward": self.backward, "backward": self.forward, "is_turned": not self.is_turned}
        return other

    def words_at(self, low: np.ndarray) -> np.ndarray:
        """Word whose both delimiters the patterns of the backward text include."""
        # In the text read backwards such a pattern begins at the delimiter after the word.
        at = self.size - 1 - self.backward.suffixes[low]
        if self.is_turned:
            at = self.size - 1 - at
            return np.searchsorted(self.starts, at, "right") - 1
        return np.searchsorted(self.starts, at, "left") - 1

    # ------------------------------------------------------------ search scheme
    def one_error(self, patterns: np.ndarray, kept: int, until: int) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word) of words that differ by one replaced or added letter.

        ``patterns`` is a matrix of symbols, one pattern a row. The first ``kept`` letters agree
        and the error lies before position ``until``.
        """
        n, m = patterns.shape
        low, back, size = self._matched(patterns, kept)
        who = np.arange(n)
        right = self.backward
        empty = np.zeros(0, np.int64)
        e_who, e_low, e_size = empty, empty, empty       # states with their error behind them
        for at in range(kept, m + 1):
            added = changed = (empty,) * 3
            if at <= until:
                node, nodes = _grouped(back)
                n_low, n_size = back[nodes], size[nodes]
                c_node, c_symbol, c_low, c_size = self._children(n_low, n_size)
                begins = np.searchsorted(c_node, np.arange(len(nodes) + 1))
                counts = begins[node + 1] - begins[node]
                child = _ranges(begins[node], counts)
                state = np.repeat(np.arange(len(who)), counts)
                other = c_symbol[child] > 1
                if at < m:
                    differs = other & (c_symbol[child] != patterns[who[state], at])
                else:
                    differs = other
                # A letter equal to the next one is added after it instead: each word once.
                insert = other if at == until else differs
                added = who[state[insert]], c_low[child[insert]], c_size[child[insert]]
                if at < until:
                    changed = who[state[differs]], c_low[child[differs]], c_size[child[differs]]
            e_who, e_low, e_size = (np.concatenate(p) for p in zip((e_who, e_low, e_size), added))
            if at == m:
                break
            e_who, e_low, e_size = _extended(right, patterns[e_who, at], e_who, e_low, e_size)
            who, back, size = _extended(right, patterns[who, at], who, back, size)
            e_who, e_low, e_size = (np.concatenate(p) for p in zip((e_who, e_low, e_size), changed))
        e_who, e_low, e_size = _extended(right, np.ones(len(e_who), np.int64), e_who, e_low, e_size)
        return e_who, self.words_at(e_low)

    def _matched(self, patterns: np.ndarray, kept: int):
        """Intervals, in both directions, of the delimiter and the first ``kept`` letters."""
        n = len(patterns)
        low, back = np.zeros(n, np.int64), np.zeros(n, np.int64)
        size = np.full(n, self.size + 1, np.int64)
        for at in range(kept - 1, -2, -1):
            symbol = patterns[:, at] if at >= 0 else np.ones(n, np.int64)
            smaller = (self.forward.smaller(symbol, low + size) - self.forward.smaller(symbol, low))
            low, fewer = self.forward.extend(symbol, low, size)
            back, size = back + smaller, fewer
        return low, back, size

    def _children(self, low: np.ndarray, size: np.ndarray):
        """(interval, symbol, low, size) of every letter that follows the pattern of an interval."""
        right = self.backward
        node = np.repeat(np.arange(len(low)), size)
        symbol = right.last.reshape(-1)[_ranges(low, size)].astype(np.int64)
        keys, counts = np.unique(node * self.n_symbols + symbol, return_counts=True)
        node, symbol = keys // self.n_symbols, keys % self.n_symbols
        return node, symbol, right.first[symbol] + right.rank(symbol, low[node]), counts


def _grouped(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the interval of each state, and one state of each interval."""
    _, first, number = np.unique(low, return_index=True, return_inverse=True)
    return number, first


def _extended(side: _Direction, symbol, who, low, size):
    low, size = side.extend(symbol.astype(np.int64), low, size)
    keep = size > 0
    return who[keep], low[keep], size[keep]


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - ends + sizes, sizes)


# ---------------------------------------------------------------- near words
def _near_in(words: list[bytes], n: np.ndarray, searches: dict[tuple, np.ndarray]):
    """(word, near words, best n, best word) within the words of some groups.

    ``searches`` maps (m, side, kept, until, other) to the numbers of the words to search for.
    """
    index = Index(words)
    mirrored = index.turned()
    left, right = [], []
    slices = [(kind, numbers[at:at + MOST_SEARCHED]) for kind, numbers in searches.items()
              for at in range(0, len(numbers), MOST_SEARCHED)]
    for (m, side, kept, until, other), numbers in slices:
        letters = np.frombuffer(b"".join([words[i] for i in numbers]), np.uint8).reshape(-1, m)
        symbols = index.code[letters].astype(np.int64)
        if side == "L":
            who, found = index.one_error(symbols, kept, until)
        else:
            who, found = mirrored.one_error(symbols[:, ::-1], kept, until)
        who = numbers[who]
        if other and len(who):
            elsewhere = np.array([words[a][:other] == words[b][:other]
                                  for a, b in zip(who.tolist(), found.tolist())])
            who, found = who[~elsewhere], found[~elsewhere]
        # A word of the same length is searched for itself and finds this one; a longer one isn't.
        longer = np.array([len(words[b]) for b in found.tolist()]) > m if len(found) else np.zeros(0, bool)
        left += [who, found[longer]]
        right += [found, who[longer]]
    a, b = np.concatenate(left), np.concatenate(right)
    # Words are in code-point order, so the number breaks ties of n.
    order = np.lexsort((b, -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(a)))
    return a[first], counts, n[b[first]], b[first]


def _near_rows(batches: Iterator[pa.RecordBatch]):
    """Gather whole groups, which come sorted by key, and search them together."""
    rows: list[tuple] = []
    key = None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
        for row in zip(*columns):
            if row[0] != key:
                if len(rows) >= MOST_INDEXED:
                    yield _searched(rows)
                    rows = []
                key = row[0]
            rows.append(row)
    if rows:
        yield _searched(rows)


def _searched(rows: list[tuple]):
    known = {}
    for _, word, n, *_ in rows:
        known[word.encode("latin-1")] = n
    words = sorted(known)
    number = {w: k for k, w in enumerate(words)}
    searches: dict[tuple, list] = {}
    for _, word, _, m, side, kept, until, other in rows:
        if len(word) == m:
            searches.setdefault((m, side, kept, until, other), []).append(
                number[word.encode("latin-1")])
    if not searches:
        return [[], [], [], []]
    a, counts, best_n, best = _near_in(
        words, np.array([known[w] for w in words], np.int64),
        {k: np.unique(np.array(v, np.int64)) for k, v in searches.items()})
    return [[words[i].decode("latin-1") for i in a.tolist()], counts, best_n,
            [words[i].decode("latin-1") for i in best.tolist()]]


def near_words(words: DataFrame, most_group: int = MOST_GROUP) -> DataFrame:
    """(word, n_near, best_n, best): number of near words, and the most frequent of them."""
    groups = _dealt_again(_searches(words), most_group)
    dealt = groups.select("key", "word", "n", "m", "side", "kept", "until", "other").repartition(
        "key").sortWithinPartitions("key")
    found = map_arrow(dealt, _near_rows, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("m")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("m.less")).alias("best_n"), "m.best")


# ---------------------------------------------------------------- forms
def group_variants(documents: DataFrame, most_group: int = MOST_GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of at least 7 code points and 2 occurrences.

    ``documents`` has doc_id and text; further columns are ignored. A missing or empty text has no
    words; a missing doc_id counts as an empty one in the checksum. Repeated rows count each time.
    Of near words of equal n the smallest in code-point order is the form. Texts and words may be
    of any length. Empty tables give no rows.
    """
    words = cut_lineage(word_counts(documents).where(F.col("n") >= LEAST_COUNT), "words")
    near = near_words(words, most_group)
    is_form = F.col("best_n") >= FORM_FACTOR * F.col("n")
    words = cut_lineage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n")), "near-words")
    roots = _roots(words.where("form IS NOT NULL").select("word", F.col("form").alias("root")),
                   words.agg(F.max("n")).first()[0] or 0)
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame, most: int) -> DataFrame:
    """The end of each word's chain of forms. A form has ten times its word's n, so chains are short."""
    longest = max(1, math.ceil(math.log10(max(most, 10))))
    reached = 1
    while reached < longest:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        links = cut_lineage(links.join(ahead, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root")), "roots")
        reached *= 2
    return links


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"))
