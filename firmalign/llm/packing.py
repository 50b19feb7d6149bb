"""Sum-of-squares online packing of documents into windows of a fixed number of tokens.

Each document goes to the fill level at which the sum, over all levels, of the squared number of
partially filled windows is smallest afterwards; a level array holds these numbers. A task packs
the documents of its partition one after the other and keeps only the open windows in memory, so
nothing is shuffled and a lost task repeats the same choices from the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from firmalign.llm import tokens
from firmalign.llm.common import cut_rows, map_arrow, table, texts_of

WINDOW, END_ID, MOST_OPEN = 2048, 1, 4096
PIECES = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, ids binary")


class SumOfSquares:
    """Windows of one task. A piece is (doc_id, start, doc_tokens, ids as bytes)."""

    def __init__(self, window: int = WINDOW, most_open: int = MOST_OPEN, first_id: int = 0):
        self.window, self.most_open, self.next_id = window, most_open, first_id
        self.levels = np.zeros(window + 1, np.int64)   # open windows by level; none at 0 and full
        self.open: dict[int, list[list]] = {}
        self.n_open = 0
        self.done: list[tuple] = []

    def best_level(self, size: int) -> int:
        """The level (0: a new window) that minimises the sum of squares; ties: the fullest."""
        at = np.flatnonzero(self.levels[:self.window - size + 1])
        at = np.concatenate(([0], at))
        after = at + size
        change = 2 * (self.levels[after] - self.levels[at]) + (at > 0) + (after < self.window)
        return int(at[len(at) - 1 - np.argmin(change[::-1])])

    def add(self, doc_id, ids: bytes) -> None:
        """Place a document; whole windows of a longer one are cut off and closed at once."""
        n = len(ids) // 4
        whole = n - n % self.window
        for start in range(0, whole, self.window):
            self.close([(doc_id, start, n, ids[4 * start:4 * (start + self.window)])])
        if n > whole:
            self.place((doc_id, whole, n, ids[4 * whole:]))

    def place(self, piece: tuple) -> None:
        size = len(piece[3]) // 4
        level = self.best_level(size)
        if level:
            pieces = self.open[level].pop()
            self.levels[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if level + size == self.window:
            self.close(pieces)
            return
        self.open.setdefault(level + size, []).append(pieces)
        self.levels[level + size] += 1
        self.n_open += 1
        if self.n_open > self.most_open:
            self.settle()

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, n, ids in pieces:
            size = len(ids) // 4
            self.done.append((doc_id, start, size, n, self.next_id, offset, ids))
            offset += size
        self.next_id += 1

    def settle(self) -> None:
        """Dissolve the emptiest open windows and fill the fullest with their cut pieces."""
        left = [p for level in sorted(self.open, reverse=True) for p in self.open[level]]
        self.open, self.n_open = {}, 0
        self.levels[:] = 0
        head, tail = 0, len(left) - 1
        while head < tail:
            target = left[head]
            room = self.window - sum(len(p[3]) // 4 for p in target)
            while room and head < tail:
                doc_id, start, n, ids = left[tail].pop()
                size = len(ids) // 4
                if size > room:
                    keep = size - room
                    left[tail].append((doc_id, start, n, ids[:4 * keep]))
                    start, ids, size = start + keep, ids[4 * keep:], room
                target.append((doc_id, start, n, ids))
                room -= size
                if not left[tail]:
                    tail -= 1
            if not room:
                self.close(target)
                head += 1
        if head == tail and left[head]:
            level = sum(len(p[3]) // 4 for p in left[head])
            if level == self.window:
                self.close(left[head])
            else:
                self.open, self.n_open = {level: [left[head]]}, 1
                self.levels[level] = 1

    def finish(self) -> None:
        """Settle; the one window left is cut at powers of two, which need no padding."""
        self.settle()
        rest = [p for windows in self.open.values() for pieces in windows for p in pieces]
        level = sum(len(p[3]) // 4 for p in rest)
        while level:
            room = 1 << (level.bit_length() - 1)
            level -= room
            taken = []
            while room:
                doc_id, start, n, ids = rest.pop(0)
                size = min(room, len(ids) // 4)
                taken.append((doc_id, start, n, ids[:4 * size]))
                if 4 * size < len(ids):
                    rest.insert(0, (doc_id, start + size, n, ids[4 * size:]))
                room -= size
            self.close(taken)
        self.open, self.n_open = {}, 0
        self.levels[:] = 0


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW,
         end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their place in a sequence, and their ids.

    ``docs`` needs doc_id and text; other columns are ignored. A missing text is an empty one and
    still has its end id. Repeated rows are packed as often as they occur, and a missing doc_id is
    kept. Sequence ids are unique, not consecutive.
    """
    path = path or tokens.tokenizer_path()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches) -> Iterator[list]:
        encode = tokens.encoder(path).encode
        packer = SumOfSquares(window, first_id=TaskContext.get().partitionId() << 32)
        for batch in cut_rows(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                    strict=True):
                packer.add(doc_id, encode(text) + end)
            if packer.done:
                yield [list(c) for c in zip(*packer.done, strict=True)]
                packer.done = []
        packer.finish()
        if packer.done:
            yield [list(c) for c in zip(*packer.done, strict=True)]

    return map_arrow(docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")),
                     run, PIECES)


def op1_pack(spark, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")
