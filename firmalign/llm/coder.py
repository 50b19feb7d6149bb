"""Token ids in binary files, compressed by an adaptive context-mixing range coder.

Documents are written in ascending order of doc_id, one file for each task, in segments. A segment
holds the ids of its documents in blocks of ``BLOCK`` ids, an index of its documents and a table of
id frequencies. Every block starts from that table and empty contexts, ends on its own and carries
a checksum, so blocks are independent of each other. That is used twice: a damaged block is noticed
without reading others, and all blocks of a segment are coded in step, one id of each at a time,
with numpy over the blocks.

Three predictions are mixed for each id: the id that last followed the same two ids (order 2), the
one that last followed the same id (order 1), and the segment's frequencies (order 0). The weights
of the two first depend on how often their contexts were right lately and adapt after every id.
The mixed distribution drives a carry-less range coder with a 64-bit state and 16-bit output.

File layout, all integers little-endian:
  segment  = b"CMS1", u32 header bytes, zlib header, blocks
  header   = JSON: n_docs, n_ids, block, n_symbols; then arrays: doc ids (i64), whether a doc id is
             missing (u8), ids of each document (i64), symbols (u32), frequencies (u32), words of
             each block (u32), crc32 of each block's ids (u32)
  block    = its 16-bit words
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from firmalign.llm import tokens
from firmalign.llm.common import (cut_lineage, cut_rows, map_arrow, open_file, shared_folder,
                                  spread, table, task_file, texts_of)

END_ID = 2
BLOCK = 1024
#: Ids after which a segment is closed; its working memory is about thirty bytes for each.
SEGMENT = 8 << 20
MAGIC = b"CMS1"
MIX_BITS, ORDER0_BITS = 12, 20
SLOTS_BITS = 8
MANIFEST = "path string, part bigint, at bigint, n_bytes bigint, n_docs bigint, n_ids bigint"

_U = np.uint64
_TOP, _BOTTOM = _U(1 << 48), _U(1 << 32)
_FULL_MIX, _FULL_0 = 1 << MIX_BITS, 1 << ORDER0_BITS
#: What a weight moves to, a sixteenth at a time, by what was right: nothing, order 2, order 1.
#: Both weights are kept in one integer, order 2 in the upper half; a weight ends near 32 or 4000.
_RATE, _KEEP = 4, np.int32(0x0FFF0FFF)
_WRONG, _RIGHT2, _RIGHT1 = np.int32(2 << 16 | 2), np.int32(246 << 16), np.int32(246)
_HASH1, _HASH2, _HASH3 = np.int32(40503), np.int32(31153), np.int32(52711)
_SLOTS = np.int32((1 << SLOTS_BITS) - 1)


class _Order0:
    """Frequencies of a segment's ids, scaled to a power of two, none below one."""

    def __init__(self, symbols: np.ndarray, freq: np.ndarray):
        self.symbols, self.freq = symbols, freq.astype(np.uint64)
        self.low = (np.cumsum(self.freq) - self.freq).astype(np.uint64)

    @classmethod
    def of(cls, ids: np.ndarray) -> _Order0:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
        if len(symbols) >= _FULL_0:
            raise ValueError("more different ids in a segment than the order-0 table can hold")
        freq = 1 + counts * (_FULL_0 - len(symbols)) // max(1, counts.sum())
        if len(freq):
            freq[np.argmax(freq)] += _FULL_0 - freq.sum()
        return cls(symbols.astype(np.uint32), freq)

    def decode_table(self) -> np.ndarray:
        kind = np.uint16 if len(self.freq) <= 1 << 16 else np.int32
        return np.repeat(np.arange(len(self.freq), dtype=kind), self.freq.astype(np.int64))


def _mask(where: np.ndarray) -> np.ndarray:
    """All bits where true, none elsewhere: choosing by masks costs a fraction of masked copies."""
    return np.negative(where, dtype=np.int32, casting="unsafe")


def _wide_mask(mask: np.ndarray) -> np.ndarray:
    return mask.astype(np.int64).view(_U)


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``values[at]``; no place is out of range, and "clip" spares the check that would say so."""
    return values.take(at, mode="clip")


class _Model:
    """Adaptive state of all lanes: predictions of order 1 and 2 and their weights.

    A prediction is kept as 4 * rank + confidence, both weights of a state as order 2 << 16 | order 1.
    """

    def __init__(self, lanes: int):
        self.base = np.arange(lanes, dtype=np.intp) << SLOTS_BITS
        self.mix_base = np.arange(lanes, dtype=np.intp) << 4
        self.order1, self.order2 = (np.zeros(lanes << SLOTS_BITS, np.int32) for _ in range(2))
        self.weights = np.full(lanes << 4, 128 << 16 | 128, np.int32)
        self.last, self.before = (np.zeros(lanes, np.int32) for _ in range(2))

    def predict(self, n: int) -> None:
        """Predictions and weights of the next id in the first ``n`` lanes."""
        last = self.last[:n]
        base = self.base[:n]
        self.at1 = base + (last * _HASH1 >> 8 & _SLOTS)
        self.at2 = base + (last * _HASH2 + self.before[:n] >> 8 & _SLOTS)
        self.s1, self.s2 = _take(self.order1, self.at1), _take(self.order2, self.at2)
        self.p1, self.p2 = self.s1 >> 2, self.s2 >> 2
        self.row = self.mix_base[:n] + ((self.s2 & 3) << 2 | self.s1 & 3)
        self.both = _take(self.weights, self.row)
        self.w1, self.w2 = self.both & 0xFFFF, self.both >> 16

    def interval(self, hit1: np.ndarray, hit2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and width of what was coded first: a prediction, or that none is right.

        ``hit1`` and ``hit2`` are masks.
        """
        begin = (self.w2 + (self.w1 & ~hit1)) & ~hit2
        width = _FULL_MIX - self.w1 - self.w2
        width ^= (width ^ self.w1) & hit1
        width ^= (width ^ self.w2) & hit2
        return begin.astype(_U), width.astype(_U)

    def update(self, x: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        n = len(x)
        self.weights[self.row] = (self.both - (self.both >> _RATE & _KEEP) + _WRONG
                                  + (hit2 & _RIGHT2) + (hit1 & _RIGHT1))
        fresh = x << 2
        for table, at, s, same in ((self.order1, self.at1, self.s1, _mask(self.p1 == x)),
                                   (self.order2, self.at2, self.s2, hit2)):
            # Right: confident. Wrong: less confident, or replaced where there was no confidence.
            state = fresh | same & 3
            state ^= (state ^ (s - 1)) & ~same & -((s & 3) + 3 >> 2)
            table[at] = state
        np.multiply(self.last[:n], _HASH3, out=self.before[:n])
        self.last[:n] = x


def _lanes(n_ids: int, block: int) -> np.ndarray:
    """Ids of each block; all but the last are full."""
    full, rest = divmod(n_ids, block)
    return np.array([block] * full + [rest] * bool(rest), np.int64)


def encode_segment(ids: np.ndarray, block: int = BLOCK) -> tuple[_Order0, list[bytes], list[int]]:
    """(order-0 table, coded blocks, crc32 of each block's ids)."""
    order0 = _Order0.of(ids)
    lengths = _lanes(len(ids), block)
    lanes = len(lengths)
    ranks = np.zeros(int(order0.symbols[-1]) + 1 if lanes else 0, np.int32)
    ranks[order0.symbols] = np.arange(len(order0.symbols))
    rank = np.zeros(lanes * block, np.int32)
    rank[:len(ids)] = ranks.take(ids)
    steps = np.ascontiguousarray(rank.reshape(lanes, block).T) if lanes else rank.reshape(0, 0)
    model = _Model(lanes)
    low, wide = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    # An id takes at most 32 bits and what truncating a range costs; four words end a block.
    room = 3 * block + 8
    # Words of equal rank lie side by side: lanes write about as many, so writes stay close.
    words, place = np.zeros(lanes * room, np.uint16), np.arange(lanes)

    def put(at: np.ndarray, lows: np.ndarray) -> None:
        to = _take(place, at)
        words[to] = (lows >> _U(48)).astype(np.uint16)
        place[at] = to + lanes

    for t in range(block if lanes else 0):
        n = lanes - (lengths[-1] <= t)
        if not n:
            break
        x = steps[t, :n]
        model.predict(n)
        hit2 = _mask(model.p2 == x)
        hit1 = _mask(model.p1 == x) & ~hit2
        _narrow(low[:n], wide[:n], model.interval(hit1, hit2), order0, x, hit1 | hit2)
        _renew(low[:n], wide[:n], put)
        model.update(x, hit1, hit2)
    for _ in range(4):
        put(np.arange(lanes), low)
        low <<= _U(16)
    counts = place // lanes if lanes else place
    by_lane = words.reshape(room, lanes)[:counts.max(initial=0)].T.astype("<u2", order="C")
    blocks = [row[:n].tobytes() for row, n in zip(by_lane, counts.tolist(), strict=True)]
    ends = np.cumsum(lengths)
    plain = ids.astype("<u4")
    sums = [zlib.crc32(plain[e - n:e].tobytes()) for e, n in zip(ends, lengths, strict=True)]
    return order0, blocks, sums


def _narrow(low: np.ndarray, wide: np.ndarray, interval: tuple, order0: _Order0, x: np.ndarray,
            hit: np.ndarray) -> None:
    """Go to the interval of the mix and, in lanes without a right prediction, to that of the id."""
    begin, width = interval
    part = wide >> _U(MIX_BITS)
    low += part * begin
    np.multiply(part, width, out=wide)
    spelt, at = _wide_mask(~hit), x.astype(np.intp)
    part = wide >> _U(ORDER0_BITS)
    low += part * _take(order0.low, at) & spelt
    part *= _take(order0.freq, at)
    wide ^= (wide ^ part) & spelt


def _renew(low: np.ndarray, wide: np.ndarray, move) -> None:
    """Shift lanes that have become too narrow by 16 bits until all are wide enough."""
    at = np.flatnonzero(wide < _BOTTOM)
    while len(at):
        lows, widths = _take(low, at), _take(wide, at)
        open_end = np.flatnonzero((lows ^ (lows + widths - _U(1))) >= _TOP)
        if len(open_end):   # the first word isn't settled: end the range where it would change
            widths[open_end] = (_U(0) - lows[open_end]) & (_BOTTOM - _U(1))
        move(at, lows)
        lows <<= _U(16)
        widths <<= _U(16)
        low[at], wide[at] = lows, widths
        at = _take(at, np.flatnonzero(widths < _BOTTOM))


def decode_segment(order0: _Order0, blocks: list[bytes], sums: list[int], n_ids: int,
                   block: int = BLOCK) -> np.ndarray:
    """The ids of a segment; a block whose checksum differs is an error."""
    lengths = _lanes(n_ids, block)
    lanes = len(lengths)
    sizes = np.array([len(b) // 2 for b in blocks], np.int64)
    # As when they were written, with zeros after the end of a block.
    words = np.zeros((lanes, int(sizes.max(initial=0)) + 1), np.uint16)
    words[np.arange(words.shape[1]) < sizes[:, None]] = np.frombuffer(b"".join(blocks), "<u2")
    words, place = np.ravel(words.T), np.arange(lanes)
    find = order0.decode_table()
    model = _Model(lanes)
    low, wide = np.zeros(lanes, _U), np.full(lanes, (1 << 64) - 1, _U)
    code = np.zeros(lanes, _U)

    def take(at: np.ndarray, _=None) -> None:
        come = _take(place, at)
        code[at] = _take(code, at) << _U(16) | _take(words, come)
        place[at] = come + lanes

    for _ in range(4):
        take(np.arange(lanes))
    steps = np.zeros((block if lanes else 0, lanes), np.int32)
    for t in range(len(steps)):
        n = lanes - (lengths[-1] <= t)
        if not n:
            break
        model.predict(n)
        part = wide[:n] >> _U(MIX_BITS)
        value = code[:n] - low[:n]
        hit2 = _mask(value < part * model.w2.astype(_U))
        hit1 = _mask(value < part * (model.w1 + model.w2).astype(_U)) & ~hit2
        begin, width = model.interval(hit1, hit2)
        # The id of a lane without a right prediction; of the others, one that is not used.
        value = (value - part * begin) // (part * width >> _U(ORDER0_BITS))
        x = _take(find, np.minimum(value, _U(_FULL_0 - 1)).view(np.intp)).astype(np.int32)
        x ^= (x ^ model.p1) & hit1
        x ^= (x ^ model.p2) & hit2
        _narrow(low[:n], wide[:n], (begin, width), order0, x, hit1 | hit2)
        _renew(low[:n], wide[:n], take)
        model.update(x, hit1, hit2)
        steps[t, :n] = x
    ids = order0.symbols[steps.T.reshape(-1)[:n_ids]] if n_ids else np.zeros(0, np.uint32)
    plain = ids.astype("<u4")
    for k, (end, n) in enumerate(zip(np.cumsum(lengths), lengths, strict=True)):
        if zlib.crc32(plain[end - n:end].tobytes()) != sums[k]:
            raise ValueError(f"block {k} of a segment is damaged")
    return ids


def pack_segment(doc_ids: list, sizes: list[int], ids: np.ndarray, block: int = BLOCK) -> bytes:
    order0, blocks, sums = encode_segment(ids, block)
    facts = json.dumps({"n_docs": len(sizes), "n_ids": len(ids), "block": block,
                        "n_symbols": len(order0.symbols)}).encode()
    arrays = [np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is None for d in doc_ids], "u1"),
              np.array(sizes, "<i8"), order0.symbols.astype("<u4"), order0.freq.astype("<u4"),
              np.array([len(b) // 2 for b in blocks], "<u4"), np.array(sums, "<u4")]
    header = zlib.compress(struct.pack("<I", len(facts)) + facts
                           + b"".join(a.tobytes() for a in arrays), 1)
    return MAGIC + struct.pack("<I", len(header)) + header + b"".join(blocks)


def unpack_segment(data: bytes) -> tuple[list, list[int], np.ndarray]:
    """(doc ids, ids of each document, all ids)."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment of token ids")
    (size,) = struct.unpack_from("<I", data, 4)
    header, at = zlib.decompress(data[8:8 + size]), 8 + size
    (n,) = struct.unpack_from("<I", header)
    facts = json.loads(header[4:4 + n])
    place = 4 + n
    arrays = []
    lanes = len(_lanes(facts["n_ids"], facts["block"]))
    for kind, count in (("<i8", facts["n_docs"]), ("u1", facts["n_docs"]), ("<i8", facts["n_docs"]),
                        ("<u4", facts["n_symbols"]), ("<u4", facts["n_symbols"]),
                        ("<u4", lanes), ("<u4", lanes)):
        arrays.append(np.frombuffer(header, kind, count, place))
        place += arrays[-1].nbytes
    doc_ids, missing, sizes, symbols, freq, words, sums = arrays
    blocks = []
    for w in words.tolist():
        blocks.append(data[at:at + 2 * w])
        at += 2 * w
    ids = decode_segment(_Order0(symbols, freq), blocks, sums.tolist(), facts["n_ids"],
                         facts["block"])
    named = [None if m else d for d, m in zip(doc_ids.tolist(), missing.tolist(), strict=True)]
    return named, sizes.tolist(), ids


def write_ids(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID,
              block: int = BLOCK, segment: int = SEGMENT) -> DataFrame:
    """Write the ids of all documents in ascending order of doc_id; returns the list of segments.

    ``docs`` needs doc_id and text; other columns are ignored. A missing text has only its end id,
    a missing doc_id comes first, and repeated rows are written as often as they occur. An empty
    table gives an empty list.
    """
    path = path or tokens.tokenizer_path()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches) -> Iterator[list]:
        encode = tokens.encoder(path).encode
        name, file, at = task_file(folder, ".ids"), None, 0
        doc_ids, parts, n_ids = [], [], 0

        def close():
            nonlocal file, at, doc_ids, parts, n_ids
            file = file or open_file(name, "w")
            data = pack_segment(doc_ids, [len(p) // 4 for p in parts],
                                np.frombuffer(b"".join(parts), "<u4"), block)
            file.write(data)
            row = [[name], [part], [at], [len(data)], [len(doc_ids)], [n_ids]]
            at += len(data)
            doc_ids, parts, n_ids = [], [], 0
            return row

        for batch in cut_rows(batches):
            part = batch.column(2)[0].as_py()
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)),
                                    strict=True):
                ids = encode(text) + end
                doc_ids.append(doc_id)
                parts.append(ids)
                n_ids += len(ids) // 4
                if n_ids >= segment:
                    yield close()
        if doc_ids:
            yield close()
        if file:
            file.close()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                          F.col("text").cast("string").alias("text")).repartitionByRange(
        parts, "doc_id").sortWithinPartitions("doc_id").withColumn(
            "part", F.spark_partition_id().cast("bigint"))
    return cut_lineage(map_arrow(ordered, run, MANIFEST), "id-segments")


def read_ids(segments: DataFrame) -> DataFrame:
    """Every document from the files: doc_id, start (ids before it), n_tokens, ids (binary, u32)."""
    before = Window.orderBy("part", "at").rowsBetween(Window.unboundedPreceding, -1)
    listed = segments.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches) -> Iterator[list]:
        for batch in batches:
            for name, at, n_bytes, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open_file(name, "r") as file:
                    file.seek(at)
                    doc_ids, sizes, ids = unpack_segment(file.read(n_bytes))
                ends = np.cumsum(sizes)
                plain = ids.astype("<u4")
                for k in range(0, len(sizes), 2048):
                    cut = slice(k, k + 2048)
                    yield [doc_ids[cut], (base + ends[cut] - np.array(sizes[cut])).tolist(),
                           sizes[cut], [plain[e - n:e].tobytes() for e, n in
                                        zip(ends[cut], sizes[cut], strict=True)]]

    dealt = spread(listed.select("path", "at", "n_bytes", "base"), segments.count())
    return map_arrow(dealt, run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def op3_token_files(spark, sf_dir: str) -> DataFrame:
    segments = write_ids(table(spark, sf_dir, "documents"), shared_folder(spark, "token-ids"))
    return read_ids(segments).select("doc_id", "start", "n_tokens",
                                     F.crc32("ids").alias("ids_crc32"))
