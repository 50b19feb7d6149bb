"""Tokens, packing and token files: exact against the tokenizers library."""

import random
import zlib

import numpy as np
import pytest
from conftest_llm import ODD
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from firmalign.llm import coder, packing, tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abSTéÉßİſ 'srtvem\n\t.,;:!&%$#@½²9\xa0\x1ć漢ªº<|>"),
               max_size=40))
def test_memo_gives_the_library_ids(text):
    encoder = tokens.encoder(tokens.tokenizer_path())
    assert encoder.encode(text) == as_bytes(
        encoder.tokenizer.encode(text, add_special_tokens=False).ids)


def test_strings_of_added_tokens_get_their_ids():
    encode = tokens.encoder(tokens.tokenizer_path()).encode
    assert encode("hello <|endoftext|> and") == as_bytes([3306, 49407, 537])
    for text in ("<|startoftext|>", "a<|endoftext|>b", "the cat <|ENDOFTEXT|> sat", "x <|endoftext| > y"):
        assert encode(text) == as_bytes(
            tokens.encoder(tokens.tokenizer_path()).tokenizer.encode(text, add_special_tokens=False).ids)


def test_memo_keeps_values_when_full(monkeypatch, library):
    monkeypatch.setattr(tokens, "_MEMO", 3)
    encoder = tokens.Encoder(tokens.tokenizer_path())
    text = "the cat sat on the mat, and the dog sat on the cat. " * 3
    assert encoder.encode(text) == as_bytes(library(text))


def check_pieces(rows, pieces, library):
    expected = sorted(((i, as_bytes([*library(t), packing.END_ID])) for i, t in rows),
                      key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    by_place = {}
    for p in pieces:
        by_place.setdefault(p["sequence_id"], []).append(p)
    for own in by_place.values():
        own.sort(key=lambda p: p["offset"])
        at = 0
        for p in own:
            assert p["offset"] == at and p["length"] == len(p["ids"]) // 4 > 0
            at += p["length"]
        assert at <= packing.WINDOW
    # Pieces of a document, put together by start, are its ids; equal documents are told apart by
    # counting every id once.
    assert sum(p["length"] for p in pieces) == sum(len(b) // 4 for _, b in expected)
    for doc_id in {i for i, _ in rows}:
        wanted = [b for i, b in expected if i == doc_id]
        own = [p for p in pieces if p["doc_id"] == doc_id]
        for ids in set(wanted):
            for p in own:
                if p["doc_tokens"] == len(ids) // 4 and len(set(wanted)) == 1:
                    assert bytes(p["ids"]) == ids[4 * p["start"]:4 * (p["start"] + p["length"])]
        starts = sorted((p["doc_tokens"], p["start"], p["length"]) for p in own)
        for n, start, length in starts:
            assert start + length == n or any(m == n and s == start + length
                                              for m, s, _ in starts)


def test_pack_keeps_every_id_once(documents, corpus, library):
    check_pieces(corpus, packing.pack(documents).collect(), library)


def test_pack_odd_rows(odd, empty, library):
    check_pieces(ODD, packing.pack(odd).collect(), library)
    assert packing.pack(empty).count() == 0


def sum_of_squares_by_hand(sizes, window):
    """Levels chosen by trying each one and adding up all squares."""
    counts, out = [0] * (window + 1), []
    for size in sizes:
        best = None
        for level in range(window - size + 1):
            if level and not counts[level]:
                continue
            after = counts.copy()
            if level:
                after[level] -= 1
            after[level + size] += 1
            score = (sum(c * c for c in after[1:window]), -level)
            if best is None or score < best[0]:
                best = score, level, after
        out.append(best[1])
        counts = best[2]
        counts[window] = 0
    return out


def test_levels_minimise_the_sum_of_squares():
    rng = random.Random(2)
    sizes = [rng.randint(1, 20) for _ in range(300)]
    packer = packing.SumOfSquares(20, 10 ** 6)
    chosen = []
    choose = packer.best_level
    packer.best_level = lambda size: chosen.append(choose(size)) or chosen[-1]
    for k, size in enumerate(sizes):
        packer.place((k, 0, size, bytes(4 * size)))
    assert chosen == sum_of_squares_by_hand(sizes, 20)


def test_packing_leaves_no_padding_and_few_open_windows():
    rng = random.Random(3)
    packer = packing.SumOfSquares(64, most_open=10)
    total = 0
    for k in range(2000):
        size = rng.choice([40, 41, 50, 200, 64])   # hardly any two fit together
        total += size
        packer.add(k, bytes(4 * size))
        assert packer.n_open <= 11
    packer.finish()
    lengths = {}
    for p in packer.done:
        lengths[p[4]] = lengths.get(p[4], 0) + p[2]
    assert sum(lengths.values()) == total
    assert all(n == 64 or n & (n - 1) == 0 for n in lengths.values())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 60_000), max_size=300), st.integers(1, 40))
def test_segment_round_trip(ids, block):
    data = coder.pack_segment([1, None], [len(ids), 0], np.array(ids, "<u4"), block)
    doc_ids, sizes, back = coder.unpack_segment(data)
    assert (doc_ids, sizes, back.tolist()) == ([1, None], [len(ids), 0], ids)


def test_predictable_ids_become_short():
    ids = np.tile(np.arange(50, dtype="<u4"), 400)
    assert len(coder.pack_segment([1], [len(ids)], ids)) < len(ids) * 2 // 8


def test_blocks_are_independent_and_checked():
    ids = np.random.default_rng(1).integers(0, 500, 1000).astype("<u4")
    order0, blocks, sums = coder.encode_segment(ids, 100)
    alone = coder.decode_segment(order0, blocks[3:4], sums[3:4], 100, 100)
    assert (alone == ids[300:400]).all()
    blocks[4] = blocks[4][:10] + bytes([blocks[4][10] ^ 8]) + blocks[4][11:]
    with pytest.raises(ValueError, match="block 4"):
        coder.decode_segment(order0, blocks, sums, 1000, 100)


def test_coded_words_stay_the_same():
    """Files of earlier versions can be read: the blocks, and so their predictions, are unchanged."""
    ids = np.random.default_rng(7).zipf(1.4, 4000).clip(max=49_000).astype("<u4")
    order0, blocks, sums = coder.encode_segment(ids, 64)
    assert zlib.crc32(b"".join(blocks)) == 261412152
    assert (coder.decode_segment(order0, blocks, sums, 4000, 64) == ids).all()
    blocks[5] = blocks[5][:-20]
    with pytest.raises(ValueError, match="block 5"):
        coder.decode_segment(order0, blocks, sums, 4000, 64)


def test_every_latin_letter_is_shown_as_the_library_does(library):
    encoder = tokens.Encoder(tokens.tokenizer_path())
    for text in map("x{0}y {0} é{0}".format, map(chr, range(0xA0, 0x100))):
        assert encoder.encode(text) == as_bytes(library(text))


def check_files(rows, read, library):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted((r["start"], r["doc_id"], bytes(r["ids"])) for r in read)
    at = 0
    for start, _, ids in got:
        assert start == at
        at += len(ids) // 4
    assert [d for _, d, _ in got] == [i for i, _ in order]
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted([(d, b) for _, d, b in got], key=key) == sorted(
        [(i, as_bytes([*library(t), coder.END_ID])) for i, t in rows], key=key)


def test_token_files(documents, corpus, odd, empty, library, tmp_path):
    for k, (df, rows) in enumerate(((documents, corpus), (odd, ODD))):
        segments = coder.write_ids(df, f"{tmp_path}/{k}", segment=2000)
        assert segments.count() > 2
        read = coder.read_ids(segments)
        check_files(rows, read.collect(), library)
        row = read.withColumn("crc", F.crc32("ids")).first()
        assert row["crc"] == zlib.crc32(row["ids"])
    assert coder.read_ids(coder.write_ids(empty, f"{tmp_path}/none")).count() == 0
