"""Token ids of whole texts with a tokenizer file of the tokenizers library.

The word tokenizer used by default works on each word by itself, so ids are looked up word by word
in a bounded memo and only new words go through the library's model. A text with any character
outside the range in which that holds or with the string of an added token, and every text of
another kind of tokenizer, is handed to the library as a whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

WORD_BPE = "word_bpe_49k.json"
#: Normal form, white space, lower-casing and splitting of other characters are left to the library.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa0-\xff]*")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]"
                    r"|[^\s0-9²³¹¼½¾a-zªµºß-öø-ÿ]+")
#: Fixed value: the splitting pattern for which the memo is valid.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Most texts: the only marks stand alone, so blanks around them do the splitting.
_SIMPLE = re.compile(r"[\t\n\r .,a-zA-Zªµº\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
_MARKS_MEET = ("..", ",,", ".,", ",.")
#: Entries in each of the two generations of a memo.
_MEMO = 250_000


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Memo(dict):
    """A bounded memo: when full, it becomes the old generation, from which hot keys come back."""

    old: dict = {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.work_out(key)
        if len(self) >= _MEMO:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class _Words(_Memo):
    """Pre-token -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer):
        from tokenizers.pre_tokenizers import ByteLevel
        super().__init__()
        self.model = tokenizer.model
        to_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        # Each character is shown by itself, as the characters of its UTF-8 bytes.
        self.shown = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)}

    def work_out(self, word: str) -> bytes:
        shown = word if word.isascii() else word.translate(self.shown)
        return _little_endian([t.id for t in self.model.tokenize(shown)])


@lru_cache(1024)
def _packer(n: int):
    return struct.Struct(f"<{n}I").pack


def _little_endian(ids: list[int]) -> bytes:
    return _packer(len(ids))(*ids)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        # The library gives the string of an added token its id wherever a text holds it.
        self.added = [t["content"].lower() for t in spec.get("added_tokens") or []]
        simple = any(_SIMPLE.fullmatch(t) for t in self.added)
        self.words = _Words(self.tokenizer) if self._by_word(spec) and not simple else None

    @staticmethod
    def _by_word(spec: dict) -> bool:
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        kinds = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        return (kinds == ["NFC", "Replace", "Lowercase"] and len(split) == 2
                and split[0].get("pattern") == {"Regex": _SPLIT}
                and split[1].get("type") == "ByteLevel")

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers, without special tokens."""
        if self.words is not None and _PLAIN.fullmatch(text):
            if _SIMPLE.fullmatch(text) and not any(m in text for m in _MARKS_MEET):
                words = text.lower().replace(".", " . ").replace(",", " , ").split()
                return b"".join(map(self.words.__getitem__, words))
            lowered = text.lower()
            if not any(t in lowered for t in self.added):
                return b"".join(map(self.words.__getitem__, _PIECE.findall(lowered)))
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return _little_endian(ids)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, kept by the worker process for later tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
