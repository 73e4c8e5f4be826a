"""Byte-level BPE ids of whole texts, by the tokenizers library, with a memo of words.

Most of a corpus is words seen before. A text of plain characters is cut by the
tokenizer's own word pattern, and each word is looked up first. In other texts, a space
between two visible characters always begins a new word, so they are cut there and only
the parts that aren't plain go through the whole tokenizer. Special tokens hold no space,
so they stay whole within a part.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import lru_cache

import numpy as np

# Both neighbours of a cutting space are printable ASCII or Latin letters, whose classes
# no version of the Unicode tables changes. Any other text is cut more carefully.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_CUT = re.compile(rf"(?<=[!-~{_LETTER}]) (?=[!-~{_LETTER}])")
_PLAIN = re.compile(rf"[ \n!-~{_LETTER}]*")

# --- fixed values (the tokenizer's own word pattern, over the characters above) ---
_WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[0-9]+| ?[^\s0-9{_LETTER}]+|\s+(?!\S)|\s+")
# ----------------------------------------------------------------------------------

MEMO_BYTES = 40 << 20
_LONGEST_KEY = 64
_ENTRY = 250  # bytes that an entry takes besides the characters of its key


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _visible() -> dict[int, str]:
    """Character to the characters that stand for its bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    stands = dict(zip(shown + hidden, shown + [256 + i for i in range(len(hidden))]))
    return {c: "".join(chr(stands[b]) for b in chr(c).encode()) for c in range(256)}


@lru_cache(maxsize=1)
def shared_encoder(path: str | None = None) -> ByteBpe:
    """One encoder a Python worker, whose memo serves all tasks that the worker runs."""
    return ByteBpe(path)


class Memo(dict):
    """Keeps the last results, about `size` bytes of them and up to twice as many; long keys are not kept."""

    def __init__(self, make, size: int):
        super().__init__()
        self._make, self._size, self._taken, self._older = make, size, 0, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        if len(key) > _LONGEST_KEY:
            return value
        if self._taken >= self._size:
            self._older = dict(self)
            self.clear()
            self._taken = 0
        self._taken += _ENTRY + len(key)
        self[key] = value
        return value


class ByteBpe:
    """Encoder with its memo. `dtype` is the narrowest unsigned type that holds every id."""

    def __init__(self, path: str | None = None, memo_bytes: int = MEMO_BYTES):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path or default_path())
        self._model = self._tokenizer.model
        self._model._resize_cache(0)  # the memo is the cache
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._visible = _visible()
        self._words = Memo(self._word, memo_bytes).__getitem__

    def encode(self, text: str | None) -> bytes:
        """Ids of the whole text, as little-endian numbers of `dtype`."""
        if not text:
            return b""
        if _PLAIN.fullmatch(text) and not any(t in text for t in self._added):
            return b"".join(map(self._words, _WORDS.findall(text)))
        return self._whole(text)

    def _word(self, word: str) -> bytes:
        return self._pack([t.id for t in self._model.tokenize(word.translate(self._visible))])

    def _whole(self, text: str) -> bytes:
        """Ids of any text: the parts between safe cuts, each by the whole tokenizer where it isn't plain."""
        out = []
        for n, part in enumerate(_CUT.split(text)):
            part = " " + part if n else part
            if _PLAIN.fullmatch(part) and not any(t in part for t in self._added):
                out.append(b"".join(map(self._words, _WORDS.findall(part))))
            else:
                out.append(self._pack(self._tokenizer.encode(part, add_special_tokens=False).ids))
        return b"".join(out)

    def _pack(self, ids: list[int]) -> bytes:
        packed = array(self._code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()
