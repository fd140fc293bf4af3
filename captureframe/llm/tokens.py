"""Texts to token ids with a public tokenizer file, at the speed of a table look-up.

The tokenizer's pieces never reach over white space, so a text's ids are the ids of its white-space-separated chunks in
a row. Every chunk is encoded by the tokenizers library itself and its ids are kept as bytes in a bounded table; a text
is then one split, one look-up per chunk and one join. Texts in which that would not hold go to the library whole: those
with the strings of special tokens and those with the four ASCII separators that Python splits at and the
tokenizer does not. A chunk seen for the first time that is Latin letters and then marks is taken apart once more, so that
a word costs one pass of the merge table however it is written.
"""

from __future__ import annotations

import ctypes
import gc
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Latin letters that are one code point before and after normalisation, then ASCII marks without the apostrophe.
_PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-&(-/:-@\[-`{-~]*)")
_WHOLE = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")


class _Chunks(dict):
    """Chunk -> ids. A chunk that is not there is encoded; those that come again are kept, in two generations."""

    def __init__(self, owner: Encoder):
        super().__init__()
        self.owner, self.old = owner, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            ids, again = self.owner.chunk_ids(chunk)
            if not again:  # most words occur once
                return ids
        if len(self) >= self.owner.most:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


class Encoder:
    """encode(text) -> ids as little-endian unsigned 32-bit bytes. Tables hold two generations of ``most`` entries."""

    def __init__(self, path: str, most: int = 160_000, longest: int = 64):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.most, self.longest = most, longest
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelt = {c: spell(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self.words: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}
        self.find = _Chunks(self).__getitem__

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> tuple[bytes, bool]:
        """A run of plain lower-case letters, straight through the tokenizer's merge table; and whether it was known."""
        got = self.words.get(word)
        if got is not None:
            return got, True
        got = self.old_words.get(word)
        known = got is not None
        if not known:
            spelt = word if word.isascii() else word.translate(self.spelt)
            ids = [t.id for t in self.tokenizer.model.tokenize(spelt)]
            got = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= self.longest:
            if len(self.words) >= 2 * self.most:
                self.old_words, self.words = self.words, {}
            self.words[word] = got
        return got, known

    def chunk_ids(self, chunk: str) -> tuple[bytes, bool]:
        """The ids of a chunk, and whether it is worth a place in the table."""
        plain = _PLAIN.fullmatch(chunk)
        if not plain:
            return self._ids(chunk), len(chunk) <= self.longest
        ids, known = self._word(plain[1].lower())
        return ids + (self.find(plain[2]) if plain[2] else b""), known and len(chunk) <= self.longest

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(x in text for x in _WHOLE):
            return self._ids(text)
        return b"".join(map(self.find, text.split()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def trim() -> None:
    """Give memory that a worker process has freed back to the system; allocators would keep it for as long as the worker is reused."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library has no such call


def forget() -> None:
    """Drop the token tables of this process. (A function of the module, so that it reaches the module's own tables in a worker.)"""
    if _ENCODERS:
        _ENCODERS.clear()
        gc.collect()
        trim()


def frugal(rows: Callable[[Iterator], Iterator], tables: bool = False) -> Callable[[Iterator], Iterator]:
    """``rows`` (a function of batches), leaving nothing in its worker process that the next task would not use.

    Only work with token tables (``tables``) keeps those of tasks before; any other drops them as it begins.
    """

    def of(batches: Iterator) -> Iterator:
        if not tables:
            forget()
        try:
            yield from rows(batches)
        finally:
            trim()

    return of


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))
