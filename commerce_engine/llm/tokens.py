"""Token ids of whole texts, word by word, exactly as the tokenizers library gives them.

A lower-casing, white-space-dropping BPE (``word_bpe_49k.json``) never joins
characters across white space, so a text's ids are the ids of its words in
order. Words repeat, hence a bounded cache from word to packed ids. Words of
ASCII and Latin letters go to the library's BPE model piece by piece; any other
word (other scripts, apostrophes, special strings) goes through the library's
whole encoder.
"""

from __future__ import annotations

import os
import re

import numpy as np

#: Words kept by one Python worker; the cache is emptied when it holds more.
CACHE_WORDS = 400_000

PLAIN = re.compile(r"[!-&(-~À-ÖØ-öø-ÿ]+")
PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def byte_symbols() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: itself, or one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def load(path: str):
    """A tokenizer of the tokenizers library; its own thread pool stays off inside tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordIds(dict):
    """word (UTF-8 bytes) -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load(path)
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHE_WORDS:
            self.clear()
        text = word.decode()
        if PLAIN.fullmatch(text) and "<|" not in text:
            ids = b"".join([self.piece(p) for p in PIECE.findall(text.lower())])
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = ids
        return ids

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) > CACHE_WORDS:
                self.pieces.clear()
            shown = piece.encode().decode("latin-1").translate(self.symbols)
            ids = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
            self.pieces[piece] = ids
        return ids

    def encode(self, text: bytes) -> bytes:
        """All ids of a text, packed; splitting on ASCII white space keeps them exact."""
        return b"".join(map(self.__getitem__, text.split()))


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One cache per worker process and vocabulary, shared by the tasks it runs."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]
