"""Encoding with a public tokenizer file, fast enough for a corpus.

The word-end BPE drops white space and never merges across it, so a text's ids are those of its blank-separated pieces, one
after another. Pieces are looked up in a memory of this worker process that is bounded in bytes; unknown ones go to the
tokenizers library.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

#: Bytes that a worker's remembered pieces take at most, in two generations of half as many; what an entry costs besides
#: its piece and ids; bytes of the longest piece that is remembered.
MEMORY, ENTRY, LONGEST = 200 * 1024 * 1024, 180, 64

#: A lower-case word of plain Latin letters, which no normalizer changes, and the punctuation behind it.
_PLAIN = re.compile(rb"([a-z\xdf-\xf6\xf8-\xff]+)([.,:;!?*#$%&|]*)")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Texts to ids, as bytes of little-endian unsigned 32-bit numbers; equal to the library's encode(text, add_special_tokens=False).

    `word_ends` says that the file is a word-end BPE with the normalizer NFC, blanks, lower case: then pieces are remembered.
    Other files are encoded whole.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.pieces = spec["model"].get("end_of_word_suffix") == "</w>" and kinds == ["NFC", "Replace", "Lowercase"]
        self.specials = [x["content"] for x in spec["added_tokens"]]
        letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in letters]
        self.shown = {b: chr(b) for b in letters} | {b: chr(256 + i) for i, b in enumerate(others)}  # the byte-level alphabet
        self.memory = _Memory(self.of_piece)
        self.old: dict[bytes, bytes] = {}

    def _library(self, text: str) -> bytes:
        return _packed(self.tok.encode(text, add_special_tokens=False).ids)

    def _model(self, word: bytes) -> bytes:
        """The ids of a plain word or a run of punctuation, given in Latin-1."""
        text = word.decode("latin-1")
        if not text.isascii():
            text = "".join(map(self.shown.__getitem__, text.encode()))
        return _packed([t.id for t in self.tok.model.tokenize(text)])

    def of_piece(self, piece: bytes) -> bytes:
        found = self.old.get(piece)
        if found is not None:
            return found
        m = _PLAIN.fullmatch(piece)
        if not m:
            return self._library(piece.decode("latin-1"))
        word, behind = m.groups()
        if not behind:
            return self._model(word)
        # the word is a piece of its own, and so remembered
        return self.memory[word] + self._model(behind)

    def __call__(self, text: str) -> bytes:
        if not self.pieces or any(s in text for s in self.specials):
            return self._library(text)
        try:
            pieces = text.encode("latin-1").decode("latin-1").lower().encode("latin-1").split()
        except UnicodeEncodeError:
            return self._library(text)  # other scripts: lower case and composition are left to the library
        if self.memory.bytes >= MEMORY // 2:
            self.old, self.memory = self.memory, _Memory(self.of_piece)
        return b"".join(map(self.memory.__getitem__, pieces))


class _Memory(dict):
    def __init__(self, compute):
        self.compute, self.bytes = compute, 0

    def __missing__(self, piece: bytes) -> bytes:
        found = self.compute(piece)
        if len(piece) <= LONGEST:
            self[piece] = found
            self.bytes += ENTRY + len(piece) + len(found)
        return found


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and file."""
    return Encoder(path)
