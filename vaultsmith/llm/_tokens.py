"""Token ids of whole texts by a tokenizers file, with words remembered.

A BPE over pre-split text never joins characters across the start of a white-space
separated chunk, so the ids of a text are the ids of its chunks in order. Most chunks
repeat: their ids are kept in a bounded table. An unseen chunk of Latin-1 text is split by
the tokenizer's own pattern and its parts go straight to the tokenizer's model (which
skips its costly bookkeeping of offsets); any other chunk, and any text that holds one of
the tokenizer's special strings, is encoded by the tokenizer as it is.
"""

from __future__ import annotations

import functools
import json
import os
import re
import string
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
import regex

#: Entries of a table: those made or used since its last turn, and as many from before it.
MAX_CACHED = 450_000
MAX_CACHED_PARTS = 200_000
MAX_CACHED_CHARS = 48

# Fixed value: Unicode white space.
_WS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
_WORD = re.compile(f"[^{re.escape(_WS)}]+").findall
# One space belongs to the word behind it; a run of white space gives up its last character.
_SPACED = re.compile(f" ?[^{re.escape(_WS)}]+|[{re.escape(_WS)}]+(?![^{re.escape(_WS)}])|[{re.escape(_WS)}]+").findall
#: Where white space touches more of it, or with these, the simple split at spaces and line ends would be wrong.
_TOUCHING = ("  ", "\n ", " \n", "\n\n", *[c for c in _WS if c not in " \n"])
#: str.split() also cuts at these, which are no white space to a tokenizer.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_PROBE = ["word", " word,", "'tis", " it's", " x1y22", "ÀÉ", " ñandú!?", "A.B-C", "word.", "ñ)", "it'", "Wörd,***", "x_", " ...", "\n", "3.14", " don't", "ŁÓDŹ", "_a_", "İs"]


def _byte_alphabet() -> dict[int, int]:
    """The public byte-level alphabet: printable Latin-1 as itself, other bytes from U+0100 on."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in kept]
    return {b: 256 + k for k, b in enumerate(others)}


def _latin(text: str) -> bool:
    return text.isascii() or len(text.encode("latin-1", "ignore")) == len(text)


class _Table(dict):
    """Key -> ids as bytes, made on first use. When the table is full its entries become the
    old ones: those used again come back, the others are forgotten at the next turn."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        ids = self.old.get(key)
        if ids is None:
            ids = self.make(key)
        if len(key) <= MAX_CACHED_CHARS:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = ids
        return ids


class ChunkEncoder:
    """ids of whole texts, as bytes of ``dtype`` numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        self.drops_space = steps[0]["type"] == "Split"
        pattern = steps[0]["pattern"]["Regex"] if self.drops_space else public_tokenizers.PATTERN
        self._split = regex.compile(pattern).findall
        self._normalize = self.tokenizer.normalizer.normalize_str if self.tokenizer.normalizer else None
        if self._normalize:
            # Latin-1 has no marks that join the letter before them: what holds for each character holds for texts.
            latin = [chr(c) for c in range(256) if chr(c) not in _WS]
            if all(self._normalize(c) == c.lower() for c in latin) and self._normalize("".join(latin)) == "".join(latin).lower():
                self._normalize = str.lower
        self._alphabet = _byte_alphabet()
        self._letters = [chr(self._alphabet.get(b, b)) for b in range(256)]
        self._space = self._letters[32]
        self._model = self.tokenizer.model.tokenize
        # The tables below remember more than the model's own one, which then only costs time.
        self.tokenizer.model._resize_cache(0)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self._typecode = "H" if self.vocab_size <= 1 << 16 else "I"
        self.dtype = np.dtype(self._typecode)
        self._parts = _Table(self._part, MAX_CACHED_PARTS)
        self._chunks = _Table(self._chunk, MAX_CACHED if self.drops_space else MAX_CACHED_PARTS)
        self._spaced = _Table(self._piece, MAX_CACHED)
        for probe in _PROBE:
            if self._chunk(probe) != self._whole(probe):
                raise ValueError(f"{path}: chunks can't be encoded one by one, tried {probe!r}")

    def _bytes(self, ids: list[int]) -> bytes:
        return array(self._typecode, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isprintable():
            letters = part.replace(" ", self._space)
        else:
            letters = "".join(map(self._letters.__getitem__, part.encode()))
        return self._bytes([t.id for t in self._model(letters)])

    def _chunk(self, chunk: str) -> bytes:
        if not _latin(chunk):
            return self._whole(chunk)
        text = chunk
        if self._normalize:
            text = chunk.lower() if chunk.isascii() else self._normalize(chunk)
        if self.drops_space:
            letters = text.rstrip(string.punctuation)
            if letters.isalpha():
                # Letters are one part, and so is the run of marks behind them; a word of small letters is remembered once.
                if letters == chunk:
                    return self._part(letters)
                return self._chunks[letters] if letters == text else self._chunks[letters] + self._parts[text[len(letters):]]
        elif text.isalpha() or text[:1] == " " and text[1:].isalpha():
            return self._parts[text]  # letters alone, with or without the space before them, are one part
        return b"".join([self._parts[p] for p in self._split(text)])

    def _piece(self, piece: str) -> bytes:
        """What follows a space up to the next one, with that space, or a line end with what follows it."""
        if piece[:1] == "\n":
            return self._chunks["\n"] + self._chunk(piece[1:]) if len(piece) > 1 else self._chunk(piece)
        if not self._normalize:
            letters = piece.rstrip(string.punctuation)
            if letters.isalpha() and _latin(letters):
                # Letters are one part with the space before them, and so is the run of marks behind them.
                if letters == piece:
                    return self._part(" " + letters)
                return self._spaced[letters] + self._parts[piece[len(letters):]]
        return self._chunk(" " + piece)

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self._whole(text)
        if self.drops_space:
            words = _WORD(text) if any(c in text for c in _SEPARATORS) else text.split()
            return b"".join(map(self._chunks.__getitem__, words))
        if any(p in text for p in _TOUCHING):
            return b"".join(map(self._chunks.__getitem__, _SPACED(text)))
        first, *rest = text.replace("\n", " \n").split(" ")
        return b"".join([*map(self._chunks.__getitem__, _SPACED(first)), *map(self._spaced.__getitem__, rest)])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """One encoder per Python worker; workers are reused, so its table serves many tasks."""
    return ChunkEncoder(path)


def tokenizer_path(name: str) -> str:
    return public_tokenizers.path(name)
