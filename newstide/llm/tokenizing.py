"""Token ids of whole texts by the ``tokenizers`` library, with a bounded cache of words.

Between a character that is not white space and white space, no token of the two public vocabularies used here can
reach across: their pre-tokenizers break there. A text is cut at those places only, and the ids of a piece are
remembered, so that frequent words are encoded once per Python worker. Pieces with characters for which white space or
case could be read differently by Python and by the library are given to the library whole.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable
from functools import lru_cache

import regex

#: Entries kept per worker, twice; beyond it the older half goes. It bounds memory and has no effect on results.
CACHE_ENTRIES = 450_000

#: White space that the cuts below do not treat as such.
_RARE_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -​    　﻿]")
#: Marks of white space that is not a single space or line end between words.
_UNEVEN = ("\t", "\r", "  ", " \n", "\n ", "\n\n")
#: Letters up to Latin Extended-B: every Unicode version and library agrees on them.
_PLAIN = re.compile("[\x00-ɏ]*")


#: Marks that stand alone beside letters in the patterns of both vocabularies.
_MARKS = frozenset(".,;:!?|")


class _Pieces(dict):
    """Piece of text to the bytes of its ids, little-endian unsigned 32 bits each; keeps the pieces met lately."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.before.get(piece) if self.before else None
        if ids is None:
            ids = self.encode(piece)
        if len(piece) < 200:
            if len(self) >= CACHE_ENTRIES:
                self.before = dict(self)
                self.clear()
            self[piece] = ids
        return ids


def as_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit ids."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Encodes texts with a tokenizer file; ``ids`` returns the bytes of the ids."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        pre = str(self.library.pre_tokenizer)
        if self.library.normalizer is None and pre.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in pre:
            self._units = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+").findall
            self._words = regex.compile(_pattern()).findall
            self._normalize = None
        elif "Lowercase()" in str(self.library.normalizer) and "behavior=Removed, invert=True" in pre:
            self._units = str.split  # rare spaces apart, which are looked for first, it splits at the same places
            self._words = regex.compile(re.search(r'Regex\("(.*?)"\), behavior=Removed, invert=True', pre)[1].replace("\\\\", "\\")).findall
            self._normalize = self.library.normalizer.normalize_str
        else:
            self._units = None
        self._words_seen = _Pieces(self._word)
        self._units_seen = _Pieces(self._unit)
        self._spaced_seen = _Pieces(lambda word: self._unit(" " + word))

    def _whole(self, text: str) -> bytes:
        return as_bytes(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        return as_bytes([t.id for t in self.model.tokenize(word.encode().decode("latin-1").translate(_BYTE_CHARS))])

    def _unit(self, unit: str) -> bytes:
        if not unit.isascii() and not _PLAIN.fullmatch(unit):
            return self._whole(unit)
        if self._normalize:
            unit = unit.lower() if unit.isascii() else self._normalize(unit)
        if unit[:1] == " " or self._normalize:
            # The common shapes, without the pattern: letters, or letters and one of the marks that letters cannot join.
            own = unit if self._normalize else unit[1:]
            if own.isalpha():
                return self._word(unit)  # kept as a unit, so not once more as a word
            if own[-1:] in _MARKS and own[:-1].isalpha():
                # The word without its mark is a unit as well, and most likely met already.
                first = self._units_seen[unit[:-1]] if self._normalize else self._spaced_seen[own[:-1]]
                return first + self._words_seen[own[-1]]
        words = self._words(unit)
        return self._words_seen[words[0]] if len(words) == 1 else b"".join(map(self._words_seen.__getitem__, words))

    def ids(self, text: str) -> bytes:
        """Ids of the whole text as ``encode(text, add_special_tokens=False)`` gives them."""
        if self._units is None or any(t in text for t in self.special) or _RARE_SPACE.search(text):
            return self._whole(text)
        if self._normalize or not text or text[0] in " \n" or text[-1] in " \n" or any(m in text for m in _UNEVEN):
            return b"".join(map(self._units_seen.__getitem__, self._units(text)))
        # Words parted by one space or line end each: cheaper to take apart, to the same units.
        out: list[bytes] = []
        end = ""
        for line in text.split("\n"):
            first, *words = line.split(" ")
            out.append(self._units_seen[end + first])
            out += map(self._spaced_seen.__getitem__, words)
            end = "\n"
        return b"".join(out)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _byte_chars() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves and the others as the code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in shown else next(rest)) for b in range(256)}


_BYTE_CHARS = _byte_chars()


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)
