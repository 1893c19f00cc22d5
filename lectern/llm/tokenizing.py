"""Whole texts to token ids with a public tokenizer file, piece by piece, each distinct piece once."""

from __future__ import annotations

import re
import struct

import numpy as np

#: Pieces, and words as they stand between spaces, remembered by a worker, so many of each; when so many are held all are
#: forgotten, so memory is bounded (about 200 bytes each).
REMEMBERED = 400_000
_LETTERS = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100))]
_L, _P = "".join(_LETTERS), r"!-&(-/:-@\[-`{-~"
#: Places where no token of either vocabulary crosses: before a run of ASCII white space, and between letters and the
#: punctuation (apostrophes aside) that ends a word. So a word is merged once for all that may follow it.
_PIECE = re.compile(f"[ \n]?[{_L}]+(?=[{_P}]*(?:[ \t-\r]|\\Z))|[{_P}]+(?=[ \t-\r]|\\Z)|[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: White space other than the six ASCII ones: texts with any of it are encoded whole. What splits a text otherwise than at
#: single spaces and line ends; where there is none, each of those begins a piece.
_ODD_SPACES = [c for c in map(chr, (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]
_RARE = ["\t", "\x0b", "\x0c", "\r", "  ", "\n\n", " \n", "\n "]
_WORD = re.compile(f"([ \n]?)([{_L}]+)")


_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")


def _packed(tokens: list) -> bytes:
    return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])


class PieceEncoder:
    """text -> ids as little-endian unsigned 32-bit bytes; equal to the library's encode(text, add_special_tokens=False).

    A special token's string inside a text is that token, as the library has it by default; with special_as_text it is
    ordinary text. For the byte-level and the word vocabulary. Each piece is merged by the library's model, and, unless it
    is plain letters, normalised and split by the library too; texts that may hold a special token's string go to the
    library whole.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = special_as_text
        strings = [] if special_as_text else [t.content for t in self.whole.get_added_tokens_decoder().values()]
        # how they begin, in any case, or nothing, which every text holds
        self.marks = {s[:2] if s[:2].upper() == s[:2].lower() else "" for s in strings}
        self.normalizer, self.split, self.model = self.whole.normalizer, self.whole.pre_tokenizer, self.whole.model
        self.known = _Known(remembered, self._piece)
        self.tokens = _Known(remembered, self._token)
        lower = self.normalizer is not None
        self.mapped = {ord(c): "".join(part for part, _ in self.split.pre_tokenize_str(c.lower() if lower else c)) for c in _LETTERS}
        self.space = self.split.pre_tokenize_str(" a")[0][0][:-1]

    def _piece(self, piece: str) -> bytes:
        plain = _WORD.fullmatch(piece)
        if plain and (plain[1] != "\n" or not self.space):
            tokens = self.model.tokenize((self.space if plain[1] else "") + plain[2].translate(self.mapped))
        elif plain:
            return self.known["\n"] + self.known[plain[2]]
        else:
            text = piece if self.normalizer is None else self.normalizer.normalize_str(piece)
            tokens = [t for part, _ in self.split.pre_tokenize_str(text) for t in self.model.tokenize(part)]
        return _packed(tokens)

    def _token(self, token: str) -> bytes:
        """A word after a space, or after the line end that it begins with, up to the next white space."""
        core = token.rstrip(_MARKS)
        if not (core.isascii() and core.isalpha()):
            return b"".join(map(self.known.__getitem__, _PIECE.findall(token if token[0] == "\n" else " " + token)))
        if len(core) < len(token):
            return self.tokens[core] + self.known[token[len(core) :]]
        return _packed(self.model.tokenize(self.space + core.translate(self.mapped)))

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(c in text for c in _ODD_SPACES) or any(mark in text for mark in self.marks):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if any(c in text for c in _RARE) or text[0] in " \n" or text[-1] in " \n":
            return b"".join(map(self.known.__getitem__, _PIECE.findall(text)))
        first, *rest = text.replace("\n", " \n").split(" ")
        return b"".join(map(self.known.__getitem__, _PIECE.findall(first))) + b"".join(map(self.tokens.__getitem__, rest))


class _Known(dict):
    """key -> ids, made on first use; emptied when `limit` keys are held."""

    def __init__(self, limit: int, make):
        super().__init__()
        self.limit, self.make = limit, make

    def __missing__(self, key) -> bytes:
        found = self.make(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = found
        return found


_LOADED: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, special_as_text: bool = False) -> PieceEncoder:
    """One encoder for a worker process, which reuses what it has learned from task to task."""
    if (path, special_as_text) not in _LOADED:
        _LOADED[path, special_as_text] = PieceEncoder(path, special_as_text=special_as_text)
    return _LOADED[path, special_as_text]
