"""Pre-tokens of public byte-level tokenizers, for characters below U+0250;
what holds others goes to the library."""

from __future__ import annotations

import re
import unicodedata

import numpy as np

from .kernel import mix, prefix_hashes, prime_range_hashes, range_hashes, ranges

LIMIT = 0x250


def _char_class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(LIMIT) if unicodedata.category(chr(c))[0] == kind)


LETTER, NUMBER = _char_class("L"), _char_class("N")
#: white space below the limit (not what Python's own class holds)
BLANK = "\\t-\\r \\x85\\xa0"
#: a character that the patterns below were not proven for
OTHER = re.compile(f"[^\\x00-\\u{LIMIT - 1:04x}]")

BYTE_LEVEL = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+|"
    f"[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
WORD_ENDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+")


BLANK_KIND, LETTER_KIND, NUMBER_KIND, SYMBOL_KIND, FOREIGN_KIND = range(5)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of each character below the limit. One whose lower
    case is not a single character below the limit is foreign."""
    kinds, lower = np.zeros(LIMIT + 1, np.uint8), np.zeros(LIMIT + 1, np.uint32)
    blank = re.compile(f"[{BLANK}]")
    for c in range(LIMIT):
        char = chr(c)
        low = char.lower()
        lower[c] = ord(low[0])
        if len(low) > 1 or lower[c] >= LIMIT:
            kinds[c] = FOREIGN_KIND
        elif not blank.match(char):
            kinds[c] = {"L": LETTER_KIND, "N": NUMBER_KIND}.get(unicodedata.category(char)[0], SYMBOL_KIND)
    kinds[LIMIT] = FOREIGN_KIND
    return kinds, lower


_KINDS, _LOWER = _tables()
_ASCII_BLANK = np.zeros(LIMIT + 1, bool)
_ASCII_BLANK[[0x20, *range(0x09, 0x0E)]] = True


class WordEnds:
    """Pre-tokens (``WORD_ENDS``) of a batch of UTF-8 texts.

    ``start``, ``end``: places in ``points`` (code points, lowered);
    ``hashes``: of their characters; ``foreign``: pre-tokens that are not
    proven here, each a whole run between ASCII blanks that holds a character
    from U+0250 on or one of the strings ``special``, as it is in the text;
    ``first``: number of each text's first pre-token (one more at the end).
    White space is dropped by these vocabularies, so a text's ids are those
    of its runs, one after another.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, special: list[str]):
        raw = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
        bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum((data & 0xC0) != 0x80)))[offsets]
        n = len(raw)
        known = np.minimum(raw, LIMIT)
        kind, self.raw = _KINDS[known], raw
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        edge[n] = True
        foreign = self._foreign(kind, ~_ASCII_BLANK[known], edge, bounds, special)
        self.points = np.where(foreign, raw, _LOWER[known])
        usual = (kind != BLANK_KIND) & ~foreign
        before = np.concatenate(([False], usual[:-1])) & ~edge[:-1]
        new = np.ones(n, bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER_KIND)
        begins = usual & (~before | new)
        self._contractions(begins, usual, kind, edge)
        after = np.concatenate((begins[1:] | ~usual[1:], [True])) | edge[1:]
        begins |= foreign & (np.concatenate(([True], ~foreign[:-1])) | edge[:-1])
        after = np.where(foreign, np.concatenate((~foreign[1:], [True])) | edge[1:], after & usual)
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(after) + 1
        self.foreign = foreign[self.start]
        self.first = np.searchsorted(self.start, bounds)
        hashes = range_hashes(prefix_hashes(self.points), self.start, self.end) \
            ^ mix(prime_range_hashes(self.points, self.start, self.end) + np.uint64(1))
        self.hashes = mix(hashes ^ self.foreign.astype(np.uint64))

    def _foreign(self, kind, run, edge, bounds, special) -> np.ndarray:
        """Characters of the runs that hold something foreign."""
        odd = kind == FOREIGN_KIND
        for text in special:
            own = np.array([ord(c) for c in text], np.uint32)
            at = np.flatnonzero(self.raw[: max(0, len(self.raw) - len(own) + 1)] == own[0])
            for k in range(1, len(own)):
                at = at[(self.raw[at + k] == own[k]) & ~edge[at + k]]
            odd[at] = True
        if not odd.any():
            return odd
        begins = run & (np.concatenate(([True], ~run[:-1])) | edge[:-1])
        number = np.cumsum(begins)
        held = np.zeros(int(number[-1]) + 1, bool)
        held[number[odd]] = True
        return run & held[number]

    def _contractions(self, begins, usual, kind, edge) -> None:
        """An apostrophe that begins a pre-token takes s, t, m, d, re, ve or
        ll with it; the letters after those begin another one."""
        n = len(begins)
        letter = np.concatenate((usual & (kind == LETTER_KIND), [False, False]))
        points = np.concatenate((self.points, np.zeros(2, self.points.dtype)))
        edge = np.concatenate((edge, [True, True]))
        at = np.flatnonzero(begins & (self.points == ord("'")))
        at = at[letter[at + 1] & ~edge[at + 1]]
        one, two = points[at + 1], points[at + 2]
        two = np.where(letter[at + 2] & ~edge[at + 2], two, 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        at, size = at[short | long], np.where(short, 2, 3)[short | long]
        begins[at + 1] = False
        rest = at + size
        rest = rest[(rest < n) & letter[rest] & ~edge[rest]]
        begins[rest] = True

    def texts(self, which: np.ndarray) -> list[str]:
        """The named pre-tokens as strings."""
        size = (self.end - self.start)[which]
        whole = self.points[ranges(self.start[which], size)].astype("<u4").tobytes().decode("utf-32-le")
        ends = np.cumsum(size)
        return [whole[a:b] for a, b in zip((ends - size).tolist(), ends.tolist())]


#: places where every pre-token of BYTE_LEVEL ends: from a character that is no
#: white space anywhere to white space; nothing is matched across them
_SAFE = re.compile(f"(?<=\\S)(?=[{BLANK}])")


def safe_pieces(text: str, special: list[str]) -> tuple[list[str], list[str]]:
    """The text's pieces between safe places: proven ones, and foreign ones (a
    character from U+0250 on, or one of the strings ``special``)."""
    proven, foreign = [], []
    for piece in _SAFE.split(text):
        (foreign if OTHER.search(piece) or any(s in piece for s in special) else proven).append(piece)
    return proven, foreign


def load_tokenizer(path: str):
    """The tokenizers library's tokenizer, on this task's thread alone."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def vocabulary_strings(tokenizer) -> list[str]:
    """Vocabulary entries as plain text (those that are whole UTF-8), for a
    byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    to_byte = {chr(b): b for b in printable}
    extra = 0
    for b in range(256):
        if b not in printable:
            to_byte[chr(256 + extra)] = b
            extra += 1
    out = []
    for token in tokenizer.get_vocab(with_added_tokens=False):
        try:
            out.append(bytes(to_byte[c] for c in token).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):
            continue
    return out
