"""Pre-tokens of a text as a tokenizer file describes them: normalised, lower case, split.

Texts are normalised as a whole and cut at spaces and line feeds. No pre-token, composed
character or special string crosses one, so each distinct word is split once, however
often it occurs.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache

import regex

PIECE = 1 << 20  # characters handled at once
SPECIAL = "\ud800"  # starts the word of a special string; no text holds it

# What Unicode 16 added to the letters and numbers of Python's tables (15.1).
# The tokenizer library classes characters by Unicode 16.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
)
# Lower case of letters that Python's tables (15.1) do not know; the library
# takes lower case from Unicode 17.
NEW_LOWER = (
    {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5,
     0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
    | {c: c + 0x20 for c in range(0x10D50, 0x10D66)}
    | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
)
# Combining marks, and one second half of a composed character, that are
# newer than the library's tables for the normal form. It neither moves nor composes them.
UNMOVED = (
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C),
    (0xEBA, 0xEBA), (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C),
    (0x10D24, 0x10D27), (0x10EAB, 0x10EAC), (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85),
    (0x11070, 0x11070), (0x1133B, 0x1133B), (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930),
    (0x1193D, 0x1193E), (0x11943, 0x11943), (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47),
    (0x11A99, 0x11A99), (0x11D42, 0x11D42), (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42),
    (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F), (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF),
    (0x1E4EC, 0x1E4EF),
)
# The characters of the White_Space property.
SPACES = r"\t\n\x0b\x0c\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LOWER = str.maketrans(NEW_LOWER)


def class_body(ranges: Iterable[tuple[int, int]]) -> str:
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in sorted(ranges))


_UNMOVED = re.compile(f"([{class_body(UNMOVED)}]+)")
_LATE = re.compile("[\u07fd-\U0010ffff]").search  # all that needs a second look is here
_RARE = re.compile(f"[{class_body([*UNMOVED, *((c, c) for c in NEW_LOWER)])}]").search
_BEYOND_LATIN = re.compile("[^\x00-\xff]").search


def normalised(text: str) -> str:
    """NFC and lower case by the library's tables."""
    if text.isascii():
        return text.lower()
    if _LATE(text) and _RARE(text):
        parts = _UNMOVED.split(text)
        parts[::2] = [unicodedata.normalize("NFC", p) for p in parts[::2]]
        text = "".join(parts).translate(_LOWER)
    else:
        text = unicodedata.normalize("NFC", text)
    # Letter by letter: the form of a final sigma does not depend on its place.
    return text.replace("Σ", "σ").lower()


def category_ranges(kind: str, more: tuple[tuple[int, int], ...]) -> str:
    """The body of a character class: all code points of a general category."""
    ranges: list[tuple[int, int]] = list(more)
    start = None
    for c in range(0x110001):
        inside = c < 0x110000 and unicodedata.category(chr(c))[0] == kind
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            ranges.append((start, c - 1))
            start = None
    return class_body(ranges)


@cache
def spelled_out(pattern: str) -> dict[str, str]:
    """A pattern with its classes of letters, numbers and spaces spelled out: ``latin`` for
    texts below U+0100, ``full`` for all. ``known`` serves texts without a character of the
    class ``strange``, of which the pattern library knows another kind."""
    letters, numbers = category_ranges("L", NEW_LETTERS), category_ranges("N", NEW_NUMBERS)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

    def put(text: str, letters: str, numbers: str) -> str:
        return text.replace(r"\p{L}", letters).replace(r"\p{N}", numbers).replace(r"\s", SPACES)

    strange: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        strange ^= set(regex.findall(kind, every)) ^ set(re.findall(f"[{put(kind, letters, numbers)}]", every))
    latin = every[:256]
    low = [class_body((ord(c), ord(c)) for c in regex.findall(kind, latin)) for kind in (r"\p{L}", r"\p{N}")]
    return {
        "latin": put(pattern, *low),
        "known": pattern.replace(r"\s", SPACES),
        "full": put(pattern, letters, numbers),
        "strange": f"[{class_body((ord(c), ord(c)) for c in strange)}]",
    }


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [names[b] for b in range(256)]


def read_spec(path: str) -> dict:
    """A tokenizer file whose rules this folder knows; any other is an error."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
    _, level = spec["pre_tokenizer"]["pretokenizers"]
    if (model["type"], kinds, level["type"]) != ("BPE", ["NFC", "Replace", "Lowercase"], "ByteLevel") or not model[
        "end_of_word_suffix"
    ]:
        raise ValueError("a byte-level BPE with word ends, NFC and lower case is expected")
    if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("added tokens with matching rules of their own are not supported")
    return spec


def pieces(text: str) -> Iterator[str]:
    """A long text in parts that end at a space or line feed; a stretch without one stays
    whole."""
    start = 0
    while len(text) - start > PIECE:
        gap = re.compile("[ \n]").search(text, start + PIECE)
        if gap is None:
            break
        yield text[start : gap.end()]
        start = gap.end()
    yield text[start:]


class Splitter:
    """Splits texts into words and words into pre-tokens."""

    def __init__(self, spelled: dict[str, str], specials: list[str]):
        """``spelled`` is ``spelled_out(pattern)``, made once on the driver."""
        self.latin = re.compile(spelled["latin"]).findall
        self.known = regex.compile(spelled["known"]).findall
        self.strange, self.spelled = re.compile(spelled["strange"]).search, spelled["full"]
        self.full = None
        self.marks = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True))) or "(?!)")

    def cut(self, text: str) -> list[tuple[str, bool]]:
        """(normalised text, false) and (special string, true) in order. Words of the
        former stand between spaces."""
        if "<" not in text or not self.marks.search(text):
            return [(normalised(text).replace("\n", " "), False)]
        out, start = [], 0
        for mark in self.marks.finditer(text):
            out += [(normalised(text[start : mark.start()]).replace("\n", " "), False), (mark[0], True)]
            start = mark.end()
        return [*out, (normalised(text[start:]).replace("\n", " "), False)]

    def words(self, text: str) -> list[str]:
        """Words in order, empty ones among them; special strings after ``SPECIAL``."""
        cut = self.cut(text)
        if len(cut) == 1:
            return cut[0][0].split(" ")
        return [w for part, special in cut for w in ([SPECIAL + part] if special else part.split(" "))]

    def split(self, word: str) -> list[str]:
        """Pre-tokens of a word that is no special string."""
        if word.isalpha():
            return [word]
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return [word[:-1], word[-1]]
        if not _BEYOND_LATIN(word):
            return self.latin(word)
        if not self.strange(word):
            return self.known(word)
        if self.full is None:
            self.full = re.compile(self.spelled).findall
        return self.full(word)
