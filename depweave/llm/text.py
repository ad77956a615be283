"""Pieces of text that tokenizers treat independently."""

from __future__ import annotations

import re
from collections.abc import Iterable

BLANKS = " \t\n\r"
_PIECES = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
# Other white space (for Python or for any regex engine): next to it a cut need not be stable.
_OTHER_BLANK = re.compile("[^\\S \t\n\r]|[᠎​﻿]")

_VISIBLE_THEN_BLANK = re.compile("[^ \t\n\r](?=[ \t\n\r])")


def stable(text: str, at: int) -> bool:
    """Whether tokens of the byte-level pattern end at `at` whatever stands before and after.

    No alternative of the pattern matches white space after anything else, and only runs of white
    space look ahead, so the place between a visible character and a blank always parts two matches,
    and neither side's matches depend on the other side.
    """
    return 0 < at < len(text) and text[at] in BLANKS and not _blank(text[at - 1])


def _blank(char: str) -> bool:
    return char.isspace() or char in "᠎​﻿"


def pieces(text: str) -> list[str] | None:
    """`text` cut at its stable places; None if it has unusual white space and is to be taken whole.
    """
    return None if _OTHER_BLANK.search(text) else _PIECES.findall(text)


# A-Z lower-cased, a-z, digits and bytes of other than ASCII characters kept, a blank for the rest.
_FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def folded(text: str) -> bytes:
    """UTF-8 with A-Z lower-cased and a blank for each byte that is in no word, a word being
    `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`. Byte n of it stands for byte n of the text."""
    return text.encode().translate(_FOLDED)


class Memo(dict):
    """What is known of pieces seen so far, in about `room` bytes: when half of it is full, what was not
    wanted since the last time is forgotten. Very long pieces are not kept."""

    #: Of an entry besides its text: the objects and its share of the table.
    ENTRY = 190

    def __init__(self, room: int = 32 << 20, longest: int = 200):
        super().__init__()
        self.room, self.longest, self.spent, self.before = room, longest, 0, {}

    def missing(self, wanted: Iterable) -> list:
        """The distinct pieces of `wanted` that are not known, which the caller then adds. The others
        can be looked up until the next call."""
        if self.spent > self.room // 2:
            self.before = dict(self)
            self.clear()
            self.spent = 0
        absent = [piece for piece in dict.fromkeys(wanted) if piece not in self]
        self.spent += self.ENTRY * len(absent) + sum(map(len, absent))
        if not self.before:
            return absent
        new = []
        for piece in absent:
            found = self.before.get(piece)
            if found is None:
                new.append(piece)
            else:
                self[piece] = found
        return new

    def forget_long(self, found: list) -> None:
        for piece in found:
            if len(piece) > self.longest and self.pop(piece, None) is not None:
                self.spent -= self.ENTRY + len(piece)


def stretches(text: str, about: int = 1 << 18) -> list[str]:
    """`text` cut at stable places into stretches of about `about` characters; a stretch is longer
    where there is no stable place, and the text is whole if it has unusual white space."""
    if len(text) <= about or _OTHER_BLANK.search(text):
        return [text]
    found, start = [], 0
    while len(text) - start > about:
        place = _VISIBLE_THEN_BLANK.search(text, start + about)
        if place is None:
            break
        found.append(text[start : place.end()])
        start = place.end()
    return [*found, text[start:]]
