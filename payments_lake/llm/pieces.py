"""Texts as pieces between spaces: the tokens of a text are those of its pieces, one by one."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

# A space before a character that is no space always begins a token of its own; a space before
# other white space may be part of a longer run, which then stays whole.
RUN = re.compile(r" \s")
CUT = re.compile(r" (?=\S)")
LONGEST_CACHED = 64
MOST_CACHED = 600_000


def pieces(text: str) -> tuple[str, Iterable[str]]:
    """The text before the first cut, and the pieces after it, each without its leading space."""
    parts = CUT.split(text) if RUN.search(text) else text.split(" ")
    return parts[0], parts[1:]


def is_word(piece: str) -> bool:
    """Letters only, of scripts whose letters every Unicode version agrees on. Such a word is a
    token of its own whatever punctuation follows."""
    return piece.isalpha() and (piece.isascii() or max(piece) < "\u0500")


class PieceCache(dict):
    """Values of pieces with a leading space; ``bare`` has those of pieces without one.

    Both forget everything once they hold ``MOST_CACHED`` pieces, and keep no long ones, so their
    memory is bounded. ``value`` computes the value of a string, ``join`` adds values up.
    """

    def __init__(self, value: Callable[[str], object], join: Callable[[Iterator], object], lead: str = " ") -> None:
        super().__init__()
        self.value, self.join, self.lead = value, join, lead
        self.bare = PieceCache(value, join, "") if lead else self

    def __missing__(self, piece: str):
        if is_word(piece):
            return self._kept(piece, self.value(self.lead + piece))
        lines = piece.split("\n")
        # A line break between two printed characters is a token of its own.
        if len(lines) > 1 and all(lines) and len(piece.split()) == len(lines) and not re.search(r"\s\s|^\s|\s$|[^\S\n]", piece):
            first, *rest = lines
            found = self.join(self._lined(first, rest))
        else:
            core = piece.rstrip(".,;:!?")
            if len(core) < len(piece) and is_word(core):
                found = self.join(iter((self[core], self.bare[piece[len(core) :]])))
            else:
                found = self.value(self.lead + piece)
        return self._kept(piece, found)

    def _kept(self, piece: str, found):
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= MOST_CACHED:
                self.clear()
            self[piece] = found
        return found

    def _lined(self, first: str, rest: list[str]) -> Iterator:
        yield self[first]
        for line in rest:
            yield self.bare["\n"]
            yield self.bare[line]

    def of(self, text: str):
        """The value of a whole text."""
        if not text:
            return self.join(iter(()))
        first, rest = pieces(text)
        if not first:
            return self.join(map(self.__getitem__, rest))
        return self.join(v for part in ((self.bare[first],), map(self.__getitem__, rest)) for v in part)
