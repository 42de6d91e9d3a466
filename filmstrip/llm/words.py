"""Words of texts as ids, for the Arrow passes over whole documents."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

#: A time mark of a transcript or subtitle, such as 00:14 or 00:00:14,250.
TIME_MARK = re.compile(r"(?<!\d)\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?(?!\d)")
_MARKS = re.compile("[̀-ͯ]+")
_WORD = re.compile(r"[^\W_]+")


def folded(text: str) -> str:
    """Without case, accents, width and Unicode form."""
    return _MARKS.sub("", unicodedata.normalize("NFKD", text.casefold())).replace("đ", "d")


def words(text: str) -> list[str]:
    """Folded words without time marks; punctuation parts words."""
    return _WORD.findall(folded(TIME_MARK.sub(" ", text)))


class Pieces(dict):
    """What a function makes of a piece between white space, kept for the pieces seen so far (`most` of them)."""

    def __init__(self, make: Callable[[str], object], most: int = 200_000) -> None:
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, piece: str) -> object:
        made = self.make(piece)
        if len(self) < self.most and len(piece) < 100:
            self[piece] = made
        return made
