"""Name normalization with built-in string functions only (no Python in the tasks)."""

from __future__ import annotations

import itertools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


# Code points with canonical decompositions or nonspacing marks lie in these planes.
_PLANES = (range(0x80, 0x20000), range(0x2F800, 0x2FA20), range(0xE0100, 0xE01F0))


def _accent_tables() -> tuple[str, str, dict[str, str]]:
    """Arguments for ``translate`` (letters to replace, then marks to delete; replacements), and
    the signs that stand for several letters. Hangul syllables follow a rule of their own."""
    letters, marks, several = {}, [], {}
    for code in itertools.chain(*_PLANES):
        char = chr(code)
        kept = [c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c) != "Mn"]
        if not kept:
            marks.append(char)
        elif len(kept) > 1 and code not in _HANGUL:
            several[char] = "".join(kept)
        elif len(kept) == 1 and kept[0] != char:
            letters[char] = kept[0]
    return "".join([*letters, *marks]), "".join(letters.values()), several


# Hangul syllables: 19 leading letters times 21 vowels times 27 trailing letters or none.
_HANGUL = range(0xAC00, 0xD7A4)
_LEADING, _VOWELS, _TRAILING = (
    "".join(map(chr, range(first, first + count)))
    for first, count in ((0x1100, 19), (0x1161, 21), (0x11A8, 27))
)

_FROM, _TO, _SEVERAL = _accent_tables()
_COMPOUND = f"[\uac00-\ud7a3{''.join(_SEVERAL)}]"


def _decomposed(char: Column) -> Column:
    """The letters of a Hangul syllable or of a sign that stands for several; others as they are."""
    at = F.ascii(char) - _HANGUL.start
    count = len(_TRAILING) + 1

    def letter(letters: str, place: Column) -> Column:
        return F.substr(F.lit(letters), place.cast("int"), F.lit(1))

    syllable = F.concat(
        letter(_LEADING, F.floor(at / (len(_VOWELS) * count)) + 1),
        letter(_VOWELS, F.floor(at / count) % len(_VOWELS) + 1),
        F.when(at % count > 0, letter(_TRAILING, at % count)).otherwise(""),
    )
    several = F.str_to_map(
        F.lit(",".join(f"{sign}={letters}" for sign, letters in _SEVERAL.items())),
        F.lit(","),
        F.lit("="),
    )
    inside = at.between(0, len(_HANGUL) - 1)
    return F.when(inside, syllable).otherwise(F.coalesce(F.try_element_at(several, char), char))


def _as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c: Column | str) -> Column:
    """Text without accents: NFD decomposition with nonspacing marks dropped, case kept.

    One pass with a table built from the Unicode database, which text without any accent skips.
    Signs that decompose into several letters, Hangul syllables among them, are taken apart letter
    by letter, in the texts that have any. NULL stays NULL, and letters without a decomposition
    (đ, ß, ø) are kept.
    """
    text = _as_column(c)
    letters = F.split(F.translate(text, _FROM, _TO), "")
    apart = F.array_join(F.transform(letters, _decomposed), "")
    return (
        F.when(~text.rlike(r"[^\x00-\x7F]"), text)
        .when(text.rlike(_COMPOUND), apart)
        .otherwise(F.translate(text, _FROM, _TO))
    )


def normalize_name(c: Column | str) -> Column:
    """Join key of a place name: no accents, upper case, letters, digits and single spaces only."""
    plain = F.regexp_replace(F.upper(strip_accents(c)), "[^A-Z0-9 ]", "")
    return F.trim(F.regexp_replace(plain, " +", " "))
