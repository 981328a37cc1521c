"""Hashes of the word shingles of whole texts, in numpy, for use inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np

# Upper-case ASCII becomes lower case and the six blank characters become a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b == 32 or 9 <= b <= 13 else b for b in range(256)
)
_RANDOM = np.random.default_rng(20240229)
_LETTER = _RANDOM.integers(1, 2**64, 256, dtype=np.uint64)
_BASE = int(_RANDOM.integers(1, 2**62, dtype=np.uint64)) * 8 + 5
_UNBASE = pow(_BASE, -1, 2**64)
_PIECE = 1 << 17
# A polynomial modulo 2**64 takes certain long words for equal, the shorter the less likely: words
# beyond this many bytes are hashed by what follows instead of themselves.
LONG_WORD = 32


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base % 2**64, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_BASE, 2 * _PIECE)
_UNPOWER = _powers(_UNBASE, 2 * _PIECE)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def fold(text: bytes) -> bytes:
    """The words of a UTF-8 text, ASCII in lower case, with one space between them; a digest stands
    for each long word."""
    words = text.translate(_FOLD).split()
    if words and max(map(len, words)) > LONG_WORD:
        words = [w if len(w) <= LONG_WORD else _digest(w) for w in words]
    return b" ".join(words)


def _digest(word: bytes) -> bytes:
    """NUL and 128 bits in letters."""
    return b"\0" + hashlib.blake2b(word, digest_size=16).hexdigest().encode()


def _windows(words: bytes, size: int) -> np.ndarray:
    """Hashes of each run of ``size`` words of a folded text; of all words if they are fewer."""
    letters = np.frombuffer(words, np.uint8)
    n = len(letters)
    power, unpower = _POWER, _UNPOWER
    if n > len(power):  # one word longer than a piece
        power, unpower = _powers(_BASE, n), _powers(_UNBASE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER[letters] * power[:n], out=sums[1:])
    gaps = np.flatnonzero(letters == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.append(gaps, n)
    size = min(size, len(starts))
    first, last = starts[: len(starts) - size + 1], ends[size - 1 :]
    return mix((sums[last] - sums[first]) * unpower[first] + (last - first).astype(np.uint64))


def shingle_set(text: bytes, size: int = 5) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; empty for a text without words.

    Long texts are hashed piece by piece, each beginning ``size`` - 1 words before the last ended.
    """
    words = fold(text)
    if not words:
        return np.empty(0, np.uint64)
    found = [_windows(piece, size) for piece in _pieces(words, size)]
    return np.unique(found[0] if len(found) == 1 else np.concatenate(found))


def _pieces(words: bytes, size: int):
    """Parts of about ``_PIECE`` bytes that share ``size`` - 1 words with the next."""
    at, cut = 0, words.find(b" ", _PIECE)
    while cut >= 0:
        back = cut
        for _ in range(size - 1):
            back = words.rfind(b" ", at, back) if back > at else -1
        if back > at:
            yield words[at:cut]
            at = back + 1
            cut = words.find(b" ", max(cut + 1, at + _PIECE))
        else:  # too few words so far
            cut = words.find(b" ", cut + 1)
    yield words[at:]
