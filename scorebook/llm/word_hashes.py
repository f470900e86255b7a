"""Hashes of all words of many texts at once, with array operations over their bytes."""

from __future__ import annotations

import numpy as np

#: Odd, so that its powers can be inverted modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
PIECE = 1 << 20
_powers: dict[int, np.ndarray] = {}

_word = np.zeros(256, bool)
_word[[*b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_", *range(128, 256)]] = True
#: A fixed random value for each byte.
VALUES = np.random.default_rng(400).integers(1, 1 << 63, 256, np.uint64)


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2 ** 64 for i below n."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, PIECE + 1)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = _powers[base] = np.cumprod(known, dtype=np.uint64)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of polynomial hashes."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of ``values[i] * BASE ** i`` before each place."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ranges, equal for equal values wherever they lie."""
    return mixed((sums[end] - sums[start]) * powers(_INVERSE, len(sums))[start])


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of its text). Words are runs of letters, digits, ``_`` and
    bytes beyond ASCII, in lower case. Long runs of texts are handled in pieces cut
    between words, so that memory follows the piece."""
    hashes, numbers = [], []
    held: list[bytes] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal held, owner, size
        buffer = np.frombuffer(b" " + b" ".join(held) + b" ", np.uint8)
        inside = _word[buffer]
        change = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        start, end = change[::2], change[1::2]
        hashes.append(range_hashes(prefix_sums(VALUES[buffer]), start, end))
        begins = 1 + np.r_[0, np.cumsum([len(h) + 1 for h in held])[:-1]]
        numbers.append(np.array(owner, np.int64)[np.searchsorted(begins, start, "right") - 1])
        held, owner, size = [], [], 0

    for number, text in enumerate(texts):
        raw = text.lower().encode() if text else b""
        while raw:
            piece, raw = raw, b""
            if len(piece) > PIECE:
                cut = max(piece.rfind(b" ", 0, PIECE), piece.rfind(b"\n", 0, PIECE))
                if cut > 0:
                    piece, raw = piece[:cut], piece[cut + 1 :]
            held.append(piece)
            owner.append(number)
            size += len(piece) + 1
            if size > PIECE:
                flush()
    if held:
        flush()
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(numbers)
