"""Words of many texts at once, as 64-bit hashes, with numpy.

Texts are joined as UTF-8 bytes with a separator between them, so words never
cross texts.  A word's hash is a polynomial of its bytes modulo 2**64, taken
from running sums and then mixed, so no loop runs over words.
"""

from __future__ import annotations

import numpy as np

from ledgerline.llm.common import SPACE_CHARS

BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        _POWERS[:] = []
        for b in (BASE, INVERSE):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def space_table(lower: bool) -> np.ndarray:
    """Byte map for words between white space; 0 marks a separator."""
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    t[0] = 1  # a NUL is part of a word; no text has U+0001 and U+0000 told apart here
    t[[ord(c) for c in SPACE_CHARS]] = 0
    return t


def alnum_table() -> np.ndarray:
    """Byte map for words of ASCII letters, digits, underscores and all other code points."""
    t = np.arange(256, dtype=np.uint8)
    for b in range(128):
        if not (chr(b).isalnum() or b == 95):
            t[b] = 0
    return t


def hash_words(texts: list[bytes], table: np.ndarray, separator: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in order, number of words of each text)."""
    data = np.frombuffer(separator.join([b"", *texts, b""]), np.uint8)
    mapped = table[data]
    inside = mapped != 0
    edge = np.diff(inside.view(np.int8))
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    p, inv = powers(len(data))
    total = mapped.astype(np.uint64)
    total *= p[:len(data)]
    np.cumsum(total, out=total)
    h = (total[ends - 1] - total[starts - 1]) * inv[starts]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    bounds = np.cumsum(lengths + len(separator)) + len(separator)  # where the next text starts
    n = np.diff(np.searchsorted(starts, np.concatenate([[0], bounds])))
    return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(40))), n


def runs(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each run of the given lengths."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
