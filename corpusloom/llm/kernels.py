"""Vectorised text kernels: whole Arrow batches as arrays of code points, words, and word sequences.

Texts are joined into blocks of about BLOCK characters (a longer text is a block of its own), so memory is bounded by
the longest text and not by the batch.  Words are told apart by a class table over all code points; their hashes come
from one prefix sum per block (a polynomial modulo 2**64), so no word becomes a Python object.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np

BLOCK = 1 << 20
_SEPARATOR = "\U0010fffe"  # a noncharacter, in no exchanged text
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@cache
def _alnum_table() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


@cache
def _latin_table() -> np.ndarray:
    """0 between words, 1 in words (a-z, 0-9), 2 not there at all: combining marks, zero-width characters, soft hyphens."""
    t = np.fromiter((2 if unicodedata.category(chr(i))[0] == "M" else 0 for i in range(0x110000)), np.uint8, 0x110000)
    for i in (0x00AD, 0x180E, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF):
        t[i] = 2
    for a, b in ("az", "09"):
        t[ord(a) : ord(b) + 1] = 1
    return t


@cache
def _powers(exponent: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << exponent
    with np.errstate(over="ignore"):
        up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        return np.cumprod(up), np.cumprod(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def blocks(texts: list[str], size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """(begin, end) of runs of texts that hold about `size` characters."""
    begin = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > size:
            yield begin, i
            begin, total = i, 0
        total += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def _code_points(texts: list[str]) -> np.ndarray:
    joined = _SEPARATOR.join(texts)
    if joined.count(_SEPARATOR) != len(texts) - 1:
        joined = _SEPARATOR.join(t.replace(_SEPARATOR, " ") for t in texts)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)


def spans(texts: list[str], latin: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points as they are compared, begin and end of each word in them, text of each word, hash of each word).

    Words are maximal runs of letters or digits, lower-cased; with `latin` runs of a-z and 0-9 after compatibility
    decomposition, removal of marks and invisible characters, and lower-casing.
    """
    if latin:
        texts = [t if t.isascii() else unicodedata.normalize("NFKD", t) for t in texts]
    cp = _code_points([t.lower() for t in texts])
    if latin:
        kind = _latin_table()[cp]
        if (kind == 2).any():
            cp, kind = cp[kind != 2], kind[kind != 2]
        inside = kind == 1
    else:
        inside = _alnum_table()[cp]
    edge = np.flatnonzero(np.diff(np.r_[False, inside, False].astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return cp, begin, end, np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = _powers(max(10, int(len(cp)).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(cp) + 1, np.uint64)
        np.cumsum((cp + np.uint32(1)).astype(np.uint64) * up[: len(cp)], out=sums[1:])
        h = mix((sums[end] - sums[begin]) * down[begin])
    owner = np.searchsorted(np.flatnonzero(cp == ord(_SEPARATOR)), begin)
    return cp, begin, end, owner, h


def words(texts: list[str], latin: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(text of each word, hash of each word) of a block, as in `spans`."""
    return spans(texts, latin)[3:]


def sequences(owner: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place of the first word, hash) of every run of n words inside one text."""
    if len(h) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(owner[: len(h) - n + 1] == owner[n - 1 :])
    with np.errstate(over="ignore"):
        s = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            s = s * _BASE + h[k : len(h) - n + 1 + k]
    return owner[at], at, mix(s[at])
