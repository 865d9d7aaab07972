"""Seeded hashing: the only source of randomness, so any engine can follow the same choice."""

from __future__ import annotations

from functools import reduce
from hashlib import md5

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = 4294967296.0  # 2**32


def digest(seed, *keys: Column) -> Column:
    """md5 hex text of seed and keys joined by '-'."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[key.cast("string") for key in keys]))


def word_of(hex_text: Column, index: int | Column = 0) -> Column:
    """The index-th group of eight hex digits as a BIGINT."""
    start = F.lit(index) * 8 + 1
    return F.conv(F.substr(hex_text, start.cast("int"), F.lit(8)), 16, 10).cast("bigint")


def hash_unit(seed, *keys: Column) -> Column:
    """Uniform value in [0, 1) fixed by seed and keys."""
    return word_of(digest(seed, *keys)) / F.lit(_WORD)


def hash_bucket(seed, n: int, *keys: Column) -> Column:
    """Bucket number 0 .. n-1 fixed by seed and keys."""
    return F.floor(hash_unit(seed, *keys) * F.lit(float(n))).cast("int")


def poisson_one(unit: Column) -> Column:
    """Poisson(1) quantile of a uniform value; the tail beyond 12 has mass below 2**-32."""
    steps, total, term = [], 0.0, 0.36787944117144233
    for k in range(13):
        total += term
        steps.append(total)
        term /= k + 1
    counts = [F.when(unit >= F.lit(edge), 1).otherwise(0) for edge in steps[:-1]]
    return reduce(lambda a, b: a + b, counts)


_MD5_SHIFTS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_MD5_SINES = [np.uint32(int(abs(np.sin(i + 1)) * 2**32)) for i in range(64)]
#: Messages whose rounds stay in a core's cache, and the longest message of one MD5 block.
MD5_ROWS, MD5_BYTES = 4096, 55


def _md5_first(words: np.ndarray) -> np.ndarray:
    """The first little-endian word of the MD5 digests of one-block messages, given as 16 rows of words."""
    a, b, c, d = (np.full(words.shape[1], v, np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    f, turned = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            at = i
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            at = (5 * i + 1) % 16
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            at = (3 * i + 5) % 16
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            at = 7 * i % 16
        f += a
        f += words[at]
        f += _MD5_SINES[i]
        np.right_shift(f, np.uint32(32 - _MD5_SHIFTS[i]), out=turned)
        f <<= np.uint32(_MD5_SHIFTS[i])
        f |= turned
        f += b
        a, d, c, b, f = d, c, b, f, a
    return a + np.uint32(0x67452301)


class Md5Units:
    """unit() of many keys under many prefixes, the keys padded once for each length of prefix."""

    def __init__(self, codes: list[bytes]):
        self.codes = codes
        self.sizes = np.array([len(c) for c in codes], np.int64)
        self.padded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _words(self, room: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of one-block messages after a prefix of room bytes, and which rows they are."""
        if room not in self.padded:
            short = np.flatnonzero(self.sizes + room <= MD5_BYTES)
            gap = b"\0" * room
            raw = b"".join([(gap + self.codes[i] + b"\x80").ljust(56, b"\0") + ((room + len(self.codes[i])) * 8).to_bytes(8, "little") for i in short])
            self.padded = {room: (np.ascontiguousarray(np.frombuffer(raw, "<u4").reshape(len(short), 16).T), short)}
        return self.padded[room]

    def __call__(self, prefix: bytes) -> np.ndarray:
        """The first four bytes of md5(prefix + key) as a share of 2**32, for every key."""
        words, short = self._words(len(prefix))
        first = np.empty(len(self.codes), np.uint32)
        start = np.frombuffer(prefix.ljust(64, b"\0"), "<u4").astype(np.uint32)
        made = np.empty(len(short), np.uint32)
        for i in range(0, len(short), MD5_ROWS):
            made[i : i + MD5_ROWS] = _md5_first(words[:, i : i + MD5_ROWS] | start[:, None])
        first[short] = made.byteswap()
        for i in np.flatnonzero(self.sizes + len(prefix) > MD5_BYTES):
            first[i] = int.from_bytes(md5(prefix + self.codes[i]).digest()[:4], "big")
        return first / 4294967296.0
