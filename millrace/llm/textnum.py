"""Texts as code point arrays: words, n-grams and their hashes for whole batches at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_ODD = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_ODD, -1, 2**64)


@lru_cache(maxsize=None)
def space_table() -> np.ndarray:
    """Per code point: white space."""
    return np.fromiter((chr(i).isspace() for i in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=None)
def word_table() -> np.ndarray:
    """Per code point: letter, digit or underscore."""
    table = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
    table[ord("_")] = True
    return table


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h + np.uint64((salt * _ODD + 0x632BE59BD9B4E019) % 2**64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: Powers are kept for texts of this length; longer ones have theirs for as long as they are read.
_KEPT = 1 << 17


def _raised(size: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_ODD, _INVERSE):
        row = np.full(size, base, dtype=np.uint64)
        row[0] = 1
        made.append(np.multiply.accumulate(row))
    return made[0], made[1]


_kept_powers = lru_cache(maxsize=1)(_raised)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    return _kept_powers(_KEPT) if n <= _KEPT else _raised(n)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def join_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points with a space before, between and after the texts, and the end of each text's part."""
    joined = " " + " ".join(texts) + " "
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return code_points(joined), np.cumsum(sizes) + 1


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of True; the first and last entries must be False."""
    step = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    return step[0::2], step[1::2]


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the code points of each span."""
    power, inverse = _powers(len(points) + 1)
    total = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power[: len(points)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


#: Characters, or bytes, of the texts that are turned into arrays together: these take some 50 bytes a character.
TOGETHER = 100_000


def chunks(texts: list[str], limit: int = TOGETHER) -> Iterator[tuple[int, int]]:
    """Consecutive slices of the list of at most that many characters, or one longer text."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def slices(column: pa.Array, limit: int = TOGETHER) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of an Arrow column, of at most that many bytes or one longer text, and where they start; null stays None."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > limit:
            yield start, column.slice(start, i - start).to_pylist()
            start, size = i, 0
        size += n
    if sizes:
        yield start, column.slice(start).to_pylist()


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words of all texts, and how many words each text has."""
    points, edges = join_texts([t.lower() for t in texts]) if texts else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
    if not len(edges):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts, ends = spans(word_table()[points])
    counts = np.diff(np.searchsorted(starts, edges, side="left"), prepend=0)
    return span_hashes(points, starts, ends), counts


def shingles_of(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of the runs of `size` words of one text; a shorter text is one run, an empty one none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < size:
        size = len(words)
    n = len(words) - size + 1
    h = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        h = h * np.uint64(_ODD) + words[i : i + n]
    return mix(h, size)
