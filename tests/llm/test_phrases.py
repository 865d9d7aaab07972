"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from millrace.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mined(rows, least, first=2000, share=80):
    counts, out = {}, []
    for lang, text in rows:
        f = counts.setdefault(lang or "und", Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]", piece) if w]
            for size in range(1, 5):
                f.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in candidates.items():
            inside = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= share * a for b in inside):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def corpus(seed=1, docs=120):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(12)] + ["É", "日本", "A", "a\xa0b", "x\x1cy", "don't"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(0, 60)):
            parts.append(rng.choice(["new york city", "New  York", "one two three four", "r" + str(rng.randrange(500))] + common))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "!? ", "\n", "\r\n", " ; "]))
        rows.append((i, rng.choice(["en", "fr", None, "und"]), "".join(parts), 1, "z"))
    return rows + [(None, "en", None, 1, None), (3, "en", "", 1, None), (4, "fr", "one two three four " * 50, 1, None), (4, "fr", "one two three four " * 50, 1, None), (5, "xx", " .,\n", 1, None)]


SCHEMA = "doc_id bigint, lang string, text string, f bigint, `w1.n` string"


def found(frame, **settings):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in phrases.mine_phrases(frame, **settings).collect())


@pytest.mark.parametrize("seed, least", [(1, 3), (2, 5)])
def test_phrases(spark, seed, least):
    rows = corpus(seed)
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(4), least=least)
    assert got == mined([(r[1], r[2]) for r in rows], least) and len(got) > 20


def test_first_and_share(spark):
    rows = corpus(7, 60)
    got = found(spark.createDataFrame(rows, SCHEMA), least=2, first=5, share=50)
    assert got == mined([(r[1], r[2]) for r in rows], 2, 5, 50)


def test_heavy_pairs_filters_and_chunks_change_nothing(spark, monkeypatch):
    # A filter of 64 bits lets nearly all through, every pair is heavy, chunks end within tables.
    for name, value in (("FILTER_BITS", 64), ("HEAVY_BITS", 1 << 10), ("HEAVY", 3), ("ROUTED", 50), ("CHUNK", 40), ("VOCABULARY", 30)):
        monkeypatch.setattr(phrases, name, value)
    rows = corpus(3, 60)
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(3), least=4)
    assert got == mined([(r[1], r[2]) for r in rows], 4)


def test_nothing_to_find(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(empty) == [] and phrases.mine_phrases(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert found(spark.createDataFrame([(1, "en", "a b c", 1, None), (2, None, None, 1, None)], SCHEMA)) == []


def test_quicksort_partitions():
    rng = np.random.default_rng(2)
    for least in (1, 4):
        keys = [rng.integers(0, 3, 200), *(rng.integers(-1, 4, 200) for _ in range(3))]
        for k in (2, 3):
            keys[k] = np.where(keys[k - 1] < 0, -1, keys[k])
        n = rng.integers(1, 3, 200)
        counts = Counter()
        for row, c in zip(zip(*keys), n):
            for depth in range(2, 5):
                if min(row[:depth]) >= 0:
                    counts[tuple(map(int, row[:depth]))] += int(c)
        got = phrases.equal_partitions(keys, n, least, 2)
        assert {tuple(int(k[i]) for k in keys[:d]): f for i, d, f in got} == {p: f for p, f in counts.items() if f >= least}
