"""Phrase collocations: suffix pointers routed by leading words, counted by multikey three-way quicksort."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import stored, text_of

LEAST, LONGEST, FIRST, SHARE = 30, 4, 2000, 80
#: Words a worker gathers per language before it folds equal windows, and words it numbers before it starts anew.
CHUNK, VOCABULARY = 1 << 21, 1 << 20
#: Windows aimed at per routed partition, and from how many on a leading pair is spread over all of them.
ROUTED, HEAVY = 1 << 20, 1 << 15
#: Bits of a filter of frequent phrases: fixed, so that what is sent to tasks does not grow.
FILTER_BITS, HEAVY_BITS = 1 << 24, 1 << 20

#: Words and ends of pieces in UTF-8: all separators are single bytes that occur nowhere else.
_TOKENS = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r][ \t.,;:!?\n-\r]*")
_BREAKS = frozenset(b".,;:!?\n\x0b\x0c\r")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Numbers(dict):
    """A number for every word met; -1 for what ends a piece."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, token: bytes) -> int:
        if token[0] in _BREAKS:
            if len(token) <= 4:
                self[token] = -1
            return -1
        self.words.append(token)
        self[token] = len(self.words) - 1
        return len(self.words) - 1


def read_numbers(numbers: Numbers, text: bytes) -> Iterator[np.ndarray]:
    """The words of a text as numbers, a break at the end."""
    text = text.translate(_LOWER)
    found = iter(_TOKENS.findall(text)) if len(text) <= 1 << 22 else (m.group() for m in _TOKENS.finditer(text))
    while block := list(islice(found, CHUNK)):
        yield np.fromiter(map(numbers.__getitem__, block), np.int32, len(block))
    yield np.full(1, -1, np.int32)


def over_chunks(docs: DataFrame, fold: Callable[[str, list[bytes], np.ndarray], pa.RecordBatch | None], schema: str) -> DataFrame:
    """fold(lang, words by number, numbers) over chunks of whole documents of one language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, waiting, sizes = Numbers(), {}, {}

        def folded(lang: str) -> Iterator[pa.RecordBatch]:
            made = fold(lang, numbers.words, np.concatenate(waiting.pop(lang)))
            del sizes[lang]
            if made is not None and made.num_rows:
                yield made

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                lang = lang.as_py()
                parts = list(read_numbers(numbers, text.as_py()))
                waiting.setdefault(lang, []).extend(parts)
                sizes[lang] = sizes.get(lang, 0) + sum(map(len, parts))
                if sizes[lang] >= CHUNK:
                    yield from folded(lang)
                if len(numbers.words) >= VOCABULARY or sum(sizes.values()) >= 4 * CHUNK:
                    for late in list(waiting):
                        yield from folded(late)
                    numbers = Numbers()
        for late in list(waiting):
            yield from folded(late)

    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text_of().cast("binary").alias("text")).mapInArrow(run, schema)


class PhraseFilter:
    """Tells phrases that are surely not frequent. False alarms cost work only: counts decide later.

    The key of a phrase is made of those of its words: turned by one bit a word, then added bit by bit.
    """

    def __init__(self, phrases: DataFrame, bits: int):
        step = bits.bit_length() - 1
        turned = lambda h: F.shiftleft(h, 1).bitwiseXOR(F.shiftrightunsigned(h, 63))
        key = F.aggregate(F.split("phrase", " "), F.lit(0).cast("bigint"), lambda h, w: turned(h).bitwiseXOR(F.xxhash64(F.concat_ws(" ", "lang", w))))
        keyed = phrases.select(key.alias("k"))
        places = keyed.select(F.explode(F.array(F.col("k").bitwiseAND(bits - 1), F.shiftrightunsigned("k", step).bitwiseAND(bits - 1))).alias("p"))
        cells = places.groupBy(F.shiftright("p", 6).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("mask")).toArrow()
        self.cells = np.zeros(bits // 64, np.int64)
        self.cells[cells.column("cell").to_numpy()] = cells.column("mask").to_numpy()
        self.bits, self.step = bits, np.uint64(step)

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        held = np.ones(len(keys), bool)
        for places in (keys, keys >> self.step):
            places = (places & np.uint64(self.bits - 1)).astype(np.int64)
            held &= (self.cells[places >> 6] >> (places & 63)) & 1 == 1
        return held


def word_keys(lang: str, words: list[bytes], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the words met, and the key of every word by number (0 of the others)."""
    met = np.flatnonzero(np.bincount(numbers[numbers >= 0], minlength=len(words)))
    start, keys = f"{lang} ".encode(), np.zeros(len(words), np.uint64)
    keys[met] = np.fromiter((xxhash.xxh64_intdigest(start + words[i], 42) for i in met), np.uint64, len(met))
    return met, keys


def pair_keys(keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    first, second = keys[pairs >> 32], keys[pairs & 0xFFFFFFFF]
    return first << np.uint64(1) ^ first >> np.uint64(63) ^ second


def _joined(words: list[bytes], *numbers: np.ndarray) -> pa.Array:
    kept, back = np.unique(np.concatenate(numbers), return_inverse=True)
    table = pa.array([words[i] for i in kept], pa.binary()).cast(pa.string())
    parts = [table.take(pa.array(part)) for part in np.split(back, len(numbers))]
    return pc.binary_join_element_wise(*parts, " ") if len(parts) > 1 else parts[0]


def _rows(lang: str, **columns: pa.Array) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_pydict({"lang": pa.array([lang]).take(pa.array(np.zeros(n, np.int64))), **columns})


def _pairs(held: PhraseFilter, met: np.ndarray, keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where two words that may be frequent follow each other, and the pairs as one number."""
    may = np.zeros(len(keys) + 1, bool)
    may[met] = held.may_hold(keys[met])
    frequent = may[numbers]
    at = np.flatnonzero(frequent[:-1] & frequent[1:])
    return at, numbers[at].astype(np.int64) << 32 | numbers[at + 1]


def count_words(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f) of words found `least` times, and of every language's words in all under a null phrase."""

    def fold(lang: str, words: list[bytes], numbers: np.ndarray) -> pa.RecordBatch:
        counts = np.bincount(numbers[numbers >= 0], minlength=1)
        met = np.flatnonzero(counts)
        phrase = pa.array([*(words[i] for i in met), None], pa.binary()).cast(pa.string())
        return _rows(lang, phrase=phrase, f=pa.array(np.append(counts[met], counts.sum())))

    rows = over_chunks(docs, fold, "lang string, phrase string, f bigint")
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | F.col("phrase").isNull())


def count_pairs(docs: DataFrame, words: PhraseFilter, least: int = LEAST) -> DataFrame:
    """(lang, phrase, f) of leading pairs found `least` times: where suffixes go, and which are given up before they move."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def fold(lang: str, words: list[bytes], numbers: np.ndarray) -> pa.RecordBatch | None:
        pairs, counts = np.unique(_pairs(sent.value, *word_keys(lang, words, numbers), numbers)[1], return_counts=True)
        if not len(pairs):
            return None
        return _rows(lang, phrase=_joined(words, pairs >> 32, pairs & 0xFFFFFFFF), f=pa.array(counts))

    rows = over_chunks(docs, fold, "lang string, phrase string, f bigint")
    return rows.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def suffix_windows(docs: DataFrame, words: PhraseFilter, pairs: PhraseFilter, heavy: PhraseFilter) -> DataFrame:
    """(lang, w1 .. w4, heavy, n): beginnings of suffixes, cut before a pair that is surely not frequent, equal ones of a chunk as one."""
    sent = docs.sparkSession.sparkContext.broadcast((words, pairs, heavy))

    def fold(lang: str, names: list[bytes], numbers: np.ndarray) -> pa.RecordBatch | None:
        words, pairs, heavy = sent.value
        met, keys = word_keys(lang, names, numbers)
        at, found = _pairs(words, met, keys, numbers)
        found = pair_keys(keys, found)
        kept = pairs.may_hold(found)
        at, found = at[kept], found[kept]
        if not len(at):
            return None
        crowded = heavy.may_hold(found)
        starts = np.zeros(len(numbers) + LONGEST, bool)
        starts[at] = True
        padded = np.concatenate([numbers, np.full(LONGEST, -1, numbers.dtype)])
        third = np.where(starts[at + 1], padded[at + 2], -1)
        fourth = np.where((third >= 0) & starts[at + 2], padded[at + 3], -1)
        low = (third.astype(np.int64) + 1) << 32 | (fourth.astype(np.int64) + 1)
        high = padded[at].astype(np.int64) << 32 | padded[at + 1]
        order = np.lexsort((low, high))
        low, high, crowded = low[order], high[order], crowded[order]
        edge = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
        n = np.diff(np.append(edge, len(order)))
        low, high = low[edge], high[edge]
        places = [high >> 32, high & 0xFFFFFFFF, (low >> 32) - 1, (low & 0xFFFFFFFF) - 1]
        met, back = np.unique(np.concatenate(places), return_inverse=True)
        table = pa.array([names[i] if i >= 0 else None for i in met], pa.binary()).cast(pa.string())
        columns = {f"w{k + 1}": table.take(pa.array(part)) for k, part in enumerate(np.split(back, LONGEST))}
        return _rows(lang, **columns, heavy=pa.array(crowded[edge]), n=pa.array(n))

    return over_chunks(docs, fold, "lang string, w1 string, w2 string, w3 string, w4 string, heavy boolean, n bigint")


def equal_partitions(keys: list[np.ndarray], n: np.ndarray, least: int, first: int) -> list[tuple[int, int, int]]:
    """(a pointer, depth, sum of n) of the partitions equal in their leading `first` or more keys; those below `least` are given up.

    Multikey three-way quicksort of the pointers 0 .. len(n) - 1: a partition is split at a pivot of its key into less,
    equal and more; the equal part goes on with the next key. A negative key ends a suffix.
    """
    found = []
    late = [(np.arange(len(n)), 0)] if len(n) else []
    while late:
        at, depth = late.pop()
        if n[at].sum() < least:
            continue
        key = keys[depth][at]
        pivot = key[len(key) // 2]
        same = key == pivot
        equal = at[same]
        if len(equal) < len(at):
            less = key < pivot
            late.append((at[less], depth))
            late.append((at[~(less | same)], depth))
        if pivot < 0 or not len(equal):
            continue
        total = int(n[equal].sum())
        if total >= least:
            if depth + 1 >= first:
                found.append((int(equal[0]), depth + 1, total))
            if depth + 1 < len(keys):
                late.append((equal, depth + 1))
    return found


_FOUND = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64())])


def count_phrases(windows: DataFrame, total: int, least: int = LEAST) -> DataFrame:
    """(lang, phrase, size, f) of phrases of two and more words found `least` times.

    Windows go to partitions by language and leading pair; those of a heavy pair by all their words, so that a pair
    that holds most windows is spread. A partition counts its pointers by quicksort and gives up what is infrequent;
    of heavy pairs it has a part only, so nothing is given up before the parts are added.
    """
    tasks = max(int(windows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // ROUTED))
    spread = F.when(F.col("heavy"), F.pmod(F.xxhash64("w3", "w4"), F.lit(tasks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows).combine_chunks()
        del rows
        coded = [table.column(c).combine_chunks().dictionary_encode() for c in ("lang", "w1", "w2", "w3", "w4")]
        keys = [c.indices.fill_null(-1).to_numpy() for c in coded]
        n, heavy = table.column("n").to_numpy(), table.column("heavy").to_numpy()
        names = [c.dictionary.to_pylist() for c in coded]
        for crowded in (False, True):
            part = np.flatnonzero(heavy == crowded)
            some = [k[part] for k in keys]
            found = equal_partitions(some, n[part], 1 if crowded else least, 3)
            for at in range(0, len(found), 10_000):
                block = found[at : at + 10_000]
                spelled = [" ".join(names[d][some[d][i]] for d in range(1, depth)) for i, depth, _ in block]
                langs = [names[0][some[0][i]] for i, _, _ in block]
                columns = [langs, spelled, [depth - 1 for _, depth, _ in block], [f for _, _, f in block]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _FOUND)], schema=_FOUND)

    routed = windows.repartition(tasks, "lang", "w1", "w2", spread).mapInArrow(run, "lang string, phrase string, size int, f bigint")
    return routed.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def weigh(words: DataFrame, phrases: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of phrases: the cut with the lowest floor(2000000 a / (l + r)), first of equals."""
    known = words.where("phrase is not null").select("lang", "phrase", "f").unionByName(phrases.select("lang", "phrase", "f"))
    cuts = phrases.select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("part", F.expr("substring_index(phrase, ' ', k)")).withColumn("rest", F.expr("substring_index(phrase, ' ', k - size)"))
    left = known.select("lang", F.col("phrase").alias("part"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "part"]).join(right, ["lang", "rest"])
    exact = F.expr("cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut")
    return scored.groupBy("lang", "phrase", "size", "a").agg(best).select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def inside_longer(phrases: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the highest count of a longer phrase that holds the phrase."""
    words = F.split("phrase", " ")
    starts = lambda size: F.sequence(F.lit(0), F.col("size") - size)
    part = lambda size: F.transform(starts(size), lambda i: F.array_join(F.slice(words, i + 1, size), " "))
    parts = F.when(F.col("size") == 3, part(2)).otherwise(F.concat(part(2), part(3)))
    return phrases.where("size > 2").select("lang", F.explode(parts).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def mine_phrases(docs: DataFrame, least: int = LEAST, first: int = FIRST, share: int = SHARE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `first` best phrases of two to four words of every language.

    Texts are lower-cased (A-Z) and cut into pieces and words; a null language is `und`, null and empty texts have
    no words, repeated rows count again, other columns are passed over. Phrases stand in one piece and are found
    `least` times; one inside a longer such phrase with at least `share` per cent of its count is left out. Ties go
    to the higher count, then to the phrase that comes first by bytes.

    Words are counted first, then pairs of frequent words. They route the suffixes: one moves only as far as its
    pairs may be frequent. Filters of fixed size tell that; an unsure answer costs work, since the sort counts exactly.
    """
    words = stored(count_words(docs, least))
    frequent = PhraseFilter(words.where("phrase is not null"), FILTER_BITS)
    pairs = stored(count_pairs(docs, frequent, least))
    total = pairs.agg(F.sum("f")).first()[0] or 0
    windows = suffix_windows(docs, frequent, PhraseFilter(pairs, FILTER_BITS), PhraseFilter(pairs.where(F.col("f") > HEAVY), HEAVY_BITS))
    phrases = stored(count_phrases(windows, total, least))
    rows = weigh(words, phrases).join(inside_longer(phrases), ["lang", "phrase"], "left")
    hundred = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * share
    rows = rows.where(~F.coalesce(hundred, F.lit(False)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of hash parts first: a language with most phrases is no single task.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= first)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    sums = words.where("phrase is null").select("lang", F.col("f").alias("n"))
    return rows.join(sums, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(documents: DataFrame) -> DataFrame:
    return mine_phrases(documents)


QUERY_SQL = """
WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM docs),
lists AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM lists, (SELECT unnest([1, 2, 3, 4]) AS k)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
sums AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
frequent AS (SELECT * FROM counts WHERE f >= 30),
candidates AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE k > 1),
cuts AS (
  SELECT lang, size, phrase, a, c, array_to_string(w[1:c], ' ') AS part, array_to_string(w[c + 1:size], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS c FROM candidates)),
scored AS (
  SELECT x.lang, x.size, x.phrase, x.a, x.c, p.f AS l, q.f AS r, (2000000::HUGEINT * x.a) // (p.f + q.f) AS score
  FROM cuts x JOIN frequent p ON p.lang = x.lang AND p.phrase = x.part JOIN frequent q ON q.lang = x.lang AND q.phrase = x.rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_parts AS (
  SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, size, m, unnest(range(1, size - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS m FROM candidates WHERE size > 2))),
longer AS (SELECT lang, phrase, max(a) AS top FROM inner_parts GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
  WHERE g.top IS NULL OR 100 * g.top < 80 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN sums USING (lang) WHERE rank <= 2000
"""
