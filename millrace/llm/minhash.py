"""Near-dedup by improved consistent weighted sampling over TF-IDF shingles, banded and verified."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import LOWEST, components, id_of, map_batches, stored, text_of
from millrace.llm.textnum import mix, shingles_of, slices, words_of

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 12, 3
#: Words in fewer than one of so many documents share one weight, so that the table of the others is bounded:
#: it has at most so many times the mean number of distinct words of a document.
RARE = 4096
#: Members of a pivot compared by one task, and members of a block, also at most so many bytes of text.
MEMBERS, BLOCK, BLOCK_BYTES = 256, 256, 4 << 20
#: Texts are compared if so many of the 36 samples agree: at 0.8 fewer do in one pair of 40,000.
AGREEING = 18
#: Word counts a worker holds before it passes them on.
HELD = 1 << 20


@dataclass
class WordWeights:
    """Inverse document frequencies of the frequent words, by sorted hash, and the one weight of all others."""

    words: np.ndarray
    weights: np.ndarray
    rest: float

    def of(self, words: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(words), self.rest)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, self.weights[at], self.rest)


def word_weights(texts: DataFrame) -> WordWeights:
    """ln((1 + rows) / (1 + df)) + 1 over all rows of (text), where df counts as one in RARE documents at least."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = size = 0

        def folded() -> tuple[np.ndarray, np.ndarray]:
            kinds, back = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return kinds, np.bincount(back, weights=np.concatenate([h[1] for h in held])).astype(np.int64)

        def out(kinds: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(kinds.view(np.int64)), "n": pa.array(n), "rows": pa.nulls(len(n), pa.int64())})

        for batch in batches:
            rows += batch.num_rows
            for _, part in slices(batch.column(0)):
                words, counts = words_of(part)
                owner = np.repeat(np.arange(len(part), dtype=np.uint64), counts)
                once = np.unique(mix(words + owner * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
                kinds, n = np.unique(words[once], return_counts=True)
                held.append((kinds, n))
                size += len(kinds)
                if size > 2 * HELD:
                    held[:] = [folded()]
                    size = len(held[0][0])
                    if size > HELD:
                        yield out(*held.pop())
                        size = 0
        if held:
            yield out(*folded())
        if rows:
            yield pa.RecordBatch.from_pydict({"word": pa.array([None], pa.int64()), "n": pa.array([0]), "rows": pa.array([rows])})

    counts = stored(texts.mapInArrow(count, "word bigint, n bigint, rows bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows")))
    rows = counts.agg(F.sum("rows")).first()[0] or 0
    found = counts.where(F.col("word").isNotNull() & (F.col("n") * RARE > rows)).select("word", "n").toArrow()
    words = found.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    weights = np.log((1 + rows) / (1 + found.column("n").to_numpy()[order])) + 1
    return WordWeights(words[order], weights, float(np.log((1 + rows) / (1 + rows / RARE)) + 1))


def weigh(words: np.ndarray, idf: WordWeights) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of one text, sorted, and their weights: count times the mean IDF of the words."""
    found = shingles_of(words, SHINGLE)
    if not len(found):
        return found, np.zeros(0)
    size = min(SHINGLE, len(words))
    total = np.cumsum(np.concatenate([[0.0], idf.of(words)]))
    mean = (total[size:] - total[:-size]) / size
    kinds, first, counts = np.unique(found, return_index=True, return_counts=True)
    # Rounded, so that the place of a shingle in its text cannot leave a trace in its weight.
    return kinds, np.round(mean[first], 4) * counts


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two weighted shingle sets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    return float(both / (a[1].sum() + b[1].sum() - both))


def likenesses(sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Weighted Jaccard similarities of all pairs of different members of a block, as products of matrices; the diagonal means nothing.

    The smaller of two weights of a shingle is the sum of the steps between its distinct weights that both reach.
    """
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s[0]) for s in sets])
    kinds, weights = np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets])
    order = np.lexsort((weights, kinds))
    owner, kinds, weights = owner[order], kinds[order], weights[order]
    both, below = np.zeros((n, n)), np.zeros(len(kinds))
    while len(kinds):
        # One step of every shingle: what is left of its least weight, shared by all that have it.
        first = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1]]))
        held = np.diff(np.append(first, len(kinds)))
        step = weights[first] - below[first]
        column = np.repeat(np.arange(len(first)), held)
        shared = np.flatnonzero(held > 1)
        place = np.full(len(first), -1)
        place[shared] = np.arange(len(shared))
        at = place[column]
        for low in range(0, len(shared), 4096):
            inside = (at >= low) & (at < low + 4096)
            part = np.zeros((n, min(4096, len(shared) - low)))
            part[owner[inside], at[inside] - low] = 1.0
            both += (part * step[shared[low : low + 4096]]) @ part.T
        least = np.repeat(weights[first], held)
        more = weights > least
        owner, kinds, weights, below = owner[more], kinds[more], weights[more], least[more]
    sums = np.array([s[1].sum() for s in sets])
    return both / (sums[:, None] + sums[None, :] - both)


@lru_cache(maxsize=None)
def _gamma_two() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at 65,536 midpoints."""
    p = (np.arange(65536) + 0.5) / 65536
    low, high = np.zeros(65536), np.full(65536, 40.0)
    for _ in range(60):
        middle = (low + high) / 2
        less = 1 - (1 + middle) * np.exp(-middle) < p
        low, high = np.where(less, middle, low), np.where(less, high, middle)
    return ((low + high) / 2).astype(np.float32)


@lru_cache(maxsize=None)
def _log_gamma_two() -> np.ndarray:
    return np.log(_gamma_two())


def consistent_samples(kinds: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """n consistent weighted samples of one set: two sets agree in a sample as often as their weighted Jaccard."""
    seeds = mix(np.arange(n, dtype=np.uint64), 99)[:, None]
    best, out = np.full(n, np.inf, np.float32), np.zeros(n, np.uint64)
    for at in range(0, len(kinds), 4096):
        k = kinds[at : at + 4096]
        log_weight = np.log(weights[at : at + 4096]).astype(np.float32)
        x = (k[None, :] ^ seeds) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        r = _gamma_two()[(x & np.uint64(0xFFFF)).astype(np.int32)]
        c = _log_gamma_two()[((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int32)]
        beta = (x >> np.uint64(40)).astype(np.float32) * np.float32(2.0**-24)
        t = np.floor(log_weight[None, :] / r + beta)
        value = c - r * (t - beta + np.float32(1.0))
        where = value.argmin(axis=1)
        rows = np.arange(n)
        low = value[rows, where]
        sample = mix(k[where] + t[rows, where].astype(np.int64).astype(np.uint64))
        out = np.where(low < best, sample, out)
        best = np.minimum(low, best)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    h = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + samples.reshape(BANDS, ROWS)[:, j])
    return h.astype(np.int64)


def sketch(rows: DataFrame, idf: WordWeights) -> DataFrame:
    """(id, mark, h, g, bands, samples) of rows (id, mark, text): hashes of the word sequence, band keys, 16 bits a sample; none without words."""
    sent = rows.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch.column(2)):
                h, g, bands, short = [], [], [], []
                words, counts = words_of(texts)
                for one in np.split(words, np.cumsum(counts)[:-1]):
                    place = np.arange(1, len(one) + 1, dtype=np.uint64)
                    h.append(int(mix(one + place * np.uint64(0x9E3779B97F4A7C15)).sum().astype(np.int64)))
                    g.append(int((mix(one, 3) * (place * np.uint64(2) + np.uint64(1))).sum().astype(np.int64)))
                    found = consistent_samples(*weigh(one, sent.value), BANDS * ROWS) if len(one) else None
                    bands.append([] if found is None else band_keys(found).tolist())
                    short.append(b"" if found is None else found.astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(texts)),
                        batch.column(1).slice(start, len(texts)),
                        pa.array(h, pa.int64()),
                        pa.array(g, pa.int64()),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(short, pa.binary()),
                    ],
                    names=["id", "mark", "h", "g", "bands", "samples"],
                )

    return rows.mapInArrow(run, "id bigint, mark bigint, h bigint, g bigint, bands array<bigint>, samples binary")


def verify(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity is at least `least`; texts has (id, text).

    The members a of a pivot b are dealt to groups of MEMBERS, each with the pivot's text in front, and a
    task walks through its sorted groups: a pivot with very many members is many groups.
    """
    sent = texts.sparkSession.sparkContext.broadcast(idf)
    groups = stored(pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).alias("groups")))
    members = pairs.join(groups, "b").select(
        F.col("a").alias("id"), "b", F.pmod(F.xxhash64("a"), "groups").alias("salt"), F.lit(1).alias("role")
    )
    heads = groups.select(
        F.col("b").alias("id"), "b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)).alias("salt"), F.lit(0).alias("role")
    )
    dealt = members.unionByName(heads).join(texts, "id").select("b", "salt", "role", "id", "text")
    dealt = dealt.repartition("b", "salt").sortWithinPartitions("b", "salt", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heads = None, []
        for batch in batches:
            b, salt, role, ids = (batch.column(i).to_pylist() for i in range(4))
            found = []
            for start, texts in slices(batch.column(4)):
                words, counts = words_of(texts)
                for i, one in enumerate(np.split(words, np.cumsum(counts)[:-1]), start):
                    if now != (b[i], salt[i]):
                        now, heads = (b[i], salt[i]), []
                    own = weigh(one, sent.value)
                    if not len(own[0]):
                        continue
                    if role[i] == 0:
                        heads.append(own)
                    elif any(likeness(own, head) >= least - 1e-12 for head in heads):
                        found.append((ids[i], b[i]))
            if found:
                a, p = zip(*found)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(p, pa.int64())})

    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def over_blocks(rows: DataFrame, fn: Callable[[pa.Table], pa.Table | None], schema: str) -> DataFrame:
    """fn over the rows of each (key, i, j) of rows that begin with these columns; a task walks through its sorted groups.

    A group is two blocks at most, so that what a task holds is bounded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None

        def done() -> Iterator[pa.RecordBatch]:
            made = fn(pa.Table.from_batches(held)) if held else None
            held.clear()
            if made is not None and made.num_rows:
                yield from made.combine_chunks().to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in range(3)]
            edges = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for start, end in zip([0, *edges], [*edges, batch.num_rows]):
                group = tuple(c[start] for c in columns)
                if group != last:
                    yield from done()
                    last = group
                held.append(batch.slice(start, end - start))
        yield from done()

    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(run, schema)


def _may_compare(table: pa.Table) -> np.ndarray:
    """Pairs to be compared: not both next to the pivot, and of two blocks one member of each."""
    home, block = table.column("home").to_numpy(), table.column("block").to_numpy()
    may = ~(home[:, None] & home[None, :])
    if table.column("i")[0] != table.column("j")[0]:
        may &= block[:, None] != block[None, :]
    np.fill_diagonal(may, False)
    return may


def agreeing(table: pa.Table) -> pa.Table | None:
    """The members of a group whose samples agree with those of another to be compared."""
    samples = np.frombuffer(b"".join(table.column("samples").to_pylist()), "<u2").reshape(table.num_rows, -1)
    same = np.zeros((len(samples), len(samples)), np.uint8)
    for column in samples.T:
        same += column[:, None] == column[None, :]
    met = ((same >= AGREEING) & _may_compare(table)).any(axis=1)
    return table.filter(pa.array(met)).drop_columns(["samples"]) if met.any() else None


def linked_members(table: pa.Table, idf: WordWeights, least: float) -> pa.Table | None:
    """(a, b): every member of a group that is linked with another, next to the smallest it reaches inside the group."""
    sets = []
    for _, texts in slices(table.column("text").combine_chunks()):
        words, counts = words_of(texts)
        sets += [weigh(one, idf) for one in np.split(words, np.cumsum(counts)[:-1])]
    near = (likenesses(sets) >= least - 1e-12) & _may_compare(table)
    rep = table.column("rep").to_numpy()
    tags = rep.copy()
    while True:
        lower = np.minimum(tags, np.where(near, tags[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (lower == tags).all():
            break
        tags = lower
    far = tags != rep
    return pa.table({"a": rep[far], "b": tags[far]}) if far.any() else None


def compare_rest(buckets: DataFrame, star: DataFrame, classes: DataFrame, texts: DataFrame, idf: WordWeights, least: float) -> DataFrame:
    """Links (a, b) of the pairs of a bucket that are not both linked with its pivot.

    buckets has (key, rep, pivot), star the links with pivots found so far. Members not linked with the pivot meet
    each other and the rest, block by block: a crowded bucket is many pairs of blocks, each compared inside a task.
    First by their samples; the texts of those that agree are sent to the same blocks, and links leave a task as a forest.
    """
    linked = star.select(F.col("a").alias("rep"), F.col("b").alias("pivot")).unionByName(star.select(F.col("b").alias("rep"), F.col("a").alias("pivot")))
    around = buckets.join(linked.distinct().withColumn("near", F.lit(True)), ["rep", "pivot"], "left")
    around = around.select("key", "rep", (F.coalesce("near", F.lit(False)) | (F.col("rep") == F.col("pivot"))).alias("home"))
    around = stored(around.join(texts.select(F.col("id").alias("rep"), F.octet_length("text").alias("bytes")), "rep"))
    part = lambda home: [
        F.coalesce(F.count(F.when(F.col("home") == home, 1)), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("home") == home, F.col("bytes"))), F.lit(0)),
    ]
    blocks = lambda rows, size: F.greatest(F.ceil(rows / BLOCK), F.ceil(size / BLOCK_BYTES), F.lit(1)).cast("int")
    (rest, rest_bytes), (near, near_bytes) = part(False), part(True)
    sizes = around.groupBy("key").agg(rest.alias("rest"), rest_bytes.alias("rb"), near.alias("near"), near_bytes.alias("nb"))
    # The only pair of a bucket of two was compared with the pivot.
    sizes = sizes.where("rest > 0 and rest + near > 2").select(
        "key",
        ((F.col("rest") + F.col("near") <= BLOCK) & (F.col("rb") + F.col("nb") <= BLOCK_BYTES)).alias("one"),
        blocks(F.col("rest"), F.col("rb")).alias("o"),
        blocks(F.col("near"), F.col("nb")).alias("m"),
    )
    placed = around.join(stored(sizes), "key")
    dealt = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    placed = placed.withColumn("block", F.when(F.col("one"), 0).when(F.col("home"), F.col("o") + dealt("m")).otherwise(dealt("o")))
    others = F.when(F.col("one"), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.when(F.col("home"), F.col("o")).otherwise(F.col("o") + F.col("m")) - 1))
    placed = placed.select("key", "rep", "home", "block", F.explode(others).alias("other"))
    placed = placed.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "home", "block")
    kinds = "key bigint, i int, j int, rep bigint, home boolean, block int"
    met = stored(over_blocks(placed.join(classes.select("rep", "samples"), "rep").select(*placed.columns, "samples"), agreeing, kinds))
    sent = texts.sparkSession.sparkContext.broadcast(idf)
    whole = met.join(texts.withColumnRenamed("id", "rep"), "rep").select(*placed.columns, "text")
    return over_blocks(whole, lambda table: linked_members(table, sent.value, least), "a bigint, b bigint").distinct()


def _linked(docs: DataFrame, similarity: float) -> DataFrame:
    """(id, mark, node, class_id, component_id, kept) of every row of docs, with ids of id_of() and a hash of the text.

    Rows with the same word sequence share a node of 0 or above; a row without a word has a negative node of
    its own. kept: the row's id and word sequence are the smallest of its component.
    """
    rows = docs.select(id_of().alias("id"), text_of().alias("text")).select("id", F.xxhash64("text").alias("mark"), "text")
    idf = word_weights(rows.select("text"))
    sketches = stored(sketch(rows, idf))
    classes = sketches.where(F.size("bands") > 0).groupBy("h", "g")
    classes = classes.agg(F.min(F.struct("id", "mark")).alias("first"), F.first("bands").alias("bands"), F.first("samples").alias("samples"))
    # Written down at once, so that the numbers stay.
    classes = stored(classes.select("h", "g", "first", "bands", "samples", F.monotonically_increasing_id().alias("rep")))
    classed = sketches.select("id", "mark", "h", "g").join(classes.select("h", "g", "rep"), ["h", "g"], "left")
    classed = stored(classed.select("id", "mark", F.coalesce("rep", -1 - F.monotonically_increasing_id()).alias("node")))
    buckets = classes.select("rep", F.explode("bands").alias("key")).distinct()
    shared = stored(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    # A class has one row per band at most, so that this window is small.
    met = F.sum("n").over(Window.partitionBy("rep"))
    buckets = stored(buckets.join(shared, "key").select("rep", "key", met.alias("met")))
    pivots = stored(buckets.groupBy("key").agg(F.max_by("rep", F.struct("met", F.bitwise_not("rep"))).alias("pivot")))
    buckets = stored(buckets.select("rep", "key").join(pivots, "key"))
    candidates = classes.join(buckets.select("rep").distinct(), "rep", "left_semi").select("first.id", "first.mark", "rep")
    texts = stored(rows.join(candidates, ["id", "mark"]).select(F.col("rep").alias("id"), "text").dropDuplicates(["id"]))
    star = buckets.where("rep <> pivot").groupBy(F.greatest("rep", "pivot").alias("hi"), F.least("rep", "pivot").alias("lo"))
    star = star.agg(F.max("pivot").alias("b")).select(F.when(F.col("b") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("a"), "b")
    near = stored(verify(stored(star), texts, idf, similarity))
    rest = compare_rest(buckets, near, classes, texts, idf, similarity)
    found = components(stored(near.unionByName(rest)))
    names = stored(classes.select("rep", F.struct(F.col("first.id").alias("id"), "h", "g", "rep").alias("name")))
    # A component goes by its smallest (id, word sequence), whatever the numbers of its nodes.
    found = stored(names.join(found.withColumnRenamed("node", "rep"), "rep"))
    tops = stored(found.groupBy("component").agg(F.min("name").alias("top")))
    found = stored(found.join(tops, "component").select("rep", "top"))
    named = names.join(found, "rep", "left").select(
        F.col("rep").alias("node"), F.col("name.id").alias("class_id"), F.coalesce("top", "name").alias("top")
    )
    whole = classed.join(stored(named), "node", "left")
    return whole.select(
        "id",
        "mark",
        "node",
        F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("top.id", "id").alias("component_id"),
        (F.col("top").isNull() | (F.col("top.id") == F.col("id")) & (F.col("top.rep") == F.col("node"))).alias("kept"),
    )


def _numbered(linked: DataFrame, *others: str) -> DataFrame:
    out = lambda c: F.when(F.col(c) != LOWEST, F.col(c))
    return linked.select(out("id").alias("doc_id"), out("class_id").alias("class_id"), out("component_id").alias("component_id"), *others)


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, component_id) of every row of docs.

    class_id is the smallest doc_id with the same word sequence, component_id the smallest one reachable over
    links between texts of weighted Jaccard similarity >= `similarity`. A shingle is five words (a shorter
    text is one shingle); its weight is its count times the mean IDF of its words, over all rows. Null and
    empty texts, and texts without a word, are linked with nothing. Only texts link rows: rows of one doc_id,
    or of no doc_id, with other words are other documents. A null id comes before all others, and comes back
    as null. Other columns are passed over.

    Equal texts are folded first. In a bucket of equal band keys every member is compared with a pivot, the
    member that meets most others over all its buckets. Members not linked with the pivot are then compared with
    all of the bucket, in blocks inside tasks, so that no pair that matters is left untested and the number of jobs
    is the same for any bucket. Nothing of a document but its numbers passes the driver.
    """
    return _numbered(_linked(docs, similarity))


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs without near duplicates: of each component a row of its smallest doc_id and word sequence stays.

    Several rows of that doc_id and word sequence are one document, of which one row stays. Rows without a word all stay.
    """
    linked = _linked(docs.select("doc_id", "text"), similarity).where("kept")
    kept = linked.groupBy("id", "node").agg(F.min("mark").alias("mark"))
    kept = stored(kept.select("id", "mark", (F.col("node") >= 0).alias("once")).distinct())
    names, key = docs.columns, ["id", "mark"]
    # Input columns stay inside a struct, so that none can clash.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), id_of().alias("id"), text_of().alias("text"))
    rows = rows.withColumn("mark", F.xxhash64("text"))
    repeated = rows.select(*key).join(kept.where("once").select(*key), key, "left_semi")
    repeated = stored(repeated.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key))
    single = rows.join(kept.select(*key), key, "left_semi").join(repeated, key, "left_anti").select("row")
    least = rows.join(repeated, key, "left_semi").groupBy(*key).agg(F.min_by("row", "text").alias("row")).select("row")
    return single.unionByName(least).select(*[F.col("row")[c].alias(c) for c in names])


def query(documents: DataFrame) -> DataFrame:
    return _numbered(_linked(documents, SIMILARITY), "kept")
