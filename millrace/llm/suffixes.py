"""Removal of repeated byte strings by a distributed difference-cover suffix sort.

The order of suffixes is only needed where a string can repeat at all. Every window of `window` bytes names its
anchor, the position of the least hash of ANCHOR bytes in it; equal windows name equal anchors, so suffixes are
dealt to tasks by the anchor's bytes, and an anchor that occurs once rules out all its windows. The windows of
one anchor with equal surroundings are equal strings, of which one is sorted for all. Where an anchor has very many
surroundings, its windows are counted by their hash instead, so that no sort grows with them. What is left is sorted by
difference cover: triples at positions 1 and 2 modulo 3 get names, names of names follow until they span the
window, the positions 0 modulo 3 are merged in, and neighbours are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWEST, id_of, map_batches, released, sent_if_small, stored, text_of
from millrace.llm.textnum import _powers, mix

WINDOW, ANCHOR = 100, 40
#: Bytes sorted at once by a task, and the most surroundings of one anchor that are sorted.
SORT_BYTES, TOGETHER = 400_000, 1024
_LOW = np.uint64((1 << 24) - 1)


def _chunks(sizes: list[int], limit: int = 400_000):
    start = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if sizes:
        yield start, len(sizes)


def anchors_of(data: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Anchors of the documents that end at `ends`: (document, first and last window, anchor, its hash, surroundings' hash)."""
    k = min(ANCHOR, window)
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    n = len(data)
    if n < window:
        return none
    power, inverse = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    grams = mix((total[k:] - total[:-k]) * inverse[: n - k + 1])
    # The least of each run of windows: hash above, place below, so that the first of equal hashes wins.
    span, size = window - k + 1, 1
    bits = np.uint64(max(24, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if span > size:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    place = (least & low).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    room = np.zeros(n + 1, np.int64)
    whole = ends - starts >= window
    np.add.at(room, starts[whole], 1)
    np.add.at(room, ends[whole] - window + 1, -1)
    at = np.flatnonzero(np.cumsum(room)[: len(place)] > 0)
    if not len(at):
        return none
    doc, anchor = np.searchsorted(ends, at, side="right"), place[at]
    fresh = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
    first = np.flatnonzero(fresh)
    lo, hi = at[first], at[np.append(first[1:] - 1, len(at) - 1)]
    doc, anchor = doc[first], anchor[first]
    around = (total[hi + window] - total[lo]) * inverse[lo] + ((anchor - lo) * 4096 + (hi - lo)).astype(np.uint64)
    return doc, lo - starts[doc], hi - starts[doc], anchor - starts[doc], grams[anchor], mix(around, 7)


def anchor_rows(rows: DataFrame, window: int) -> DataFrame:
    """(h, g, id, tie, at) per anchor of rows (id, tie, text): its n windows from place lo on, as lo * 4096 + n."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
        sizes, found = [len(t) for t in texts], []
        for a, b in _chunks(sizes):
            data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
            doc, lo, hi, _, h, g = anchors_of(data, np.cumsum(sizes[a:b]), window)
            found.append((h.view(np.int64), g.view(np.int64), ids[a:b][doc], ties[a:b][doc], lo * 4096 + (hi - lo + 1)))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["h", "g", "id", "tie", "at"])

    return map_batches(rows, run, "h bigint, g bigint, id bigint, tie bigint, at bigint")


def _names(parts: list[np.ndarray]) -> np.ndarray:
    """Ranks of tuples of ranks below 2**32, packed at once where they fit into 64 bits, else part by part."""
    bits = max(int(part.max(initial=0)).bit_length() for part in parts)
    whole = bits * len(parts) <= 64
    key = parts[0].astype(np.uint64)
    for part in parts[1:]:
        key = (key << np.uint64(bits if whole else 32)) | part.astype(np.uint64)
        if not whole:
            key = np.unique(key, return_inverse=True)[1].astype(np.uint64)
    return np.unique(key, return_inverse=True)[1].astype(np.int64)


def sorted_windows(data: np.ndarray, wanted: np.ndarray, window: int) -> np.ndarray:
    """The wanted positions in the order of their suffixes' first `window` bytes or more, by difference cover 1, 2 modulo 3."""
    n = len(data)
    pad = 3 * window + 16
    size = n + pad
    s = np.zeros(size, np.int64)
    s[:n] = data.astype(np.int64) + 1
    cover = np.arange(size - pad + 8)
    sample = cover[cover % 3 != 0]
    rank = np.zeros(size, np.int64)
    rank[sample] = _names([s[sample], s[sample + 1], s[sample + 2]])
    span = 3
    while span < window:
        # Names of three names; the step keeps the residue, so that the recursion stays inside the cover.
        following = [np.where(sample + j * span < size, rank[np.minimum(sample + j * span, size - 1)], 0) for j in (0, 1, 2)]
        named = _names(following)
        rank = np.zeros(size, np.int64)
        rank[sample] = named
        span *= 3
        if named.max(initial=0) + 1 == len(sample):
            break
    covered = wanted[wanted % 3 != 0]
    covered = covered[np.argsort(rank[covered], kind="stable")]
    rest = wanted[wanted % 3 == 0]
    one, two = covered[covered % 3 == 1], covered[covered % 3 == 2]

    def short(p: np.ndarray) -> np.ndarray:
        return (s[p] << 42) | rank[p + 1]

    def long(p: np.ndarray) -> np.ndarray:
        return (s[p] << 52) | (s[p + 1] << 42) | rank[p + 2]

    rest = rest[np.argsort(short(rest), kind="stable")]
    before = np.searchsorted(np.sort(short(one)), short(rest)) + np.searchsorted(np.sort(long(two)), long(rest))
    merged = np.concatenate([covered, rest])
    key = np.concatenate([2 * np.arange(len(covered)) + 1, 2 * before])
    return merged[np.argsort(key, kind="stable")]


def equal_neighbours(data: np.ndarray, order: np.ndarray, window: int) -> np.ndarray:
    """Per position of the order but the first: its window equals the one before."""
    same = np.ones(max(0, len(order) - 1), bool)
    alive = np.arange(len(same))
    for j in range(window):
        if not len(alive):
            break
        alive = alive[data[order[alive] + j] == data[order[alive + 1] + j]]
    same[:] = False
    same[alive] = True
    return same


def repeats_among(fragments: list[bytes], window: int) -> list[np.ndarray]:
    """Per fragment, in order of precedence: which of its windows occur earlier."""
    sizes = np.array([len(f) for f in fragments])
    data = np.frombuffer(b"".join(fragments), np.uint8)
    starts = np.cumsum(sizes) - sizes
    counts = sizes - window + 1
    wanted = np.concatenate([np.arange(a, a + c) for a, c in zip(starts, counts)])
    order = sorted_windows(data, wanted, window)
    group = np.concatenate([[0], np.cumsum(~equal_neighbours(data, order, window))])
    heads = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
    first = np.minimum.reduceat(order, heads)
    late = np.zeros(len(data), bool)
    late[order] = order > first[group]
    return [late[a : a + c] for a, c in zip(starts, counts)]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _cut_fragments(dealt: DataFrame, window: int) -> DataFrame:
    """Bytes of the fragments of rows (id, tie, text, marks of (h, lo, n)), with the anchor to sort them under."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out = {k: [] for k in ("h", "id", "tie", "lo", "part")}
        for doc, tie, text, marks in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = text.encode("utf-8", "surrogatepass")
            for mark in marks:
                lo, n = mark["lo"], mark["n"]
                for key, value in zip(out, (mark["h"], doc, tie, lo, data[lo : lo + n - 1 + window])):
                    out[key].append(value)
        return pa.RecordBatch.from_pydict(out, schema=_FRAGMENTS) if out["h"] else None

    return map_batches(dealt, run, "h bigint, id bigint, tie bigint, lo bigint, part binary")


_FRAGMENTS = pa.schema([("h", pa.int64()), ("id", pa.int64()), ("tie", pa.int64()), ("lo", pa.int64()), ("part", pa.binary())])


def _hash_windows(dealt: DataFrame, window: int) -> DataFrame:
    """(h, u, v, id, tie, at) of every window of rows (id, tie, text, marks of (h, lo, n)): its anchor, 128 bits of hash, its place."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        h, digests, ids, ties, places = [], [], [], [], []
        for doc, tie, text, marks in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = text.encode("utf-8", "surrogatepass")
            for mark in marks:
                for at in range(mark["lo"], mark["lo"] + mark["n"]):
                    digests.append(blake2b(data[at : at + window], digest_size=16).digest())
                    places.append(at)
                for column, value in zip((h, ids, ties), (mark["h"], doc, tie)):
                    column += [value] * mark["n"]
        u, v = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2).T
        columns = [pa.array(c, pa.int64()) for c in (h, u, v, ids, ties, places)]
        return pa.RecordBatch.from_arrays(columns, names=["h", "u", "v", "id", "tie", "at"])

    return map_batches(dealt, run, "h bigint, u bigint, v bigint, id bigint, tie bigint, at bigint")


def _fold_windows(windows: DataFrame, window: int) -> DataFrame:
    """(id, tie, start, end) of the windows that occur earlier: equal ones are folded, and all but the first of each go."""
    windows = released(windows)
    place = F.struct("id", "tie", "at")
    firsts = windows.groupBy("h", "u", "v").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1")
    firsts = stored(firsts.select("h", "u", "v", "first"))
    late = windows.join(firsts, ["h", "u", "v"]).where("struct(id, tie, at) <> first")
    return late.select("id", "tie", F.col("at").alias("start"), (F.col("at") + window).alias("end"))


def _sort_fragments(fragments: DataFrame, window: int) -> DataFrame:
    """(id, tie, start, end): runs of bytes of windows that occur earlier, among fragments dealt by h."""
    sorted_rows = fragments.repartition("h").sortWithinPartitions("h", "id", "tie", "lo")

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        rows = sorted(rows, key=lambda r: r[1:4])
        out = [[], [], [], []]
        for row, late in zip(rows, repeats_among([r[4] for r in rows], window)):
            for a, b in zip(*_runs(late)):
                for column, value in zip(out, (row[1], row[2], row[3] + int(a), row[3] + int(b) - 1 + window)):
                    column.append(value)
        if not out[0]:
            return None
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["id", "tie", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, size, group, last = [], 0, [], None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if row[0] != last:
                    # A chunk is made of whole groups, each of at most TOGETHER fragments.
                    ready, group, last = ready + group, [], row[0]
                    if size >= SORT_BYTES:
                        made = solve(ready)
                        if made is not None:
                            yield made
                        ready, size = [], 0
                group.append(row)
                size += len(row[4])
        ready += group
        if ready:
            made = solve(ready)
            if made is not None:
                yield made

    return sorted_rows.mapInArrow(run, "id bigint, tie bigint, start bigint, end bigint")


def _compare_anchors(single: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What equal surroundings of anchors tell: (id, tie, spans) to remove, and (id, tie, marks) still to sort and to fold."""
    anchors = anchor_rows(single, window)
    twice = released(anchors.groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h"))
    shared = released(anchors.join(twice, "h"))
    del twice
    classes = released(shared.groupBy("h", "g").agg(F.min(F.struct("id", "tie", "at")).alias("first"), F.count(F.lit(1)).alias("c")))
    lo, n = F.floor(F.col("at") / 4096).alias("lo"), F.pmod(F.col("at"), F.lit(4096)).alias("n")
    kinds = stored(classes.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    both = classes.join(kinds, "h").select("first.*", "h", (F.col("kinds") > TOGETHER).alias("many"))
    both = released(both.groupBy("id", "tie", "many").agg(F.collect_list(F.struct("h", lo, n)).alias("marks")))
    marks, crowded = both.where(~F.col("many")).drop("many"), both.where("many").drop("many")
    later = shared.join(classes.where("c > 1").select("h", "g", "first"), ["h", "g"]).where("struct(id, tie, at) <> first")
    later = later.select("id", "tie", lo, n).select("id", "tie", F.col("lo").alias("start"), (F.col("lo") + F.col("n") - 1 + window).alias("end"))
    spans = stored(later.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    return spans, marks, crowded


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the removed runs as (start, end), and the bytes that stay.

    Texts are UTF-8 bytes, null is empty. A byte goes if a string of `window` bytes that covers it also starts
    earlier: in a smaller doc_id or before in the same document. Matches never cross documents. Texts shorter
    than the window stay whole. A null doc_id comes before all others. Where ids repeat, rows of one id come in
    the order of a hash of their text, and equal rows are one document, which all of them report. Other
    columns are passed over.

    Anchors travel as hashes; texts move twice, once for the strings left to sort and once for the result.
    All joins have plain shuffles on both sides, so that adaptive execution splits a very common passage. The
    windows of an anchor with more than TOGETHER surroundings are not sorted but folded by their hash.
    """
    rows = docs.select(id_of().alias("id"), text_of().alias("text"))
    repeated_ids = not rows.groupBy("id").count().where("count > 1").isEmpty()
    rows = rows.withColumn("tie", F.xxhash64("text") if repeated_ids else F.lit(0).cast("bigint")).select("id", "tie", "text")
    single = rows.distinct() if repeated_ids else rows
    spans, marks, crowded = _compare_anchors(single, window)
    fragments = _cut_fragments(single.join(marks, ["id", "tie"]).select("id", "tie", "text", "marks"), window)
    late = _sort_fragments(fragments, window)
    if not crowded.isEmpty():
        crowded = sent_if_small(crowded, F.size("marks") * 24 + 32)
        windows = _hash_windows(single.join(crowded, ["id", "tie"]).select("id", "tie", "text", "marks"), window)
        late = late.unionByName(_fold_windows(windows, window))
    found = late.groupBy("id", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    both = released(spans.unionByName(found).groupBy("id", "tie").agg(F.flatten(F.collect_list("spans")).alias("spans")))
    dealt = rows.join(both, ["id", "tie"], "left").select("id", "text", "spans")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [None if i == LOWEST else i for i in batch.column(0).to_pylist()]
        sizes, kept, merged = [], [], []
        for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = text.encode("utf-8", "surrogatepass")
            runs: list[list[int]] = []
            for start, end in sorted((f["start"], f["end"]) for f in found or []):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], end)
                else:
                    runs.append([start, end])
            edges = [0, *[x for r in runs for x in r], len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
            sizes.append(len(data))
            merged.append([{"start": a, "end": b} for a, b in runs])
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(merged, pa.list_(span)), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "spans", "kept"],
        )

    return map_batches(dealt, run, "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")


def query(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents).select(
        "doc_id",
        "n_bytes",
        F.coalesce(F.aggregate("spans", F.lit(0).cast("bigint"), lambda t, s: t + s["end"] - s["start"]), F.lit(0)).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
