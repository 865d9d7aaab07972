"""Exact cosine nearest neighbours of sparse documents.

Documents are packed and stored once, where they are made. Equal documents are folded: the others of a group are passed over.
Blocks of documents are read pair by pair and multiplied inside the tasks, frequent terms as matrices of single precision,
rare ones through an index of their postings. Only pairs that rounding does not rule out are measured in double precision,
and only the k best of each block leave a task. No posting and no copy of a block is shuffled.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import cut_lineage

SLACK = 1e-9
BLOCK_DOCS = 512  # documents of a product
TASK_DOCS = 16_384  # documents of a task's block, at most
BLOCK_POSTINGS = 2_000_000  # postings of a task's block, about
TERM_STEP = 2048
DENSE_SHARE = 200.0  # multiplications of a matrix product in the time of one product of two postings
PRODUCTS = 200_000  # products of postings held at once
LEAST_SINGLE = 1e-18  # weights whose products single precision holds
SENT_KEYS = 32 << 20  # bytes of keys that travel with the tasks at most


def packed(postings: DataFrame, key: str, weight: str) -> DataFrame:
    """One row per document: its terms, in order, and their weights."""
    entries = F.sort_array(F.collect_list(F.struct("term", F.col(weight).alias("w"))))
    rows = postings.groupBy(key).agg(entries.alias("e"))
    return rows.select(key, F.col("e.term").alias("terms"), F.col("e.w").alias("weights"))


def _lists(table: pa.Table) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    terms, weights = (table.column(c).combine_chunks() for c in ("terms", "weights"))
    sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(terms)), sizes), terms.flatten(), weights.flatten().to_numpy(zero_copy_only=False)


class _Part:
    """Postings of BLOCK_DOCS documents: those of frequent terms by row, those of rare terms by term."""

    def __init__(self, row: np.ndarray, code: np.ndarray, w: np.ndarray, place: np.ndarray, common: np.ndarray, rare: np.ndarray, rows: int, terms: int):
        self.rows = rows
        often = common[code]
        self.often = row[often], place[code[often]], w[often]
        few = rare[code]
        at = place[code[few]]
        order = np.argsort(at)
        self.term, self.row, self.w = at[order], row[few][order], w[few][order]
        self.terms = terms

    def runs(self) -> tuple[np.ndarray, np.ndarray]:
        """First posting and number of postings of every rare term."""
        n = np.bincount(self.term, minlength=self.terms)
        return np.cumsum(n) - n, n

    def dense(self, start: int, stop: int) -> np.ndarray:
        row, at, w = self.often
        if start or at.size and int(at.max()) >= stop:
            take = (at >= start) & (at < stop)
            row, at, w = row[take], at[take], w[take]
        made = np.zeros(self.rows * (stop - start), w.dtype)
        made[row * (stop - start) + (at - start)] = w
        return made.reshape(self.rows, stop - start)


def _products(a: _Part, runs: tuple[np.ndarray, np.ndarray], b: _Part, common: int) -> np.ndarray:
    """Dot products of all documents of two parts: frequent terms as matrices of TERM_STEP terms, rare ones posting by posting."""
    out = np.zeros((a.rows, b.rows), a.w.dtype)
    for start in range(0, common, TERM_STEP):
        stop = min(start + TERM_STEP, common)
        out += a.dense(start, stop) @ b.dense(start, stop).T
    first, n = runs
    n = n[b.term]
    met = np.flatnonzero(n)
    n, first, row_b, w_b = n[met], first[b.term[met]], b.row[met], b.w[met]
    flat, row_a, ends = out.reshape(-1), a.row * b.rows, np.cumsum(n)
    start = 0
    while start < len(n):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PRODUCTS, side="right")))
        each = n[start:stop]
        own = np.repeat(first[start:stop] - (ends[start:stop] - each - before), each) + np.arange(ends[stop - 1] - before)
        np.add.at(flat, row_a[own] + np.repeat(row_b[start:stop], each), a.w[own] * np.repeat(w_b[start:stop], each))
        start = stop
    return out


def best_of_blocks(a: pa.Table, b: pa.Table, k: int, dense_share: float | None = None) -> pa.Table:
    """The k best documents of b for every query of a, with all that tie: (q, d, s).

    Products of BLOCK_DOCS by BLOCK_DOCS documents are made in single precision. Only pairs that their rounding does not
    rule out are measured in double precision. Weights that single precision could lose are multiplied in double.
    """
    share = DENSE_SHARE if dense_share is None else dense_share
    q, d = a.column("q").to_numpy(), b.column("d").to_numpy()
    row_a, term_a, w_a = _lists(a)
    row_b, term_b, w_b = _lists(b)
    codes = pa.chunked_array([term_a, term_b]).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    code_a, code_b = codes[: len(term_a)], codes[len(term_a) :]
    size = int(codes.max(initial=-1)) + 1
    met = np.bincount(code_a, minlength=size).astype(float) * np.bincount(code_b, minlength=size)
    rare = (met > 0) & (met * share < float(a.num_rows) * b.num_rows)
    common = (met > 0) & ~rare
    place = np.zeros(size, np.int64)
    place[rare], place[common] = np.arange(rare.sum()), np.arange(common.sum())
    heavy = np.abs(np.concatenate((w_a, w_b)))
    kind = np.float32 if heavy.min(initial=1.0) >= LEAST_SINGLE and heavy.max(initial=1.0) <= 1 / LEAST_SINGLE else np.float64

    def parts(row: np.ndarray, code: np.ndarray, w: np.ndarray, rows: int) -> list[_Part]:
        made = []
        for i in range(0, rows, BLOCK_DOCS):
            lo, hi = np.searchsorted(row, (i, i + BLOCK_DOCS))
            made.append(_Part(row[lo:hi] - i, code[lo:hi], w[lo:hi].astype(kind), place, common, rare, min(BLOCK_DOCS, rows - i), int(rare.sum())))
        return made

    right = parts(row_b, code_b, w_b, b.num_rows)
    from_a, from_b = (np.searchsorted(row, np.arange(n + 1)) for row, n in ((row_a, a.num_rows), (row_b, b.num_rows)))
    # A sum of n products of rounded weights is off by at most (n + 2) roundings of the product of both lengths.
    lengths_a, lengths_b = (np.sqrt(np.bincount(row, w * w, n)) for row, w, n in ((row_a, w_a, a.num_rows), (row_b, w_b, b.num_rows)))
    slip = (np.diff(from_a) + 4.0) * float(np.finfo(kind).eps) * lengths_a * lengths_b.max(initial=0.0)
    query, found = np.zeros(size), []
    for number, part in enumerate(parts(row_a, code_a, w_a, a.num_rows)):
        i, runs = number * BLOCK_DOCS, part.runs()
        off = 2 * slip[i : i + part.rows] + SLACK
        best, held, low = np.zeros((part.rows, k)), [], np.zeros(part.rows)
        for j, other in enumerate(right):
            s = _products(part, runs, other, int(common.sum()))
            kk = min(k, other.rows)
            top = s.max(axis=1, keepdims=True) if kk == 1 else np.partition(s, other.rows - kk, axis=1)[:, other.rows - kk :]
            best = np.partition(np.hstack((best, top)), kk, axis=1)[:, kk:]
            low = best.min(axis=1) - off
            hit = np.flatnonzero(s >= np.where(low > 0, low, np.nextafter(kind(0), kind(1))).astype(kind)[:, None])
            held.append((hit // other.rows, hit % other.rows + j * BLOCK_DOCS, s.reshape(-1)[hit]))
        row, col, s = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, int),) * 3
        may = s >= low[row].astype(kind)
        row, col = row[may], col[may]
        order = np.argsort(row, kind="stable")
        row, col = row[order], col[order]
        s = np.zeros(len(row))
        at = -1
        for n, (r, c) in enumerate(zip(row.tolist(), col.tolist())):
            if r != at:
                if at >= 0:
                    query[own] = 0.0
                at = r
                own = code_a[from_a[i + r] : from_a[i + r + 1]]
                query[own] = w_a[from_a[i + r] : from_a[i + r + 1]]
            s[n] = query[code_b[from_b[c] : from_b[c + 1]]] @ w_b[from_b[c] : from_b[c + 1]]
        if at >= 0:
            query[own] = 0.0
        order = np.lexsort((-s, row))
        row, col, s = row[order], col[order], s[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        sizes = np.diff(np.append(first, len(row)))
        border = np.where(sizes >= k, s[first + np.minimum(sizes, k) - 1], 0.0) if len(row) else s
        keep = (s >= np.repeat(border, sizes) - SLACK) & (s > 0)
        found.append(pa.table({"q": pa.array(q[row[keep] + i], pa.int64()), "d": pa.array(d[col[keep]], pa.int64()), "s": pa.array(s[keep], pa.float64())}))
    return pa.concat_tables(found) if found else pa.table({"q": pa.array([], pa.int64()), "d": pa.array([], pa.int64()), "s": pa.array([], pa.float64())})


def task_docs(documents: int, cores: int) -> int:
    """Documents per block of a task: about two blocks a core, so that the number of blocks does not grow up to TASK_DOCS."""
    return min(TASK_DOCS, max(BLOCK_DOCS, -(-documents // (2 * cores))))


def stored_vectors(rows: DataFrame, key: str, *more: str) -> DataFrame:
    """Documents (key, terms, weights), terms in order, stored where they are made, without a shuffle.

    A row holds the packed documents of one batch (data), of equal `more`, BLOCK_POSTINGS postings at most unless one
    document has more; with their keys and hashes of their terms and weights, rounded to 12 decimals (documents).
    Documents without a key are left out.
    """
    most, known = BLOCK_POSTINGS, rows.where(F.col(key).isNotNull()).select(key, *more, "terms", "weights")

    def hashes(table: pa.Table) -> list[bytes]:
        terms, weights = (table.column(c).combine_chunks() for c in ("terms", "weights"))
        ends = np.cumsum(pc.list_value_length(terms).to_numpy(zero_copy_only=False)).tolist()
        flat, w = terms.flatten(), np.round(weights.flatten().to_numpy(zero_copy_only=False), 12)
        flat = flat.to_numpy(zero_copy_only=False)
        bits = (lambda x: repr(x.tolist()).encode()) if flat.dtype == object else np.ndarray.tobytes
        return [hashlib.blake2b(bits(flat[lo:hi]) + w[lo:hi].tobytes(), digest_size=16).digest() for lo, hi in zip([0, *ends], ends)]

    def write(batches):
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            for part in {tuple(x.values()) for x in whole.select(list(more)).to_pylist()} if more else {()}:
                table = whole
                for name, value in zip(more, part):
                    table = table.filter(pc.equal(table.column(name), pa.scalar(value)))
                table = table.select([key, "terms", "weights"])
                ends = np.cumsum(pc.list_value_length(table.column("terms")).to_numpy())
                start = 0
                while start < table.num_rows:
                    before = ends[start - 1] if start else 0
                    stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
                    piece = table.slice(start, stop - start).combine_chunks()
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                        out.write_table(piece)
                    documents = [{"key": i, "print": h} for i, h in zip(piece.column(key).to_pylist(), hashes(piece))]
                    made = [(name, [value]) for name, value in zip(more, part)]
                    made += [("postings", [int(ends[stop - 1] - before)]), ("documents", [documents]), ("data", [sink.getvalue().to_pybytes()])]
                    types = [*(whole.schema.field(name).type for name in more), pa.int64(), pa.list_(pa.struct([("key", pa.int64()), ("print", pa.binary())])), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for (_, x), t in zip(made, types)], [name for name, _ in made])
                    start = stop

    kinds = "".join(f"`{name}` {rows.schema[name].dataType.simpleString()}, " for name in more)
    made = known.mapInArrow(write, kinds + "postings bigint, documents array<struct<key: bigint, print: binary>>, data binary")
    return cut_lineage(made.withColumn("chunk", F.monotonically_increasing_id()))


def written_blocks(postings: DataFrame, key: str, weight: str, documents: int) -> DataFrame:
    """The documents of postings (key, term, weight), packed and stored as by stored_vectors."""
    return stored_vectors(packed(postings, key, weight), key)


def block_pairs(left: DataFrame, right: DataFrame, k: int, queries: int, documents: int, dense_share: float | None = None) -> DataFrame:
    """The k best documents of every query within each block of documents: (q, d, s), from stored documents (data, drop).

    The task of a pair of blocks reads both from where they are stored; keys in `drop` are passed over.
    """
    spark, most, share = left.sparkSession, BLOCK_POSTINGS, DENSE_SHARE if dense_share is None else dense_share
    cores = spark.sparkContext.defaultParallelism

    def dealt(stored: DataFrame, least: int):
        postings = stored.agg(F.sum("postings")).first()[0] or 0
        blocks = max(1, least, -(-postings // most))
        return blocks, stored.select("postings", "data", "drop").coalesce(blocks).rdd.glom()

    def tables(rows: list, name: str):
        """Documents of stored rows, some `most` postings at a time."""
        held, size = [], 0
        for row in rows:
            if held and size + row["postings"] > most:
                yield pa.concat_tables(held)
                held, size = [], 0
            table = pa.ipc.open_stream(row["data"]).read_all()
            table = table.rename_columns([name, "terms", "weights"])
            if row["drop"]:
                table = table.filter(~np.isin(table.column(name).to_numpy(), row["drop"]))
            held.append(table)
            size += row["postings"]
        if held:
            yield pa.concat_tables(held)

    def best(pair):
        for a in tables(pair[0], "q"):
            for b in tables(pair[1], "d"):
                yield from zip(*(c.to_pylist() for c in best_of_blocks(a, b, k, share).columns))

    # Pairs are made large, four a core, since a task orders the terms of both its blocks.
    count, right = dealt(right, -(-documents // task_docs(documents, cores)))
    _, left = dealt(left, max(-(-queries // TASK_DOCS), -(-4 * cores // count)))
    found = left.cartesian(right).flatMap(best)
    return spark.createDataFrame(found, "q bigint, d bigint, s double", verifySchema=False)


def by_blocks(post: DataFrame, asked: DataFrame, k: int, documents: int) -> DataFrame:
    """The k best documents of every query within each block of documents: (q, d, s)."""
    left = written_blocks(asked, "q", "wq", documents).withColumn("drop", F.lit(None).cast("array<bigint>"))
    right = written_blocks(post, "d", "wd", documents).withColumn("drop", F.lit(None).cast("array<bigint>"))
    return block_pairs(left, right, k, asked.select("q").distinct().count(), documents)


def folded(stored: DataFrame, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored documents with the keys to pass over (drop), the k lowest keys of every distinct document, and every owner.

    The document of the lowest key stands for all that equal it.
    """
    prints = cut_lineage(stored.select("chunk", F.inline("documents")))
    ranked = prints.withColumn("_n", F.row_number().over(Window.partitionBy("print").orderBy("key")))
    kept = ranked.where(F.col("_n") <= k)
    members = kept.groupBy("print").agg(F.min("key").alias("rep"), F.collect_list("key").alias("members"))
    members = cut_lineage(members)
    owners = prints.join(members, "print").select(F.col("key").alias("owner"), "rep", "chunk")
    passed = cut_lineage(owners.where(F.col("owner") != F.col("rep")).groupBy("chunk").agg(F.collect_list("owner").alias("drop")))
    size = passed.agg(F.sum(8 * F.size("drop") + 24)).first()[0] or 0
    rows = stored.drop("documents").join(F.broadcast(passed) if size <= SENT_KEYS else passed, "chunk", "left")
    return rows, members.select("rep", "members"), owners.select("owner", "rep")


def cosine_neighbors(train: DataFrame, queries: DataFrame, key: str, k: int, dense_share: float = DENSE_SHARE) -> DataFrame:
    """(query, neighbor, similarity, rank) over unit-length postings (key, term, w), or stored_vectors of both.

    Ties go to the lowest key. Only documents sharing a term with the query appear; the caller fills up shorter lists.
    """
    train, queries = (x if "data" in x.columns else stored_vectors(packed(x, key, "w"), key) for x in (train, queries))
    post, members, _ = folded(train, k)
    asked, reps, owners = folded(queries, 1)
    blocks = block_pairs(asked, post, k, reps.count(), members.count(), dense_share).select("q", "d", F.round("s", 9).alias("similarity"))
    rows = blocks.join(members, F.col("d") == F.col("rep")).select("q", "similarity", F.explode("members").alias("neighbor"))
    order = Window.partitionBy("q").orderBy(F.col("similarity").desc(), "neighbor")
    top = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return owners.select(F.col("owner").alias("query"), F.col("rep").alias("q")).join(top, "q").select("query", "neighbor", "similarity", "rank")
