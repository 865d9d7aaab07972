"""Quality classifier: hashed word and character n-gram vectors, averaged, with a softmax on top."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.llm.common import text_of
from millrace.llm.textnum import chunks, join_texts, mix, slices, space_table, span_hashes, spans

BUCKETS = 1 << 18
NGRAMS = (3, 4, 5)
_SAME_AS_BEFORE = np.uint64(0x5A17D0B3C4E92F61)
#: At most so many labelled documents are fitted on, those with the lowest hash of doc_id.
TRAIN_ROWS = 6000
#: Least number of gradient steps; small samples are passed over more often.
STEPS = 12_000


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all words and of the character n-grams inside words, and the text each belongs to.

    Words are separated by white space; the n-grams see a space at both ends of a word. A word that is the
    same as the word before it in the text gives one more feature, the same for all words.
    """
    points, edges = join_texts(texts)
    space = space_table()[points]
    points = np.where(space, np.uint32(32), points)
    starts, ends = spans(~space)
    ids, at = [span_hashes(points, starts, ends)], [starts]
    again = starts[1:][(ids[0][1:] == ids[0][:-1]) & (np.diff(np.searchsorted(edges, starts, side="right")) == 0)]
    ids.append(np.full(len(again), _SAME_AS_BEFORE, np.uint64))
    at.append(again)
    blanks = np.concatenate([[0], np.cumsum(space)])
    wide = points.astype(np.uint64)
    for n in NGRAMS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        # No white space but at the two ends, and a word between them.
        good = np.flatnonzero(blanks[n - 1 : n - 1 + m] == blanks[1 : m + 1])
        h = np.zeros(len(good), dtype=np.uint64)
        for j in range(n):
            h = h * np.uint64(0x100000001B3) + wide[good + j]
        ids.append(mix(h, n))
        at.append(good + 1)
    owner = np.searchsorted(edges, np.concatenate(at), side="right")
    return (np.concatenate(ids) >> np.uint64(64 - 18)).astype(np.int32), np.minimum(owner, len(texts) - 1)


@dataclass
class QualityModel:
    """Vectors per bucket, output weights per class, output biases."""

    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def bucket_margins(self) -> np.ndarray:
        """What one occurrence of each bucket adds to the margin of class 1 over class 0."""
        return (self.vectors @ (self.weights[1] - self.weights[0])).astype(np.float32)


def fit_arrays(samples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, dim: int, epochs: int, rate: float, seed: int) -> QualityModel:
    """Stochastic gradient descent over documents given as (buckets, shares)."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim)).astype(np.float32)
    weights, bias = np.zeros((2, dim), np.float32), np.zeros(2, np.float32)
    steps, done = max(1, epochs * len(samples)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(samples)):
            ids, share = samples[i]
            now = rate * (1 - done / steps)
            done += 1
            hidden = share @ vectors[ids] if len(ids) else np.zeros(dim, np.float32)
            out = weights @ hidden + bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = weights.T @ p
            weights -= now * np.outer(p, hidden)
            bias -= now * p
            if len(ids):
                vectors[ids] -= np.outer(share, now * back)
    return QualityModel(vectors, weights, bias)


def fit_quality(
    docs: DataFrame, labels: DataFrame, may_learn: Column, limit: int = TRAIN_ROWS, dim: int = 8, steps: int = STEPS, rate: float = 2.0, seed: int = 1
) -> QualityModel:
    """Fit on at most `limit` labelled rows of docs for which may_learn (over doc_id) holds.

    Rows without label, id or partner are passed over; a document with several labels gets the lowest. The
    sample is chosen by a hash of doc_id among the labels, which are then few enough to be sent to the
    documents; the fit is one task over that bounded sample. Without any row the model scores one half.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & may_learn)
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    rows = docs.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(limit).select("label", "text")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        samples, targets = [], []
        for batch in batches:
            texts = batch.column(1).to_pylist()
            targets += batch.column(0).to_pylist()
            for a, b in chunks(texts):
                ids, owner = features(texts[a:b])
                order = np.argsort(owner, kind="stable")
                cuts = np.searchsorted(owner[order], np.arange(1, b - a))
                for part in np.split(ids[order], cuts):
                    kinds, counts = np.unique(part, return_counts=True)
                    samples.append((kinds, (counts / max(1, len(part))).astype(np.float32)))
        if samples:
            model = fit_arrays(samples, np.array(targets), dim, -(-steps // len(samples)), rate, seed)
            yield pa.RecordBatch.from_pydict({k: [getattr(model, k).astype("<f4").tobytes()] for k in ("vectors", "weights", "bias")})

    made = rows.mapInArrow(fit, "vectors binary, weights binary, bias binary").collect()
    if not made:
        return QualityModel(np.zeros((BUCKETS, dim), np.float32), np.zeros((2, dim), np.float32), np.zeros(2, np.float32))
    read = lambda name: np.frombuffer(bytes(made[0][name]), "<f4")
    return QualityModel(read("vectors").reshape(BUCKETS, dim), read("weights").reshape(2, dim), read("bias"))


def score_texts(margins: np.ndarray, offset: float, texts: list[str]) -> np.ndarray:
    out = np.empty(len(texts))
    for a, b in chunks(texts):
        ids, owner = features(texts[a:b])
        total = np.bincount(owner, weights=margins[ids], minlength=b - a)
        count = np.bincount(owner, minlength=b - a)
        out[a:b] = total / np.maximum(count, 1)
    return 1 / (1 + np.exp(-np.clip(out + offset, -500, 500)))


def score_quality(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All columns of docs and ``score``, the probability of class 1 for the whole text.

    Null and empty texts have no feature and get the probability of the bias alone. An input column named
    score is replaced. What travels with the tasks is one number per bucket, the same size for any corpus.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.bucket_margins(), float(model.bias[1] - model.bias[0])))
    rest = [c for c in docs.columns if c != "score"]
    # Input columns stay inside a struct, so that no name of theirs can be misread.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"), text_of().alias("text"))
    made = StructType([rows.schema["row"], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margins, offset = sent.value
        for batch in batches:
            if batch.num_rows:
                scores = np.concatenate([score_texts(margins, offset, texts) for _, texts in slices(batch.column(1))])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["row", "score"])

    scored = rows.mapInArrow(run, made)
    return scored.select(*[F.col("row")[c].alias(c) for c in rest], "score")


def held_out() -> Column:
    """Rows kept from learning: crc32 of the id as text divides by 5. A null id is never learned from, and not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


THRESHOLD = 0.3


def query(documents: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit_quality(documents, labels, ~held_out())
    scored = score_quality(documents.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
