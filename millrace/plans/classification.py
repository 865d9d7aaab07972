"""Classifiers fitted by gradient sums: one job per step, only parameters return to the driver."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import digest, hash_bucket
from millrace.operators.linalg import add_up, matrix, sum_vectors, vector_batch
from millrace.operators.sampling import batch_number
from millrace.operators.scoring import score_rows
from millrace.plans.regression import metric_table

LOG_FLOOR = 1e-15


@contextmanager
def cached(df: DataFrame):
    """Keep the training rows for the steps of one fit; lost blocks are recomputed."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


#: Rows of a partition that is read again in every step of a fit, at least; only one per core may hold fewer.
STEP_ROWS = 100_000


@contextmanager
def cached_evenly(df: DataFrame):
    """As cached(), for fits of many short steps: every core has a share of the rows, and no step starts more tasks than they need."""
    with cached(df):
        cores, now = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
        most = max(cores, -(-df.count() // STEP_ROWS))
        if cores <= now <= most:
            yield df
            return
        with cached(df.repartition(min(max(now, cores), most))) as dealt:
            dealt.count()
            df.unpersist()
            yield dealt


def training_frame(df: DataFrame, features: Column, label: Column, is_test: Column, *more: Column) -> DataFrame:
    return df.select(
        features.cast("array<double>").alias("x"), label.cast("int").alias("y"), is_test.alias("t"), *more
    )


def _columns(batch: pa.RecordBatch):
    x = matrix(batch.column(0))
    y = batch.column(1).to_numpy(zero_copy_only=False)
    tests = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
    return x, y, tests


def _with_ones(x: np.ndarray) -> np.ndarray:
    return np.column_stack([x, np.ones(len(x))])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))


def logistic_gradient(
    df: DataFrame, features: Column, label: Column, is_test: Column, dims: int, steps: int, rate: float
) -> tuple[np.ndarray, DataFrame]:
    """Logistic regression by full-batch gradient steps, bias as a last feature.

    Loss and accuracy of the weights before the step come from the same aggregate as the gradient.
    """
    weights = np.zeros(dims + 1)
    rows = []
    with cached(training_frame(df, features, label, is_test)) as data:
        for step in range(steps + 1):

            def fn(batch: pa.RecordBatch, w=weights) -> np.ndarray:
                x, y, tests = _columns(batch)
                x = _with_ones(x)
                p = _sigmoid(x @ w)
                loss = -(y * np.log(np.maximum(p, LOG_FLOOR)) + (1 - y) * np.log(np.maximum(1 - p, LOG_FLOOR)))
                hit = np.abs(y - p) <= 0.5
                train = ~tests
                gradient = (p - y)[train] @ x[train]
                return np.concatenate(
                    [gradient, [loss[train].sum(), hit[train].sum(), train.sum(), loss[tests].sum(), hit[tests].sum(), tests.sum()]]
                )

            total = sum_vectors(data, fn)
            gradient, m = total[: dims + 1], total[dims + 1 :]
            rows.append((step, m[0] / m[2], m[1] / m[2], m[3] / max(m[5], 1), m[4] / max(m[5], 1)))
            if step < steps:
                weights = weights - rate * gradient / m[2]
    rows = [tuple([r[0], *[float(v) for v in r[1:]]]) for r in rows]
    return weights, metric_table(df.sparkSession, rows, "step INT, train_loss DOUBLE, train_acc DOUBLE, test_loss DOUBLE, test_acc DOUBLE")


def softmax_gradient(
    df: DataFrame, features: Column, label: Column, is_test: Column, dims: int, classes: int, steps: int, rate: float
) -> tuple[np.ndarray, DataFrame]:
    """Softmax regression by full-batch gradient steps, bias as a last feature; lowest class on ties."""
    weights = np.zeros((dims + 1, classes))
    rows = []
    with cached(training_frame(df, features, label, is_test)) as data:
        for step in range(steps + 1):

            def fn(batch: pa.RecordBatch, w=weights) -> np.ndarray:
                x, y, tests = _columns(batch)
                x = _with_ones(x)
                p = _softmax(x @ w)
                loss = -np.log(np.maximum(p[np.arange(len(y)), y], LOG_FLOOR))
                # Rounding settles ties that summation order would split.
                hit = np.round(p, 12).argmax(axis=1) == y
                train = ~tests
                error = p[train]
                error[np.arange(len(error)), y[train]] -= 1.0
                gradient = x[train].T @ error
                return np.concatenate(
                    [gradient.ravel(), [loss[train].sum(), hit[train].sum(), train.sum(), loss[tests].sum(), hit[tests].sum(), tests.sum()]]
                )

            total = sum_vectors(data, fn)
            gradient, m = total[:-6].reshape(dims + 1, classes), total[-6:]
            rows.append((step, *[float(v) for v in (m[0] / m[2], m[1] / m[2], m[3] / max(m[5], 1), m[4] / max(m[5], 1))]))
            if step < steps:
                weights = weights - rate * gradient / m[2]
    return weights, metric_table(df.sparkSession, rows, "step INT, train_loss DOUBLE, train_acc DOUBLE, test_loss DOUBLE, test_acc DOUBLE")


@dataclass
class LinearClassifier:
    """Weights (features + bias) x classes; the class of the highest score, the lowest on ties.

    A single column is the score of class 1 against 0.
    """

    weights: np.ndarray

    def transform(self, df: DataFrame, features: str, name: str = "prediction") -> DataFrame:
        """Batch or streaming frames."""
        weights = self.weights.reshape(len(self.weights), -1)

        def best(x: np.ndarray) -> np.ndarray:
            scores = _with_ones(x) @ weights
            return (scores[:, 0] > 0).astype(int) if weights.shape[1] == 1 else np.round(_softmax(scores), 12).argmax(axis=1)

        return score_rows(df, F.col(features), name, "int", best, len(weights) - 1)


def perceptron(
    df: DataFrame, features: Column, label: Column, dims: int, max_passes: int
) -> tuple[np.ndarray, DataFrame]:
    """Batch perceptron on labels -1, +1: w += sum of t x over rows with t (w.x) <= 0.

    Stops at the first pass without an error or after max_passes: inseparable rows never finish.
    """
    weights = np.zeros(dims + 1)
    rows = []
    data = df.select(features.cast("array<double>").alias("x"), label.cast("int").alias("y"))
    with cached(data):
        for number in range(1, max_passes + 1):

            def fn(batch: pa.RecordBatch, w=weights) -> np.ndarray:
                x = _with_ones(matrix(batch.column(0)))
                t = batch.column(1).to_numpy(zero_copy_only=False)
                wrong = t * (x @ w) <= 0
                return np.append(t[wrong] @ x[wrong], wrong.sum())

            total = sum_vectors(data, fn)
            errors = int(round(total[-1]))
            rows.append((number, errors))
            if errors == 0:
                break
            weights = weights + total[:-1]
    return weights, metric_table(df.sparkSession, rows, "pass INT, errors BIGINT")


@dataclass
class Network:
    """Fully connected ReLU layers with a softmax output."""

    weights: list[np.ndarray]
    biases: list[np.ndarray]

    @classmethod
    def start(cls, sizes: list[int], seed: int = 42, spread: float = 0.1) -> "Network":
        generator = np.random.RandomState(seed)
        weights = [generator.uniform(-spread, spread, size=(a, b)) for a, b in zip(sizes, sizes[1:])]
        return cls(weights, [np.zeros(b) for b in sizes[1:]])

    def parts(self) -> list[np.ndarray]:
        return [*self.weights, *self.biases]

    def pack(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def unpack(self, vector: np.ndarray) -> "Network":
        out, at = [], 0
        for p in self.parts():
            out.append(vector[at : at + p.size].reshape(p.shape))
            at += p.size
        k = len(self.weights)
        return Network(out[:k], out[k:])

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        """Outputs of every layer; the last is the class probabilities."""
        layers = [x]
        for i, (w, b) in enumerate(zip(self.weights, self.biases)):
            z = layers[-1] @ w + b
            layers.append(_softmax(z) if i == len(self.weights) - 1 else np.maximum(z, 0.0))
        return layers

    def gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        """Summed gradient of -ln p(target), packed like the parameters."""
        layers = self.forward(x)
        delta = layers[-1].copy()
        delta[np.arange(len(y)), y] -= 1.0
        if weight is not None:
            delta *= weight[:, None]
        dw: list[np.ndarray] = [None] * len(self.weights)
        db: list[np.ndarray] = [None] * len(self.weights)
        for i in reversed(range(len(self.weights))):
            dw[i] = layers[i].T @ delta
            db[i] = delta.sum(axis=0)
            if i:
                delta = (delta @ self.weights[i].T) * (layers[i] > 0)
        return np.concatenate([p.ravel() for p in [*dw, *db]])

    def transform(self, df: DataFrame, features: str, name: str = "prediction", expand=None) -> DataFrame:
        """Class with the highest probability; batch or streaming frames."""

        def best(x: np.ndarray) -> np.ndarray:
            return self.forward(x if expand is None else expand(x))[-1].argmax(axis=1)

        return score_rows(df, F.col(features), name, "int", best)


class Steps:
    """Gradient step rules over a packed parameter vector."""

    def __init__(self, rule: str, rate: float):
        self.rule, self.rate = rule, rate
        self.count, self.mean, self.square = 0, 0.0, 0.0

    def apply(self, vector: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        if self.rule == "sgd":
            return vector - self.rate * gradient
        # Adam with its published default decay rates.
        self.count += 1
        self.mean = 0.9 * self.mean + 0.1 * gradient
        self.square = 0.999 * self.square + 0.001 * gradient * gradient
        mean = self.mean / (1 - 0.9**self.count)
        square = self.square / (1 - 0.999**self.count)
        return vector - self.rate * mean / (np.sqrt(square) + 1e-8)


def fit_network(
    df: DataFrame,
    features: Column,
    label: Column,
    is_test: Column,
    keys: list[Column],
    dims: int,
    hidden: list[int],
    classes: int,
    epochs: int,
    rate: float,
    batches: int = 1,
    rule: str = "sgd",
    seed: int = 42,
    spread: float = 0.1,
) -> tuple[Network, DataFrame]:
    """Back-propagation with seeded mini-batches; one job per batch, accuracy of each epoch folded
    into the first job of the next."""
    network = Network.start([dims, *hidden, classes], seed, spread)
    steps = Steps(rule, rate)
    rows = []
    codes = F.concat_ws("-", *[k.cast("string") for k in keys]).alias("k")
    with cached(training_frame(df, features, label, is_test, codes)) as data:
        for epoch in range(epochs + 1):
            numbered = data.select("x", "y", "t", batch_number(seed, epoch, batches, F.col("k")).alias("b"))
            last = epoch == epochs
            for number in range(1 if last else batches):

                def fn(batch: pa.RecordBatch, net=network, number=number, metrics=number == 0, last=last) -> np.ndarray:
                    x, y, tests = _columns(batch)
                    mine = batch.column(3).to_numpy(zero_copy_only=False) == number
                    use = ~tests & mine
                    gradient = np.zeros(net.pack().size) if last else net.gradient(x[use], y[use])
                    if metrics:
                        hit = net.forward(x)[-1].argmax(axis=1) == y
                        m = [hit[~tests].sum(), (~tests).sum(), hit[tests].sum(), tests.sum()]
                    else:
                        m = [0, 0, 0, 0]
                    return np.concatenate([gradient, [use.sum()], m])

                total = sum_vectors(numbered, fn)
                if number == 0 and epoch:
                    m = total[-4:]
                    rows.append((epoch, float(m[0] / m[1]), float(m[2] / max(m[3], 1))))
                used = total[-5]
                if not last and used:
                    network = network.unpack(steps.apply(network.pack(), total[:-5] / used))
    return network, metric_table(df.sparkSession, rows, "epoch INT, train_acc DOUBLE, test_acc DOUBLE")


class LogisticUnit(Network):
    """Weights and a bias with a sigmoid: the probability of class 1."""

    @classmethod
    def zeros(cls, dims: int) -> "LogisticUnit":
        return cls([np.zeros((dims, 1))], [np.zeros(1)])

    def unpack(self, vector: np.ndarray) -> "LogisticUnit":
        return LogisticUnit([vector[:-1].reshape(-1, 1)], [vector[-1:]])

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        p = _sigmoid(x @ self.weights[0] + self.biases[0])
        return [x, np.column_stack([1.0 - p, p])]

    def gradient(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        error = self.forward(x)[-1][:, 1] - y
        error = error if weight is None else error * weight
        return np.append(x.T @ error, error.sum())


#: Rows of a shard where their number is taken from the data.
SHARD_ROWS = 8192


def fit_network_averaged(
    df: DataFrame,
    features: Column,
    label: Column,
    is_test: Column,
    keys: list[Column],
    dims: int,
    hidden: list[int],
    classes: int,
    epochs: int,
    rate: float,
    batch_size: int = 32,
    shards: int | None = None,
    rule: str = "sgd",
    seed: int = 42,
    spread: float = 0.1,
    weight: Column | None = None,
    expand=None,
    start: Network | None = None,
) -> tuple[Network, DataFrame]:
    """Parallel passes: each seeded shard runs sequential mini-batches from the shared weights, the
    results are averaged by row count once per epoch (Zinkevich et al. 2010). One job per epoch.

    ``weight`` is the number of examples a row stands for. ``expand`` turns the stored matrix of a
    record batch into the input layer (say codes into one-hot slots), so that only the compact form
    is stored and shuffled. ``start`` replaces the random first network. Without ``shards`` there is one per
    SHARD_ROWS rows.

    A shard is a partition, and rows are dealt to shards by hash. Every epoch orders them anew, by a hash of epoch and key
    inside the partition, and cuts the train rows in that order into batches, whatever the record batches they arrive in.
    So the result hangs neither on the layout nor on the cluster. Only a parameter vector leaves a shard.
    """
    network = Network.start([dims, *hidden, classes], seed, spread) if start is None else start
    rows = []
    codes = F.concat_ws("-", *[k.cast("string") for k in keys]).alias("k")
    count = (F.lit(1.0) if weight is None else weight.cast("double")).alias("w")
    frame = training_frame(df, features, label, is_test, codes, count)
    if shards is None:
        shards = max(1, -(-frame.count() // SHARD_ROWS))
    sharded = frame.repartitionById(shards, hash_bucket(f"{seed}-shard", shards, F.col("k")))
    with cached(sharded) as data:
        for epoch in range(epochs + 1):

            def run(batches, net=network, last=epoch == epochs):
                vector, seen, m = net.pack(), 0.0, np.zeros(4)
                steps = Steps(rule, rate)
                waiting: list[tuple] = []

                def step(part: list[tuple]) -> None:
                    nonlocal vector, seen
                    a, b, c = (np.concatenate(p) for p in zip(*part))
                    vector = steps.apply(vector, net.unpack(vector).gradient(a, b, c) / c.sum())
                    seen += c.sum()

                for batch in batches:
                    if not batch.num_rows:
                        continue
                    x, y, tests = _columns(batch)
                    x = x if expand is None else expand(x)
                    w = batch.column(3).to_numpy(zero_copy_only=False)
                    hit = w * (net.forward(x)[-1].argmax(axis=1) == y)
                    m += [hit[~tests].sum(), w[~tests].sum(), hit[tests].sum(), w[tests].sum()]
                    if last:
                        continue
                    a, b, c = x[~tests], y[~tests], w[~tests]
                    at = 0
                    while at < len(a):
                        room = batch_size - sum(len(p[1]) for p in waiting)
                        part = slice(at, at + room)
                        waiting.append((a[part], b[part], c[part]))
                        at += room
                        if sum(len(p[1]) for p in waiting) == batch_size:
                            step(waiting)
                            waiting = []
                if waiting:
                    step(waiting)
                out = np.concatenate([vector * seen, [seen], m])
                yield vector_batch(out)

            ordered = data.select("x", "y", "t", "w", digest(f"{seed}-{epoch}", F.col("k")).alias("o"), "k").sortWithinPartitions("o", "k")
            total = add_up(ordered.select("x", "y", "t", "w").mapInArrow(run, "vec array<double>"))
            if epoch:
                m = total[-4:]
                rows.append((epoch, float(m[0] / m[1]), float(m[2] / max(m[3], 1))))
            if epoch < epochs:
                network = network.unpack(total[:-5] / total[-5])
    return network, metric_table(df.sparkSession, rows, "epoch INT, train_acc DOUBLE, test_acc DOUBLE")


class OneHotPositions:
    """Codes at fixed positions to a one-hot block with the same category list at every position.

    A code outside the list sets nothing; slot = position * size + place in the list.
    """

    def __init__(self, categories: list[int]):
        self.categories = np.array(sorted(categories), dtype=float)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        size = len(self.categories)
        n, positions = codes.shape
        place = np.minimum(np.searchsorted(self.categories, codes), size - 1)
        row, position = np.nonzero(self.categories[place] == codes)
        out = np.zeros((n, positions * size))
        out[row, position * size + place[row, position]] = 1.0
        return out


def library_logistic(features_col: str, label_col: str, strength: float, rows: int, max_iter: int = 100):
    """L2 logistic regression with inverse strength C, as Spark's objective expresses it."""
    from pyspark.ml.classification import LogisticRegression

    return LogisticRegression(
        featuresCol=features_col,
        labelCol=label_col,
        regParam=1.0 / (strength * rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=max_iter,
        tol=1e-8,
    )
