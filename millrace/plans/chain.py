"""Fit/transform chains, and one typed Parquet form in which every fitted model is stored and loaded again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.features import ArrayScaler, ColumnProcessor, OneHot, Scaler
from millrace.plans.bayes import DenseBayes
from millrace.plans.classification import LinearClassifier, Network
from millrace.plans.regression import FourierMap, LinearModel, PolynomialMap
from millrace.plans.svm import PairMachines
from millrace.plans.tree import Node, Tree

#: One row is a slice of one part of one step: doubles, whole numbers or texts, in the order of a flat array.
STORED = "step INT, kind STRING, part STRING, type STRING, shape ARRAY<INT>, start BIGINT, numbers ARRAY<DOUBLE>, whole ARRAY<BIGINT>, texts ARRAY<STRING>"
SLICE = 1 << 18


# --- parts of fitted models ------------------------------------------------------------------------------------


def _values_of(categories: list) -> dict:
    """Categories with their type: texts, whole numbers or doubles."""
    if all(isinstance(c, str) for c in categories):
        return {"texts": [str(c) for c in categories]}
    if all(isinstance(c, (int, np.integer)) and not isinstance(c, bool) for c in categories):
        return {"whole": np.array(categories, dtype=np.int64)}
    return {"numbers": np.array(categories, dtype=float)}


def _categories(parts: dict, prefix: str = "") -> list:
    for kind in ("texts", "whole", "numbers"):
        if f"{prefix}{kind}" in parts:
            values = parts[f"{prefix}{kind}"]
            return values if kind == "texts" else values.tolist()
    return []


def _scaler(m: Scaler) -> dict:
    return {"columns": list(m.columns), "shift": np.array(m.shift, float), "scale": np.array(m.scale, float)}


def _read_scaler(p: dict) -> Scaler:
    return Scaler(p["columns"], p["shift"].tolist(), p["scale"].tolist())


def _one_hot(m: OneHot) -> dict:
    return {"column": m.column, **_values_of(m.categories)}


def _processor(m: ColumnProcessor) -> dict:
    parts = {f"scaler.{k}": v for k, v in _scaler(m.scaler).items()}
    for i, encoder in enumerate(m.one_hot):
        parts |= {f"one_hot.{i}.{k}": v for k, v in _one_hot(encoder).items()}
    return parts | {"encoders": len(m.one_hot), "expand": int(m.expand)}


def _read_processor(p: dict) -> ColumnProcessor:
    encoders = [OneHot(p[f"one_hot.{i}.column"], _categories(p, f"one_hot.{i}.")) for i in range(p["encoders"])]
    scaler = {k.removeprefix("scaler."): v for k, v in p.items() if k.startswith("scaler.")}
    return ColumnProcessor(encoders, _read_scaler(scaler), bool(p["expand"]))


def _tree(m: Tree) -> dict:
    nodes = list(m.nodes.values())
    none = lambda v: -1 if v is None else v
    return {
        "columns": list(m.columns),
        "nodes": np.array([[n.node_id, n.depth, none(n.feature), none(n.left), none(n.right)] for n in nodes], np.int64).reshape(-1, 5),
        "counts": np.array([n.counts for n in nodes], np.int64).reshape(len(nodes), -1),
        "cuts": np.array([np.nan if n.cut is None else n.cut for n in nodes]),
        "impurity": np.array([n.impurity for n in nodes]),
    }


def _read_tree(p: dict) -> Tree:
    made = Tree(p["columns"])
    for (node, depth, feature, left, right), counts, cut, impurity in zip(p["nodes"].tolist(), p["counts"].tolist(), p["cuts"], p["impurity"]):
        leaf = feature < 0
        branch = {} if leaf else {"feature": feature, "cut": float(cut), "left": left, "right": right}
        made.nodes[node] = Node(node, depth, counts, float(impurity), **branch)
    return made


def _network(m: Network) -> dict:
    return {f"weights.{i}": w for i, w in enumerate(m.weights)} | {f"biases.{i}": b for i, b in enumerate(m.biases)}


def _read_network(p: dict) -> Network:
    layers = range(len(p) // 2)
    return Network([p[f"weights.{i}"] for i in layers], [p[f"biases.{i}"] for i in layers])


def _bayes(m: DenseBayes) -> dict:
    return _values_of(m.classes) | {"center": m.center, "constant": m.constant, "linear": m.linear, "square": m.square}


def _machines(m: PairMachines) -> dict:
    parts = {"pairs": np.array(m.pairs, np.int64).reshape(-1, 2), "weights": m.weights, "losses": m.losses}
    if isinstance(m.feature_map, PolynomialMap):
        return parts | {"map": "poly", "dims": m.feature_map.dims, "degree": m.feature_map.degree, "gamma": float(m.feature_map.gamma)}
    return parts | {"map": "fourier", "frequencies": m.feature_map.frequencies, "phases": m.feature_map.phases}


def _read_machines(p: dict) -> PairMachines:
    if p["map"] == "poly":
        made = PolynomialMap(p["dims"], p["degree"], p["gamma"])
    else:
        made = FourierMap.of(p["frequencies"], p["phases"])
    return PairMachines([tuple(x) for x in p["pairs"].tolist()], p["weights"], p["losses"], made)


#: Kind: class, parts of a model, model of its parts.
KINDS: dict[str, tuple[type, Callable, Callable]] = {
    "scaler": (Scaler, _scaler, _read_scaler),
    "array scaler": (ArrayScaler, lambda m: {"low": np.array(m.low, float), "high": np.array(m.high, float)}, lambda p: ArrayScaler(p["low"].tolist(), p["high"].tolist())),
    "one-hot": (OneHot, _one_hot, lambda p: OneHot(p["column"], _categories(p))),
    "columns": (ColumnProcessor, _processor, _read_processor),
    "linear": (LinearModel, lambda m: {"columns": list(m.columns), "weights": np.array(m.weights, float)}, lambda p: LinearModel(p["columns"], p["weights"].tolist())),
    "linear classifier": (LinearClassifier, lambda m: {"weights": m.weights}, lambda p: LinearClassifier(p["weights"])),
    "tree": (Tree, _tree, _read_tree),
    "network": (Network, _network, _read_network),
    "bayes": (DenseBayes, _bayes, lambda p: DenseBayes(_categories(p), p["center"], p["constant"], p["linear"], p["square"])),
    "pair machines": (PairMachines, _machines, _read_machines),
}


# --- chains ----------------------------------------------------------------------------------------------------


@dataclass
class Step:
    """A fitted model, the array column it reads (None where it knows its columns) and the column it writes (None: in place)."""

    model: object
    features: str | None = None
    name: str | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df, *[c for c in (self.features, self.name) if c is not None])


@dataclass
class Stage:
    """How a step is fitted: ``fit`` gets the rows as the steps before have left them."""

    fit: Callable[[DataFrame], object]
    features: str | None = None
    name: str | None = None


@dataclass
class FittedChain:
    """Fitted steps in order. transform() is a projection or a narrow pass per step, on batch and streaming frames alike."""

    steps: list[Step]

    def transform(self, df: DataFrame) -> DataFrame:
        for step in self.steps:
            df = step.transform(df)
        return df

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the steps as one table; what was stored there before is replaced."""
        rows = []
        for number, step in enumerate(self.steps):
            kind, parts = next((k, parts(step.model)) for k, (cls, parts, _) in KINDS.items() if type(step.model) is cls)
            bound = {f"@{k}": v for k, v in (("features", step.features), ("name", step.name)) if v is not None}
            for part, value in {**parts, **bound}.items():
                rows += [(number, kind, part, *slice_) for slice_ in _slices(value)]
        spark.createDataFrame(rows, STORED).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedChain":
        parts: dict[tuple[int, str], dict[str, list]] = {}
        for row in spark.read.parquet(path).collect():
            parts.setdefault((row["step"], row["kind"]), {}).setdefault(row["part"], []).append(row)
        steps = []
        for (_, kind), stored in sorted(parts.items()):
            values = {part: _joined(slices) for part, slices in stored.items()}
            bound = {k: values.pop(f"@{k}", None) for k in ("features", "name")}
            steps.append(Step(KINDS[kind][2](values), **bound))
        return cls(steps)


@dataclass
class Chain:
    """Stages fitted one after the other, each on the rows that the fitted ones before it give."""

    stages: list[Stage]

    def fit(self, df: DataFrame) -> FittedChain:
        steps = []
        for i, stage in enumerate(self.stages):
            steps.append(Step(stage.fit(df), stage.features, stage.name))
            if i + 1 < len(self.stages):
                df = steps[-1].transform(df)
        return FittedChain(steps)


def _slices(value) -> list[tuple]:
    """(type, shape, start, numbers, whole, texts) rows of a value."""
    shape = None if np.isscalar(value) or isinstance(value, str) else list(np.shape(value))
    if isinstance(value, str) or (isinstance(value, list) and all(isinstance(v, str) for v in value)):
        flat, slot, kind = ([value] if isinstance(value, str) else value), 2, "texts"
    else:
        array = np.asarray(value)
        slot, kind = (1, "whole") if array.dtype.kind in "iu" else (0, "numbers")
        flat = array.ravel().tolist()
    out = []
    for start in range(0, max(1, len(flat)), SLICE):
        columns = [None, None, None]
        columns[slot] = flat[start : start + SLICE]
        out.append((kind, shape, start, *columns))
    return out


def _joined(rows: list):
    flat = [v for row in sorted(rows, key=lambda r: r["start"]) for v in row[rows[0]["type"]]]
    kind, shape = rows[0]["type"], rows[0]["shape"]
    if shape is None:
        return flat[0]
    if kind == "texts":
        return flat
    return np.array(flat, dtype=np.int64 if kind == "whole" else float).reshape(shape)


def lattice(spark: SparkSession, columns: list[str], low: list[float], high: list[float], steps: int) -> DataFrame:
    """An even lattice of steps ** len(columns) points over a box, made by tasks: what a decision surface is scored on."""
    axis = lambda i: F.pmod(F.floor(F.col("id") / steps ** (len(columns) - 1 - i)), F.lit(steps))
    step = [(b - a) / (steps - 1) for a, b in zip(low, high)]
    return spark.range(steps ** len(columns)).select(
        *[(F.lit(float(a)) + axis(i) * F.lit(float(d))).alias(c) for i, (c, a, d) in enumerate(zip(columns, low, step))]
    )


# --- stages ----------------------------------------------------------------------------------------------------


def standardise(columns: list[str]) -> Stage:
    return Stage(lambda df: Scaler.standard(df, columns))


def min_max(columns: list[str]) -> Stage:
    return Stage(lambda df: Scaler.min_max(df, columns))


def min_max_array(features: str, dims: int, name: str) -> Stage:
    return Stage(lambda df: ArrayScaler.fit(df, features, dims), features, name)


def process_columns(columns: list[str], name: str = "features", expand: bool = True) -> Stage:
    return Stage(lambda df: ColumnProcessor.fit(df, columns, expand), None, name)


def drop_rows(condition: str) -> Callable[[Stage], Stage]:
    """A stage fitted without the rows for which the condition holds; transform keeps them."""
    return lambda stage: Stage(lambda df: stage.fit(df.where(~F.coalesce(F.expr(condition), F.lit(False)))), stage.features, stage.name)
