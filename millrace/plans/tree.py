"""Decision tree with exact cuts: one aggregate job grows every open node of a level."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.metrics import impurity
from millrace.operators.ordering import range_edges, running_totals
from millrace.session import cut_lineage

NODE_SCHEMA = "node_id INT, depth INT, feature INT, cut DOUBLE, left INT, right INT, class INT, n BIGINT, impurity DOUBLE"


@dataclass
class Node:
    node_id: int
    depth: int
    counts: list[int]
    impurity: float
    feature: int | None = None
    cut: float | None = None
    left: int | None = None
    right: int | None = None
    split: tuple | None = None  # best known split: (gain, feature, cut, left counts)

    @property
    def majority(self) -> int:
        return self.counts.index(max(self.counts))


@dataclass
class Tree:
    columns: list[str]
    nodes: dict[int, Node] = field(default_factory=dict)

    def route(self, columns: list[Column], leaf) -> Column:
        """Nested CASE from the root; ``leaf(node)`` gives the value at a leaf."""

        def walk(node: Node) -> Column:
            if node.feature is None:
                return F.lit(leaf(node))
            go_left = columns[node.feature] < F.lit(node.cut)
            return F.when(go_left, walk(self.nodes[node.left])).otherwise(walk(self.nodes[node.right]))

        return walk(self.nodes[0])

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Majority class of the leaf; batch or streaming frames."""
        cols = [F.col(c).cast("double") for c in self.columns]
        return df.withColumn(name, self.route(cols, lambda n: n.majority))

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (n.node_id, n.depth, n.feature, n.cut, n.left, n.right, n.majority, sum(n.counts), n.impurity)
            for n in self.nodes.values()
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)


def _impurity_value(counts: list[int], criterion: str) -> float:
    total = sum(counts)
    if not total:
        return 0.0
    if criterion == "gini":
        return total - sum(c * c for c in counts) / total
    return -sum(c * math.log(c / total) for c in counts if c)


def value_counts(rows: DataFrame, columns: list[str], label: str, classes: int) -> DataFrame:
    """Class counts of every (node, feature, value); the map-side combine shrinks repeated values."""
    pairs = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("value")) for i, c in enumerate(columns)])
    long = rows.select("node_id", F.col(label).alias("_y"), F.inline(pairs))
    return long.groupBy("node_id", "feature", "value").agg(
        *[F.sum(F.when(F.col("_y") == k, 1).otherwise(0)).cast("bigint").alias(f"c{k}") for k in range(classes)]
    )


def candidate_splits(counts: DataFrame, totals: DataFrame, classes: int, criterion: str, edges: list) -> DataFrame:
    """Gain and left class counts at every midpoint between neighbouring distinct values."""
    names = [f"c{k}" for k in range(classes)]
    running = running_totals(
        counts, ["node_id", "feature"], ["value"], {f"l{k}": F.col(f"c{k}") for k in range(classes)}, edges, {"next_value": F.col("value")}
    )
    joined = running.where(F.col("next_value").isNotNull()).drop(*names).join(totals, "node_id")
    left = [F.col(f"l{k}") for k in range(classes)]
    right = [F.col(f"t{k}") - F.col(f"l{k}") for k in range(classes)]
    whole = [F.col(f"t{k}") for k in range(classes)]
    gain = impurity(left, criterion) + impurity(right, criterion) - impurity(whole, criterion)
    return joined.select(
        "node_id",
        "feature",
        ((F.col("value") + F.col("next_value")) / 2.0).alias("cut"),
        gain.alias("gain"),
        F.array(*left).alias("left_counts"),
    )


def best_splits(candidates: DataFrame) -> DataFrame:
    """Largest decrease per node; on ties the first feature, then the lowest cut."""
    order = F.struct(F.round("gain", 6).alias("g"), F.col("feature").alias("f"), F.col("cut").alias("c"))
    value = F.struct("gain", "feature", "cut", "left_counts")
    return candidates.groupBy("node_id").agg(F.min_by(value, order).alias("s")).select("node_id", "s.*")


def value_ranges(rows: DataFrame, columns: list[str]) -> list:
    """Ranges over all features' values together; they only bound how much one task sorts."""
    values = F.explode(F.array(*[F.col(c).cast("double") for c in columns]))
    return range_edges(rows.select(values.alias("v")).distinct(), F.col("v"))


class TreeBuilder:
    """Grows a tree; only per-node split choices reach the driver."""

    def __init__(self, df: DataFrame, columns: list[str], label: str, classes: int, criterion: str):
        self.columns, self.label, self.classes, self.criterion = columns, label, classes, criterion
        doubles = [F.col(c).cast("double").alias(c) for c in columns]
        self.rows = df.select(*doubles, F.col(label).cast("int").alias(label)).persist()
        self.edges = value_ranges(self.rows, columns)
        self.tree = Tree(columns)
        self.stored = False

    def _routed(self, open_ids: list[int]) -> DataFrame:
        """Rows of the open nodes with their node id."""
        if self.stored:
            at = self.rows
        else:
            cols = [F.col(c) for c in self.columns]
            at = self.rows.withColumn("node_id", self.tree.route(cols, lambda n: n.node_id))
        if len(open_ids) <= 64:
            return at.where(F.col("node_id").isin(open_ids))
        ids = self.rows.sparkSession.createDataFrame([(i,) for i in open_ids], "node_id INT")
        return at.join(ids, "node_id", "left_semi")

    def store_level(self, level: list[Node]) -> None:
        """Move every row one level down from its stored node and write the result.

        Used once a CASE over all nodes would grow too long; the split table of one level is joined.
        """
        cols = [F.col(c) for c in self.columns]
        if not self.stored:
            at = self.rows.withColumn("node_id", self.tree.route(cols, lambda n: n.node_id))
        else:
            splits = [(n.node_id, n.feature, n.cut, n.left, n.right) for n in level if n.feature is not None]
            table = self.rows.sparkSession.createDataFrame(
                splits, "node_id INT, _feature INT, _cut DOUBLE, _left INT, _right INT"
            )
            value = F.element_at(F.array(*cols), F.col("_feature") + 1)
            side = F.when(value < F.col("_cut"), F.col("_left")).otherwise(F.col("_right"))
            joined = self.rows.join(table, "node_id", "left")
            at = joined.withColumn("node_id", F.coalesce(side, F.col("node_id"))).select(*self.columns, self.label, "node_id")
        self.rows, self.stored = cut_lineage(at), True

    def root(self) -> Node:
        counts = [0] * self.classes
        for row in self.rows.groupBy(self.label).count().collect():
            counts[row[self.label]] = row["count"]
        node = Node(0, 0, counts, _impurity_value(counts, self.criterion))
        self.tree.nodes[0] = node
        return node

    def find_splits(self, nodes: list[Node]) -> None:
        """Best split of each given leaf, all in one job."""
        todo = [n for n in nodes if n.impurity > 1e-12]
        if not todo:
            return
        spark = self.rows.sparkSession
        schema = "node_id INT, " + ", ".join(f"t{k} BIGINT" for k in range(self.classes))
        totals = spark.createDataFrame([(n.node_id, *n.counts) for n in todo], schema)
        counts = value_counts(self._routed([n.node_id for n in todo]), self.columns, self.label, self.classes)
        best = best_splits(candidate_splits(counts, totals, self.classes, self.criterion, self.edges))
        for row in best.collect():
            node = self.tree.nodes[row.node_id]
            node.split = (row.gain, row.feature, row.cut, list(row.left_counts))

    def apply_split(self, node: Node) -> tuple[Node, Node]:
        gain, feature, cut, left_counts = node.split
        right_counts = [t - c for t, c in zip(node.counts, left_counts)]
        made = []
        for counts in (left_counts, right_counts):
            child = Node(len(self.tree.nodes), node.depth + 1, counts, _impurity_value(counts, self.criterion))
            self.tree.nodes[child.node_id] = child
            made.append(child)
        node.feature, node.cut = feature, cut
        node.left, node.right = made[0].node_id, made[1].node_id
        return made[0], made[1]


CASE_NODES = 512  # beyond this many nodes rows are routed once and stored per level


def fit_tree(
    df: DataFrame,
    columns: list[str],
    label: str,
    classes: int,
    criterion: str = "entropy",
    max_depth: int | None = None,
    min_to_split: int | None = None,
    max_leaves: int | None = None,
) -> Tree:
    """Level-wise growth, or best-first up to max_leaves with ties to the earliest node.

    A node is split only if it is shallower than max_depth, holds min_to_split rows, is impure and
    has two distinct values in some column.
    """
    builder = TreeBuilder(df, columns, label, classes, criterion)
    kept = builder.rows
    try:
        root = builder.root()

        def allowed(node: Node) -> bool:
            deep = max_depth is not None and node.depth >= max_depth
            small = min_to_split is not None and sum(node.counts) < min_to_split
            return not deep and not small

        if max_leaves:
            builder.find_splits([n for n in [root] if allowed(n)])
            leaves = [root]
            while len(leaves) < max_leaves:
                ready = [n for n in leaves if n.split is not None]
                if not ready:
                    break
                node = min(ready, key=lambda n: (round(n.split[0], 6), n.node_id))
                children = builder.apply_split(node)
                leaves.remove(node)
                leaves.extend(children)
                if len(leaves) < max_leaves:
                    builder.find_splits([n for n in children if allowed(n)])
        else:
            level = [root]
            while level:
                builder.find_splits([n for n in level if allowed(n)])
                grown = []
                for node in level:
                    if node.split is not None:
                        grown.extend(builder.apply_split(node))
                if len(builder.tree.nodes) > CASE_NODES and grown:
                    builder.store_level(level)
                level = grown
    finally:
        kept.unpersist()
    return builder.tree
