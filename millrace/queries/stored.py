"""Fitted chains that are written, read back and scored, in batch and as a stream."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import features as FE
from millrace.operators import metrics as M
from millrace.operators import sampling
from millrace.operators.linalg import gram
from millrace.plans import bayes, chain, tree
from millrace.plans import regression as R
from millrace.queries import classification, regression
from millrace.queries.common import SEED, Registry, lineitem, lineitem_keys, vectors
from millrace.session import shared_folder
from millrace.streaming.scoring import score_stream

registry = Registry()
COLUMNS = ["l_quantity", "l_discount", "l_tax"]


def _reloaded(spark: SparkSession, fitted: chain.FittedChain) -> chain.FittedChain:
    """The chain as another application would find it in the shared folder."""
    path = os.path.join(shared_folder(spark), f"model-{uuid.uuid4().hex}")
    fitted.save(spark, path)
    return chain.FittedChain.load(spark, path)


def _linear(train: DataFrame, columns: list[str], target: str) -> R.LinearModel:
    g = gram(train, [*[F.col(c) for c in columns], F.lit(1.0)], F.col(target))
    return R.LinearModel(columns, list(R.normal_weights(g)))


def _errors(scored: DataFrame, model: str) -> DataFrame:
    error = F.round(M.rmse(F.col("prediction"), F.col("l_extendedprice")), 3)
    return scored.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), error.alias("value")).select(F.lit(model).alias("model"), "is_test", "n", "value")


def _hits(scored: DataFrame, model: str, label: str) -> DataFrame:
    share = F.round(M.accuracy(F.col("prediction"), F.col(label)), 6)
    return scored.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), share.alias("value")).select(F.lit(model).alias("model"), "is_test", "n", "value")


_LINEAR_SQL = f"SELECT 'linear' AS model, is_test, n, rmse AS value FROM ({regression.registry.sql['regression_scores']})"
_TREE_SQL = f"SELECT 'tree' AS model, is_test, n, accuracy AS value FROM ({classification.registry.sql['tree_fit_depth']})"
_BAYES_SQL = f"""SELECT 'bayes' AS model, true AS is_test, sum(n)::BIGINT AS n, round(sum(CASE WHEN label = prediction THEN n ELSE 0 END) / sum(n), 6) AS value
  FROM ({classification.registry.sql['nb_gaussian']})"""


@registry.add("stored_model_scores", f"{_LINEAR_SQL} UNION ALL {_TREE_SQL} UNION ALL {_BAYES_SQL}")
def stored_model_scores(spark, folder):
    """A linear model, a tree and a Bayes model, each stored, loaded and then scored."""
    parted = sampling.with_split(lineitem(spark, folder), lineitem_keys(), 0.1, SEED)
    linear = chain.FittedChain([chain.Step(_linear(parted.where("NOT is_test"), COLUMNS, "l_extendedprice"))])
    rows = classification._tree_rows(spark, folder)
    grown = chain.FittedChain([chain.Step(tree.fit_tree(rows.where("NOT is_test"), classification.TREE_COLUMNS, "y", 3, "entropy", max_depth=2))])
    marked = sampling.with_split(vectors(spark, folder), [F.col("vec_id")], 0.25, SEED)
    model = bayes.gaussian_fit(marked.where("NOT is_test"), "features", "label", 0.1, classification.DIMS)
    classes = chain.FittedChain([chain.Step(bayes.DenseBayes.gaussian(model), "features", "prediction")])
    return (
        _errors(_reloaded(spark, linear).transform(parted), "linear")
        .unionByName(_hits(_reloaded(spark, grown).transform(rows), "tree", "y"))
        .unionByName(_hits(_reloaded(spark, classes).transform(marked.where("is_test")), "bayes", "label"))
    )


@registry.add("pipeline_scores", f"{_LINEAR_SQL} UNION ALL {_TREE_SQL}")
def pipeline_scores(spark, folder):
    """Chains of a scaler and a model, fitted as one, stored, loaded and scored.

    Least squares and midpoint trees do not change with the scale of their columns, so the plain fits are the yardstick.
    """
    parted = sampling.with_split(lineitem(spark, folder), lineitem_keys(), 0.1, SEED)
    on_train = chain.drop_rows("is_test")
    linear = chain.Chain([on_train(chain.standardise(COLUMNS)), on_train(chain.Stage(lambda df: _linear(df, COLUMNS, "l_extendedprice")))])
    rows = classification._tree_rows(spark, folder)
    names = classification.TREE_COLUMNS
    grown = chain.Chain([on_train(chain.min_max(names)), on_train(chain.Stage(lambda df: tree.fit_tree(df, names, "y", 3, "entropy", max_depth=2)))])
    return _errors(_reloaded(spark, linear.fit(parted)).transform(parted), "linear").unionByName(
        _hits(_reloaded(spark, grown.fit(rows)).transform(rows), "tree", "y")
    )


@registry.add("stream_scores", _LINEAR_SQL)
def stream_scores(spark, folder):
    """lineitem read as a stream, scored by a stored chain, and written as it arrives."""
    parted = sampling.with_split(lineitem(spark, folder), lineitem_keys(), 0.1, SEED)
    on_train = chain.drop_rows("is_test")
    fitted = chain.Chain([on_train(chain.standardise(COLUMNS)), on_train(chain.Stage(lambda df: _linear(df, COLUMNS, "l_extendedprice")))]).fit(parted)
    # A pattern, since a stream may start from a single file only that way.
    schema = spark.read.parquet(os.path.join(folder, "lineitem.parquet")).schema
    arriving = spark.readStream.schema(schema).parquet(os.path.join(folder, "lineitem.[p]arquet"))
    arriving = sampling.with_split(arriving, lineitem_keys(), 0.1, SEED)
    place = os.path.join(shared_folder(spark), f"stream-{uuid.uuid4().hex}")
    score_stream(_reloaded(spark, fitted), arriving, os.path.join(place, "rows"), os.path.join(place, "log")).awaitTermination()
    return _errors(spark.read.parquet(os.path.join(place, "rows")), "linear")


@registry.add(
    "fitted_surface",
    f"""{regression._NORMAL},
        b AS (SELECT min(a) AS la, max(a) AS ha, min(b) AS lb, max(b) AS hb, min(c) AS lc, max(c) AS hc FROM d WHERE NOT is_test),
        g AS (SELECT i, j, k FROM range(11) x(i), range(11) y(j), range(11) z(k))
        SELECT round(la + i * (ha - la) / 10, 6) AS l_quantity, round(lb + j * (hb - lb) / 10, 6) AS l_discount, round(lc + k * (hc - lc) / 10, 6) AS l_tax,
          round(my + wa * (la + i * (ha - la) / 10 - ma) + wb * (lb + j * (hb - lb) / 10 - mb) + wc * (lc + k * (hc - lc) / 10 - mc), 3) AS prediction
        FROM g, b, w""",
)
def fitted_surface(spark, folder):
    """Least squares fitted here, stored, and scored on a lattice over the range of its train rows."""
    train = sampling.with_split(lineitem(spark, folder), lineitem_keys(), 0.1, SEED).where("NOT is_test")
    fitted = _reloaded(spark, chain.Chain([chain.standardise(COLUMNS), chain.Stage(lambda df: _linear(df, COLUMNS, "l_extendedprice"))]).fit(train))
    scaler = FE.Scaler.min_max(train, COLUMNS)
    high = [a + b for a, b in zip(scaler.shift, scaler.scale)]
    names = [f"{c}_at" for c in COLUMNS]
    points = chain.lattice(spark, COLUMNS, scaler.shift, high, 11).withColumns({n: F.col(c) for n, c in zip(names, COLUMNS)})
    scored = fitted.transform(points)
    return scored.select(*[F.round(n, 6).alias(c) for n, c in zip(names, COLUMNS)], F.round("prediction", 3).alias("prediction"))
