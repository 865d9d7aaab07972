"""Margin machines and grids on two columns with targets the table determines; the SQL twins descend to the same optimum."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import metrics as M
from millrace.operators import sampling
from millrace.plans import classification, selection, svm
from millrace.plans.regression import kernel_map
from millrace.queries.common import SEED, SQL_VECTORS, Registry, sql_unit, vectors

registry = Registry()

_V = f"""v AS (SELECT vec_id, 4 * x[1] AS a, 4 * x[2] AS b, {sql_unit(SEED, 'vec_id')} < 0.35 AS is_test FROM ({SQL_VECTORS})),
  d AS (SELECT *, [1, sqrt(2) * a, sqrt(2) * b, a * a, sqrt(2) * a * b, b * b, 1]::DOUBLE[] AS phi,
          (a * b + a / 2 > 0)::INT AS y, CASE WHEN a > 0.3 THEN 0 WHEN b > 0 THEN 1 ELSE 2 END AS k FROM v)"""


def _points(spark, folder, size=0.35):
    marked = sampling.with_split(vectors(spark, folder), [F.col("vec_id")], size, SEED)
    a, b = F.col("features")[0] * 4, F.col("features")[1] * 4
    kind = F.when(F.col("a") > 0.3, 0).when(F.col("b") > 0, 1).otherwise(2)
    rows = marked.select("vec_id", "is_test", a.alias("a"), b.alias("b"))
    return rows.withColumns({"y": (F.col("a") * F.col("b") + F.col("a") / 2 > 0).cast("int"), "k": kind, "features": F.array("a", "b")})


def _descent(width: int, slope: str, shrunk: int, steps: int) -> str:
    """CTE ``best`` (p, w): accelerated descent on the rows r (p, t, phi) with the constants c (p, n, mu, lip).

    ``slope`` is the derivative of a row's loss by its score z; the first ``shrunk`` weights are shrunk by mu.
    """
    zero = f"[{', '.join(['0.0::DOUBLE'] * width)}]"
    step = ", ".join(
        f"any_value(v[{j}]) - ({'any_value(mu * v[%d])' % j if j <= shrunk else '0'} + sum(g * phi[{j}]) / any_value(n)) / any_value(lip)" for j in range(1, width + 1)
    )
    ahead = ", ".join(f"w1[{j}] + m * (w1[{j}] - w[{j}])" for j in range(1, width + 1))
    return f"""it AS (SELECT p, 0 AS i, {zero} AS w, {zero} AS v FROM c
    UNION ALL SELECT p, i + 1, w1, [{ahead}] FROM (
      SELECT p, i, any_value(w) AS w, any_value((sqrt(lip / mu) - 1) / (sqrt(lip / mu) + 1)) AS m, [{step}] AS w1
      FROM (SELECT *, {slope} AS g FROM (SELECT it.p, it.i, it.w, it.v, c.n, c.mu, c.lip, r.t, r.phi, list_dot_product(r.phi, it.v) AS z
                                         FROM it JOIN c ON c.p = it.p JOIN r ON r.p = it.p WHERE it.i < {steps})) GROUP BY p, i)),
  best AS (SELECT p, w FROM it WHERE i = {steps})"""


_HINGE = _descent(7, "-t * greatest(0, least(1, (1 - t * z) / 0.1))", 6, 1500)
_CONSTANTS = "c AS (SELECT p, count(*) AS n, 1 / (0.1 * count(*)) AS mu, avg(list_dot_product(phi, phi)) / 0.1 + 1 / (0.1 * count(*)) AS lip FROM r GROUP BY 1)"
_HINGE_LOSS = """loss AS (SELECT p, avg(s * (u - s * 0.05)) + any_value(mu * list_sum(list_transform(w[1:6], lambda q: q * q)) / 2) AS loss
    FROM (SELECT *, greatest(0, least(1, u / 0.1)) AS s FROM (SELECT r.p, w, mu, 1 - t * list_dot_product(phi, w) AS u FROM r JOIN best ON best.p = r.p JOIN c ON c.p = r.p)) GROUP BY 1)"""


@registry.add(
    "svm_binary_loss",
    f"""WITH RECURSIVE {_V}, r AS (SELECT 1 AS p, 2 * y - 1 AS t, phi FROM d WHERE NOT is_test), {_CONSTANTS}, {_HINGE}, {_HINGE_LOSS}
        SELECT is_test, count(*) AS n, round(avg(((list_dot_product(phi, w) > 0)::INT = y)::INT), 4) AS accuracy, round(any_value(loss), 5) AS loss
        FROM d, best JOIN loss ON loss.p = best.p GROUP BY 1""",
)
def svm_binary_loss(spark, folder):
    """The degree-2 machine of a quadratic boundary: accuracy and the objective reached, a row."""
    rows = _points(spark, folder)
    fitted = svm.fit_pair_machines(rows, F.col("features"), F.col("y"), F.col("is_test"), [(1, 0)], kernel_map("poly", 2, 1.0, 2), 0.1, 1e-6)
    scored = fitted.transform(rows, "features")
    accuracy = F.round(M.accuracy(F.col("prediction"), F.col("y")), 4).alias("accuracy")
    return scored.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), accuracy, F.lit(round(float(fitted.losses[0]), 5)).alias("loss"))


@registry.add(
    "svm_ovo_loss",
    f"""WITH RECURSIVE {_V}, pairs AS (SELECT f * 3 + s AS p, f, s FROM range(3) a(f), range(3) b(s) WHERE f < s),
        r AS (SELECT p, CASE WHEN k = f THEN 1 ELSE -1 END AS t, phi FROM d JOIN pairs ON k = f OR k = s WHERE NOT is_test), {_CONSTANTS}, {_HINGE}, {_HINGE_LOSS},
        votes AS (SELECT vec_id, CASE WHEN list_dot_product(phi, w) > 0 THEN f ELSE s END AS k FROM d, best JOIN pairs ON pairs.p = best.p),
        won AS (SELECT vec_id, k, row_number() OVER (PARTITION BY vec_id ORDER BY count(*) DESC, k) AS place FROM votes GROUP BY 1, 2),
        hit AS (SELECT round(avg((won.k = d.k)::INT) FILTER (NOT is_test), 4) AS train_acc, round(avg((won.k = d.k)::INT) FILTER (is_test), 4) AS test_acc
                FROM won JOIN d ON d.vec_id = won.vec_id WHERE place = 1)
        SELECT f::INT AS first, s::INT AS second, round(loss, 5) AS loss, train_acc, test_acc FROM loss JOIN pairs ON pairs.p = loss.p, hit""",
)
def svm_ovo_loss(spark, folder):
    """Three classes, three machines in the same scans: the objective of each, and the accuracy of their vote."""
    rows = _points(spark, folder)
    pairs = [(0, 1), (0, 2), (1, 2)]
    fitted = svm.fit_pair_machines(rows, F.col("features"), F.col("k"), F.col("is_test"), pairs, kernel_map("poly", 2, 1.0, 2), 0.1, 1e-6)
    hit = fitted.transform(rows, "features").select("is_test", (F.col("prediction") == F.col("k")).cast("int").alias("hit"))
    accuracy = hit.agg(*[F.round(F.avg(F.when(F.col("is_test") == side, F.col("hit"))), 4).alias(n) for n, side in (("train_acc", False), ("test_acc", True))])
    table = [(a, b, round(float(loss), 5)) for (a, b), loss in zip(pairs, fitted.losses)]
    return spark.createDataFrame(table, "first INT, second INT, loss DOUBLE").join(accuracy)  # one row of accuracies


def _grid_sql(degrees: list[int], strengths: list[float], steps: int) -> str:
    parts = {1: "[a, b, 0, 0, 0, 1]", 2: "[a, b, a * a, a * b, b * b, 1]"}
    models = " UNION ALL ".join(
        f"SELECT {(i * len(strengths) + j) * 6} + f AS p, {d} AS degree, {c}::DOUBLE AS strength, f FROM range(6) q(f)"
        for i, d in enumerate(degrees)
        for j, c in enumerate(strengths)
    )
    phi = "CASE degree " + " ".join(f"WHEN {d} THEN {parts[d]}::DOUBLE[]" for d in degrees) + " END"
    return f"""WITH RECURSIVE {_V},
      rows AS (SELECT *, -1 AS fold FROM d WHERE is_test UNION ALL SELECT *, ntile(5) OVER (PARTITION BY y ORDER BY vec_id) - 1 AS fold FROM d WHERE NOT is_test),
      models AS ({models}),
      r AS (SELECT p, y AS t, {phi} AS phi FROM rows, models WHERE fold >= 0 AND fold <> f),
      c AS (SELECT r.p, count(*) AS n, 1 / (any_value(strength) * count(*)) AS mu, avg(list_dot_product(phi, phi)) / 4 + 1 / (any_value(strength) * count(*)) AS lip
            FROM r JOIN models ON models.p = r.p GROUP BY 1),
      {_descent(6, '1 / (1 + exp(-z)) - t', 5, steps)},
      loss AS (SELECT r.p, avg(ln(1 + exp(-z)) + (1 - t) * z) + any_value(mu * list_sum(list_transform(w[1:5], lambda q: q * q)) / 2) AS loss
               FROM (SELECT r.*, w, list_dot_product(r.phi, w) AS z FROM r JOIN best ON best.p = r.p) r JOIN c ON c.p = r.p GROUP BY 1),
      judged AS (SELECT models.p, avg(((list_dot_product({phi}, w) > 0)::INT = y)::INT) AS acc FROM models JOIN best ON best.p = models.p, rows
                 WHERE (f = 5 AND fold = -1) OR (f < 5 AND fold = f) GROUP BY 1),
      shown AS (SELECT degree, strength, avg(acc) FILTER (f < 5) AS cv, any_value(acc) FILTER (f = 5) AS test, any_value(loss) FILTER (f = 5) AS loss
                FROM models JOIN judged ON judged.p = models.p JOIN loss ON loss.p = models.p GROUP BY 1, 2)
      SELECT degree::INT AS degree, strength, round(cv, 4) AS cv_accuracy, round(test, 4) AS test_accuracy, round(loss, 5) AS loss,
        row_number() OVER (ORDER BY round(cv, 9) DESC, degree, strength) = 1 AS best FROM shown"""


def _grid(spark, folder, degrees, strengths):
    rows = _points(spark, folder)
    folded = sampling.with_stratified_fold(rows.where("NOT is_test"), "y", ["vec_id"]).select("features", "y", "fold")
    both = folded.unionByName(rows.where("is_test").select("features", "y", F.lit(-1).alias("fold")))
    done = selection.grid_search(both, F.col("features"), F.col("y"), F.col("fold"), 2, degrees, strengths, 5, 1e-6)
    shown = [F.round(c, places).alias(c) for c, places in (("cv_accuracy", 4), ("test_accuracy", 4), ("loss", 5))]
    return done.select("degree", "strength", *shown, "best")


@registry.add("grid_losses", _grid_sql([1, 2], [0.05, 0.5], 800))
def grid_losses(spark, folder):
    """Two degrees, two strengths, five stratified folds and a refit: 24 models in the same scans, down to the optimum."""
    return _grid(spark, folder, [1, 2], [0.05, 0.5])


@registry.add("grid_single_loss", _grid_sql([2], [0.2], 800))
def grid_single_loss(spark, folder):
    """A grid of one."""
    return _grid(spark, folder, [2], [0.2])


# Mini-batches in an order of their own every epoch, four shards averaged after each


def _epochs_sql(width: int, label: str, rate: float, epochs: int, gradient: str, hit: str) -> str:
    """``gradient`` is a list of ``width`` terms of a row (phi, label, w), ``hit`` tells a right answer."""
    step = ", ".join(f"any_value(w[{j}]) - {rate} * coalesce(sum(g[{j}]) / nullif(count(g), 0), 0)" for j in range(1, width + 1))
    mean = ", ".join(f"sum(n * w[{j}]) OVER (PARTITION BY i) / sum(n) OVER (PARTITION BY i)" for j in range(1, width + 1))
    return f"""WITH RECURSIVE {_V},
      u AS (SELECT vec_id, [a, b, 1.0] AS phi, {label} AS y, is_test, floor({sql_unit(f'{SEED}-shard', 'vec_id')} * 4)::INT AS s FROM d),
      o AS (SELECT e, s, phi, y, (row_number() OVER (PARTITION BY e, s ORDER BY md5(concat_ws('-', '{SEED}-' || e, vec_id)), vec_id) - 1) // 16 AS j
            FROM u, range({epochs}) t(e) WHERE NOT is_test),
      size AS (SELECT max(j) + 1 AS nb FROM o),
      shards AS (SELECT s, count(*) FILTER (NOT is_test) AS n FROM u GROUP BY 1),
      it AS (SELECT s, n, 0 AS i, [{', '.join(['0.0::DOUBLE'] * width)}] AS w FROM shards
        UNION ALL SELECT s, n, i, CASE WHEN i % nb = 0 THEN [{mean}] ELSE w END FROM (
          SELECT s, any_value(n) AS n, i + 1 AS i, any_value(nb) AS nb, [{step}] AS w FROM (
            SELECT it.s, it.n, it.i, it.w, nb, CASE WHEN o.phi IS NOT NULL THEN {gradient} END AS g
            FROM it CROSS JOIN size LEFT JOIN o ON o.s = it.s AND o.e = it.i // nb AND o.j = it.i % nb WHERE it.i < {epochs} * nb) GROUP BY s, i)),
      net AS (SELECT i // nb AS epoch, any_value(w) AS w FROM it, size WHERE i > 0 AND i % nb = 0 GROUP BY 1),
      norm AS (SELECT list_sum(list_transform(w, lambda q: q * q)) AS q FROM net WHERE epoch = {epochs})
      SELECT epoch::INT AS epoch, round(avg(({hit})::INT) FILTER (NOT is_test), 4) AS train_acc, round(avg(({hit})::INT) FILTER (is_test), 4) AS test_acc,
        round(any_value(q), 5) AS squares FROM net, u, norm GROUP BY 1"""


_Z = [f"list_dot_product(phi, [w[{c + 1}], w[{c + 4}], w[{c + 7}]])" for c in range(3)]
_SHARE = [f"(exp({z}) / ({' + '.join(f'exp({q})' for q in _Z)}) - (y = {c})::INT)" for c, z in enumerate(_Z)]
_SOFTMAX_SQL = _epochs_sql(
    9, "k", 0.5, 10, "[" + ", ".join(f"{_SHARE[c]} * phi[{d}]" for d in (1, 2, 3) for c in range(3)) + "]",
    f"y = CASE WHEN {_Z[0]} >= {_Z[1]} AND {_Z[0]} >= {_Z[2]} THEN 0 WHEN {_Z[1]} >= {_Z[2]} THEN 1 ELSE 2 END",
)
_ERROR = "(1 / (1 + exp(-list_dot_product(phi, w))) - y)"
_LOGISTIC_SQL = _epochs_sql(3, "y", 0.5, 9, "[" + ", ".join(f"{_ERROR} * phi[{d}]" for d in (1, 2, 3)) + "]", "y = (list_dot_product(phi, w) > 0)::INT")


def _epochs(spark, folder, label, classes, epochs, start):
    rows = _points(spark, folder)
    net, table = classification.fit_network_averaged(
        rows, F.col("features"), F.col(label), F.col("is_test"), [F.col("vec_id")], 2, [], classes, epochs, 0.5, 16, 4, start=start
    )
    shown = [F.round(c, 4).alias(c) for c in ("train_acc", "test_acc")]
    return table.select("epoch", *shown, F.lit(round(float(net.pack() @ net.pack()), 5)).alias("squares"))


@registry.add("softmax_batches", _SOFTMAX_SQL)
def softmax_batches(spark, folder):
    """Softmax regression in batches of 16, ten epochs."""
    return _epochs(spark, folder, "k", 3, 10, classification.Network.start([2, 3], spread=0.0))


@registry.add("logistic_batches", _LOGISTIC_SQL)
def logistic_batches(spark, folder):
    """Logistic regression in batches of 16, nine epochs."""
    return _epochs(spark, folder, "y", 2, 9, classification.LogisticUnit.zeros(2))
