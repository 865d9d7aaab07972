"""Regression jobs on lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import metrics as M
from millrace.operators import sampling
from millrace.plans import regression as R
from millrace.queries.common import SEED, SQL_LINEITEM_KEY, SQL_LINEITEM_UNIT, SQL_VECTORS, Registry, lineitem, lineitem_keys, sql_unit, vectors
from millrace.sources.stores import metric_report as report

registry = Registry()


def _parted(spark, folder, size=0.1):
    return sampling.with_split(lineitem(spark, folder), lineitem_keys(), size, SEED)


_PART = f"p AS (SELECT *, {SQL_LINEITEM_UNIT} < 0.1 AS is_test FROM lineitem)"


def _det(m):
    if len(m) == 1:
        return m[0][0]
    parts = []
    for j, head in enumerate(m[0]):
        minor = [row[:j] + row[j + 1 :] for row in m[1:]]
        parts.append(f"{'-' if j % 2 else '+'} {head} * ({_det(minor)})")
    return " ".join(parts).lstrip("+ ")


# Cramer's rule on centred sums: the intercept drops out and three slopes remain.
_S3 = [[f"s{min(i, j)}{max(i, j)}" for j in "abc"] for i in "abc"]


def _cramer(k):
    rows = [[f"s{r}y" if j == k else cell for j, cell in enumerate(_S3[i])] for i, r in enumerate("abc")]
    return f"({_det(rows)}) / ({_det(_S3)})"


_NORMAL = f"""WITH {_PART},
  d AS (SELECT is_test, l_quantity AS a, l_discount AS b, l_tax AS c, l_extendedprice AS y FROM p),
  s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, covar_pop(a, a) AS saa, covar_pop(a, b) AS sab, covar_pop(a, c) AS sac,
               covar_pop(b, b) AS sbb, covar_pop(b, c) AS sbc, covar_pop(c, c) AS scc, covar_pop(a, y) AS say, covar_pop(b, y) AS sby, covar_pop(c, y) AS scy
        FROM d WHERE NOT is_test),
  w AS (SELECT {_cramer(0)} AS wa, {_cramer(1)} AS wb, {_cramer(2)} AS wc, ma, mb, mc, my FROM s)"""


@registry.add(
    "regression_normal_eq",
    f"""{_NORMAL}
        SELECT round(sqrt(avg(pow(my + wa * (a - ma) + wb * (b - mb) + wc * (c - mc) - y, 2))), 3) AS rmse, count(*) AS n
        FROM d, w WHERE is_test""",
)
def regression_normal_eq(spark, folder):
    """One scan gives the train and test Grams, the weights and the held-out error."""
    rows = _parted(spark, folder)
    columns = [F.col(c) for c in ("l_quantity", "l_discount", "l_tax")]
    train, test = R.part_grams(rows, columns, F.col("l_extendedprice"), F.col("is_test"))
    found = R.metric_table(spark, [(test.rmse(R.normal_weights(train)), test.n)], "rmse double, n bigint")
    return found.select(F.round("rmse", 3).alias("rmse"), "n")


@registry.add(
    "regression_scores",
    f"""{_NORMAL}
        SELECT is_test, count(*) AS n, round(avg(my + wa * (a - ma) + wb * (b - mb) + wc * (c - mc)), 3) AS mean_prediction,
               round(sqrt(avg(pow(my + wa * (a - ma) + wb * (b - mb) + wc * (c - mc) - y, 2))), 3) AS rmse FROM d, w GROUP BY 1""",
)
def regression_scores(spark, folder):
    """Scoring as a projection over all rows."""
    rows = _parted(spark, folder)
    model, _ = R.normal_equations(rows, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice")
    scored = model.transform(rows)
    return scored.groupBy("is_test").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("prediction"), 3).alias("mean_prediction"),
        F.round(M.rmse(F.col("prediction"), F.col("l_extendedprice")), 3).alias("rmse"),
    )


@registry.add(
    "ridge_sweep",
    f"""WITH {_PART},
        s AS (SELECT avg(l_discount) AS mx, avg(l_extendedprice) AS my, count(*) AS n, covar_pop(l_discount, l_extendedprice) * count(*) AS sxy,
                     var_pop(l_discount) * count(*) AS sxx FROM p WHERE NOT is_test),
        g AS (SELECT i, exp(ln(0.01::DOUBLE) + i * (ln(10::DOUBLE) - ln(0.01::DOUBLE)) / 499::DOUBLE) AS a FROM range(500) t(i)),
        b AS (SELECT i, a, sxy / (sxx + a) AS b, mx, my FROM s, g),
        t AS (SELECT l_discount AS x, l_extendedprice AS y FROM p WHERE is_test),
        m AS (SELECT count(*) AS n, avg(x) AS tx, avg(y) AS ty, var_pop(x) AS vx, var_pop(y) AS vy, covar_pop(x, y) AS vxy FROM t)
        SELECT i::INT AS step, round(a, 6) AS strength,
               round(sqrt(vy - 2 * b * vxy + b * b * vx + pow(ty - my - b * (tx - mx), 2)), 3) AS rmse FROM b, m""",
)
def ridge_sweep(spark, folder):
    rows = _parted(spark, folder)
    sweep = R.ridge_sweep(rows, [F.col("l_discount")], F.col("l_extendedprice"), F.col("is_test"))
    return sweep.select("step", F.round("strength", 6).alias("strength"), F.round("rmse", 3).alias("rmse"))


@registry.add("ridge_best")
def ridge_best(spark, folder):
    """Best of 500 strengths over four columns."""
    rows = _parted(spark, folder, 0.5)
    columns = [F.col(c) for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")]
    return R.best_of(R.ridge_sweep(rows, columns, F.col("l_extendedprice"), F.col("is_test")), "rmse", "step")


_ORDER2 = f"""WITH {_PART},
  b AS (SELECT min(l_quantity) AS lo, (max(l_quantity) - min(l_quantity)) / 2 AS h FROM p WHERE NOT is_test),
  d AS (SELECT is_test, (l_quantity - lo) / h - 1 AS a, l_extendedprice AS y FROM p, b),
  e AS (SELECT is_test, a, a * a AS b, y FROM d),
  s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my, covar_pop(a, a) AS saa, covar_pop(a, b) AS sab, covar_pop(b, b) AS sbb,
               covar_pop(a, y) AS say, covar_pop(b, y) AS sby FROM e WHERE NOT is_test),
  w AS (SELECT 1 AS o, say / saa AS wa, 0.0::DOUBLE AS wb, ma, mb, my FROM s UNION ALL
        SELECT 2, (say * sbb - sby * sab) / (saa * sbb - sab * sab), (sby * saa - say * sab) / (saa * sbb - sab * sab), ma, mb, my FROM s)"""


@registry.add(
    "order_sweep_two",
    f"""{_ORDER2} SELECT o AS "order", round(sqrt(avg(pow(my + wa * (a - ma) + wb * (b - mb) - y, 2))), 3) AS rmse
        FROM e, w WHERE is_test GROUP BY 1""",
)
def order_sweep_two(spark, folder):
    rows = _parted(spark, folder)
    sweep = R.order_sweep(rows, F.col("l_quantity"), F.col("l_extendedprice"), F.col("is_test"), 2)
    return sweep.select("order", F.round("rmse", 3).alias("rmse"))


@registry.add("order_sweep")
def order_sweep(spark, folder):
    rows = _parted(spark, folder)
    return R.order_sweep(rows, F.col("l_quantity"), F.col("l_extendedprice"), F.col("is_test"), 9)


_GD_STEP = """w0 - 0.1 * ((saa * w0 + sab * w1 + sa * w2 - say) / n + 0.01 * w0) AS w0,
  w1 - 0.1 * ((sab * w0 + sbb * w1 + sb * w2 - sby) / n + 0.01 * w1) AS w1,
  w2 - 0.1 * ((sa * w0 + sb * w1 + n * w2 - sy) / n + 0.01 * w2) AS w2"""
_GD = f"""WITH RECURSIVE {_PART},
  d AS (SELECT is_test, l_quantity / 50 AS a, l_discount * 10 AS b, l_extendedprice / 100000 AS y FROM p),
  s AS (SELECT sum(a * a) AS saa, sum(a * b) AS sab, sum(b * b) AS sbb, sum(a) AS sa, sum(b) AS sb, sum(a * y) AS say, sum(b * y) AS sby,
               sum(y) AS sy, count(*) AS n FROM d WHERE NOT is_test),
  g AS (SELECT 0 AS epoch, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2 UNION ALL
        SELECT epoch + 1, {_GD_STEP} FROM g, s WHERE epoch < 30),
  r AS (SELECT epoch, is_test, sqrt(avg(pow(a * w0 + b * w1 + w2 - y, 2))) AS rmse FROM d, g WHERE epoch > 0 GROUP BY 1, 2)
  SELECT epoch, round(max(CASE WHEN NOT is_test THEN rmse END), 6) AS train_rmse, round(max(CASE WHEN is_test THEN rmse END), 6) AS test_rmse
  FROM r GROUP BY 1"""


def _gd_input(spark, folder):
    rows = _parted(spark, folder)
    columns = [F.col("l_quantity") / 50, F.col("l_discount") * 10]
    return rows, columns, F.col("l_extendedprice") / 100000


@registry.add("linear_gd", _GD)
def linear_gd(spark, folder):
    rows, columns, target = _gd_input(spark, folder)
    _, table = R.linear_gradient(rows, columns, target, F.col("is_test"), epochs=30, rate=0.1, l2=0.01)
    return table.select("epoch", F.round("train_rmse", 6).alias("train_rmse"), F.round("test_rmse", 6).alias("test_rmse"))


_GDB_UNITS = " UNION ALL ".join(
    f"SELECT {e} AS epoch, floor({sql_unit(f'{SEED}-{e}', *SQL_LINEITEM_KEY)} * 10)::INT AS batch, l_quantity / 50 AS a, l_discount * 10 AS b, "
    "l_extendedprice / 100000 AS y FROM p WHERE NOT is_test"
    for e in range(50)
)
_GDB = f"""WITH RECURSIVE {_PART}, d AS (SELECT is_test, l_quantity / 50 AS a, l_discount * 10 AS b, l_extendedprice / 100000 AS y FROM p),
  u AS ({_GDB_UNITS}),
  s AS MATERIALIZED (SELECT epoch * 10 + batch AS at, sum(a * a) AS saa, sum(a * b) AS sab, sum(b * b) AS sbb, sum(a) AS sa, sum(b) AS sb, sum(a * y) AS say,
               sum(b * y) AS sby, sum(y) AS sy, count(*) AS n FROM u GROUP BY 1),
  g AS (SELECT 0 AS step, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2 UNION ALL
        SELECT step + 1, {_GD_STEP.replace('0.01', '0.0')} FROM g JOIN s ON s.at = g.step),
  r AS (SELECT (step // 10)::INT AS epoch, is_test, sqrt(avg(pow(a * w0 + b * w1 + w2 - y, 2))) AS rmse FROM d, g WHERE step > 0 AND step % 10 = 0 GROUP BY 1, 2)
  SELECT epoch, round(max(CASE WHEN NOT is_test THEN rmse END), 6) AS train_rmse, round(max(CASE WHEN is_test THEN rmse END), 6) AS test_rmse
  FROM r GROUP BY 1"""


@registry.add("linear_gd_batches", _GDB)
def linear_gd_batches(spark, folder):
    """Ten seeded mini-batches in each of fifty epochs, all from one scan."""
    rows, columns, target = _gd_input(spark, folder)
    _, table = R.linear_gradient(rows, columns, target, F.col("is_test"), 50, 0.1, 0.0, 10, lineitem_keys(), SEED)
    return table.select("epoch", F.round("train_rmse", 6).alias("train_rmse"), F.round("test_rmse", 6).alias("test_rmse"))


# (2 x z + 1)^2 has the exact map 1, 2 x, 2 x^2.
_KERNEL_STEP = ", ".join(
    f"(w{i} - 0.05 * (s{min(i,0)}{max(i,0)} * w0 + s{min(i,1)}{max(i,1)} * w1 + s{min(i,2)}{max(i,2)} * w2 - c{i}) / n) * (1 - 0.02 * 0.05::DOUBLE) AS w{i}" for i in range(3)
)
_KERNEL = f"""WITH RECURSIVE {_PART},
  d AS (SELECT is_test, 1.0::DOUBLE AS f0, 2 * (l_quantity / 50) AS f1, 2 * (l_quantity / 50) * (l_quantity / 50) AS f2, l_extendedprice / 100000 AS y FROM p),
  m AS (SELECT avg(y) AS bias FROM d WHERE NOT is_test),
  s AS (SELECT {', '.join(f'sum(f{i} * f{j}) AS s{i}{j}' for i in range(3) for j in range(i, 3))},
               {', '.join(f'sum(f{i} * (y - bias)) AS c{i}' for i in range(3))}, count(*) AS n FROM d, m WHERE NOT is_test),
  g AS (SELECT 0 AS iteration, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2 UNION ALL
        SELECT iteration + 1, {_KERNEL_STEP} FROM g, s WHERE iteration < 20),
  r AS (SELECT iteration, is_test, sqrt(avg(pow(f0 * w0 + f1 * w1 + f2 * w2 + bias - y, 2))) AS e FROM d, g, m WHERE iteration > 0 GROUP BY 1, 2)
  SELECT iteration, round(max(CASE WHEN NOT is_test THEN e END), 6) AS train_rmse, round(max(CASE WHEN is_test THEN e END), 6) AS test_rmse
  FROM r GROUP BY 1"""


def _rounded(table, order):
    return table.select(order, F.round("train_rmse", 6).alias("train_rmse"), F.round("test_rmse", 6).alias("test_rmse"))


@registry.add("kernel_regression_poly", _KERNEL)
def kernel_regression_poly(spark, folder):
    rows = _parted(spark, folder)
    made = R.kernel_map("poly", 1, gamma=2.0, degree=2)
    _, _, table = R.kernel_regression(
        rows, F.array(F.col("l_quantity") / 50), F.col("l_extendedprice") / 100000, F.col("is_test"), made, 20, 0.05, 0.02
    )
    return _rounded(table, "iteration")


@registry.add("kernel_regression_rbf")
def kernel_regression_rbf(spark, folder):
    rows = _parted(spark, folder)
    made = R.kernel_map("rbf", 1, gamma=50.0, size=128)
    _, _, table = R.kernel_regression(
        rows, F.array(F.col("l_quantity") / 25 - 1), F.col("l_extendedprice") / 100000, F.col("is_test"), made, 200, 0.01, 0.02
    )
    return _rounded(table, "iteration")


@registry.add("gram_wide", f"""WITH v AS ({SQL_VECTORS}), e AS (SELECT vec_id, generate_subscripts(x, 1) AS i, unnest(x) AS a, label FROM v)
  SELECT (e.i - 1)::INT AS i, (f.i - 1)::INT AS j, round(sum(e.a * f.a), 6) AS g FROM e JOIN e f USING (vec_id) GROUP BY 1, 2""")
def gram_wide(spark, folder):
    from millrace.operators.linalg import gram_wide as wide

    g = wide(vectors(spark, folder), "features", "label")
    rows = [(i, j, round(float(g.xx[i, j]), 6)) for i in range(64) for j in range(64)]
    return spark.createDataFrame(rows, "i INT, j INT, g DOUBLE")


@registry.add(
    "metric_report",
    f"""SELECT 'linear_gd' AS run, epoch, split, 'rmse' AS metric, CASE split WHEN 'train' THEN train_rmse ELSE test_rmse END AS value
        FROM ({_GD}) t, (SELECT unnest(['train', 'test']) AS split) s""",
)
def metric_report(spark, folder):
    """The metrics of a run in long form."""
    return report(linear_gd(spark, folder), "linear_gd", "epoch")
