"""Feature transforms and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as X
from millrace.operators import features as FE
from millrace.operators import metrics as M
from millrace.operators import sampling
from millrace.queries.common import (
    SEED,
    SQL_LINEITEM_UNIT,
    SQL_VECTORS,
    Registry,
    documents,
    lineitem,
    lineitem_keys,
    sql_unit,
    vectors,
)
from millrace.session import cut_lineage
from millrace.sources.tables import table

registry = Registry()

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _parted(spark, folder):
    return sampling.with_split(lineitem(spark, folder), lineitem_keys(), 0.1, SEED)


@registry.add(
    "is_integer_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", bool_and({c} % 1 = 0) AS is_categorical FROM lineitem WHERE {SQL_LINEITEM_UNIT} >= 0.1" for c in NUMERIC
    ),
)
def is_integer_columns(spark, folder):
    return FE.integer_columns(_parted(spark, folder).where("NOT is_test"), NUMERIC)


@registry.add(
    "one_hot_unknown",
    f"""WITH p AS (SELECT floor(p_retailprice / 10)::BIGINT AS band, {sql_unit(SEED, 'p_partkey')} < 0.5 AS is_test FROM part),
        c AS (SELECT band, row_number() OVER (ORDER BY band) - 1 AS idx FROM (SELECT DISTINCT band FROM p WHERE NOT is_test))
        SELECT p.band, idx, count(*) AS n FROM p LEFT JOIN c ON p.band = c.band WHERE is_test GROUP BY 1, 2""",
)
def one_hot_unknown(spark, folder):
    """Price bands that only occur in the test part get no slot."""
    rows = table(spark, folder, "part").select("p_partkey", F.floor(F.col("p_retailprice") / 10).alias("band"))
    marked = sampling.with_split(rows, [F.col("p_partkey")], 0.5, SEED)
    coded = FE.encode_index(marked.where("is_test"), "band", FE.category_index(marked.where("NOT is_test"), "band"))
    return coded.groupBy("band", "idx").agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "one_hot_block",
    """SELECT l_returnflag, sum((l_linenumber = 1)::INT)::DOUBLE AS s0, sum((l_linenumber = 4)::INT)::DOUBLE AS s3,
              sum((l_linenumber = (SELECT max(l_linenumber) FROM lineitem))::INT)::DOUBLE AS last
       FROM lineitem GROUP BY 1""",
)
def one_hot_block(spark, folder):
    rows = lineitem(spark, folder)
    slots = FE.OneHot.fit(rows, "l_linenumber").slots()
    return rows.groupBy("l_returnflag").agg(
        F.round(F.sum(slots[0]), 1).alias("s0"), F.round(F.sum(slots[3]), 1).alias("s3"), F.round(F.sum(slots[-1]), 1).alias("last")
    )


@registry.add(
    "standardize",
    f"""WITH p AS (SELECT *, {SQL_LINEITEM_UNIT} < 0.1 AS is_test FROM lineitem),
        m AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS sa, avg(l_extendedprice) AS b, stddev_pop(l_extendedprice) AS sb,
                     avg(l_tax) AS c, stddev_pop(l_tax) AS sc FROM p WHERE NOT is_test)
        SELECT is_test, l_linenumber, round(avg((l_quantity - a) / sa), 6) AS q, round(avg((l_extendedprice - b) / sb), 6) AS p,
               round(var_pop((l_tax - c) / sc), 6) AS t
        FROM p, m GROUP BY 1, 2""",
)
def standardize(spark, folder):
    rows = _parted(spark, folder)
    scaler = FE.Scaler.standard(rows.where("NOT is_test"), ["l_quantity", "l_extendedprice", "l_tax"])
    return scaler.transform(rows).groupBy("is_test", "l_linenumber").agg(
        F.round(F.avg("l_quantity"), 6).alias("q"), F.round(F.avg("l_extendedprice"), 6).alias("p"), F.round(F.var_pop("l_tax"), 6).alias("t")
    )


@registry.add(
    "min_max",
    f"""WITH p AS (SELECT c_custkey, c_acctbal, 3 AS k, {sql_unit(SEED, 'c_custkey')} < 0.3 AS is_test FROM customer),
        m AS (SELECT min(c_acctbal) AS a, max(c_acctbal) AS b FROM p WHERE NOT is_test)
        SELECT c_custkey, is_test, round((c_acctbal - a) / (b - a), 6) AS scaled, 0.0::DOUBLE AS k FROM p, m""",
)
def min_max(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal", F.lit(3).alias("k"))
    marked = sampling.with_split(rows, [F.col("c_custkey")], 0.3, SEED)
    scaler = FE.Scaler.min_max(marked.where("NOT is_test"), ["c_acctbal", "k"])
    return scaler.transform(marked).select("c_custkey", "is_test", F.round("c_acctbal", 6).alias("scaled"), "k")


@registry.add(
    "min_max_array",
    f"""WITH v AS ({SQL_VECTORS}), e AS (SELECT vec_id, generate_subscripts(x, 1) AS i, unnest(x) AS a FROM v),
        m AS (SELECT i, min(a) AS lo, max(a) AS hi FROM e GROUP BY 1)
        SELECT vec_id, round(sum((a - lo) / (hi - lo)), 6) AS total, round(max((a - lo) / (hi - lo)), 6) AS top
        FROM e JOIN m USING (i) GROUP BY 1""",
)
def min_max_array(spark, folder):
    rows = vectors(spark, folder)
    low, high = FE.array_range(rows, "features", 64)
    scaled = rows.select("vec_id", FE.scale_array(F.col("features"), low, high).alias("s"))
    return scaled.select("vec_id", F.round(X.array_sum(F.col("s")), 6).alias("total"), F.round(F.array_max("s"), 6).alias("top"))


_P = ["l_quantity", "l_discount", "l_tax"]


def _poly_sql(terms):
    return ", ".join(f"round(sum({t}), 4) AS f{i}" for i, t in enumerate(terms))


_TWO = [*_P, *[f"{_P[i]} * {_P[j]}" for i in range(3) for j in range(i, 3)]]


def _sums(rows, cols):
    return rows.groupBy("l_returnflag").agg(*[F.round(F.sum(c), 4).alias(f"f{i}") for i, c in enumerate(cols)])


@registry.add("poly2", f"SELECT l_returnflag, {_poly_sql(_TWO)} FROM lineitem GROUP BY 1")
def poly2(spark, folder):
    return _sums(lineitem(spark, folder), FE.degree_two([F.col(c) for c in _P]))


_THREE = ["1.0::DOUBLE", *_TWO, *[f"{_P[i]} * {_P[j]} * {_P[k]}" for i in range(3) for j in range(i, 3) for k in range(j, 3)]]


@registry.add("poly3_bias", f"SELECT l_returnflag, {_poly_sql(_THREE)} FROM lineitem GROUP BY 1")
def poly3_bias(spark, folder):
    return _sums(lineitem(spark, folder), FE.polynomial([F.col(c) for c in _P], 3, bias=True))


@registry.add(
    "power_features",
    "SELECT l_returnflag, " + ", ".join(f"round(sum(pow(l_quantity / 50, {m})), 6) AS f{m - 1}" for m in range(1, 10)) + " FROM lineitem GROUP BY 1",
)
def power_features(spark, folder):
    rows = lineitem(spark, folder).withColumn("p", X.powers(F.col("l_quantity") / 50.0, 9))
    return rows.groupBy("l_returnflag").agg(*[F.round(F.sum(F.col("p")[m]), 6).alias(f"f{m}") for m in range(9)])


@registry.add(
    "column_processor",
    f"""WITH p AS (SELECT p_partkey, p_size % 3 AS z, p_retailprice AS r, {sql_unit(SEED, 'p_partkey')} < 0.5 AS is_test FROM part),
        m AS (SELECT avg(r) AS a, stddev_pop(r) AS s FROM p WHERE NOT is_test),
        b AS (SELECT p_partkey, is_test, (z = 0)::INT::DOUBLE AS z0, (z = 1)::INT::DOUBLE AS z1, (z = 2)::INT::DOUBLE AS z2, (r - a) / s AS u FROM p, m)
        SELECT p_partkey, is_test, 14 AS width, z0 AS f0, z1 AS f1, z2 AS f2, round(u, 6) AS f3, z0 * z0 AS f4, z0 * z1 AS f5,
               round(z2 * u, 6) + 0.0 AS f12, round(u * u, 6) AS f13
        FROM b""",
)
def column_processor(spark, folder):
    """Remainders 0..2 stand as the integer column, the price as the real one."""
    rows = table(spark, folder, "part").select("p_partkey", (F.col("p_size") % 3).alias("z"), F.col("p_retailprice").alias("r"))
    marked = sampling.with_split(rows, [F.col("p_partkey")], 0.5, SEED)
    done = FE.ColumnProcessor.fit(marked.where("NOT is_test"), ["z", "r"]).transform(marked)
    f = F.col("features")
    return done.select(
        "p_partkey", "is_test", F.size(f).alias("width"), f[0].alias("f0"), f[1].alias("f1"), f[2].alias("f2"),
        F.round(f[3], 6).alias("f3"), f[4].alias("f4"), f[5].alias("f5"), (F.round(f[12], 6) + 0.0).alias("f12"), F.round(f[13], 6).alias("f13"),
    )


@registry.add(
    "l2_normalize",
    f"""WITH v AS ({SQL_VECTORS})
        SELECT vec_id, round(x[1] / sqrt(list_dot_product(x, x)), 8) AS a, round(x[64] / sqrt(list_dot_product(x, x)), 8) AS b FROM v""",
)
def l2_normalize(spark, folder):
    rows = vectors(spark, folder).withColumn("u", X.l2_normalized(F.col("features")))
    return rows.select("vec_id", F.round(F.col("u")[0], 8).alias("a"), F.round(F.col("u")[63], 8).alias("b"))


# Predictions below follow a fixed rule on the row, so that the scores have something to judge.


@registry.add(
    "metric_rmse",
    """SELECT l_returnflag, round(avg(pow(l_quantity * 1500 - l_extendedprice, 2)), 2) AS mse,
              round(sqrt(avg(pow(l_quantity * 1500 - l_extendedprice, 2))), 4) AS rmse FROM lineitem GROUP BY 1""",
)
def metric_rmse(spark, folder):
    p, t = F.col("l_quantity") * 1500, F.col("l_extendedprice")
    return lineitem(spark, folder).groupBy("l_returnflag").agg(F.round(M.mse(p, t), 2).alias("mse"), F.round(M.rmse(p, t), 4).alias("rmse"))


def _judged(spark, folder):
    predicted = F.when(F.col("features")[0] > 0.1, F.col("label")).otherwise(F.col("vec_id") % 10).cast("int")
    return vectors(spark, folder).select("vec_id", "label", "features", predicted.alias("pred"))


_JUDGED = f"j AS (SELECT vec_id, label, x, CASE WHEN x[1] > 0.1 THEN label ELSE vec_id % 10 END AS pred FROM ({SQL_VECTORS}))"


@registry.add("metric_accuracy", f"WITH {_JUDGED} SELECT label, round(avg((pred = label)::INT), 6) AS accuracy, count(*) AS n FROM j GROUP BY 1")
def metric_accuracy(spark, folder):
    rows = _judged(spark, folder).groupBy("label")
    return rows.agg(F.round(M.accuracy(F.col("pred"), F.col("label")), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


_COUNTS = f"""WITH {_JUDGED}, c AS (SELECT label AS k FROM j UNION SELECT pred FROM j),
  n AS (SELECT k, (SELECT count(*) FROM j WHERE pred = k AND label = k) AS tp, (SELECT count(*) FROM j WHERE pred = k AND label <> k) AS fp,
               (SELECT count(*) FROM j WHERE pred <> k AND label = k) AS fn FROM c)"""


@registry.add("class_counts", f"{_COUNTS} SELECT k::INT AS class, tp, fp, fn FROM n")
def class_counts(spark, folder):
    return M.class_counts(_judged(spark, folder), "pred", "label")


@registry.add("metric_macro_f1", f"{_COUNTS} SELECT round(avg(2.0::DOUBLE * tp / (2.0::DOUBLE * tp + fp + fn)), 6) AS macro_f1 FROM n")
def metric_macro_f1(spark, folder):
    return M.macro_f1(_judged(spark, folder), "pred", "label").select(F.round("macro_f1", 6).alias("macro_f1"))


@registry.add(
    "metric_f1",
    """WITH j AS (SELECT l_linestatus, (l_quantity > 25)::INT AS p, (l_returnflag = 'R')::INT AS t FROM lineitem)
       SELECT l_linestatus, round(2.0::DOUBLE * sum(p * t) / (2.0::DOUBLE * sum(p * t) + sum((p <> t)::INT)), 6) AS f1 FROM j GROUP BY 1""",
)
def metric_f1(spark, folder):
    p, t = (F.col("l_quantity") > 25).cast("int"), (F.col("l_returnflag") == "R").cast("int")
    return lineitem(spark, folder).groupBy("l_linestatus").agg(F.round(M.binary_f1(p, t), 6).alias("f1"))


@registry.add(
    "metric_logloss",
    f"""WITH v AS ({SQL_VECTORS}), p AS (SELECT label % 2 AS t, 1 / (1 + exp(-5 * x[1])) AS p, x, label FROM v),
        s AS (SELECT t, p, exp(x[1 + label]) / (exp(x[1]) + exp(x[2]) + exp(x[3]) + exp(x[4]) + exp(x[5]) + exp(x[6]) + exp(x[7]) + exp(x[8]) + exp(x[9]) + exp(x[10])) AS q FROM p)
        SELECT round(-avg(t * ln(p) + (1 - t) * ln(1 - p)), 6) AS binary_loss, round(-avg(ln(q)), 6) AS class_loss FROM s""",
)
def metric_logloss(spark, folder):
    x = F.col("features")
    rows = vectors(spark, folder).withColumn("q", X.softmax(F.slice(x, 1, 10)))
    return rows.agg(
        F.round(M.binary_log_loss(X.parity(F.col("label")), X.sigmoid(5 * x[0])), 6).alias("binary_loss"),
        F.round(M.class_log_loss(F.col("q"), F.col("label")), 6).alias("class_loss"),
    )


@registry.add("pearson", "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r, round(avg(l_tax), 6) AS m FROM lineitem GROUP BY 1")
def pearson(spark, folder):
    return lineitem(spark, folder).groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"), F.round(F.avg("l_tax"), 6).alias("m"))


@registry.add(
    "majority_class",
    """WITH c AS (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2),
       r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) AS k FROM c)
       SELECT l_suppkey, l_returnflag AS top FROM r WHERE k = 1""",
)
def majority_class(spark, folder):
    return lineitem(spark, folder).groupBy("l_suppkey").agg(M.majority(F.col("l_returnflag")).alias("top"))


@registry.add(
    "weighted_vote",
    """WITH c AS (SELECT l_partkey, l_linenumber, round(sum(l_discount), 9) AS w FROM lineitem GROUP BY 1, 2),
       r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY w DESC, l_linenumber) AS k FROM c)
       SELECT l_partkey, l_linenumber AS prediction FROM r WHERE k = 1""",
)
def weighted_vote(spark, folder):
    return M.weighted_vote(lineitem(spark, folder), "l_partkey", "l_linenumber", F.col("l_discount"))


@registry.add(
    "impurity",
    """WITH c AS (SELECT l_linenumber, sum((l_returnflag = 'A')::INT) AS a, sum((l_returnflag = 'N')::INT) AS b, sum((l_returnflag = 'R')::INT) AS c FROM lineitem GROUP BY 1)
       SELECT l_linenumber, round(a + b + c - (a * a + b * b + c * c) / (a + b + c)::DOUBLE, 4) AS gini,
              round(-(a * ln(a / (a + b + c)::DOUBLE) + b * ln(b / (a + b + c)::DOUBLE) + c * ln(c / (a + b + c)::DOUBLE)), 4) AS entropy FROM c""",
)
def impurity(spark, folder):
    counts = lineitem(spark, folder).groupBy("l_linenumber").agg(
        *[F.sum((F.col("l_returnflag") == f).cast("bigint")).alias(f) for f in "ANR"]
    )
    c = [F.col(f) for f in "ANR"]
    return counts.select("l_linenumber", F.round(M.impurity(c, "gini"), 4).alias("gini"), F.round(M.impurity(c), 4).alias("entropy"))


@registry.add(
    "hourly_counts",
    """SELECT hour(ts)::INT AS hour, dayofweek(ts)::INT + 1 AS day_of_week, count(*) AS rentals, round(avg(value), 4) AS mean_value
       FROM events GROUP BY 1, 2""",
)
def hourly_counts(spark, folder):
    """Events in the calendar columns of the rental schema."""
    rows = table(spark, folder, "events")
    return rows.groupBy(F.hour("ts").alias("hour"), F.dayofweek("ts").alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("rentals"), F.round(F.avg("value"), 4).alias("mean_value")
    )


@registry.add(
    "class_number",
    "SELECT (max(label) + 1)::INT AS classes FROM embeddings",
)
def class_number(spark, folder):
    return vectors(spark, folder).agg((F.max("label") + 1).cast("int").alias("classes"))


@registry.add("language_counts", "SELECT lang, count(*) AS n, min_by(doc_id, (n_chars, doc_id)) AS shortest FROM documents GROUP BY 1")
def language_counts(spark, folder):
    """Extreme with its first position."""
    rows = documents(spark, folder).groupBy("lang")
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min_by("doc_id", F.struct("n_chars", "doc_id")).alias("shortest"))


_WIDE = """c AS (SELECT l_orderkey, dense_rank() OVER (ORDER BY l_orderkey) - 1 AS i FROM (SELECT DISTINCT l_orderkey FROM lineitem)),
  k AS (SELECT l_linenumber, dense_rank() OVER (ORDER BY l_linenumber) - 1 AS i FROM (SELECT DISTINCT l_linenumber FROM lineitem)),
  m AS (SELECT (SELECT count(*) FROM c) AS nc, (SELECT count(*) FROM k) AS nk, avg(l_tax) AS mu, stddev_pop(l_tax) AS sd FROM lineitem),
  x AS (SELECT l.l_linenumber, c.i AS i, nc + k.i AS j, nc + nk AS t, nc + nk + 1 AS d, (l_tax - mu) / sd AS z
        FROM lineitem l JOIN c ON c.l_orderkey = l.l_orderkey JOIN k ON k.l_linenumber = l.l_linenumber, m),
  e AS (SELECT l_linenumber, unnest([i, j, t, d + i * d - i * (i - 1) // 2, d + i * d - i * (i - 1) // 2 + j - i, d + i * d - i * (i - 1) // 2 + t - i,
                 d + j * d - j * (j - 1) // 2, d + j * d - j * (j - 1) // 2 + t - j, d + t * d - t * (t - 1) // 2]) AS slot,
               unnest([1, 1, z, 1, 1, z, 1, z, z * z]) AS v FROM x)"""


def _narrowed(rows, name):
    """Few rows with an exact sum as BIGINT, as in SQL, or as the decimal it is where one does not fit 64 bits."""
    rows = cut_lineage(rows)
    wide = rows.where(F.col(name).isNotNull() & F.expr(f"try_cast({name} AS BIGINT)").isNull())
    return rows if wide.take(1) else rows.withColumn(name, F.col(name).cast("bigint"))


def _slot_sums(long):
    rows = long.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("set_slots"),
        X.exact_sum(F.col("slots")).alias("slot_sum"),
        F.max("slots").alias("last_slot"),
        F.round(F.sum("values"), 3).alias("value_sum"),
    )
    return _narrowed(rows, "slot_sum")


@registry.add(
    "sparse_columns",
    f"""WITH {_WIDE} SELECT l_linenumber, count(*) AS set_slots, sum(slot)::BIGINT AS slot_sum, max(slot)::BIGINT AS last_slot, round(sum(v), 3) AS value_sum
        FROM e WHERE v <> 0 GROUP BY 1""",
)
def sparse_columns(spark, folder):
    """Every order key a category, line numbers too, tax scaled, products of degree two: set slots only."""
    rows = lineitem(spark, folder).select("l_orderkey", "l_linenumber", "l_tax")
    done = FE.SparseColumns.fit(rows, ["l_orderkey", "l_linenumber", "l_tax"]).transform(rows)
    long = done.select("l_linenumber", F.explode(F.arrays_zip("slots", "values")).alias("p")).select("l_linenumber", "p.slots", "p.values")
    return _slot_sums(long)
