"""Splits, samples, row-level math."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as X
from millrace.functions.hashing import digest
from millrace.operators import sampling
from millrace.operators.ordering import with_rank
from millrace.queries.common import (
    SEED,
    SQL_LINEITEM_KEY,
    SQL_LINEITEM_UNIT,
    SQL_VECTORS,
    Registry,
    documents,
    lineitem,
    lineitem_keys,
    sql_digest,
    sql_unit,
    vectors,
)
from millrace.sources.tables import labelled_documents, lowest_classes, table

registry = Registry()


@registry.add(
    "split_counts",
    f"""SELECT {sql_unit(SEED, 'doc_id')} < 0.25 AS is_test, count(*) AS n, sum(doc_id)::BIGINT AS ids
        FROM documents GROUP BY 1""",
)
def split_counts(spark, folder):
    marked = sampling.with_split(documents(spark, folder), [F.col("doc_id")], 0.25, SEED)
    return marked.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"))


@registry.add(
    "split_counts_lineitem",
    f"""SELECT {SQL_LINEITEM_UNIT} < 0.1 AS is_test, count(*) AS n, sum(l_orderkey)::BIGINT AS keys
        FROM lineitem GROUP BY 1""",
)
def split_counts_lineitem(spark, folder):
    marked = sampling.with_split(lineitem(spark, folder), lineitem_keys(), "0.1", SEED)
    return marked.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@registry.add(
    "split_exact",
    f"""WITH r AS (SELECT l_orderkey, row_number() OVER (ORDER BY {sql_digest(SEED, *SQL_LINEITEM_KEY)}) <= 500 AS is_test
               FROM lineitem)
        SELECT is_test, count(*) AS n, sum(l_orderkey)::BIGINT AS keys FROM r GROUP BY 1""",
)
def split_exact(spark, folder):
    marked = sampling.with_split(lineitem(spark, folder), lineitem_keys(), "500", SEED)
    return marked.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@registry.add(
    "strat_folds",
    """WITH r AS (SELECT vec_id, label, ntile(5) OVER (PARTITION BY label ORDER BY vec_id) - 1 AS fold FROM embeddings)
       SELECT label, fold::INT AS fold, count(*) AS n, sum(vec_id)::BIGINT AS ids FROM r GROUP BY 1, 2""",
)
def strat_folds(spark, folder):
    marked = sampling.with_stratified_fold(vectors(spark, folder), "label", ["vec_id"])
    return marked.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("vec_id").alias("ids"))


_POISSON = " + ".join(
    f"(CASE WHEN u >= {edge!r} THEN 1 ELSE 0 END)"
    for edge in __import__("itertools").accumulate(
        0.36787944117144233 / __import__("math").factorial(k) for k in range(12)
    )
)


@registry.add(
    "bootstrap_totals",
    f"""WITH r AS (
          SELECT o_orderkey, o_totalprice, b AS replicate,
                 ('0x' || substr({sql_digest(SEED, 'o_orderkey', 'b // 4')}, 8 * (b % 4)::INT + 1, 8))::BIGINT / 4294967296::DOUBLE AS u
          FROM orders, range(20) t(b)),
        w AS (SELECT *, {_POISSON} AS weight FROM r)
        SELECT replicate::INT AS replicate, sum(weight)::BIGINT AS weight, sum(weight * o_orderkey)::BIGINT AS keys,
               round(sum(weight * o_totalprice) / sum(weight), 4) AS mean_price
        FROM w GROUP BY 1""",
)
def bootstrap_totals(spark, folder):
    rows = sampling.bootstrap_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"], 20, SEED)
    w = F.col("weight")
    return rows.groupBy("replicate").agg(
        F.sum(w).alias("weight"),
        F.sum(w * F.col("o_orderkey")).alias("keys"),
        F.round(F.sum(w * F.col("o_totalprice")) / F.sum(w), 4).alias("mean_price"),
    )


@registry.add(
    "batch_numbers",
    "SELECT epoch::INT AS epoch, batch::INT AS batch, count(*) AS n, sum(l_orderkey)::BIGINT AS keys FROM (" + " UNION ALL ".join(
        f"SELECT {e} AS epoch, floor({sql_unit(f'{SEED}-{e}', *SQL_LINEITEM_KEY)} * 10) AS batch, l_orderkey FROM lineitem" for e in (0, 1)
    ) + ") GROUP BY 1, 2",
)
def batch_numbers(spark, folder):
    numbers = F.array(*[sampling.batch_number(SEED, e, 10, *lineitem_keys()) for e in (0, 1)])
    rows = lineitem(spark, folder).select("l_orderkey", F.posexplode(numbers).alias("epoch", "batch"))
    return rows.groupBy("epoch", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("keys"))


@registry.add(
    "permutation",
    f"SELECT doc_id, row_number() OVER (ORDER BY {sql_digest(SEED, 'doc_id')}) - 1 AS place FROM documents",
)
def permutation(spark, folder):
    coded = documents(spark, folder).select("doc_id", digest(SEED, F.col("doc_id")).alias("code"))
    return with_rank(coded, [], ["code"], "place").select("doc_id", "place")


@registry.add(
    "pick_rows",
    """SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""",
)
def pick_rows(spark, folder):
    wanted = table(spark, folder, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    rows = sampling.pick_rows(lineitem(spark, folder), wanted, "l_orderkey")
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@registry.add("two_classes", "SELECT label, vec_id FROM embeddings WHERE label IN (2, 7)")
def two_classes(spark, folder):
    return sampling.two_classes(vectors(spark, folder), "label", 2, 7).select("label", "vec_id")


@registry.add("lowest_classes", "SELECT label, count(*) AS n FROM embeddings WHERE label < 3 GROUP BY 1")
def low_classes(spark, folder):
    return lowest_classes(vectors(spark, folder), "label", 3).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@registry.add("first_rows", "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 5")
def first_rows(spark, folder):
    return sampling.first_rows(documents(spark, folder).select("doc_id", "lang", "n_chars"), 5, "doc_id")


@registry.add(
    "labelled_documents",
    """SELECT d.lang, l.toxic, l.quality, count(*) AS n, sum(d.n_chars)::BIGINT AS chars
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2, 3""",
)
def labelled(spark, folder):
    rows = labelled_documents(documents(spark, folder).select("doc_id", "lang", "n_chars"), table(spark, folder, "labels"), "doc_id")
    return rows.groupBy("lang", "toxic", "quality").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@registry.add(
    "label_maps",
    f"""WITH v AS ({SQL_VECTORS})
        SELECT vec_id, (label % 2)::INT AS parity, (2 * (label % 2) - 1)::INT AS plus_minus,
               CASE label WHEN 1 THEN 1 WHEN 4 THEN -1 END AS pair,
               CASE WHEN x[1] >= 0.05 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS bin,
               len(list_append(x, 1.0)) AS width
        FROM v""",
)
def label_maps(spark, folder):
    label = F.col("label")
    return vectors(spark, folder).select(
        "vec_id",
        X.parity(label).cast("int").alias("parity"),
        X.to_plus_minus(X.parity(label)).cast("int").alias("plus_minus"),
        X.pair_label(label, 1, 4).alias("pair"),
        X.binarize(F.col("features")[0], 0.05).alias("bin"),
        F.size(X.with_one(F.col("features"))).cast("bigint").alias("width"),
    )


_E = "exp(x[{0}] - greatest(x[1], x[2], x[3], x[4]))"
_SOFT = "(" + " + ".join(_E.format(i) for i in range(1, 5)) + ")"


@registry.add(
    "activations",
    f"""WITH v AS ({SQL_VECTORS})
        SELECT vec_id, round(1 / (1 + exp(-x[1])), 8) AS sigmoid, round(greatest(x[2], 0), 8) AS relu,
               (CASE WHEN x[2] > 0 THEN 1 ELSE 0 END) AS slope,
               round({_E.format(1)} / {_SOFT}, 8) AS p0, round({_E.format(4)} / {_SOFT}, 8) AS p3,
               (list_position(x[1:4], list_max(x[1:4])) - 1)::INT AS top,
               CASE WHEN x[3] > 0 THEN 1 ELSE -1 END AS side,
               round(greatest(least(x[4], 0.1), -0.1), 8) AS clipped,
               abs(label % 2 - 1 / (1 + exp(-x[1]))) <= 0.5 AS hit
        FROM v""",
)
def activations(spark, folder):
    x = F.col("features")
    head = F.slice(x, 1, 4)
    rows = vectors(spark, folder).withColumn("p", X.softmax(head))
    return rows.select(
        "vec_id",
        F.round(X.sigmoid(x[0]), 8).alias("sigmoid"),
        F.round(X.relu(x[1]), 8).alias("relu"),
        X.relu_slope(x[1]).alias("slope"),
        F.round(F.col("p")[0], 8).alias("p0"),
        F.round(F.col("p")[3], 8).alias("p3"),
        X.argmax(F.col("p")).alias("top"),
        X.sign_label(x[2]).alias("side"),
        F.round(X.clip(x[3], F.lit(-0.1), F.lit(0.1)), 8).alias("clipped"),
        X.probability_hit(X.parity(F.col("label")), X.sigmoid(x[0])).alias("hit"),
    )


_WEIGHTS = [round(0.01 * (i - 32), 2) for i in range(64)]


@registry.add(
    "linear_scores",
    f"""WITH v AS ({SQL_VECTORS}),
        s AS (SELECT vec_id, label, list_dot_product(x, {_WEIGHTS}::DOUBLE[]) + 0.5 AS z FROM v)
        SELECT vec_id, round(z, 6) AS score, CASE WHEN z > 0 THEN 1 ELSE -1 END AS side FROM s""",
)
def linear_scores(spark, folder):
    score = X.linear_score(F.col("features"), _WEIGHTS, 0.5)
    return vectors(spark, folder).select("vec_id", F.round(score, 6).alias("score"), X.sign_label(score).alias("side"))


_CENTRE = """v AS (%s), e AS (SELECT vec_id, label, generate_subscripts(x, 1) AS i, unnest(x) AS a FROM v),
  c AS (SELECT label, i, avg(a) AS m FROM e GROUP BY 1, 2)""" % SQL_VECTORS


def _centred(spark, folder):
    rows = vectors(spark, folder)
    centres = rows.groupBy("label").agg(F.array(*[F.avg(F.col("features")[i]) for i in range(64)]).alias("centre"))
    return rows.join(centres, "label")


@registry.add(
    "lp_distances",
    f"""WITH {_CENTRE}
        SELECT vec_id, round(sum(abs(a - m)), 6) AS l1, round(sqrt(sum((a - m) * (a - m))), 6) AS l2,
               round(pow(sum(pow(abs(a - m), 3)), 1.0::DOUBLE / 3), 6) AS l3
        FROM e JOIN c USING (label, i) GROUP BY 1""",
)
def lp_distances(spark, folder):
    a, b = F.col("features"), F.col("centre")
    return _centred(spark, folder).select("vec_id", *[F.round(X.lp_distance(a, b, p), 6).alias(f"l{p}") for p in (1, 2, 3)])


@registry.add(
    "kernel_values",
    f"""WITH {_CENTRE},
        s AS (SELECT vec_id, sum(a * m) AS d, sum((a - m) * (a - m)) AS q FROM e JOIN c USING (label, i) GROUP BY 1)
        SELECT vec_id, round(pow(2 * d + 1, 3), 6) AS poly, round(exp(-0.5 * q), 6) AS rbf FROM s""",
)
def kernel_values(spark, folder):
    a, b = F.col("features"), F.col("centre")
    return _centred(spark, folder).select(
        "vec_id",
        F.round(X.kernel(a, b, "poly", 2.0, 3), 6).alias("poly"),
        F.round(X.kernel(a, b, "rbf", 0.5), 6).alias("rbf"),
    )


@registry.add(
    "value_grids",
    """WITH b AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi, min(l_extendedprice) AS plo, max(l_extendedprice) AS phi FROM lineitem)
       SELECT i::INT AS step, round(lo + i * (hi - lo) / 200::DOUBLE, 6) AS even,
              round(exp(ln(plo) + i * (ln(phi) - ln(plo)) / 200::DOUBLE), 4) AS geometric
       FROM b, range(201) t(i)""",
)
def value_grids(spark, folder):
    b = lineitem(spark, folder).agg(
        F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"), F.min("l_extendedprice").alias("plo"), F.max("l_extendedprice").alias("phi")
    )
    both = F.arrays_zip(
        X.even_grid(F.col("lo"), F.col("hi"), 201).alias("even"), X.even_grid(F.ln("plo"), F.ln("phi"), 201).alias("logs")
    )
    rows = b.select(F.posexplode(both).alias("step", "g"))
    return rows.select("step", F.round("g.even", 6).alias("even"), F.round(F.exp("g.logs"), 4).alias("geometric"))


@registry.add(
    "decision_surface",
    """WITH b AS (SELECT min(l_quantity) AS a0, max(l_quantity) AS a1, min(l_discount) AS b0, max(l_discount) AS b1 FROM lineitem),
       g AS (SELECT i, j, a0 + i * (a1 - a0) / 49::DOUBLE AS x, b0 + j * (b1 - b0) / 49::DOUBLE AS y FROM b, range(50) s(i), range(50) t(j))
       SELECT i::INT AS i, j::INT AS j, round(1 / (1 + exp(-(0.05 * x - 20 * y + 0.1))), 6) AS p FROM g""",
)
def decision_surface(spark, folder):
    b = lineitem(spark, folder).agg(
        F.min("l_quantity").alias("a0"), F.max("l_quantity").alias("a1"), F.min("l_discount").alias("b0"), F.max("l_discount").alias("b1")
    )
    xs = b.select("b0", "b1", F.posexplode(X.even_grid(F.col("a0"), F.col("a1"), 50)).alias("i", "x"))
    grid = xs.select("i", "x", F.posexplode(X.even_grid(F.col("b0"), F.col("b1"), 50)).alias("j", "y"))
    score = X.linear_score_columns([F.col("x"), F.col("y")], [0.05, -20.0], 0.1)
    return grid.select("i", "j", F.round(X.sigmoid(score), 6).alias("p"))
