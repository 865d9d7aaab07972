"""Classifiers on embeddings, documents and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import columns as X
from millrace.functions.strings import long_word_tokens
from millrace.operators import features as FE
from millrace.operators import metrics as M
from millrace.operators import neighbors as NB
from millrace.operators import sampling, textstats
from millrace.plans import bayes, classification, correlation, selection, svm, tree
from millrace.plans.regression import kernel_map
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
DIMS = 64


def _vectors(spark, folder, size=0.25):
    return sampling.with_split(vectors(spark, folder), [F.col("vec_id")], size, SEED)


_V = f"v AS (SELECT *, {sql_unit(SEED, 'vec_id')} < 0.25 AS is_test FROM ({SQL_VECTORS}))"
_E = f"{_V}, e AS (SELECT vec_id, label, is_test, generate_subscripts(x, 1) AS i, unnest(x) AS a FROM v)"
_BEST = """b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 9) DESC, k) AS place FROM sc)
  SELECT label, k::INT AS prediction, count(*) AS n FROM b WHERE place = 1 GROUP BY 1, 2"""


def _confusion(predicted, label="label"):
    return predicted.groupBy(label, "prediction").agg(F.count(F.lit(1)).alias("n"))


# Naive Bayes


@registry.add(
    "nb_gaussian",
    f"""WITH {_E},
        m AS (SELECT label AS k, i, avg(a) AS mu, var_pop(a) + 0.1 AS s2 FROM e WHERE NOT is_test GROUP BY 1, 2),
        p AS (SELECT label AS k, ln(count(*) / (SELECT count(*) FROM v WHERE NOT is_test)) AS lp FROM v WHERE NOT is_test GROUP BY 1),
        sc AS (SELECT vec_id, any_value(label) AS label, m.k, any_value(lp) + sum(-0.5 * ln(2 * pi() * s2) - (a - mu) * (a - mu) / (2 * s2)) AS s
               FROM e JOIN m USING (i) JOIN p ON p.k = m.k WHERE is_test GROUP BY vec_id, m.k), {_BEST}""",
)
def nb_gaussian(spark, folder):
    rows = _vectors(spark, folder)
    model = bayes.gaussian_fit(rows.where("NOT is_test"), "features", "label", 0.1, DIMS)
    return _confusion(bayes.gaussian_predict(model, rows.where("is_test"), "features"))


_BIN = _E.replace("unnest(x) AS a", "(unnest(x) >= 0.02)::INT AS a")


@registry.add(
    "nb_bernoulli_dense",
    f"""WITH {_BIN},
        n AS (SELECT label AS k, count(*) AS n, ln(count(*) / (SELECT count(*) FROM v WHERE NOT is_test)) AS lp FROM v WHERE NOT is_test GROUP BY 1),
        m AS (SELECT n.k, i, (sum(a) + 0.1) / (any_value(n) + 0.2) AS p FROM e JOIN n ON n.k = label WHERE NOT is_test GROUP BY 1, 2),
        sc AS (SELECT vec_id, any_value(label) AS label, m.k, any_value(lp) + sum(a * ln(p / (1 - p)) + ln(1 - p)) AS s
               FROM e JOIN m USING (i) JOIN n ON n.k = m.k WHERE is_test GROUP BY vec_id, m.k), {_BEST}""",
)
def nb_bernoulli_dense(spark, folder):
    ones = F.transform("features", lambda v: X.binarize(v, 0.02))
    rows = _vectors(spark, folder).withColumn("features", ones)
    model = bayes.dense_bernoulli_fit(rows.where("NOT is_test"), "features", "label", 0.1, DIMS)
    return _confusion(bayes.dense_predict(model, rows.where("is_test"), "features"))


_SHIFT = _E.replace("unnest(x) AS a", "unnest(x) + 1 AS a")


@registry.add(
    "nb_multinomial_dense",
    f"""WITH {_SHIFT},
        n AS (SELECT label AS k, ln(count(*) / (SELECT count(*) FROM v WHERE NOT is_test)) AS lp FROM v WHERE NOT is_test GROUP BY 1),
        t AS (SELECT label AS k, sum(a) AS total FROM e WHERE NOT is_test GROUP BY 1),
        m AS (SELECT label AS k, i, (sum(a) + 0.1) / (any_value(total) + 0.1 * 64) AS p FROM e JOIN t ON t.k = label WHERE NOT is_test GROUP BY 1, 2),
        sc AS (SELECT vec_id, any_value(label) AS label, m.k, any_value(lp) + sum(a * ln(p)) AS s
               FROM e JOIN m USING (i) JOIN n ON n.k = m.k WHERE is_test GROUP BY vec_id, m.k), {_BEST}""",
)
def nb_multinomial_dense(spark, folder):
    """Features shifted by one, since the multinomial model counts."""
    rows = _vectors(spark, folder).withColumn("features", F.transform("features", lambda v: v + 1.0))
    model = bayes.dense_multinomial_fit(rows.where("NOT is_test"), "features", "label", 0.1, DIMS)
    return _confusion(bayes.dense_predict(model, rows.where("is_test"), "features"))


def _doc_terms(spark, folder):
    docs = documents(spark, folder).join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
    marked = sampling.with_split(docs.select("doc_id", "text", "quality"), [F.col("doc_id")], 0.5, SEED)
    terms = textstats.term_counts(marked, "doc_id", long_word_tokens(F.col("text")), "quality", "is_test")
    return marked.select("doc_id", "quality", "is_test"), terms.withColumnRenamed("tf_count", "cnt")


_DT = f"""d AS (SELECT d.doc_id, text, quality, {sql_unit(SEED, 'd.doc_id')} < 0.5 AS is_test FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
  w AS (SELECT doc_id, quality, is_test, unnest(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM d),
  t AS (SELECT doc_id, quality, is_test, term, count(*) AS cnt FROM w GROUP BY ALL),
  vocab AS (SELECT term FROM t WHERE NOT is_test GROUP BY 1 HAVING sum(cnt) > 1),
  tv AS (SELECT t.* FROM t JOIN vocab USING (term)),
  pr AS (SELECT quality AS k, count(*) AS n, ln(count(*) / (SELECT count(*) FROM d WHERE NOT is_test)) AS lp FROM d WHERE NOT is_test GROUP BY 1)"""
_DBEST = """b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(s, 9) DESC, k) AS place FROM sc)
  SELECT quality, k::INT AS prediction, count(*) AS n FROM b WHERE place = 1 GROUP BY 1, 2"""


def _sparse_nb(spark, folder, fit, count):
    docs, terms = _doc_terms(spark, folder)
    train_terms, vocab = terms.where("NOT is_test"), None
    vocab = train_terms.groupBy("term").agg(F.sum("cnt").alias("c")).where("c > 1").select("term")
    known = cut_lineage(terms.join(vocab, "term", "left_semi"))  # read by the fit, its totals and the scoring
    classes, weights = fit(known.where("NOT is_test"), docs.where("NOT is_test"), "quality", 0.1, vocab)
    scored = bayes.sparse_predict(classes, weights, known.where("is_test"), docs.where("is_test"), "doc_id", count)
    return _confusion(scored, "quality")


@registry.add(
    "nb_multinomial",
    f"""WITH {_DT},
        tot AS (SELECT quality AS k, sum(cnt) AS total FROM tv WHERE NOT is_test GROUP BY 1),
        m AS (SELECT pr.k, vocab.term, ln((coalesce(c, 0) + 0.1) / (total + 0.1 * (SELECT count(*) FROM vocab))) AS lw
              FROM pr CROSS JOIN vocab JOIN tot ON tot.k = pr.k
              LEFT JOIN (SELECT quality AS k, term, sum(cnt) AS c FROM tv WHERE NOT is_test GROUP BY 1, 2) s ON s.k = pr.k AND s.term = vocab.term),
        sc AS (SELECT d.doc_id, any_value(d.quality) AS quality, pr.k, any_value(lp) + coalesce(sum(cnt * lw), 0) AS s
               FROM d CROSS JOIN pr LEFT JOIN tv ON tv.doc_id = d.doc_id LEFT JOIN m ON m.k = pr.k AND m.term = tv.term WHERE d.is_test GROUP BY d.doc_id, pr.k), {_DBEST}""",
)
def nb_multinomial(spark, folder):
    return _sparse_nb(spark, folder, bayes.multinomial_fit, F.col("cnt"))


@registry.add(
    "nb_bernoulli",
    f"""WITH {_DT},
        m AS (SELECT pr.k, vocab.term, (coalesce(c, 0) + 0.1) / (n + 0.2) AS p
              FROM pr CROSS JOIN vocab
              LEFT JOIN (SELECT quality AS k, term, count(*) AS c FROM tv WHERE NOT is_test GROUP BY 1, 2) s ON s.k = pr.k AND s.term = vocab.term),
        z AS (SELECT k, sum(ln(1 - p)) AS z FROM m GROUP BY 1),
        sc AS (SELECT d.doc_id, any_value(d.quality) AS quality, pr.k, any_value(lp) + any_value(z) + coalesce(sum(ln(p / (1 - p))), 0) AS s
               FROM d CROSS JOIN pr JOIN z ON z.k = pr.k LEFT JOIN tv ON tv.doc_id = d.doc_id LEFT JOIN m ON m.k = pr.k AND m.term = tv.term
               WHERE d.is_test GROUP BY d.doc_id, pr.k), {_DBEST}""",
)
def nb_bernoulli(spark, folder):
    return _sparse_nb(spark, folder, bayes.bernoulli_fit, F.lit(1))


# Gradient classifiers; the SQL twins unroll the steps from zero weights.


def _logistic_sql(steps, rate):
    parts = [
        f"""v AS (SELECT vec_id, label % 2 AS t, list_append(x, 1.0::DOUBLE) AS x, {sql_unit(SEED, 'vec_id')} < 0.25 AS is_test FROM ({SQL_VECTORS}))""",
        "w0 AS (SELECT [0.0::DOUBLE for q in range(65)] AS w)",
    ]
    for s in range(steps + 1):
        parts.append(f"p{s} AS MATERIALIZED (SELECT vec_id, t, x, is_test, 1 / (1 + exp(-list_dot_product(x, w))) AS p FROM v, w{s})")
        if s < steps:
            parts.append(
                f"""g{s} AS (SELECT i, sum((p - t) * a) / any_value(n) AS g FROM
                    (SELECT p, t, generate_subscripts(x, 1) AS i, unnest(x) AS a FROM p{s} WHERE NOT is_test), (SELECT count(*) AS n FROM v WHERE NOT is_test) GROUP BY 1)"""
            )
            parts.append(f"w{s + 1} AS (SELECT list(w[i] - {rate} * g ORDER BY i) AS w FROM g{s}, w{s})")
    loss = "-avg(t * ln(p) + (1 - t) * ln(1 - p)) FILTER ({c})"
    acc = "avg((abs(t - p) <= 0.5)::INT) FILTER ({c})"
    rows = [
        f"SELECT {s}::INT AS step, round({loss.format(c='NOT is_test')}, 6) AS train_loss, round({acc.format(c='NOT is_test')}, 6) AS train_acc, "
        f"round({loss.format(c='is_test')}, 6) AS test_loss, round({acc.format(c='is_test')}, 6) AS test_acc FROM p{s}"
        for s in range(steps + 1)
    ]
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(rows)


_METRICS = ["train_loss", "train_acc", "test_loss", "test_acc"]


def _six(frame, order, names):
    return frame.select(order, *[F.round(n, 6).alias(n) for n in names])


@registry.add("logistic_gd", _logistic_sql(3, 2.0))
def logistic_gd(spark, folder):
    rows = _vectors(spark, folder)
    _, metrics = classification.logistic_gradient(rows, F.col("features"), X.parity(F.col("label")), F.col("is_test"), DIMS, 3, 2.0)
    return _six(metrics, "step", _METRICS)


def _softmax_sql(steps, rate):
    parts = [
        f"""v AS (SELECT vec_id, label, list_append(x, 1.0::DOUBLE) AS x, {sql_unit(SEED, 'vec_id')} < 0.25 AS is_test FROM ({SQL_VECTORS}))""",
        "w0 AS (SELECT k, [0.0::DOUBLE for q in range(65)] AS w FROM range(10) r(k))",
    ]
    for s in range(steps + 1):
        parts.append(f"z{s} AS MATERIALIZED (SELECT vec_id, label, is_test, k, list_dot_product(x, w) AS z FROM v, w{s})")
        parts.append(f"m{s} AS (SELECT vec_id, max(z) AS m FROM z{s} GROUP BY 1)")
        parts.append(f"e{s} AS (SELECT vec_id, sum(exp(z - m)) AS e FROM z{s} JOIN m{s} USING (vec_id) GROUP BY 1)")
        parts.append(f"p{s} AS MATERIALIZED (SELECT vec_id, label, is_test, k, exp(z - m) / e AS p FROM z{s} JOIN m{s} USING (vec_id) JOIN e{s} USING (vec_id))")
        parts.append(
            f"""r{s} AS (SELECT vec_id, any_value(label) AS label, any_value(is_test) AS is_test, max(CASE WHEN k = label THEN p END) AS pt,
                arg_min(k, (-round(p, 12), k)) AS top FROM p{s} GROUP BY 1)"""
        )
        if s < steps:
            parts.append(
                f"""g{s} AS (SELECT k, i, sum((p - (k = label)::INT) * a) / any_value(n) AS g FROM
                    (SELECT p, k, p{s}.label, generate_subscripts(x, 1) AS i, unnest(x) AS a FROM p{s} JOIN v USING (vec_id) WHERE NOT v.is_test),
                    (SELECT count(*) AS n FROM v WHERE NOT is_test) GROUP BY 1, 2)"""
            )
            parts.append(f"w{s + 1} AS (SELECT k, list(w[i] - {rate} * g ORDER BY i) AS w FROM g{s} JOIN w{s} USING (k) GROUP BY 1)")
    rows = [
        f"""SELECT {s}::INT AS step, round(-avg(ln(pt)) FILTER (NOT is_test), 6) AS train_loss, round(avg((top = label)::INT) FILTER (NOT is_test), 6) AS train_acc,
            round(-avg(ln(pt)) FILTER (is_test), 6) AS test_loss, round(avg((top = label)::INT) FILTER (is_test), 6) AS test_acc FROM r{s}"""
        for s in range(steps + 1)
    ]
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(rows)


@registry.add("softmax_gd", _softmax_sql(2, 5.0))
def softmax_gd(spark, folder):
    rows = _vectors(spark, folder)
    _, metrics = classification.softmax_gradient(rows, F.col("features"), F.col("label"), F.col("is_test"), DIMS, 10, 2, 5.0)
    return _six(metrics, "step", _METRICS)


def _perceptron_sql(passes):
    parts = [
        f"v AS (SELECT vec_id, 2 * (label % 2) - 1 AS t, list_append(x, 1.0::DOUBLE) AS x FROM ({SQL_VECTORS}))",
        "w1 AS (SELECT [0.0::DOUBLE for q in range(65)] AS w)",
    ]
    for s in range(1, passes + 1):
        parts.append(f"b{s} AS MATERIALIZED (SELECT t, x FROM v, w{s} WHERE t * list_dot_product(x, w) <= 0)")
        parts.append(f"g{s} AS (SELECT i, sum(t * a) AS g FROM (SELECT t, generate_subscripts(x, 1) AS i, unnest(x) AS a FROM b{s}) GROUP BY 1)")
        parts.append(f"w{s + 1} AS (SELECT list(w[i] + g ORDER BY i) AS w FROM g{s}, w{s})")
    rows = [f"SELECT {s}::INT AS pass, count(*) AS errors FROM b{s}" for s in range(1, passes + 1)]
    return "WITH " + ", ".join(parts) + " " + " UNION ALL ".join(rows)


@registry.add("perceptron_batch", _perceptron_sql(4))
def perceptron_batch(spark, folder):
    label = X.to_plus_minus(X.parity(F.col("label")))
    return classification.perceptron(vectors(spark, folder), F.col("features"), label, DIMS, 4)[1]


@registry.add("mlp_gd")
def mlp_gd(spark, folder):
    """One hidden ReLU layer, four seeded batches per epoch."""
    _, metrics = classification.fit_network(
        _vectors(spark, folder), F.col("features"), F.col("label"), F.col("is_test"), [F.col("vec_id")], DIMS, [20], 10, 3, 1.0, 4
    )
    return _six(metrics, "epoch", ["train_acc", "test_acc"])


@registry.add("mlp_averaged")
def mlp_averaged(spark, folder):
    """Two hidden layers, sequential Adam passes per shard averaged per epoch."""
    _, metrics = classification.fit_network_averaged(
        _vectors(spark, folder), F.col("features"), F.col("label"), F.col("is_test"), [F.col("vec_id")], DIMS, [32, 16], 10, 5, 0.01, 16, 4, "adam"
    )
    return _six(metrics, "epoch", ["train_acc", "test_acc"])


# Neighbours


_WEIGHT = {
    "uniform": "1.0::DOUBLE",
    "inverse": "CASE WHEN dmin = 0 THEN (d = 0)::INT::DOUBLE ELSE 1 / nullif(d, 0) END",
    "softmax": "exp(dmin - d) / sum(exp(dmin - d)) OVER (PARTITION BY q)",
}


def _power(p):
    term = {1: "abs(a - b)", 2: "(a - b) * (a - b)", 3: "pow(abs(a - b), 3)"}[p]
    whole = {1: "sum({t})", 2: "sqrt(sum({t}))", 3: "pow(sum({t}), 1.0::DOUBLE / 3)"}[p]
    return whole.format(t=term)


def _near_sql(p, k):
    return f"""WITH {_E},
      dist AS (SELECT q.vec_id AS q, t.vec_id AS t, round({_power(p)}, 9) AS d
               FROM (SELECT vec_id, i, a FROM e WHERE is_test) q JOIN (SELECT vec_id, i, a AS b FROM e WHERE NOT is_test) t USING (i) GROUP BY 1, 2),
      near AS (SELECT q, t, d, row_number() OVER (PARTITION BY q ORDER BY d, t) AS r, 0 AS z FROM dist QUALIFY r <= {k}),
      lab AS (SELECT q, t, d, r, label, min(d) OVER (PARTITION BY q) AS dmin FROM near JOIN v ON v.vec_id = near.t)"""


def _knn_sql(weights, p, k):
    return f"""{_near_sql(p, k)},
      wt AS (SELECT q, label, {_WEIGHT[weights]} AS w FROM lab),
      vote AS (SELECT q, label, round(sum(w), 9) AS w FROM wt GROUP BY 1, 2),
      best AS (SELECT q, label, row_number() OVER (PARTITION BY q ORDER BY w DESC, label) AS place FROM vote)
      SELECT q AS query, best.label AS prediction FROM best WHERE place = 1"""


def _knn(weights, p, k=3):
    def run(spark, folder):
        rows = _vectors(spark, folder)
        return NB.classify(rows.where("NOT is_test"), rows.where("is_test"), "vec_id", "features", "label", k, p, weights)

    return run


for _w in ("uniform", "inverse", "softmax"):
    for _p in (1, 2, 3):
        registry.add(f"knn_{_w}_{_p}", _knn_sql(_w, _p, 3))(_knn(_w, _p))


@registry.add("knn_neighbors", _near_sql(2, 5) + " SELECT q AS query, t AS neighbor, round(d, 6) AS distance, r AS rank FROM near")
def knn_neighbors(spark, folder):
    rows = _vectors(spark, folder)
    found = NB.nearest(rows.where("NOT is_test"), rows.where("is_test"), "vec_id", "features", 5)
    return found.select("query", "neighbor", F.round("distance", 6).alias("distance"), F.col("rank").cast("bigint").alias("rank"))


_KNN = _knn_sql("uniform", 2, 3)


@registry.add("knn_accuracy", f"SELECT round(avg((prediction = label)::INT), 6) AS accuracy, count(*) AS n FROM ({_KNN}) k JOIN embeddings ON vec_id = query")
def knn_accuracy(spark, folder):
    predicted = _knn("uniform", 2)(spark, folder)
    joined = predicted.join(vectors(spark, folder).select(F.col("vec_id").alias("query"), "label"), "query")
    return joined.agg(F.round(M.accuracy(F.col("prediction"), F.col("label")), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@registry.add(
    "first_mistakes",
    f"""SELECT label, min(query) AS query, arg_min(prediction, query) AS prediction FROM ({_KNN}) k JOIN embeddings ON vec_id = query
        WHERE prediction <> label GROUP BY 1""",
)
def first_mistakes(spark, folder):
    predicted = _knn("uniform", 2)(spark, folder)
    joined = predicted.join(vectors(spark, folder).select(F.col("vec_id").alias("query"), "label"), "query")
    return NB.first_mistakes(joined.select("query", "prediction", "label"), "label", F.col("query"))


# Kernel machines


@registry.add(
    "kernel_scores",
    f"""WITH {_E},
        c AS (SELECT label, i, avg(a) AS m FROM e WHERE NOT is_test GROUP BY 1, 2),
        s AS (SELECT vec_id, c.label, sum((a - m) * (a - m)) AS q FROM e JOIN c USING (i) GROUP BY 1, 2),
        z AS (SELECT vec_id, sum((CASE WHEN label % 2 = 0 THEN 1 ELSE -1 END) * exp(-2 * q)) + 0.01 AS z FROM s GROUP BY 1)
        SELECT vec_id, round(z, 6) AS score, CASE WHEN z > 0 THEN 1 ELSE -1 END AS prediction FROM z""",
)
def kernel_scores(spark, folder):
    """Class centres of the training part are the support rows, weighted by class parity."""
    rows = _vectors(spark, folder)
    centre = F.array(*[F.avg(F.col("features")[i]) for i in range(DIMS)])
    supports = rows.where("NOT is_test").groupBy("label").agg(centre.alias("sv")).select(
        "sv", (-X.to_plus_minus(X.parity(F.col("label")))).alias("weight")
    )
    scores = svm.kernel_labels(svm.kernel_scores(rows, "vec_id", "features", supports, 0.01, "rbf", 2.0))
    return scores.select(F.col("key").alias("vec_id"), F.round("score", 6).alias("score"), "prediction")


@registry.add("class_pairs", "SELECT a.label AS first, b.label AS second FROM (SELECT DISTINCT label FROM embeddings) a, (SELECT DISTINCT label FROM embeddings) b WHERE a.label < b.label")
def class_pairs(spark, folder):
    return svm.class_pairs(vectors(spark, folder), "label")


@registry.add("svm_ovo")
def svm_ovo(spark, folder):
    """All 45 class pairs on radial features, fitted together, then the majority vote."""
    rows = _vectors(spark, folder, 0.35)
    pairs = [(r.first, r.second) for r in svm.class_pairs(vectors(spark, folder), "label").orderBy("first", "second").collect()]
    made = kernel_map("rbf", DIMS, gamma=0.5, size=256)
    weights = svm.fit_pairs(rows, F.col("features"), F.col("label"), F.col("is_test"), pairs, made, 1.0)
    votes = svm.pair_votes(rows, "vec_id", "features", pairs, weights, made)
    joined = votes.join(rows.select(F.col("vec_id").alias("key"), "label", "is_test"), "key")
    return joined.groupBy("is_test").agg(F.round(M.accuracy(F.col("prediction"), F.col("label")), 4).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@registry.add("svm_binary")
def svm_binary(spark, folder):
    """Label parity with the exact degree-2 polynomial map."""
    rows = _vectors(spark, folder, 0.5).withColumn("y", X.parity(F.col("label")))
    made = kernel_map("poly", DIMS, gamma=1.0, degree=2)
    weights = svm.fit_pairs(rows, F.col("features"), F.col("y"), F.col("is_test"), [(1, 0)], made, 5.0)
    votes = svm.pair_votes(rows, "vec_id", "features", [(1, 0)], weights, made)
    joined = votes.join(rows.select(F.col("vec_id").alias("key"), "y", "is_test"), "key")
    return joined.groupBy("is_test").agg(F.round(M.accuracy(F.col("prediction"), F.col("y")), 4).alias("accuracy"), F.count(F.lit(1)).alias("n"))


# Decision tree: return flag from quantity, discount, tax


TREE_COLUMNS = ["l_quantity", "l_discount", "l_tax"]


def _tree_rows(spark, folder):
    code = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    marked = sampling.with_split(lineitem(spark, folder), lineitem_keys(), 0.25, SEED)
    return marked.select(*TREE_COLUMNS, code.alias("y"), "is_test")


_TREE_BASE = f"""d AS (SELECT l_quantity AS f0, l_discount AS f1, l_tax AS f2, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS y,
  {SQL_LINEITEM_UNIT} < 0.25 AS is_test FROM lineitem)"""


def _entropy(cols):
    total = "(" + " + ".join(cols) + ")"
    return "-(" + " + ".join(f"(CASE WHEN {c} > 0 THEN {c} * ln({c} / {total}::DOUBLE) ELSE 0 END)" for c in cols) + ")"


def _split_sql(source, name):
    """CTEs for the candidate and best splits of every node of ``source`` (node, f0, f1, f2, y)."""
    left, right, whole = [f"l{k}" for k in range(3)], [f"(t{k} - l{k})" for k in range(3)], [f"t{k}" for k in range(3)]
    run = ", ".join(f"sum(sum((y = {k})::INT)) OVER (PARTITION BY node, f ORDER BY v) AS l{k}" for k in range(3))
    tot = ", ".join(f"sum((y = {k})::INT) AS t{k}" for k in range(3))
    return f"""{name}l AS (SELECT node, y, unnest([0, 1, 2]) AS f, unnest([f0, f1, f2]) AS v FROM {source}),
      {name}t AS (SELECT node, {tot} FROM {source} GROUP BY 1),
      {name}r AS (SELECT node, f, v, lead(v) OVER (PARTITION BY node, f ORDER BY v) AS nv, {run} FROM {name}l GROUP BY node, f, v),
      {name}c AS (SELECT node, f, (v + nv) / 2 AS cut, {_entropy(left)} + {_entropy(right)} - ({_entropy(whole)}) AS gain FROM {name}r JOIN {name}t USING (node) WHERE nv IS NOT NULL),
      {name} AS (SELECT node, f, cut, gain FROM {name}c QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 6), f, cut) = 1)"""


@registry.add(
    "tree_split_root",
    f"""WITH {_TREE_BASE}, tr AS (SELECT 0 AS node, * FROM d WHERE NOT is_test), {_split_sql('tr', 's')}
        SELECT f::INT AS feature, round(cut, 6) AS cut, round(gain, 4) AS gain FROM s""",
)
def tree_split_root(spark, folder):
    rows = _tree_rows(spark, folder).where("NOT is_test")
    root = tree.fit_tree(rows, TREE_COLUMNS, "y", 3, "entropy", max_depth=1).nodes[0]
    return spark.createDataFrame([(root.feature, round(root.cut, 6), round(root.split[0], 4))], "feature INT, cut DOUBLE, gain DOUBLE")


@registry.add(
    "tree_candidates",
    f"""WITH {_TREE_BASE}, tr AS (SELECT 0 AS node, * FROM d WHERE NOT is_test), {_split_sql('tr', 's')}
        SELECT f::INT AS feature, round(cut, 6) AS cut, round(gain, 4) AS gain FROM sc""",
)
def tree_candidates(spark, folder):
    """Every midpoint of every column with its gain."""
    rows = _tree_rows(spark, folder).where("NOT is_test").withColumn("node_id", F.lit(0))
    counts = tree.value_counts(rows, TREE_COLUMNS, "y", 3)
    totals = rows.groupBy("node_id").agg(*[F.sum((F.col("y") == k).cast("bigint")).alias(f"t{k}") for k in range(3)])
    found = tree.candidate_splits(counts, totals, 3, "entropy", tree.value_ranges(rows, TREE_COLUMNS))
    return found.select("feature", F.round("cut", 6).alias("cut"), F.round("gain", 4).alias("gain"))


_SIDE = "CASE f WHEN 0 THEN f0 WHEN 1 THEN f1 ELSE f2 END < cut"


@registry.add(
    "tree_fit_depth",
    f"""WITH {_TREE_BASE}, tr AS (SELECT 0 AS node, * FROM d), tr0 AS (SELECT * FROM tr WHERE NOT is_test), {_split_sql('tr0', 's')},
        n1 AS (SELECT CASE WHEN {_SIDE} THEN 1 ELSE 2 END AS node, f0, f1, f2, y, is_test FROM tr JOIN s USING (node)),
        n1t AS (SELECT * FROM n1 WHERE NOT is_test), {_split_sql('n1t', 'u')},
        n2 AS (SELECT n1.node * 2 + CASE WHEN {_SIDE} THEN 1 ELSE 2 END AS node, y, is_test FROM n1 JOIN u USING (node)),
        m AS (SELECT node, y AS p FROM n2 WHERE NOT is_test GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY node ORDER BY count(*) DESC, y) = 1)
        SELECT is_test, round(avg((p = y)::INT), 6) AS accuracy, count(*) AS n FROM n2 JOIN m USING (node) GROUP BY 1""",
)
def tree_fit_depth(spark, folder):
    rows = _tree_rows(spark, folder)
    grown = tree.fit_tree(rows.where("NOT is_test"), TREE_COLUMNS, "y", 3, "entropy", max_depth=2)
    scored = grown.transform(rows)
    return scored.groupBy("is_test").agg(F.round(M.accuracy(F.col("prediction"), F.col("y")), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


@registry.add("tree_fit_leaves")
def tree_fit_leaves(spark, folder):
    """Best-first growth to seven leaves."""
    rows = _tree_rows(spark, folder)
    grown = tree.fit_tree(rows.where("NOT is_test"), TREE_COLUMNS, "y", 3, "gini", max_leaves=7)
    scored = grown.transform(rows)
    return scored.groupBy("is_test").agg(F.round(M.accuracy(F.col("prediction"), F.col("y")), 6).alias("accuracy"), F.count(F.lit(1)).alias("n"))


# Evaluation studies


def _edits(spark, folder):
    """Per order: lines returned are wanted edits, open lines are predicted edits, the price is the rating."""
    lines = lineitem(spark, folder).groupBy("l_orderkey").agg(
        F.sum((F.col("l_returnflag") == "R").cast("bigint")).alias("gold_edits"),
        F.sum((F.col("l_linestatus") == "O").cast("bigint")).alias("predicted_edits"),
        F.sum(((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")).cast("bigint")).alias("predicted_correct"),
    )
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.floor(F.col("o_totalprice") / 5000).alias("human_rating"))
    return lines.join(orders, "l_orderkey")


_EDITS = f"""e AS (SELECT l_orderkey AS id, sum((l_returnflag = 'R')::INT) AS g, sum((l_linestatus = 'O')::INT) AS p,
    sum((l_returnflag = 'R' AND l_linestatus = 'O')::INT) AS c, any_value(floor(o_totalprice / 5000)::BIGINT) AS h
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
  r AS (SELECT *, ('0x' || substr(md5(concat_ws('-', '42', id, b // 4)), 8 * (b % 4)::INT + 1, 8))::BIGINT / 4294967296::DOUBLE AS u FROM e, range(100) t(b)),
  w AS (SELECT *, {{poisson}} AS w FROM r),
  t AS (SELECT b, sum(w * h) / sum(w) AS rating, sum(w * c)::DOUBLE AS tp, sum(w * (p - c))::DOUBLE AS fp, sum(w * (g - c))::DOUBLE AS fn FROM w GROUP BY 1),
  f AS (SELECT i, b, rating, (1 + beta * beta) * tp / ((1 + beta * beta) * tp + beta * beta * fn + fp) AS f FROM t, (SELECT i, i * 2 / 200::DOUBLE AS beta FROM range(201) q(i))),
  k AS (SELECT i, corr(f, rating) AS r FROM f GROUP BY 1)"""


def _edits_sql():
    from millrace.queries.rows import _POISSON

    return _EDITS.format(poisson=_POISSON)


@registry.add("fbeta_bootstrap", f"WITH {_edits_sql()} SELECT i::INT AS step, round(i * 2 / 200::DOUBLE, 2) AS beta, round(r, 5) AS correlation FROM k")
def fbeta_bootstrap(spark, folder):
    curve = correlation.beta_curve(_edits(spark, folder), ["l_orderkey"])
    return curve.select("step", F.round("beta", 2).alias("beta"), F.round("correlation", 5).alias("correlation"))


@registry.add("fbeta_best", f"WITH {_edits_sql()} SELECT round(i * 2 / 200::DOUBLE, 2) AS beta, round(r, 5) AS correlation FROM k ORDER BY round(r, 9) DESC, i LIMIT 1")
def fbeta_best(spark, folder):
    best = correlation.best_beta(correlation.beta_curve(_edits(spark, folder), ["l_orderkey"]))
    return best.select(F.round("beta", 2).alias("beta"), F.round("correlation", 5).alias("correlation"))


@registry.add("grid_search")
def grid_search(spark, folder):
    """Degrees 1, 2 and three strengths over five stratified folds; label parity on min-max scaled vectors."""
    rows = _vectors(spark, folder, 0.5).withColumn("y", X.parity(F.col("label")))
    train = rows.where("NOT is_test")
    low, high = FE.array_range(train, "features", DIMS)
    folded = sampling.with_stratified_fold(train, "y", ["vec_id"]).select("vec_id", "features", "y", "fold")
    ready = folded.unionByName(rows.where("is_test").select("vec_id", "features", "y", F.lit(-1).alias("fold")))
    scaled = FE.scale_array(F.col("features"), low, high)
    done = selection.grid_search(ready, scaled, F.col("y"), F.col("fold"), DIMS, [1, 2], [0.01, 1.0, 100.0], 5)
    return done.select("degree", "strength", F.round("cv_accuracy", 4).alias("cv_accuracy"), F.round("test_accuracy", 4).alias("test_accuracy"), "best")


@registry.add("grid_single")
def grid_single(spark, folder):
    """A grid of one: degree 3 and C 500 on standardised columns, five stratified folds."""
    names = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    rows = sampling.with_split(lineitem(spark, folder), lineitem_keys(), 0.2, SEED)
    rows = rows.select("l_orderkey", *names, (F.col("l_returnflag") == "R").cast("int").alias("y"), "is_test", F.hash("*").alias("h"))
    scaler = FE.Scaler.standard(rows.where("NOT is_test"), names)
    folded = sampling.with_stratified_fold(rows.where("NOT is_test"), "y", ["l_orderkey", "h"])
    both = folded.unionByName(rows.where("is_test").withColumn("fold", F.lit(-1)))
    done = selection.grid_search(both, F.array(*scaler.slots()), F.col("y"), F.col("fold"), len(names), [3], [500.0], 5)
    return done.select("degree", "strength", F.round("cv_accuracy", 4).alias("cv_accuracy"), F.round("test_accuracy", 4).alias("test_accuracy"), "best")
