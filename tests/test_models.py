"""Fits and searches against plain numpy on small data."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.operators import blocks, cosine
from millrace.operators import neighbors as NB
from millrace.operators.linalg import FAN_IN, gram, gram_wide, sum_vectors
from millrace.operators.metrics import weighted_vote
from millrace.operators.sampling import with_split
from millrace.plans import classification as C
from millrace.plans import correlation
from millrace.plans import regression as R
from millrace.plans import selection, svm, tree
from millrace.sources import stores

RNG = np.random.RandomState(5)


def frame(spark, x, y, kind="DOUBLE"):
    rows = [(i, [float(v) for v in a], (float(b) if kind == "DOUBLE" else int(b))) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, f"id BIGINT, features ARRAY<DOUBLE>, target {kind}")


@pytest.fixture(scope="module")
def line(spark):
    x = RNG.normal(size=(200, 2))
    y = x @ [2.0, -1.0] + 0.5 + RNG.normal(scale=0.1, size=200)
    rows = [(i, *map(float, a), float(b), i % 4 == 0) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id BIGINT, a DOUBLE, b DOUBLE, y DOUBLE, is_test BOOLEAN"), x, y


def test_normal_equations(line):
    df, x, y = line
    model, rmse = R.normal_equations(df, ["a", "b"], "y")
    full = np.column_stack([x, np.ones(200)])
    test = np.arange(200) % 4 == 0
    w = np.linalg.lstsq(full[~test], y[~test], rcond=None)[0]
    assert model.weights == pytest.approx(w)
    assert rmse == pytest.approx(np.sqrt(np.mean((full[test] @ w - y[test]) ** 2)))


def test_ridge_and_gradient_approach_least_squares(line):
    df, _, _ = line
    cols = [F.col("a"), F.col("b")]
    _, rmse = R.normal_equations(df, ["a", "b"], "y")
    ridge = R.ridge_sweep(df, cols, F.col("y"), F.col("is_test"), [1e-9]).first()
    assert ridge.rmse == pytest.approx(rmse)
    w, table = R.linear_gradient(df, cols, F.col("y"), F.col("is_test"), 300, 0.2)
    assert table.orderBy(F.desc("epoch")).first().test_rmse == pytest.approx(rmse, rel=1e-4)
    again, batches = R.linear_gradient(df, cols, F.col("y"), F.col("is_test"), 60, 0.1, 0.0, 5, [F.col("id")])
    assert again == pytest.approx(w, abs=0.05)


def test_ridge_matches_its_objective(line):
    df, x, y = line
    train = np.arange(200) % 4 != 0
    g, _ = R.part_grams(df, [F.col("a"), F.col("b")], F.col("y"), F.col("is_test"))
    w = R.ridge_path(g, np.array([3.0]))[0]
    xc, yc = x[train] - x[train].mean(axis=0), y[train] - y[train].mean()
    assert w[:2] == pytest.approx(np.linalg.solve(xc.T @ xc + 3.0 * np.eye(2), xc.T @ yc))


def test_kernel_regression_equals_the_dual_loop(spark):
    x = np.linspace(-1, 1, 40)
    y = np.sin(3 * x) + 1
    rows = [(float(a), float(b), i % 5 == 0) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x DOUBLE, y DOUBLE, t BOOLEAN")
    made = R.PolynomialMap(1, 3, 2.0)
    _, bias, table = R.kernel_regression(df, F.array("x"), F.col("y"), F.col("t"), made, 15, 0.1, 0.02)
    test = np.arange(40) % 5 == 0
    a, b = x[~test], y[~test]
    k = (2.0 * np.outer(a, a) + 1) ** 3
    betas = np.zeros(len(a))
    errors = []
    for _ in range(15):
        betas = betas - 0.1 / len(a) * (k @ betas + b.mean() - b)
        betas = betas - 0.02 * 0.1 * betas
        errors.append(np.sqrt(np.mean((k @ betas + b.mean() - b) ** 2)))
    assert bias == pytest.approx(b.mean())
    assert [r.train_rmse for r in table.orderBy("iteration").collect()] == pytest.approx(errors, rel=1e-8)


def test_maps_reproduce_their_kernels():
    a, b = RNG.normal(size=(6, 3)), RNG.normal(size=(5, 3))
    exact = R.PolynomialMap(3, 3, 0.7)
    assert exact.apply(a) @ exact.apply(b).T == pytest.approx((0.7 * a @ b.T + 1) ** 3)
    close = R.FourierMap(3, 20000, 0.3)
    gap = a[:, None, :] - b[None, :, :]
    assert np.abs(close.apply(a) @ close.apply(b).T - np.exp(-0.3 * (gap**2).sum(axis=2))).max() < 0.05


def test_sum_vectors_adds_in_rounds(spark):
    rows = spark.range(0, 1000, 1, FAN_IN + 9).select(F.array(F.col("id").cast("double")).alias("v"))
    from millrace.operators.linalg import matrix

    assert sum_vectors(rows, lambda batch: matrix(batch.column(0)).sum(axis=0))[0] == 499500


def test_gram_wide(spark):
    x, y = RNG.normal(size=(50, 4)), RNG.normal(size=50)
    g = gram_wide(frame(spark, x, y), "features", "target")
    assert g.xx == pytest.approx(x.T @ x) and g.xy == pytest.approx(x.T @ y) and g.n == 50


def test_partition_count_does_not_matter(line):
    df, _, _ = line
    one = R.normal_equations(df.repartition(1), ["a", "b"], "y")[0].weights
    seven = R.normal_equations(df.repartition(7), ["a", "b"], "y")[0].weights
    assert one == pytest.approx(seven)


# Neighbours


def brute(train, queries, k, p):
    out = {}
    for q, a in queries.items():
        d = [(round(float((np.abs(np.array(a) - np.array(b)) ** p).sum() ** (1 / p)), 9), t) for t, b in train.items()]
        out[q] = [t for _, t in sorted(d)[:k]]
    return out


@pytest.mark.parametrize("p", [1, 2, 3])
def test_neighbors_with_a_third_of_equal_rows(spark, p):
    x = RNG.randint(0, 4, size=(120, 3)).astype(float)
    x[:40] = [1.0, 2.0, 3.0]
    train = {i: v.tolist() for i, v in enumerate(x[:90])}
    queries = {i + 1000: v.tolist() for i, v in enumerate(np.vstack([x[90:], x[:5]]))}
    schema = "id BIGINT, x ARRAY<DOUBLE>"
    found = NB.nearest(
        spark.createDataFrame(list(train.items()), schema), spark.createDataFrame(list(queries.items()), schema), "id", "x", 4, p, pivots=6
    )
    got = {}
    for r in found.orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append(r.neighbor)
    assert got == brute(train, queries, 4, p)


def test_small_blocks_give_the_same_neighbors(spark, monkeypatch):
    x = RNG.normal(size=(200, 3))
    schema = "id BIGINT, x ARRAY<DOUBLE>"
    rows = [(i, [float(v) for v in a]) for i, a in enumerate(x)]
    train, queries = spark.createDataFrame(rows[:150], schema), spark.createDataFrame(rows[150:], schema)
    whole = sorted(map(tuple, NB.nearest(train, queries, "id", "x", 3).collect()))
    monkeypatch.setattr(NB, "block_join", lambda *a, **k: blocks.block_join(*a, **{**k, "rows": 7}))
    assert sorted(map(tuple, NB.nearest(train, queries, "id", "x", 3).collect())) == whole


@pytest.mark.parametrize("p", [1, 2, 3])
def test_few_cells_are_visited(spark, p):
    """Rows in groups: a query searches its own cell and a small part of the others, and finds what all pairs give."""
    rng = np.random.RandomState(7)
    centre = rng.uniform(-50, 50, size=(30, 3))
    x = centre[np.arange(1200) % 30] + rng.normal(size=(1200, 3))
    train, asked = {i: v.tolist() for i, v in enumerate(x[:1100])}, {i + 5000: v.tolist() for i, v in enumerate(x[1100:])}
    schema = "id BIGINT, x ARRAY<DOUBLE>"
    frames = [spark.createDataFrame(list(d.items()), schema) for d in (train, asked)]
    found, visits = NB.search(*frames, "id", "x", 3, p, F.col("id") * 2, pivots=60)
    got = {}
    for r in found.orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append(r.neighbor)
        assert r["tag"] == 2 * r.neighbor
    assert got == brute(train, asked, 3, p)
    assert visits.count() < 0.15 * 100 * 60


def test_more_neighbors_than_a_cell_holds(spark):
    x = np.arange(40.0) ** 2
    rows = spark.createDataFrame([(i, [float(v)]) for i, v in enumerate(x)], "id BIGINT, x ARRAY<DOUBLE>")
    for k in (7, 40, 50):
        found = NB.nearest(rows, rows.where("id < 3"), "id", "x", k, pivots=20)
        got = {}
        for r in found.orderBy("query", "rank").collect():
            got.setdefault(r["query"], []).append(r.neighbor)
        assert got == {q: sorted(range(40), key=lambda i: (abs(x[i] - x[q]), i))[:k] for q in range(3)}


def test_k_equal_to_n_and_identity(spark):
    rows = spark.createDataFrame([(i, [float(i)], i % 2) for i in range(6)], "id BIGINT, x ARRAY<DOUBLE>, y INT")
    assert NB.nearest(rows, rows.where("id = 0"), "id", "x", 6).count() == 6
    same = NB.classify(rows, rows, "id", "x", "y", k=1).join(rows.withColumnRenamed("id", "query"), "query")
    assert same.where("prediction <> y").count() == 0


def test_zero_distance_decides_inverse_weights(spark):
    train = spark.createDataFrame([(1, [0.0], 3), (2, [0.1], 1), (3, [0.1], 1)], "id BIGINT, x ARRAY<DOUBLE>, y INT")
    query = spark.createDataFrame([(9, [0.0])], "id BIGINT, x ARRAY<DOUBLE>")
    assert NB.classify(train, query, "id", "x", "y", 3, 2, "inverse").first().prediction == 3
    assert NB.classify(train, query, "id", "x", "y", 3, 2, "uniform").first().prediction == 1


@pytest.mark.parametrize("cost", [0.0, 1.0, 1e12])
def test_cosine_index_and_blocks_agree_with_brute_force(spark, cost):
    docs = {}
    for d in range(80):
        terms = RNG.choice(30, size=RNG.randint(1, 8), replace=False)
        w = RNG.uniform(0.1, 1, size=len(terms))
        docs[d] = dict(zip([f"t{t}" for t in terms], w / np.linalg.norm(w)))
    for d in range(20):
        docs[d] = docs[0]
    rows = [(d, t, float(w)) for d, v in docs.items() for t, w in v.items()]
    post = spark.createDataFrame(rows, "id BIGINT, term STRING, w DOUBLE")
    train, queries = post.where("id < 60"), post.where("id >= 60 OR id = 3")
    found = cosine.cosine_neighbors(train, queries, "id", 3, cost)
    got = {}
    for r in found.orderBy("query", "rank").collect():
        got.setdefault(r["query"], []).append(r.neighbor)
    for q in [3, *range(60, 80)]:
        sims = [(-round(sum(w * docs[t].get(k, 0.0) for k, w in docs[q].items()), 9), t) for t in range(60)]
        expected = [t for s, t in sorted(sims)[:3] if s < 0]
        assert got.get(q, []) == expected


# Tree


def test_cuts_are_midpoints_of_distinct_values(spark):
    rows = spark.createDataFrame([(1.0, 0), (7.0, 1), (3.0, 0), (3.0, 1)], "f DOUBLE, y INT").withColumn("node_id", F.lit(0))
    counts = tree.value_counts(rows, ["f"], "y", 2)
    totals = spark.createDataFrame([(0, 2, 2)], "node_id INT, t0 BIGINT, t1 BIGINT")
    for edges in ([], [3.0, 7.0]):
        cuts = tree.candidate_splits(counts, totals, 2, "gini", edges).collect()
        assert sorted(r.cut for r in cuts) == [2.0, 5.0]


def grow(x, y, classes, criterion, depth):
    def value(t):
        n, c = len(t), np.bincount(t, minlength=classes)
        if criterion == "gini":
            return n - (c * c).sum() / n
        return -sum(v * np.log(v / n) for v in c if v)

    def node(index, level):
        t = y[index]
        if level == depth or value(t) < 1e-12:
            return int(np.bincount(t, minlength=classes).argmax())
        best = None
        for f in range(x.shape[1]):
            v = np.unique(x[index, f])
            for cut in (v[1:] + v[:-1]) / 2:
                left = x[index, f] < cut
                gain = round(value(t[left]) + value(t[~left]) - value(t), 6)
                if best is None or gain < best[0]:
                    best = (gain, f, cut)
        if best is None:
            return int(np.bincount(t, minlength=classes).argmax())
        left = x[index, best[1]] < best[2]
        return best[1], best[2], node(index[left], level + 1), node(index[~left], level + 1)

    return node(np.arange(len(y)), 0)


def nested(t, i=0):
    n = t.nodes[i]
    return n.majority if n.feature is None else (n.feature, n.cut, nested(t, n.left), nested(t, n.right))


@pytest.mark.parametrize("criterion,case_nodes", [("gini", 512), ("entropy", 512), ("entropy", 2)])
def test_tree_equals_exhaustive_growth(spark, monkeypatch, criterion, case_nodes):
    monkeypatch.setattr(tree, "CASE_NODES", case_nodes)
    x = RNG.randint(0, 6, size=(80, 3)).astype(float)
    y = ((x[:, 0] > 2).astype(int) + (x[:, 1] > 3)).astype(int)
    y[::7] = 0
    rows = [(float(a), float(b), float(c), int(t)) for (a, b, c), t in zip(x, y)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, y INT")
    made = tree.fit_tree(df, ["a", "b", "c"], "y", 3, criterion, max_depth=4)
    assert nested(made) == grow(x, y, 3, criterion, 4)


def test_identical_rows_become_a_leaf(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 1)], "a DOUBLE, y INT")
    made = tree.fit_tree(df, ["a"], "y", 2)
    assert made.nodes[0].feature is None and made.nodes[0].majority == 0


def test_leaf_limit_and_ties(spark):
    df = spark.createDataFrame([(float(i), i % 4 // 2) for i in range(16)], "a DOUBLE, y INT")
    made = tree.fit_tree(df, ["a"], "y", 2, "gini", max_leaves=4)
    assert sum(n.feature is None for n in made.nodes.values()) == 4


# Gradient classifiers


def blobs(n=240, classes=3):
    y = np.arange(n) % classes
    centres = np.array([[2.0, 0.0], [-2.0, 1.0], [0.0, -3.0]])[:classes]
    return centres[y] + RNG.normal(scale=0.4, size=(n, 2)), y


def test_network_gradient_by_differences():
    net = C.Network.start([3, 4, 2], 1, 0.5)
    x, y = RNG.normal(size=(6, 3)), np.array([0, 1, 1, 0, 1, 0])
    at = net.pack()
    loss = lambda v: -np.log(net.unpack(v).forward(x)[-1][np.arange(6), y]).sum()
    numeric = [(loss(at + d) - loss(at - d)) / 2e-6 for d in np.eye(len(at)) * 1e-6]
    assert net.gradient(x, y) == pytest.approx(np.array(numeric), abs=1e-5)


def test_classifiers_learn_blobs(spark):
    x, y = blobs()
    df = with_split(frame(spark, x, y, "INT"), [F.col("id")], 0.25)
    parts = (F.col("features"), F.col("target"), F.col("is_test"))
    _, soft = C.softmax_gradient(df, *parts, 2, 3, 20, 0.5)
    assert soft.orderBy(F.desc("step")).first().test_acc > 0.95
    net, table = C.fit_network_averaged(df, *parts, [F.col("id")], 2, [8], 3, 6, 0.05, 16, 2, "adam")
    assert table.orderBy(F.desc("epoch")).first().test_acc > 0.9
    _, plain = C.fit_network(df, *parts, [F.col("id")], 2, [8], 3, 8, 0.5, 4)
    assert plain.orderBy(F.desc("epoch")).first().train_acc > 0.9
    scored = net.transform(df, "features")
    assert scored.where("prediction = target").count() / df.count() > 0.9


def test_full_batch_logistic_matches_numpy(spark):
    x, y = blobs(100, 2)
    df = frame(spark, x, y, "INT").withColumn("is_test", F.col("id") % 5 == 0)
    w, _ = C.logistic_gradient(df, F.col("features"), F.col("target"), F.col("is_test"), 2, 5, 0.7)
    train = np.arange(100) % 5 != 0
    full, expected = np.column_stack([x, np.ones(100)])[train], np.zeros(3)
    for _ in range(5):
        expected = expected - 0.7 * full.T @ (1 / (1 + np.exp(-full @ expected)) - y[train]) / train.sum()
    assert w == pytest.approx(expected)


def test_perceptron_stops_without_errors(spark):
    x, y = blobs(60, 2)
    df = frame(spark, x, 2 * y - 1, "INT")
    w, table = C.perceptron(df, F.col("features"), F.col("target"), 2, 50)
    assert table.orderBy(F.desc("pass")).first().errors == 0
    assert ((np.column_stack([x, np.ones(60)]) @ w > 0) == (y == 1)).all()


def test_one_hot_positions():
    made = C.OneHotPositions([97, 32])
    assert made(np.array([[32.0, 97.0], [99.0, 32.0]])).tolist() == [[1, 0, 0, 1], [0, 0, 1, 0]]


def test_pair_machines_reach_the_hinge_optimum(spark):
    x, y = blobs(150, 3)
    df = frame(spark, x, y, "INT").withColumn("t", F.lit(False))
    made = R.PolynomialMap(2, 2, 1.0)
    pairs = [(0, 1), (0, 2), (1, 2)]
    w = svm.fit_pairs(df, F.col("features"), F.col("target"), F.col("t"), pairs, made, 1.0)
    votes = svm.pair_votes(df, "id", "features", pairs, w, made)
    joined = votes.join(df.withColumnRenamed("id", "key"), "key")
    assert joined.where("prediction = target").count() / 150 > 0.97


def test_pair_machine_objective_is_near_the_library(spark):
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.functions import array_to_vector

    x, y = blobs(120, 2)
    x = x + np.random.RandomState(3).normal(scale=2.0, size=x.shape)
    df = frame(spark, x, y, "INT").withColumn("t", F.lit(False)).coalesce(1)
    made = R.PolynomialMap(2, 1, 1.0)
    phi = made.apply(x)

    def objective(w, b):
        return w @ w / 2 + 2.0 * np.maximum(0, 1 - (2 * y - 1) * (phi @ w + b)).sum()

    mine = svm.fit_pairs(df, F.col("features"), F.col("target"), F.col("t"), [(1, 0)], made, 2.0)[:, 0]
    rows = spark.createDataFrame([([float(v) for v in a], float(b)) for a, b in zip(phi, y)], "f ARRAY<DOUBLE>, label DOUBLE")
    library = LinearSVC(regParam=1 / (2.0 * 120), standardization=False, maxIter=60).fit(rows.coalesce(1).select(array_to_vector("f").alias("features"), "label"))
    best = objective(library.coefficients.toArray(), library.intercept)
    assert objective(mine[:-1], mine[-1]) <= best * 1.02


def test_kernel_scores_both_ways(spark, monkeypatch):
    x, sv = RNG.normal(size=(30, 2)), RNG.normal(size=(5, 2))
    df = frame(spark, x, np.zeros(30))
    supports = spark.createDataFrame([([float(v) for v in a], float(i - 2)) for i, a in enumerate(sv)], "sv ARRAY<DOUBLE>, weight DOUBLE")
    expected = np.exp(-0.5 * ((x[:, None] - sv[None]) ** 2).sum(axis=2)) @ (np.arange(5) - 2.0) + 0.3
    for cells in (10_000, 1):
        monkeypatch.setattr(svm, "SUPPORT_CELLS", cells)
        got = svm.kernel_scores(df, "id", "features", supports, 0.3, "rbf", 0.5).orderBy("key").collect()
        assert [r.score for r in got] == pytest.approx(expected)


def test_grid_search_equals_newton(spark):
    x, y = blobs(120, 2)
    x = x + RNG.normal(scale=1.5, size=x.shape)
    x = (x - x.min(axis=0)) / (x.max(axis=0) - x.min(axis=0))
    fold = np.where(np.arange(120) % 6 == 5, -1, np.arange(120) % 6)
    rows = [([float(v) for v in a], int(b), int(f)) for a, b, f in zip(x, y, fold)]
    df = spark.createDataFrame(rows, "features ARRAY<DOUBLE>, y INT, fold INT")
    got = selection.grid_search(df, F.col("features"), F.col("y"), F.col("fold"), 2, [1, 2], [0.01, 1.0], 5, 1e-8)

    def fit(a, b, c):
        w = np.zeros(a.shape[1])
        ridge = np.eye(len(w))
        ridge[-1, -1] = 0
        for _ in range(50):
            p = 1 / (1 + np.exp(-a @ w))
            w = w - np.linalg.solve(c * (a.T * (p * (1 - p))) @ a + ridge + 1e-9 * np.eye(len(w)), c * a.T @ (p - b) + ridge @ w)
        return w

    for r in got.collect():
        e = selection.expanded(x, r.degree)
        scores = [np.mean((e[fold == f] @ fit(e[(fold >= 0) & (fold != f)], y[(fold >= 0) & (fold != f)], r.strength) > 0) == y[fold == f]) for f in range(5)]
        assert r.cv_accuracy == pytest.approx(np.mean(scores), abs=1e-9)
        assert r.test_accuracy == pytest.approx(np.mean((e[fold == -1] @ fit(e[fold >= 0], y[fold >= 0], r.strength) > 0) == y[fold == -1]), abs=1e-9)


def test_beta_curve_equals_numpy_over_the_replicates(spark):
    rows = []
    for i in range(300):
        gold = int(RNG.poisson(2))
        correct = int(RNG.randint(gold + 1))
        extra = int(RNG.poisson(0.5))
        rows.append((i, gold, correct + extra, correct, int(100 - 6 * (gold - correct) - 10 * extra)))
    df = spark.createDataFrame(rows, "id INT, gold_edits INT, predicted_edits INT, predicted_correct INT, human_rating INT")
    totals = correlation.replicate_totals(df, ["id"], 30).collect()
    tp, fp, fn, rating = (np.array([float(r[c]) for r in totals]) for c in ("tp", "fp", "fn", "rating"))
    expected = []
    for beta in np.linspace(0, 2, 21):
        f = (1 + beta**2) * tp / ((1 + beta**2) * tp + beta**2 * fn + fp)
        expected.append(np.corrcoef(f, rating)[0, 1])
    curve = correlation.beta_curve(df, ["id"], 30, 21)
    assert [r.correlation for r in curve.orderBy("step").collect()] == pytest.approx(expected)
    best = correlation.best_beta(curve).first()
    assert best.correlation == pytest.approx(max(expected))
    assert best.beta == pytest.approx(np.linspace(0, 2, 21)[int(np.argmax(expected))])


def test_arrays_are_stored_and_loaded(spark, tmp_path):
    stores.save_arrays(spark, {"w": np.arange(6.0).reshape(2, 3)}, str(tmp_path / "m"))
    assert stores.load_arrays(spark, str(tmp_path / "m"))["w"].tolist() == [[0, 1, 2], [3, 4, 5]]


def test_feature_tables_by_schema(spark, tmp_path):
    from millrace.sources import tables

    frame(spark, [[1.0, 2.0], [3.0, 4.0]], [0, 5], "INT").write.parquet(str(tmp_path / "digits.parquet"))
    rows = tables.feature_table(spark, str(tmp_path / "digits.parquet"), classes=True)
    assert tables.lowest_classes(rows, "target", 3).count() == 1
    assert tables.feature_table(spark, str(tmp_path / "digits.parquet"), labelled=False).columns == ["id", "features"]
    assert tables.table(spark, str(tmp_path), "digits").count() == 2


def test_long_votes_take_the_lowest_class_on_ties(spark):
    votes = spark.createDataFrame([(1, 2), (1, 0), (2, 1), (2, 1), (2, 0)], "key INT, label INT")
    assert {r["key"]: r.prediction for r in svm.vote_table(votes, "key", "label").collect()} == {1: 0, 2: 1}


def test_close_and_far_points_keep_their_order(spark):
    def found(scale):
        train = spark.createDataFrame([(1, [0.0]), (2, [3.0 * scale])], "key bigint, x array<double>")
        asked = spark.createDataFrame([(9, [3.0 * scale])], "key bigint, x array<double>")
        return NB.nearest(train, asked, "key", "x", 1).first()["neighbor"]

    assert [found(scale) for scale in (1e-10, 1.0, 1e10)] == [2, 2, 2]


def test_votes_have_no_scale(spark):
    votes = spark.createDataFrame([(1, 1, 1e-10), (1, 0, 3e-11), (2, 4, 0.5), (2, 3, 0.5), (3, 7, 0.0), (3, 6, 0.0)], "q int, c int, w double")
    assert {r["q"]: r["prediction"] for r in weighted_vote(votes, "q", "c", F.col("w")).collect()} == {1: 1, 2: 3, 3: 6}


def test_gram_leaves_out_rows_with_nulls(spark):
    rows = spark.createDataFrame([(1.0, 1.0, False), (None, 5.0, False), (2.0, 2.0, False)], "x double, y double, is_test boolean")
    found = gram(rows, [F.col("x")], F.col("y"))
    assert (found.n, found.xx[0, 0], found.yy) == (2, 5.0, 5.0)
    model, error = R.normal_equations(rows, ["x"], "y")
    assert error is None and np.allclose(model.weights, [1.0, 0.0])
    assert R.ridge_sweep(rows, [F.col("x")], F.col("y"), F.col("is_test"), [0.1]).first()["rmse"] is None
    with pytest.raises(ValueError):
        R.normal_equations(rows.limit(0), ["x"], "y")


def test_rows_of_many_steps_are_dealt_out_once(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    for parts, each, want in ((64, 100_000, cores), (1, 100_000, cores), (64, 10, 20), (16, 10, 16)):
        monkeypatch.setattr(C, "STEP_ROWS", each)
        with C.cached_evenly(spark.range(200).repartition(parts)) as kept:
            assert kept.rdd.getNumPartitions() == want
            assert sorted(r.id for r in kept.collect()) == list(range(200))


def test_monomials_by_degree_and_column():
    x = RNG.normal(size=(5, 3))
    places = [(i,) for i in range(3)] + [(i, j) for i in range(3) for j in range(i, 3)]
    places += [(i, j, k) for i in range(3) for j in range(i, 3) for k in range(j, 3)]
    want = np.column_stack([*[np.prod(x[:, list(p)], axis=1) for p in places], np.ones(5)])
    assert np.allclose(selection.expanded(x, 3), want, rtol=1e-14)
    assert selection.expanded(x[:0], 2).shape == (0, 10)


@pytest.mark.parametrize("p", [1, 2, 3])
def test_closest_is_what_all_distances_give(p, monkeypatch):
    monkeypatch.setattr(NB, "CACHE_CELLS", 40)
    monkeypatch.setattr(NB, "PAIR_CELLS", 640)
    for shift, scale in ((0.0, 1.0), (1e6, 1e-3), (0.0, 1e150)):
        a, b = shift + scale * RNG.normal(size=(30, 5)), shift + scale * RNG.normal(size=(50, 5))
        b[20:30], a[3] = b[7], b[7]
        with np.errstate(over="ignore"):
            d = NB.distances(a, b, p)
            for k in (1, 3, 50, 60):
                border = np.sort(d, axis=1)[:, min(k, 50) - 1]
                want = {(int(i), int(j)): d[i, j] for i, j in zip(*np.nonzero(d <= border[:, None] * (1 + NB.SLACK)))}
                row, col, far = NB.closest(a, b, p, k)
                assert {(int(i), int(j)): v for i, j, v in zip(row, col, far)} == want
                # A bound keeps everything within it.
                bound = np.sort(d, axis=1)[:, 1]
                kept = set(zip(*(x.tolist() for x in NB.closest(a, b, p, k, bound)[:2])))
                assert {pair for pair, v in want.items() if v <= bound[pair[0]]} <= kept <= set(want)
                if scale == 1.0 and k == 60:
                    assert len(kept) < 30 * 50 / 2


def test_pairs_within_a_bound_are_read_from_one_product():
    a, b = RNG.normal(size=(40, 5)), RNG.normal(size=(60, 5))
    b[:9] = a[:9]
    for scale, shift in ((1.0, 0.0), (1e-9, 0.0), (1e9, 0.0), (1.0, 1e4)):
        x, y = a * scale + shift, b * scale + shift
        far = NB.distances(x, y, 2)
        for bound in (np.zeros(40), np.sort(far, axis=1)[:, 1]):
            found = NB.pairs_within(x, y, bound)
            assert found is not None and len(found[0]) < 40 * 60 / NB.FEW
            assert set(zip(*(z.tolist() for z in np.nonzero(far <= bound[:, None])))) <= set(zip(*(z.tolist() for z in found)))
            row, col, d = NB.closest(x, y, 2, 3, bound)
            assert (d == far[row, col]).all() and (d <= bound[row] * (1 + 1e-8)).all()
    assert NB.pairs_within(a, b, np.full(40, np.inf)) is None
    assert NB.pairs_within(np.where(a > 2, np.nan, a), b, np.ones(40)) is None


@pytest.mark.parametrize("p", [1, 3])
def test_pairs_within_a_bound_are_read_from_one_product_under_other_norms(p):
    for width in (1, 4, 64):
        a, b = RNG.normal(size=(40, width)), RNG.normal(size=(200, width))
        b[:9] = a[:9]
        for scale, shift in ((1.0, 0.0), (1e-9, 0.0), (1e9, 0.0), (1.0, 1e2)):
            x, y = a * scale + shift, b * scale + shift
            far = NB.distances(x, y, p)
            bound = np.sort(far, axis=1)[:, 0]
            bound[9] = np.inf  # its pairs are all measured, the others keep their bounds
            found = NB.pairs_within(x, y, bound, p)
            assert found is not None and len(found[0]) <= 40 * 200 / NB.FEW_SUMS
            assert set(zip(*(z.tolist() for z in np.nonzero(far <= bound[:, None])))) <= set(zip(*(z.tolist() for z in found)))
            row, col, d = NB.closest(x, y, p, 3, bound)
            assert (d == far[row, col]).all() and (d <= bound[row] * (1 + 1e-8)).all()
            assert set(row.tolist()) == set(range(40)) and (row == 9).sum() == 3
    assert NB.pairs_within(a, b, np.full(40, np.inf), p) is None
    assert NB.pairs_within(a, np.where(b > 2, np.nan, b), np.ones(40), p) is None


def test_lowest_distances_of_a_block_tighten_its_bounds():
    lowest = np.full((3, 2), np.inf)
    NB.keep_lowest(lowest, np.array([0, 0, 0, 2]), np.array([1.0, 4.0, 5.0, 2.0]))
    NB.keep_lowest(lowest, np.array([0, 2]), np.array([3.0, 1.0]))
    NB.keep_lowest(lowest, np.zeros(0, int), np.zeros(0))
    assert lowest.tolist() == [[1.0, 3.0], [np.inf, np.inf], [1.0, 2.0]]


def test_blocks_that_travel_grow_with_the_documents():
    """Copies of a document, one per partner block, stay about as many as there are cores."""
    assert cosine.task_docs(100, 12) == cosine.BLOCK_DOCS
    for n in (20_000, 100_000, 390_000):
        assert -(-n // cosine.task_docs(n, 12)) <= 24
    assert cosine.task_docs(10**7, 12) == cosine.TASK_DOCS


def test_pairs_of_blocks_read_every_document_from_one_copy(spark, monkeypatch):
    monkeypatch.setattr(cosine, "BLOCK_POSTINGS", 20)
    x, y = (np.round(RNG.uniform(0, 1, size=(n, 6)) * (RNG.uniform(size=(n, 6)) < 0.5), 1) for n in (16, 40))
    rows = lambda m: [(int(i) + 100, int(t), float(m[i, t])) for i, t in zip(*np.nonzero(m))]
    asked = spark.createDataFrame(rows(x), "q bigint, term bigint, wq double")
    post = spark.createDataFrame(rows(y), "d bigint, term bigint, wd double")
    stored = cosine.written_blocks(post, "d", "wd", 40).collect()
    held = [d for row in stored for d in pa.ipc.open_stream(row["data"]).read_all().column("d").to_pylist()]
    assert len(stored) > 2 and sorted(held) == sorted({d for d, _, _ in rows(y)})
    s = x @ y.T
    for k in (1, 3):
        found = cosine.by_blocks(post, asked, k, 40).collect()
        best = {}
        for r in found:
            assert abs(r["s"] - s[r["q"] - 100, r["d"] - 100]) < 1e-9
            best.setdefault(r["q"], set()).add(r["d"])
        for i in range(16):
            border = max(np.sort(s[i])[-k], 1e-12)
            assert {j + 100 for j in np.flatnonzero(s[i] >= border - 1e-12).tolist()} <= best.get(i + 100, set())


def test_best_of_blocks_over_several_products(monkeypatch):
    monkeypatch.setattr(cosine, "BLOCK_DOCS", 7)
    x, y = (np.round(RNG.uniform(0, 1, size=(n, 6)) * (RNG.uniform(size=(n, 6)) < 0.4), 1) for n in (16, 40))
    table = lambda m, key: pa.table({key: np.arange(len(m)) + 100, "terms": [np.flatnonzero(r).tolist() for r in m], "weights": [r[r > 0].tolist() for r in m]})
    s = x @ y.T
    for k in (1, 3, 50):
        got = cosine.best_of_blocks(table(x, "q"), table(y, "d"), k)
        border = -np.sort(-s, axis=1)[:, min(k, 40) - 1]
        want = {(i + 100, j + 100) for i, j in zip(*(z.tolist() for z in np.nonzero((s >= border[:, None] - cosine.SLACK) & (s > 0))))}
        assert set(zip(got.column("q").to_pylist(), got.column("d").to_pylist())) == want


def test_stored_documents_fold_equal_ones_and_keep_near_ties_apart(spark):
    """Documents are packed where they lie; equal ones are passed over, and single precision settles no order."""
    rows = [(0, ["a", "b"], [0.6, 0.8]), (1, ["a", "b"], [0.6, 0.8]), (2, ["a", "b"], [0.6, 0.8]), (3, ["a", "c"], [0.6 + 3e-8, 0.8]), (4, ["a", "c"], [0.6, 0.8])]
    rows += [(5, ["d"], [1e-30]), (None, ["a", "b"], [0.6, 0.8])]
    train = cosine.stored_vectors(spark.createDataFrame(rows, "id bigint, terms array<string>, weights array<double>"), "id")
    kept, members, owners = cosine.folded(train, 2)
    assert sorted(i for r in kept.collect() for i in r["drop"] or []) == [1, 2]
    assert sorted(sorted(r.members) for r in members.collect()) == [[0, 1], [3], [4], [5]] and owners.count() == 6
    asked = [(10, ["a"], [1.0]), (11, ["d"], [1e-30]), (12, ["x"], [1.0]), (13, ["a", "b"], [0.6, 0.8])]
    queries = cosine.stored_vectors(spark.createDataFrame(asked, "id bigint, terms array<string>, weights array<double>"), "id")
    found = cosine.cosine_neighbors(train, queries, "id", 2).orderBy("query", "rank").collect()
    assert [(r["query"], r.neighbor) for r in found] == [(10, 3), (10, 0), (11, 5), (13, 0), (13, 1)]


def test_units_of_many_keys_are_those_of_md5():
    from hashlib import md5

    from millrace.functions.hashing import Md5Units

    codes = [b"", b"1-2", "é-x".encode(), *(b"k" * n for n in range(45, 70))]
    units = Md5Units(codes)
    for prefix in (b"", b"42-7-", b"42-17-", b"42-8-"):
        wanted = [int.from_bytes(md5(prefix + c).digest()[:4], "big") / 4294967296.0 for c in codes]
        assert units(prefix).tolist() == wanted
    assert Md5Units([])(b"42-1-").tolist() == []
