"""Fitted chains, stored models, Bayes tables in blocks, and the solver behind the margin and grid fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import features as FE
from millrace.plans import bayes, chain, selection, solver, svm, tree
from millrace.plans import classification as C
from millrace.plans import regression as R
from millrace.streaming.scoring import feature_stream, score_stream

RNG = np.random.RandomState(5)


@pytest.fixture(scope="module")
def rows(spark):
    made = [(i, float(a), float(b), i % 4, f"k{i % 3}", int(a + b > 0), [float(a), float(b)], "x") for i, (a, b) in enumerate(RNG.normal(size=(120, 2)))]
    return spark.createDataFrame(made, "id BIGINT, a DOUBLE, b DOUBLE, c INT, s STRING, y INT, v ARRAY<DOUBLE>, `p.q` STRING").repartition(3)


def reloaded(spark, fitted, path):
    fitted.save(spark, str(path))
    return chain.FittedChain.load(spark, str(path))


def same(left, right):
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


def steps_of(rows):
    linear = R.LinearModel(["a", "b"], [0.25, -1.5, 3.0])
    yield chain.Step(FE.Scaler.standard(rows, ["a", "b"]))
    yield chain.Step(FE.Scaler([], [], []))
    yield chain.Step(FE.ArrayScaler.fit(rows, "v", 2), "v", "scaled")
    yield chain.Step(FE.OneHot.fit(rows, "s"), None, "slots")
    yield chain.Step(FE.OneHot.fit(rows, "c"), None, "slots")
    yield chain.Step(FE.ColumnProcessor.fit(rows, ["a", "c", "b"]), None, "features")
    yield chain.Step(linear, None, "score")
    yield chain.Step(C.LinearClassifier(np.array([[1.0, 0.5, 0.0], [0.0, 1.0, -1.0], [0.1, 0.2, 0.3]])), "v", "prediction")
    yield chain.Step(C.LinearClassifier(np.array([1.0, 1.0, 0.0])), "v", "prediction")
    yield chain.Step(tree.fit_tree(rows, ["a", "b"], "y", 2, "gini", max_depth=3))
    yield chain.Step(C.Network.start([2, 4, 3], 1, 0.7), "v", "prediction")
    yield chain.Step(bayes.DenseBayes.gaussian(bayes.gaussian_fit(rows, "v", "s", 0.1, 2)), "v", "prediction")
    for made in (R.PolynomialMap(2, 3, 0.5), R.FourierMap(2, 16, 0.5)):
        yield chain.Step(svm.fit_pair_machines(rows, F.col("v"), F.col("y"), F.lit(False), [(0, 1)], made), "v", "prediction")


def test_every_kind_is_stored(spark, rows, tmp_path):
    kinds = set()
    for i, step in enumerate(steps_of(rows)):
        fitted = chain.FittedChain([step])
        again = reloaded(spark, fitted, tmp_path / str(i))
        assert type(again.steps[0].model) is type(step.model) and (again.steps[0].features, again.steps[0].name) == (step.features, step.name)
        assert same(fitted.transform(rows), again.transform(rows))
        kinds.add(type(step.model))
    assert kinds == {cls for cls, _, _ in chain.KINDS.values()}


def test_long_parts_are_cut_into_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(chain, "SLICE", 3)
    net = C.Network.start([3, 5, 2], 1, 0.5)
    again = reloaded(spark, chain.FittedChain([chain.Step(net, "v", "p")]), tmp_path / "m").steps[0].model
    assert np.array_equal(again.pack(), net.pack()) and spark.read.parquet(str(tmp_path / "m")).count() > 8


def test_chain_fits_each_stage_on_what_came_before(spark, rows, tmp_path):
    marked = rows.withColumn("is_test", F.col("id") % 5 == 0)
    on_train = chain.drop_rows("is_test")
    stages = [chain.min_max(["a"]), chain.standardise(["a", "b"]), chain.process_columns(["a", "b", "c"], "features", False)]
    made = chain.Chain([on_train(s) for s in stages]).fit(marked)
    got = made.transform(marked)
    train = got.where("NOT is_test").agg(F.avg("a"), F.avg("b"), F.stddev_pop("a"), F.count("*")).first()
    assert [round(v, 9) for v in train[:3]] == [0.0, 0.0, 1.0] and train[3] == 96 and got.count() == 120
    assert same(got, reloaded(spark, made, tmp_path / "m").transform(marked))


def test_stream_equals_batch(spark, rows, tmp_path):
    plain = rows.drop("p.q")
    plain.write.parquet(str(tmp_path / "in"))
    made = chain.Chain(
        [chain.standardise(["a", "b"]), chain.Stage(lambda df: bayes.DenseBayes.gaussian(bayes.gaussian_fit(df, "v", "y", 0.1, 2)), "v", "prediction")]
    ).fit(plain)
    made = reloaded(spark, made, tmp_path / "m")
    stream = feature_stream(spark, str(tmp_path / "in"), plain.schema)
    score_stream(made, stream, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    assert same(spark.read.parquet(str(tmp_path / "out")), made.transform(plain))


def test_rows_without_usable_vector_get_no_prediction(spark):
    made = C.LinearClassifier(np.array([1.0, 1.0, 0.0]))
    odd = [(1, [1.0, 2.0]), (2, None), (3, [None, 1.0]), (4, [1.0]), (5, [-3.0, 0.5])]
    got = {r["id"]: r["prediction"] for r in made.transform(spark.createDataFrame(odd, "id INT, v ARRAY<DOUBLE>"), "v").collect()}
    assert got == {1: 1, 2: None, 3: None, 4: None, 5: 0}


def test_bayes_scores_any_number_of_classes(spark, monkeypatch):
    monkeypatch.setattr(bayes, "CLASS_BLOCK", 7)
    rng = np.random.RandomState(1)
    mean, variance, prior = rng.normal(size=(40, 3)), rng.uniform(0.5, 2, size=(40, 3)), rng.dirichlet(np.ones(40))
    mean[23], variance[23], prior[23] = mean[4], variance[4], prior[4]
    x = np.vstack([rng.normal(size=(60, 3)), mean[4]])
    model = spark.createDataFrame([(i, m.tolist(), v.tolist(), float(p)) for i, (m, v, p) in enumerate(zip(mean, variance, prior))], "class INT, mean ARRAY<DOUBLE>, variance ARRAY<DOUBLE>, prior DOUBLE")
    test = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id INT, v ARRAY<DOUBLE>")
    scores = np.log(prior) - 0.5 * (np.log(2 * np.pi * variance)[None] + (x[:, None] - mean[None]) ** 2 / variance[None]).sum(axis=2)
    got = {r["id"]: r["prediction"] for r in bayes.gaussian_predict(model, test, "v").collect()}
    assert [got[i] for i in range(61)] == np.round(scores, 9).argmax(axis=1).tolist() and 23 not in got.values()
    assert bayes.gaussian_predict(model.limit(0), test, "v").where("prediction IS NOT NULL").count() == 0


def test_sparse_bayes_in_blocks_equals_plain_counting(spark, monkeypatch):
    monkeypatch.setattr(bayes, "CLASS_BLOCK", 2)
    rng = np.random.RandomState(2)
    label = rng.randint(0, 5, 60)
    counts = rng.poisson(0.4 + 0.6 * (np.arange(30)[None, :] % 5 == label[:, None]))
    test = np.arange(60) % 3 == 0
    counts[3] = 0
    docs = spark.createDataFrame([(int(i), int(label[i]), bool(test[i])) for i in range(60)], "id BIGINT, y INT, is_test BOOLEAN")
    terms = spark.createDataFrame([(int(i), int(label[i]), bool(test[i]), f"t{j:02}", int(counts[i, j])) for i in range(60) for j in range(30) if counts[i, j]], "id BIGINT, y INT, is_test BOOLEAN, term STRING, cnt BIGINT")
    vocab = spark.createDataFrame([(f"t{j:02}",) for j in range(30)], "term STRING")
    for fit, count, seen in ((bayes.multinomial_fit, F.col("cnt"), counts), (bayes.bernoulli_fit, F.lit(1), (counts > 0).astype(int))):
        classes, weights = fit(terms.where("NOT is_test"), docs.where("NOT is_test"), "y", 0.1, vocab)
        got = {r["id"]: r["prediction"] for r in bayes.sparse_predict(classes, weights, terms.where("is_test"), docs.where("is_test"), "id", count).collect()}
        scores = []
        for k in range(5):
            own = ~test & (label == k)
            prior = np.log(own.sum() / (~test).sum())
            s = seen[own].sum(axis=0)
            if fit is bayes.multinomial_fit:
                scores.append(prior + seen @ np.log((s + 0.1) / (s.sum() + 0.1 * 30)))
            else:
                p = (s + 0.1) / (own.sum() + 0.2)
                scores.append(prior + seen @ np.log(p) + (1 - seen) @ np.log(1 - p))
        best = np.round(np.array(scores), 9).argmax(axis=0)
        assert got == {int(i): int(best[i]) for i in np.flatnonzero(test)}


def test_solver_reaches_optima_side_by_side():
    scans = []

    def evaluate(points):
        scans.append(len(points))
        made = {}
        for i, x in points.items():
            if i == 0:
                made[i] = (100 * (x[1] - x[0] ** 2) ** 2 + (1 - x[0]) ** 2, np.array([-400 * x[0] * (x[1] - x[0] ** 2) - 2 * (1 - x[0]), 200 * (x[1] - x[0] ** 2)]))
            else:
                scale = np.array([1.0, 1e4])
                made[i] = (float(scale @ (x - i) ** 2), 2 * scale * (x - i))
        return made

    done = solver.minimise(evaluate, [np.array([-1.2, 1.0]), np.zeros(2), np.zeros(2)], tolerance=1e-8)
    assert np.allclose(done[0].x, 1, atol=1e-5) and np.allclose(done[1].x, 1) and np.allclose(done[2].x, 2)
    assert scans[0] == 3 and scans[-1] == 1 and len(scans) < 100
    with pytest.raises(ArithmeticError):
        solver.minimise(evaluate, [np.array([-1.2, 1.0])], tolerance=1e-12, scans=5)


def test_blocks_of_models_change_nothing(spark, monkeypatch):
    rng = np.random.RandomState(4)
    x, y = rng.normal(size=(90, 2)), np.arange(90) % 3
    x += y[:, None]
    rows = [(x[i].tolist(), int(y[i]), int(y[i] > 0), int(i % 4) - 1) for i in range(90)]
    df = spark.createDataFrame(rows, "v ARRAY<DOUBLE>, k INT, y INT, fold INT")
    pairs = [(0, 1), (0, 2), (1, 2)]

    def fits():
        machines = svm.fit_pair_machines(df, F.col("v"), F.col("k"), F.lit(False), pairs, R.PolynomialMap(2, 2, 1.0), 1.0, 1e-7)
        return machines, selection.grid_search(df, F.col("v"), F.col("y"), F.col("fold"), 2, [1, 2], [0.1, 1.0], 3, 1e-7).collect()

    whole, grid = fits()
    for module in (svm, selection):
        monkeypatch.setattr(module, "VECTOR_CELLS", 8)
    monkeypatch.setattr(solver, "ROW_CELLS", 40)
    parts, again = fits()
    assert np.allclose(whole.weights, parts.weights, atol=1e-4) and np.allclose(whole.losses, parts.losses, atol=1e-8)
    assert [tuple(r)[:4] for r in grid] == [tuple(r)[:4] for r in again] and np.allclose([r.loss for r in grid], [r.loss for r in again])


def test_polynomial_map_is_the_kernel():
    rng = np.random.RandomState(6)
    for dims, degree, gamma in ((1, 4, 0.5), (4, 3, 2.0), (3, 1, 1.0), (70, 2, 0.3)):
        a, b = rng.normal(size=(5, dims)), rng.normal(size=(6, dims))
        made = R.PolynomialMap(dims, degree, gamma)
        assert made.apply(a).shape[1] == made.size and np.allclose(made.apply(a) @ made.apply(b).T, (gamma * a @ b.T + 1) ** degree)
