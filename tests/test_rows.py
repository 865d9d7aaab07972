"""Row operators, splits, ranks and scores on hand-made rows."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import columns as X
from millrace.functions import strings as S
from millrace.operators import features as FE
from millrace.operators import metrics as M
from millrace.operators import sampling
from millrace.operators.ordering import running_totals, with_rank


def one(df):
    return df.first()[0]


def test_sizes_are_parsed_like_the_command_line():
    assert sampling.parse_size("20") == 20
    assert sampling.parse_size("0.5") == 0.5


@pytest.mark.parametrize("n", [1, 7, 499, 999])
def test_exact_split_has_exactly_n_rows(spark, n):
    rows = spark.range(1000)
    assert sampling.with_split(rows, [F.col("id")], n).where("is_test").count() == n


def test_split_does_not_hang_on_partitions(spark):
    def ids(parts):
        marked = sampling.with_split(spark.range(500).repartition(parts), [F.col("id")], 0.3)
        return sorted(r.id for r in marked.where("is_test").collect())

    assert ids(1) == ids(7)


def test_rank_crosses_ranges(spark):
    rows = spark.range(3000).select((F.col("id") * 7 % 3000).alias("v"), (F.col("id") % 2).alias("k"))
    ranked = with_rank(rows, [], ["v"], rows_per_range=100)
    assert ranked.where("rank <> v").count() == 0
    per_key = with_rank(rows, ["k"], ["v"], rows_per_range=100)
    assert per_key.groupBy("k").agg((F.max("rank") - F.count("*")).alias("d")).where("d <> -1").count() == 0


def test_running_totals_look_ahead_over_range_borders(spark):
    rows = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 8.0)], "v DOUBLE")
    done = running_totals(rows, [], ["v"], {"s": F.col("v")}, [2.0, 5.0], {"n": F.col("v")})
    assert sorted((r.v, r.s, r.n) for r in done.collect()) == [(1.0, 1.0, 2.0), (2.0, 3.0, 4.0), (4.0, 7.0, 8.0), (8.0, 15.0, None)]


def test_stratified_folds_take_remainders_first(spark):
    rows = spark.createDataFrame([(i, 0) for i in range(7)] + [(i, 1) for i in range(10, 13)], "id INT, y INT")
    folds = {r.id: r.fold for r in sampling.with_stratified_fold(rows, "y", ["id"]).collect()}
    assert [folds[i] for i in range(7)] == [0, 0, 1, 1, 2, 3, 4]
    assert [folds[i] for i in range(10, 13)] == [0, 1, 2]


def test_bootstrap_weight_is_about_one(spark):
    rows = sampling.bootstrap_rows(spark.range(4000), ["id"], 10)
    total = rows.agg(F.sum("weight")).first()[0]
    assert abs(total / 40000 - 1) < 0.03


def test_argmax_and_hit_rules(spark):
    row = spark.createDataFrame([([1.0, 3.0, 3.0],)], "a ARRAY<DOUBLE>")
    assert one(row.select(X.argmax(F.col("a")))) == 1
    assert row.select(X.probability_hit(F.lit(0), F.lit(0.5)), X.probability_hit(F.lit(1), F.lit(0.5))).first()[:] == (True, True)
    assert one(row.select(X.sign_label(F.lit(0.0)))) == -1


def test_softmax_survives_large_scores(spark):
    p = one(spark.createDataFrame([([1000.0, 1000.0],)], "a ARRAY<DOUBLE>").select(X.softmax(F.col("a"))))
    assert p == [0.5, 0.5]


def test_zero_vector_stays_zero(spark):
    assert one(spark.createDataFrame([([0.0, 0.0],)], "a ARRAY<DOUBLE>").select(X.l2_normalized(F.col("a")))) == [0.0, 0.0]


def test_f_beta_without_edits_is_guarded(spark):
    value = one(spark.range(1).select(M.f_beta(F.lit(0), F.lit(0), F.lit(0), F.lit(0.0))))
    assert value == 0.0


def test_constant_columns(spark):
    rows = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "a DOUBLE, b DOUBLE")
    assert [tuple(r) for r in FE.Scaler.min_max(rows, ["a", "b"]).transform(rows).collect()] == [(0.0, 0.0), (0.0, 1.0)]
    assert [r.a for r in FE.Scaler.standard(rows, ["a"]).transform(rows).collect()] == [0.0, 0.0]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e3, 1e3), min_size=3, max_size=30))
def test_standardised_mean_and_variance(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values], "v DOUBLE")
    done = FE.Scaler.standard(rows, ["v"]).transform(rows).agg(F.avg("v"), F.var_pop("v")).first()
    assert abs(done[0]) < 1e-6
    assert abs(done[1] - 1) < 1e-6 or len({round(v, 6) for v in values}) < 2 or done[1] == 0


def test_unknown_category_is_all_zero(spark):
    train = spark.createDataFrame([(3,), (1,)], "c INT")
    slots = FE.OneHot.fit(train, "c").slots()
    got = spark.createDataFrame([(1,), (2,), (3,)], "c INT").select(*slots).collect()
    assert [tuple(r) for r in got] == [(1.0, 0.0), (0.0, 0.0), (0.0, 1.0)]


def test_degree_two_order(spark):
    row = spark.createDataFrame([(2.0, 3.0)], "a DOUBLE, b DOUBLE")
    assert row.select(*FE.degree_two([F.col("a"), F.col("b")])).first()[:] == (2.0, 3.0, 4.0, 6.0, 9.0)
    assert len(FE.polynomial([F.col("a"), F.col("b")], 3)) == 10


def test_tokens(spark):
    row = spark.createDataFrame([("čas a_1 x",)], "t STRING")
    assert one(row.select(S.word_tokens(F.col("t")))) == ["čas", "a_1", "x"]
    assert one(row.select(S.long_word_tokens(F.col("t")))) == ["čas", "a_1"]
    assert one(row.select(S.letter_runs(F.lit("Ab1 č.")))) == ["Ab", "1", " ", "č", "."]
    assert one(row.select(S.strip_marks(F.lit("Žluťoučký kůň")))) == "Zlutoucky kun"


def test_mark_classes_and_marked_letters(spark):
    row = spark.range(1)
    assert row.select(*[S.mark_class(F.lit(c)) for c in "áčůaŽ"]).first()[:] == (1, 2, 3, 0, 2)
    pairs = [("e", 1), ("C", 2), ("u", 3), ("b", 1), ("U", 3), ("e", 0)]
    assert row.select(*[S.add_mark(F.lit(c), F.lit(k)) for c, k in pairs]).first()[:] == ("é", "Č", "ů", "b", "Ů", "e")


def test_capital_letter_rule(spark):
    assert one(spark.range(1).select(S.capitalized(F.lit("pRAHA")))) == "Praha"


def test_grids(spark):
    even, logs = spark.range(1).select(X.even_grid(F.lit(0.0), F.lit(2.0), 201), X.log_grid(0.01, 10, 500)).first()
    assert len(even) == 201 and even[1] == pytest.approx(0.01) and even[-1] == 2.0
    assert len(logs) == 500 and logs[0] == pytest.approx(0.01) and logs[-1] == pytest.approx(10.0)


def test_weighted_vote_ties_go_to_the_lowest_class(spark):
    rows = spark.createDataFrame([(1, 5, 0.5), (1, 2, 0.25), (1, 2, 0.25)], "q INT, y INT, w DOUBLE")
    assert M.weighted_vote(rows, "q", "y", F.col("w")).first()["prediction"] == 2


def test_gaussian_density(spark):
    value = one(spark.range(1).select(X.log_normal_density(F.lit(1.0), F.lit(0.0), F.lit(4.0))))
    assert value == pytest.approx(-0.5 * math.log(2 * math.pi * 4) - 1 / 8)


def test_context_code_lists():
    assert len(S.FOLDED_CODES) == 41
    assert sorted(set(S.FOLDED_CODES)) == S.FOLDED_CODES


def test_sparse_columns_equal_the_dense_form(spark):
    rng = np.random.RandomState(3)
    rows = [(int(a), float(b), int(c), "x") for a, b, c in zip(rng.randint(0, 5, 40), rng.normal(size=40).round(3), rng.randint(-2, 2, 40))]
    df = spark.createDataFrame(rows, "a INT, b DOUBLE, c INT, slots STRING")
    new = spark.createDataFrame([(9, 0.5, 0, "y"), (None, 0.25, 1, None)], df.schema)
    for expand in (True, False):
        dense = FE.ColumnProcessor.fit(df, ["a", "b", "c"], expand)
        sparse = FE.SparseColumns.fit(df, ["a", "b", "c"], expand)
        for part in (df, new):
            want = {(r.a, r.b, r.c): [0.0 if v is None else v for v in r.features] for r in dense.transform(part).collect()}
            for r in sparse.transform(part, "at", "values").collect():
                full = np.zeros(sparse.size())
                full[r["at"]] = r["values"]
                assert full.tolist() == pytest.approx(want[r.a, r.b, r.c]) and list(r["at"]) == sorted(r["at"]) and r.slots in ("x", "y", None)
    assert FE.SparseColumns.fit(df, ["a"]).transform(df.limit(0)).count() == 0


def test_exact_sum_beyond_64_bits(spark):
    values = [2**62, 2**62 + 3, 2**62, -5, -(2**33) - 1]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v BIGINT")
    assert int(rows.agg(X.exact_sum(F.col("v")).alias("s")).first().s) == sum(values)


def test_slot_sums_beyond_64_bits(spark):
    """Sums that pass 64 bits are whole; those that do not keep the type of SQL."""
    from millrace.queries.columns import _slot_sums

    for slot, kind in ((5, "bigint"), (2**62, "decimal(32,0)")):
        got = _slot_sums(spark.createDataFrame([(1, slot, 0.5)] * 3 + [(2, 7, 1.0)], "l_linenumber INT, slots BIGINT, values DOUBLE"))
        assert dict(got.dtypes)["slot_sum"] == kind
        assert sorted((r.l_linenumber, r.set_slots, int(r.slot_sum), r.last_slot, r.value_sum) for r in got.collect()) == [(1, 3, 3 * slot, slot, 1.5), (2, 1, 7, 7, 1.0)]
