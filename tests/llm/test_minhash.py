"""Near-dedup against all pairs, and the cases a corpus brings."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import minhash, textnum

SCHEMA = "doc_id bigint, text string"


def words(rng, n, letters="abcdefghij"):
    return [("".join(rng.choice(letters) for _ in range(rng.randint(2, 9)))) for _ in range(n)]


def changed(rng, base, share):
    return [w if rng.random() > share else "".join(rng.choice("klmnop") for _ in range(5)) for w in base]


def components_by_all_pairs(spark, rows, least):
    table = spark.createDataFrame(rows, SCHEMA)
    idf = minhash.word_weights(table.select(F.coalesce("text", F.lit("")).alias("text")))
    sets = {i: minhash.weigh(textnum.words_of([t or ""])[0], idf) for i, t in rows}
    full = [i for i in sets if len(sets[i][0])]
    links = [(a, b) for n, a in enumerate(full) for b in full[n + 1 :] if minhash.likeness(sets[a], sets[b]) >= least]
    return brute.roots(list(sets), links), sets


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(12):
        base = words(rng, rng.randint(30, 150))
        rows += [" ".join(changed(rng, base, share)) for share in (0.0, 0.004, 0.01, 0.02, 0.04, 0.1)]
    rows += [" ".join(words(rng, rng.randint(1, 80))) for _ in range(20)] + [None, "", "...", "one", "one", "One!"]
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, seed):
    rows = corpus(seed)
    expected, _ = components_by_all_pairs(spark, rows, 0.8)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert got == expected and len(set(expected.values())) < len(rows) - 20


def test_template_pages_in_few_jobs(spark, monkeypatch):
    """Texts of one template, alike by 0.6 to 0.75, with a few true groups among them: crowded buckets without links."""
    rng = random.Random(5)
    shared = [words(rng, 12) for _ in range(10)]
    page = lambda: [w for part in shared for w in part + words(rng, 3)]
    pages = [page() for _ in range(300)]
    rows = [(i, " ".join(p)) for i, p in enumerate(pages)]
    rows += [(1000 + i, " ".join(pages[i * 20][:-2] + ["new", "end"])) for i in range(8)]
    expected, sets = components_by_all_pairs(spark, rows, 0.8)
    monkeypatch.setattr(minhash, "BLOCK", 64)
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("template", "template")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    jobs = len(status.getJobIdsForGroup("template"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == expected and len([i for i in expected if expected[i] != i]) >= 8
    assert jobs < 150


def test_block_likeness_equals_pair_likeness():
    rng = np.random.default_rng(1)
    sets = []
    for _ in range(40):
        kinds = np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64))
        sets.append((kinds, rng.choice([1.0, 1.5, 3.0, 4.5], len(kinds))))
    made = minhash.likenesses(sets)
    pairs = ~np.eye(40, dtype=bool)
    assert np.allclose(made[pairs], np.array([[minhash.likeness(a, b) for b in sets] for a in sets])[pairs])


def test_rare_words_share_a_weight():
    weights = minhash.WordWeights(np.array([3, 9], np.uint64), np.array([1.0, 2.0]), 7.0)
    assert weights.of(np.array([9, 4, 3, 10], np.uint64)).tolist() == [2.0, 7.0, 1.0, 7.0]
    assert minhash.WordWeights(np.zeros(0, np.uint64), np.zeros(0), 7.0).of(np.array([9], np.uint64)).tolist() == [7.0]


def test_columns_of_any_name_stay(spark):
    rng = random.Random(9)
    base = words(rng, 60)
    rows = [(1, " ".join(base), "q", 5, "r", 1.5), (2, " ".join(base[:-1] + ["end"]), "w", 6, "s", 2.5), (3, " ".join(words(rng, 40)), None, None, None, None)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, _id string, _mark bigint, `a.b` string, id double")
    assert sorted(map(repr, minhash.keep_one(table).collect())) == sorted(map(repr, table.where("doc_id <> 2").collect()))
    assert minhash.keep_one(table).columns == table.columns


def test_very_long_text(spark):
    rng = random.Random(3)
    text = " ".join(words(rng, 300_000))
    rows = [(1, text), (2, text + " more"), (3, "short one")]
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
