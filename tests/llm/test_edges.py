"""Empty tables, nulls, repeated rows, odd column names and very long texts, for the operators and the pipeline's stages."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import lines, minhash, mixing, packing, phrases, quality, spots, suffixes, tokens, transducer, vectors, whitening, wrappers

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD = f"{DOCS}, `a.b` string, id bigint, score double, mark string, row string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def rows_of(rng):
    texts = [words(rng, rng.randint(5, 60)) for _ in range(14)] + [None, "", " \n\t", "é" * 300]
    shared = words(rng, 15)
    texts += [f"{shared}\n{words(rng, 20)}" for _ in range(7)]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, words(rng, 30), "en", "s0", 1), (None, None, None, None, None), (2, words(rng, 25), "fr", "s1", 9)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(random.Random(2)), DOCS).repartition(3)


@pytest.fixture(scope="module")
def odd(docs):
    more = {"a.b": F.lit("q"), "id": F.lit(7).cast("bigint"), "score": F.lit(0.25), "mark": F.lit("m"), "row": F.lit("r")}
    for name, value in more.items():
        docs = docs.withColumn(name, value)
    return docs


QUERIES = {"op1": minhash, "op2": suffixes, "op3": spots, "op4": mixing, "op7": packing, "op8": lines, "op9": tokens, "op12": transducer, "op13": phrases}


@pytest.mark.parametrize("name", QUERIES)
def test_documents_empty_or_with_odd_columns(docs, odd, name):
    query = QUERIES[name].query
    assert query(docs.limit(0)).count() == 0
    plain, wide = query(docs), query(odd)
    common = [c for c in plain.columns if c != "sequence_id"]
    assert sorted(map(repr, plain.select(*common).collect())) == sorted(map(repr, wide.select(*common).collect()))


def test_other_tables_empty(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    found = quality.query(docs, labels).collect()
    assert len(found) == docs.count() and all(r["held_out"] is not None and 0 <= r["score"] <= 1 for r in found)
    assert quality.query(docs.limit(0), labels).count() == 0
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert vectors.query(none).count() == 0 and whitening.query(none).count() == 0
    assert wrappers.query(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_pages_odd(spark):
    rows = [(None, None, None, "x"), (None, "http://h/a", "<p>one</p>", "x"), (1, "", "", "x"), (1, "http://h/a", "<p>one</p>" * 3, "x"), (2, "::", "<" * 500, "x")]
    found = wrappers.query(spark.createDataFrame(rows, "page_id bigint, url string, html string, `a.b` string")).collect()
    assert len(found) == 5 and all(r["n_chars"] == len(r["text"]) for r in found)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = tmp_path_factory.mktemp("tables")
    labels = [(i, i % 2, 0) for i in range(20)] + [(None, 1, 0), (3, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(place / "labels.parquet"))
    return str(place)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=[name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_rows_of_documents(spark, docs, odd, folder, stage):
    name, run = stage
    made = run(spark, odd, folder)
    assert made.columns == odd.columns
    assert made.where("`a.b` <> 'q' or id <> 7 or mark <> 'm' or row <> 'r' or `a.b` is null").count() == 0
    assert run(spark, odd.limit(0), folder).count() == 0
    ids = {r["doc_id"] for r in made.collect()}
    assert ids <= {r["doc_id"] for r in docs.collect()}
    if name == "line dedup":
        assert made.count() == docs.count() and made.where("n_chars <> char_length(text)").count() == 0
    if name == "minhash near-dedup":
        assert made.where("doc_id = 3").count() == 1 and made.where("text is null").count() == 2
    if name == "source mixing":
        assert ids == {r["doc_id"] for r in docs.collect()}


def test_last_stage(spark, odd, docs, folder):
    made = corpus_pipeline.pack(spark, odd, folder)
    assert made.agg(F.sum("length")).first()[0] == made.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert made.where("start = 0").count() == docs.count() and corpus_pipeline.pack(spark, odd.limit(0), folder).count() == 0


def test_a_very_long_text_everywhere(spark):
    rng = random.Random(8)
    text = "\n".join(words(rng, 400) for _ in range(400)) + "x" * 200_000
    table = spark.createDataFrame([(1, text, "en", "s", 1), (2, "short", "en", "s", 1)], DOCS)
    for module in (suffixes, spots, mixing, packing, lines, transducer, phrases):
        assert module.query(table).count() >= 0
    assert suffixes.query(table).where("doc_id = 1").first()["n_bytes"] == len(text)
    assert lines.query(table).where("doc_id = 1").first()["n_lines"] == 400
