"""Text operators on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.strings import WESTERN, MarkTable, long_word_tokens
from millrace.operators import marks as MK
from millrace.operators import textstats
from millrace.plans import documents as DOC
from millrace.plans.regression import LinearModel
from millrace.sources import text as source
from millrace.streaming.scoring import feature_stream, score_stream


def test_context_at_both_ends(spark):
    df = spark.createDataFrame([(1, "čA")], "id INT, t STRING")
    rows = MK.letter_examples(df, ["id"], F.col("t")).orderBy("pos").collect()
    assert [(r.letter, r.context, r.cls) for r in rows] == [("c", "   ca  ", 2), ("A", "  ca   ", 0)]


def test_contexts_turn_noise_into_spaces(spark):
    df = spark.createDataFrame([(1, "x-e\n.")], "id INT, t STRING")
    assert [r.context for r in MK.letter_examples(df, ["id"], F.col("t")).collect()] == [" x e   "]


def test_counted_contexts_are_those_of_all_letters(spark):
    texts = ["Žáček, a-b.\nč", "", None, "e", "\U0001f600ab\U0001f600\U0001f601ýc\U0001f600", "İa Σa ΑΣ", "xx", "ab ab ab", "   ", "a\r\u2028e"]
    df = spark.createDataFrame([(i % 2, i, t) for i, t in enumerate(texts * 2)], "half INT, id INT, t STRING")
    for marks in (MarkTable(), WESTERN):
        letters = MK.letter_examples(df, ["id", "half"], F.col("t"), marks).groupBy("half", "context", "cls").agg(F.count(F.lit(1)).alias("n"))
        counted = MK.context_counts(df, ["half"], F.col("t"), marks)
        assert counted.columns == letters.columns and sorted(map(tuple, counted.collect())) == sorted(map(tuple, letters.collect()))
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_zip" not in plan and plan.count("regexp_extract_all") == 1



def test_dictionary_examples_repeat_per_variant(spark):
    d = spark.createDataFrame([("sad", ["sad", "sád"])], "word STRING, variants ARRAY<STRING>")
    rows = MK.dictionary_examples(d).orderBy("number", "pos").collect()
    assert [(r.letter, r.cls) for r in rows] == [("s", 0), ("a", 0), ("d", 0), ("s", 0), ("a", 1), ("d", 0)]


@pytest.mark.parametrize("low,expected", [(0, ["sád"]), (49, ["sád"]), (50, ["sad", "sád"])])
def test_refinement_depends_on_the_rarest_variant(spark, low, expected):
    d = spark.createDataFrame([("Sad", ["Sad", "Sád"])], "word STRING, variants ARRAY<STRING>")
    counts = spark.createDataFrame([("sad", low), ("sád", 60)], "word STRING, n INT")
    row = MK.refine_dictionary(d, counts).first()
    assert (row.word, row.variants) == ("sad", expected)


def test_refinement_keeps_all_variants_that_never_occur(spark):
    d = spark.createDataFrame([("sad", ["sad", "sád"])], "word STRING, variants ARRAY<STRING>")
    counts = spark.createDataFrame([("les", 5)], "word STRING, n INT")
    assert MK.refine_dictionary(d, counts).first().variants == ["sad", "sád"]


def test_words_are_replaced_and_case_restored(spark):
    d = spark.createDataFrame([("cas", ["čas"]), ("sad", ["sad", "sád"])], "word STRING, variants ARRAY<STRING>")
    docs = spark.createDataFrame([(1, "Cas, cas-sad! LES\ncas")], "id INT, t STRING")
    assert MK.restore_words(docs, "id", "t", d).first().text == "Čas, čas-sad! Les\nčas"


def test_restored_text_differs_only_in_marks(spark):
    text = "Žluťoučký kůň úpěl ďábelské ódy."
    docs = spark.createDataFrame([(1, text)], "id INT, t STRING")
    model = MK.context_model(MK.letter_examples(docs, ["id"], F.col("t")))
    source_, target = MarkTable().translation()
    plain = spark.createDataFrame([(1, text.translate(str.maketrans(source_, target)))], "id INT, t STRING")
    assert MK.restore_marks(plain, "id", "t", model).first().text == text


def test_contexts_that_ask_for_a_mark_travel_to_the_letters(spark, capsys):
    learned = spark.createDataFrame([(1, "čas je sad, čas a čáp")], "id INT, t STRING")
    model = MK.context_model(MK.letter_examples(learned, ["id"], F.col("t")))
    docs = spark.createDataFrame([(1, "cas a cap"), (1, "cas"), (None, "sad je cas"), (2, ""), (3, None)], "id INT, t STRING")
    sent, shuffled = MK.restore_marks(docs, "id", "t", model), MK.restore_marks(docs, "id", "t", model, most=0)
    rows = lambda df: sorted(((r.id, r.text) for r in df.collect()), key=str)
    assert rows(sent) == rows(shuffled) and (1, "čas a čáp") in rows(sent)
    letters = lambda df: [line for line in (df.explain("simple"), capsys.readouterr().out)[1].splitlines() if "hashpartitioning(context" in line]
    assert not letters(sent) and letters(shuffled)


def test_patches_leave_the_rest_of_the_text(spark):
    rows = spark.createDataFrame([(["a", "b", "c", "d"], [(0, "A"), (3, "D")]), (["a", "b"], None), (["a"], []), ([], None), (["a", "b", "c"], [(1, "XY")])],
                                 "p ARRAY<STRING>, c ARRAY<STRUCT<pos: INT, piece: STRING>>")
    found = rows.select(F.array_join(MK.patched(F.col("p"), F.col("c")), "").alias("t")).collect()
    assert [r.t for r in found] == ["AbcD", "ab", "a", "", "aXYc"]


def test_restoring_odd_rows(spark):
    d = spark.createDataFrame([("cas", ["čas"]), ("a", ["á"])], "word STRING, variants ARRAY<STRING>")
    long = "Cas a " * 60_000
    texts = [(1, "cas"), (1, "x cas"), (1, "cas"), (None, "Cas"), (None, "a, a"), (2, ""), (3, None), (4, "..."), (5, long), (6, "McX")]
    docs = spark.createDataFrame(texts, "id INT, t STRING")
    found = sorted(((r.id, r.text) for r in MK.restore_words(docs, "id", "t", d).collect()), key=str)
    wanted = [(1, "čas"), (1, "x čas"), (1, "čas"), (None, "Čas"), (None, "á, á"), (2, ""), (3, None), (4, "..."), (5, "Čas á " * 60_000), (6, "Mcx")]
    assert found == sorted(wanted, key=str)
    assert MK.restore_words(docs.limit(0), "id", "t", d).count() == 0
    learned = MK.context_model(MK.letter_examples(spark.createDataFrame([(1, "čas")], "id INT, t STRING"), ["id"], F.col("t")))
    found = sorted(((r.id, r.text) for r in MK.restore_marks(docs.where("id < 5 or id is null"), "id", "t", learned).collect()), key=str)
    wanted = [(1, "čas"), (1, "x cas"), (1, "čas"), (None, "Čas"), (None, "a, a"), (2, ""), (3, None), (4, "...")]
    assert found == sorted(wanted, key=str)


def test_negative_idf_and_documents_without_known_terms(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "aa bb"), (3, "aa bb"), (4, "zz")], "id INT, t STRING")
    terms = textstats.term_counts(docs, "id", long_word_tokens(F.col("t")))
    vocab = textstats.inverse_frequency(textstats.vocabulary(terms.where("id < 4")), F.lit(3))
    assert {r.term: round(r.idf, 6) for r in vocab.collect()} == {"aa": -0.287682, "bb": -0.287682}
    weighted = textstats.weights(terms, vocab, "tfidf", "id")
    assert weighted.where("id = 4").count() == 0
    assert {r.doc_len for r in terms.where("id = 1").collect()} == {3}


def test_counting_terms_and_sums_by_document_share_one_shuffle(spark):
    docs = spark.createDataFrame([(i, "aa bb aa") for i in range(9)], "id INT, t STRING")
    sums = textstats.term_counts(docs, "id", long_word_tokens(F.col("t"))).groupBy("id").agg(F.sum("tf_count"))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("regexp_extract_all") == 1
    assert {tuple(r) for r in sums.collect()} == {(i, 3) for i in range(9)}


@pytest.mark.parametrize("most", [0, 60, 1000])
def test_frequent_and_rare_terms_meet_the_vocabulary_alike(spark, most):
    terms = spark.createDataFrame([(i, t) for i in range(8) for t in ("aa", f"b{i % 4}", "zz")], "id INT, term STRING")
    vocab = terms.where("term <> 'zz'").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    found = textstats.by_term(terms, vocab, most)
    assert sorted(map(tuple, found.select("id", "term", "df").collect())) == sorted([(i, "aa", 8) for i in range(8)] + [(i, f"b{i % 4}", 2) for i in range(8)])


@pytest.mark.parametrize("most", [0, 1000])
def test_words_with_marks_and_capitals_are_restored_on_both_ways(spark, most):
    docs = spark.createDataFrame([(1, "CAS sád Sád, SAD cas"), (1, "İx cás"), (2, "nic"), (3, None)], "id INT, t STRING")
    d = spark.createDataFrame([("cas", ["čas"]), ("sad", ["sad"]), ("i̇x", ["i̇x"])], "word STRING, variants ARRAY<STRING>")
    found = MK.restore_words(docs, "id", "t", d, most=most).collect()
    assert {(r.id, r.text) for r in found} == {(1, "Čas sad Sad, Sad čas"), (1, "I\u0307x čas"), (2, "nic"), (3, None)}


def test_the_text_classifier_fits_on_one_partition_a_core(spark, monkeypatch):
    seen = []
    real = DOC.library_logistic

    def library(*settings):
        made = real(*settings)
        fit = made.fit
        made.fit = lambda data: seen.append(data.rdd.getNumPartitions()) or fit(data)
        return made

    monkeypatch.setattr(DOC, "library_logistic", library)
    rows = [(i, "good fine good", 0) if i % 2 else (i, "bad awful bad", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "id BIGINT, t STRING, y INT").repartition(40)
    monkeypatch.setattr(DOC, "cached", lambda df: __import__("contextlib").nullcontext(df.repartition(40)))
    DOC.TextClassifier.fit(docs, "id", "t", "y", 100.0)
    assert seen and seen[0] <= spark.sparkContext.defaultParallelism


def test_queries_without_common_terms_fall_back_to_lowest_ids(spark):
    rows = [(i, "red fox red fox", "a") for i in range(8)] + [(i, f"word{i}", "b") for i in range(8, 12)]
    docs = spark.createDataFrame(rows, "id BIGINT, t STRING, y STRING")
    out = DOC.nearest_labels(docs, "id", "t", "y", 0.4, k=2, seed=3)
    assert out.count() == out.select("query").distinct().count()
    assert out.where("prediction IS NULL").count() == 0


def test_label_lines_strip_the_mark_and_fail_on_bad_rows(spark, tmp_path):
    path = tmp_path / "lines.tsv"
    path.write_text("﻿1\tjá vím\n0\tok\n", encoding="utf-8")
    rows = source.read_label_lines(spark, str(path)).collect()
    assert [(r.label, r.text) for r in rows] == [(1, "já vím"), (0, "ok")]
    path.write_text("1\ta\tb\n", encoding="utf-8")
    with pytest.raises(Exception):
        source.read_label_lines(spark, str(path)).collect()


def test_last_dictionary_line_wins(spark, tmp_path):
    path = tmp_path / "dictionary.txt"
    path.write_text("﻿cas čas\nsad sad sád\ncas  čas  cas\n", encoding="utf-8")
    rows = {r.word: r.variants for r in source.read_variant_lines(spark, str(path)).collect()}
    assert rows == {"cas": ["čas", "cas"], "sad": ["sad", "sád"]}
    assert source.read_corpus(spark, str(path), whole=True).count() == 1


def test_text_classifier_is_stored_with_its_vocabulary(spark, tmp_path):
    rows = [(i, "good fine good", 0) if i % 2 else (i, "bad awful bad", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "id BIGINT, t STRING, y INT")
    DOC.TextClassifier.fit(docs, "id", "t", "y", 100.0).save(str(tmp_path / "m"))
    scored = DOC.TextClassifier.load(spark, str(tmp_path / "m")).transform(docs, "id", "t").join(docs, "id")
    assert scored.where("prediction <> y").count() == 0


def test_stream_scoring_equals_batch(spark, tmp_path):
    rows = spark.range(20).select("id", (F.col("id") * 0.5).alias("a"))
    rows.write.parquet(str(tmp_path / "in"))
    model = LinearModel(["a"], [2.0, 1.0])
    stream = feature_stream(spark, str(tmp_path / "in"), "id BIGINT, a DOUBLE")
    score_stream(model, stream, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, model.transform(rows).collect()))


def test_words_and_letters_without_a_partner_do_not_move(spark):
    """Of words and letters only those that find a partner are shuffled, and texts and patches are dealt out once."""
    docs = spark.range(200).select("id", F.concat(F.lit("cas word "), F.col("id").cast("string"), F.lit(" sam")).alias("t"))
    many = spark.range(500).select(F.concat(F.lit("sad"), F.col("id").cast("string")).alias("k"))
    rows = many.select("k").unionByName(spark.range(20_000).select(F.concat(F.lit("other"), F.col("id").cast("string")).alias("k")))
    kept = [r.k for r in MK.may_meet(rows, "k", many).collect()]
    assert sum(k.startswith("sad") for k in kept) == 500 and len(kept) < 600
    assert MK.may_meet(rows, "k", many.limit(0)).count() == 0
    dictionary = spark.createDataFrame([("cas", ["čas"]), ("word", ["word"])], "word string, variants array<string>")
    for most in (0, 1 << 20):
        out = MK.restore_words(docs, "id", "t", dictionary, most=most)
        assert sorted(r.t for r in out.withColumnRenamed("text", "t").collect()) == sorted(f"čas word {i} sam" for i in range(200))
        plan = out._jdf.queryExecution().executedPlan().toString()
        # The text's own hash deals out texts, words and patches: the key never does.
        assert "hashpartitioning(id" not in plan and "hashpartitioning(coalesce(id" not in plan
