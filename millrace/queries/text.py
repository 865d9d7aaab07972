"""Text statistics, document classification, mark restoration."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import strings as S
from millrace.operators import features as FE
from millrace.operators import marks as MK
from millrace.operators import sampling, textstats
from millrace.plans import classification, documents as DOC
from millrace.queries.common import SEED, Registry, documents, sql_unit, text_parts
from millrace.session import cut_lineage
from millrace.sources import text as source
from millrace.sources.tables import table

registry = Registry()
MARKS = S.WESTERN


def _split(spark, folder, size=0.25, seed=SEED):
    return sampling.with_split(documents(spark, folder).select("doc_id", "text", "lang"), [F.col("doc_id")], size, seed)


_D = f"d AS (SELECT doc_id, text, lang, {sql_unit(SEED, 'doc_id')} < 0.25 AS is_test FROM documents)"
_LONG = r"regexp_extract_all(text, '[\p{L}\p{N}_]{2,}')"
_T = f"""{_D}, w AS (SELECT doc_id, lang, is_test, unnest({_LONG}) AS term FROM d),
  t AS (SELECT *, (sum(tf_count) OVER (PARTITION BY doc_id))::BIGINT AS doc_len FROM (SELECT doc_id, lang, is_test, term, count(*) AS tf_count FROM w GROUP BY ALL)),
  vocab AS (SELECT term, sum(tf_count)::BIGINT AS cnt, count(*) AS df FROM t WHERE NOT is_test GROUP BY 1 HAVING sum(tf_count) > 1),
  idf AS (SELECT term, cnt, df, ln((SELECT count(*) FROM d WHERE NOT is_test)::DOUBLE / (df + 1)) AS idf FROM vocab)"""


@registry.add("word_counts", r"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM documents) GROUP BY 1""")
def word_counts(spark, folder):
    return textstats.word_counts(documents(spark, folder), S.word_tokens(F.col("text")))


@registry.add(
    "space_tokens",
    r"""SELECT doc_id, len(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '')) AS n,
        list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: w <> '')[1] AS first FROM documents""",
)
def space_tokens(spark, folder):
    tokens = documents(spark, folder).select("doc_id", S.space_tokens(F.col("text")).alias("t"))
    return tokens.select("doc_id", F.size("t").cast("bigint").alias("n"), F.try_element_at("t", F.lit(1)).alias("first"))


@registry.add("vocab", f"WITH {_T} SELECT term, cnt, df, row_number() OVER (ORDER BY term) - 1 AS term_idx FROM vocab")
def vocab(spark, folder):
    terms = textstats.term_counts(_split(spark, folder), "doc_id", S.long_word_tokens(F.col("text")), "is_test", parts=text_parts(spark, folder))
    return textstats.vocabulary(terms.where("NOT is_test"), indexed=True)


@registry.add("doc_freq", f"WITH {_T} SELECT term, df, round(idf, 8) AS idf FROM idf")
def doc_freq(spark, folder):
    docs = _split(spark, folder)
    terms = textstats.term_counts(docs, "doc_id", S.long_word_tokens(F.col("text")), "is_test", parts=text_parts(spark, folder))
    known = textstats.vocabulary(terms.where("NOT is_test"))
    rows = textstats.inverse_frequency(known, docs.where("NOT is_test").agg(F.count(F.lit(1))).scalar())
    return rows.select("term", "df", F.round("idf", 8).alias("idf"))


@registry.add("doc_terms", f"WITH {_T} SELECT doc_id, max(doc_len) AS doc_len, count(*) AS terms, max(tf_count) AS top, sum(tf_count)::BIGINT AS tokens FROM t GROUP BY 1")
def doc_terms(spark, folder):
    terms = textstats.term_counts(documents(spark, folder), "doc_id", S.long_word_tokens(F.col("text")), parts=text_parts(spark, folder))
    return terms.groupBy("doc_id").agg(
        F.max("doc_len").alias("doc_len"), F.count(F.lit(1)).alias("terms"), F.max("tf_count").alias("top"), F.sum("tf_count").alias("tokens")
    )


_VARIANT = {"tfidf": "tf_count / doc_len::DOUBLE * idf", "tf": "tf_count / doc_len::DOUBLE", "idf": "idf", "binary": "1.0::DOUBLE"}


def _weights_query(variant):
    def run(spark, folder):
        weighted, _ = DOC.split_weights(_split(spark, folder), "doc_id", S.long_word_tokens(F.col("text")), variant, parts=text_parts(spark, folder))
        if variant == "tfidf":
            return weighted.select("doc_id", "term", F.round("w", 8).alias("w"))
        return weighted.groupBy("doc_id").agg(
            F.count(F.lit(1)).alias("terms"), F.round(F.sum("w"), 6).alias("total"), F.round(F.max("w"), 6).alias("top")
        )

    return run


for _name, _sql in _VARIANT.items():
    _rows = f"SELECT doc_id, term, {_sql} AS w FROM t JOIN idf USING (term)"
    if _name == "tfidf":
        registry.add("tf_idf_tfidf", f"WITH {_T} SELECT doc_id, term, round(w, 8) AS w FROM ({_rows})")(_weights_query(_name))
    else:
        registry.add(
            f"tf_idf_{_name}",
            f"WITH {_T} SELECT doc_id, count(*) AS terms, round(sum(w), 6) AS total, round(max(w), 6) AS top FROM ({_rows}) GROUP BY 1",
        )(_weights_query(_name))


@registry.add(
    "tf_idf_unit",
    f"""WITH {_T}, x AS (SELECT doc_id, term, {_VARIANT['tfidf']} AS w FROM t JOIN idf USING (term))
        SELECT doc_id, round(sum(w) / sqrt(sum(w * w)), 6) AS total, sum((w <> 0)::INT)::BIGINT AS terms FROM x GROUP BY 1 HAVING sum(w * w) > 0""",
)
def tf_idf_unit(spark, folder):
    weighted, _ = DOC.split_weights(_split(spark, folder), "doc_id", S.long_word_tokens(F.col("text")), "tfidf", parts=text_parts(spark, folder))
    return textstats.unit_length(weighted, "doc_id").groupBy("doc_id").agg(
        F.round(F.sum("w"), 6).alias("total"), F.count(F.lit(1)).alias("terms")
    )


def _cosine_sql(k, variant):
    return f"""WITH {_T.replace("'42'", "'37'")},
      x AS (SELECT doc_id, is_test, term, {_VARIANT[variant]} AS w FROM t JOIN idf USING (term)),
      n AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM x GROUP BY 1 HAVING sum(w * w) > 0),
      u AS (SELECT x.doc_id, is_test, term, w / n AS w FROM x JOIN n USING (doc_id) WHERE w <> 0),
      s AS (SELECT q.doc_id AS q, t.doc_id AS t, round(sum(q.w * t.w), 9) AS s FROM u q JOIN u t USING (term) WHERE q.is_test AND NOT t.is_test GROUP BY 1, 2),
      f AS (SELECT q.doc_id AS q, t.doc_id AS t, 0.0::DOUBLE AS s FROM (SELECT doc_id FROM d WHERE is_test) q,
              (SELECT doc_id FROM d WHERE NOT is_test ORDER BY doc_id LIMIT {2 * k}) t),
      a AS (SELECT * FROM s UNION ALL SELECT * FROM f ANTI JOIN s USING (q, t)),
      near AS (SELECT q, t FROM a QUALIFY row_number() OVER (PARTITION BY q ORDER BY s DESC, t) <= {k}),
      vote AS (SELECT q, lang, count(*) AS n FROM near JOIN d ON d.doc_id = t GROUP BY 1, 2),
      pred AS (SELECT q AS query, lang AS prediction FROM vote QUALIFY row_number() OVER (PARTITION BY q ORDER BY n DESC, lang) = 1)"""


@registry.add("doc_knn_predictions", _cosine_sql(3, "tfidf") + " SELECT query, prediction, lang AS target FROM pred JOIN d ON d.doc_id = query")
def doc_knn_predictions(spark, folder):
    return DOC.nearest_labels(documents(spark, folder), "doc_id", "text", "lang", 0.25, k=3, parts=text_parts(spark, folder)).select("query", "prediction", "target")


def _macro_sql(k, variant):
    return _cosine_sql(k, variant) + """, j AS (SELECT prediction AS p, lang AS t FROM pred JOIN d ON d.doc_id = query),
      c AS (SELECT p AS k FROM j UNION SELECT t FROM j),
      m AS (SELECT k, (SELECT count(*) FROM j WHERE p = k AND t = k) AS tp, (SELECT count(*) FROM j WHERE p = k) + (SELECT count(*) FROM j WHERE t = k) AS den FROM c)
      SELECT round(avg(2.0::DOUBLE * tp / den), 6) AS macro_f1 FROM m"""


def _macro_query(variant):
    def run(spark, folder):
        predicted = DOC.nearest_labels(documents(spark, folder), "doc_id", "text", "lang", 0.25, k=1, variant=variant, parts=text_parts(spark, folder))
        return DOC.nearest_macro_f1(predicted).select(F.round("macro_f1", 6).alias("macro_f1"))

    return run


for _name in _VARIANT:
    registry.add("doc_knn_cosine" if _name == "tfidf" else f"doc_knn_cosine_{_name}", _macro_sql(1, _name))(_macro_query(_name))


@registry.add("text_classifier")
def text_classifier(spark, folder):
    """Toxic or not from TF-IDF over white-space tokens; F1 on the held-out quarter."""
    docs = documents(spark, folder).select("doc_id", "text").join(table(spark, folder, "labels").select("doc_id", "toxic"), "doc_id")
    train, test = sampling.train_test(docs, [F.col("doc_id")], 0.25, SEED)
    parts = text_parts(spark, folder)
    fitted = DOC.TextClassifier.fit(train, "doc_id", "text", "toxic", 1e6, parts=parts)
    scored = fitted.transform(test, "doc_id", "text", parts).join(test.select("doc_id", F.col("toxic").alias("label")), "doc_id")
    return DOC.held_out_f1(scored)


# Parsing of line formats, on lines built from the tables


@registry.add(
    "label_lines",
    r"""SELECT d.doc_id, l.toxic AS label, regexp_replace(d.text, '\s+', ' ', 'g') AS text FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
)
def label_lines(spark, folder):
    joined = documents(spark, folder).join(table(spark, folder, "labels"), "doc_id")
    flat = F.regexp_replace("text", r"\s+", " ")
    lines = joined.select("doc_id", F.concat(F.lit("\ufeff"), F.col("toxic").cast("string"), F.lit("\t"), flat).alias("value"))
    return source.parse_label_lines(lines)


_MARKED, _PLAIN = MARKS.translation()
_COUNTS = r"""wc AS (SELECT lower(w) AS word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '\p{L}+')) AS w FROM documents) GROUP BY 1)"""
_DICT = f"""dict AS (SELECT translate(word, '{_MARKED}', '{_PLAIN}') AS word, list(word ORDER BY word) AS variants FROM wc GROUP BY 1)"""


def _dictionary(spark, folder):
    counts = MK.word_occurrences(documents(spark, folder), "text")
    return counts, MK.variant_dictionary(counts, MARKS)


@registry.add("variant_lines", f"WITH {_COUNTS}, {_DICT} SELECT word, len(variants) AS n, array_to_string(variants, ',') AS variants FROM dict")
def variant_lines(spark, folder):
    """Dictionary lines written out and parsed back; each word is listed twice, the last line counts."""
    _, dictionary = _dictionary(spark, folder)
    old = dictionary.select(F.concat_ws(" ", "word", F.lit("old")).alias("value"), F.lit(1).alias("line_no"))
    new = dictionary.select(F.concat_ws("  ", F.col("word"), F.array_join("variants", " ")).alias("value"), F.lit(2).alias("line_no"))
    parsed = source.parse_variant_lines(old.unionByName(new))
    return parsed.select("word", F.size("variants").cast("bigint").alias("n"), F.array_join("variants", ",").alias("variants"))


# Marks and contexts


_CLASS = "CASE " + " ".join(f"WHEN instr('{MARKS.class_letters(k)[1]}', {{0}}) > 0 THEN {k}" for k in sorted(MARKS.classes)) + " ELSE 0 END"
_MAY = f"instr('{MARKS.plain_letters()}', {{0}}) > 0"
_CH = f"""{_D}, ch AS (SELECT doc_id, lang, is_test, unnest(regexp_extract_all(text, '(?s).')) AS tgt, generate_subscripts(regexp_extract_all(text, '(?s).'), 1) - 1 AS pos FROM d),
  pl AS (SELECT *, translate(tgt, '{_MARKED}', '{_PLAIN}') AS letter FROM ch)"""
_CTX_PARTS = "||".join(
    [f"coalesce(lag(letter, {i}) OVER w, ' ')" for i in (3, 2, 1)] + ["letter"] + [f"coalesce(lead(letter, {i}) OVER w, ' ')" for i in (1, 2, 3)]
)
_CTX = f"""{_CH}, cx AS (SELECT doc_id, lang, is_test, pos, tgt, letter, translate(lower({_CTX_PARTS}), '.,' || chr(10) || '-:', '     ') AS context
    FROM pl WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
  ex AS (SELECT doc_id, lang, is_test, pos, letter, context, {_CLASS.format('tgt')} AS cls FROM cx WHERE {_MAY.format('letter')})"""


@registry.add(
    "strip_marks",
    f"""SELECT doc_id, md5(translate(text, '{_MARKED}', '{_PLAIN}')) AS stripped, translate(text, '{_MARKED}', '{_PLAIN}') <> text AS changed FROM documents""",
)
def strip_marks(spark, folder):
    plain = S.strip_marks(F.col("text"), MARKS)
    return documents(spark, folder).select("doc_id", F.md5(plain).alias("stripped"), (plain != F.col("text")).alias("changed"))


_CZ_FROM, _CZ_TO = S.MarkTable().translation()


@registry.add("strip_marks_default", f"SELECT lang, sum((translate(text, '{_CZ_FROM}', '{_CZ_TO}') <> text)::INT)::BIGINT AS changed FROM documents GROUP BY 1")
def strip_marks_default(spark, folder):
    plain = S.strip_marks(F.col("text"))
    return documents(spark, folder).groupBy("lang").agg(F.sum((plain != F.col("text")).cast("bigint")).alias("changed"))


@registry.add("mark_class", f"WITH {_CTX} SELECT lang, letter, cls::INT AS cls, count(*) AS n FROM ex GROUP BY 1, 2, 3")
def mark_class(spark, folder):
    examples = MK.letter_examples(documents(spark, folder), ["doc_id", "lang"], F.col("text"), MARKS)
    return examples.groupBy("lang", "letter", "cls").agg(F.count(F.lit(1)).alias("n"))


@registry.add("char_context", f"WITH {_CTX} SELECT context, cls::INT AS cls, count(*) AS n FROM ex GROUP BY 1, 2")
def char_context(spark, folder):
    return MK.context_counts(documents(spark, folder), [], F.col("text"), MARKS).select("context", "cls", "n")


CODES = S.FOLDED_CODES


@registry.add(
    "position_one_hot",
    f"""WITH {_CTX}, c AS (SELECT code, row_number() OVER (ORDER BY code) - 1 AS place FROM (SELECT unnest({CODES}) AS code)),
        u AS (SELECT context, count(*) AS n FROM ex GROUP BY 1),
        o AS (SELECT n, p, ord(substr(context, (p + 1)::INT, 1)) AS code FROM u, range(7) r(p))
        SELECT (p * {len(CODES)} + place)::INT AS slot, sum(n)::BIGINT AS n FROM o JOIN c USING (code) GROUP BY 1""",
)
def position_one_hot(spark, folder):
    examples = MK.letter_examples(documents(spark, folder), ["doc_id"], F.col("text"), MARKS)
    counted = examples.groupBy("context").agg(F.count(F.lit(1)).alias("n"))
    slots = FE.position_slots(MK.context_codes(F.col("context"), 7), CODES)
    rows = counted.select("n", F.explode(slots).alias("slot"))
    return rows.groupBy("slot").agg(F.sum("n").alias("n"))


@registry.add("variant_dictionary", f"WITH {_COUNTS}, {_DICT} SELECT word, array_to_string(variants, ',') AS variants FROM dict")
def variant_dictionary(spark, folder):
    _, dictionary = _dictionary(spark, folder)
    return dictionary.select("word", F.array_join("variants", ",").alias("variants"))


_REFINED = f"""{_COUNTS}, {_DICT},
  v AS (SELECT dict.word, unnest(variants) AS variant, generate_subscripts(variants, 1) AS pos FROM dict),
  vn AS (SELECT v.word, variant, pos, coalesce(n, 0) AS n FROM v LEFT JOIN wc ON wc.word = variant),
  g AS (SELECT word, max(n) AS hi, min(n) AS lo, arg_min(variant, (-n, pos)) AS best, list(variant ORDER BY pos) AS every FROM vn GROUP BY 1),
  refined AS (SELECT word, CASE WHEN hi > 0 AND lo < 50 THEN [best] ELSE every END AS variants FROM g)"""


@registry.add("refine_dictionary", f"WITH {_REFINED} SELECT word, array_to_string(variants, ',') AS chosen FROM refined")
def refine_dictionary(spark, folder):
    counts, dictionary = _dictionary(spark, folder)
    return MK.refine_dictionary(dictionary, counts).select("word", F.array_join("variants", ",").alias("chosen"))


@registry.add(
    "dictionary_restore",
    f"""WITH {_REFINED},
        k AS (SELECT doc_id, unnest(regexp_extract_all(s, '\\p{{L}}+|[^\\p{{L}}]')) AS tok, generate_subscripts(regexp_extract_all(s, '\\p{{L}}+|[^\\p{{L}}]'), 1) AS pos
              FROM (SELECT doc_id, translate(text, '{_MARKED}', '{_PLAIN}') AS s FROM documents)),
        a AS (SELECT *, regexp_matches(tok, '^\\p{{L}}') AS alpha, regexp_matches(tok, '^\\p{{Lu}}') AS up FROM k),
        b AS (SELECT *, CASE WHEN up THEN lower(tok) ELSE tok END AS w FROM a),
        c AS (SELECT b.*, coalesce(r.variants[1], w) AS word FROM b LEFT JOIN (SELECT * FROM refined WHERE len(variants) = 1) r
              ON alpha AND r.word = translate(w, '{_MARKED}', '{_PLAIN}')),
        o AS (SELECT doc_id, pos, CASE WHEN NOT alpha THEN tok WHEN up THEN upper(substr(word, 1, 1)) || lower(substr(word, 2)) ELSE word END AS piece FROM c)
        SELECT doc_id, md5(string_agg(piece, '' ORDER BY pos)) AS restored FROM o GROUP BY 1""",
)
def dictionary_restore(spark, folder):
    """Marks are stripped from every document and put back from the refined dictionary."""
    counts = cut_lineage(MK.word_occurrences(documents(spark, folder), "text"))
    refined = MK.refine_dictionary(MK.variant_dictionary(counts, MARKS), counts)
    plain = documents(spark, folder).select("doc_id", S.strip_marks(F.col("text"), MARKS).alias("text"))
    return MK.restore_words(plain, "doc_id", "text", refined, MARKS).select("doc_id", F.md5("text").alias("restored"))


_DEX = f"""{_COUNTS}, {_DICT},
  v AS (SELECT dict.word, unnest(variants) AS variant FROM dict),
  vc AS (SELECT word, variant, unnest(regexp_extract_all(word, '.')) AS letter, unnest(regexp_extract_all(variant, '.')) AS tgt, generate_subscripts(regexp_extract_all(word, '.'), 1) AS pos FROM v),
  dx AS (SELECT letter, tgt, translate(lower({_CTX_PARTS}), '.,' || chr(10) || '-:', '     ') AS context FROM vc WINDOW w AS (PARTITION BY word, variant ORDER BY pos)),
  de AS (SELECT context, {_CLASS.format('tgt')} AS cls FROM dx WHERE {_MAY.format('letter')})"""


@registry.add("dictionary_examples", f"WITH {_DEX} SELECT context, cls::INT AS cls, count(*) AS n FROM de GROUP BY 1, 2")
def dictionary_examples(spark, folder):
    _, dictionary = _dictionary(spark, folder)
    return MK.dictionary_examples(dictionary, MARKS).groupBy("context", "cls").agg(F.count(F.lit(1)).alias("n"))


@registry.add(
    "all_examples",
    f"WITH {_CTX}, {_DEX} SELECT cls::INT AS cls, count(*) AS n, count(DISTINCT context) AS contexts FROM (SELECT context, cls FROM ex UNION ALL SELECT context, cls FROM de) GROUP BY 1",
)
def all_examples(spark, folder):
    """Text and dictionary examples together."""
    docs = documents(spark, folder)
    _, dictionary = _dictionary(spark, folder)
    text = MK.letter_examples(docs, ["doc_id"], F.col("text"), MARKS).select("context", "cls")
    both = text.unionByName(MK.dictionary_examples(dictionary, MARKS).select("context", "cls"))
    counted = both.groupBy("context", "cls").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("contexts"))


_MODEL = f"""{_CTX}, mc AS (SELECT context, cls, count(*) AS n FROM ex WHERE NOT is_test GROUP BY 1, 2),
  mo AS (SELECT context, cls AS pred FROM mc QUALIFY row_number() OVER (PARTITION BY context ORDER BY n DESC, cls) = 1)"""


@registry.add(
    "mark_restore",
    f"""WITH {_MODEL} SELECT count(*) AS letters, sum((coalesce(pred, 0) = cls)::INT)::BIGINT AS correct, round(avg((coalesce(pred, 0) = cls)::INT), 6) AS accuracy
        FROM ex LEFT JOIN mo USING (context) WHERE is_test""",
)
def mark_restore(spark, folder):
    """Most frequent class per context, learned on three quarters of the documents."""
    examples = MK.letter_examples(_split(spark, folder), ["doc_id", "is_test"], F.col("text"), MARKS)
    model = MK.context_model(examples.where("NOT is_test"))
    scored = MK.context_accuracy(examples.where("is_test"), model)
    return scored.select("letters", "correct", F.round("accuracy", 6).alias("accuracy"))


_PUT = "CASE " + " ".join(
    f"WHEN pred = {k} THEN translate(letter, '{MARKS.class_letters(k)[0]}', '{MARKS.class_letters(k)[1]}')" for k in sorted(MARKS.classes)
) + " ELSE letter END"


@registry.add(
    "restored_texts",
    f"""WITH {_MODEL}, r AS (SELECT doc_id, pos, CASE WHEN {_MAY.format('letter')} THEN {_PUT} ELSE letter END AS piece
              FROM cx LEFT JOIN mo USING (context) WHERE is_test)
        SELECT doc_id, md5(string_agg(piece, '' ORDER BY pos)) AS restored FROM r GROUP BY 1""",
)
def restored_texts(spark, folder):
    docs = _split(spark, folder)
    examples = MK.letter_examples(docs.where("NOT is_test"), ["doc_id"], F.col("text"), MARKS)
    plain = docs.where("is_test").select("doc_id", S.strip_marks(F.col("text"), MARKS).alias("text"))
    restored = MK.restore_marks(plain, "doc_id", "text", MK.context_model(examples), MARKS)
    return restored.select("doc_id", F.md5("text").alias("restored"))


def _network(counted, epochs=2):
    """ReLU network on one-hot contexts; equal examples are one weighted row."""
    slots = classification.OneHotPositions(CODES)
    network, metrics = classification.fit_network_averaged(
        counted, MK.context_codes(F.col("context"), 7), F.col("cls"), F.col("is_test"), [F.col("context"), F.col("cls")],
        7 * len(CODES), [50], len(MARKS.classes) + 1, epochs, 0.003, 256, 8, "adam", weight=F.col("n"), expand=slots,
    )
    return network, slots, metrics


@registry.add("restore_network")
def restore_network(spark, folder):
    counted = MK.context_counts(_split(spark, folder), ["is_test"], F.col("text"), MARKS)
    _, _, metrics = _network(counted)
    return metrics.select("epoch", F.round("train_acc", 4).alias("train_acc"), F.round("test_acc", 4).alias("test_acc"))


@registry.add("restore_pipeline")
def restore_pipeline(spark, folder):
    """Text and dictionary examples, network, marks put back, dictionary pass; share of right characters.

    The network scores every distinct context once; letters meet the scores by a join.
    """
    docs = _split(spark, folder)
    train, test = docs.where("NOT is_test"), docs.where("is_test")
    counts = cut_lineage(MK.word_occurrences(train, "text"))
    dictionary = MK.variant_dictionary(counts, MARKS)
    text = MK.context_counts(train, [], F.col("text"), MARKS).select("context", "cls", "n")
    words = MK.dictionary_examples(dictionary, MARKS).groupBy("context", "cls").agg(F.count(F.lit(1)).alias("n"))
    counted = text.unionByName(words).groupBy("context", "cls").agg(F.sum("n").alias("n")).withColumn("is_test", F.lit(False))
    network, slots, _ = _network(counted)
    plain = test.select("doc_id", S.strip_marks(F.col("text"), MARKS).alias("text"))
    letters = MK.letter_table(plain, ["doc_id"], F.col("text"), None)
    asked = letters.where(S.is_member(F.col("letter"), MARKS.plain_letters())).select("context").distinct()
    coded = asked.withColumn("codes", MK.context_codes(F.col("context"), 7))
    model = network.transform(coded, "codes", "pred", slots).select("context", "pred")
    restored = cut_lineage(MK.restore_marks(plain, "doc_id", "text", model, MARKS))
    final = MK.restore_words(restored, "doc_id", "text", MK.refine_dictionary(dictionary, counts), MARKS)
    score = lambda t, name: MK.letter_accuracy(t, test, "doc_id", "text").select(F.lit(name).alias("stage"), F.round("accuracy", 4).alias("accuracy"))
    return score(plain, "plain").unionByName(score(restored, "network")).unionByName(score(final, "dictionary"))
