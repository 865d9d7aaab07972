"""Document classification by cosine neighbours and by a linear text model."""

from __future__ import annotations

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.strings import long_word_tokens, space_tokens
from millrace.operators import textstats
from millrace.operators.cosine import cosine_neighbors, stored_vectors
from millrace.operators.metrics import binary_f1, macro_f1, weighted_vote
from millrace.operators.ordering import with_rank
from millrace.operators.sampling import with_split
from millrace.plans.classification import cached, library_logistic
from millrace.session import cut_lineage


def split_weights(docs: DataFrame, key: str, tokens: Column, variant: str, is_test: str = "is_test", numbered: bool = False, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Document weights (key, is_test, term, w) and the vocabulary with idf, learned on train rows.

    Where terms are only compared, `numbered` puts stored numbers in their place, so that no later shuffle carries words.

    The vocabulary is stored. Terms are counted once for it and once for the weights, which takes less room than to keep them.
    """
    terms = textstats.term_counts(docs, key, tokens, is_test, parts=parts)
    train_docs = docs.where(~F.col(is_test)).agg(F.count(F.lit(1))).scalar()
    vocab = textstats.inverse_frequency(textstats.vocabulary(terms.where(~F.col(is_test))), train_docs)
    vocab = cut_lineage(vocab.withColumn("number", F.monotonically_increasing_id()) if numbered else vocab)
    return textstats.weights(terms, vocab, variant, key, is_test, name="number" if numbered else "term"), vocab


def nearest_labels(docs: DataFrame, key: str, text: str, label: str, test_size, k: int = 1, variant: str = "tfidf", seed=37, parts: int | None = None) -> DataFrame:
    """(query, prediction, label): vote of the k most similar train documents, lowest class on ties.

    A query with fewer than k documents sharing a term is filled up with the lowest train keys, whose
    similarity is 0.
    """
    marked = with_split(docs.select(key, text, label), [F.col(key)], test_size, seed)
    weighted, _ = split_weights(marked, key, long_word_tokens(F.col(text)), variant, numbered=True, parts=parts)
    unit = stored_vectors(textstats.unit_vectors(weighted, key, "is_test"), key, "is_test")
    # Stored, since the votes and the queries that lack some both start from it.
    found = cut_lineage(cosine_neighbors(unit.where(~F.col("is_test")), unit.where("is_test"), key, k))
    queries = marked.where("is_test").select(F.col(key).alias("query"), F.col(label).alias("target"))
    train_labels = marked.where(~F.col("is_test")).select(F.col(key).alias("neighbor"), F.col(label).alias("class"))
    votes = found.join(train_labels, "neighbor").select("query", "class", "neighbor")
    # The 2k lowest train rows always hold k that are not among a query's own neighbours.
    lowest = [(r.neighbor, r["class"]) for r in train_labels.orderBy("neighbor").limit(2 * k).collect()]
    fill = F.array(*[F.struct(F.lit(n).alias("neighbor"), F.lit(c).alias("class")) for n, c in lowest])
    short = queries.join(votes, "query", "left").groupBy("query").agg(F.collect_list("neighbor").alias("have"))
    missing = (
        short.where(F.size("have") < k)
        .select("query", "have", F.slice(F.filter(fill, lambda s: ~F.array_contains(F.col("have"), s["neighbor"])), F.lit(1), F.lit(k) - F.size("have")).alias("_m"))
        .select("query", F.inline("_m"))
        .select("query", "class", "neighbor")
    )
    predicted = weighted_vote(votes.unionByName(missing), "query", "class", F.lit(1.0))
    return predicted.join(queries, "query")


def nearest_macro_f1(predictions: DataFrame) -> DataFrame:
    return macro_f1(predictions, "prediction", "target")


@F.udf(VectorUDT())
def _sparse(size, entries):
    return SparseVector(size, [e[0] for e in entries], [e[1] for e in entries])


def sparse_rows(weighted: DataFrame, key: str, size: int) -> DataFrame:
    """One sparse vector per document from (key, number of the term, w); one small Python call per document, not per token."""
    entries = F.sort_array(F.collect_list(F.struct(F.col("term").cast("int").alias("term_idx"), "w")))
    return weighted.groupBy(key).agg(entries.alias("_e")).select(key, _sparse(F.lit(size), F.col("_e")).alias("features"))


class TextClassifier:
    """TF-IDF over white-space tokens and an L2 linear model; vocabulary and model are stored apart."""

    def __init__(self, vocab: DataFrame, size: int, model):
        self.vocab, self.size, self.model = vocab, size, model

    @classmethod
    def fit(cls, docs: DataFrame, key: str, text: str, label: str, strength: float = 1.0, max_iter: int = 20, parts: int | None = None) -> "TextClassifier":
        terms = textstats.term_counts(docs, key, space_tokens(F.col(text)), parts=parts)
        rows = docs.count()
        counted = textstats.inverse_frequency(textstats.vocabulary(terms), F.lit(rows))
        vocab = cut_lineage(with_rank(cut_lineage(counted), [], ["term"], "term_idx"))
        size = vocab.count()
        made = cls(vocab, size, None)
        with cached(made.vectors(docs, key, text, parts).join(docs.select(key, F.col(label).alias("label")), key)) as data:
            # Every step adds up one vector as long as the vocabulary per partition, so there is one partition per core.
            cores = docs.sparkSession.sparkContext.defaultParallelism
            made.model = library_logistic("features", "label", strength, rows, max_iter).fit(data.coalesce(cores))
        return made

    def vectors(self, docs: DataFrame, key: str, text: str, parts: int | None = None) -> DataFrame:
        terms = textstats.term_counts(docs, key, space_tokens(F.col(text)), parts=parts)
        weighted = textstats.weights(terms, self.vocab, "tfidf", key, name="term_idx")
        filled = sparse_rows(weighted, key, self.size)
        # A document without known words has a zero vector.
        empty = F.array().cast("array<struct<term_idx:int,w:double>>")
        return docs.select(key).join(filled, key, "left").withColumn("features", F.coalesce("features", _sparse(F.lit(self.size), empty)))

    def transform(self, docs: DataFrame, key: str, text: str, parts: int | None = None) -> DataFrame:
        scored = self.model.transform(self.vectors(docs, key, text, parts))
        return scored.select(key, F.col("prediction").cast("int").alias("prediction"))

    def save(self, path: str) -> None:
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocabulary")
        self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark, path: str) -> "TextClassifier":
        from pyspark.ml.classification import LogisticRegressionModel

        vocab = spark.read.parquet(f"{path}/vocabulary")
        return cls(vocab, vocab.count(), LogisticRegressionModel.load(f"{path}/model"))


def held_out_f1(predictions: DataFrame) -> DataFrame:
    return predictions.agg(binary_f1(F.col("prediction"), F.col("label")).alias("f1"))
