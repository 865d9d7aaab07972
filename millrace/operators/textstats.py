"""Term statistics and document weights as sparse long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import guarded_ratio
from millrace.operators.ordering import with_rank
from millrace.session import cut_lineage

#: Bytes of terms and numbers that travel with the tasks at most; the rarer terms beyond them meet their rows by a shuffle.
SENT_TERMS = 32 << 20


def term_counts(docs: DataFrame, key: str, tokens: Column, *more: str, parts: int | None = None) -> DataFrame:
    """(doc, term, tf_count, doc_len): doc_len counts all tokens of the document.

    Texts are dealt out by key, so that counting and later sums by key need no shuffle of terms. ``parts`` is the number of
    partitions where the session's own would be too few. The length is taken from the token array before it is exploded,
    so no window is needed and the array itself is not carried along with every token.
    """
    dealt = docs.repartition(F.col(key)) if parts is None else docs.repartition(parts, key)
    listed = dealt.select(key, *more, tokens.alias("_tokens")).select(key, *more, "_tokens", F.size("_tokens").alias("doc_len"))
    # An outer explode, since Spark puts a filter on the size of the array below a plain one, which splits every text again.
    rows = listed.select(key, *more, "doc_len", F.explode_outer("_tokens").alias("term")).where(F.col("term").isNotNull())
    return rows.groupBy(key, *more, "term").agg(
        F.count(F.lit(1)).alias("tf_count"), F.first("doc_len").cast("bigint").alias("doc_len")
    )


def word_counts(docs: DataFrame, tokens: Column) -> DataFrame:
    return docs.select(F.explode_outer(tokens).alias("word")).where(F.col("word").isNotNull()).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(terms: DataFrame, indexed: bool = False) -> DataFrame:
    """Terms seen at least twice, with total count and document frequency, in one aggregate."""
    out = (
        terms.groupBy("term")
        .agg(F.sum("tf_count").alias("cnt"), F.count(F.lit(1)).alias("df"))
        .where(F.col("cnt") > 1)
    )
    return with_rank(out, [], ["term"], "term_idx") if indexed else out


def inverse_frequency(vocab: DataFrame, documents: Column) -> DataFrame:
    """ln(N / (df + 1)); negative for a term in every document."""
    return vocab.withColumn("idf", F.ln(documents.cast("double") / (F.col("df") + 1)))


def weights(terms: DataFrame, vocab_idf: DataFrame, variant: str, *keys: str, name: str = "term") -> DataFrame:
    """(keys, term, w) for 'tfidf', 'idf', 'tf' or 'binary'; terms outside the vocabulary drop out.

    `name` is the column of the vocabulary that stands for the term, such as its number.
    """
    tf = guarded_ratio(F.col("tf_count").cast("double"), F.col("doc_len").cast("double"))
    choice = {"tfidf": tf * F.col("idf"), "idf": F.col("idf"), "tf": tf, "binary": F.lit(1.0)}[variant]
    joined = by_term(terms, vocab_idf.select("term", "idf", "df", F.col(name).alias("_name")))
    return joined.select(*keys, F.col("_name").alias("term"), choice.alias("w"))


def by_term(terms: DataFrame, vocab: DataFrame, most: int = SENT_TERMS) -> DataFrame:
    """terms joined with a vocabulary (term, df, more): its frequent terms travel with the tasks, `most` bytes of them.

    Only rows of rarer terms are shuffled. The vocabulary is read twice and should be stored.
    """
    size = F.octet_length("term") + 24
    level = F.floor(F.log2(F.col("df").cast("double"))).alias("level")
    levels = vocab.groupBy(level).agg(F.sum(size).alias("size")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for row in levels:
        total += row["size"]
        if total > most:
            break
        least = row["level"]
    if not levels or (least is not None and total <= most):
        return terms.join(F.broadcast(vocab), "term")
    if least is None:
        return terms.join(vocab, "term")
    frequent = F.broadcast(vocab.where(F.col("df") >= 2**least))
    rare = vocab.where(F.col("df") < 2**least)
    return terms.join(frequent, "term").unionByName(terms.join(frequent.select("term"), "term", "left_anti").join(rare, "term"))


def unit_length(weighted: DataFrame, *keys: str) -> DataFrame:
    """Divide by the Euclidean length of the document; documents without weight keep no row.

    Length and entries of a document come from one group-by, so nothing is joined back.
    """
    grouped = weighted.where(F.col("w") != 0).groupBy(*keys).agg(
        F.collect_list(F.struct("term", "w")).alias("_e"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm")
    )
    return grouped.select(*keys, "_norm", F.inline("_e")).select(*keys, "term", (F.col("w") / F.col("_norm")).alias("w"))


def unit_vectors(weighted: DataFrame, *keys: str) -> DataFrame:
    """(keys, terms, weights) of the documents of unit_length, a row each, terms in order."""
    grouped = weighted.where(F.col("w") != 0).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("term", "w"))).alias("_e"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm")
    )
    return grouped.select(*keys, F.col("_e.term").alias("terms"), F.transform("_e.w", lambda w: w / F.col("_norm")).alias("weights"))
