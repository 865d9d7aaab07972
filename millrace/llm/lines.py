"""Line dedup: lines that many documents share stay in one document only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import id_of, stored, text_of

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends and with A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(BLANKS)), UPPER, LOWER)


def drop_repeated_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """All columns of docs with the text thinned in ``text``, plus ``n_lines`` and ``n_dropped``.

    A line goes if its key has at least min_chars code points, occurs in at least min_docs documents, and a
    larger doc_id has it too. Rows with one doc_id count as one document and are thinned each for itself; a
    null doc_id is one document below all others; a null or empty text is one empty line. Input columns
    named n_lines or n_dropped are replaced.

    Lines travel as two 64-bit hashes. Counting distinct documents is a partial aggregate, the join with
    the frequent keys is one that adaptive execution splits at a very common line, and the text itself
    moves once, to meet the numbers of its dropped lines.
    """
    rest = [c for c in docs.columns if c not in ("text", "n_lines", "n_dropped")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), text_of().alias("body"), id_of().alias("id")
    ).withColumn("print", F.xxhash64("body"))
    lines = rows.select(
        "id", "print", F.posexplode(F.transform(F.split("body", "\n"), line_key)).alias("place", "line")
    ).where(F.char_length("line") >= min_chars)
    marks = lines.select("id", "print", "place", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), "line").alias("g"))
    frequent = stored(
        marks.groupBy("h", "g")
        .agg(F.count_distinct("id").alias("n"), F.max("id").alias("keep"))
        .where(F.col("n") >= min_docs)
        .drop("n")
    )
    gone = (
        marks.join(frequent, ["h", "g"])
        .where(F.col("id") < F.col("keep"))
        .groupBy("id", "print")
        .agg(F.collect_set("place").alias("places"))
    )
    left = rows.join(stored(gone), ["id", "print"], "left")
    pieces = F.split("body", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(pieces) - 1), F.col("places"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("pieces"), i)), "\n")
    return left.withColumn("pieces", pieces).select(
        *[F.col("rest")[c].alias(c) for c in rest],
        F.when(F.col("places").isNull(), F.col("body")).otherwise(kept).alias("text"),
        F.size("pieces").cast("bigint").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


QUERY_SQL = f"""
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM line),
frequent AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, place, line, coalesce(doc_id < keep, false) AS gone FROM keyed LEFT JOIN frequent USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def query(documents: DataFrame) -> DataFrame:
    thinned = drop_repeated_lines(documents.select("doc_id", "text"))
    return thinned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
