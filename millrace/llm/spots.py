"""Document fingerprints: chains of content words that follow common words, compared by Jaccard similarity."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import LOWEST, id_of, stored, text_of

#: Anchors: common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in a is that it was for on with as be by at he this from are or an had not but his have were which "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an aus bei nach wird durch einer um am sind noch wie über einen so zum war "
    "le la les de des et un une du en que qui est pour dans par plus pas au sur ne se ce il sont avec on ou son aux "
    "el los las y del por con no una su para lo al como más o pero sus le ha me si sin sobre este ya entre cuando"
).split()


def _any_of(words: list[str]) -> str:
    """A pattern for the words with common beginnings factored out, so that a word is compared letter by letter."""
    heads = {}
    for word in words:
        if word:
            heads.setdefault(word[0], []).append(word[1:])
    parts = [head + _any_of(sorted(set(rest))) for head, rest in sorted(heads.items())]
    body = "(?:" + "|".join(parts) + ")" if parts else ""
    return body + "?" if body and "" in words else body


def normal_words(text: Column) -> Column:
    """Lower-case words, each with one space before, and one space at the end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def signatures(text: Column) -> Column:
    """The set of a text's signatures, sorted 40-bit numbers.

    A signature is the chain of two content words after an anchor, anchors in between left out. A text without
    any chain has one signature, of all its words.
    """
    words = normal_words(text)
    # Every anchor becomes a mark; the lookahead leaves the space for the next word.
    marked = F.regexp_replace(words, " " + _any_of(sorted(set(ANCHORS))) + "(?= )", " ^")
    chains = F.regexp_extract_all(marked, F.lit(r"\^ (?=([^ ^]+ (?:\^ )*+[^ ^]+) )"), F.lit(1))
    short = lambda c: F.shiftrightunsigned(F.xxhash64(c), 24)
    found = F.array_distinct(F.transform(chains, lambda c: short(F.replace(c, F.lit("^ "), F.lit("")))))
    # An array around the set, so that it is made once for both of its uses.
    whole = F.array(short(F.concat(F.lit("^"), words)))
    return F.get(F.transform(F.array(found), lambda f: F.when(F.size(f) > 0, F.sort_array(f)).otherwise(whole)), 0)


def fingerprint(found: Column) -> Column:
    """Signatures as text: hexadecimal numbers with commas between."""
    return F.array_join(F.transform(found, lambda h: F.lower(F.lpad(F.hex(h), 10, "0"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two non-empty signature sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both).cast("double")


def spot_pairs(prints: DataFrame, least: float = 0.8) -> DataFrame:
    """(a, b, likeness) of all pairs of different fingerprints with likeness >= least; prints has (id, signatures).

    Equal fingerprints are folded to their smallest id first (membership is a groupBy on the signatures).
    Sets are dealt to ranges of their length such that a partner is in the same range or a neighbour, and only
    pairs that share one of the rarest signatures of both are compared: a set of n signatures must share one of
    its n - ceil(least n) + 1 rarest with any partner. Pairs whose lengths already rule out the likeness are
    dropped before the sets are read. Null ids, empty and null sets take no part.
    """
    if not 0 < least <= 1:
        raise ValueError("least must lie in (0, 1]")
    sets = stored(
        prints.where(F.col("id").isNotNull() & (F.size("signatures") > 0)).groupBy("signatures").agg(F.min("id").alias("id"))
    ).withColumn("n", F.size("signatures"))
    split = sets.select("id", "n", F.explode("signatures").alias("s"))
    frequency = stored(split.groupBy("s").agg(F.count(F.lit(1)).alias("df")))
    step = -log(least) if least < 1 else 1.0
    ranked = split.join(frequency, "s").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "s"))).alias("ranked"))
    rare = ranked.select(
        "id",
        "n",
        F.floor(F.log("n") / F.lit(step)).alias("range"),
        F.explode(F.slice("ranked", 1, (F.col("n") - F.ceil(F.col("n") * F.lit(least) - F.lit(1e-9)) + 1).cast("int"))).alias("r"),
    ).select("id", "n", "range", F.col("r.s").alias("s"))
    rare = stored(rare)
    left = rare.select(F.col("id").alias("a"), F.col("n").alias("na"), "s", F.explode(F.array(F.col("range"), F.col("range") + 1)).alias("range"))
    right = rare.select(F.col("id").alias("b"), F.col("n").alias("nb"), "s", "range")
    pairs = left.join(right, ["s", "range"]).where((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    pairs = stored(pairs.where(F.col("na") >= F.col("nb") * F.lit(least) - F.lit(1e-9)).select("a", "b").distinct())
    own = sets.select(F.col("id").alias("a"), F.col("signatures").alias("sa"))
    other = sets.select(F.col("id").alias("b"), F.col("signatures").alias("sb"))
    compared = pairs.join(own, "a").join(other, "b").select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness"))
    return compared.where(F.col("likeness") >= F.lit(least) - F.lit(1e-12))


def previous_rows(keys: DataFrame) -> DataFrame:
    """(id, tie, before_id, before_tie): for each key the next smaller one; the smallest gets the largest.

    Keys are dealt to ranges; only the last key of each range meets in one place.
    """
    dealt = stored(keys.select("id", "tie").repartitionByRange("id", "tie").withColumn("part", F.spark_partition_id()))
    key = F.struct("id", "tie")
    inside = dealt.withColumn("before", F.lag(key).over(Window.partitionBy("part").orderBy("id", "tie")))
    ends = dealt.groupBy("part").agg(F.max(key).alias("last"))
    ends = ends.select("part", F.lag("last").over(Window.orderBy("part")).alias("carried"), F.max("last").over(Window.partitionBy(F.lit(0))).alias("top"))
    joined = inside.join(stored(ends), "part").withColumn("before", F.coalesce("before", "carried", "top"))
    return joined.select("id", "tie", F.col("before.id").alias("before_id"), F.col("before.tie").alias("before_tie"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, signatures, fingerprint) of every row; null and empty texts have the signature of no word."""
    return docs.select("doc_id", signatures(text_of()).alias("signatures")).withColumn("fingerprint", fingerprint(F.col("signatures")))


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint against that of its edited text and of the next document.

    The next document has the next smaller doc_id, after the smallest the largest. In the edited text the last
    floor(n / 3) code points are replaced by the first as many of the next document. Null texts are empty. A
    null doc_id is below all others. Rows of one doc_id are ordered by a hash of their text, equal rows are one
    document; a lone document is next to itself. Other columns are passed over.
    """
    # Both sides of the join below read these three columns and nothing else, so that the texts are shuffled once.
    rows = docs.select(id_of().alias("id"), text_of().alias("text")).withColumn("tie", F.xxhash64("text"))
    sizes = stored(rows.select("id", "tie", F.char_length("text").cast("bigint").alias("n_chars")).distinct())
    order = previous_rows(sizes)
    asks = stored(
        order.join(sizes, ["id", "tie"]).select(
            F.col("before_id").alias("id"), F.col("before_tie").alias("tie"), F.col("id").alias("for_id"), F.col("tie").alias("for_tie"), "n_chars"
        )
    )
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    lent = (
        rows.join(asks, ["id", "tie"])
        .select(
            F.col("for_id").alias("id"),
            F.col("for_tie").alias("tie"),
            "n_chars",
            F.substring("text", F.lit(1), cut).alias("head"),
            signatures(F.col("text")).alias("next_signatures"),
        )
    )
    repeated = not rows.groupBy("id", "tie").count().where("count > 1").isEmpty()
    lent = lent.dropDuplicates(["id", "tie"]) if repeated else lent
    joined = rows.join(lent, ["id", "tie"]).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")), "head")
    )
    found = joined.select(
        F.when(F.col("id") != LOWEST, F.col("id")).alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "next_signatures",
        signatures(F.col("text")).alias("own"), signatures(F.col("edited")).alias("changed"),
    )
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_signatures")).alias("near_next"),
    )


def query(documents: DataFrame) -> DataFrame:
    return compare_with_edits(documents)
