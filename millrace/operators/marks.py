"""Letter contexts, mark prediction tables, dictionary repair and text rebuilding."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.strings import (
    MarkTable,
    add_mark,
    alphabetic_runs,
    capitalized,
    code_point,
    is_member,
    letter_runs,
    mark_class,
    noise_to_space,
    starts_upper,
    strip_marks,
)
from millrace.session import cut_lineage

#: Bytes of dictionary entries that travel with the tasks at most.
SENT_WORDS = 32 << 20
#: A filter of words is 256 blocks of so many numbers of 64 bits at most, 32 MB in all.
FILTER_NUMBERS = 16_384


def may_meet(rows: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Rows whose column may occur among values (one column): all that do, and few others.

    A filter of a fixed number of bits travels with the tasks, so that of a large table's rows only those move that find
    a partner. A value sets two bits of one number; more values only let more rows pass.
    """
    numbers = FILTER_NUMBERS

    def places(value: Column) -> tuple[Column, Column, Column]:
        h = F.xxhash64(value)
        bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(h, at).bitwiseAND(63).cast("int"))
        return h.bitwiseAND(255).cast("int"), F.shiftright(h, 8).bitwiseAND(numbers - 1).cast("int"), bit(22).bitwiseOR(bit(28))

    def filled(table: pa.Table) -> pa.Table:
        bits = np.zeros(numbers, np.int64)
        np.bitwise_or.at(bits, table.column("number").to_numpy(), table.column("bits").to_numpy())
        return pa.table({"block": table.column("block")[:1], "filter": pa.array([bits], pa.list_(pa.int64()))})

    made = values.select(*(x.alias(n) for x, n in zip(places(F.col(values.columns[0])), ("block", "number", "bits"))))
    made = made.groupBy("block", "number").agg(F.bit_or("bits").alias("bits"))
    blocks = made.groupBy("block").applyInArrow(filled, "block int, filter array<bigint>")
    block, number, bits = places(F.col(column))
    return rows.join(F.broadcast(blocks), (F.col("block") == block) & (F.get("filter", number).bitwiseAND(bits) == bits), "left_semi")


def characters(text: Column) -> Column:
    return F.split(text, "")


def letter_table(df: DataFrame, keys: list[str], plain: Column, target: Column | None, n: int = 3, fold_case: bool = True) -> DataFrame:
    """One row per character: keys, pos, letter, context of n characters each side, target letter.

    The context columns are the padded character array shifted 2n+1 times and zipped, so a text of
    any length costs time in proportion to its length. Past the ends of the text is a space.
    """
    pad = F.array_repeat(F.lit(" "), n)
    split = df.select(*keys, characters(plain).alias("_c"), *( [characters(target).alias("_t")] if target is not None else []))
    padded = split.select("*", F.concat(pad, F.col("_c"), pad).alias("_p"), F.size("_c").alias("_n"))
    width = 2 * n + 1
    shifts = [F.slice(F.col("_p"), F.lit(i + 1), F.col("_n")).alias(f"c{i}") for i in range(width)]
    zipped = F.arrays_zip(
        F.sequence(F.lit(0), F.col("_n") - 1).alias("pos"), *shifts, *([F.col("_t").alias("target")] if target is not None else [])
    )
    # Outer, since Spark puts a filter on the size of the array below a plain inline, which builds it twice.
    rows = padded.where(F.col("_n") > 0).select(*keys, F.inline_outer(zipped))
    joined = F.concat(*[F.col(f"c{i}") for i in range(width)])
    context = noise_to_space(joined) if fold_case else joined
    columns = [*keys, "pos", F.col(f"c{n}").alias("letter"), context.alias("context")]
    return rows.select(*columns, *(["target"] if target is not None else []))


def letter_examples(
    df: DataFrame, keys: list[str], target: Column, marks: MarkTable = MarkTable(), n: int = 3, fold_case: bool = True
) -> DataFrame:
    """Context and mark class of every letter that may carry a mark."""
    rows = letter_table(df, keys, strip_marks(target, marks), target, n, fold_case)
    kept = rows.where(is_member(F.col("letter"), marks.plain_letters()))
    return kept.select(*keys, "pos", "letter", "context", mark_class(F.col("target"), marks).alias("cls"))


def context_counts(df: DataFrame, keys: list[str], target: Column, marks: MarkTable = MarkTable(), n: int = 3) -> DataFrame:
    """(keys, context, cls, n): what letter_examples gives, counted.

    One pattern cuts the windows of letters that may carry a mark out of the marked text, a character at a time. They are
    counted as they are; marks and case are only folded in windows that differ.
    """
    middle = "".join(dict.fromkeys(marks.plain_letters() + marks.translation()[0]))
    pattern = f"(?s)(?=(.{{{n}}}[{middle}].{{{n}}})?)."
    pad = F.lit(" " * n)
    # An empty text is one empty character, as in letter_table.
    windows = F.when(target == "", F.array(F.lit(" " * (2 * n)))).otherwise(F.regexp_extract_all(F.concat(pad, target, pad), F.lit(pattern), F.lit(1)))
    # Outer, since Spark puts a filter on the size of the array below a plain explode, which cuts every text again.
    rows = df.select(*keys, F.explode_outer(windows).alias("_w")).where(F.col("_w") != "")
    counted = rows.groupBy(*keys, "_w").agg(F.count(F.lit(1)).alias("n"))
    letter = F.when(F.char_length("_w") > 2 * n, F.substring("_w", n + 1, 1)).otherwise("")
    folded = counted.select(*keys, noise_to_space(strip_marks(F.col("_w"), marks)).alias("context"), mark_class(letter, marks).alias("cls"), "n")
    return folded.groupBy(*keys, "context", "cls").agg(F.sum("n").alias("n"))


def dictionary_examples(dictionary: DataFrame, marks: MarkTable = MarkTable(), n: int = 3) -> DataFrame:
    """Examples from (word, variants): every eligible letter of the word, once per variant."""
    pairs = dictionary.select("word", F.posexplode("variants").alias("number", "variant"))
    rows = letter_table(pairs, ["word", "number"], F.col("word"), F.col("variant"), n)
    kept = rows.where(is_member(F.col("letter"), marks.plain_letters()))
    return kept.select("word", "number", "pos", "letter", "context", mark_class(F.col("target"), marks).alias("cls"))


def word_occurrences(docs: DataFrame, text: str) -> DataFrame:
    """Lower-cased letter runs and their counts."""
    return (
        docs.select(F.explode_outer(alphabetic_runs(F.col(text))).alias("word"))
        .where(F.col("word").isNotNull())
        .groupBy(F.lower("word").alias("word"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def variant_dictionary(counts: DataFrame, marks: MarkTable = MarkTable()) -> DataFrame:
    """Stripped word -> its distinct marked forms, from a word count table."""
    return (
        counts.select(strip_marks(F.col("word"), marks).alias("key"), "word")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("word")).alias("variants"))
        .withColumnRenamed("key", "word")
    )


def refine_dictionary(dictionary: DataFrame, counts: DataFrame, rare: int = 50) -> DataFrame:
    """Keep only the most frequent variant if it occurs and the least frequent is below ``rare``.

    Otherwise all variants stay. The first listed variant wins ties. Keys and variants are folded to
    lower case; of keys that fold together the last line stays.
    """
    folded = dictionary.withColumn("word", F.lower("word"))
    if "line_no" in dictionary.columns:
        folded = folded.groupBy("word").agg(F.max_by("variants", "line_no").alias("variants"))
    rows = folded.select("word", F.posexplode("variants").alias("pos", "variant")).withColumn("variant", F.lower("variant"))
    seen = rows.join(counts.select(F.col("word").alias("variant"), "n"), "variant", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    grouped = seen.groupBy("word").agg(
        F.max("n").alias("best_n"),
        F.min("n").alias("least_n"),
        F.min_by("variant", F.struct((-F.col("n")).alias("a"), F.col("pos").alias("b"))).alias("best"),
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "variant"))), lambda s: s["variant"]).alias("all"),
    )
    single = (F.col("best_n") > 0) & (F.col("least_n") < rare)
    return grouped.select("word", F.when(single, F.array("best")).otherwise(F.col("all")).alias("variants"))


def patched(pieces: Column, patches: Column) -> Column:
    """The array with the pieces of the patches, structs (pos, piece) in order of pos, in their places.

    Runs between patches are copied as slices, so the cost is linear in the array. No patches (NULL) leave it as it is.
    """
    start = lambda i: F.coalesce(F.get(patches, i - 1)["pos"] + 1, F.lit(0))
    body = F.flatten(F.transform(patches, lambda p, i: F.concat(F.slice(pieces, start(i) + 1, p["pos"] - start(i)), F.array(p["piece"]))))
    done = start(F.size(patches))
    tail = F.slice(pieces, done + 1, F.greatest(F.size(pieces) - done, F.lit(0)))
    return F.when(F.coalesce(F.size(patches), F.lit(0)) <= 0, pieces).otherwise(F.concat(body, tail))


def patch_texts(docs: DataFrame, key: str, text: str, changes: DataFrame, pieces: Callable[[Column], Column], each: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, text) of every row of docs with the changes (key, _print, pos, piece) put into pieces(text).

    Only the changes are grouped, and where they are made: `changes` come from rows of printed(docs), which lie by _print.
    A row is its key with a hash of its text, so rows without a key or of one repeated key keep their own changes.
    `each` maps the pieces that are not patched too.
    """
    listed = changes.groupBy(key, "_print").agg(F.sort_array(F.collect_set(F.struct("pos", "piece"))).alias("_patches"))
    listed = listed.select(F.col(key).alias("_key"), F.col("_print").alias("_same"), "_patches")
    rows = printed(docs, key, text)
    # The keys are compared within the join by _print: as join keys they would have rows and changes dealt out again.
    same = F.when(F.col("_key").isNull(), rows[key].isNull()).otherwise(F.coalesce(rows[key] == F.col("_key"), F.lit(False)))
    met = rows.join(listed, (F.col("_print") == F.col("_same")) & same, "left")
    cut = met.select(key, pieces(F.col("_text")).alias("_pieces"), "_patches")
    if each is not None:
        cut = cut.select(key, F.transform("_pieces", each).alias("_pieces"), "_patches")
    return cut.select(key, F.array_join(patched(F.col("_pieces"), F.col("_patches")), "").alias("text"))


def printed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, _text, _print): the text and its hash with the key, by which rows are dealt out once for words and patches.

    Empty texts have a hash too, NULL texts have that of their key. It tells equal texts of different keys apart, so that a
    text held by many documents is spread.
    """
    return docs.select(key, F.col(text).alias("_text"), F.xxhash64(key, text).alias("_print")).repartition("_print")


def restore_words(
    docs: DataFrame, key: str, text: str, dictionary: DataFrame, marks: MarkTable = MarkTable(), most: int = SENT_WORDS
) -> DataFrame:
    """Replace words that have exactly one variant; a capital first letter is restored.

    Variants that differ from their word travel with the tasks, if they are `most` bytes at most, and meet every word; more
    of them meet the words that a filter of fixed size lets pass. The others change nothing but words that hold marks or letters of odd case. Only words that change come back to their text.
    Empty texts stay empty and NULL stays NULL.
    """
    single = cut_lineage(dictionary.where(F.size("variants") == 1).select(F.col("word").alias("k"), F.col("variants")[0].alias("v")))
    token, upper = F.col("token"), starts_upper(F.col("token"))
    folded = F.when(upper, F.lower("token")).otherwise(token)

    def words(rows: DataFrame) -> DataFrame:
        # Outer, since Spark puts a filter on the size of the array below a plain explode, which splits every text again.
        cut = rows.select(key, "_print", F.posexplode_outer(letter_runs(F.col("_text"))).alias("pos", "token"))
        return cut.where(token.rlike(r"^\p{L}")).withColumn("k", strip_marks(folded, marks))

    def met(rows: DataFrame, variants: DataFrame) -> DataFrame:
        """The places of words whose k has a variant; words are shuffled once per text, not once per place."""
        places = rows.groupBy(key, "_print", "token", "k").agg(F.collect_list("pos").alias("places"))
        # Dealt out like the texts before the places are taken apart, so that their changes need no more shuffles.
        found = places.join(variants, "k").select(key, "_print", "token", "v", "places").repartition("_print")
        return found.select(key, "_print", "token", "v", F.explode("places").alias("pos"))

    rows = printed(docs, key, text)
    marked = single.where(F.col("v") != F.col("k"))
    size = marked.agg(F.sum(F.octet_length("k") + F.octet_length("v") + 24)).first()[0] or 0
    if size <= most:
        found = words(rows).join(F.broadcast(marked), "k").select(key, "_print", "token", "v", "pos")
    else:
        found = met(may_meet(words(rows), "k", marked.select("k")), marked)
    # What follows a variant equal to its word is what a word without a variant becomes, but for these words.
    odd = (F.col("k") != folded) | (upper & (capitalized(folded) != capitalized(token)))
    may = (strip_marks(F.col("_text"), marks) != F.col("_text")) | F.col("_text").rlike(r"[^\x00-\x7F]")
    found = found.unionByName(met(words(rows.where(may)).where(odd), single.where(F.col("v") == F.col("k"))))
    piece = F.when(upper, capitalized(F.col("v"))).otherwise(F.col("v"))
    changes = found.where(piece != token).select(key, "_print", "pos", piece.alias("piece"))
    # Case is folded without the dictionary, so that it needs no change list.
    return patch_texts(docs, key, text, changes, letter_runs, lambda w: F.when(w.rlike(r"^\p{Lu}"), capitalized(w)).otherwise(w))


def context_model(examples: DataFrame) -> DataFrame:
    """Most frequent mark class per context, lowest class on ties."""
    counted = examples.groupBy("context", "cls").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct((-F.col("n")).alias("a"), F.col("cls").alias("b"))
    return counted.groupBy("context").agg(F.min_by("cls", order).alias("pred"), F.sum("n").alias("n"))


def context_accuracy(test: DataFrame, model: DataFrame) -> DataFrame:
    """Share of letters whose class the context table gets right.

    Test letters are counted per (context, class) first, so a common context is one row in the join.
    """
    counted = test.groupBy("context", "cls").agg(F.count(F.lit(1)).alias("letters"))
    joined = counted.join(model.select("context", "pred"), "context", "left")
    hit = F.coalesce(F.col("pred"), F.lit(0)) == F.col("cls")
    return joined.agg(
        F.sum("letters").alias("letters"),
        F.sum(F.when(hit, F.col("letters")).otherwise(0)).alias("correct"),
    ).select("letters", "correct", (F.col("correct") / F.col("letters")).alias("accuracy"))


def restore_marks(
    docs: DataFrame, key: str, text: str, model: DataFrame, marks: MarkTable = MarkTable(), n: int = 3, most: int = SENT_WORDS
) -> DataFrame:
    """Put predicted marks on the letters of unmarked texts.

    model has columns context, pred. Only letters that may carry a mark meet predictions, by key, never by a running
    counter, and only letters that change come back to their text. Contexts that ask for a mark travel with the tasks, if
    they are `most` bytes at most, so that no letter is shuffled; more of them are shuffled to meet the letters that a filter
    of fixed size lets pass.
    Empty texts stay empty and NULL stays NULL.
    """
    marked = cut_lineage(model.where(F.col("pred") != 0).select("context", "pred"))
    size = marked.agg(F.sum(F.octet_length("context") + 24)).first()[0] or 0
    rows = letter_table(printed(docs, key, text), [key, "_print"], F.col("_text"), None, n)
    may = rows.where(is_member(F.col("letter"), marks.plain_letters()))
    if size <= most:
        found = may.join(F.broadcast(marked), "context")
    else:
        found = may_meet(may, "context", marked.select("context")).join(marked, "context").repartition("_print")
    piece = add_mark(F.col("letter"), F.col("pred"), marks)
    changes = found.select(key, "_print", "pos", "letter", piece.alias("piece")).where("piece <> letter").drop("letter")
    return patch_texts(docs, key, text, changes, characters)


def letter_accuracy(restored: DataFrame, truth: DataFrame, key: str, text: str) -> DataFrame:
    """Share of characters equal at the same position."""
    both = restored.select(key, F.col("text").alias("_a")).join(truth.select(key, F.col(text).alias("_b")), key)
    hits = F.zip_with(characters(F.col("_a")), characters(F.col("_b")), lambda a, b: (a == b).cast("bigint"))
    sums = both.select(F.aggregate(hits, F.lit(0).cast("bigint"), lambda s, h: s + h).alias("h"), F.length("_b").alias("n"))
    return sums.agg((F.sum("h") / F.sum("n")).alias("accuracy"))


def context_codes(context: Column, width: int) -> Column:
    """Code points of a context string."""
    return F.array(*[code_point(F.substring(context, i + 1, 1)) for i in range(width)])


