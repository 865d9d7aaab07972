"""Mixing sources to target weights: tempered shares, realised as budgeted block permutations."""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import stored

BLOCK_ROWS = 1024
SALTS = 64
_SECTIONS, _ROUNDS = 32, 4


def word_tokens(text: str = "text") -> Column:
    """Tokens of a text counted as its runs of non-blank characters, at least 1."""
    return F.greatest(F.lit(1), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"\S+"))).cast("bigint")


def tempered_exponent(sources: DataFrame, entropy: float | None = None, repeats: float | None = None) -> float:
    """The exponent in [0, 1] that just meets the target, found by sectioning the interval.

    entropy: the largest exponent whose weights have at least this share of the largest possible entropy.
    repeats: the smallest exponent at which no source is passed more than so many times when every source is
    passed once at least. Weights flatten as the exponent falls. Each round is one aggregate over the sources
    (columns source, tokens) that tests all inner points of the interval, so the sources stay where they are.
    """
    if (entropy is None) == (repeats is None):
        raise ValueError("give either entropy or repeats")
    whole = sources.agg(
        F.sum("tokens").alias("all"), F.max("tokens").alias("most"), F.min("tokens").alias("least"), F.count(F.lit(1)).alias("n")
    ).first()
    if not whole["n"] or whole["n"] == 1:
        return 1.0
    share = F.col("tokens") / F.lit(float(whole["all"]))

    def enough(points: list[float]) -> list[bool]:
        """Per point: its weights are flat enough."""
        if repeats is not None:
            return [(whole["most"] / whole["least"]) ** (1.0 - p) > repeats for p in points]
        sums = [F.sum(F.pow(share, F.lit(p))).alias(f"z{i}") for i, p in enumerate(points)]
        logs = [F.sum(F.pow(share, F.lit(p)) * F.log(share)).alias(f"l{i}") for i, p in enumerate(points)]
        row = sources.agg(*sums, *logs).first()
        return [(log(row[f"z{i}"]) - p * row[f"l{i}"] / row[f"z{i}"]) / log(whole["n"]) >= entropy - 1e-12 for i, p in enumerate(points)]

    low, high = 0.0, 1.0
    if enough([high])[0]:
        return high
    if not enough([low])[0]:
        return low
    for _ in range(_ROUNDS):
        points = [low + (high - low) * i / _SECTIONS for i in range(_SECTIONS + 1)]
        met = sum(enough(points[1:-1]))
        low, high = points[met], points[met + 1]
    return round(high if repeats is not None else low, 7)


def mix_sources(
    docs: DataFrame,
    tokens: Column | None = None,
    source: str = "source",
    key: str = "doc_id",
    entropy: float | None = None,
    repeats: float | None = 2.0,
    budget: float | None = None,
    seed: int = 17,
) -> DataFrame:
    """All columns of docs, once for each time the mixture reads a row, with ``mix_pass`` and ``mix_turn``.

    A source's share of all tokens is raised to one exponent and normalised to its weight. With a budget of
    tokens a source gets weight x budget; without one the budget is the least that passes every source once,
    so that no row is lost. A source of T tokens and b budgeted ones is read floor(b / T) times in full; the
    last pass takes whole blocks of some thousand rows in a seeded order of their own, and of the block on
    the edge the rows that still fit. mix_turn in [0, 1] is the place of the block in the reading order of its
    source: sorted by mix_turn all sources run side by side at their weights.

    A null source is a source of its own; equal rows are rows of their own and may both be taken; null or
    empty texts count one token; an empty table gives an empty one. Columns of docs named mix_pass or
    mix_turn are replaced. Only DataFrame operations are used: a hot source is many blocks, block totals are
    partial aggregates, and a running sum runs over blocks of a source or rows of one block.
    """
    if budget is not None and not budget > 0:
        raise ValueError("the budget must be positive")
    names = [c for c in docs.columns if c not in ("mix_pass", "mix_turn")]
    count = word_tokens() if tokens is None else tokens
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("s"),
        F.xxhash64(F.lit(seed), F.col(key)).alias("h"),
        count.cast("bigint").alias("t"),
    )
    sources = stored(rows.groupBy("s").agg(F.sum("t").alias("tokens"), F.count(F.lit(1)).alias("rows")).withColumnRenamed("s", "source"))
    exponent = tempered_exponent(sources, entropy, None if entropy is not None else repeats)
    whole = sources.agg(F.sum("tokens").alias("all"), F.max("tokens").alias("most")).first()
    if whole["all"] is None:
        return docs.select(*[F.col(f"`{c}`") for c in names], F.lit(0).cast("bigint").alias("mix_pass"), F.lit(0.0).alias("mix_turn")).limit(0)
    raised = F.pow(F.col("tokens") / F.lit(float(whole["all"])), F.lit(exponent))
    if budget is None:
        # One pass over the largest source; a smaller one gets more than one.
        wanted = F.col("tokens") * F.pow(F.lit(float(whole["most"])) / F.col("tokens"), F.lit(1.0 - exponent))
    else:
        norm = sources.agg(F.sum(raised).alias("z")).first()["z"]
        wanted = raised / F.lit(norm) * F.lit(float(budget))
    # Rounded to whole tokens, so that the order of summation cannot tip a pass over.
    plan = stored(sources.withColumn("wanted", F.round(wanted).cast("bigint")).withColumn("blocks", F.ceil(F.col("rows") / BLOCK_ROWS)))
    planned = plan.select(F.col("source").alias("s"), F.col("tokens").alias("all_tokens"), "wanted", "blocks")
    # Each source's row is there once per salt, so that a source with a third of all rows meets it in many tasks.
    salted = planned.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    placed = rows.withColumn("salt", F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("bigint")).join(salted, ["s", "salt"])
    placed = placed.withColumn("b", F.pmod(F.col("h"), F.col("blocks")))
    blocks = placed.groupBy("s", "b").agg(F.sum("t").alias("bt"), F.first("all_tokens").alias("all_tokens"), F.first("wanted").alias("wanted"))
    passes = blocks.withColumn("mix_pass", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("wanted") / F.col("all_tokens")))))
    order = Window.partitionBy("s", "mix_pass").orderBy(F.xxhash64(F.lit(seed), "s", "b", "mix_pass"), "b")
    before = F.sum("bt").over(order.rowsBetween(Window.unboundedPreceding, -1))
    passes = passes.withColumn("start", F.coalesce(before, F.lit(0)) + F.col("mix_pass") * F.col("all_tokens")).where("start < wanted")
    passes = stored(
        passes.select("s", "b", "mix_pass", (F.col("start") / F.col("wanted")).alias("mix_turn"), (F.col("wanted") - F.col("start")).alias("room"), "bt")
    )
    read = placed.select("row", "s", "b", "h", "t").join(passes, ["s", "b"])
    inside = read.where("bt <= room")
    edge = Window.partitionBy("s", "b", "mix_pass").orderBy("h", F.xxhash64("row")).rowsBetween(Window.unboundedPreceding, 0)
    partly = read.where("bt > room").withColumn("sum", F.sum("t").over(edge)).where("sum <= room").drop("sum")
    return inside.unionByName(partly).select(*[F.col("row")[c].alias(c) for c in names], "mix_pass", "mix_turn")


def query(documents: DataFrame) -> DataFrame:
    rows = documents.select("doc_id", "source", word_tokens().alias("tokens"))
    return mix_sources(rows, F.col("tokens"))
