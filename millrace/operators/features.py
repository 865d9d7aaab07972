"""Feature transforms: fit is one aggregate, transform is a projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import with_rank
from millrace.session import cut_lineage

CATEGORY_LIMIT = 10_000


def integer_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: is every value an integer? One pass for all columns."""
    flags = df.agg(*[F.bool_and(F.col(c) % 1 == 0).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("is_categorical")) for c in columns])
    return flags.select(F.inline(pairs))


def split_columns(df: DataFrame, columns: list[str]) -> tuple[list[str], list[str]]:
    rows = {r["column"]: r["is_categorical"] for r in integer_columns(df, columns).collect()}
    return [c for c in columns if rows[c]], [c for c in columns if not rows[c]]


def category_index(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their ascending position; any number of categories."""
    distinct = df.select(column).where(F.col(column).isNotNull()).distinct()
    return with_rank(distinct, [], [column], "idx")


def encode_index(df: DataFrame, column: str, index: DataFrame, name: str = "idx") -> DataFrame:
    """Position of the set slot in the one-hot block, NULL where the value was not seen in fit."""
    return df.join(index.withColumnRenamed("idx", name), column, "left")


@dataclass
class OneHot:
    """One-hot block over values learned in ascending order; unknown values give zeros."""

    column: str
    categories: list

    @classmethod
    def fit(cls, df: DataFrame, column: str) -> "OneHot":
        values = df.select(column).where(F.col(column).isNotNull()).distinct().limit(CATEGORY_LIMIT + 1).collect()
        if len(values) > CATEGORY_LIMIT:
            raise ValueError(f"{column}: over {CATEGORY_LIMIT} categories, use SparseColumns")
        return cls(column, sorted(v[0] for v in values))

    def slots(self) -> list[Column]:
        return [F.coalesce((F.col(self.column) == F.lit(v)).cast("double"), F.lit(0.0)) for v in self.categories]

    def transform(self, df: DataFrame, name: str) -> DataFrame:
        return df.withColumn(name, F.array(*self.slots()).cast("array<double>"))


@dataclass
class Scaler:
    """(x - shift) / scale per column."""

    columns: list[str]
    shift: list[float]
    scale: list[float]

    @classmethod
    def standard(cls, df: DataFrame, columns: list[str]) -> "Scaler":
        """Mean 0 and population variance 1; a constant column is only shifted."""
        if not columns:
            return cls([], [], [])
        row = df.agg(
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(columns)],
        ).first()
        n = range(len(columns))
        return cls(columns, [row[f"m_{i}"] for i in n], [row[f"s_{i}"] or 1.0 for i in n])

    @classmethod
    def min_max(cls, df: DataFrame, columns: list[str]) -> "Scaler":
        """Train range to [0, 1]; a constant column becomes 0."""
        row = df.agg(
            *[F.min(F.col(c).cast("double")).alias(f"a_{i}") for i, c in enumerate(columns)],
            *[F.max(F.col(c).cast("double")).alias(f"b_{i}") for i, c in enumerate(columns)],
        ).first()
        n = range(len(columns))
        return cls(columns, [row[f"a_{i}"] for i in n], [(row[f"b_{i}"] - row[f"a_{i}"]) or 1.0 for i in n])

    def slots(self) -> list[Column]:
        return [
            (F.col(c).cast("double") - F.lit(float(a))) / F.lit(float(b))
            for c, a, b in zip(self.columns, self.shift, self.scale)
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns(dict(zip(self.columns, self.slots())))


def array_range(df: DataFrame, features: str, dims: int) -> tuple[list[float], list[float]]:
    """Column-wise min and max of an array column in one aggregate."""
    row = df.agg(
        *[F.min(F.col(features)[i]).alias(f"a_{i}") for i in range(dims)],
        *[F.max(F.col(features)[i]).alias(f"b_{i}") for i in range(dims)],
    ).first()
    return [float(row[f"a_{i}"]) for i in range(dims)], [float(row[f"b_{i}"]) for i in range(dims)]


def scale_array(features: Column, low: list[float], high: list[float]) -> Column:
    """Min-max scaling of an array column; constant positions become 0."""
    shift = F.array(*[F.lit(v) for v in low])
    width = F.array(*[F.lit((b - a) or 1.0) for a, b in zip(low, high)])
    return F.zip_with(F.zip_with(features, shift, lambda x, a: x - a), width, lambda x, w: x / w)


@dataclass
class ArrayScaler:
    """Min-max scaling of an array column; constant positions become 0."""

    low: list[float]
    high: list[float]

    @classmethod
    def fit(cls, df: DataFrame, features: str, dims: int) -> "ArrayScaler":
        return cls(*array_range(df, features, dims))

    def transform(self, df: DataFrame, features: str, name: str) -> DataFrame:
        return df.withColumn(name, scale_array(F.col(features), self.low, self.high))


def upper_products(columns: list[Column]) -> list[Column]:
    """ci * cj for i <= j, row by row of the upper triangle."""
    return [columns[i] * columns[j] for i in range(len(columns)) for j in range(i, len(columns))]


def degree_two(columns: list[Column], bias: bool = False) -> list[Column]:
    """[a, b, .., a^2, ab, .., b^2, ..], optionally with a leading 1."""
    head = [F.lit(1.0)] if bias else []
    return [*head, *columns, *upper_products(columns)]


def polynomial(columns: list[Column], degree: int, bias: bool = True) -> list[Column]:
    """All monomials up to a degree, by degree and then by column order."""
    out = [F.lit(1.0)] if bias else []
    level = [(i, c) for i, c in enumerate(columns)]
    out += [c for _, c in level]
    for _ in range(1, degree):
        level = [(j, term * columns[j]) for i, term in level for j in range(i, len(columns))]
        # Keep lexicographic order of the index tuples.
        out += [c for _, c in level]
    return out


@dataclass
class ColumnProcessor:
    """Integer columns one-hot encoded first, the rest standardised, then degree-2 terms."""

    one_hot: list[OneHot]
    scaler: Scaler
    expand: bool = True

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], expand: bool = True) -> "ColumnProcessor":
        categorical, real = split_columns(df, columns)
        return cls([OneHot.fit(df, c) for c in categorical], Scaler.standard(df, real), expand)

    def slots(self) -> list[Column]:
        base = [slot for encoder in self.one_hot for slot in encoder.slots()] + self.scaler.slots()
        return base

    def transform(self, df: DataFrame, name: str = "features") -> DataFrame:
        base = self.slots()
        names = [f"_f{i}" for i in range(len(base))]
        ready = df.withColumns(dict(zip(names, base)))
        cols = [F.col(n) for n in names]
        return ready.withColumn(name, F.array(*(degree_two(cols) if self.expand else cols))).drop(*names)


@dataclass
class SparseColumns:
    """The slots of ColumnProcessor for any number of categories: per row the set slots and their values, by joins.

    Slot order is that of the dense form: categories of each integer column in ascending order, then scaled real columns,
    then products of slots i <= j row by row of the upper triangle. Categories stay tables; a row holds only what is set.
    """

    categories: list[tuple[str, DataFrame, int]]  # column, (value, idx), first slot
    scaler: Scaler
    width: int
    expand: bool = True

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str], expand: bool = True) -> "SparseColumns":
        categorical, real = split_columns(df, columns)
        tables, first = [], 0
        for column in categorical:
            index = cut_lineage(category_index(df, column))
            tables.append((column, index, first))
            first += index.count()
        return cls(tables, Scaler.standard(df, real), first + len(real), expand)

    def size(self) -> int:
        return self.width * (self.width + 3) // 2 if self.expand else self.width

    def transform(self, df: DataFrame, slots: str = "slots", values: str = "values") -> DataFrame:
        """df with an ascending array of slots and the array of their values; unknown and null categories set nothing, as zeros do."""
        names = df.columns
        row = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
        for i, (column, index, first) in enumerate(self.categories):
            known = index.select(F.col(column).alias(f"v{i}"), (F.col("idx") + F.lit(first)).alias(f"s{i}"))
            # A left join on a category: one that holds most rows is split by adaptive execution.
            row = row.join(known, F.col("row")[column] == F.col(f"v{i}"), "left").drop(f"v{i}")
        pair = lambda slot, value: F.struct(slot.cast("bigint").alias("s"), value.cast("double").alias("v"))
        parts = [F.when(F.col(f"s{i}").isNotNull(), pair(F.col(f"s{i}"), F.lit(1.0))) for i in range(len(self.categories))]
        start = self.width - len(self.scaler.columns)
        for i, (c, a, b) in enumerate(zip(self.scaler.columns, self.scaler.shift, self.scaler.scale)):
            parts.append(pair(F.lit(start + i), (F.col("row")[c].cast("double") - F.lit(float(a))) / F.lit(float(b))))
        set_slots = F.filter(F.array(*parts), lambda p: p.isNotNull() & (p["v"] != 0)) if parts else F.array().cast("array<struct<s:bigint,v:double>>")
        row = row.select("row", set_slots.alias("set"))
        if self.expand:
            width = F.lit(self.width).cast("bigint")
            # Slot of the product i <= j: rows of the triangle before i, and the place in row i.
            place = lambda i, j: width + i * width - F.shiftright(i * (i - 1), 1) + (j - i)
            products = F.flatten(
                F.transform("set", lambda p, k: F.transform(F.slice("set", k + 1, F.size("set")), lambda q: pair(place(p["s"], q["s"]), p["v"] * q["v"])))
            )
            row = row.select("row", F.concat("set", products).alias("set"))
        ordered = F.array_sort("set")
        kept = [c for c in names if c not in (slots, values)]
        return row.select(*[F.col("row")[c].alias(c) for c in kept], F.transform(ordered, lambda p: p["s"]).alias(slots), F.transform(ordered, lambda p: p["v"]).alias(values))


def position_slots(codes: Column, categories: list[int]) -> Column:
    """Set slots of a one-hot with the same category list at every position of an array of codes.

    Slot = position * size + category; codes outside the list set nothing.
    """
    size = len(categories)
    listed = F.array(*[F.lit(c) for c in categories])
    slots = F.transform(
        codes,
        lambda code, i: F.when(F.array_contains(listed, code), (i * size + F.array_position(listed, code) - 1).cast("int")),
    )
    return F.filter(slots, lambda s: s.isNotNull())
