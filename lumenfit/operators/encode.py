"""Category codes and indicator columns.

The fitted state is a table ``(category, code)``. Few categories become a literal lookup inside
the plan; many become a join with the category table, broadcast only while its size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import durable
from .typing import is_missing

LITERAL_CATEGORIES = 500
BROADCAST_BYTES = 64 << 20
SORTED_IN_ONE_TASK = 100_000
MAX_WIDTH = 1_000


def categories_of(df: DataFrame, column: str) -> DataFrame:
    """Distinct present values of a column, as text."""
    return df.where(~is_missing(df, column)).select(
        F.col(f"`{column}`").cast("string").alias("category")
    ).distinct()


def numbered(categories: DataFrame, n: int) -> DataFrame:
    """Add ``code``: the position in sorted order.

    Large sets are range-partitioned and numbered per partition plus an offset, so that no
    single task sorts all of them.
    """
    if n <= SORTED_IN_ONE_TASK:
        position = F.row_number().over(W.orderBy("category")) - 1
        return categories.select("category", position.cast("long").alias("code"))
    ranged = categories.repartitionByRange(F.col("category")).sortWithinPartitions("category")
    marked = durable(ranged.withColumn("_p", F.spark_partition_id()).withColumn(
        "_i", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ))
    sizes = marked.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_p", F.coalesce(before, F.lit(0)).alias("_before"))
    joined = marked.join(F.broadcast(offsets), "_p")  # one row per partition
    return joined.select("category", (F.col("_i") + F.col("_before")).alias("code"))


class LabelEncoder:
    """Categories to codes 0..k-1 in the given or in sorted order; unknown and missing give -1."""

    def __init__(self, categories: list[str] | None = None):
        self.given = list(categories) if categories is not None else None
        self.size, self.small = 0, False
        self.mapping: dict[str, int] | None = None
        self.table: DataFrame | None = None

    def fit(self, df: DataFrame, column: str) -> "LabelEncoder":
        if self.given is not None:
            pairs = {str(c): i for i, c in enumerate(self.given)}
            self.size, self.mapping = len(self.given), pairs
            return self
        found = categories_of(df, column)
        few = [r[0] for r in found.limit(LITERAL_CATEGORIES + 1).collect()]
        if len(few) <= LITERAL_CATEGORIES:
            self.size, self.mapping = len(few), {c: i for i, c in enumerate(sorted(few, key=_bytes))}
        else:
            self.size, text = found.agg(F.count(F.lit(1)), F.sum(F.octet_length("category"))).first()
            self.small = text + 16 * self.size <= BROADCAST_BYTES
            self.table = durable(numbered(found, self.size))
        return self

    @property
    def categories(self) -> list[str]:
        if self.mapping is None:
            raise ValueError(f"{self.size} categories: use to_table()")
        return list(self.mapping)

    def to_table(self, spark) -> DataFrame:
        """The fitted state as ``(category, code)``."""
        if self.table is not None:
            return self.table
        return spark.createDataFrame(list(self.mapping.items()), "category string, code long")

    def code(self, c: Column) -> Column:
        """The code as a column expression (few categories)."""
        if not self.mapping:
            return F.lit(-1).cast("long")
        literal = F.create_map(*[F.lit(v) for pair in self.mapping.items() for v in pair])
        return F.coalesce(F.try_element_at(literal, c.cast("string")), F.lit(-1)).cast("long")

    def transform(self, df: DataFrame, column: str, name: str | None = None) -> DataFrame:
        name = name or column
        if self.table is None:
            return df.withColumn(name, self.code(F.col(f"`{column}`")))
        lookup = self.table.select(F.col("category").alias("_category"), F.col("code").alias("_code"))
        if self.small:
            lookup = F.broadcast(lookup)
        joined = df.join(lookup, F.col(f"`{column}`").cast("string") == F.col("_category"), "left")
        coded = joined.withColumn(name, F.coalesce(F.col("_code"), F.lit(-1)).cast("long"))
        return coded.drop("_category", "_code")

    def fit_transform(self, df: DataFrame, column: str, name: str | None = None) -> DataFrame:
        return self.fit(df, column).transform(df, column, name)


class OneHotEncoder:
    """One 0/1 column per category, all categories kept; unknown and missing give all zeros."""

    def __init__(self, max_width: int = MAX_WIDTH):
        self.max_width = max_width
        self.categories: list[str] = []

    def fit(self, df: DataFrame, column: str) -> "OneHotEncoder":
        found = [r[0] for r in categories_of(df, column).limit(self.max_width + 1).collect()]
        if len(found) > self.max_width:
            raise ValueError(f"column '{column}' has more than {self.max_width} categories; drop it, "
                             "label-encode it or raise max_width")
        self.categories = sorted(found, key=_bytes)
        return self

    def indicators(self, c: Column) -> list[Column]:
        return [
            F.coalesce((c.cast("string") == F.lit(k)).cast("int"), F.lit(0)) for k in self.categories
        ]

    def names(self, column: str) -> list[str]:
        return [f"{column}_{k}" for k in self.categories]

    def transform(self, df: DataFrame, column: str) -> DataFrame:
        cells = self.indicators(F.col(f"`{column}`"))
        return df.withColumns(dict(zip(self.names(column), cells)))

    def fit_transform(self, df: DataFrame, column: str) -> DataFrame:
        return self.fit(df, column).transform(df, column)


def Encoding(category_type: str, categories: list[str] | None = None):
    """The encoder for 'ordinal' (codes) or 'nominal' (indicators) categories."""
    if category_type == "ordinal":
        return LabelEncoder(categories)
    if category_type == "nominal":
        return OneHotEncoder()
    raise ValueError(f"no encoder for {category_type!r} categories: they are 'ordinal' or 'nominal'")


def _bytes(s: str) -> bytes:
    return s.encode("utf-8")
