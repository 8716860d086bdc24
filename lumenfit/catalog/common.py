"""Small helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.split import poisson_steps


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(c, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + F.lit(0.0)


def labelled_documents(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id")


def embeddings(spark, sf) -> DataFrame:
    width = {"width": 64}
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("features", metadata=width))


def fold_sql(k: int, key: str, by: str = "") -> str:
    """Fold number of the seeded order, in SQL."""
    part = f"partition by {by} " if by else ""
    return f"(ntile({k}) over ({part}order by md5(concat_ws(':', '42', {key}::varchar))) - 1)"


def draws_sql(key: str, tree: int) -> str:
    """How often a tree draws a row, in SQL."""
    draw = f"('0x' || substr(md5('42:{tree // 8}:' || {key}), {tree % 8 * 4 + 1}, 4))::int"
    return "(" + " + ".join(f"({draw} >= {step})::int" for step in poisson_steps()) + ")"
