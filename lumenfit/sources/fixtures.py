"""Small synthetic tables for tests: the same columns and formulas at any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _uniform(seed: int, stream: int) -> Column:
    """A reproducible number in [0, 1) per row id."""
    h = F.xxhash64(F.lit(seed), F.lit(stream), F.col("id"))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))


def _whole(low: int, high: int, u: Column) -> Column:
    return (F.floor(u * (high - low)) + low).cast("int")


def classification_table(spark: SparkSession, n: int = 200, seed: int = 42,
                         learnable: bool = True, target: str = "Survived") -> DataFrame:
    """Age, Income, Education and a 0/1 target; the target is ``Age > 40 and Income > 50000``
    or, unlearnable, an independent coin."""
    levels = F.array(F.lit("low"), F.lit("medium"), F.lit("high"))
    rows = spark.range(n).select(
        "id",
        _whole(18, 70, _uniform(seed, 1)).alias("Age"),
        F.round(F.lit(20000.0) + _uniform(seed, 2) * 80000.0, 2).alias("Income"),
        F.get(levels, _whole(0, 3, _uniform(seed, 3))).alias("Education"),
    )
    label = (F.col("Age") > 40) & (F.col("Income") > 50000) if learnable else _uniform(seed, 4) < 0.5
    return rows.withColumn(target, label.cast("int"))


def regression_table(spark: SparkSession, n: int = 200, seed: int = 7,
                     learnable: bool = True, target: str = "Price") -> DataFrame:
    """Area, Rooms, Age and a price: ``round(Area * 1500 + Rooms * 15000)`` or independent."""
    rows = spark.range(n).select(
        "id",
        F.round(F.lit(40.0) + _uniform(seed, 1) * 210.0, 1).alias("Area"),
        _whole(1, 6, _uniform(seed, 2)).alias("Rooms"),
        _whole(0, 40, _uniform(seed, 3)).alias("Age"),
    )
    formula = F.col("Area") * 1500 + F.col("Rooms") * 15000
    noise = F.lit(50000) + _uniform(seed, 4) * 400000
    return rows.withColumn(target, F.round(formula if learnable else noise).cast("int"))
