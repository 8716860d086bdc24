"""Reading tables: quoted CSV as text, or any DataFrame or parquet path as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.typing import require_column


def read_csv(spark: SparkSession, path: str, target: str | None = None, **options) -> DataFrame:
    """CSV with a header line and RFC 4180 quoting; all columns text, blank lines skipped.

    ``multiLine=True`` allows line breaks inside quotes at the price of unsplittable files.
    """
    reader = (
        spark.read.option("header", True).option("quote", '"').option("escape", '"')
        .option("encoding", "UTF-8").option("enforceSchema", False)
    )
    for name, value in options.items():
        reader = reader.option(name, value)
    df = reader.csv(path)
    if target is not None:
        require_column(df, target)
    return df


def read_table(spark: SparkSession, source: DataFrame | str, target: str | None = None) -> DataFrame:
    """A DataFrame, a parquet, ORC or JSON path, a CSV path, or a catalog table name."""
    if isinstance(source, DataFrame):
        df = source
    elif source.rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(source)
    elif source.rstrip("/").endswith(".orc"):
        df = spark.read.orc(source)
    elif source.rstrip("/").endswith((".json", ".jsonl")):
        df = spark.read.json(source)
    elif "/" not in source and spark.catalog.tableExists(source):
        df = spark.table(source)
    else:
        df = read_csv(spark, source)
    if target is not None:
        require_column(df, target)
    return df
