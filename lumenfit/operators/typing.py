"""Column kinds, missing cells and input checks.

A cell is missing when it is null, NaN, blank text or the text "nan". Kinds are decided once,
from the schema where that suffices and by one aggregate over the text columns otherwise, and
then travel with the fitted objects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Fixed value: text that counts as a number.
NUM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Fixed value: up to this many distinct targets the task is a classification.
MAX_CLASSES = 20

NUMERICAL, CATEGORICAL, BOOLEAN = "numerical", "categorical", "boolean"


def split_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """Features in their order, and the target."""
    require_column(df, target)
    return df.drop(target), df.select(target)


def require_column(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"column '{name}' not found among {df.columns}")


def is_missing(df: DataFrame, name: str) -> Column:
    """Whether a cell is missing, by the column's schema type."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    if isinstance(kind, T.StringType):
        return c.isNull() | F.lower(F.trim(c)).isin("", "nan")
    return c.isNull()


def handle_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every kind of missing cell becomes null."""
    columns = columns or df.columns
    return df.withColumns(
        {c: F.when(~is_missing(df, c), F.col(f"`{c}`")) for c in columns}
    )


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column with its number of missing cells; one pass."""
    columns = columns or df.columns
    row = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "missing")


def check_nan(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Total number of missing cells, as a one-row table."""
    return missing_counts(df, columns).agg(F.sum("missing").alias("missing"))


def _check_supported(df: DataFrame, columns: list[str]) -> None:
    for c in columns:
        kind = df.schema[c].dataType
        if not isinstance(kind, (T.NumericType, T.BooleanType, T.StringType)):
            raise ValueError(f"column '{c}' has type {kind.simpleString()}; project it to a "
                             "number, a boolean or text first")


def _text_checks(df: DataFrame, text: list[str]) -> dict[str, dict]:
    if not text:
        return {}
    checks = []
    for c in text:
        present, numeric = ~is_missing(df, c), F.col(f"`{c}`").rlike(NUM)
        checks.append(F.struct(
            F.count_if(present).alias("present"),
            F.count_if(present & ~numeric).alias("unparsable"),
        ).alias(c))
    row = df.agg(*checks).first()
    return {c: row[c].asDict() for c in text}


def detect_column_types(df: DataFrame, columns: list[str] | None = None) -> dict[str, str]:
    """``{column: kind}``. Text whose present cells are all numbers is numerical."""
    columns = columns or df.columns
    _check_supported(df, columns)
    types = {c: df.schema[c].dataType for c in columns}
    found = _text_checks(df, [c for c, t in types.items() if isinstance(t, T.StringType)])
    kinds = {}
    for c, t in types.items():
        if isinstance(t, T.BooleanType):
            kinds[c] = BOOLEAN
        elif isinstance(t, T.NumericType):
            kinds[c] = NUMERICAL
        else:
            numeric = found[c]["present"] > 0 and found[c]["unparsable"] == 0
            kinds[c] = NUMERICAL if numeric else CATEGORICAL
    return kinds


def column_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: kind, missing cells, and present text cells that are no number."""
    columns = columns or df.columns
    _check_supported(df, columns)
    cells = []
    for c in columns:
        kind, missing = df.schema[c].dataType, is_missing(df, c)
        if isinstance(kind, T.StringType):
            unparsable = F.count_if(~missing & ~F.col(f"`{c}`").rlike(NUM))
            word = F.when((F.count_if(~missing) > 0) & (unparsable == 0), NUMERICAL)
            word = word.otherwise(CATEGORICAL)
        else:
            unparsable = F.lit(0).cast("bigint")
            word = F.lit(BOOLEAN if isinstance(kind, T.BooleanType) else NUMERICAL)
        cells.append(F.struct(
            F.lit(c).alias("column"), word.alias("kind"),
            F.count_if(missing).alias("missing"), unparsable.alias("unparsable"),
        ))
    return df.agg(F.array(*cells).alias("a")).select(F.inline("a"))


def to_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Text cells become doubles where they are numbers and null elsewhere."""
    columns = columns or df.columns
    return df.withColumns({c: numeric_cell(df, c) for c in columns})


def numeric_cell(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(c.rlike(NUM), F.trim(c).try_cast("double"))
    return F.when(~is_missing(df, name), c.cast("double"))


def typed(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Cast each column to its kind, missing cells to null; other columns pass through."""
    casts = {}
    for c, kind in kinds.items():
        if kind == NUMERICAL:
            casts[c] = numeric_cell(df, c)
        elif kind == CATEGORICAL:
            casts[c] = F.when(~is_missing(df, c), F.col(f"`{c}`").cast("string"))
    return df.withColumns(casts) if casts else df


def detect_task(df: DataFrame, target: str) -> str:
    """Classification when the target has at most 20 distinct values.

    A sketch settles clearly continuous targets without shuffling their values; only targets
    with few values are counted exactly, and those shrink before the shuffle.
    """
    y = df.where(~is_missing(df, target)).select(target)
    rough = y.agg(F.approx_count_distinct(target, 0.02)).first()[0]
    if rough > 3 * MAX_CLASSES:
        return "regression"
    exact = y.agg(F.count_distinct(target)).first()[0]
    return "classification" if exact <= MAX_CLASSES else "regression"


def cast_target(df: DataFrame, target: str, task: str) -> DataFrame:
    kind = "int" if task == "classification" else "double"
    return df.withColumn(target, F.col(target).cast("double").cast(kind))


def validate_input(df: DataFrame, features, target: str) -> None:
    """Features and target sit in the same table; vectors must all have the same length."""
    require_column(df, target)
    if isinstance(df.schema[target].dataType, (T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"target '{target}' must hold single values")
    if isinstance(features, (list, tuple)):
        for c in features:
            require_column(df, c)
        return
    require_column(df, features)
    low, high = df.agg(F.min(F.size(features)), F.max(F.size(features))).first()
    if low is None or low != high:
        raise ValueError(f"vectors in '{features}' must all have the same length")


def where(df: DataFrame, condition: Column) -> DataFrame:
    """Row subset by a condition."""
    return df.where(condition)


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which every given column holds a value."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & ~is_missing(df, c)
    return df.where(condition)
