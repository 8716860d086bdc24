"""The whole pipeline: profile, prepare, search, evaluate, explain, report."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.metrics import SEARCH_METRIC, TASK_METRICS, Metric
from ..models.base import Matrix, Model, feature_importance
from ..operators.prepare import FittedPreprocessor, Preprocessor, clean_target
from ..operators.profile import DataInspector
from ..operators.split import kfold, with_row_key
from ..operators.typing import detect_task, is_missing
from ..session import durable
from ..sources.tables import read_table
from .report import build_report, explanation_of, report_table, write_report
from .search import (FAMILIES, GridSearch, RandomSearch, Scored, better, default_grid, fold_metrics,
                     leaderboard_table, out_of_fold, usable_metrics)

TOP_FEATURES = 10
LABEL = "label"


@dataclass
class AutofitResult:
    """The report, the fitted transform and model, and the tables behind the choice."""

    report: dict
    model: Model
    preprocessor: FittedPreprocessor
    matrix: Matrix
    profile: DataFrame
    lines: list[Scored] = field(default_factory=list)

    @property
    def spark(self) -> SparkSession:
        return self.matrix.df.sparkSession

    def report_df(self) -> DataFrame:
        return report_table(self.spark, self.report)

    def leaderboard(self) -> DataFrame:
        return leaderboard_table(self.spark, self.lines)

    def importances(self) -> DataFrame:
        return self.model.importance_table(self.spark)

    @property
    def explanation(self) -> str:
        return explanation_of(self.spark, self.report)

    def predict(self, df: DataFrame) -> DataFrame:
        """Prepare new rows as the training rows were and add ``prediction``."""
        keep = [k for k in self.matrix.keys if k in df.columns]
        return self.model.transform(self.preprocessor.matrix(df, keep)).drop("features")


def autofit(
    source: DataFrame | str, target: str, task_type: str = "auto", time_budget: float = 60,
    cv_folds: int = 5, use_random_search: bool = False, *, spark: SparkSession | None = None,
    keys: list[str] | None = None, features: list[str] | None = None, metric: Metric | None = None,
    families: dict | None = None, grids: dict | None = None, imputer_strategy: str = "mean",
    scaler: str = "standard", fit_per_fold: bool = False, max_width: int = 1_000, seed: int = 42,
    parallelism: int = 3,
) -> AutofitResult:
    """Find, refit and explain the best model for ``target``.

    ``source`` is a DataFrame, a path or a table name. ``keys`` name the columns that identify a
    row (they are not features); without them rows are keyed by content. ``fit_per_fold`` fits
    the preparation on each fold's training rows only. ``parallelism`` families are searched at a
    time, as independent Spark jobs; with 1 the budget is checked strictly between families.
    """
    start = time.time()
    if task_type not in ("auto", "classification", "regression"):
        raise ValueError("task_type must be 'auto', 'classification' or 'regression'")
    spark = spark or (source.sparkSession if isinstance(source, DataFrame) else SparkSession.active())
    df = read_table(spark, source, target)
    if not keys:
        df, keys = durable(with_row_key(df)), ["row_id"]  # every later pass would repeat the shuffle
    elif df.groupBy(*keys).count().where("count > 1").limit(1).count():
        raise ValueError(f"the keys {keys} name some row more than once")
    features = features or [c for c in df.columns if c != target and c not in keys]
    if not features:
        raise ValueError("there are no feature columns")

    inspector = DataInspector()
    eda = inspector.fit(df.select(*[F.col(f"`{c}`") for c in features]), features)

    labelled, _ = clean_target(df, target)
    task = detect_task(labelled, target) if task_type == "auto" else task_type
    kind = "int" if task == "classification" else "double"
    labelled = labelled.withColumn(LABEL, F.col(f"`{target}`").cast(kind))
    labelled = kfold(labelled, keys, cv_folds, seed)
    prepare = Preprocessor(scaler, imputer_strategy, max_width=max_width)
    fitted = prepare.fit(labelled, features)
    matrix = Matrix(durable(fitted.matrix(labelled, [*keys, LABEL, "fold"])), tuple(keys), task=task)
    per_fold = None
    if fit_per_fold:
        per_fold = _matrices_per_fold(prepare, labelled, features, matrix, cv_folds)

    search = _search_families(matrix, per_fold, task, cv_folds, time_budget, use_random_search,
                              metric, families, grids, seed, parallelism)
    best, lines = search
    model = best.refit(matrix)
    model.names = fitted.feature_names
    report = build_report(
        best.name, best.best_params, {n: best.best_scores[n] for n in TASK_METRICS[task]},
        feature_importance(model, fitted.feature_names)[:TOP_FEATURES], eda, task, time.time() - start,
    )
    return AutofitResult(report, model, fitted, matrix, inspector.profile, lines)


def _matrices_per_fold(prepare, labelled, features, matrix, k) -> list[Matrix]:
    """Per fold: a matrix prepared from its training rows, fold 0 held out, fold 1 training."""
    found = []
    for f in range(k):
        fitted = prepare.fit(labelled.where(F.col("fold") != f), features)
        part = fitted.matrix(labelled, [*matrix.keys, LABEL, "fold"])
        part = part.withColumn("fold", F.when(F.col("fold") == f, 0).otherwise(1))
        found.append(matrix.with_df(durable(part)))
    return found


class _PerFold:
    """A family whose folds come from separately prepared matrices."""

    def __init__(self, family, matrices):
        self.family, self.matrices = family, matrices
        self.__name__ = family.__name__

    def out_of_fold(self, m, configs, k, seed):
        out = None
        for f, matrix in enumerate(self.matrices):
            part = out_of_fold(self.family, matrix, configs, 1, seed).withColumn("fold", F.lit(f))
            out = part if out is None else out.unionByName(part)
        return out

    def fit_matrix(self, m, params, seed):
        return self.family.fit_matrix(m, params, seed)


def _search_families(matrix, per_fold, task, k, time_budget, use_random, metric, families, grids, seed,
                     parallelism):
    """Search the families, several at a time; none starts once the budget is spent, and a
    failing family is skipped. The first of equally good families wins."""
    chosen = metric or SEARCH_METRIC[task]
    maker = RandomSearch if use_random else GridSearch
    start = time.time()

    def run(name, family):
        if time.time() - start > time_budget:
            return Scored(name, {}, {}, 0.0, "skipped: time budget reached")
        family = family if per_fold is None else _PerFold(family, per_fold)
        search = maker(family, (grids or {}).get(name, default_grid(name)), k, chosen, seed, name)
        try:
            return search.fit(matrix, refit=False)
        except (ValueError, ArithmeticError, PySparkException) as problem:
            return Scored(name, {}, {}, 0.0, f"skipped: {str(problem)[:300]}")

    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        jobs = [pool.submit(inheritable_thread_target(matrix.df.sparkSession)(run), name, family)
                for name, family in (families or FAMILIES[task]).items()]
        found = [job.result() for job in jobs]
    lines, best = [], None
    for search in found:
        if isinstance(search, Scored):
            lines.append(search)
            continue
        lines += search.lines
        if search.best_params is not None and better(chosen, search.best_score, best and best.best_score):
            best = search
    if best is None:
        raise RuntimeError("no model family could be fitted: " + "; ".join(f"{x.family}: {x.status}" for x in lines))
    return best, lines


def run_autofit(spark: SparkSession, arguments: dict, **options) -> dict:
    """Checked call for services: a report record with explanation and path, or an error record."""
    source, target = arguments.get("csv_path"), arguments.get("target_col")
    if not source or not target:
        return _error("the call needs both 'csv_path' and 'target_col'")
    try:
        result = autofit(
            source, target, arguments.get("task_type", "auto"), arguments.get("time_budget", 60),
            arguments.get("cv_folds", 5), spark=spark, **options)
        report = dict(result.report, explanation=result.explanation)
        stem = source[:-4] if source.endswith(".csv") else source.rstrip("/")
        report["report_path"] = write_report(report_table(spark, report), f"{stem}_report.json")
        return report
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return _error(f"CSV file not found: {source}")
        return _error(str(problem))
    except Exception as problem:  # the contract of this call: every failure becomes a record
        return _error(str(problem))


def _error(message: str) -> dict:
    return {"status": "error", "error": message}


def error_table(spark: SparkSession, record: dict) -> DataFrame:
    """An error record as a one-row table."""
    return spark.createDataFrame([(record["status"], record["error"])], "status string, error string")
