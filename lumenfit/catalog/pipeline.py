"""Search over families, the whole pipeline, reports and comparisons."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import metrics
from ..models.tree import DecisionTree
from ..operators.split import kfold
from ..plans import compare, leaderboard, report
from ..plans.autofit import autofit
from ..plans.search import RandomSearch
from ..models.base import Matrix
from ..session import shared_folder
from .common import labelled_documents, rounded, table


def _pipeline(spark, sf, target="quality", **options):
    """All families at full work; the budget is there to end a run, not to leave families out."""
    docs = labelled_documents(spark, sf).drop("toxic")
    return autofit(docs, target, keys=["doc_id"], time_budget=3600, **options)


def autofit_report(spark, sf):
    return _pipeline(spark, sf).report_df().drop("pipeline_seconds")


def autofit_regression(spark, sf):
    return _pipeline(spark, sf, "n_chars").report_df().drop("pipeline_seconds")


def autofit_explanation(spark, sf):
    """The whole run told in words and read back from its JSON report."""
    found = _pipeline(spark, sf)
    path = f"{shared_folder(spark).rstrip('/')}/report-{uuid.uuid4().hex}.json"
    full = dict(found.report, explanation=found.explanation)
    back = report.load_report(spark, report.write_report(report.report_table(spark, full), path))
    return back.select("best_model", "explanation", F.size("top_features").alias("n_features"))


def random_search(spark, sf):
    docs = kfold(labelled_documents(spark, sf), ["doc_id"], 5)
    m = Matrix(docs, ("doc_id",), "quality", ["n_chars", "toxic"])
    grid = {"max_depth": [1, 2, 3], "min_samples_split": [2, 5, 20]}
    return RandomSearch(DecisionTree, grid, k=5, n_iter=10).fit(m, refit=False).leaderboard(spark).drop("seconds")


def leaderboard_classification(spark, sf):
    docs = labelled_documents(spark, sf)
    m = leaderboard.baseline_matrix(docs, "quality", ["doc_id"], ["lang", "source", "n_chars", "toxic"], "classification")
    return leaderboard.leaderboard(m).drop("seconds")


def leaderboard_regression(spark, sf):
    docs = labelled_documents(spark, sf)
    m = leaderboard.baseline_matrix(docs, "n_chars", ["doc_id"], ["lang", "source", "quality", "toxic"], "regression")
    return leaderboard.leaderboard(m).drop("seconds")


def _labels_report(spark, sf, guess, name, seconds):
    """A report whose metrics are those of a guess at the quality labels."""
    y = F.col("quality")
    named = {"accuracy": metrics.accuracy, "f1": metrics.f1_score, "precision": metrics.precision,
             "recall": metrics.recall}
    entries = [F.struct(F.lit(n).alias("key"), rounded(m(y, guess)).alias("value")) for n, m in named.items()]
    return table(spark, sf, "labels").agg(F.map_from_entries(F.array(*entries)).alias("metrics")).select(
        "metrics", F.lit(name).alias("best_model"), F.lit(seconds).alias("pipeline_seconds"))


def _two_reports(spark, sf):
    return (_labels_report(spark, sf, F.col("toxic"), "toxic", 2.0),
            _labels_report(spark, sf, F.lit(1), "always", 1.0))


def compare_metrics(spark, sf):
    a, b = _two_reports(spark, sf)
    found = compare.compare_metrics(compare.metric_rows(a), compare.metric_rows(b), ("toxic", "always"))
    return found.withColumn("difference", rounded("difference"))


def report_sink(spark, sf):
    """A report written as JSON and read back: its metrics, one per row."""
    path = f"{shared_folder(spark).rstrip('/')}/report-{uuid.uuid4().hex}.json"
    back = report.load_report(spark, report.write_report(_two_reports(spark, sf)[0], path))
    return back.select("best_model", F.explode("metrics").alias("metric", "value"))


def comparison_sink(spark, sf):
    """A comparison written as JSON and read back."""
    path = f"{shared_folder(spark).rstrip('/')}/comparison-{uuid.uuid4().hex}.json"
    found = compare_metrics(spark, sf)
    return spark.read.schema(found.schema).json(compare.write_comparison(found, path))


def compare_reports(spark, sf):
    a, b = _two_reports(spark, sf)
    found = compare.compare_reports(a, b, ("toxic", "always"))
    return found.select(
        F.col("models.left").alias("left_model"), F.col("models.right").alias("right_model"),
        F.col("time_seconds.left").alias("left_seconds"), F.size("metrics").alias("shared"), "winner",
        rounded(F.col("metrics")["accuracy"]["difference"]).alias("accuracy_difference"))


def _leaders(spark, sf, columns):
    """A leaderboard of constant and given guesses at the labels."""
    rows = []
    for position, (name, guess) in enumerate(columns):
        row = table(spark, sf, "labels").agg(rounded(metrics.accuracy(F.col("quality"), guess), 4).alias("accuracy"))
        rows.append(row.select(F.lit(position).alias("position"), F.lit(name).alias("family"), "accuracy",
                               F.lit(1.0).alias("seconds")))
    return rows[0].unionByName(rows[1])


def compare_leaderboards(spark, sf):
    a = _leaders(spark, sf, [("toxic", F.col("toxic")), ("calm", 1 - F.col("toxic"))])
    b = _leaders(spark, sf, [("never", F.lit(0)), ("always", F.lit(1))])
    return compare.compare_leaderboards(a, b, "accuracy", ("ours", "theirs"))


QUERIES = {
    "autofit_report": autofit_report,
    "autofit_regression": autofit_regression,
    "autofit_explanation": autofit_explanation,
    "random_search": random_search,
    "leaderboard_classification": leaderboard_classification,
    "leaderboard_regression": leaderboard_regression,
    "compare_metrics": compare_metrics,
    "compare_reports": compare_reports,
    "report_sink": report_sink,
    "comparison_sink": comparison_sink,
    "compare_leaderboards": compare_leaderboards,
}

_GUESSES = """with g as (select quality as y, toxic as p, 0 as side from labels union all select quality, 1, 1 from labels),
    c as (select side, avg((y = p)::int) acc, count(*) filter (y = 1 and p = 1)::double tp,
                 count(*) filter (y = 0 and p = 1) fp, count(*) filter (y = 1 and p = 0) fn from g group by side),
    q as (select side, acc, tp / (tp + fp + 1e-8) p, tp / (tp + fn + 1e-8) r from c),
    m as (select side, 'accuracy' as metric, round(acc, 6) as v from q union all select side, 'precision', round(p, 6) from q
          union all select side, 'recall', round(r, 6) from q union all
          select side, 'f1', round(2 * p * r / (p + r + 1e-8), 6) from q),
    x as (select a.metric, a.v + 0.0 as "left", b.v + 0.0 as "right", round(a.v - b.v, 6) + 0.0 as difference,
                 case when a.v > b.v then 'toxic' else 'always' end as winner
          from m a join m b on a.metric = b.metric where a.side = 0 and b.side = 1) """

ORACLES = {
    "compare_metrics": _GUESSES + "select * from x",
    "comparison_sink": _GUESSES + "select * from x",
    "report_sink": _GUESSES + """select 'toxic' as best_model, metric, "left" as value from x""",
    "compare_reports": _GUESSES + """select 'toxic' as left_model, 'always' as right_model, 2.0::double as left_seconds,
        (select count(*) from x)::int as shared, winner, difference as accuracy_difference from x where metric = 'accuracy'""",
    "compare_leaderboards": """with a as (select round(avg((quality = toxic)::int), 4) t, round(avg((quality = 1 - toxic)::int), 4) c,
            round(avg((quality = 0)::int), 4) n, round(avg((quality = 1)::int), 4) y from labels)
        select case when t >= c then 'toxic' else 'calm' end as model_ours, greatest(t, c) as accuracy_ours,
               1.0::double as seconds_ours, case when n >= y then 'never' else 'always' end as model_theirs,
               greatest(n, y) as accuracy_theirs, 1.0::double as seconds_theirs,
               round(greatest(t, c) - greatest(n, y), 4) + 0.0 as accuracy_diff from a""",
}
