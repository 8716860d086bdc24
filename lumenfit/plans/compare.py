"""Comparing two reports or two leaderboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.metrics import METRICS

# The metric that decides, by task.
PRIMARY = {"classification": "accuracy", "regression": "mae"}


def metric_rows(report: DataFrame) -> DataFrame:
    return report.select(F.explode("metrics").alias("metric", "value"))


def compare_metrics(left: DataFrame, right: DataFrame, names=("left", "right")) -> DataFrame:
    """(metric, left, right, difference, winner) for the metrics both tables hold.

    The better value wins by the metric's direction; a tie goes to the second.
    """
    a = left.select("metric", F.col("value").alias("left"))
    b = right.select("metric", F.col("value").alias("right"))
    both = a.join(b, "metric").withColumn("difference", F.col("left") - F.col("right"))
    return both.withColumn("winner", F.when(_left_wins(), names[0]).otherwise(names[1]))


def _left_wins() -> Column:
    lower = [m.name for m in METRICS.values() if not m.higher_is_better]
    smaller_wins = F.col("metric").isin(lower)
    return F.when(smaller_wins, F.col("left") < F.col("right")).otherwise(F.col("left") > F.col("right"))


def compare_reports(left: DataFrame, right: DataFrame, names=("left", "right")) -> DataFrame:
    """One row: both models and times, the shared metrics, and the winner by the deciding metric."""
    shared = compare_metrics(metric_rows(left), metric_rows(right), names)
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(
        F.col("metric"), F.struct(F.col("left"), F.col("right"), F.col("difference"))))))
    folded = shared.agg(
        entries.alias("metrics"),
        F.first(F.when(F.col("metric").isin(*PRIMARY.values()), F.col("winner")), True).alias("winner"),
    )
    side = lambda df, s: df.select(F.lit(1).alias("_one"), F.col("best_model").alias(f"model_{s}"),
                                   F.col("pipeline_seconds").alias(f"time_{s}"))
    # three one-row tables
    joined = folded.withColumn("_one", F.lit(1)).join(side(left, "left"), "_one").join(
        side(right, "right"), "_one")
    return joined.select(
        F.struct(F.col("model_left").alias("left"), F.col("model_right").alias("right")).alias("models"),
        F.struct(F.col("time_left").alias("left"), F.col("time_right").alias("right")).alias("time_seconds"),
        "metrics", "winner",
    )


def compare_leaderboards(left: DataFrame, right: DataFrame, metric: str, names=("left", "right")) -> DataFrame:
    """Best line of each leaderboard side by side, with the difference rounded to 4 places."""
    a, b = (best_line(df, metric).select(
        F.lit(1).alias("_one"), F.col("family").alias(f"model_{s}"), F.col(metric).alias(f"{metric}_{s}"),
        F.col("seconds").alias(f"seconds_{s}")) for df, s in ((left, names[0]), (right, names[1])))
    gap = F.round(F.col(f"{metric}_{names[0]}") - F.col(f"{metric}_{names[1]}"), 4)
    return a.join(b, "_one").drop("_one").withColumn(f"{metric}_diff", gap)


def best_line(leaderboard: DataFrame, metric: str) -> DataFrame:
    order = F.col(metric).desc() if METRICS[metric].higher_is_better else F.col(metric).asc()
    return leaderboard.where(F.col(metric).isNotNull()).orderBy(order, "position").limit(1)


def write_comparison(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").json(path)
    return path
