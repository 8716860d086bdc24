import json

import pytest
from pyspark.sql import functions as F

from lumenfit.functions.metrics import METRICS
from lumenfit.models.naive_bayes import GaussianNB
from lumenfit.models.tree import DecisionTree, RandomForest
from lumenfit.plans import compare, leaderboard, report
from lumenfit.plans.autofit import autofit, error_table, run_autofit
from lumenfit.plans.search import FAMILIES
from lumenfit.sources.fixtures import classification_table, regression_table
from lumenfit.streaming import score_stream

QUICK = {n: FAMILIES["classification"][n] for n in ("DecisionTree_clf", "GaussianNB")}
KEYS = ("status task_type best_model best_params metrics top_features eda_summary pipeline_seconds "
        "benchmark_pass within_time_budget").split()


@pytest.fixture(scope="module")
def people(spark):
    return classification_table(spark, 120).cache()


@pytest.fixture(scope="module")
def classified(people):
    return autofit(people, "Survived", keys=["id"], cv_folds=3, time_budget=600)


def test_classification_report(spark, classified):
    found = classified.report
    assert set(found) == set(KEYS)
    assert found["task_type"] == "classification" and found["metrics"]["accuracy"] > 0.9
    assert set(found["metrics"]) == {"accuracy", "f1", "precision", "recall"}
    assert found["eda_summary"]["n_rows"] == 120 and found["eda_summary"]["categorical_cols"] == ["Education"]
    assert sum(f["importance"] for f in found["top_features"]) == pytest.approx(1, abs=1e-3)
    families = {r["family"] for r in classified.leaderboard().collect()}
    assert families == set(FAMILIES["classification"])
    assert classified.leaderboard().count() == 14
    best = max(line.scores["accuracy"] for line in classified.lines)
    assert found["metrics"]["accuracy"] == pytest.approx(best, abs=1e-6)
    assert classified.importances().count() == 5 and classified.profile.count() == 3


def test_prediction_of_new_rows(spark, people, classified):
    new = people.drop("Survived").withColumn("Education", F.lit("unknown"))
    assert classified.predict(new).join(people, "id").where("prediction = Survived").count() > 100


def test_regression(spark):
    result = autofit(regression_table(spark, 120), "Price", "regression", keys=["id"], cv_folds=3, time_budget=600,
                     parallelism=1)
    assert set(result.report["metrics"]) == {"mae", "mse", "r2"} and result.report["metrics"]["r2"] > 0.9
    lowest = min(line.scores["mse"] for line in result.lines)
    assert result.report["metrics"]["mse"] == pytest.approx(lowest, rel=1e-6)
    assert "and R2 " in result.explanation and len(result.lines) == 12


def test_time_budget_and_failing_family(spark, people):
    class Broken:
        def __init__(self):
            raise ValueError("no luck")

    late = autofit(people, "Survived", keys=["id"], cv_folds=2, families={"GaussianNB": GaussianNB, "Broken": Broken})
    assert {(line.family, line.status) for line in late.lines if line.status != "ok"} == {("Broken", "skipped: no luck")}
    with pytest.raises(RuntimeError, match="no model family"):
        autofit(people, "Survived", keys=["id"], cv_folds=2, time_budget=-1, families=QUICK)


def test_fit_per_fold_and_text_target(spark, people):
    named = people.withColumn("Survived", F.when(F.col("Survived") == 1, "yes").otherwise("no"))
    result = autofit(named, "Survived", keys=["id"], cv_folds=2, families=QUICK, fit_per_fold=True, time_budget=600)
    assert result.report["metrics"]["accuracy"] > 0.9 and result.report["best_model"] == "DecisionTree_clf"


def test_table_without_key(spark, people):
    result = autofit(people.drop("id"), "Survived", cv_folds=2, families=QUICK, use_random_search=True, time_budget=600)
    assert result.report["eda_summary"]["n_cols"] == 3 and result.report["status"] == "success"


def test_bad_arguments(spark, people):
    with pytest.raises(ValueError, match="not found among"):
        autofit(people, "Nothing", keys=["id"])
    with pytest.raises(ValueError, match="task_type"):
        autofit(people, "Survived", "other")


def test_checked_call(spark, people, tmp_path):
    assert "csv_path" in run_autofit(spark, {})["error"]
    missing = run_autofit(spark, {"csv_path": str(tmp_path / "no.csv"), "target_col": "y"})
    assert missing["status"] == "error" and "not found" in missing["error"]
    assert error_table(spark, missing).first()["status"] == "error"
    path = tmp_path / "people.csv"
    rows = people.collect()
    path.write_text("id,Age,Income,Education,Survived\n" + "\n".join(
        f'{r["id"]},{r["Age"]},{r["Income"]},{r["Education"]},{r["Survived"]}' for r in rows))
    assert "not found among" in run_autofit(spark, {"csv_path": str(path), "target_col": "z"})["error"]
    done = run_autofit(spark, {"csv_path": str(path), "target_col": "Survived", "cv_folds": 2, "time_budget": 600},
                       families=QUICK, keys=["id"])
    assert done["status"] == "success" and "Best family" in done["explanation"]
    back = report.load_report(spark, done["report_path"]).first()
    assert back["best_model"] == done["best_model"] and back["metrics"]["accuracy"] == done["metrics"]["accuracy"]
    assert back["report_path"] == done["report_path"]


EDA = {"n_rows": 9, "n_cols": 2, "numeric_cols": ["x"], "categorical_cols": []}


def test_explanation(spark):
    made = report.build_report("KNN_clf", {"k": 3, "task": "classification"},
                               {"accuracy": 0.5, "f1": 0.25, "precision": 1, "recall": 0.125}, [("x", 0.75)],
                               dict(EDA, missing_filled=4), "classification", 1.5)
    text = report.explanation_of(spark, made)
    assert text == ("The table has 9 rows and 2 feature columns. 4 empty cells were imputed. Best family: KNN_clf, settings k=3. "
                    "Cross-validation gives accuracy 50.00%, F1 0.2500, precision 1.0000 and recall 0.1250. It relies most on x. "
                    "The run took 1.50 s, inside the limit of 120 s.")
    slow = report.build_report("LinearRegression", {}, {"mae": 1, "r2": 0.5}, [], dict(EDA, outliers_flagged=2), "regression", 130)
    text = report.explanation_of(spark, slow)
    assert "2 cells lie outside" in text and "error of 1.0000 and R2 0.5000" in text and "beyond the limit" in text
    assert "relies" not in text and "imputed" not in text
    parsed = json.loads(report.report_to_json(report.report_table(spark, made)).first()["json"])
    assert parsed["eda_summary"]["n_rows"] == 9 and parsed["best_params"] == {"k": "3"}


def test_compare_reports(spark, tmp_path):
    def made(name, metrics, task, seconds):
        return report.report_table(spark, report.build_report(name, {}, metrics, [], EDA, task, seconds))

    a, b = made("a", {"accuracy": 0.8, "f1": 0.5}, "classification", 1), made("b", {"accuracy": 0.7}, "classification", 2)
    row = compare.compare_reports(a, b, ("ours", "theirs")).first()
    assert row["winner"] == "ours" and list(row["metrics"]) == ["accuracy"] and row["time_seconds"]["right"] == 2
    assert row["metrics"]["accuracy"]["difference"] == pytest.approx(0.1)
    a, b = made("a", {"mae": 2.0}, "regression", 1), made("b", {"mae": 1.0}, "regression", 1)
    assert compare.compare_reports(a, b).first()["winner"] == "right"  # the lower error wins
    path = compare.write_comparison(compare.compare_reports(a, b), str(tmp_path / "c"))
    assert spark.read.json(path).count() == 1


@pytest.mark.parametrize("task, target", [("classification", "Survived"), ("regression", "Income")])
def test_leaderboards(spark, people, task, target):
    features = [c for c in ("Age", "Income", "Education") if c != target]
    m = leaderboard.baseline_matrix(people, target, ["id"], features, task, 3)
    models = {n: (f, dict(p, n_trees=5) if f is RandomForest else p) for n, (f, p) in
              (leaderboard.CLASSIFIERS if task == "classification" else leaderboard.REGRESSORS).items()}
    board = leaderboard.leaderboard(m, 3, models)
    assert board.count() == len(models)
    metric = "accuracy" if task == "classification" else "r2"
    best = compare.best_line(board, metric).first()
    assert best[metric] == max(r[metric] for r in board.collect())
    row = compare.compare_leaderboards(board, board, metric).first()
    assert row[f"{metric}_diff"] == 0


def test_scoring_a_stream(spark, people, tmp_path):
    """Fitted transforms and models are plain projections, so they apply to streams unchanged."""
    path = str(tmp_path / "people")
    people.write.parquet(path)
    model = DecisionTree(2).fit(people, "Survived", ["Age", "Income"])
    stream = score_stream(model, spark.readStream.schema(people.schema).parquet(path))
    query = stream.writeStream.format("memory").queryName("scored").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("scored").where("prediction = Survived").count() == 120


def test_metric_registry():
    assert not METRICS["mse"].higher_is_better and METRICS["accuracy"].higher_is_better
