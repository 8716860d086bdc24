"""Headline timings: one JSON line, seconds per query over the tables in ``$BENCH_SF_DIR``."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lumenfit import catalog  # noqa: E402
from lumenfit.catalog.common import embeddings, labelled_documents, table  # noqa: E402
from lumenfit.functions.metrics import METRICS  # noqa: E402
from lumenfit.models.base import Matrix  # noqa: E402
from lumenfit.models.linear import LinearRegression  # noqa: E402
from lumenfit.models.logistic import LogisticRegression  # noqa: E402
from lumenfit.models.tree import DecisionTree, RandomForest  # noqa: E402
from lumenfit.operators.split import kfold  # noqa: E402
from lumenfit.plans.autofit import autofit  # noqa: E402
from lumenfit.plans.search import cross_validate  # noqa: E402
from lumenfit.session import durable, local_session  # noqa: E402

LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


def lines_matrix(spark, sf) -> Matrix:
    lines = table(spark, sf, "lineitem").select(
        *LINE_KEYS, (F.col("l_quantity") / 50).alias("a"), (F.col("l_discount") * 10).alias("b"),
        (F.col("l_tax") * 10).alias("c"), (F.col("l_extendedprice") / 100000).alias("label"))
    return Matrix(durable(kfold(lines, LINE_KEYS, 5)), tuple(LINE_KEYS), "label", ["a", "b", "c"], task="regression")


def linear_cv(spark, sf):
    grid = [{"lr": 0.01, "epochs": 200}, {"lr": 0.1, "epochs": 200}]
    return cross_validate(lines_matrix(spark, sf), LinearRegression, grid, 5, [METRICS["mse"], METRICS["r2"]])


def logistic_lines(spark, sf):
    """200 epochs over every line item: returned or not."""
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_quantity") / 50).alias("a"), (F.col("l_discount") * 10).alias("b"),
        (F.col("l_extendedprice") / 100000).alias("p"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    model = LogisticRegression(0.1, 200).fit(lines, "y", ["a", "b", "p"])
    return model.transform(lines).groupBy("y", "prediction").count()


def tree_lines(spark, sf):
    """Depth 5 over every line item."""
    lines = table(spark, sf, "lineitem").withColumn("y", F.col("l_extendedprice") / 100000)
    features = ["l_quantity", "l_discount", "l_tax", "l_partkey", "l_suppkey"]
    return DecisionTree(5, task="regression").fit(lines, "y", features).to_table(spark)


def forest_docs(spark, sf):
    docs = labelled_documents(spark, sf)
    return RandomForest(10, 5).fit(docs, "quality", ["n_chars", "toxic"], keys=["doc_id"]).to_table(spark)


def autofit_classification(spark, sf):
    docs = labelled_documents(spark, sf).drop("toxic")
    return autofit(docs, "quality", keys=["doc_id"], time_budget=600).report_df()


def autofit_regression(spark, sf):
    docs = labelled_documents(spark, sf).drop("toxic")
    return autofit(docs, "n_chars", keys=["doc_id"], time_budget=600).report_df()


CATALOG = ["profile_table", "corr_matrix", "outlier_rows", "impute_median", "standard_scale", "prepare_table",
           "kfold", "gramian", "least_squares", "gnb_cv", "knn_cv", "metrics_regression"]
LOCAL = [linear_cv, logistic_lines, tree_lines, forest_docs, autofit_classification, autofit_regression]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("OFF")
    known = catalog.all_queries()
    runs = {name: known[name] for name in CATALOG} | {f.__name__: f for f in LOCAL}
    wanted = sys.argv[1:] or list(runs)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the engine
    seconds = {}
    for name in wanted:
        start = time.time()
        runs[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
