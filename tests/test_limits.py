"""Sizes and keys beyond what the given tables hold: nothing is cut off, refused or typed differently."""

import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lumenfit.catalog.statistics import single_statistics
from lumenfit.models.knn import KNearestNeighbors
from lumenfit.operators import encode, prepare, quantiles, split
from lumenfit.plans.autofit import autofit
from lumenfit.session import Scratch, durable, shared_folder


def test_statistics_of_many_groups(spark, tmp_path):
    rows = [(f"type{i % 1500}" if i % 1501 else None, float(i * 37 % 101)) for i in range(6000)] + [("none", None)]
    spark.createDataFrame(rows, "event_type string, value double").write.parquet(f"{tmp_path}/events.parquet")
    found = {r["event_type"]: r for r in single_statistics(spark, str(tmp_path)).collect()}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    assert set(found) == set(groups) and len(groups) == 1502
    for g, values in groups.items():
        values = [v for v in values if v is not None]
        if values:
            top = min(Counter(values).items(), key=lambda x: (-x[1], x[0]))[0]
            assert (found[g]["median"], found[g]["mode"], found[g]["n_unique"]) == (statistics.median(values), top, len(set(values)))


@pytest.mark.parametrize("n", [1, 2, 9, 10, 30_000, 30_001])
def test_group_medians(spark, n):
    df = spark.range(n).select(F.lit("g").alias("g"), (F.col("id") * 7919 % n).cast("double").alias("x"))
    assert quantiles.group_medians(df, "g", "x").first()["median"] == (n - 1) / 2


@pytest.mark.parametrize("n", [3, 500, 501, 3000])
def test_codes_have_one_type(spark, n):
    df = spark.range(n).select(F.format_string("c%05d", "id").alias("t"), "id")
    coded = encode.LabelEncoder().fit_transform(df, "t", "code")
    assert coded.schema["code"].dataType.simpleString() == "bigint"
    assert coded.where("code <> id").count() == 0


@pytest.mark.parametrize("options", [{"encoding": "ordinal"}, {"wide": "ordinal"}])
def test_wide_text_is_prepared(spark, options):
    df = spark.range(3000).select(F.format_string("c%05d", "id").alias("wide"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("narrow"), "id")
    fitted = prepare.Preprocessor(**options).fit(df, ["wide", "narrow"])
    assert fitted.wide == ["wide"]
    assert list(prepare.Preprocessor().fit(df, ["wide", "narrow"]).sparse) == ["wide"]
    row = fitted.matrix(df, ["id"]).agg(F.avg(F.col("features")[0]), F.stddev_pop(F.col("features")[0]), F.count(F.lit(1))).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 3000


def test_wide_indicators_equal_columns(spark):
    df = spark.range(600).select(F.format_string("c%03d", F.col("id") % 60).alias("t"), "id")
    fitted = prepare.Preprocessor().fit(df, ["t"])
    names = fitted.feature_names
    array = {r["id"]: r["features"] for r in fitted.matrix(df, ["id"]).collect()}
    for r in fitted.transform(df, ["id"]).collect():
        assert array[r["id"]] == pytest.approx([r[n] for n in names])


def test_autofit_with_identifiers(spark):
    df = spark.range(1500).select("id", F.format_string("name %d", "id").alias("name"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 > 3).cast("int").alias("y"))
    scratch = Scratch(spark)
    with scratch:
        result = autofit(df, "y", keys=["id"], families=None, grids={}, max_width=100, time_budget=600, cv_folds=2, parallelism=1)
        assert result.report["status"] == "success" and scratch.paths
        folder = scratch.paths[0]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_keys_must_be_unique(spark):
    df = spark.createDataFrame([(i // 4, float(i), i % 2) for i in range(40)], "k int, x double, y int")
    with pytest.raises(ValueError, match="more than once"):
        autofit(df, "y", keys=["k"])


def test_composite_keys_do_not_collide(spark):
    df = spark.createDataFrame([("a:b", "c", 0.0, 0), ("a", "b:c", 9.0, 1), (None, "x", 20.0, 0), ("x", None, 30.0, 1)], "p string, q string, x double, label int")
    model = KNearestNeighbors(k=1).fit(df, "label", ["x"], keys=["p", "q"])
    assert all(r["prediction"] == r["label"] for r in model.transform(df).collect())
    assert df.select(split.row_hash(["p", "q"], 42)).distinct().count() == 4


@pytest.mark.parametrize("values, kind", [([i / 10 for i in range(10)], "double"), ([2**60 + i for i in range(10)], "long"), ([f"k{i}" for i in range(10)], "string")])
def test_split_in_order(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in reversed(values)], f"k {kind}").repartition(3)
    train, test = split.train_test_split(df, ["k"], 0.5, shuffle=False)
    assert sorted(r[0] for r in train.collect()) == values[:5] and sorted(r[0] for r in test.collect()) == values[5:]


def test_split_in_order_of_composite_keys(spark):
    rows = [(i // 4, f"s{i % 4}") for i in range(20)]
    df = spark.createDataFrame(rows, "a int, b string").repartition(4)
    train, _ = split.train_test_split(df, ["a", "b"], 0.3, shuffle=False)
    assert sorted(tuple(r) for r in train.collect()) == rows[:14]


def test_intermediate_tables_stay_in_the_shared_folder(spark):
    with Scratch(spark) as scratch:
        durable(spark.range(3))
        assert all(p.startswith(shared_folder(spark)) for p in scratch.paths) and len(scratch.paths) == 1


def test_copies_are_numbered_by_many_tasks(spark, monkeypatch):
    """The pieces of a table of copies are a few bytes, which must not put all of its rows into one task."""
    monkeypatch.setattr(split, "ROWS_PER_PIECE", 1_000)
    df = spark.range(20_000).select((F.col("id") % 3).alias("a"), F.lit(None).cast("string").alias("b"))
    keyed = split.with_row_key(df, chunk=100)
    each = keyed.groupBy(F.spark_partition_id()).count().collect()
    assert len(each) > 8 and max(r["count"] for r in each) < 5_000
    assert keyed.select("row_id").distinct().count() == 20_000 and keyed.where("b is null").count() == 20_000
