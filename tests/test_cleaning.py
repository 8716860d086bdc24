import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenfit.operators import encode, impute, prepare, scale, split
from lumenfit.sources.fixtures import classification_table, regression_table
from lumenfit.sources.tables import read_csv, read_table


def test_csv_quoting(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,name,score\n1,"a, b",2\n\n2,"say ""hi""",3.5\n', encoding="utf-8")
    df = read_csv(spark, str(path), "score")
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("1", "a, b", "2"), ("2", 'say "hi"', "3.5")]
    with pytest.raises(ValueError, match="not found among"):
        read_table(spark, str(path), "nothing")


def test_fixture_tables(spark):
    df = classification_table(spark, 120)
    assert df.where("(Survived = 1) <> (Age > 40 and Income > 50000)").count() == 0
    assert df.where("Age < 18 or Age >= 70").count() == 0
    assert classification_table(spark, 50).collect() == classification_table(spark, 50).collect()
    houses = regression_table(spark, 120)
    assert houses.where("Price <> round(Area * 1500 + Rooms * 15000)").count() == 0


HOLES = [(1.0, "a"), (None, "b"), (4.0, ""), (4.0, "b"), (float("nan"), "nan")]


@pytest.mark.parametrize("strategy, number", [("mean", 3.0), ("median", 4.0), ("mode", 4.0)])
def test_imputer(spark, strategy, number):
    df = spark.createDataFrame(HOLES, "x double, t string")
    done = impute.SimpleImputer(strategy).fit_transform(df)
    assert [r["x"] for r in done.collect()] == [1.0, number, 4.0, 4.0, number]
    assert [r["t"] for r in done.collect()] == ["a", "b", "b", "b", "b"]


def test_imputer_without_values(spark):
    with pytest.raises(ValueError, match="'x'"):
        impute.SimpleImputer().fit(spark.createDataFrame([(None,)], "x double"))
    with pytest.raises(ValueError, match="strategy"):
        impute.SimpleImputer("max")


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 7.0, "t"), (3.0, 7.0, "t"), (None, 7.0, "t")], "x double, k double, t string")
    done = scale.StandardScaler().fit_transform(df).collect()
    assert done[0]["x"] == pytest.approx(-1) and done[2]["x"] is None and done[0]["k"] == 0 and done[0]["t"] == "t"
    low = scale.MinMaxScaler().fit_transform(df).collect()
    assert (low[0]["x"], low[1]["x"], low[0]["k"]) == (0, pytest.approx(1), 0)


def test_encoders(spark):
    train = spark.createDataFrame([("b",), ("a",), ("c",), ("",), (None,)], "t string")
    new = spark.createDataFrame([("d",), (None,), ("c",)], "t string")
    encoder = encode.LabelEncoder().fit(train, "t")
    assert encoder.categories == ["a", "b", "c"]
    assert [r["t"] for r in encoder.transform(new, "t").collect()] == [-1, -1, 2]
    assert [r["t"] for r in encode.Encoding("ordinal", ["c", "a"]).fit(train, "t").transform(new, "t").collect()] == [-1, -1, 0]
    hot = encode.Encoding("nominal").fit(train, "t").transform(new, "t")
    assert [tuple(r)[1:] for r in hot.collect()] == [(0, 0, 0), (0, 0, 0), (0, 0, 1)]
    with pytest.raises(ValueError, match="ordinal"):
        encode.Encoding("other")
    with pytest.raises(ValueError, match="'t'"):
        encode.OneHotEncoder(max_width=2).fit(train, "t")


def test_many_categories_join(spark, monkeypatch):
    monkeypatch.setattr(encode, "LITERAL_CATEGORIES", 5)
    monkeypatch.setattr(encode, "SORTED_IN_ONE_TASK", 10)
    names = [f"n{i:03d}" for i in range(200)]
    df = spark.createDataFrame([(n,) for n in names[::-1]] + [(None,)], "t string").repartition(4)
    got = encode.LabelEncoder().fit_transform(df, "t", "code").collect()
    assert {r["t"]: r["code"] for r in got} == {None: -1, **{n: i for i, n in enumerate(names)}}


def test_prepare(spark):
    rows = [(1.0, "m", "s", True), (None, "f", "m", False), (5.0, "f", "l", True), (6.0, None, "l", True)]
    df = spark.createDataFrame(rows, "x double, two string, three string, b boolean")
    fitted = prepare.Preprocessor().fit(df, ["x", "two", "three", "b"])
    assert fitted.feature_names == ["x", "two", "three_l", "three_m", "three_s", "b"]
    done = np.array([list(r) for r in fitted.transform(df).collect()])
    np.testing.assert_allclose(done.mean(axis=0), 0, atol=1e-9)
    np.testing.assert_allclose(done.std(axis=0), 1, atol=1e-6)
    raw = prepare.Preprocessor(scaler=None).fit_transform(df, ["x", "two", "three", "b"]).collect()
    assert [list(r) for r in raw] == [[1, 1, 0, 0, 1, 1], [4, 0, 0, 1, 0, 0], [5, 0, 1, 0, 0, 1], [6, 0, 1, 0, 0, 1]]
    new = spark.createDataFrame([(None, "x", "zz", None)], df.schema)
    plain = prepare.Preprocessor(scaler=None).fit(df, ["x", "two", "three"])
    assert list(plain.transform(new).first()) == [4, -1, 0, 0, 0]
    codes = prepare.Preprocessor(scaler=None, encoding="ordinal").fit_transform(df, ["three"]).collect()
    assert [r[0] for r in codes] == [2, 1, 0, 0]


@pytest.mark.parametrize("strategy", ["mean", "median", "mode"])
def test_scaler_statistics_of_filled_columns(spark, strategy):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(None if i % 4 == 0 else float(v),) for i, v in enumerate(rng.integers(0, 9, 80))], "x double")
    done = prepare.Preprocessor(imputer_strategy=strategy).fit_transform(df, ["x"])
    mean, std = done.agg(F.avg("x"), F.stddev_pop("x")).first()
    assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(1, abs=1e-6)


def test_prepare_rejects_wide_text(spark):
    df = spark.range(50).select(F.concat(F.lit("u"), "id").alias("t"))
    with pytest.raises(ValueError, match="'t'"):
        prepare.Preprocessor(max_width=10, wide="error").fit(df, ["t"])


def test_clean_target(spark):
    df = spark.createDataFrame([("yes",), ("no",), (None,), ("yes",)], "y string")
    done, encoder = prepare.clean_target(df, "y")
    assert sorted(r["y"] for r in done.collect()) == [0.0, 1.0, 1.0] and encoder.categories == ["no", "yes"]
    assert prepare.missing_targets(df, "y") == 1


@pytest.mark.parametrize("n, k, sizes", [(7, 3, [3, 2, 2]), (3, 5, [1, 1, 1]), (200, 7, [29, 29, 29, 29, 28, 28, 28])])
def test_fold_sizes(spark, n, k, sizes):
    done = split.kfold(spark.range(n), ["id"], k)
    counts = {r["fold"]: r["count"] for r in done.groupBy("fold").count().collect()}
    assert sorted(counts.values(), reverse=True) == sizes and sum(counts.values()) == n


def test_folds_do_not_depend_on_partitions(spark):
    a = split.kfold(spark.range(500).repartition(7), ["id"], 5).orderBy("id").collect()
    assert a == split.kfold(spark.range(500).coalesce(1), ["id"], 5).orderBy("id").collect()
    assert a != split.kfold(spark.range(500), ["id"], 5, seed=1).orderBy("id").collect()
    for train, test in split.get_splits(split.kfold(spark.range(11), ["id"], 3), 3):
        assert train.count() + test.count() == 11 and train.join(test, "id").count() == 0


def test_stratified(spark):
    df = spark.range(100).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    counts = split.stratified_kfold(df, ["id"], "y", 5).groupBy("y", "fold").count().collect()
    assert {(r["y"], r["fold"]): r["count"] for r in counts} == {(y, f): 2 if y else 18 for y in (0, 1) for f in range(5)}


def test_train_test(spark):
    train, test = split.train_test_split(spark.range(11), ["id"], 0.3)
    assert (train.count(), test.count()) == (7, 4) and train.join(test, "id").count() == 0
    train, test = split.train_test_split(spark.range(10), ["id"], 0.2, shuffle=False)
    assert sorted(r["id"] for r in test.collect()) == [8, 9]


def test_row_key_of_copies(spark):
    df = spark.createDataFrame([("a", 1)] * 40 + [("b", None)] * 3, "t string, n int")
    keyed = split.with_row_key(df, chunk=7)
    assert keyed.count() == 43 and keyed.select("row_id").distinct().count() == 43
    again = split.with_row_key(df.repartition(3), chunk=7)
    assert {r["row_id"] for r in keyed.collect()} == {r["row_id"] for r in again.collect()}


def test_bootstrap(spark):
    done = split.bootstrap(spark.range(4000), ["id"], 3).cache()
    means = done.select(*[F.avg(F.col("weights")[t]).alias(str(t)) for t in range(3)]).first()
    assert all(abs(m - 1) < 0.06 for m in means)
    none = done.where("weights[0] = 0").count() / 4000
    assert abs(none - np.exp(-1)) < 0.03
    assert split.feature_subset(10, None, 42, 0) == split.feature_subset(10, None, 42, 0)
    assert len(split.feature_subset(10, None, 42, 1)) == 3


def test_matrix_equals_columns(spark):
    rows = [(float(i % 7), f"c{i % 12:02d}" if i % 5 else None, f"s{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "x double, wide string, few string")
    new = df.unionByName(spark.createDataFrame([(None, "zz", "zz")], df.schema))
    for options in ({}, {"scaler": None}, {"scale_encoded": False}):
        fitted = prepare.Preprocessor(**options).fit(df, ["x", "wide", "few"])
        assert len(fitted.feature_names) == 16
        columns = np.array([list(r) for r in fitted.transform(new).collect()])
        vectors = np.array([r["features"] for r in fitted.matrix(new).collect()])
        np.testing.assert_allclose(vectors, columns, rtol=1e-12)


def test_a_thousand_labels_are_cut_together(spark):
    df = spark.range(6_000).select("id", F.concat(F.lit("label"), (F.pow(F.rand(3), 3) * 1000).cast("int")).alias("y")).persist()
    df = df.unionByName(spark.range(6_000, 9_000).select("id", F.lit(None).cast("string").alias("y")))
    folds = split.stratified_kfold(df, ["id"], "y", 4)
    assert folds.count() == 9_000
    counts = folds.groupBy("y").agg(*[F.count_if(F.col("fold") == f).alias(f"f{f}") for f in range(4)]).collect()
    for r in counts:
        n = [r[f"f{f}"] for f in range(4)]
        assert n == [sum(n) // 4 + (f < sum(n) % 4) for f in range(4)]
    # narrowing by longer prefixes finds the same cuts
    deep = {r["group"]: r["cuts"] for r in split.group_cuts(df, ["id"], "y", 4, ranked=0).collect()}
    assert deep == {r["group"]: r["cuts"] for r in split.group_cuts(df, ["id"], "y", 4).collect()}
