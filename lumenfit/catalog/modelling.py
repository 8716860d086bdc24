"""Model families, metrics and cross-validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import metrics
from ..models.base import Matrix
from ..models.knn import MAX_CELLS, KNearestNeighbors
from ..models.linear import LinearRegression
from ..models.logistic import LogisticRegression
from ..models.naive_bayes import GaussianNB
from ..models.tree import DecisionTree, RandomForest
from ..operators.split import feature_subset, kfold
from ..plans.search import GridSearch, cross_validate, generate_combinations, mean_scores
from .common import draws_sql, embeddings, fold_sql, labelled_documents, rounded, table

ROW = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        *ROW, (F.col("l_quantity") / 50).alias("a"), (F.col("l_discount") * 10).alias("b"),
        (F.col("l_extendedprice") * (1 + F.col("l_quantity") / 50) / 100000).alias("y"))


LINES = """(select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_quantity / 50 as a,
    l_discount * 10 as b, l_extendedprice * (1 + l_quantity / 50) / 100000 as y from lineitem)"""

DESCENT = f"""with recursive s as (select avg(a * a) aa, avg(a * b) ab, avg(b * b) bb, avg(a) ma, avg(b) mb,
        avg(y) my, avg(a * y) ay, avg(b * y) byy from {LINES}),
    g(e, wa, wb, w0) as (select 0, 0.0::double, 0.0::double, 0.0::double union all
        select e + 1, wa - 0.2 * (wa * aa + wb * ab + w0 * ma - ay), wb - 0.2 * (wa * ab + wb * bb + w0 * mb - byy),
               w0 - 0.2 * (wa * ma + wb * mb + w0 - my) from g, s where e < 200),
    w as (select * from g where e = 200) """


def _linear(spark, sf):
    return LinearRegression(lr=0.1, epochs=200).fit(_lines(spark, sf), "y", ["a", "b"])


def linear_fit(spark, sf):
    model = _linear(spark, sf)
    rows = [("a", float(model.weights[0])), ("b", float(model.weights[1])), ("bias", model.bias)]
    return spark.createDataFrame(rows, "feature string, weight double").select("feature", rounded("weight").alias("weight"))


def linear_importance(spark, sf):
    return _linear(spark, sf).importance_table(spark).select("feature", rounded("importance").alias("importance"))


def linear_predict(spark, sf):
    return _linear(spark, sf).transform(_lines(spark, sf)).select(*ROW, rounded("prediction").alias("prediction"))


def linear_score(spark, sf):
    scored = _linear(spark, sf).transform(_lines(spark, sf))
    return scored.agg(rounded(metrics.r2_plain("y", "prediction")).alias("r2"))


def _docs(spark, sf):
    return labelled_documents(spark, sf).withColumns({"x": F.col("n_chars") / 1000, "weight": F.col("n_chars") % 7})


LOGISTIC = """with recursive d as (select doc_id, n_chars / 1000 as x, quality as y from documents join labels using (doc_id)),
    g(e, w, b) as (select 0, 0.0::double, 0.0::double union all
        select e + 1, w - 0.1 * (select avg((1 / (1 + exp(-(g.w * x + g.b))) - y) * x) from d),
               b - 0.1 * (select avg(1 / (1 + exp(-(g.w * x + g.b))) - y) from d) from g where e < 200),
    m as (select * from g where e = 200) """


def _logistic(spark, sf):
    return LogisticRegression(lr=0.1, epochs=200).fit(_docs(spark, sf), "quality", ["x"])


def logistic_fit(spark, sf):
    model = _logistic(spark, sf)
    rows = [("x", float(model.weights[0])), ("bias", model.bias)]
    return spark.createDataFrame(rows, "feature string, weight double").select("feature", rounded("weight").alias("weight"))


def logistic_predict(spark, sf):
    docs, model = _docs(spark, sf), _logistic(spark, sf)
    scored = model.transform(docs.withColumn("p", model.probability(docs)))
    return scored.select("doc_id", rounded("p").alias("p"), "prediction")


def logistic_score(spark, sf):
    """Accuracy of the fitted model on its rows."""
    docs = _docs(spark, sf)
    return docs.agg(F.lit(_logistic(spark, sf).score(docs, "quality")).alias("accuracy")).select(rounded("accuracy").alias("accuracy"))


def logistic_optimum(spark, sf):
    """The logistic optimum by L-BFGS, with a small penalty."""
    model = LogisticRegression(solver="lbfgs", l2=0.01, tolerance=1e-9).fit(_docs(spark, sf), "quality", ["x"])
    rows = [("x", float(model.weights[0])), ("bias", model.bias)]
    return spark.createDataFrame(rows, "feature string, weight double").select("feature", rounded("weight").alias("weight"))


# Newton steps on the same loss: the two-by-two system is solved in closed form.
OPTIMUM = """with recursive d as (select n_chars / 1000 as x, quality as y from documents join labels using (doc_id)),
    g(e, w, b) as (select 0, 0.0::double, 0.0::double union all
        select e + 1, w - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), b - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12) from (
            select e, w, b, avg((p - y) * x) + 0.01 * w as g1, avg(p - y) as g2, avg(p * (1 - p) * x * x) + 0.01 as h11, avg(p * (1 - p) * x) as h12, avg(p * (1 - p)) as h22
            from (select e, w, b, x, y, 1 / (1 + exp(-(w * x + b))) as p from g, d where e < 30) group by e, w, b)),
    m as (select * from g where e = 30) """


def nb_fit(spark, sf):
    found = GaussianNB().fit(embeddings(spark, sf)).to_table(spark)
    number = F.regexp_extract("feature", r"(\d+)$", 1).cast("int")
    return found.select("class", rounded("prior").alias("prior"), number.alias("j"),
                        rounded("mean", 8).alias("mean"), rounded("var", 8).alias("var"))


def nb_predict(spark, sf):
    vectors = embeddings(spark, sf)
    return GaussianNB().fit(vectors).transform(vectors).select("vec_id", "label", "prediction")


CELLS = """c as (select vec_id, label, unnest(embedding::double[]) as v, generate_subscripts(embedding, 1) as j
    from embeddings)"""


def _folded(spark, sf):
    return Matrix(kfold(embeddings(spark, sf), ["vec_id"], 5), ("vec_id",))


def nb_cross_validation(spark, sf):
    grid = [{"var_smoothing": 1e-9}, {"var_smoothing": 1e-3}]
    found = cross_validate(_folded(spark, sf), GaussianNB, grid, 5, [metrics.METRICS["accuracy"]])
    return found.select("config", "fold", "metric", rounded("value").alias("value"))


def nb_fold_means(spark, sf):
    grid = [{"var_smoothing": 1e-9}, {"var_smoothing": 1e-3}]
    found = cross_validate(_folded(spark, sf), GaussianNB, grid, 5, [metrics.METRICS["accuracy"]])
    return mean_scores(found).select("config", "metric", rounded("value").alias("value"))


NB_CV = f"""with f as (select vec_id, {fold_sql(5, 'vec_id')}::int as fold from embeddings), {CELLS},
    t as (select c.*, f.fold from c join f using (vec_id)),
    k as (select unnest([0, 1, 2, 3, 4]) as out),
    s as (select out, label, j, avg(v) m, var_pop(v) var, count(*) n from t join k on t.fold <> k.out group by all),
    pr as (select out, label, n / (sum(n) over (partition by out)) as prior from s where j = 1),
    cfg as (select * from (values (0, 1e-9), (1, 1e-3)) as x(config, eps)),
    sc as (select config, t.vec_id, t.fold, t.label as truth, s.label as class,
                  max(ln(prior)) + sum(-0.5 * ln(2 * pi() * (var + eps)) - (v - m) * (v - m) / (2 * (var + eps))) as score
           from t join s on s.out = t.fold and s.j = t.j join pr on pr.out = s.out and pr.label = s.label
           cross join cfg group by all),
    b as (select *, row_number() over (partition by config, vec_id order by score desc, class) rn from sc),
    r as (select config, fold, avg((truth = class)::int) as value from b where rn = 1 group by all) """


def grid_search(spark, sf):
    search = GridSearch(GaussianNB, {"var_smoothing": [1e-9, 1e-3]}, k=5).fit(_folded(spark, sf), refit=False)
    return search.leaderboard(spark).select(
        F.col("params")["var_smoothing"].cast("double").alias("var_smoothing"),
        rounded(F.col("scores")["accuracy"]).alias("accuracy"),
        (F.col("params")["var_smoothing"].cast("double") == F.lit(search.best_params["var_smoothing"])).alias("chosen"))


def grid_combinations(spark, sf):
    """Tree grids with their cross-validated accuracy: all settings read off one growth."""
    docs = kfold(_docs(spark, sf), ["doc_id"], 5)
    m = Matrix(docs, ("doc_id",), "quality", ["x", "toxic"])
    grid = generate_combinations({"max_depth": [1, 2], "min_samples_split": [2, 50]})
    found = mean_scores(cross_validate(m, DecisionTree, grid, 5, [metrics.METRICS["accuracy"]]))
    return found.select("config", rounded("value").alias("accuracy"))


def neighbours_found(spark, sf):
    vectors = embeddings(spark, sf)
    found = KNearestNeighbors(5).fit(vectors, keys=["vec_id"]).neighbours(vectors)
    return found.select("qid", "tid", rounded("dist").alias("dist"), "rank")


def knn_approximate(spark, sf):
    """Neighbours by inverted cells, every cell probed: the exact ones."""
    vectors = embeddings(spark, sf)
    found = KNearestNeighbors(5, approx=True, probes=MAX_CELLS).fit(vectors, keys=["vec_id"]).neighbours(vectors)
    return found.select("qid", "tid", rounded("dist").alias("dist"), "rank")


def knn_classify(spark, sf):
    vectors = embeddings(spark, sf)
    return KNearestNeighbors(3).fit(vectors, keys=["vec_id"]).transform(vectors).select("vec_id", "label", "prediction")


def knn_regress(spark, sf):
    vectors = embeddings(spark, sf)
    model = KNearestNeighbors(5, "manhattan", "regression").fit(vectors, keys=["vec_id"])
    return model.transform(vectors).select("vec_id", rounded("prediction").alias("prediction"))


def knn_cross_validation(spark, sf):
    found = cross_validate(_folded(spark, sf), KNearestNeighbors, [{"k": 3}, {"k": 5}], 5, [metrics.METRICS["accuracy"]])
    return found.select("config", "fold", "metric", rounded("value").alias("value"))


def _knn_sql(measure: str, select: str, folds: bool = False) -> str:
    where = "where fa.fold <> fb.fold" if folds else ""
    return f"""with f as (select vec_id, {fold_sql(5, 'vec_id')}::int as fold from embeddings), {CELLS},
    d as (select a.vec_id q, b.vec_id t, any_value(b.label) y, any_value(fa.fold) fold, any_value(a.label) truth, {measure} dist
          from c a join c b on a.j = b.j join f fa on fa.vec_id = a.vec_id join f fb on fb.vec_id = b.vec_id {where}
          group by a.vec_id, b.vec_id),
    n as (select *, row_number() over (partition by q order by dist, t) as rank from d) {select}"""


EUCLIDEAN, MANHATTAN = "sqrt(sum((a.v - b.v) * (a.v - b.v)))", "sum(abs(a.v - b.v))"


def _tree_columns(model, spark):
    return model.to_table(spark).select(
        "node_id", "feature", rounded("threshold", 4).alias("threshold"), F.col("n").cast("long").alias("n"),
        rounded("value", 4).alias("value"))


def tree_split(spark, sf):
    """The best single split of the line items' returned flag."""
    lines = table(spark, sf, "lineitem").select(
        "l_quantity", "l_discount", "l_tax", F.col("l_extendedprice").alias("price"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return _tree_columns(DecisionTree(1).fit(lines, "y", ["l_quantity", "l_discount", "l_tax", "price"]), spark)


def tree_classify(spark, sf):
    return _tree_columns(DecisionTree(3).fit(_docs(spark, sf), "quality", ["n_chars", "toxic"]), spark)


def tree_regress(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("y", F.col("l_extendedprice") / 100000)
    model = DecisionTree(3, task="regression").fit(lines, "y", ["l_quantity", "l_discount", "l_tax"])
    return _tree_columns(model, spark)


def _tree_sql(source: str, features: list[str], depth: int, classify: bool, want: str = "nodes", w: str = "1") -> str:
    """An exhaustive tree in SQL: every distinct value of every feature, level by level.

    ``want`` is "nodes", "importance" or the key column of the predictions; ``w`` says how often a row counts."""
    def mass(n, s, q):
        if classify:
            return f"({n} - (({s}) * ({s}) + ({n} - ({s})) * ({n} - ({s}))) / ({n}))"
        return f"greatest({q} - ({s}) * ({s}) / ({n}), 0)"
    parts = [f"d as materialized (select row_number() over () as id, * from {source})",
             "c as materialized (" + " union all ".join(
                 f"select id, {i} as f, {x}::double as v from d" for i, x in enumerate(features)) + ")",
             "r0 as materialized (select id, 1::bigint as node from d)"]
    for level in range(depth):
        left, right, whole = mass("ln", "ls", "lq"), mass("(n - ln)", "(s - ls)", "(q - lq)"), mass("n", "s", "q")
        parts.append(f"""p{level} as (select *, sum(cn) over w ln, sum(cs) over w ls, sum(cq) over w lq,
            sum(cn) over (partition by node, f) n, sum(cs) over (partition by node, f) s, sum(cq) over (partition by node, f) q
            from (select node, f, v, sum({w})::double cn, sum({w} * y)::double cs, sum({w} * y * y)::double cq
                  from r{level} join c using (id) join d using (id) group by all)
            window w as (partition by node, f order by v rows unbounded preceding))""")
        parts.append(f"""s{level} as materialized (select node, f, v, gain from (
            select node, f, v, {whole} - {left} - {right} as gain, round(({left} + {right}) / ({whole}), 12) as ratio,
                   row_number() over (partition by node order by round(({left} + {right}) / ({whole}), 12), f, v) rn
            from p{level} where n > ln and ln > 0 and {whole} > 1e-9 and n >= 2) where rn = 1 and ratio < 1)""")
        parts.append(f"""r{level + 1} as materialized (select id, node * 2 + (c.v > s{level}.v)::int as node
            from r{level} join s{level} using (node) join c using (id) where c.f = s{level}.f)""")
    names = "case f " + " ".join(f"when {i} then '{x}'" for i, x in enumerate(features)) + " end"
    value = f"(case when 2 * sum({w} * y) > sum({w}) then 1 else 0 end)::double" if classify else f"sum({w} * y) / sum({w})"
    rows = []
    if want in ("importance", "share"):
        gains = " union all ".join(f"select f, gain from s{level}" for level in range(depth))
        if want == "share":
            return "with " + ", ".join(parts) + f""", g as (select f, sum(gain) as g from ({gains}) group by f)
                select {names} as feature, g / (select sum(g) from g) as share from g"""
        return "with " + ", ".join(parts) + f""", g as (select f, sum(gain) as g from ({gains}) group by f),
            a as (select k.f, coalesce(g, 0) / (select sum(g) from g) as share
                  from (select unnest({list(range(len(features)))}) as f) k left join g on g.f = k.f)
            select {names} as feature, round(share / (1 + 1e-10), 6) + 0.0 as importance from a"""
    if want != "nodes":
        leaf = value.replace("::double", "::int")
        for level in range(depth + 1):
            stay = f"where node not in (select node from s{level})" if level < depth else ""
            rows.append(f"""select {want}, prediction from r{level} join d using (id) join (
                select node, {leaf} as prediction from r{level} join d using (id) group by node) using (node) {stay}""")
        return "with " + ", ".join(parts) + " " + " union all ".join(rows)
    for level in range(depth + 1):
        join = f"left join s{level} using (node)" if level < depth else ""
        pick = f"{names} as feature, round(s{level}.v, 4) + 0.0 as threshold" if level < depth else "null as feature, null::double as threshold"
        rows.append(f"""select node as node_id, {pick}, n, value from (select node, sum({w})::bigint as n, round({value}, 4) + 0.0 as value
            from r{level} join d using (id) group by node) {join}""")
    return "with " + ", ".join(parts) + " " + " union all ".join(rows)


def tree_predict(spark, sf):
    docs = _docs(spark, sf)
    model = DecisionTree(3).fit(docs, "quality", ["n_chars", "toxic"])
    return model.transform(docs).select("doc_id", "prediction")


def tree_importance(spark, sf):
    model = DecisionTree(3).fit(_docs(spark, sf), "quality", ["n_chars", "toxic"])
    return model.importance_table(spark).select("feature", rounded("importance").alias("importance"))


def _forest(spark, sf):
    return RandomForest().fit(_docs(spark, sf), "quality", FOREST_FEATURES, keys=["doc_id"])


def forest_fit(spark, sf):
    model = _forest(spark, sf)
    return model.to_table(spark).select("tree_id", "node_id", "feature", rounded("threshold", 4).alias("threshold"),
                                        F.col("n").cast("long").alias("n"), rounded("value", 4).alias("value"))


def forest_predict(spark, sf):
    return _forest(spark, sf).transform(_docs(spark, sf)).select("doc_id", "prediction")


def forest_importance(spark, sf):
    return _forest(spark, sf).importance_table(spark).select("feature", rounded("importance").alias("importance"))


def tree_binned(spark, sf):
    """A tree over buckets that hold every value: the exhaustive tree."""
    lines = table(spark, sf, "lineitem").withColumn("y", F.col("l_extendedprice") / 100000)
    model = DecisionTree(3, task="regression", solver="binned").fit(lines, "y", ["l_quantity", "l_discount", "l_tax"])
    return _tree_columns(model, spark)


FOREST_FEATURES = ["n_chars", "toxic", "weight"]


def _forest_sql(want: str) -> str:
    """All trees of the default forest, one after the other: seeded weights, seeded features, exhaustive splits."""
    parts = []
    for t in range(10):
        subset = [FOREST_FEATURES[i] for i in feature_subset(len(FOREST_FEATURES), None, 42, t)]
        source = f"(select doc_id, n_chars, toxic, n_chars % 7 as weight, quality as y, {draws_sql('doc_id', t)}::double as w from documents join labels using (doc_id))"
        parts.append(f"select {t} as tree_id, * from ({_tree_sql(source, subset, 5, True, want, 'w')})")
    return " union all ".join(parts)


def classification_metrics(spark, sf):
    y, p = F.col("quality"), F.col("toxic")
    return table(spark, sf, "labels").agg(
        rounded(metrics.accuracy(y, p)).alias("accuracy"), rounded(metrics.precision(y, p)).alias("precision"),
        rounded(metrics.recall(y, p)).alias("recall"), rounded(metrics.f1_score(y, p)).alias("f1"))


def regression_metrics(spark, sf):
    y, p = F.col("y"), F.col("a") + F.col("b") / 10
    return _lines(spark, sf).agg(
        rounded(metrics.mse(y, p)).alias("mse"), rounded(metrics.mae(y, p)).alias("mae"),
        rounded(metrics.rmse(y, p)).alias("rmse"), rounded(metrics.r2_score(y, p)).alias("r2"))


def confusion(spark, sf):
    return metrics.confusion_matrix(table(spark, sf, "labels"), "quality", "toxic").drop("matrix")


def confusion_pairs(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_linestatus").alias("s"))
    return metrics.confusion_table(lines, "l_returnflag", "s")


def weighted_metrics(spark, sf):
    pairs = table(spark, sf, "lineitem").select(
        (F.col("l_linenumber") % 5).alias("y"), (F.col("l_quantity").cast("int") % 6).alias("p"), "l_returnflag")
    found = metrics.weighted_scores(pairs, "y", "p", ["l_returnflag"])
    return found.select("l_returnflag", *[rounded(c).alias(c) for c in ("precision", "recall", "f1")])


QUERIES = {
    "linear_fit": linear_fit,
    "linear_importance": linear_importance,
    "linear_predict": linear_predict,
    "linear_score": linear_score,
    "logistic_fit": logistic_fit,
    "logistic_predict": logistic_predict,
    "logistic_score": logistic_score,
    "logistic_optimum": logistic_optimum,
    "gnb_fit": nb_fit,
    "gnb_predict": nb_predict,
    "gnb_cv": nb_cross_validation,
    "fold_means": nb_fold_means,
    "grid_search": grid_search,
    "grid_combinations": grid_combinations,
    "knn_neighbours": neighbours_found,
    "knn_approximate": knn_approximate,
    "knn_classify": knn_classify,
    "knn_regress": knn_regress,
    "knn_cv": knn_cross_validation,
    "tree_split": tree_split,
    "tree_classify": tree_classify,
    "tree_regress": tree_regress,
    "tree_predict": tree_predict,
    "tree_importance": tree_importance,
    "tree_binned": tree_binned,
    "forest_fit": forest_fit,
    "forest_predict": forest_predict,
    "forest_importance": forest_importance,
    "metrics_classification": classification_metrics,
    "metrics_regression": regression_metrics,
    "confusion_matrix": confusion,
    "confusion_table": confusion_pairs,
    "metrics_weighted": weighted_metrics,
}

ORACLES = {
    "linear_fit": DESCENT + """select 'a' as feature, round(wa, 6) + 0.0 as weight from w union all
        select 'b', round(wb, 6) + 0.0 from w union all select 'bias', round(w0, 6) + 0.0 from w""",
    "linear_importance": DESCENT + """select 'a' as feature, round(abs(wa) / (abs(wa) + abs(wb) + 1e-10), 6) + 0.0 as importance
        from w union all select 'b', round(abs(wb) / (abs(wa) + abs(wb) + 1e-10), 6) + 0.0 from w""",
    "linear_predict": DESCENT + f"""select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
        round(wa * a + wb * b + w0, 6) + 0.0 as prediction from {LINES}, w""",
    "linear_score": DESCENT + f"""select round(1 - sum(power(y - (wa * a + wb * b + w0), 2)) / (var_pop(y) * count(*)), 6) + 0.0 as r2
        from {LINES}, w""",
    "logistic_fit": LOGISTIC + """select 'x' as feature, round(w, 6) + 0.0 as weight from m union all
        select 'bias', round(b, 6) + 0.0 from m""",
    "logistic_predict": LOGISTIC + """select doc_id, round(1 / (1 + exp(-(w * x + b))), 6) + 0.0 as p,
        (1 / (1 + exp(-(w * x + b))) >= 0.5)::int as prediction from d, m""",
    "logistic_score": LOGISTIC + """select round(avg(((1 / (1 + exp(-(w * x + b))) >= 0.5)::int = y)::int), 6) + 0.0 as accuracy from d, m""",
    "logistic_optimum": OPTIMUM + """select 'x' as feature, round(w, 6) + 0.0 as weight from m union all
        select 'bias', round(b, 6) + 0.0 from m""",
    "gnb_fit": f"""with {CELLS} select label as class, round((select count(*) from embeddings e where e.label = c.label)
        / (select count(*) from embeddings), 6) + 0.0 as prior, (j - 1)::int as j, round(avg(v), 8) + 0.0 as mean,
        round(var_pop(v) + 1e-9, 8) + 0.0 as var from c group by label, j""",
    "gnb_predict": f"""with {CELLS}, s as (select label, j, avg(v) m, var_pop(v) + 1e-9 var, count(*) n from c group by all),
        sc as (select c.vec_id, c.label, s.label as class, max(ln(n / (select count(*) from embeddings)))
                      + sum(-0.5 * ln(2 * pi() * var) - (v - m) * (v - m) / (2 * var)) as score
               from c join s on s.j = c.j group by all)
        select vec_id, label, class as prediction from (
            select *, row_number() over (partition by vec_id order by score desc, class) rn from sc) where rn = 1""",
    "gnb_cv": NB_CV + "select config, fold, 'accuracy' as metric, round(value, 6) + 0.0 as value from r",
    "fold_means": NB_CV + "select config, 'accuracy' as metric, round(avg(value), 6) + 0.0 as value from r group by config",
    "grid_search": NB_CV + """, a as (select config, avg(value) v from r group by config)
        select case config when 0 then 1e-9 else 1e-3 end::double as var_smoothing, round(v, 6) + 0.0 as accuracy,
               config = (select config from a order by round(v, 12) desc, config limit 1) as chosen from a""",
    "knn_neighbours": _knn_sql(EUCLIDEAN, "select q as qid, t as tid, round(dist, 6) + 0.0 as dist, rank from n where rank <= 5"),
    "knn_approximate": _knn_sql(EUCLIDEAN, "select q as qid, t as tid, round(dist, 6) + 0.0 as dist, rank from n where rank <= 5"),
    "knn_classify": _knn_sql(EUCLIDEAN, """, v as (select q, truth, y, row_number() over (partition by q order by count(*) desc, y) r
        from n where rank <= 3 group by q, truth, y) select q as vec_id, truth as label, y as prediction from v where r = 1"""),
    "knn_regress": _knn_sql(MANHATTAN, "select q as vec_id, round(avg(y), 6) + 0.0 as prediction from n where rank <= 5 group by q"),
    "knn_cv": _knn_sql(EUCLIDEAN, """, k as (select * from (values (0, 3), (1, 5)) as x(config, k)),
        v as (select config, q, truth, fold, y, row_number() over (partition by config, q order by count(*) desc, y) r
              from n join k on rank <= k.k group by config, q, truth, fold, y)
        select config, fold, 'accuracy' as metric, round(avg((truth = y)::int), 6) + 0.0 as value
        from v where r = 1 group by config, fold""", folds=True),
    "tree_split": _tree_sql("""(select l_quantity, l_discount, l_tax, l_extendedprice as price,
        (l_returnflag = 'R')::int as y from lineitem)""", ["l_quantity", "l_discount", "l_tax", "price"], 1, True),
    "tree_classify": _tree_sql("(select n_chars, toxic, quality as y from documents join labels using (doc_id))",
                               ["n_chars", "toxic"], 3, True),
    "tree_regress": _tree_sql("(select *, l_extendedprice / 100000 as y from lineitem)",
                              ["l_quantity", "l_discount", "l_tax"], 3, False),
    "tree_predict": _tree_sql("(select doc_id, n_chars, toxic, quality as y from documents join labels using (doc_id))",
                              ["n_chars", "toxic"], 3, True, "doc_id"),
    "tree_importance": _tree_sql("(select n_chars, toxic, quality as y from documents join labels using (doc_id))",
                                 ["n_chars", "toxic"], 3, True, "importance"),
    "tree_binned": _tree_sql("(select *, l_extendedprice / 100000 as y from lineitem)",
                             ["l_quantity", "l_discount", "l_tax"], 3, False),
    "forest_fit": _forest_sql("nodes"),
    "forest_predict": f"""with v as (select doc_id, prediction, count(*) as n from ({_forest_sql("doc_id")}) group by doc_id, prediction)
        select doc_id, prediction from (select *, row_number() over (partition by doc_id order by n desc, prediction) as rn from v) where rn = 1""",
    "forest_importance": f"""with g as (select feature, sum(share) as s from ({_forest_sql("share")}) group by feature),
        a as (select f as feature, coalesce(s, 0) as s from (select unnest({FOREST_FEATURES}) as f) left join g on g.feature = f)
        select feature, round(s / (select sum(s) from a) / (1 + 1e-10), 6) + 0.0 as importance from a""",
    "metrics_classification": """with c as (select count(*) filter (quality = 1 and toxic = 1)::double tp,
            count(*) filter (quality = 0 and toxic = 1) fp, count(*) filter (quality = 1 and toxic = 0) fn,
            avg((quality = toxic)::int) acc from labels),
        p as (select acc, tp / (tp + fp + 1e-8) p, tp / (tp + fn + 1e-8) r from c)
        select round(acc, 6) + 0.0 as accuracy, round(p, 6) + 0.0 as precision, round(r, 6) + 0.0 as recall,
               round(2 * p * r / (p + r + 1e-8), 6) + 0.0 as f1 from p""",
    "metrics_regression": f"""with t as (select y, a + b / 10 as p from {LINES})
        select round(avg((y - p) * (y - p)), 6) + 0.0 as mse, round(avg(abs(y - p)), 6) + 0.0 as mae,
               round(sqrt(avg((y - p) * (y - p))), 6) + 0.0 as rmse,
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*) + 1e-8), 6) + 0.0 as r2 from t""",
    "confusion_matrix": """select count(*) filter (quality = 0 and toxic = 0) as tn, count(*) filter (quality = 0 and toxic = 1) as fp,
        count(*) filter (quality = 1 and toxic = 0) as fn, count(*) filter (quality = 1 and toxic = 1) as tp from labels""",
    "confusion_table": "select l_returnflag as truth, l_linestatus as predicted, count(*) as n from lineitem group by all",
    "metrics_weighted": """with t as (select l_returnflag, l_linenumber % 5 as y, l_quantity::int % 6 as p from lineitem),
        k as (select l_returnflag, c, count(*) filter (y = c) support, count(*) filter (p = c) guessed,
                     count(*) filter (y = c and p = c) hits from t, (select unnest([0, 1, 2, 3, 4, 5]) as c) group by all)
        select l_returnflag,
               round(sum(support * case when guessed > 0 then hits / guessed else 0 end) / sum(support), 6) + 0.0 as precision,
               round(sum(support * case when support > 0 then hits / support else 0 end) / sum(support), 6) + 0.0 as recall,
               round(sum(support * case when support + guessed > 0 then 2 * hits / (support + guessed) else 0 end) / sum(support), 6) + 0.0 as f1
        from k group by l_returnflag""",
}
