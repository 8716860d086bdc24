"""Sources, imputation, scaling, encoding, preparation and splits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import encode, impute, prepare, scale, split, typing
from ..operators.sparse import SparseOneHot
from ..session import shared_folder
from ..sources.tables import read_csv
from .common import draws_sql, fold_sql, labelled_documents, rounded, table


def csv_scan(spark, sf):
    """Documents' descriptions with quotes and commas, through CSV and back, typed again."""
    source = table(spark, sf, "documents").select(
        "doc_id", F.concat(F.col("lang"), F.lit(', "'), F.col("source"), F.lit('"')).alias("note"), "n_chars")
    path = f"{shared_folder(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    source.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    back = read_csv(spark, path, "n_chars")
    return typing.typed(back, typing.detect_column_types(back))


def _with_holes(spark, sf):
    """Line items with deterministic holes in numbers and text."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        F.nullif("l_quantity", F.lit(25.0)).alias("quantity"),
        F.when(F.col("l_discount") != 0.05, F.col("l_discount")).alias("discount"),
        F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).otherwise(F.lit("")).alias("flag"))


HOLES = """(select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
    nullif(l_quantity, 25.0) as quantity, case when l_discount <> 0.05 then l_discount end as discount,
    case when l_returnflag <> 'A' then l_returnflag end as flag from lineitem)"""


def imputed(strategy: str):
    def run(spark, sf):
        columns = ["quantity", "discount", "flag"]
        done = impute.SimpleImputer(strategy).fit_transform(_with_holes(spark, sf), columns)
        return done.withColumns({c: rounded(c) for c in ("quantity", "discount")})
    return run


def _impute_sql(number) -> str:
    common = lambda c: f"(select {c} from {HOLES} where {c} is not null group by {c} order by count(*) desc, {c} limit 1)"
    fill = lambda c: number(c) if number else common(c)
    return f"""select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
        round(coalesce(quantity, {fill('quantity')}), 6) + 0.0 as quantity,
        round(coalesce(discount, {fill('discount')}), 6) + 0.0 as discount,
        coalesce(flag, {common('flag')}) as flag from {HOLES}"""


def impute_labels(spark, sf):
    """Labels that most documents lack, filled with their mean."""
    joined = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    done = impute.SimpleImputer("mean").fit_transform(joined, ["quality", "toxic"])
    return done.select("doc_id", rounded("quality").alias("quality"), rounded("toxic").alias("toxic"))


def scaled(maker):
    def run(spark, sf):
        lines = table(spark, sf, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_tax")
        price = lines.withColumn("price", F.col("l_extendedprice"))
        done = maker().fit(price, ["price", "l_quantity", "l_tax"]).transform(price)
        return done.withColumns({c: rounded(c) for c in ("price", "l_quantity", "l_tax")})
    return run


def _scale_sql(low: str, width: str) -> str:
    cell = lambda c, name: (f"round(({c} - (select {low.format(c)} from lineitem)) / "
                            f"((select {width.format(c)} from lineitem) + 1e-8), 6) + 0.0 as {name}")
    return f"""select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
        {cell('l_extendedprice', 'price')}, {cell('l_quantity', 'l_quantity')}, {cell('l_tax', 'l_tax')} from lineitem"""


def label_encoded(spark, sf):
    return encode.LabelEncoder().fit_transform(
        table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "code")


def label_encoded_many(spark, sf):
    """Every customer name is a category of its own: codes by a joined table."""
    return encode.LabelEncoder().fit_transform(
        table(spark, sf, "customer").select("c_custkey", "c_name"), "c_name", "code")


ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH"]


def ordinal_encoded(spark, sf):
    encoder = encode.Encoding("ordinal", ORDER)
    return encoder.fit_transform(
        table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "code")


def onehot_encoded(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("MACHINERY")).alias("c_mktsegment"))
    return encode.Encoding("nominal").fit_transform(customers, "c_mktsegment")


def prepared(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") < "3", "fast").otherwise("slow").alias("speed"))
    fitted = prepare.Preprocessor().fit(orders, ["o_orderstatus", "price", "speed"])
    done = fitted.transform(orders, ["o_orderkey"])
    return done.select("o_orderkey", *[rounded(F.col(f"`{c}`")).alias(c) for c in fitted.feature_names])


def _noted(spark, sf):
    """Labelled documents with a note that is blank, "NaN" or the language."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf, "labels"), "doc_id", "left")
    return docs.withColumn("note", F.when(F.col("doc_id") % 5 == 0, "  ").when(F.col("doc_id") % 7 == 0, "NaN").otherwise(F.col("lang")))


def missing_cleaned(spark, sf):
    """Every kind of missing cell as null."""
    return typing.handle_missing(_noted(spark, sf)).select("doc_id", "note", "quality")


def present_rows(spark, sf):
    """Rows with a note and a label, of the longer half of a range of lengths."""
    found = typing.present(_noted(spark, sf), "note", "quality")
    return typing.where(found, F.col("n_chars") > 1000).select("doc_id", "note", "quality")


def target_split(spark, sf):
    """Features and target apart, each with its sums."""
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax")
    features, target = typing.split_target(lines, "l_tax")
    total = lambda df, name: df.agg(F.lit(name).alias("part"), F.lit(",".join(df.columns)).alias("columns"), F.count(F.lit(1)).alias("n"),
                                    rounded(sum((F.sum(c) for c in df.columns), F.lit(0.0)), 2).alias("total"))
    return total(features, "features").unionByName(total(target, "target"))


def target_cast(spark, sf):
    """Text labels as whole numbers for classes, as doubles for regression."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.substring("o_orderpriority", 1, 1).alias("rank"), F.col("o_totalprice").cast("string").alias("price"))
    return typing.cast_target(typing.cast_target(orders, "rank", "classification"), "price", "regression")


def inputs_validated(spark, sf):
    """Whether tables are fit for training: the target is there and all vectors have one length."""
    vectors = table(spark, sf, "embeddings")
    ragged = vectors.withColumn("embedding", F.when(F.col("vec_id") == 7, F.slice("embedding", 1, 3)).otherwise(F.col("embedding")))
    rows = []
    for name, df, features, target in (("vectors", vectors, "embedding", "label"), ("ragged", ragged, "embedding", "label"), ("no target", vectors, "embedding", "price"), ("target of vectors", vectors, ["vec_id"], "embedding")):
        try:
            typing.validate_input(df, features, target)
            rows.append((name, True))
        except ValueError:
            rows.append((name, False))
    return spark.createDataFrame(rows, "input string, fit boolean")


def prepared_wide(spark, sf):
    """Names of customers as standardised indicators, a category per customer: the hot place of each row, its value there, and
    the value of all other rows."""
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    fitted = prepare.Preprocessor(max_width=100).fit(customers, ["c_name", "c_acctbal"])
    pairs = fitted.pairs(customers, "c_name", ["c_custkey"])
    base = fitted.sparse["c_name"].base(spark).withColumnRenamed("value", "off")
    return pairs.join(base, "index").select("c_custkey", "index", rounded("value").alias("value"), rounded("off").alias("off"))


def category_moments(spark, sf):
    """Rows and sums of measures per category: the products of sparse indicators with other columns."""
    orders = table(spark, sf, "orders").select("o_custkey", F.col("o_custkey").cast("string").alias("customer"), "o_totalprice")
    named = orders.withColumn("customer", F.concat(F.lit("c"), "customer"))
    fitted = SparseOneHot("customer").fit(named)
    return fitted.moments(named, ["o_totalprice"]).select("index", "n", rounded("sum_o_totalprice", 2).alias("total"))


PREPARED_SQL = """
    with t as (select o_orderkey, (o_orderstatus = 'F')::int as f, (o_orderstatus = 'O')::int as o,
                      (o_orderstatus = 'P')::int as p,
                      case when o_totalprice > 100000 then o_totalprice end as raw,
                      (o_orderpriority >= '3')::int as speed from orders),
    i as (select *, coalesce(raw, (select avg(raw) from t)) as price from t),
    s as (select avg(f) mf, stddev_pop(f) sf, avg(o) mo, stddev_pop(o) so, avg(p) mp, stddev_pop(p) sp,
                 avg(price) mx, stddev_pop(price) sx, avg(speed) ms, stddev_pop(speed) ss from i)
    select o_orderkey, round((f - mf) / (sf + 1e-8), 6) + 0.0 as "o_orderstatus_F",
           round((o - mo) / (so + 1e-8), 6) + 0.0 as "o_orderstatus_O",
           round((p - mp) / (sp + 1e-8), 6) + 0.0 as "o_orderstatus_P",
           round((price - mx) / (sx + 1e-8), 6) + 0.0 as price,
           round((speed - ms) / (ss + 1e-8), 6) + 0.0 as speed
    from i, s"""


def cleaned_target(spark, sf):
    done, _ = prepare.clean_target(
        table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("target")),
        "target")
    return done


def train_test(spark, sf):
    return split.train_test_mark(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


def train_test_in_order(spark, sf):
    return split.train_test_mark(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], shuffle=False)


def folds(spark, sf):
    return split.kfold(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 7)


def fold_splits(spark, sf):
    """Training and test sizes of every split."""
    marked = split.kfold(labelled_documents(spark, sf), ["doc_id"], 5)
    parts = [
        train.agg(F.lit(f).alias("fold"), F.count(F.lit(1)).alias("train_rows")).join(
            test.agg(F.lit(f).alias("fold"), F.count(F.lit(1)).alias("test_rows")), "fold")
        for f, (train, test) in enumerate(split.get_splits(marked, 5))
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def stratified_folds(spark, sf):
    return split.stratified_kfold(
        labelled_documents(spark, sf).select("doc_id", "quality"), ["doc_id"], "quality", 5)


def bootstrap_counts(spark, sf):
    """How often rows are drawn, per tree."""
    drawn = split.bootstrap(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 5)
    cells = drawn.select(F.posexplode("weights").alias("tree", "draws"))
    return cells.groupBy("tree", "draws").agg(F.count(F.lit(1)).alias("n"))


BOOTSTRAP_SQL = " union all ".join(
    f"select {t}::int as tree, draws::int as draws, count(*) as n from (select {draws_sql('o_orderkey', t)} as draws from orders) group by draws" for t in range(5))

QUERIES = {
    "csv_scan": csv_scan,
    "impute_mean": imputed("mean"),
    "impute_median": imputed("median"),
    "impute_mode": imputed("mode"),
    "impute_labels": impute_labels,
    "standard_scale": scaled(scale.StandardScaler),
    "minmax_scale": scaled(scale.MinMaxScaler),
    "label_encode": label_encoded,
    "label_encode_many": label_encoded_many,
    "ordinal_encode": ordinal_encoded,
    "onehot_encode": onehot_encoded,
    "prepare_table": prepared,
    "handle_missing": missing_cleaned,
    "present_rows": present_rows,
    "split_target": target_split,
    "cast_target": target_cast,
    "validate_input": inputs_validated,
    "prepare_onehot_wide": prepared_wide,
    "category_moments": category_moments,
    "clean_target": cleaned_target,
    "train_test_split": train_test,
    "train_test_in_order": train_test_in_order,
    "kfold": folds,
    "kfold_splits": fold_splits,
    "stratified_kfold": stratified_folds,
    "bootstrap": bootstrap_counts,
}

ORACLES = {
    "csv_scan": """select doc_id::double as doc_id, lang || ', "' || source || '"' as note,
        n_chars::double as n_chars from documents""",
    "impute_mean": _impute_sql(lambda c: f"(select avg({c}) from {HOLES})"),
    "impute_median": _impute_sql(lambda c: f"(select median({c}) from {HOLES})"),
    "impute_mode": _impute_sql(None),
    "impute_labels": """select doc_id, round(coalesce(quality, (select avg(quality) from labels)), 6) + 0.0 as quality,
        round(coalesce(toxic, (select avg(toxic) from labels)), 6) + 0.0 as toxic
        from documents left join labels using (doc_id)""",
    "standard_scale": _scale_sql("avg({0})", "stddev_pop({0})"),
    "minmax_scale": _scale_sql("min({0})", "max({0}) - min({0})"),
    "label_encode": """select c_custkey, c_mktsegment,
        (dense_rank() over (order by c_mktsegment) - 1)::int as code from customer""",
    "label_encode_many": """select c_custkey, c_name,
        (dense_rank() over (order by c_name) - 1)::bigint as code from customer""",
    "ordinal_encode": "select o_orderkey, o_orderpriority, (case o_orderpriority "
    + " ".join(f"when '{c}' then {i}" for i, c in enumerate(ORDER)) + " else -1 end)::int as code from orders",
    "onehot_encode": "select c_custkey, nullif(c_mktsegment, 'MACHINERY') as c_mktsegment, " + ", ".join(
        f"(c_mktsegment = '{c}')::int as \"c_mktsegment_{c}\"" for c in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD")
    ) + " from customer",
    "prepare_table": PREPARED_SQL,
    "handle_missing": """select doc_id, case when doc_id % 5 <> 0 and doc_id % 7 <> 0 then lang end as note, quality from documents left join labels using (doc_id)""",
    "present_rows": """select doc_id, lang as note, quality from documents join labels using (doc_id)
        where doc_id % 5 <> 0 and doc_id % 7 <> 0 and lang is not null and quality is not null and n_chars > 1000""",
    "split_target": """select 'features' as part, 'l_quantity,l_discount' as columns, count(*) as n, round(sum(l_quantity) + sum(l_discount), 2) + 0.0 as total from lineitem
        union all select 'target', 'l_tax', count(*), round(sum(l_tax), 2) + 0.0 from lineitem""",
    "cast_target": "select o_orderkey, substr(o_orderpriority, 1, 1)::int as rank, o_totalprice::double as price from orders",
    "validate_input": """with v as (select min(len(embedding)) = max(len(embedding)) as same, min(case when vec_id = 7 then 3 else len(embedding) end) = max(len(embedding)) as ragged from embeddings),
        c as (select count(*) filter (column_name = 'price') > 0 as has from (describe embeddings))
        select 'vectors' as input, same as fit from v union all select 'ragged', ragged from v union all select 'no target', has from c
        union all select 'target of vectors', column_type not like '%[%' from (describe embeddings) where column_name = 'embedding'""",
    "prepare_onehot_wide": """with c as (select c_name, count(*) as n, row_number() over (order by c_name) - 1 as index from customer group by c_name),
        p as (select c_name, index, n / (select count(*) from customer) as p from c), s as (select *, sqrt(p * (1 - p)) + 1e-8 as s from p)
        select c_custkey, index, round((1 - p) / s, 6) + 0.0 as value, round((0 - p) / s, 6) + 0.0 as off from customer join s using (c_name)""",
    "category_moments": """select dense_rank() over (order by 'c' || o_custkey::varchar) - 1 as index, count(*) as n, round(sum(o_totalprice), 2) + 0.0 as total
        from orders group by o_custkey""",
    "bootstrap": BOOTSTRAP_SQL,
    "clean_target": """select o_orderkey, (dense_rank() over (order by o_orderpriority) - 1)::double as target
        from orders where o_orderpriority <> '5-LOW'""",
    "train_test_split": """select o_orderkey,
        row_number() over (order by md5(concat_ws(':', '42', o_orderkey::varchar)))
          <= (select floor(count(*) * 0.8) from orders) as is_train from orders""",
    "train_test_in_order": """select o_orderkey, row_number() over (order by o_orderkey)
          <= (select floor(count(*) * 0.8) from orders) as is_train from orders""",
    "kfold": f"select o_orderkey, {fold_sql(7, 'o_orderkey')}::int as fold from orders",
    "kfold_splits": f"""with f as (select {fold_sql(5, 'doc_id')}::int as fold from documents join labels using (doc_id))
        select g.fold, (select count(*) from f) - count(*) as train_rows, count(*) as test_rows from f g group by g.fold""",
    "stratified_kfold": f"""select doc_id, quality, {fold_sql(5, 'doc_id', 'quality')}::int as fold
        from documents join labels using (doc_id)""",
}
