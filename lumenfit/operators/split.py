"""Seeded, reproducible splits.

Rows are ordered by ``md5(seed:key)``. A split needs only the hash values at its cut ranks, so
instead of sorting or numbering the table we find those few order statistics: count rows per hash
prefix (65,536 prefixes, merged on the map side), then look inside the prefixes that contain a
cut. Membership is then a plain comparison of each row's hash with literal cuts: no shuffle of
the table, no one-partition window, the same answer however the data is partitioned.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import durable

PREFIX = 4  # hex digits: 65,536 prefixes


def row_hash(keys: list[str], seed: int) -> Column:
    """``md5(seed:key)``; the cells of a composite key are escaped, so different keys stay different."""
    cells = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    if len(keys) > 1:
        escaped = [F.replace(F.replace(F.col(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\:")) for k in keys]
        cells = [F.coalesce(c, F.lit("\\0")) for c in escaped]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *cells))


# Rows that one task makes of counted pieces, about.
ROWS_PER_PIECE = 500_000


def with_row_key(df: DataFrame, name: str = "row_id", chunk: int = 1_000_000) -> DataFrame:
    """Add a stable key to a table without one: content hash plus occurrence number.

    Copies of a row are interchangeable, so they are counted (merged on the map side) and then
    numbered; a row copied very often is numbered in chunks by many tasks.
    """
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in df.columns]
    rows = df.count()
    counted = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    pieces = counted.withColumn(
        "_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1,
                                       F.lit(chunk).cast("long")))
    ).withColumn("_hash", F.md5(F.concat_ws("\1", *cells)))
    # A piece is a few bytes and becomes ``chunk`` rows, so the number of tasks follows from the rows and not from the bytes.
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_PIECE))
    pieces = pieces.repartition(tasks, "_hash", "_start")
    last = F.least(F.col("_start") + chunk, F.col("_n")) - 1
    copies = pieces.withColumn("_copy", F.explode(F.sequence(F.col("_start"), last)))
    key = F.concat_ws("#", "_hash", F.col("_copy").cast("string"))
    return copies.select(key.alias(name), *[F.col(f"`{c}`") for c in df.columns])


def hash_cuts(df: DataFrame, keys: list[str], seed: int, ranks) -> tuple[int, list[str]]:
    """The number of rows, and the hash value of the row at each wanted 0-based rank; ``ranks(n)`` lists them for n rows."""
    prefix = F.substring(row_hash(keys, seed), 1, PREFIX).alias("p")
    counts = sorted((r["p"], r["n"]) for r in df.groupBy(prefix).agg(F.count(F.lit(1)).alias("n")).collect())
    n, seen, wanted = sum(c for _, c in counts), 0, {}
    targets = sorted(set(ranks(n)))
    for p, c in counts:
        for rank in targets:
            if seen <= rank < seen + c:
                wanted.setdefault(p, []).append((rank, rank - seen + 1))
        seen += c
    found = _pick(df, keys, seed, wanted)
    return n, [found[rank] for rank in ranks(n)]


def _pick(df, keys, seed, wanted) -> dict:
    """The hashes at the wanted positions inside the prefixes that contain a cut."""
    if not wanted:
        return {}
    hashed = df.select(row_hash(keys, seed).alias("h")).withColumn("p", F.substring("h", 1, PREFIX))
    hashed = hashed.where(F.col("p").isin(sorted(wanted)))
    # keys should be unique; copies of one key are merged before they meet in a task
    counted = hashed.groupBy("p", "h").agg(F.count(F.lit(1)).alias("n"))
    order = W.partitionBy("p").orderBy("h").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = counted.withColumn("upto", F.sum("n").over(order))
    places = sorted({position for hits in wanted.values() for _, position in hits})
    hit = F.exists(F.lit(places), lambda p: (p <= F.col("upto")) & (p > F.col("upto") - F.col("n")))
    picked: dict = {}
    for r in running.where(hit).collect():
        picked.setdefault(r["p"], []).append((r["upto"], r["h"]))
    return {rank: next(h for upto, h in sorted(picked[p]) if upto >= position) for p, hits in wanted.items() for rank, position in hits}


def _fold_ranks(k: int):
    """Last rank of every fold but the final one; the first ``n % k`` folds get one row more."""
    def ranks(n: int) -> list[int]:
        size, extra = divmod(n, k)
        ends = [(f + 1) * size + min(f + 1, extra) - 1 for f in range(k - 1)]
        return [e for e in ends if 0 <= e < n - 1]
    return ranks


def _fold_column(h: Column, cuts: list[str]) -> Column:
    fold = F.lit(len(cuts))
    for f in reversed(range(len(cuts))):
        fold = F.when(h <= F.lit(cuts[f]), F.lit(f)).otherwise(fold)
    return fold.cast("int")


def kfold(df: DataFrame, keys: list[str], k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add the fold number 0..k-1. Folds are disjoint, complete and differ by at most one row."""
    if k < 2:
        raise ValueError("k must be at least 2")
    _, cuts = hash_cuts(df, keys, seed, _fold_ranks(k))
    return df.withColumn(name, _fold_column(row_hash(keys, seed), cuts))


def stratified_kfold(
    df: DataFrame, keys: list[str], label: str, k: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Folds that are exact within every class."""
    if k < 2:
        raise ValueError("k must be at least 2")
    cuts = group_cuts(df, keys, label, k, seed).withColumnRenamed("group", "_group")
    cuts = F.broadcast(cuts) if cuts.count() * (k - 1) <= BROADCAST_CUTS else cuts
    joined = df.withColumn("_h", row_hash(keys, seed)).join(cuts, F.col(f"`{label}`").eqNullSafe(F.col("_group")), "left")
    fold = F.size(F.filter(F.coalesce("cuts", F.array().cast("array<string>")), lambda c: c < F.col("_h"))).cast("int")
    return joined.withColumn(name, fold).drop("_h", "_group", "cuts")


# Cut hashes that may be broadcast, and rows of one label that are ranked by a window.
BROADCAST_CUTS = 1_000_000
RANKED = 10_000


def group_cuts(df: DataFrame, keys: list[str], label: str, k: int, seed: int = 42, ranked: int = RANKED) -> DataFrame:
    """``(group, cuts)``: for each label the last hash of every fold but the final one, in order.

    All labels are cut together, in tables: rows are counted per (label, hash prefix), running counts tell which prefix holds
    each cut, and only rows under those prefixes are counted again by a longer prefix, until a prefix holds few enough to rank.
    Nothing per label reaches the driver, however many labels there are, and a label with most of the rows is counted in many tasks.
    """
    hashed = df.select(F.col(f"`{label}`").alias("group"), row_hash(keys, seed).alias("h"))
    sizes = durable(hashed.groupBy("group").agg(F.count(F.lit(1)).alias("n")))
    size, extra = F.floor(F.col("n") / k), F.col("n") % k
    folds = sizes.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 2))))
    rank = ((F.col("fold") + 1) * size + F.least((F.col("fold") + 1).cast("long"), extra)).cast("long")
    # A fold that ends before the first row or with the last one needs no cut.
    wanted = durable(folds.withColumn("rank", rank).where("rank > 0 and rank < n").select("group", "fold", "rank", F.lit("").alias("prefix")))
    under = lambda rows, length, names: rows.join(
        names.select(F.col("group").alias("_g"), F.col("prefix").alias("_p")).distinct(),
        F.col("group").eqNullSafe(F.col("_g")) & (F.substring("h", 1, length) == F.col("_p")), "left_semi")
    found, length = None, 0
    while True:
        length += PREFIX
        inside = under(hashed, length - PREFIX, wanted) if found is not None else hashed
        counts = inside.groupBy("group", F.substring("h", 1, length - PREFIX).alias("prefix"), F.substring("h", 1, length).alias("p")).agg(F.count(F.lit(1)).alias("c"))
        placed = _holding(wanted, counts, ["group", "prefix"], "p")
        placed = durable(placed.select("group", "fold", "rank", F.col("p").alias("prefix"), "c"))
        done = placed.where(F.col("c") <= ranked) if length < 32 else placed
        few = under(hashed, length, done).groupBy("group", "h", F.substring("h", 1, length).alias("prefix")).agg(F.count(F.lit(1)).alias("c"))
        hit = durable(_holding(done.drop("c"), few, ["group", "prefix"], "h").select("group", "fold", "h"))
        found = hit if found is None else found.unionByName(hit)
        wanted = placed.where(F.col("c") > ranked).drop("c")
        if length >= 32 or wanted.isEmpty():
            return found.groupBy("group").agg(F.array_sort(F.collect_list("h")).alias("cuts"))


def _holding(wanted: DataFrame, counts: DataFrame, by: list[str], order: str) -> DataFrame:
    """Each wanted rank (from 1) with the row of ``counts`` that holds it, and the rank inside that row."""
    running = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = counts.withColumn("_upto", F.sum("c").over(running))
    counts = counts.select(*[F.col(c).alias(f"_{c}") for c in by], F.col(order).alias(order), F.col("c").alias("c"), "_upto")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    held = wanted.join(counts, same + [F.col("rank") <= F.col("_upto"), F.col("rank") > F.col("_upto") - F.col("c")])
    return held.withColumn("rank", F.col("rank") - F.col("_upto") + F.col("c"))


def get_splits(df: DataFrame, k: int = 5, name: str = "fold"):
    """(train, test) for each fold number of a table that carries folds."""
    for f in range(k):
        yield df.where(F.col(name) != f), df.where(F.col(name) == f)


def train_test_split(
    df: DataFrame, keys: list[str], test_size: float = 0.2, shuffle: bool = True, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """The first ``int(n * (1 - test_size))`` rows of the seeded order train, the rest test."""
    marked = train_test_mark(df, keys, test_size, shuffle, seed)
    train = marked.where(F.col("is_train")).drop("is_train")
    return train, marked.where(~F.col("is_train")).drop("is_train")


def train_test_mark(df, keys, test_size=0.2, shuffle=True, seed=42) -> DataFrame:
    size = lambda n: int(n * (1 - test_size))
    if not shuffle:
        return df.withColumn("is_train", _first_by_key(df, keys, size))
    _, hashes = hash_cuts(df, keys, seed, lambda n: [size(n) - 1] if size(n) else [])
    inside = row_hash(keys, seed) <= F.lit(hashes[0]) if hashes else F.lit(False)
    return df.withColumn("is_train", inside)


def _first_by_key(df, keys, size) -> Column:
    """Unshuffled split: rows up to the key at the cut, in key order (null first), whatever the keys' types.

    The keys are range-partitioned and sorted; with the sizes of the partitions the cut's place in its partition
    is known, and one row is read there. Copies of the key at the cut all train.
    """
    key = lambda: F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    ranged = df.select(key().alias("k")).repartitionByRange("k").sortWithinPartitions("k")
    place = F.monotonically_increasing_id()
    ranged = durable(ranged.select("k", F.spark_partition_id().alias("_p"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_i")))
    sizes = sorted(tuple(r) for r in ranged.groupBy("_p").agg(F.count(F.lit(1))).collect())
    left = size(sum(n for _, n in sizes)) - 1
    if left < 0:
        return F.lit(False)
    for part, n in sizes:
        if left < n:
            break
        left -= n
    cut = ranged.where((F.col("_p") == part) & (F.col("_i") == left)).select("k").first()["k"]
    literal = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut, ranged.schema["k"].dataType.fields)])
    return key() <= literal


# --- resampling --------------------------------------------------------------------------------

def poisson_weights(keys: list[Column], seed: int, n_trees: int) -> Column:
    """How often a row is drawn for each tree: Poisson(1), from 16 of the bits of ``md5(seed:group:key...)``.

    One digest serves eight trees, and any SQL engine can repeat it.
    """
    parts = [F.coalesce(k.cast("string"), F.lit("")) for k in keys]
    groups = F.transform(F.sequence(F.lit(0), F.lit((n_trees - 1) // 8)), lambda g: F.md5(F.concat_ws(":", F.lit(str(seed)), g.cast("string"), *parts)))
    draws = F.transform(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: F.conv(F.substring(F.get(groups, F.floor(t / 8).cast("int")), t % 8 * 4 + 1, F.lit(4)), 16, 10).cast("int"))
    return F.transform(draws, lambda u: F.size(F.filter(F.lit(poisson_steps()), lambda c: c <= u)))


def poisson_steps() -> list[int]:
    """The 16-bit numbers from which on a row is drawn once more."""
    steps, density, cumulative = [], 0.36787944117144233, 0.0  # exp(-1)
    for count in range(12):
        cumulative += density
        density /= count + 1
        if round(cumulative * 65536) < 65536:
            steps.append(round(cumulative * 65536))
    return steps


def bootstrap(df: DataFrame, keys: list[str], n_trees: int, seed: int = 42) -> DataFrame:
    """Add ``weights``: the row's draw count for every tree."""
    return df.withColumn("weights", poisson_weights([F.col(f"`{k}`") for k in keys], seed, n_trees))


def feature_subset(n_features: int, size: int | None, seed: int, tree: int) -> list[int]:
    """Feature numbers one tree may use, drawn without replacement."""
    size = size or max(1, int(n_features ** 0.5))
    return sorted(random.Random(f"{seed}:{tree}").sample(range(n_features), min(size, n_features)))
