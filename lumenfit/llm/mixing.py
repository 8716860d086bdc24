"""Mixing sources to target weights by entropy balancing.

Among all document rates ``r`` that give each margin category its target of tokens, the one nearest to the
unweighted corpus in relative entropy (each token counts alike) is an exponential tilt, ``r = min(cap, exp(sum of
the multipliers of its categories))``. The multipliers solve a convex dual; Newton steps find them, each step one
aggregate over the cells of the corpus. Rates become whole copies by systematic rounding within size classes, and a
few small documents of each category then absorb what rounding left over.

Everything is native: DataFrame functions only, no Python on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import durable
from .common import small

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def capped_targets(groups: DataFrame, by: str, weights=(1, 2, 3), cap: float = 3.0) -> DataFrame:
    """Token targets of a table ``(by, group_size)``: shares of all tokens by weight, none above ``cap`` times its size.

    Categories in code point order, null last, take the weights in turn. A category whose share exceeds its limit gets
    the limit and the excess goes to the others by weight: in order of limit per weight, categories are capped as
    long as their limit is below the level that the rest would reach. Adds ``target``.
    """
    order = Window.orderBy(F.col(by).asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    ranked = groups.withColumn("_w", weight).withColumn("_limit", F.col("group_size") * cap)
    everything = Window.partitionBy()
    lower = Window.orderBy(F.col("_limit") / F.col("_w"), F.col(by).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    total, mass = F.sum("group_size").over(everything), F.sum("_w").over(everything)
    level = (total - F.coalesce(F.sum("_limit").over(lower), F.lit(0.0))) / (mass - F.coalesce(F.sum("_w").over(lower), F.lit(0.0)))
    levels = ranked.withColumn("_level", level).withColumn("_full", F.col("_limit") / F.col("_w") <= F.col("_level"))
    # Where the caps end, all the rest share one level: the lowest that any of them computed.
    shared = F.first(F.when(~F.col("_full"), F.col("_level")), ignorenulls=True).over(
        Window.orderBy("_full", F.col("_limit") / F.col("_w"), F.col(by).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("target", F.when(F.col("_full"), F.col("_limit")).otherwise(F.col("_w") * shared)).drop("_w", "_limit", "_level", "_full")


def balance(cells: DataFrame, margins: dict[str, DataFrame], cap: float, tolerance: float = 1e-9, steps: int = 60) -> DataFrame:
    """Solve the dual. ``cells`` has the margin columns and ``cell_size``; each margin is a table ``(column, target)``.

    A step updates one margin by ``lambda += (target - mass) / curvature``, at most 1 in size; with one margin the
    Hessian is diagonal and this is Newton's method, with several it is Newton's method by blocks. The state is a table
    in the shared folder, so an executor lost between steps costs nothing. Returns the cells with ``rate``.
    """
    state = cells
    for column, wanted in margins.items():
        wanted = wanted.select(F.col(column).alias("_k"), F.col("target").alias(f"_t_{column}"))
        state = state.join(wanted, F.col(column).eqNullSafe(F.col("_k")), "left").drop("_k").withColumn(f"_l_{column}", F.lit(0.0))
    state = durable(state)
    tilt = F.exp(reduce(lambda a, b: a + b, [F.col(f"_l_{c}") for c in margins]))
    rate = F.least(tilt, F.lit(float(cap)))
    for _ in range(steps):
        worst = 0.0
        for column in margins:
            each = Window.partitionBy(column)
            mass = F.sum(F.col("cell_size") * rate).over(each)
            free = F.sum(F.when(tilt < cap, F.col("cell_size") * tilt)).over(each)
            miss = F.col(f"_t_{column}") - mass
            step = F.when((F.abs(miss) > tolerance * F.col(f"_t_{column}")) & (free > 0), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), miss / free)))
            step = F.when((F.col(f"_t_{column}") < mass) & free.isNull() & (F.abs(miss) > tolerance * F.col(f"_t_{column}")), F.lit(-0.1)).otherwise(step)
            step = F.coalesce(step, F.lit(0.0))
            state = durable(state.withColumn("_s", step).withColumn(f"_l_{column}", F.col(f"_l_{column}") + F.col("_s")))
            worst = max(worst, state.agg(F.max(F.abs("_s"))).first()[0] or 0.0)
            state = state.drop("_s")
        if worst == 0.0:
            break
    return state.withColumn("rate", rate).drop(*[f"_{k}_{c}" for k in "tl" for c in margins])


def _uniform(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


def mix(docs: DataFrame, by: str = "source", weights=(1, 2, 3), cap: float = 3.0, key: str = "doc_id", text: str = "text",
        rows_per_cell: int = 100_000, spare: int = 8) -> DataFrame:
    """How often each document goes into the mix: ``(key, by, size, source_size, target, rate, copies, taken)``, a row per row.

    Every row is decided by itself: rows that repeat ``(key, by, size)`` are numbered, by many tasks where they are many. In a
    cell of like sizes the ``i``-th row in hash order gets ``floor(rate * i + u) - floor(rate * (i - 1) + u)`` copies,
    ``u`` being the cell's own hash, so each cell is right to one copy; cells hold about ``rows_per_cell`` rows, so a source
    with a third of all rows is many cells. Then ``spare`` rows of each size class are offered, larger first, to
    close the gap to the source's target. Null and empty texts have size 0 and count for nothing; null sources are a
    source of their own; a null key is a key. Empty tables give an empty result. Deterministic: no random numbers.
    """
    plan = _plan(docs, by, weights, cap, key, text, rows_per_cell, spare)
    return plan.select(key, by, "size", F.col("group_size").alias("source_size"), "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


# Repeated rows of one (key, source, size) that a task numbers at once.
CHUNK = 100_000


def _plan(docs: DataFrame, by: str, weights, cap: float, key: str, text: str, rows_per_cell: int, spare: int) -> DataFrame:
    """A row per row: ``(key, by, size, _copy, group_size, target, rate, copies)``; ``_copy`` numbers equal ``(key, by, size)`` from 0."""
    sized = docs.select(F.col(key), F.col(by), word_count(F.col(text)).alias("size"))
    counted = durable(sized.groupBy(key, by, "size").agg(F.count(F.lit(1)).alias("_m")))
    groups = durable(counted.groupBy(by).agg(F.sum(F.col("size") * F.col("_m")).alias("group_size"), F.sum("_m").alias("_n"), F.max("_m").alias("_most")))
    rows, most = groups.agg(F.sum("_n"), F.max("_most")).first()
    targets = durable(capped_targets(groups.drop("_n", "_most"), by, weights, cap))
    rates = balance(targets.select(by, F.col("group_size").alias("cell_size")), {by: targets.select(by, "target")}, cap)
    rates = durable(targets.join(rates.select(F.col(by).alias("_k"), "rate"), F.col(by).eqNullSafe(F.col("_k"))).drop("_k"))

    pieces = counted.withColumn("_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1, F.lit(CHUNK).cast("long"))))
    if (most or 0) > CHUNK:
        pieces = pieces.repartition(F.xxhash64(key, by, "size", "_start"))
    units = pieces.withColumn("_copy", F.explode(F.sequence(F.col("_start"), F.least(F.col("_start") + CHUNK, F.col("_m")) - 1))).drop("_m", "_start")
    salts = 1 + (rows or 0) // rows_per_cell
    bins = F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)).cast("double")) * 4).cast("long")
    cell = units.join(small(rates.withColumnRenamed(by, "_k")), F.col(by).eqNullSafe(F.col("_k"))).drop("_k")
    cell = cell.withColumn("_cell", bins * salts + F.pmod(F.xxhash64(F.col(key), F.col("_copy"), F.lit(1)), F.lit(salts)))
    place = F.row_number().over(Window.partitionBy(by, "_cell").orderBy(F.xxhash64(F.col(key), F.col("size"), F.col("_copy")), F.col(key), F.col("size"), F.col("_copy")))
    cell = cell.withColumn("_i", place.cast("long"))
    u = _uniform(F.col(by), F.col("_cell"))
    copies = F.floor(F.col("rate") * F.col("_i") + u) - F.floor(F.col("rate") * (F.col("_i") - 1) + u)
    # A row that alone would move its source by more than a twentieth of its target is left to the repair.
    copies = F.when(F.col("size") * 20 > F.col("target"), F.floor(F.col("rate"))).otherwise(copies)
    limit = int(cap)
    cell = durable(cell.withColumn("copies", F.greatest(F.lit(0), F.least(F.lit(limit), copies)).cast("long")))
    for flip in (False, True, False):
        cell = durable(_repaired(cell, by, key, limit, spare, flip))
    return cell


def _repaired(cell: DataFrame, by: str, key: str, limit: int, spare: int, flip: bool) -> DataFrame:
    """Change the copies of a few rows by one each to close the gaps to the targets.

    Of each size class ``spare`` rows are offered; larger first, a row is taken while it does not exceed what is
    left or, with ``flip``, while it brings the rest nearer to zero. Gaps and changes are a few rows per source, so
    that the rows themselves are not dealt by source.
    """
    gaps = cell.groupBy(by).agg(F.first("target").alias("_target"), F.sum(F.col("size") * F.col("copies")).alias("_taken"))
    gaps = durable(gaps.select(F.col(by).alias("_k"), (F.col("_target") - F.col("_taken")).alias("_gap")))
    offered = cell.join(small(gaps), F.col(by).eqNullSafe(F.col("_k"))).where((F.col("size") > 0) & (F.col("size") < 2 * F.abs("_gap")))
    offered = offered.withColumn("_mass", F.col("size"))
    offered = offered.where(F.when(F.col("_gap") > 0, F.col("copies") < limit).otherwise(F.col("copies") > 0))
    offered = offered.withColumn("_level", F.floor(F.log2(F.col("_mass").cast("double"))))
    first = F.row_number().over(Window.partitionBy(by, "_level").orderBy(F.xxhash64(F.col(key), F.lit(2 + flip)), F.col("_cell"), F.col("_i")))
    offered = offered.withColumn("_turn", first).where(F.col("_turn") <= spare)
    lists = offered.groupBy("_k").agg(F.first("_gap").alias("_gap"), F.sort_array(F.collect_list(F.struct("_mass", "_cell", "_i")), asc=False).alias("_offer"))
    start = F.struct(F.abs(F.col("_gap")).alias("left"), F.array().cast("array<struct<c:bigint,i:bigint>>").alias("took"))
    take = F.aggregate("_offer", start, lambda s, x: F.when(
        x["_mass"] < 2 * s["left"] if flip else x["_mass"] <= s["left"],
        F.struct((s["left"] - x["_mass"]).alias("left"), F.concat(s["took"], F.array(F.struct(x["_cell"].alias("c"), x["_i"].alias("i")))).alias("took"))).otherwise(s))
    changes = lists.select("_k", F.signum("_gap").cast("long").alias("_sign"), F.explode(take["took"]).alias("_u")).select("_k", "_sign", F.col("_u.c").alias("_c"), F.col("_u.i").alias("_j"))
    final = cell.join(small(durable(changes)), F.col(by).eqNullSafe(F.col("_k")) & (F.col("_cell") == F.col("_c")) & (F.col("_i") == F.col("_j")), "left")
    return final.withColumn("copies", F.col("copies") + F.coalesce(F.col("_sign"), F.lit(0))).drop("_k", "_c", "_j", "_sign")


def mixed_documents(docs: DataFrame, by: str = "source", key: str = "doc_id", text: str = "text", weights=(1, 2, 3), cap: float = 3.0,
                    rows_per_cell: int = 100_000, spare: int = 8) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix` decides, with all its columns.

    Rows that alone have their key, source and size are joined with their decision. Of rows that share them, equal ones are
    merged and numbered in the order of their content, cell by cell, and take the decisions of their numbers.
    """
    plan = _plan(docs, by, weights, cap, key, text, rows_per_cell, spare)
    plan = durable(plan.select(F.col(key).alias("_key"), F.col(by).alias("_by"), F.col("size").alias("_size"), "_copy", "copies"))
    repeated = durable(plan.where(F.col("_copy") == 1).select("_key", "_by", "_size"))
    # The columns of a document travel as one, so their names may be anything.
    sized = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_k"), F.col(by).alias("_b"), word_count(F.col(text)).alias("_n"))
    same = F.col("_k").eqNullSafe(F.col("_key")) & F.col("_b").eqNullSafe(F.col("_by")) & (F.col("_n") == F.col("_size"))
    few = small(repeated)
    alone = plan.join(few.select(*[F.col(c).alias(f"{c}2") for c in ("_key", "_by", "_size")]),
                      F.col("_key").eqNullSafe(F.col("_key2")) & F.col("_by").eqNullSafe(F.col("_by2")) & (F.col("_size") == F.col("_size2")), "left_anti")
    kept = sized.join(small(durable(alone.where(F.col("copies") > 0))), same).select("_row", "copies")
    if not repeated.isEmpty():
        kept = kept.unionByName(_numbered(sized.join(few, same), plan))
    return kept.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")


def _numbered(rows: DataFrame, plan: DataFrame, cells: int = 1024) -> DataFrame:
    """``(_row, copies)`` of rows that share key, source and size: merged where they are equal, numbered over cells of
    their hash, and given the sum of the decisions of their numbers."""
    unit = ["_k", "_b", "_n"]
    merged = rows.groupBy(*unit, "_row").agg(F.count(F.lit(1)).alias("_m"))
    merged = durable(merged.withColumns({"_h": F.xxhash64("_row"), "_g": F.xxhash64(F.lit(3), "_row")}).withColumn("_cell", F.pmod("_h", F.lit(cells))))
    names = merged.drop("_row")
    sizes = names.groupBy(*unit, "_cell").agg(F.sum("_m").alias("_s"))
    before = Window.partitionBy(*unit).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*[F.col(c).alias(f"{c}2") for c in (*unit, "_cell")], F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_before"))
    equal = lambda c: F.col(c).eqNullSafe(F.col(f"{c}2"))
    inside = Window.partitionBy(*unit, "_cell").orderBy("_h", "_g").rowsBetween(Window.unboundedPreceding, -1)
    placed = names.withColumn("_first", F.coalesce(F.sum("_m").over(inside), F.lit(0)))
    placed = placed.join(sizes, equal("_k") & equal("_b") & equal("_n") & equal("_cell")).select(*unit, "_h", "_g", "_m", (F.col("_first") + F.col("_before")).alias("_first"))
    pieces = placed.withColumn("_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1, F.lit(CHUNK).cast("long"))))
    pieces = pieces.repartition(F.xxhash64(*unit, "_h", "_start"))
    each = pieces.withColumn("_number", F.explode(F.sequence(F.col("_first") + F.col("_start"), F.col("_first") + F.least(F.col("_start") + CHUNK, F.col("_m")) - 1)))
    decided = each.join(plan, F.col("_k").eqNullSafe(F.col("_key")) & F.col("_b").eqNullSafe(F.col("_by")) & (F.col("_n") == F.col("_size")) & (F.col("_number") == F.col("_copy")))
    total = decided.groupBy(*unit, "_h", "_g").agg(F.sum("copies").alias("copies")).where("copies > 0")
    total = total.select(*[F.col(c).alias(f"{c}2") for c in (*unit, "_h", "_g")], "copies")
    return merged.join(total, equal("_k") & equal("_b") & equal("_n") & equal("_h") & equal("_g")).select("_row", "copies")
