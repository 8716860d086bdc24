"""Exact percentiles (linear interpolation between order statistics) at any table size.

Spark's exact ``percentile`` keeps every distinct value of a column in one buffer, which is fine
for a small table only. Beyond ``SMALL`` rows the order statistics are found by narrowing: a
mergeable sketch gives an interval that must contain the wanted rank, one more aggregate counts
what lies below it and sketches inside it, and so on until the interval is narrow enough to be
ranked value by value. Every round is a scan with map-side aggregation; no column is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SMALL = 1_000_000
ACCURACY = 10_000


def exact_percentiles(
    df: DataFrame, columns: list[str], probs: list[float], small: int = SMALL,
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """``{column: [percentile, ...]}`` over the non-null cells of double columns."""
    if not columns:
        return {}
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns]).first()
    if max(counts) <= small:
        row = df.agg(*[F.percentile(F.col(f"`{c}`"), probs).alias(c) for c in columns]).first()
        return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in columns}
    ranks = wanted_ranks(counts.asDict(), probs)
    found = _order_statistics(df, dict.fromkeys(ranks), counts.asDict(), small, accuracy)
    return interpolate(counts.asDict(), probs, found)


def wanted_ranks(counts: dict[str, int], probs: list[float]) -> list[tuple[str, int]]:
    """The 0-based ranks whose values the percentiles lie between."""
    ranks = []
    for c, n in counts.items():
        for p in probs if n else []:
            position = p * (n - 1)
            ranks += [(c, math.floor(position)), (c, math.ceil(position))]
    return list(dict.fromkeys(ranks))


def interpolate(counts: dict[str, int], probs: list[float], values: dict) -> dict[str, list]:
    result = {}
    for c, n in counts.items():
        result[c] = []
        for p in probs:
            if not n:
                result[c].append(None)
                continue
            position = p * (n - 1)
            low, high = values[(c, math.floor(position))], values[(c, math.ceil(position))]
            result[c].append(low + (high - low) * (position - math.floor(position)))
    return result


def rank_hits(ranks: list[tuple[str, int]], name: Column, upto: Column, n: Column) -> Column:
    """Whether a counted value (n copies, running total ``upto``) sits at one of the ranks."""
    hit = F.lit(False)
    for key, rank in ranks:
        hit = hit | ((name == F.lit(key)) & (upto > rank) & (upto - n <= rank))
    return hit


def approx_percentiles(df, columns, probs, accuracy: int = ACCURACY) -> dict[str, list]:
    """The opt-in sketch: one pass, rank error of at most ``rows / accuracy``."""
    if not columns:
        return {}
    row = df.agg(
        *[F.percentile_approx(F.col(f"`{c}`"), probs, accuracy).alias(c) for c in columns]
    ).first()
    return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in columns}


def _order_statistics(df, wanted, counts, small, accuracy):
    """The values at the given 0-based ranks, for all columns at once."""
    open_ = {}
    for c, rank in wanted:
        if 0 <= rank < counts[c]:
            # below: cells strictly under the interval; inside: cells in it
            open_[(c, rank)] = {"lo": None, "hi": None, "below": 0, "inside": counts[c]}
    answers = dict(wanted)
    while any(s["inside"] > small for s in open_.values()):
        keys = [k for k, s in open_.items() if s["inside"] > small]
        _narrow(df, open_, keys, accuracy)
        for key in keys:
            state = open_[key]
            if state["lo"] == state["hi"]:
                answers[key] = state["lo"]
                del open_[key]
    if open_:
        answers.update(_rank_inside(df, open_))
    return answers


def _within(c: str, state) -> Column:
    x = F.col(f"`{c}`")
    inside = x.isNotNull()
    if state["lo"] is not None:
        inside = inside & (x >= F.lit(state["lo"])) & (x <= F.lit(state["hi"]))
    return inside


def _narrow(df, states, keys, accuracy) -> None:
    sketches = []
    for i, key in enumerate(keys):
        s = states[key]
        share = (key[1] - s["below"] + 0.5) / s["inside"]
        slack = 2.0 / accuracy
        probs = [max(0.0, share - slack), min(1.0, share + slack)]
        cell = F.when(_within(key[0], s), F.col(f"`{key[0]}`"))
        sketches.append(F.percentile_approx(cell, probs, accuracy).alias(f"p{i}"))
    row = df.agg(*sketches).first()
    counts = []
    for i, key in enumerate(keys):
        x, (lo, hi) = F.col(f"`{key[0]}`"), row[f"p{i}"]
        counts += [
            F.count_if(x < lo).alias(f"b{i}"),
            F.count_if(x == lo).alias(f"l{i}"),
            F.count_if((x > lo) & (x < hi)).alias(f"m{i}"),
            F.count_if(x == hi).alias(f"h{i}"),
        ]
    found = df.agg(*counts).first()
    for i, key in enumerate(keys):
        lo, hi = row[f"p{i}"]
        below, at_lo, middle, at_hi = (found[f"{t}{i}"] for t in "blmh")
        s, rank = states[key], key[1]
        if rank < below:
            # the sketch was off to the right: keep the part under it
            s.update(hi=_previous(lo), inside=below - s["below"])
            if s["lo"] is None:
                s["lo"] = -math.inf
        elif rank < below + at_lo:
            s.update(lo=lo, hi=lo, below=below, inside=at_lo)
        elif rank < below + at_lo + middle:
            s.update(lo=_next(lo), hi=_previous(hi), below=below + at_lo, inside=middle)
        elif lo != hi and rank < below + at_lo + middle + at_hi:
            s.update(lo=hi, hi=hi, below=below + at_lo + middle, inside=at_hi)
        else:
            used = below + at_lo + (middle + at_hi if lo != hi else 0)
            left = s["inside"] - (used - s["below"])
            s.update(lo=_next(hi), below=used, inside=left)
            if s["hi"] is None:
                s["hi"] = math.inf


def _next(x: float) -> float:
    return math.nextafter(x, math.inf)


def _previous(x: float) -> float:
    return math.nextafter(x, -math.inf)


def _rank_inside(df, states):
    """Rank the values left in each interval; equal values are merged before the shuffle."""
    parts = []
    for i, ((c, _), s) in enumerate(states.items()):
        parts.append(F.when(_within(c, s), F.struct(F.lit(i).alias("i"),
                                                    F.col(f"`{c}`").alias("v"))))
    cells = df.select(F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("s"))
    values = cells.groupBy("s.i", "s.v").agg(F.count(F.lit(1)).alias("n"))
    running = W.partitionBy("i").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = values.withColumn("upto", F.sum("n").over(running))
    keys = list(states)
    ranks = [(i, key[1] - states[key]["below"]) for i, key in enumerate(keys)]
    hits = ranked.where(rank_hits(ranks, F.col("i"), F.col("upto"), F.col("n")))
    return {keys[r["i"]]: r["v"] for r in hits.collect()}


def group_medians(df: DataFrame, by: str, column: str) -> DataFrame:
    """``(by, median)`` of every group, exact, null-safe in ``by``; missing values do not count.

    Value counts are merged on the map side. A sketch per group bounds the middle ranks; what lies below the bounds
    is only counted, and the few values between them are ranked. No limit on groups.
    """
    x = F.col(column).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(F.col(by).alias("_g"), x.alias("_x"))
    counts = rows.groupBy("_g", "_x").agg(F.count(F.lit(1)).alias("_n"))
    margin, accuracy = 5e-5, 50_000
    bounds = rows.groupBy("_g").agg(F.percentile_approx("_x", [0.5 - margin, 0.5 + margin], accuracy).alias("_b"), F.count(F.lit(1)).alias("_all"))
    bounds = bounds.select(F.col("_g").alias("_k"), F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi"), "_all")
    placed = counts.join(bounds, F.col("_g").eqNullSafe(F.col("_k")))
    # Of an even number of values the upper middle one may be the first above the bound.
    beside = placed.groupBy("_k").agg(F.sum(F.when(F.col("_x") < F.col("_lo"), F.col("_n"))).alias("_below"), F.min(F.when(F.col("_x") > F.col("_hi"), F.col("_x"))).alias("_next"))
    inside = placed.drop("_k").join(beside, F.col("_g").eqNullSafe(F.col("_k")))
    inside = inside.where(F.col("_x").between(F.col("_lo"), F.coalesce("_next", "_hi")))
    upto = F.coalesce("_below", F.lit(0)) + F.sum("_n").over(W.partitionBy("_g").orderBy("_x").rowsBetween(W.unboundedPreceding, W.currentRow))
    inside = inside.withColumn("_upto", upto)
    lower, upper = F.floor((F.col("_all") + 1) / 2), F.floor((F.col("_all") + 2) / 2)
    holds = lambda rank: (rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_n"))
    ends = inside.groupBy("_g").agg(F.max(F.when(holds(lower), F.col("_x"))).alias("_a"), F.max(F.when(holds(upper), F.col("_x"))).alias("_z"))
    return ends.select(F.col("_g").alias(by), ((F.col("_a") + F.col("_z")) / 2).alias("median"))
