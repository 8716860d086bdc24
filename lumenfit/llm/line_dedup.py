"""Line dedup by distinct-site spread, native: lines that too many sites share are boilerplate and go from all of them.

A HyperLogLog sketch of sites per line hash merges by aggregation. Lines whose estimate is clearly above or below the
threshold are decided by it; lines near the threshold get an exact distinct count. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import durable
from .common import BROADCAST_ROWS, row_count

# Salts of joins on a line or a text that many rows share, and line places that may be broadcast.
SALTS = 16
BROADCAST_PLACES = 8_000_000
# 2^11 registers: relative standard error below 2 %.
LG_K = 11
# Estimates within this factor of the threshold, or within two of it, are counted exactly (many standard errors).
BAND = 0.25


def line_hash(line: Column) -> Column:
    """128 bits of a line without surrounding ASCII white space, as two longs."""
    line = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return F.struct(F.xxhash64(line).alias("x"), F.xxhash64(F.lit(7), line, F.length(line)).alias("y"))


def lines_of(docs: DataFrame, text: str) -> DataFrame:
    """Lines that hold something, with their place (from 0) in the text: adds ``pos`` and ``h``."""
    lines = docs.select("*", F.posexplode(F.split(F.col(text), "\n")).alias("pos", "_line")).drop(text)
    return lines.where(F.btrim("_line", F.lit(" \t\n\x0b\x0c\r")) != "").withColumn("h", line_hash(F.col("_line"))).drop("_line")


def boilerplate(lines: DataFrame, site: str, min_sites: int) -> DataFrame:
    """``(h, sites)``: lines on at least ``min_sites`` distinct sites. ``lines`` has ``h`` and the site column; null is no site."""
    low, high = min(min_sites * (1 - BAND), min_sites - 2), max(min_sites * (1 + BAND), min_sites + 2)
    sketches = lines.where(F.col(site).isNotNull()).groupBy("h").agg(F.hll_sketch_agg(site, F.lit(LG_K)).alias("sketch"))
    sketches = durable(sketches.select("h", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= low))
    sure = sketches.where(F.col("estimate") > high).select("h", F.col("estimate").alias("sites"))
    near = sketches.where(F.col("estimate") <= high).select("h")
    pairs = lines.where(F.col(site).isNotNull()).select("h", site)
    few = row_count(near) <= BROADCAST_ROWS
    # Few lines are looked up where they stand; many only after a line is one row per site, however often it occurs.
    pairs = pairs.join(F.broadcast(near), "h", "left_semi").distinct() if few else pairs.distinct().join(near, "h", "left_semi")
    exact = pairs.groupBy("h").agg(F.count(F.lit(1)).alias("sites"))
    return sure.union(exact.where(F.col("sites") >= min_sites))


def dedup_lines(docs: DataFrame, site: str = "source", key: str = "doc_id", text: str = "text", min_sites: int = 10) -> DataFrame:
    """``(key, n_lines, n_removed, text)`` for each row: the text without boilerplate lines.

    Lines are cut at ``\\n`` and compared without surrounding ASCII white space; blank lines stay. Null texts stay null
    with no lines; an empty text has none either. Rows without site neither count nor escape removal. Repeated rows
    keep their number: what goes is decided by the text, so keys may repeat or be null. ``min_sites`` is an absolute number: what ten
    independent sites share word for word is boilerplate in a corpus of twenty sites as in one of a million. With fewer
    sites than that nothing goes.
    """
    rows = docs.select(F.col(key).alias("_key"), F.col(site).cast("string").alias("_site"), F.col(text).alias("_text"))
    rows = rows.withColumn("_id", F.struct(F.xxhash64("_text").alias("x"), F.xxhash64(F.lit(7), F.col("_text"), F.length("_text")).alias("y")))
    lines = lines_of(rows.drop("_key"), "_text")
    common = durable(boilerplate(lines, "_site", min_sites).select("h"))
    if row_count(common) <= BROADCAST_ROWS:
        found = lines.join(F.broadcast(common), "h", "left_semi").select("_id", "pos")
    else:
        # Of a line that is everywhere, the texts that hold it are dealt over salts; a text's copies are one row first.
        salted = lines.select("_id", "pos", "h").distinct().withColumn("_salt", F.pmod(F.xxhash64("_id", "pos"), F.lit(SALTS)))
        every = common.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        found = salted.join(every, ["h", "_salt"], "left_semi").select("_id", "pos")
    gone = durable(found.groupBy("_id").agg(F.array_sort(F.collect_set("pos")).alias("_gone")).withColumnRenamed("_id", "_of"))
    places = gone.agg(F.sum(F.size("_gone") + 8)).first()[0] or 0
    if places <= BROADCAST_PLACES:
        joined = rows.join(F.broadcast(gone), F.col("_id") == F.col("_of"), "left")
    else:
        # Copies of one text are dealt over salts as well.
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_key", "_site"), F.lit(SALTS)))
        every = gone.withColumn("_salt2", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        joined = salted.join(every, (F.col("_id") == F.col("_of")) & (F.col("_salt") == F.col("_salt2")), "left")
    n_lines = F.size(F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\x0c\r")) != ""))
    return joined.select(
        F.col("_key").alias(key), F.coalesce(F.when(F.col("_text").isNotNull(), n_lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(without(F.split("_text", "\n"), F.col("_gone")), "\n")).alias("text"))


def without(lines: Column, gone: Column) -> Column:
    """An array without the places that a sorted array names: the stretches between them, in one walk. As the argument of
    a lambda each array is computed once, not once per place."""
    def walk(both: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(both["gone"], lambda g: g + 1))
        ends = F.concat(both["gone"], F.array(F.size(both["lines"])))
        return F.flatten(F.zip_with(starts, ends, lambda a, b: F.slice(both["lines"], a + 1, b - a)))

    return F.get(F.transform(F.array(F.struct(lines.alias("lines"), gone.alias("gone"))), walk), 0)
