"""Rows that every operator must handle."""

from pyspark.sql import types as T

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] + str((seed + i) % 13) for i in range(n))


# Columns whose names the operators use inside.
CLASH = ["size", "score", "copies", "h", "n", "token", "label", "component", "_key", "_text", "taken", "target", "rate", "quality", "pos", "shard"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType())] + [T.StructField(c, T.StringType()) for c in CLASH])


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, *["x"] * len(CLASH)) for i, t, s in rows], SCHEMA)


LONG = prose(3, 60_000)
ROWS = [(1, prose(1, 40), "a"), (2, None, "a"), (3, "", "b"), (None, prose(2, 30), "b"), (4, prose(4, 50), None), (4, prose(4, 50), None),
        (5, LONG, "a"), (6, prose(6, 3), "c"), (7, " \t\n ", "c"), (8, prose(1, 40), "b"), (9, prose(4, 50) + " extra", "c")]
