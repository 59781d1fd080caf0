"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names operators might use themselves.
CLASH = ["doc", "tie", "fp", "row", "pos", "core", "key", "at", "start", "rank", "code", "language", "__n2"]


def docs(spark, rows, clash: bool = False):
    """rows: (doc_id, text) or whole rows."""
    full = [r if len(r) == 5 else (r[0], r[1], "en", "src0", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOC).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        for name in CLASH:
            df = df.withColumn(name, F.lit("clash"))
    return df


def awkward(seed: int = 5) -> list[tuple]:
    rnd = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "über", "naïve", "Ñandú", "don't", "x.", "12", "漢字", "ЯБ"]

    def text(n):
        return " ".join(rnd.choice(words) + rnd.choice(["", "", ",", ".\n", "  "]) for _ in range(n))

    long = text(6_000)
    one = text(60)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "two words"), (6, one), (7, one), (7, one), (8, one + " tail"),
        (9, long), (10, "pre " + long), (11, "a" * 5_000), (12, "ab " * 300), (None, text(30)), (None, one), (13, text(40)),
        (13, text(41)), (14, "\x1cfoo \x85bar  baz "), (15, "<|endoftext|> is text"), (16, "İstanbul ΣΑΣ ﬁn é"),
    ]


def table(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
