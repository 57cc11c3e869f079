"""Small fixtures with the awkward cases every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

# extra columns whose names operators use inside
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, keep_id string, copies string, bucket string,"
        " length string, rank string, kept string, tokens string, node string, label string, size string, html string, ids string")
EXTRA = [7, *["x"] * 12]


def prose(seed: int, n: int, vocabulary: int = 2000) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(("ka", "lo", "mi", "ter", "ne", "su")) for _ in range(1 + k % 4)) + str(r.randrange(vocabulary) % 97)
                    for k in range(n))


def frame(spark: SparkSession, rows: list[tuple], partitions: int = 3) -> DataFrame:
    return spark.createDataFrame([(row[0], row[1], None, None, *EXTRA) for row in rows],
                                 DOCS).repartition(partitions)


def odd_rows() -> list[tuple]:
    """Nulls, empties, blanks, a very long text, ties and repeated rows, one text often."""
    base = prose(1, 120)
    return [(1, base), (1, base), (2, base.replace(" ", "\n\t ")), (3, None), (4, ""), (5, " \t\n"), (None, base), (None, None),
            (6, "one"), (7, "one"), (8, prose(2, 30000)), (9, base + " more"), (10, "é ß 漢字  x </s>[INST] &amp; <|x|> \x01 y"),
            (11, prose(3, 60)), (12, prose(3, 60) + " " + prose(4, 60)), *((20 + k, "hot text of many copies") for k in range(30)),
            (-5, prose(5, 55)), ((1 << 61) + 1, prose(6, 55))]
