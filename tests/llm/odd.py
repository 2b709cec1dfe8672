"""Small tables with everything that is awkward: nulls, empty and long texts, repeated rows, clashing columns."""

import random

LONG = " ".join(f"long{i % 701}" for i in range(30_000))
CLASHING = ("key", "body", "score", "stats", "node", "place", "block", "label", "rejected", "length")


def prose(seed, n=60, words="alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()):
    r = random.Random(seed)
    return " ".join(r.choice(words) + r.choice(["", "s", "ed", "ing"]) for _ in range(n))


ROWS = [
    (0, prose(0), "en"),
    (1, prose(1), None),
    (2, None, "en"),
    (3, "", "de"),
    (4, " \n\t ", None),
    (None, prose(2), "en"),
    (None, None, None),
    (6, LONG, "en"),
    (7, prose(0), "en"),
    (7, prose(0), "en"),
    (8, "one two three", "de"),
    (9, "a", "de"),
    (10, "日本語 text ▁ \x00   é 👍🏽", "fr"),
    (11, "w" * 3000, "fr"),
    (12, "!!! ??? 123", "fr"),
]
SCHEMA = "doc_id bigint, text string, lang string, " + ", ".join(f"{c} string" for c in CLASHING)


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(*row, *["x"] * len(CLASHING)) for row in rows], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
