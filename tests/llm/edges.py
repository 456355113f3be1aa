"""A small table with every awkward case, and extra columns whose names clash
with those that the operators add or use."""

import random

CLASH = ("component", "kept", "size", "copies", "score", "_key", "_text", "word", "ids", "labels", "n_lines")


def word_salad(seed, n):
    r = random.Random(seed)
    parts = ["an", "ti", "the", "ing", "or", "é", "ou", "st"]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n))


def rows():
    long = word_salad(1, 30_000)
    return [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, "a"), (4, "one", "en", None),
        (5, "Two  words", "en", None), (6, "two words", "fr", "b"), (7, long, "en", "b"), (8, long, "en", "c"),
        (9, "x" * 20_000, "de", "c"), (10, word_salad(2, 200), "en", "a"), (11, word_salad(2, 200), "en", "a"),
        (11, word_salad(2, 200), "en", "a"),                       # a repeated row
        (12, "a\nb\n\na\nb", "en", "a"), (None, "no key", "en", "b"), (None, None, None, None),
        (13, "日本語 😀 é́ \u0000 ﻿", "ja", "c"), (14, word_salad(3, 100) + "\n" + word_salad(3, 100), "en", "a"),
    ]


def docs(spark, data=None, clash=True):
    extra = CLASH if clash else ()
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in extra)
    data = rows() if data is None else data
    return spark.createDataFrame([(*r, len(r[1] or ""), *["clash"] * len(extra)) for r in data], schema)
