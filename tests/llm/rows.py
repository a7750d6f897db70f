"""Rows that operators must take: nulls, empty and long texts, repeats, ties, clashing extra columns."""

import random

WORDS = "the of and to in a is that it was for on are as with his they at be this".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ".", ",", "x", "ly"]) for _ in range(words))


def nasty(spark):
    """documents with every awkward case, and extra columns named like internal ones."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 300), "en", "a"),
        (2, prose(2, 300), "en", "a"),
        (2, prose(2, 300), "en", "a"),
        (3, None, "en", "b"),
        (4, "", None, None),
        (5, " \n\t ", "de", "b"),
        (6, long, "de", "c"),
        (7, long + " more", None, "c"),
        (None, prose(3, 120), "en", None),
        (8, "123 456 !!", "en", "\U0001f600"),
        (9, "ÄÖ ß\u00a0x " + prose(4, 200), "de", "b"),
        (10, "a" * 200_000, "en", "d"),
        (11, "1" * 20_000 + "@" + "." * 20_000 + "+" + " " * 20_000, "en", "d"),
        (12, prose(2, 299), "fr", "a"),
    ]
    wide = [(*r, len(r[1] or ""), "x", 0.5, "y", i) for i, r in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key string, size double, fp string, row int"
    return spark.createDataFrame(wide, schema)


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
