"""Awkward tables that every operator must take."""

import random

SF = "/root/testdata/sf0.001"

#: Columns whose names the operators use inside, next to those of the table.
EXTRA = "size long, key string, print long, count long, n long, plan string, words long, a long, b long, host string, cell int"


def documents(spark, rows, extra=True):
    """A documents table from (doc_id, text) or (doc_id, text, source)."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = []
    for doc_id, text, *source in rows:
        row = (doc_id, text, "en", source[0] if source else "s", None if text is None else len(text))
        full.append(row + ((7, "k", 7, 7, 7, "p", 7, 7, 7, "h", 7) if extra else ()))
    return spark.createDataFrame(full, schema + (f", {EXTRA}" if extra else ""))


def prose(seed, n, vocabulary=60):
    """``n`` words of made-up prose, the same for a seed."""
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(r.choice(words) for _ in range(n)) + "."


def awkward(spark):
    """Nulls, empty and very long texts, repeated rows and ids, all kinds of white space."""
    long = prose(5, 30_000, 900)
    rows = [
        (None, None, None), (None, "alone in the dark", "a"), (1, None, "a"), (2, "", "b"), (3, " \t\n\x0b\f\r ", None),
        (4, long, "b"), (5, long, "b"), (6, "one two", "a"), (6, "one two", "a"), (6, "quite another text here", "c"),
        (7, prose(1, 80), "a"), (8, prose(1, 80), "c"), (9, prose(2, 300), "c"), (-3, prose(2, 299) + " more", "c"),
        (10, "ünïcödé \u2028 wörds \xa0 stay" * 30, "\U0001f600"), (11, "a" * 5000, "z"), (12, "ab " * 700, ""),
    ]
    return documents(spark, rows)


def empty(spark):
    return documents(spark, [(1, "x")]).limit(0)
