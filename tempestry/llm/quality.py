"""Quality rules as weak supervision.

Each rule votes a document good, bad, or abstains. The votes of all documents are
counted by pattern, expectation-maximisation on those counts estimates how often each
rule is right on good and on bad documents, and a document's posterior probability of
being good replaces the demand that it pass every rule.
"""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tempestry.llm.common import bytes_of

#: (measure, good below or above, bad beyond): the rules. A measure between the two
#: bounds, or one that the text does not have, makes the rule abstain.
RULES = (
    ("symbols per word", 0.02, 0.10),
    ("share of repeated lines", 0.10, 0.30),
    ("share of repeated words", 0.20, 0.50),
    ("share of capital letters", 0.15, 0.50),
    ("characters per word", 9.0, 16.0),
    ("share of characters that are no letters", 0.08, 0.25),
    ("separators per word", 0.02, 0.30),
    ("exclamation marks per word", 0.05, 0.30),
)

MEASURES = StructType(
    [
        StructField(name, LongType())
        for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    ]
    + [StructField("pattern", IntegerType())]
)

_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_OTHER = bytes(b for b in range(128) if not chr(b).isalpha())


def repeated_words(words):
    """How many word places lie in a three-word window that the text holds twice."""
    n = len(words)
    if n < 4:
        return 0
    ids = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    v = len(ids)
    pairs = a[:-1] * v + a[1:]
    if v >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, inverse, count = np.unique(
        pairs[:-1] * v + a[2:], return_inverse=True, return_counts=True
    )
    twice = count[inverse] > 1
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


def measure(text: bytes):
    """The base counts of a text and its vote pattern, one base-3 digit per rule."""
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()] if n else []
    joined = b"".join(words)
    word_chars = len(joined.decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    duplicates = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    if not n:
        return 0, 0, symbols, 0, 0, 0
    capitals = len(joined) - len(joined.translate(None, _UPPER))
    small = len(joined) - len(joined.translate(None, _LOWER))
    letters = capitals + small
    others = len(joined) - len(joined.translate(None, _OTHER))
    values = (
        symbols / n,
        duplicates / len(lines),
        repeated / n,
        capitals / letters if letters else None,
        word_chars / n,
        others / len(joined),
        text.count(b"|") / n,
        text.count(b"!") / n,
    )
    pattern = 0
    for value, (_, good, bad) in zip(reversed(values), reversed(RULES)):
        vote = 0 if value is None else 1 if value <= good else 2 if value > bad else 0
        pattern = pattern * 3 + vote
    return n, word_chars, symbols, duplicates, repeated, pattern


@pandas_udf(MEASURES)
def _measures(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(bytes(t)) for t in texts], columns=MEASURES.names)


def votes_of(pattern):
    """The votes in a pattern: 0 abstains, 1 good, 2 bad."""
    return [pattern // 3**j % 3 for j in range(len(RULES))]


def fit(counts, rounds=50, strength=2.0):
    """Posterior probability of being good for each pattern, by expectation-maximisation.

    ``counts`` maps vote patterns to how many documents show them; there are at most 3
    to the number of rules of them, whatever the number of documents. Each rule has a
    probability of voting good, given that it votes, for good and for bad documents; a
    prior worth ``strength`` votes of 0.9 and 0.5 keeps both sides in their places, and a rule
    never counts as worse than a coin. The share of good documents is learnt too and may be
    small.
    """
    patterns = sorted(counts)
    if not patterns:
        return {}
    weight = np.array([counts[p] for p in patterns], dtype=float)
    votes = np.array([votes_of(p) for p in patterns])
    good, bad = votes == 1, votes == 2
    # a document starts as good unless a rule calls it bad
    posterior = np.where(bad.any(axis=1), np.where(bad.sum(axis=1) > 1, 0.05, 0.3), 0.95)
    for _ in range(rounds):
        share = ((weight * posterior).sum() + strength * 0.9) / (weight.sum() + strength)
        share = np.clip(share, 1e-3, 0.999)
        rates = []
        for side, start in ((posterior, 0.9), (1 - posterior, 0.5)):
            w = (weight * side)[:, None]
            up, down = (w * good).sum(axis=0), (w * bad).sum(axis=0)
            rates.append((up + strength * start) / (up + down + strength))
        p_good = np.clip(rates[0], 0.5, 1 - 1e-6)
        p_bad = np.clip(np.minimum(rates[1], rates[0]), 1e-6, 1 - 1e-6)
        logit = math.log(share / (1 - share)) + (
            good * np.log(p_good / p_bad) + bad * np.log((1 - p_good) / (1 - p_bad))
        ).sum(axis=1)
        posterior = 1 / (1 + np.exp(-np.clip(logit, -60, 60)))
    return dict(zip(patterns, posterior.tolist()))


def pattern_counts(measured: DataFrame) -> dict:
    """Documents by vote pattern, over all documents."""
    return dict(measured.groupBy("pattern").count().collect())


def _verdict(measured: DataFrame, posterior: dict) -> DataFrame:
    """``base_failed``, ``probability`` and ``kept`` beside the measures."""
    table = measured.sparkSession.createDataFrame(
        sorted(posterior.items()), "pattern int, probability double"
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measured.join(F.broadcast(table), "pattern")  # at most 3 ** len(RULES) rows
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("probability") >= 0.5))
    )


def rate_documents(docs: DataFrame, scratch) -> DataFrame:
    """One row per document: doc_id, base counts, base_failed, probability, kept.

    Other columns are ignored. Null and empty texts have no words, fail the base rule
    and are not kept. Null and repeated ids are rows like any other. Equal texts get
    equal verdicts. With no rows there is no model and no row.
    """
    measured = scratch.save(
        docs.select("doc_id", _measures(bytes_of("text")).alias("m")).select("doc_id", "m.*"),
        "measures",
    )
    posterior = fit(pattern_counts(measured))
    return _verdict(measured, posterior).drop("pattern")


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, columns as given.

    The texts are measured twice, to fit and to filter, and never shuffled. Rows are
    dealt with as in ``rate_documents``.
    """
    columns = docs.columns
    measured = docs.withColumn("__m", _measures(bytes_of("text")))
    posterior = fit(pattern_counts(docs.select(_measures(bytes_of("text")).alias("m")).select("m.*")))
    passed = [p for p, q in posterior.items() if q >= 0.5]
    m = F.col("__m")
    failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    return measured.where(~failed & m["pattern"].isin(passed)).select(*columns)
