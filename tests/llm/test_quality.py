import random
from collections import Counter

import duckdb
import pytest

from tempestry.llm import quality
from tempestry.session import Scratch
from tests.llm.cases import SF, awkward, documents, empty, prose


def slow_base(text):
    text = text or ""
    words = text.encode().split()
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.encode().split(b"\n") if x.split()]
    n = len(words)
    return (
        n,
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


@pytest.mark.parametrize("make", [awkward, lambda spark: spark.read.parquet(f"{SF}/documents.parquet")])
def test_base_counts(spark, make):
    docs = make(spark)
    got = quality.rate_documents(docs, Scratch(spark)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = sorted(((r.doc_id, *slow_base(r.text)) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, *(r[n] for n in names)) for r in got), key=str) == want
    assert not any(r.kept for r in got if r.base_failed)


def test_no_rows(spark):
    assert quality.rate_documents(empty(spark), Scratch(spark)).count() == 0
    assert quality.good_documents(empty(spark)).count() == 0


def test_filter_keeps_the_same_documents(spark):
    docs = awkward(spark)
    kept = quality.good_documents(docs)
    assert kept.columns == docs.columns
    rated = quality.rate_documents(docs, Scratch(spark)).where("kept")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in rated.collect())


def test_labelled_documents(spark):
    """No labels are used to fit; they measure the verdicts."""
    sf = "/root/testdata/sf0.01"
    rated = quality.rate_documents(spark.read.parquet(f"{sf}/documents.parquet"), Scratch(spark))
    kept = {r.doc_id: (r.kept, r.base_failed) for r in rated.collect()}
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").fetchall()
    judged = [(q, kept[d][0]) for d, q in labels if not kept[d][1]]
    assert sum(k for q, k in judged if q) >= 0.98 * sum(q for q, _ in judged)
    assert sum(not k for q, k in judged if not q) >= 0.8 * sum(not q for q, _ in judged)


def test_expectation_maximisation_finds_accurate_rules():
    r = random.Random(0)
    accuracy = [0.95, 0.9, 0.9, 0.85, 0.6, 0.8, 0.9, 0.75]
    counts, truth = Counter(), {}
    for _ in range(20_000):
        good = r.random() < 0.8
        votes = [0 if r.random() < 0.3 else 1 if (r.random() < a) == good else 2 for a in accuracy]
        pattern = sum(v * 3**j for j, v in enumerate(votes))
        counts[pattern] += 1
        truth.setdefault(pattern, []).append(good)
    posterior = quality.fit(counts)
    right = sum(sum(g == (posterior[p] >= 0.5) for g in good) for p, good in truth.items())
    assert right >= 0.93 * 20_000


def test_fit_of_agreeing_documents_keeps_them():
    assert all(q > 0.9 for q in quality.fit({sum(3**j for j in range(8)): 1000}).values())
    assert quality.fit({}) == {}


def test_one_doubtful_vote_among_many_good_ones_is_outvoted(spark):
    docs = documents(spark, [(i, prose(i, 200, 150)) for i in range(30)] + [(99, "|" .join(["junk!!! ###"] * 5) + " SHOUT! ### %%%" * 60)])
    kept = {r.doc_id for r in quality.good_documents(docs).collect()}
    assert kept == set(range(30))


def _pattern(votes):
    return sum(v * 3**j for j, v in enumerate(votes))


def test_the_share_of_good_documents_may_be_small():
    """Rules of known accuracy over documents of which most are junk: nearly all are told apart."""
    r = random.Random(9)
    for share in (0.05, 0.2, 0.5, 0.9):
        counts, truth = Counter(), Counter()
        for _ in range(20_000):
            is_good = r.random() < share
            votes = [0 if r.random() < 0.2 else 1 if r.random() < (0.95 if is_good else 0.3) else 2 for _ in quality.RULES]
            counts[_pattern(votes)] += 1
            truth[_pattern(votes), is_good] += 1
        posterior = quality.fit(counts)
        wrong = sum(n for (p, is_good), n in truth.items() if (posterior[p] >= 0.5) != is_good)
        assert wrong < 0.05 * 20_000, share
        assert abs(sum(posterior[p] * n for p, n in counts.items()) / 20_000 - share) < 0.04
