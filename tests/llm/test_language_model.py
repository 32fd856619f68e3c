import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tempestry.llm import language_model
from tests.llm.cases import SF, awkward, documents, empty, prose


def tokens_of(text):
    return (text or "").encode().lower().split() + ["</s>"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def discount(counts, k):
    n = [sum(c == i for c in counts) for i in range(5)]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    defaults = {1: 0.5, 2: 1.0, 3: 1.5}
    out = {0: 0.0}
    for i in (1, 2, 3):
        d = i - (i + 1) * y * n[i + 1] / n[i] if n[i] and n[i + 1] else defaults[i]
        out[i] = min(max(d, 0.05), i - 0.05)
    return out[min(k, 3)]


class Slow:
    """The model from dictionaries."""

    def __init__(self, texts):
        self.pairs, self.words = Counter(), Counter()
        for t in texts:
            first = "<s>"
            for w in tokens_of(t):
                self.pairs[first, w] += 1
                self.words[w] += 1
                first = w
        self.before, self.after, self.total = Counter(), defaultdict(list), Counter()
        for (u, w), c in self.pairs.items():
            self.before[w] += 1
            self.after[u].append(c)
            self.total[u] += c
        high, low = Counter(self.pairs.values()), Counter(self.before.values())
        self.high = {k: discount(list(high.elements()), k) for k in range(4)}
        self.low = {k: discount(list(low.elements()), k) for k in range(4)}

    def probability(self, u, w):
        n = len(self.pairs)
        floor = sum(self.low[min(c, 3)] for c in self.before.values()) / n / (len(self.words) + 1) if n else 1.0
        low = floor + (max(self.before[w] - self.low[min(self.before[w], 3)], 0) / n if n else 0)
        if u not in self.total:
            return low
        c = self.pairs[u, w]
        rest = sum(self.high[min(x, 3)] for x in self.after[u])
        return (max(c - self.high[min(c, 3)], 0) + rest * low) / self.total[u]


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    slow = Slow([t for d, t in rows if not held(d)])
    n, v = sum(slow.words.values()), len(slow.words)
    got = language_model.score_documents(docs).collect()
    want = []
    for d, t in rows:
        words = tokens_of(t)
        base = sum(math.log10((slow.words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        score = sum(math.log10(slow.probability(u, w)) for u, w in zip(["<s>"] + words, words))
        want.append((d, held(d), len(words), sum(slow.words[w] > 0 for w in words), n, base, score))
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 4))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert np.allclose(a[5:], b[5:], rtol=1e-9)
    return got


def test_awkward_rows(spark):
    check(awkward(spark))
    assert language_model.score_documents(empty(spark)).count() == 0
    check(documents(spark, [(None, "held out only"), (None, None)]))


def test_tables_and_held_out_texts(spark):
    got = check(spark.read.parquet(f"{SF}/documents.parquet"))
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_probabilities_add_up_to_one(spark):
    docs = documents(spark, [(i, prose(i, 50, 12)) for i in range(40)])
    slow = Slow([r.text for r in docs.collect() if not held(r.doc_id)])
    words = [*slow.words, b"never seen"]
    for u in [*list(slow.total)[:5], b"nor this"]:
        assert abs(sum(slow.probability(u, w) for w in words) - 1) < 1e-9


@pytest.mark.parametrize("n", [1, 7])
def test_number_of_shards_changes_nothing(spark, n):
    from pyspark.sql import functions as F

    from tempestry.session import Scratch

    docs = documents(spark, [(i, prose(i, 200, 90)) for i in range(20)]).select(F.col("text").cast("binary").alias("text"))
    model = language_model.train(docs, Scratch(spark), n)
    slow = Slow([bytes(r.text).decode() for r in docs.collect()])
    pairs = [p for p in slow.pairs if p[0] != "<s>" and p[1] != "</s>"][:200]
    hashes = [language_model.word_hashes(b" ".join(p))[:2] for p in pairs]
    first, second = (np.array(x, np.uint64) for x in zip(*hashes))
    count, probability = model.probabilities(first, second)
    assert count.tolist() == [slow.words[w] for _, w in pairs]
    assert np.allclose(probability, [slow.probability(*p) for p in pairs])


def test_shared_folder_must_be_mounted():
    assert language_model.folder_of("file:///a/b") == language_model.folder_of("/a/b") == "/a/b"
    with pytest.raises(ValueError, match="mounted"):
        language_model.folder_of("hdfs://x/a")


def test_arrays_that_a_worker_does_not_see_are_an_error(spark, tmp_path):
    from pyspark.sql import functions as F

    from tempestry.session import Scratch

    docs = documents(spark, [(i, prose(i, 50, 9)) for i in range(5)]).select(F.col("text").cast("binary").alias("text"))
    model = language_model.train(docs, Scratch(spark), 2)
    words = language_model.word_hashes(prose(1, 50, 9).encode())
    assert model.words(np.unique(words))[:, 0].sum() > 0
    model = language_model.train(docs, Scratch(spark), 2)
    model.folder = str(tmp_path)  # not mounted here
    with pytest.raises(FileNotFoundError):
        model.words(np.unique(words))
