import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from tempestry.llm import lexical
from tempestry.llm.common import ship
from tempestry.llm.queries import QUERIES, SQL
from tests.llm.cases import SF, awkward, documents, empty, prose
from tests.oracle import compare, connect

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def slow_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow_search(docs, items, k=10):
    counted = [(i, Counter(t)) for i, t in ((i, slow_terms(x)) for i, x in docs) if t]
    n_all, l_all = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            m = 100 - 90 + 90 * sum(c.values()) * n_all // l_all
            score = 0
            for t in set(slow_terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return out


def items_table(spark, rows):
    rows = [(*r, 7, 9, "t") for r in rows]
    return spark.createDataFrame(rows, "item_id long, text string, score long, rank int, term string")


def as_set(df):
    return Counter(map(tuple, df.collect()))


def test_sql(spark):
    assert compare(QUERIES["op13_rmq_search"](spark, SF), connect(SF), SQL["op13_rmq_search"]) > 0


def test_awkward_documents_and_items(spark):
    ship(spark)
    docs = awkward(spark)
    long = prose(5, 30_000, 900)
    items = [(1, prose(1, 40)), (2, None), (2, ""), (None, "ONE two"), (3, "\0 !"), (4, "ünïcödé WÖRDS  "), (5, "nowhere"),
             (6, long), (1, "more alone"), (1, "more alone")]
    want = Counter(slow_search([(r.doc_id, r.text) for r in docs.collect()], items))
    for size in (3, 2048):
        found = lexical.search(docs, items_table(spark, items), bucket_docs=size)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert as_set(found) == want
    assert want


def test_ties_across_buckets_stand_by_id(spark):
    ship(spark)
    docs = documents(spark, [(i, "same words here") for i in range(60, 0, -1)] + [(99, "other words")] * 30)
    items = items_table(spark, [(1, "same"), (2, "words")])
    for size in (4, 1000):
        found = [tuple(r) for r in lexical.search(docs, items, bucket_docs=size).collect()]
        assert sorted(r[:3] for r in found if r[0] == 1) == [(1, i, i) for i in range(1, 11)]
        assert sorted(found) == sorted(slow_search([(r.doc_id, r.text) for r in docs.collect()], [(1, "same"), (2, "words")]))


def test_empty_tables(spark):
    ship(spark)
    items = items_table(spark, [(1, "x")])
    assert lexical.search(empty(spark), items).count() == 0
    assert lexical.search(documents(spark, [(1, "x")]), items.limit(0)).count() == 0


def test_ranges_and_best_first_search_against_all_documents():
    r = random.Random(3)
    for trial in range(30):
        n_docs, n_terms = r.randint(1, 400), r.randint(1, 12)
        held = sorted({(r.randrange(n_terms), r.randrange(n_docs)) for _ in range(r.randint(1, 1500))}, key=lambda _: r.random())
        impacts = np.array([r.choice((r.randint(1, 9), r.randint(1, 10**6))) for _ in held])
        terms = pa.array([b"t%d" % t for t, _ in held], type=pa.binary())
        index = lexical.Postings(terms, np.array([d for _, d in held]), impacts, n_docs)
        order = sorted(range(len(held)), key=lambda i: (index.code[b"t%d" % held[i][0]], held[i][1]))
        in_order = impacts[order]
        for _ in range(20):
            lo = r.randrange(len(held))
            run = [i for i in range(lo, len(held)) if held[order[i]][0] == held[order[lo]][0]]
            hi = r.choice(run) + 1
            assert in_order[index.largest(np.array([lo]), np.array([hi]))[0]] == in_order[lo:hi].max()
        asked = [(b"t%d" % t, r.randint(0, 50)) for t in range(n_terms + 2)]
        weight, total = dict(asked), Counter()
        for (t, d), i in zip(held, impacts):
            total[d] += int(i) * weight[b"t%d" % t]
        want = sorted(((s, d) for d, s in total.items() if s > 0), key=lambda x: (-x[0], x[1]))[:10]
        best, _ = index.search(*zip(*asked), 10, batch=r.choice((1, 7, 128)))
        assert best == want


def test_documents_that_cannot_win_are_not_scored():
    n = 5000
    docs = np.arange(n)
    terms = pa.array([b"a"] * n + [b"b"] * 20, type=pa.binary())
    impacts = np.concatenate([np.full(n, 5), np.full(20, 1000)])
    index = lexical.Postings(terms, np.concatenate([docs, docs[:2000:100]]), impacts, n)
    best, seen = index.search([b"a", b"b"], [1, 3], 10, batch=4)
    assert best == [(3005, i * 100) for i in range(10)] and seen < 200
