import random

from tempestry.llm import mixing
from tests.llm.cases import SF, awkward, documents, empty
from tests.oracle import compare, connect
from tempestry.llm.queries import QUERIES, SQL


def test_sql(spark):
    assert compare(QUERIES["op10_source_mix"](spark, SF), connect(SF), SQL["op10_source_mix"]) > 0


def slow_targets(sizes, weights=(1, 2, 3), epochs=3):
    """Shares by weight, stopped and reshared until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        shares = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if shares[s] > epochs * sizes[s]]
        if not over:
            return {**fixed, **shares}
        fixed |= {s: epochs * sizes[s] for s in over}


def check(spark, docs):
    got = mixing.mix_sources(docs).collect()
    assert len(got) == docs.count()
    source = {}
    for r in docs.collect():
        source.setdefault((r.doc_id, len((r.text or "").encode().split())), set()).add(r.source)
    sizes = {}
    for r in docs.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len((r.text or "").encode().split())
    targets = slow_targets(sizes)
    assert {round(r.target, 6) for r in got} == {round(t, 6) for t in targets.values()}
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    taken = sum(r.taken for r in got)
    assert abs(taken - sum(sizes.values())) <= 2 * len(sizes) + 3
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs).collect()))


def test_targets_and_sums(spark):
    r = random.Random(1)
    rows = [(i, "w " * r.randint(0, 40), f"s{min(i % 50, 6)}") for i in range(400)]
    check(spark, documents(spark, rows))
    check(spark, awkward(spark))
    assert mixing.mix_sources(empty(spark)).count() == 0


def test_all_sources_without_words(spark):
    got = mixing.mix_sources(documents(spark, [(1, "", "a"), (2, None, "b")])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2


def test_documents_stand_in_the_mix_as_often_as_they_are_taken(spark):
    r = random.Random(2)
    rows = [(i, " ".join(f" w{i}x{k}\n" for k in range(r.randint(0, 30))), "abc"[min(i % 9, 2)]) for i in range(60)]
    docs = documents(spark, rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    words, texts = {}, dict((d, t) for d, t, _ in rows)
    for m in mixed.collect():
        assert texts[m.doc_id].startswith(m.text) and m.n_chars == len(m.text)
        words[m.doc_id] = words.get(m.doc_id, 0) + len(m.text.split())
    taken = {t.doc_id: t.taken for t in mixing.mix_sources(docs).collect() if t.taken}
    assert words == taken
    assert mixing.mixed_documents(empty(spark)).count() == 0
    assert mixing.mixed_documents(awkward(spark)).count() > 0
