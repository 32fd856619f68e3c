import random
from collections import defaultdict

import pytest
import xxhash

from tempestry.llm import simhash
from tempestry.session import Scratch
from tests.llm.cases import SF, awkward, documents, empty, prose


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * ones[bit] > len(shingles))


def slow_groups(rows, radius=2):
    prints = [(d, slow_fingerprint(t)) for d, t in rows]
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, row in enumerate(prints):
        groups[root(i)].append(row)
    return list(groups.values())


def slow_components(rows):
    out = []
    for group in slow_groups(rows):
        least = min((d for d, _ in group if d is not None), default=None)
        out += [(d, f"{p:016x}", least) for d, p in group]
    return sorted(out, key=str)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == slow_components(rows)


def test_tables(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_awkward_rows(spark):
    check(awkward(spark))
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_edits_near_and_far(spark):
    base, r = prose(3, 900, 300).split(), random.Random(1)
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(i % 6):
            words[r.randrange(len(words))] = f"edit{i}"
        rows.append((1000 - i, " ".join(words)))
    check(documents(spark, rows))


@pytest.mark.parametrize("shard_size, block_size", [(3, 16_384), (3, 5), (50, 7), (4096, 16_384)])
def test_links_find_all_pairs_in_shards_of_any_size(spark, shard_size, block_size):
    r = random.Random(4)
    centre = r.getrandbits(64)
    values = {centre ^ sum(1 << b for b in r.sample(range(64), k)) for k in (0, 1, 1, 2, 2, 3, 5) for _ in range(12)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "print long")
    stars = simhash.star_components(simhash.near_links(df, 2, shard_size, block_size), Scratch(spark)).collect()
    root = {r.a: r.b for r in stars}
    forest = simhash.Forest()
    for a in signed:
        for b in signed:
            if ((a ^ b) & simhash._MASK).bit_count() <= 2:
                forest.join(a, b)
    assert {v: root.get(v, v) for v in signed} == {v: forest.root(v) for v in signed}


def test_bk_tree_follows_edges_within_the_radius():
    r = random.Random(2)
    values = [r.getrandbits(64) for _ in range(300)]
    values += [v ^ (1 << r.randrange(64)) for v in values]
    tree = simhash.BKTree(values)
    for v in values[::17]:
        assert sorted(tree.within(v, 2)) == sorted({w for w in values if (v ^ w).bit_count() <= 2})


def test_star_components_of_long_chains(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(200, 199), (205, 200)], "a long, b long")
    got = {r.a: r.b for r in simhash.star_components(edges, Scratch(spark)).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 199, 205: 199}


def test_one_of_each(spark):
    docs = awkward(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = slow_groups([(r.doc_id, r.text) for r in docs.collect()])
    least = [min((d for d, _ in g if d is not None), default=None) for g in groups]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, least))
