import numpy as np

from tempestry.llm import neighbours
from tests.llm.cases import SF

NAN, INF = float("nan"), float("inf")


def exact(rows, every=20, k=20):
    rows = sorted({i: v for i, v in rows}.items())
    ids, points = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for i, v in rows:
        if i % every == 0:
            score = points @ np.array(v, dtype=np.float64)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def recall(got, want, k=20):
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(found.get(q, set()) & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(len(w) for w in want.values())


def check_order(got, rows):
    points = dict(rows)
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, found in by_query.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, len(found) + 1))
        assert len({f[1] for f in found}) == len(found) and q not in {f[1] for f in found}
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        for _, i, score in found:
            assert np.isclose(score, np.dot(np.float64(points[q]), np.float64(points[i])), rtol=1e-12)


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = neighbours.nearest(table).collect()
    check_order(got, rows)
    assert recall(got, exact(rows)) >= 0.95


def test_several_cells_blocks_and_lengths(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 30)
    r = np.random.default_rng(1)
    points = r.normal(size=(2500, 16)) * r.uniform(0.5, 2, size=(2500, 1))
    rows = [(i, p.tolist()) for i, p in enumerate(points.astype(np.float32))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = neighbours.nearest(table, cell=700, rounds=3).collect()
    check_order(got, rows)
    assert recall(got, exact(rows)) >= 0.9


def test_equal_vectors_and_rows_that_take_no_part(spark):
    r = np.random.default_rng(2)
    hot = [1.0, 0.5, 0.25]
    rows = [(i, hot) for i in range(100)] + [(100 + i, r.normal(size=3).astype(np.float32).tolist()) for i in range(60)]
    bad = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 0.0]), (260, [NAN, 1.0, 1.0]), (280, [INF, 1.0, 1.0]),
           (300, []), (320, [1.0]), (None, [1.0, 1.0, 1.0])]
    full = [(i, v, 1, 1.0, 2) for i, v in rows + bad + rows[:5]]
    table = spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, score double, node long")
    got = neighbours.nearest(table, rounds=2).collect()
    check_order(got, rows)
    want = exact(rows)
    assert {r.query_id for r in got} == set(want)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got if r.query_id < 100) == sorted(
        (q, k, i) for q, w in want.items() if q < 100 for k, (i, _) in enumerate(w, 1)
    )


def test_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert neighbours.nearest(spark.createDataFrame([], schema), rounds=1).count() == 0
    assert neighbours.nearest(spark.createDataFrame([(0, [1.0], 1)], schema), rounds=1).count() == 0
    got = neighbours.nearest(spark.createDataFrame([(0, [1.0], 1), (1, [2.0], 1), (2, [-1.0], 1)], schema), rounds=1).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 2.0), (0, 2, 2, -1.0)]
