import random
import time

import pyarrow as pa

from tempestry.llm.common import groups_of


def batches(rows, size):
    table = pa.table({"k": pa.array([r[0] for r in rows], pa.int64()), "b": pa.array([r[1] for r in rows], pa.binary()),
                      "v": pa.array(range(len(rows)), pa.int64())})
    return table.to_batches(max_chunksize=size)


def test_groups_stay_whole_and_rows_in_order():
    r = random.Random(1)
    for _ in range(200):
        rows = sorted(((r.choice([None, 0, 1, 2]), r.choice([None, b"", b"x", b"xy"])) for _ in range(r.randint(0, 40))), key=str)
        tables = list(groups_of([*batches(rows, r.randint(1, 9)), *batches([], 1)], ("k", "b")))
        assert [v for t in tables for v in t.column("v").to_pylist()] == list(range(len(rows)))
        keys = [set(zip(t.column("k").to_pylist(), t.column("b").to_pylist())) for t in tables]
        assert all(not a & b for i, a in enumerate(keys) for b in keys[i + 1 :])


def test_one_large_group_takes_seconds():
    rows = [(0, b"k")] * 100_000 + [(i, b"k") for i in range(1, 200_001)]
    start = time.time()
    assert sum(t.num_rows for t in groups_of(batches(rows, 1000), ("k", "b"))) == 300_000
    assert time.time() - start < 10
