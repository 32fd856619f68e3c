"""Approximate nearest neighbours on graphs built by NN-descent.

Equal vectors are one node. Nodes are dealt by hash into cells of bounded size, and each
cell's graph starts from random neighbours. A round joins the neighbour lists, both ways,
with the lists of the neighbours, and every node keeps the nearest of these neighbours of
neighbours. Queries, in blocks, search every cell's graph greedily from a few entry
points with a pool of the best nodes found; the cells' answers are merged.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempestry.session import Scratch

#: Nodes of a cell, neighbours kept by a node, rounds of the descent.
CELL, DEGREE, ROUNDS = 8192, 16, 5
#: Nodes that a search keeps in its pool, expands at once, and enters at.
POOL, STEP, ENTRIES = 192, 8, 32
#: Queries that search a cell together.
QUERY_BLOCK = 2048


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` of the rows that take part, as arrays of doubles.

    Left out are null ids and vectors that are null, all zero, or hold a null or
    non-finite component, or whose length is not the most frequent one. An id that
    stands on several rows counts once, with the smallest of its vectors.
    """
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = (
        vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
        .where("vec_id is not null and embedding is not null")
        .where(finite & F.exists("embedding", lambda x: x != 0))
    )
    lengths = rows.groupBy(F.size("embedding").alias("n")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("n")).first()
    if common is not None:
        rows = rows.where(F.size("embedding") == common["n"])
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _matrix(data, n):
    return np.frombuffer(data, dtype=np.float64).reshape(n, -1)


def _pack(frame: pd.DataFrame) -> pd.DataFrame:
    """One row per cell: node ids and vectors in the order of their place."""
    frame = frame.sort_values("place")
    return pd.DataFrame(
        {
            "cell": [frame["cell"].iloc[0]],
            "n": [len(frame)],
            "nodes": [frame["node"].to_numpy(np.int64).tobytes()],
            "vectors": [np.stack(frame["embedding"].to_list()).astype(np.float64).tobytes()],
        }
    )


def _nearness(matrix, longest):
    """Vectors scaled and lifted so that the largest inner product is the nearest direction."""
    x = matrix / longest
    lift = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
    return np.concatenate([x, lift[:, None]], axis=1).astype(np.float32)


def _keep_nearest(degree, longest):
    def keep(candidates: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        if not len(cells) or not len(candidates):
            return pd.DataFrame({"cell": [], "place": [], "near": pd.Series([], dtype=object)})
        points = _nearness(_matrix(cells["vectors"].iloc[0], int(cells["n"].iloc[0])), longest)
        near = []
        for place, lists in zip(candidates["place"], candidates["candidates"]):
            found = np.unique(np.asarray(lists, dtype=np.int64))
            found = found[found != place]
            score = points[found] @ points[place]
            if len(found) > degree:
                best = np.argpartition(-score, degree - 1)[:degree]
                found, score = found[best], score[best]
            near.append(found[np.lexsort((found, -score))].astype(np.int32))
        return pd.DataFrame({"cell": candidates["cell"], "place": candidates["place"], "near": near})

    return keep


def build_graph(nodes: DataFrame, scratch: Scratch, cell=CELL, degree=DEGREE, rounds=ROUNDS):
    """``(cells, graph)`` of ``nodes`` (node, embedding), both written tables.

    cells: cell, n, nodes, vectors (packed). graph: cell, place, near.
    """
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))
    count, longest = nodes.agg(F.count("*"), F.max(norm)).first()
    cells_n = max(1, -(-count // cell))
    in_cell = nodes.withColumn("cell", F.pmod(F.xxhash64("node"), F.lit(cells_n)).cast("int"))
    order = Window.partitionBy("cell").orderBy("node")  # a cell is bounded
    placed = scratch.save(in_cell.withColumn("place", F.row_number().over(order) - 1), "placed")
    cells = scratch.save(
        placed.groupBy("cell").applyInPandas(_pack, "cell int, n int, nodes binary, vectors binary"), "cells"
    )
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"))
    graph = placed.join(sizes, "cell").select(
        "cell",
        "place",
        F.transform(
            F.sequence(F.lit(1), F.lit(degree)),
            lambda j: F.pmod(F.xxhash64("node", j), F.col("n")).cast("int"),
        ).alias("near"),
    )
    graph = scratch.save(graph, "graph-0")
    keep = _keep_nearest(degree, longest or 1.0)
    for turn in range(1, rounds + 1):
        # both ways; of those that name a node only a sample as large as its own list
        back = graph.select("cell", F.explode("near").alias("to"), F.col("place").alias("by"))
        back = back.groupBy("cell", "to").agg(F.collect_set("by").alias("by"))
        mixed = F.array_sort(
            F.transform("by", lambda x: F.struct(F.xxhash64(x, F.lit(turn)).alias("h"), x.alias("x")))
        )
        back = back.select(
            "cell", F.col("to").alias("place"), F.transform(F.slice(mixed, 1, degree), lambda s: s["x"]).alias("back")
        )
        both = graph.join(back, ["cell", "place"], "left").select(
            "cell", "place", F.array_union("near", F.coalesce("back", F.array().cast("array<int>"))).alias("near")
        )
        both = scratch.save(both, f"both-{turn}")
        steps = both.select("cell", "place", F.explode("near").alias("via"))
        beyond = both.select("cell", F.col("place").alias("via"), F.col("near").alias("beyond"))
        candidates = (
            steps.join(beyond, ["cell", "via"])
            .groupBy("cell", "place")
            .agg(F.array_union(F.collect_set("via"), F.flatten(F.collect_list("beyond"))).alias("candidates"))
        )
        graph = scratch.save(
            candidates.groupBy("cell")
            .cogroup(cells.groupBy("cell"))
            .applyInPandas(keep, "cell int, place int, near array<int>"),
            f"graph-{turn}",
        )
        scratch.drop(f"graph-{turn - 1}", f"both-{turn}")
    return cells, graph


def greedy_search(points, graph, queries, entries, pool=POOL, step=STEP):
    """For each query the places of the ``pool`` best nodes found, best first, -1 for none.

    ``graph`` has a row of neighbours for each node. All queries advance together: each
    expands the best ``step`` nodes of its pool that it has not expanded yet, until
    none is left.
    """
    n, count = len(points), len(queries)
    seen = np.zeros((count, n), dtype=bool)
    ids = np.full((count, pool), -1, dtype=np.int64)
    scores = np.full((count, pool), -np.inf, dtype=np.float32)
    open_ = np.zeros((count, pool), dtype=bool)

    def insert(codes):
        codes = np.unique(codes)
        codes = codes[~seen.ravel()[codes]]
        if not len(codes):
            return
        seen.ravel()[codes] = True
        row, place = codes // n, codes % n
        score = np.einsum("ij,ij->i", queries[row], points[place])
        rows, first, number = np.unique(row, return_index=True, return_counts=True)
        column = np.arange(len(row)) - np.repeat(first, number)
        slot = np.repeat(np.arange(len(rows)), number)
        more = number.max()
        new_ids = np.full((len(rows), more), -1, dtype=np.int64)
        new_scores = np.full((len(rows), more), -np.inf, dtype=np.float32)
        new_ids[slot, column], new_scores[slot, column] = place, score
        all_ids = np.concatenate([ids[rows], new_ids], axis=1)
        all_scores = np.concatenate([scores[rows], new_scores], axis=1)
        all_open = np.concatenate([open_[rows], new_ids >= 0], axis=1)
        best = np.argsort(-all_scores, axis=1, kind="stable")[:, :pool]
        ids[rows] = np.take_along_axis(all_ids, best, axis=1)
        scores[rows] = np.take_along_axis(all_scores, best, axis=1)
        open_[rows] = np.take_along_axis(all_open, best, axis=1)

    everyone = np.arange(count)[:, None] * n
    insert((everyone + np.asarray(entries)[None, :]).ravel())
    while True:
        rank = np.cumsum(open_, axis=1)
        chosen = open_ & (rank <= step)
        row, column = np.nonzero(chosen)
        if not len(row):
            return ids, scores
        open_[row, column] = False
        near = graph[ids[row, column]]
        codes = (row[:, None] * n + near)[near >= 0]
        if len(codes):
            insert(codes)


def _search(k, pool, step, entries):
    def search(queries: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "node": [], "score": []}
        if len(queries) and len(cells):
            n = int(cells["n"].iloc[0])
            exact = _matrix(cells["vectors"].iloc[0], n)
            nodes = np.frombuffer(cells["nodes"].iloc[0], dtype=np.int64)
            graph = np.frombuffer(cells["graph"].iloc[0], dtype=np.int32).reshape(n, -1)
            scale = max(np.sqrt((exact * exact).sum(axis=1)).max(), 1e-300)
            points = (exact / scale).astype(np.float32)
            asked = np.stack(queries["embedding"].to_list()).astype(np.float64)
            size = np.sqrt((asked * asked).sum(axis=1, keepdims=True))
            enter = np.unique(np.linspace(0, n - 1, min(entries, n)).astype(np.int64))
            keys = queries["query_id"].to_numpy()
            for at in range(0, len(keys), 256):
                part = slice(at, at + 256)
                found, _ = greedy_search(points, graph, (asked[part] / size[part]).astype(np.float32), enter, pool, step)
                row, column = np.nonzero(found >= 0)
                place = found[row, column]
                score = (exact[place] * asked[part][row]).sum(axis=1)
                sort = np.lexsort((nodes[place], -score, row))
                row, place, score = row[sort], place[sort], score[sort]
                rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
                keep = rank <= k
                out["query_id"].append(keys[part][row[keep]])
                out["node"].append(nodes[place[keep]])
                out["score"].append(score[keep])
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in out.items()})

    return search


def _pack_graph(degree):
    def pack(cells: pd.DataFrame, graph: pd.DataFrame) -> pd.DataFrame:
        out = np.full((int(cells["n"].iloc[0]), 2 * degree), -1, dtype=np.int32)
        for place, near in zip(graph["place"], graph["near"]):
            out[place, : len(near)] = near
        return cells.assign(graph=[out.tobytes()])

    return pack


def _both_ways(graph, degree):
    """The lists of the graph with up to as many of the nodes that name each node."""
    back = graph.select("cell", F.explode("near").alias("place"), F.col("place").alias("by"))
    back = back.groupBy("cell", "place").agg(F.slice(F.array_sort(F.collect_set("by")), 1, 4 * degree).alias("by"))
    return graph.join(back, ["cell", "place"], "left").select(
        "cell",
        "place",
        F.slice(F.array_union("near", F.coalesce("by", F.array().cast("array<int>"))), 1, 2 * degree).alias("near"),
    )


def nearest(
    vectors: DataFrame, every=20, k=20, cell=CELL, degree=DEGREE, rounds=ROUNDS, pool=POOL, step=STEP, entries=ENTRIES
) -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank, vec_id, score.

    Queries are the vectors whose id is divisible by ``every``, candidates all others;
    nearness is the inner product in double precision, ties go to the smaller id. Which
    rows take part says ``usable``; other columns are ignored. With fewer candidates
    than ``k`` a query gets all that the search finds. No usable rows give no rows.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.save(usable(vectors), "rows")
    nodes = scratch.save(rows.groupBy("embedding").agg(F.min("vec_id").alias("node")), "nodes")
    # of equal vectors a query can use its own row's neighbours: k + 1 ids at most
    twin = Window.partitionBy("node").orderBy("vec_id")
    members = scratch.save(
        rows.join(nodes, "embedding")
        .select("node", "vec_id", F.row_number().over(twin).alias("nth"))
        .where(F.col("nth") <= k + 1)
        .drop("nth"),
        "members",
    )
    cells, graph = build_graph(nodes, scratch, cell, degree, rounds)
    packed = (
        cells.groupBy("cell")
        .cogroup(_both_ways(graph, degree).groupBy("cell"))
        .applyInPandas(_pack_graph(degree), "cell int, n int, nodes binary, vectors binary, graph binary")
    )
    packed = scratch.save(packed, "packed")
    queries = scratch.save(
        rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "embedding"), "queries"
    )
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    cells_n = max(1, -(-nodes.count() // cell))
    asked = queries.select(
        "*",
        F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(cells_n - 1))).alias("cell"),
    )
    offered = packed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (
        asked.groupBy("cell", "block")
        .cogroup(offered.groupBy("cell", "block"))
        .applyInPandas(_search(k, pool, step, entries), "query_id long, node long, score double")
    )
    by_node = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
    best = found.select("*", F.row_number().over(by_node).alias("nth")).where(F.col("nth") <= k + 1)
    by_row = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.join(members, "node")
        .where("vec_id <> query_id")
        .select("query_id", F.row_number().over(by_row).alias("rank"), "vec_id", "score")
        .where(F.col("rank") <= k)
    )
