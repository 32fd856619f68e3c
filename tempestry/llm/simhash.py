"""SimHash near-duplicates through BK-trees.

Fingerprints within the radius agree on at least two of ``radius + 2`` blocks of their
bits, so each pair of blocks is a key under which near fingerprints meet. The distinct
fingerprints of a key are cut into shards of bounded size; each shard becomes a BK-tree,
whose children are keyed by their Hamming distance to the parent, and is sent to the
fingerprints of its key, which follow only the edges within the radius. Links leave a
shard as a spanning forest, and star contraction joins them into components.
"""

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf
from pyspark.sql.types import LongType

from tempestry.llm.common import bytes_of, emit, groups_of
from tempestry.session import Scratch

BITS = 64


def fingerprint(text: bytes, words=3) -> int:
    """SimHash of the shingles of a text, as an unsigned number; 0 where it has no word."""
    parts = text.lower().split()
    n = len(parts)
    if not n:
        return 0
    joined = b" ".join(parts)
    if n <= words:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        lengths = np.fromiter(map(len, parts), np.int64, n) + 1
        ends = np.cumsum(lengths) - 1
        starts = (ends - lengths + 1)[: n - words + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[words - 1 :].tolist())]
    h = np.array(hashes, dtype=np.uint64)
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


@pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    prints = np.array([fingerprint(bytes(t)) for t in texts], dtype=np.uint64)
    return pd.Series(prints.view(np.int64), index=texts.index)


class BKTree:
    """Values at edges labelled with their Hamming distance to the parent."""

    def __init__(self, values=()):
        self.values, self.children = [], []
        for v in values:
            self.add(v)

    def add(self, value):
        at = 0 if self.values else -1
        while at >= 0:
            distance = (self.values[at] ^ value).bit_count()
            if not distance:
                return
            below = self.children[at].get(distance, -1)
            if below < 0:
                self.children[at][distance] = len(self.values)
            at = below
        self.values.append(value)
        self.children.append({})

    def within(self, value, radius):
        """The stored values at most ``radius`` bits away."""
        out, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            distance = (self.values[at] ^ value).bit_count()
            if distance <= radius:
                out.append(self.values[at])
            for label, child in self.children[at].items():
                if distance - radius <= label <= distance + radius:
                    todo.append(child)
        return out


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self):
        self.parent = {}

    def root(self, x):
        path = []
        while (up := self.parent.setdefault(x, x)) != x:
            path.append(x)
            x = up
        for p in path:
            self.parent[p] = x
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])
_MASK = (1 << BITS) - 1
_GROUP = ("key", "shard", "block")
#: A fingerprint in a group stands in its tree and asks it, only asks, or only stands in it.
_BOTH, _ASKS, _STORED = range(3)


def _tree_links(radius):
    def links(batches):
        for table in groups_of(batches, _GROUP):
            groups = [np.array(table.column(c)) for c in _GROUP]
            prints, role = np.array(table.column("print")), np.array(table.column("role"))
            cut = np.flatnonzero(np.any([g[1:] != g[:-1] for g in groups], axis=0)) + 1
            bounds = [0, *cut.tolist(), len(prints)]
            out_a, out_b = [], []
            for a, b in zip(bounds, bounds[1:]):
                members = prints[a:b][role[a:b] != _ASKS].tolist()
                tree, forest = BKTree(v & _MASK for v in members), Forest()
                signed = {v & _MASK: v for v in members}
                for v in prints[a:b][role[a:b] != _STORED].tolist():
                    for near in tree.within(v & _MASK, radius):
                        forest.join(v, signed[near])
                for v in list(forest.parent):
                    if (root := forest.root(v)) != v:
                        out_a.append(v)
                        out_b.append(root)
            yield emit(_EDGE, a=out_a, b=out_b)

    return links


def near_links(prints: DataFrame, radius=2, shard_size=4096, block_size=16_384) -> DataFrame:
    """Edges ``(a, b)``, b < a, that connect all fingerprints within ``radius`` bits.

    ``prints`` holds distinct values in the column ``print``. Two values that differ in
    at most ``radius`` bits are connected, though maybe not by an edge of their own.

    The fingerprints of a key make shards, and each asks its own shard and those after it:
    of two the one in the earlier shard finds the other. Those that ask are dealt into
    blocks, so a group holds about ``shard_size`` values in a tree and ``block_size`` that ask it,
    however many fingerprints share the key.
    """
    blocks = radius + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    value = F.col("print")

    def block(i):
        width = edges[i + 1] - edges[i]
        return F.shiftrightunsigned(value, edges[i]).bitwiseAND((1 << width) - 1)

    keys = [
        F.xxhash64(F.lit(i * blocks + j), block(i), block(j)) for i, j in combinations(range(blocks), 2)
    ]
    rows = prints.select("print", F.explode(F.array(*keys)).alias("key"))
    crowd = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shards = F.ceil(F.col("n") / shard_size).cast("int")
    parts = F.ceil(F.col("n") / block_size).cast("int")
    home = F.pmod(F.xxhash64("print"), shards).cast("int")
    part = F.pmod(F.xxhash64("print", F.lit(1)), parts).cast("int")

    def place(shard, in_block, role):
        return F.struct(shard.alias("shard"), in_block.alias("block"), F.lit(role).alias("role"))

    own = F.array(place(F.col("home"), F.col("part"), _BOTH))
    later = F.sequence(F.lit(0), shards - 1)
    others = F.sequence(F.lit(0), parts - 1)
    asks = F.transform(F.filter(later, lambda x: x > F.col("home")), lambda x: place(x, F.col("part"), _ASKS))
    kept = F.transform(F.filter(others, lambda x: x != F.col("part")), lambda x: place(F.col("home"), x, _STORED))
    return (
        rows.join(crowd, "key")
        .withColumn("home", home)
        .withColumn("part", part)
        .select("key", "print", F.inline(F.concat(own, asks, kept)))
        .repartition(*_GROUP)
        .sortWithinPartitions(*_GROUP, "print")
        .mapInArrow(_tree_links(radius), "a long, b long")
    )


def star_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(a, b)``: each node a that is not the smallest of its component, and that smallest.

    Large-star and small-star steps by turns. Every step joins the smallest neighbour of
    a node, found by a partial aggregate, back to its edges; nothing is gathered in a
    group, and every round is a written table.
    """
    mark = [F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))]
    edges = scratch.save(edges.where("a <> b").distinct(), "edges-0")
    state, turn = tuple(edges.agg(*mark).first()), 0
    while state[0]:
        turn += 1
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", "m")).distinct()
        edges = scratch.save(small, f"edges-{turn}")
        scratch.drop(f"edges-{turn - 1}")
        before, state = state, tuple(edges.agg(*mark).first())
        if state == before:
            break
    return edges


def component_table(prints: DataFrame, scratch: Scratch, radius=2) -> DataFrame:
    """``(print, root, component_id)`` for every distinct fingerprint.

    ``prints`` has doc_id and print. Copies are reduced to one row per fingerprint by a
    partial aggregate before anything else.
    """
    classes = scratch.save(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "classes")
    stars = star_components(near_links(classes.select("print"), radius), scratch)
    rooted = classes.join(stars, F.col("print") == F.col("a"), "left").select(
        "print", "first", F.coalesce("b", "print").alias("root")
    )
    roots = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return scratch.save(rooted.join(roots, "root").select("print", "root", "component_id"), "components")


def near_duplicates(docs: DataFrame, radius=2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; a bit is set
    where more than half of the three-word shingles set it. Null and empty texts have
    fingerprint 0 and are linked like any other. Repeated rows stay, each with the same
    result. A null doc_id takes part; it is a component's id only where all its
    documents have null ids. Other columns are ignored. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    prints = scratch.save(docs.select("doc_id", _fingerprints(bytes_of("text")).alias("print")), "prints")
    parts = component_table(prints, scratch, radius).drop("root")
    return prints.join(parts, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, radius=2) -> DataFrame:
    """``docs`` with one document of each component, the one of the smallest id.

    Columns as given. Where several rows of a component share that id, or all its ids
    are null, one of them stays.
    """
    scratch = Scratch(docs.sparkSession)
    columns = docs.columns
    prints = scratch.save(docs.select("doc_id", _fingerprints(bytes_of("text")).alias("print")), "prints")
    parts = component_table(prints, scratch, radius)
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    several = (
        prints.join(parts, "print").where(first).groupBy("root").count().where("count > 1").select("root")
    )
    several = scratch.save(several, "several")
    kept = (
        docs.withColumn("__print", _fingerprints(bytes_of("text")))
        .join(parts.withColumnsRenamed({"print": "__print", "root": "__root", "component_id": "__component"}), "__print")
        .where(F.col("doc_id").eqNullSafe(F.col("__component")))
    )
    if several.isEmpty():
        return kept.select(*columns)
    here = F.col("__root") == several["root"]
    alone = kept.join(several, here, "left_anti").select(*columns)
    crowd = kept.join(several, here, "left_semi").dropDuplicates(["__root"]).select(*columns)
    return alone.union(crowd)
