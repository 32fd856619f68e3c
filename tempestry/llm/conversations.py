"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns. It is named by the smallest conversation in it
and its depth, and found by two 64-bit sums of hashes of (depth, turn), which add up along
ranges, so that a conversation of any length is never held whole; each node checks that its
members agree on the turn's SHA-256.

Sums over subtrees come from centroids: the deepest node that holds over half of its
component's weight. What lies below it is added up, given to it and to the nodes between it
and the component's top, and cut off; the children of the centroid head components of their
own. Components of few nodes are finished by the same steps inside a task.
"""

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempestry.llm.common import emit
from tempestry.llm.mixing import word_count
from tempestry.session import Scratch

_TOP = ["top_conv", "top_depth"]
_NODE = ["conv_id", "depth"]
_KEY = ["depth", "h1", "h2"]
_OUT_SQL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string"
)


def _hash(seed: int, depth: Column, digest: Column) -> Column:
    return F.xxhash64(F.lit(seed), depth.cast("long"), digest)


def _turns(df: DataFrame) -> DataFrame:
    """conv_id, turn, the digest and the words of each turn that has a conv_id."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return df.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(whole, 256)).alias("digest"),
        word_count("text").cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )


def _carried(ranged: DataFrame, **sums) -> DataFrame:
    """(range, conv_id, sums over that conversation's rows in earlier ranges).

    Ranges follow conv_id, so only a range's first and last conversation can go on in
    another: two rows per range. ``sums`` pairs an aggregate with the name it gets.
    """
    ends = ranged.groupBy("range").agg(F.min("conv_id").alias("lo"), F.max("conv_id").alias("hi"))
    border = ranged.join(ends, "range").where("conv_id = lo OR conv_id = hi")
    parts = border.groupBy("range", "conv_id").agg(*[f(c).alias(n) for n, (f, c) in sums.items()])
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    over = [f(n).over(earlier).alias(n) for n, (f, _) in sums.items()]
    return parts.select("range", "conv_id", *over).where(F.col(next(iter(sums))).isNotNull())


def _positions(df: DataFrame, scratch: Scratch) -> DataFrame:
    """The turns with their place in the conversation, from 1, and the range they lie in."""
    order = ["turn", "digest", "row"]
    turns = scratch.save(_turns(df), "turns")
    ranged = turns.repartitionByRange("conv_id", *order).withColumn("range", F.spark_partition_id())
    ranged = scratch.save(ranged, "ranged")
    inside = Window.partitionBy("range", "conv_id").orderBy(*order)
    before = _carried(ranged.withColumn("one", F.lit(1)), skipped=(F.sum, "one"))
    placed = ranged.withColumn("place", F.row_number().over(inside)).join(before, ["range", "conv_id"], "left")
    place = F.col("place") + F.coalesce("skipped", F.lit(0))
    placed = scratch.save(placed.select("conv_id", "range", place.alias("place"), "digest", "words"), "placed")
    scratch.drop("turns", "ranged")
    return placed


def _plans(placed: DataFrame, scratch: Scratch, family: int, most: int) -> DataFrame:
    """Per conversation: own turns to skip, the head it takes over, and its rebuilt length."""
    convs = placed.groupBy("conv_id").agg(F.max("place").alias("n"))
    convs = convs.withColumn("skip", F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1))
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    heads = placed.where((F.col("conv_id") % family == 0) & (F.col("place") <= most))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "digest", "words"))).alias("head")
    )
    none = F.array().cast("array<struct<place:bigint,digest:binary,words:bigint>>")
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("skip").cast("int"))
    own = F.greatest(F.col("n") - F.col("skip"), F.lit(0))
    plans = convs.join(heads, "base", "left").select("conv_id", "skip", head.alias("head"), own.alias("own"))
    return scratch.save(plans.withColumn("length", F.size("head") + F.col("own")).drop("own"), "plans")


def _summed(head: Column, seed: int) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(head, zero, lambda a, t: a.bitwiseXOR(_hash(seed, t["place"], t["digest"])))


def _members(placed: DataFrame, plans: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per conversation and depth of its rebuilt form: conv_id, length, depth, the sums
    of the node (h1, h2) and of its parent (g1, g2), digest, words."""
    depth = F.size("head") + F.col("place") - F.col("skip")
    own = placed.join(plans, "conv_id").where("place > skip").select(
        "conv_id", "range", "length", depth.cast("long").alias("depth"), "digest", "words",
        _summed(F.col("head"), 1).alias("s1"), _summed(F.col("head"), 2).alias("s2"),
    )
    own = scratch.save(
        own.withColumn("x1", _hash(1, F.col("depth"), F.col("digest"))).withColumn(
            "x2", _hash(2, F.col("depth"), F.col("digest"))
        ),
        "own",
    )
    before = _carried(own, c1=(F.bit_xor, "x1"), c2=(F.bit_xor, "x2"))
    inside = Window.partitionBy("range", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = own.withColumn("r1", F.bit_xor("x1").over(inside)).withColumn("r2", F.bit_xor("x2").over(inside))
    run = run.join(before, ["range", "conv_id"], "left")

    def total(i):
        return F.col(f"s{i}").bitwiseXOR(F.col(f"r{i}")).bitwiseXOR(F.coalesce(f"c{i}", F.lit(0)))

    kept = ["conv_id", "length", "depth", "digest", "words", "h1", "h2", "g1", "g2"]
    run = run.withColumn("h1", total(1)).withColumn("h2", total(2))
    for i in (1, 2):
        run = run.withColumn(f"g{i}", F.col(f"h{i}").bitwiseXOR(F.col(f"x{i}")))
    taken = plans.select("conv_id", "length", "head", F.posexplode("head").alias("i", "t"))
    taken = taken.withColumns({"depth": (F.col("i") + 1).cast("long"), "digest": F.col("t.digest"), "words": F.col("t.words")})
    for i in (1, 2):
        taken = taken.withColumn(f"h{i}", _summed(F.slice("head", F.lit(1), F.col("i") + 1), i))
        taken = taken.withColumn(f"g{i}", _summed(F.slice("head", F.lit(1), F.col("i")), i))
    members = scratch.save(run.select(*kept).unionByName(taken.select(*kept)), "members")
    scratch.drop("own", "placed")
    return members


def _nodes(members: DataFrame, scratch: Scratch, root: int) -> DataFrame:
    """The nodes below the root with parent_conv_id, weight (member rows in the subtree) and words."""
    same = F.min("digest") == F.max("digest")
    torn = F.raise_error(F.lit("two sequences of turns have one hash")).cast("long")
    nodes = members.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        (F.sum("length") - F.count(F.lit(1)) * (F.col("depth") - 1)).alias("weight"),
        F.when(same, F.max("words")).otherwise(torn).alias("words"),
        F.max("g1").alias("g1"),
        F.max("g2").alias("g2"),
    )
    nodes = scratch.save(nodes, "nodes")
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("conv_id").alias("parent_conv_id")
    )
    first = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(root).cast("long"))
    deeper = nodes.where("depth > 1").join(above, ["depth", "g1", "g2"])
    tree = scratch.save(first.unionByName(deeper).drop("g1", "g2"), "tree")
    scratch.drop("nodes")
    return tree


def centroid_sums(parents, weights, values):
    """Sums of ``values`` (pairs) over the subtrees of one component.

    Nodes stand by depth, the top first; ``parents`` are places in that list, ``weights`` the
    weights of the subtrees inside the component, all positive.
    """
    weights, sums = list(weights), [[0, 0] for _ in values]
    waiting = [list(range(len(values)))]
    while waiting:
        part = waiting.pop()
        top, whole = part[0], weights[part[0]]
        # the nodes of over half the weight are a path from the top: the last is the deepest
        centroid = next(v for v in reversed(part) if 2 * weights[v] > whole)
        a, b = values[centroid]
        head, parts, rest = {}, {}, []
        for v in part:
            p = parents[v]
            if v == centroid:
                continue
            if p == centroid and v != top:
                head[v] = v
                parts[v] = [v]
            elif p in head and v != top:
                head[v] = head[p]
                parts[head[p]].append(v)
            else:
                rest.append(v)
                continue
            a += values[v][0]
            b += values[v][1]
        cut, v = weights[centroid], centroid
        while True:
            sums[v][0] += a
            sums[v][1] += b
            if v == top:
                break
            v = parents[v]
            weights[v] -= cut
        if rest:
            waiting.append(rest)
        waiting.extend(parts.values())
    return sums


_SUMS = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64())])


def _finish(batches):
    """Rows sorted by component and depth to the sums of its nodes, a component at a time."""
    names = [*_TOP, "conv_id", "depth", "parent_conv_id", "weight", "leaf", "saved", "add_leaf", "add_saved"]
    now, nodes = None, []

    def close():
        place = {(n[0], n[1]): i for i, n in enumerate(nodes)}
        parents = [place.get((n[2], n[1] - 1), -1) for n in nodes]
        sums = centroid_sums(parents, [n[3] for n in nodes], [(n[4], n[5]) for n in nodes])
        return [(n[0], n[1], s[0] + n[6], s[1] + n[7]) for n, s in zip(nodes, sums)]

    def out(rows):
        return emit(_SUMS, **{c: list(v) for c, v in zip(_SUMS.names, zip(*rows))})

    for batch in batches:
        rows = []
        for row in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in names)):
            if row[:2] != now:
                if nodes:
                    rows += close()
                now, nodes = row[:2], []
            nodes.append(row[2:])
        if rows:
            yield out(rows)
    if nodes:
        yield out(close())


def subtree_sums(tree: DataFrame, paths, scratch: Scratch, largest=4096) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens): sums of ``leaf`` and ``saved`` over subtrees.

    ``tree`` has every node with parent_conv_id and the weight of its subtree; its root is of
    depth 0. ``paths`` is a function that gives (conv_id, depth) with the node found there and
    its parent; only components of more than ``largest`` nodes need it. Each round halves the
    weight of every such component.
    """
    zero = F.lit(0).cast("long")
    root = tree.where("depth = 0").select("conv_id", "weight").head()
    active = tree.select(
        F.lit(root.conv_id).cast("long").alias("top_conv"), zero.alias("top_depth"), *_NODE, "parent_conv_id",
        "weight", "leaf", "saved", zero.alias("add_leaf"), zero.alias("add_saved"),
    )
    columns, small, done, walks, turn = active.columns, [], [], None, 0
    while True:
        if turn:
            sizes = active.groupBy(*_TOP).agg(F.max("weight").alias("whole"), F.count(F.lit(1)).alias("nodes"))
            sized = active.join(sizes, _TOP)
        else:  # one component
            sized = active.withColumns({"whole": F.lit(root.weight), "nodes": F.lit(tree.count())})
        sized = scratch.save(sized, f"sized_{turn}")
        small.append(sized.where(F.col("nodes") <= largest).select(*columns))
        large = sized.where(F.col("nodes") > largest)
        if large.isEmpty():
            break
        walks = walks or paths()
        heavy = large.where("2 * weight > whole")
        centre = heavy.groupBy(*_TOP).agg(F.max(F.struct("depth", "conv_id", "weight")).alias("c"))
        centre = centre.select(
            *_TOP, F.col("c.depth").alias("c_depth"), F.col("c.conv_id").alias("c_conv"), F.col("c.weight").alias("c_weight")
        )
        seen = large.join(scratch.save(centre, f"centre_{turn}"), _TOP)
        here = (F.col("conv_id") == F.col("walk_conv")) & (F.col("c_depth") + 1 == F.col("walk_depth"))
        deeper = seen.where("depth > c_depth").join(walks, here)
        below = F.col("walk_parent") == F.col("c_conv")
        none = F.lit(None).cast("long")
        labelled = seen.where("depth <= c_depth").select(*seen.columns, none.alias("head")).unionByName(
            deeper.select(*seen.columns, F.when(below, F.col("walk_node")).alias("head"))
        )
        is_centre = (F.col("conv_id") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
        labelled = scratch.save(labelled.withColumn("centre", is_centre), f"labelled_{turn}")
        inside = labelled.where("centre OR head IS NOT NULL").groupBy(*_TOP)
        sums = inside.agg(F.sum("leaf").alias("part_leaf"), F.sum("saved").alias("part_saved"))
        told = labelled.join(scratch.save(sums, f"sums_{turn}"), _TOP)
        done.append(
            told.where("centre").select(
                *_NODE,
                (F.col("add_leaf") + F.col("part_leaf")).alias("n_leaves"),
                (F.col("add_saved") + F.col("part_saved")).alias("saved_tokens"),
            )
        )
        # the nodes that hold over half of the weight are those from the top down to the centroid
        path = F.col("head").isNull() & (2 * F.col("weight") > F.col("whole"))
        rest = told.where("NOT centre").withColumns(
            {
                "top_conv": F.coalesce("head", "top_conv"),
                "top_depth": F.when(F.col("head").isNotNull(), F.col("c_depth") + 1).otherwise(F.col("top_depth")),
                "weight": F.col("weight") - F.when(path, F.col("c_weight")).otherwise(zero),
                "add_leaf": F.col("add_leaf") + F.when(path, F.col("part_leaf")).otherwise(zero),
                "add_saved": F.col("add_saved") + F.when(path, F.col("part_saved")).otherwise(zero),
            }
        )
        active = scratch.save(rest.select(*columns), f"active_{turn}")
        turn += 1
    rows = small[0]
    for more in small[1:]:
        rows = rows.unionByName(more)
    out = (
        rows.repartition(*_TOP)
        .sortWithinPartitions(*_TOP, "depth", "conv_id")
        .mapInArrow(_finish, "conv_id long, depth long, n_leaves long, saved_tokens long")
    )
    for more in done:
        out = out.unionByName(more)
    return out


_ENDS = pa.schema([("depth", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("ends_sha256", pa.string())])


def _hash_runs(batches):
    """Rows (key, run of ids) sorted by key and range to a hash of each key's joined runs."""
    now, state, rows = None, None, []
    for batch in batches:
        for depth, h1, h2, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (depth, h1, h2) == now:
                state.update(b"," + ids.encode())
                continue
            if now is not None:
                rows.append((*now, state.hexdigest()))
            now, state = (depth, h1, h2), hashlib.sha256(ids.encode())
        if rows:
            yield emit(_ENDS, **{c: list(v) for c, v in zip(_ENDS.names, zip(*rows))})
            rows = []
    if now is not None:
        yield emit(_ENDS, **{c: list(v) for c, v in zip(_ENDS.names, zip(*[(*now, state.hexdigest())]))})


def _end_hashes(members: DataFrame, plans: DataFrame, scratch: Scratch) -> DataFrame:
    """The hash of the conversations that end at each node where any does, by the node's sums.

    Ids are joined range by range, so a node where very many end is a run per range, and its
    hash is fed run by run.
    """
    zero = F.lit(0).cast("long")
    empty = plans.where("length = 0").select(zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), "conv_id")
    ends = members.where("depth = length").select(*_KEY, "conv_id").unionByName(empty)
    ranged = ends.repartitionByRange(*_KEY, "conv_id").withColumn("range", F.spark_partition_id())
    ranged = scratch.save(ranged, "ends")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    runs = ranged.groupBy(*_KEY, "range").agg(F.array_join(ids, ",").alias("ids"))
    runs = runs.repartition(*_KEY).sortWithinPartitions(*_KEY, "range")
    return runs.select(*_KEY, "ids").mapInArrow(_hash_runs, "depth long, h1 long, h2 long, ends_sha256 string")


def prefix_trie(df: DataFrame, family=20, most=3, largest=4096) -> DataFrame:
    """The nodes of the trie of rebuilt conversations, one row each.

    ``df`` has conv_id, turn, role and text; other columns are ignored. Turns stand by turn,
    null first, those of equal turn by the SHA-256 of role and text; null role and text are
    empty; rows repeated in full are turns of their own. Rows without a conv_id belong to no
    conversation. Conversation c takes over the first h turns of conversation c - c % ``family``
    (the remainder has the sign of c), h being crc32(c) % (``most`` + 1), and goes on with its
    own turns after its first h. Of node and members: conv_id (the smallest), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. No conversations
    give no rows, not even a root.
    """
    spark = df.sparkSession
    scratch = Scratch(spark)
    placed = _positions(df, scratch)
    plans = _plans(placed, scratch, family, most)
    root, n_convs, total = plans.agg(F.min("conv_id"), F.count(F.lit(1)), F.sum("length")).head()
    if root is None:
        return spark.createDataFrame([], _OUT_SQL)
    members = _members(placed, plans, scratch)
    below = _nodes(members, scratch, root)
    top = spark.createDataFrame(
        [(0, 0, 0, root, n_convs, total + n_convs, 0, None)],
        "depth long, h1 long, h2 long, conv_id long, n_convs long, weight long, words long, parent_conv_id long",
    )
    every = below.unionByName(top)
    children = below.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    none = F.lit(0).cast("long")
    tree = every.join(children, _NODE, "left").withColumn("n_children", F.coalesce("n_children", none))
    tree = tree.withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    tree = scratch.save(tree.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "measured")
    ends = scratch.save(_end_hashes(members, plans, scratch), "hashes")

    def paths():
        found = members.select("conv_id", *_KEY).withColumnRenamed("conv_id", "walk_conv")
        found = found.join(below.select(*_KEY, "conv_id", "parent_conv_id"), _KEY).select(
            "walk_conv", F.col("depth").alias("walk_depth"), F.col("conv_id").alias("walk_node"),
            F.col("parent_conv_id").alias("walk_parent"),
        )
        return scratch.save(found, "paths")

    sums = scratch.save(subtree_sums(tree, paths, scratch, largest), "sums")
    found = tree.join(sums, _NODE).join(ends, _KEY, "left")
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        *_NODE, "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nobody).alias("ends_sha256"),
    )
