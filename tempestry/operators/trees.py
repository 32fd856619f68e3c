"""A fitted forest as a table of nodes: what it asks, how it scores, what it relies on."""

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempestry.operators.forest import vector_slots
from tempestry.schema import EVENT_ID
from tempestry.session import Scratch


def tree_table(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """One row per node of every tree of a fitted harm model.

    ``tree`` and ``node`` name it (0 is the root), ``left`` and ``right`` its children, NULL
    for a leaf. A node that splits has ``slot`` of the feature vector with its
    ``feature_group`` and ``category``, and sends a value left that is at most ``threshold``
    or, for a slot of categories, in ``left_values``. ``negatives`` and ``positives`` are the
    (weighted) training rows, with ``impurity`` and ``gain``. ``scored`` is any output of the
    model, for the names of its slots. The table comes from the model's written form.
    """
    spark, scratch = scored.sparkSession, Scratch(scored.sparkSession)
    model.stages[-1].write().save(scratch.path("forest"))
    names = spark.createDataFrame(
        vector_slots(model, scored), "slot int, feature_group string, category string"
    )
    n = "nodeData"
    inner = F.col(f"{n}.leftChild") >= 0
    split = F.col(f"{n}.split")
    numeric = split["numCategories"] < 0
    nodes = spark.read.parquet(scratch.path("forest/data")).select(
        F.col("treeID").alias("tree"),
        F.col(f"{n}.id").alias("node"),
        F.when(inner, F.col(f"{n}.leftChild")).alias("left"),
        F.when(inner, F.col(f"{n}.rightChild")).alias("right"),
        F.when(inner, split["featureIndex"]).alias("slot"),
        F.when(inner & numeric, split["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner & ~numeric, split["leftCategoriesOrThreshold"]).alias("left_values"),
        F.col(f"{n}.impurityStats")[0].alias("negatives"),
        F.col(f"{n}.impurityStats")[1].alias("positives"),
        F.col(f"{n}.impurity").alias("impurity"),
        F.when(inner, F.col(f"{n}.gain")).alias("gain"),
    )
    return nodes.join(names, "slot", "left")


def with_depth(nodes: DataFrame) -> DataFrame:
    """The nodes with their depth, found level by level from the roots: a join per level."""
    scratch = Scratch(nodes.sparkSession)
    nodes = scratch.save(nodes, "nodes")
    level = nodes.where("node = 0").select("tree", "node", F.lit(0).alias("depth"))
    found, depth = [], 0
    while not level.isEmpty():
        found.append(scratch.save(level, f"level_{depth}"))
        depth += 1
        above = nodes.join(found[-1], ["tree", "node"]).where("left IS NOT NULL")
        below = F.explode(F.array("left", "right")).alias("node")
        level = above.select("tree", below, F.lit(depth).alias("depth"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return nodes.join(every, ["tree", "node"])


def node_scores(nodes: DataFrame, rows: DataFrame, row_id=EVENT_ID, features="features", depth=30) -> DataFrame:
    """(row id, score): the mean share of positives in the leaves the row reaches, by joins.

    ``rows`` has the feature vector. Every row starts at the root of every tree and moves a
    level per join; the table of nodes is joined by its real size. ``depth`` bounds the
    levels and is cut to the deepest node.
    """
    scratch = Scratch(rows.sparkSession)
    nodes = scratch.save(with_depth(nodes), "nodes")
    levels = min(depth, nodes.agg(F.max("depth")).head()[0] or 0)
    roots = nodes.where("node = 0").agg(F.collect_set("tree").alias("trees"))
    asked = nodes.select("tree", "node", "left", "right", "slot", "threshold", "left_values")
    trees = roots.head().trees
    values = rows.select(row_id, vector_to_array(features).alias("_x"))
    state = values.withColumn("tree", F.explode(F.lit(trees))).withColumn("node", F.lit(0))
    for _ in range(levels):
        value = F.get("_x", F.col("slot"))
        goes_left = F.coalesce(value <= F.col("threshold"), F.array_contains("left_values", value))
        below = F.when(goes_left, F.col("left")).otherwise(F.col("right"))
        state = state.join(asked, ["tree", "node"]).select(
            row_id, "_x", "tree", F.coalesce(below, "node").alias("node")
        )
    share = F.col("positives") / (F.col("positives") + F.col("negatives"))
    leaves = nodes.select("tree", "node", share.alias("_share"))
    reached = state.drop("_x").join(leaves, ["tree", "node"])
    return reached.groupBy(row_id).agg(F.avg("_share").alias("score"))


def node_importance(nodes: DataFrame) -> DataFrame:
    """(slot, feature_group, category, importance) of the slots that any node asks.

    Per tree, the fall in impurity times the rows it concerns, as a share of the tree's; the
    shares of all trees that split, scaled to add up to 1.
    """
    fall = F.col("gain") * (F.col("negatives") + F.col("positives"))
    asked = nodes.where("slot IS NOT NULL")
    keys = ["slot", "feature_group", "category"]
    by_slot = asked.groupBy("tree", *keys).agg(F.sum(fall).alias("_fall"))
    by_tree = asked.groupBy("tree").agg(F.sum(fall).alias("_all"))
    shares = by_slot.join(by_tree, "tree").where("_all > 0").withColumn("_share", F.col("_fall") / F.col("_all"))
    totals = shares.groupBy(*keys).agg(F.sum("_share").alias("_sum"))
    whole = F.sum("_sum").over(Window.partitionBy())  # a row per slot
    return totals.select(*keys, (F.col("_sum") / whole).alias("importance"))
