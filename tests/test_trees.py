import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.storm_view import storm
from tempestry.operators import features, forest, trees

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fitted(spark):
    parts = features.split3(features.build_features(storm(spark, SF_DIR)))
    model = forest.train_harm_model(parts[0], trees=12, depth=6, partitions=4)
    scored = model.transform(parts[2]).cache()
    return model, scored, trees.tree_table(model, scored)


def test_nodes_are_those_of_the_forest(fitted):
    model, _, nodes = fitted
    wood = model.stages[-1]
    assert nodes.count() == wood.totalNumNodes
    assert nodes.select("tree").distinct().count() == wood.getNumTrees == 12
    rows = trees.with_depth(nodes).collect()
    assert len(rows) == wood.totalNumNodes and max(r.depth for r in rows) == max(t.depth for t in wood.trees)
    for r in rows:
        assert (r.left is None) == (r.slot is None) == (r.feature_group is None)
        assert r.left is None or (r.threshold is None) != (r.left_values is None)
    names = {r.feature_group for r in rows} - {None}
    assert names <= set(features.FEATURES) and len(names) > 2


def test_node_scores_equal_the_forest(fitted):
    _, scored, nodes = fitted
    own = {r.EVENT_ID: r.p for r in scored.select("EVENT_ID", vector_to_array("probability")[1].alias("p")).collect()}
    joined = {r.EVENT_ID: r.score for r in trees.node_scores(nodes, scored).collect()}
    assert joined == pytest.approx(own, abs=1e-12) and len(set(own.values())) > 5


def test_node_importances_equal_the_forest(fitted):
    model, scored, nodes = fitted
    own = {(r.slot, r.category): r.importance for r in forest.feature_importance(model, scored).collect() if r.importance}
    summed = {(r.slot, r.category): r.importance for r in trees.node_importance(nodes).collect()}
    assert summed == pytest.approx(own, abs=1e-12)
    assert sum(summed.values()) == pytest.approx(1)


def test_partitions_of_one_tree_grow_with_the_rows(spark, monkeypatch):
    table = features.build_features(storm(spark, SF_DIR)).localCheckpoint()
    once = forest.train_harm_model(table, trees=1, depth=3, partitions=1, bootstrap=False)
    seen = []
    monkeypatch.setattr(forest, "ROWS_PER_PARTITION", 100)
    fit = forest.Pipeline.fit
    monkeypatch.setattr(forest.Pipeline, "fit", lambda p, df: seen.append(df.rdd.getNumPartitions()) or fit(p, df))
    more = forest.train_harm_model(table, trees=1, depth=3, partitions=1, bootstrap=False)
    assert seen == [-(-table.count() // 100)] and seen[0] > 4
    assert more.stages[-1].toDebugString.split("\n")[1:] == once.stages[-1].toDebugString.split("\n")[1:]


def test_a_tree_that_is_only_a_root(spark):
    rows = [(i, "Flood", "TEXAS", "EG", 1.0, 2.0, 1) for i in range(8)]
    df = spark.createDataFrame(rows, "EVENT_ID long, EVENT_TYPE string, STATE string, MAGNITUDE_TYPE string, MAGNITUDE double, EVENT_COUNT_PER_CZ double, has_harm int")
    model = forest.train_harm_model(df.unionAll(df.withColumn("has_harm", F.lit(0))), trees=2, depth=2, partitions=1, bootstrap=False)
    scored = model.transform(df)
    nodes = trees.tree_table(model, scored)
    assert nodes.count() == 2 and trees.node_importance(nodes).count() == 0
    assert {r.score for r in trees.node_scores(nodes, scored).collect()} == {0.5}
