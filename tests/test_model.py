import math

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from checks import queries
from checks.storm_view import storm
from tempestry.operators import evaluation, forest
from tempestry.operators.features import (
    FEATURES,
    build_features,
    feature_stages,
    split3,
    with_interaction_product,
)
from tempestry.operators.ranking import with_next_rows
from tempestry.session import materialize

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def parts(spark):
    return split3(materialize(build_features(storm(spark, SF_DIR)), "features"))


@pytest.fixture(scope="module")
def model(parts):
    return forest.train_harm_model(parts[0], trees=20, depth=6, partitions=4)


@pytest.fixture(scope="module")
def scored(model, parts):
    return model.transform(parts[2])


def test_importances_name_every_slot(model, scored):
    table = forest.feature_importance(model, scored).collect()
    assert [r.slot for r in table] == list(range(len(table)))
    labels = model.stages[0].labelsArray
    expected = [
        (group, label) for group, names in zip(FEATURES, labels) for label in names
    ] + [("MAGNITUDE", None), ("EVENT_COUNT_PER_CZ", None)]
    assert [(r.feature_group, r.category) for r in table] == expected
    assert sum(r.importance for r in table) == pytest.approx(1.0)


def test_groups_and_families_sum_to_one(model, scored):
    importances = forest.feature_importance(model, scored)
    groups = forest.group_importance(importances)
    assert {r.feature_group for r in groups.collect()} == set(FEATURES)
    answer = forest.storm_vs_location(importances).head()
    assert answer.storm_pct + answer.location_pct == pytest.approx(100.0)
    assert answer.diff_pct == pytest.approx(abs(answer.storm_pct - answer.location_pct))
    ranked = forest.top_categories(importances, "STATE", 5).collect()
    assert [r["rank"] for r in ranked] == [1, 2, 3, 4, 5]
    assert ranked == sorted(ranked, key=lambda r: (-r.importance, r.category))


@pytest.mark.parametrize(
    ("storm_share", "winner", "intensity"),
    [(0.54, "STORM", "slightly"), (0.4, "LOCATION", "moderately"), (0.9, "STORM", "significantly")],
)
def test_intensity_of_the_answer(spark, storm_share, winner, intensity):
    table = spark.createDataFrame(
        [("MAGNITUDE", storm_share), ("STATE", 1 - storm_share)],
        "feature_group string, importance double",
    )
    answer = forest.storm_vs_location(table).head()
    assert (answer.more_predictive, answer.intensity) == (winner, intensity)


def test_same_forest_from_differently_placed_rows(parts, model):
    again = forest.train_harm_model(
        parts[0].repartition(3).orderBy(F.desc("MAGNITUDE")), trees=20, depth=6, partitions=4
    )

    def trees(fitted):
        return fitted.stages[-1].toDebugString.split("\n")[1:]

    assert trees(again) == trees(model)


def test_partitions_grow_with_the_rows(parts, monkeypatch):
    def trees(fitted):
        return fitted.stages[-1].toDebugString.split("\n")[1:]

    monkeypatch.setattr(forest, "ROWS_PER_PARTITION", 1000)
    grown = forest.train_harm_model(parts[0], trees=5, depth=4, partitions=2)
    n = math.ceil(parts[0].count() / 1000)
    assert n > 2 and grown.stages[-1].getCacheNodeIds()
    plain = RandomForestClassifier(labelCol="has_harm", numTrees=5, maxDepth=4, seed=42)
    placed = parts[0].repartition(n, "EVENT_ID").sortWithinPartitions("EVENT_ID")
    assert trees(grown) == trees(Pipeline(stages=[*feature_stages(), plain]).fit(placed))


def test_quality_scores_each_part_once(spark, monkeypatch):
    sf_dir, calls = SF_DIR.replace("0.01", "0.001"), []
    model, test = queries.trained(spark, sf_dir)
    made = queries.features.build_features
    monkeypatch.setattr(queries.features, "build_features", lambda *a: calls.append(a) or made(*a))
    found = {r.part: r for r in queries.rf_quality(spark, sf_dir).collect()}
    assert not calls
    for name, part in (("validation", split3(made(storm(spark, sf_dir)))[1]), ("test", test)):
        scored = model.transform(part)
        assert found[name].auc == pytest.approx(evaluation.area_under_roc(scored))
        assert found[name].accuracy == evaluation.accuracy(scored).head()[0]


def test_unseen_category_is_scored(model, parts):
    strange = parts[2].limit(5).withColumn("STATE", F.lit("ATLANTIS"))
    assert model.transform(strange).where("prediction IS NOT NULL").count() == 5


def test_quality_measures(scored):
    counts = {
        (r.has_harm, r.prediction): r.event_count
        for r in evaluation.confusion_matrix(scored).collect()
    }
    right = sum(n for (label, guess), n in counts.items() if label == guess)
    share = evaluation.accuracy(scored).head()[0]
    assert share == pytest.approx(right / sum(counts.values()))
    assert 0.0 <= evaluation.area_under_roc(scored) <= 1.0


def test_auc_of_perfect_and_constant_scores(spark):
    df = spark.createDataFrame(
        [(0, 0.1, 0.5), (0, 0.2, 0.5), (1, 0.7, 0.5), (1, 0.9, 0.5)],
        "has_harm int, good double, flat double",
    )
    assert evaluation.area_under_roc(df, score="good") == 1.0
    assert evaluation.area_under_roc(df, score="flat") == 0.5


def test_donors_are_a_permutation(parts):
    test = parts[2]
    paired = forest.with_donor_values(test, ["EVENT_ID", "STATE"]).collect()
    given = sorted(r.donor.EVENT_ID for r in paired)
    assert given == sorted(r.EVENT_ID for r in paired)
    assert len(paired) == test.count()
    assert not any(r.donor.EVENT_ID == r.EVENT_ID for r in paired)
    again = forest.with_donor_values(test.repartition(5), ["EVENT_ID", "STATE"]).collect()
    assert {(r.EVENT_ID, r.donor.EVENT_ID) for r in again} == {
        (r.EVENT_ID, r.donor.EVENT_ID) for r in paired
    }


def test_permutation_importance_finds_the_feature_that_decides(spark):
    features = spark.range(4000).select(
        F.col("id").alias("EVENT_ID"),
        F.when(F.col("id") % 2 == 0, "Flood").otherwise("Heat").alias("EVENT_TYPE"),
        F.concat(F.lit("S"), F.col("id") % 7).alias("STATE"),
        F.lit("EG").alias("MAGNITUDE_TYPE"),
        (F.col("id") % 11).cast("double").alias("MAGNITUDE"),
        (F.col("id") % 13).alias("EVENT_COUNT_PER_CZ"),
        (F.col("id") % 2).cast("int").alias("has_harm"),
    )
    fitted = forest.train_harm_model(features, trees=10, depth=3, partitions=4)
    table = {r.feature: r for r in forest.permutation_importance(fitted, features).collect()}
    assert set(table) == set(FEATURES)
    assert table["EVENT_TYPE"].auc_drop > 0.3
    assert max(abs(table[f].auc_drop) for f in FEATURES[1:]) < 0.1


def test_interaction_features_reach_the_vector(parts):
    rows = with_interaction_product(parts[1])
    fitted = Pipeline(stages=feature_stages(interactions=True)).fit(rows)
    vector = fitted.transform(rows).head().features
    kinds = [len(labels) for labels in fitted.stages[0].labelsArray]
    assert len(vector) == sum(kinds) + 2 + kinds[0] * kinds[1] + 1


def test_donors_of_several_permutations_from_one_order(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in (1, 2, 3, 40):
            df = spark.range(n).select((F.col("id") * 7 % n).alias("EVENT_ID"), F.lit("x").alias("_row")).repartition(3)
            rows = with_next_rows(df, ["EVENT_ID"], ["EVENT_ID"], 6).collect()
            found = {r.EVENT_ID: [d.EVENT_ID for d in r.donors] for r in rows}
            assert found == {i: [(i + j) % n for j in range(1, 7)] for i in range(n)}
            assert {r._row for r in rows} == {"x"}
        assert with_next_rows(df.limit(0), ["EVENT_ID"], ["EVENT_ID"], 3).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plan = forest.with_donor_values(df.drop("_row"), ("EVENT_ID",), repeats=50)
    text = plan._jdf.queryExecution().executedPlan().toString()
    few = forest.with_donor_values(df.drop("_row"), ("EVENT_ID",), repeats=1)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == few.count("Exchange")
