"""Random forest of which events harm, and what it relies on."""

import math

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempestry.operators.evaluation import grouped_area_under_roc
from tempestry.operators.features import CATEGORICAL, FEATURES, NUMERIC, feature_stages
from tempestry.operators.ranking import top_k, with_next_rows
from tempestry.schema import (
    EVENT_COUNT_PER_CZ,
    EVENT_ID,
    EVENT_TYPE,
    HAS_HARM,
    MAGNITUDE,
    MAGNITUDE_TYPE,
    STATE,
)
from tempestry.session import Scratch

# Training rows a partition holds at most, on average: about 150 MB with 100 trees.
ROWS_PER_PARTITION = 200_000

STORM_GROUPS = (EVENT_TYPE, MAGNITUDE_TYPE, MAGNITUDE)
LOCATION_GROUPS = (STATE, EVENT_COUNT_PER_CZ)


def train_harm_model(
    train: DataFrame,
    row_id=EVENT_ID,
    trees=100,
    depth=10,
    seed=42,
    partitions: int = 200,
    interactions=False,
    memory_mb=1024,
    bootstrap=True,
    columns=None,
) -> PipelineModel:
    """Fit indexer, encoder, assembler and forest as one pipeline.

    The forest draws its samples per partition and in row order, so rows are
    placed by a hash of their id and sorted first: the same rows, seed and
    ``partitions`` give the same forest on any cluster. ``partitions`` is the least number;
    above ``ROWS_PER_PARTITION`` rows in each there are as many as the rows, written and
    counted first, ask for. ``columns`` names the features to use, by default all;
    ``bootstrap=False`` gives every tree all rows and all features. ``memory_mb`` bounds the statistics a task
    gathers in one pass: the more nodes fit, the fewer passes over the rows.

    Where each row stands in each tree is kept from pass to pass, not found anew from the
    root; this changes no tree.
    """
    scratch = Scratch(train.sparkSession)
    rows = scratch.save(train, "train")
    partitions = max(partitions, math.ceil(rows.count() / ROWS_PER_PARTITION))
    placed = rows.repartition(partitions, row_id).sortWithinPartitions(row_id)
    placed = placed.persist(StorageLevel.MEMORY_AND_DISK)
    forest = RandomForestClassifier(
        labelCol=HAS_HARM,
        featuresCol="features",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        maxMemoryInMB=memory_mb,
        cacheNodeIds=True,
        checkpointInterval=-1,
        bootstrap=bootstrap,
        featureSubsetStrategy="auto" if bootstrap else "all",
    )
    try:
        return Pipeline(stages=[*feature_stages(interactions, columns), forest]).fit(placed)
    finally:
        placed.unpersist()
        scratch.close()


def vector_slots(model: PipelineModel, scored: DataFrame) -> list:
    """(slot, feature group, category or None) of the assembled vector, from its metadata."""
    attributes = scored.schema["features"].metadata["ml_attr"]["attrs"]
    inputs = sorted(model.stages[-2].getInputCols(), key=len, reverse=True)
    rows = []
    for attribute in (a for kind in attributes.values() for a in kind):
        slot, name = attribute["idx"], attribute["name"]
        source = next(c for c in inputs if name == c or name.startswith(f"{c}_"))
        category = name.removeprefix(source).removeprefix("_") or None
        rows.append((slot, source.removesuffix("_vec"), category))
    return rows


def feature_importance(model: PipelineModel, scored: DataFrame) -> DataFrame:
    """Importance of each vector slot with its feature group and category.

    One row per slot: the table is as wide as the model, whatever the number of events.
    """
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(*slot, float(weights[slot[0]])) for slot in vector_slots(model, scored)]
    return scored.sparkSession.createDataFrame(
        rows, "slot int, feature_group string, category string, importance double"
    )


def group_importance(importances: DataFrame) -> DataFrame:
    """Importance per feature group and its share of all, in percent.

    There is a row per group, so the total is taken over these rows.
    """
    groups = importances.groupBy("feature_group").agg(F.sum("importance").alias("importance"))
    total = F.sum("importance").over(Window.partitionBy())
    return groups.withColumn("pct", F.try_divide(F.col("importance") * 100, total))


def top_categories(importances: DataFrame, group: str, k=10) -> DataFrame:
    """The ``k`` categories of a group that matter most, ranked, with their share."""
    total = importances.agg(F.sum("importance")).scalar()
    shares = importances.select(
        "feature_group",
        "category",
        "importance",
        F.round(F.try_divide("importance", F.lit(total)) * 100, 2).alias("pct"),
    ).where((F.col("feature_group") == group) & F.col("category").isNotNull())
    by_weight = Window.orderBy(F.col("importance").desc(), F.col("category"))
    return top_k(shares, "importance", ["category"], k).select(
        F.row_number().over(by_weight).alias("rank"), "category", "importance", "pct"
    )


def storm_vs_location(importances: DataFrame) -> DataFrame:
    """One row: what kind of event against where, which matters more, how clearly."""

    def weight(groups):
        return F.coalesce(
            F.sum(F.when(F.col("feature_group").isin(*groups), F.col("importance"))), F.lit(0.0)
        )

    families = importances.agg(
        weight(STORM_GROUPS).alias("storm_importance"),
        weight(LOCATION_GROUPS).alias("location_importance"),
        F.sum("importance").alias("total"),
    )
    shares = families.withColumns(
        {
            "storm_pct": F.try_divide(F.col("storm_importance") * 100, "total"),
            "location_pct": F.try_divide(F.col("location_importance") * 100, "total"),
        }
    ).withColumn("diff_pct", F.abs(F.col("storm_pct") - F.col("location_pct")))
    storm_wins = F.col("storm_importance") > F.col("location_importance")
    return shares.select(
        "storm_importance",
        "location_importance",
        "storm_pct",
        "location_pct",
        "diff_pct",
        F.when(storm_wins, "STORM").otherwise("LOCATION").alias("more_predictive"),
        F.when(F.col("diff_pct") < 10, "slightly")
        .when(F.col("diff_pct") < 30, "moderately")
        .otherwise("significantly")
        .alias("intensity"),
    )


def results_record(quality: dict, importances: DataFrame) -> DataFrame:
    """One row of ten metrics: the given qualities and six summed importances.

    ``quality`` holds test and validation area under the curve and accuracy.
    """

    def weight(*groups):
        return F.coalesce(
            F.sum(F.when(F.col("feature_group").isin(*groups), F.col("importance"))), F.lit(0.0)
        )

    measured = [
        F.lit(float(quality[name])).alias(name)
        for name in ("test_auc", "test_accuracy", "val_auc", "val_accuracy")
    ]
    return importances.agg(
        *measured,
        weight(*STORM_GROUPS).alias("storm_importance"),
        weight(*LOCATION_GROUPS).alias("location_importance"),
        weight(EVENT_TYPE).alias("event_type_importance"),
        weight(STATE).alias("state_importance"),
        weight(MAGNITUDE).alias("magnitude_importance"),
        weight(EVENT_COUNT_PER_CZ).alias("event_count_importance"),
    )


def with_donor_values(
    df: DataFrame, columns=FEATURES, row_id=EVENT_ID, seed=42, out="donor", repeats=None
) -> DataFrame:
    """Add a struct holding another row's values of ``columns``, or an array of ``repeats``.

    Rows stand in the order of a seeded hash of their id and each takes the values of
    the next, the last those of the first: every row gives its values exactly once (in each
    repeat, which is one row further on), whatever the number of rows. The order is kept by
    ranges, one shuffle for all columns and repeats.
    """
    place = F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f":{seed}")))
    placed = df.withColumn("_place", place)
    donors = with_next_rows(placed, ["_place", row_id], columns, repeats or 1, out).drop("_place")
    return donors if repeats else donors.withColumn(out, F.col(out)[0])


def harm_probability(model: PipelineModel):
    """Scorer of a fitted model: adds ``score``, the probability of harm."""

    def score(df):
        return model.transform(df).withColumn("score", vector_to_array("probability")[1])

    return score


def permutation_importance(
    scorer,
    df: DataFrame,
    columns=CATEGORICAL + NUMERIC,
    row_id=EVENT_ID,
    seed=42,
    label=HAS_HARM,
) -> DataFrame:
    """Fall in the area under the curve when one feature is dealt out anew.

    ``scorer`` is a fitted pipeline or a function that adds a column ``score``. Every row
    is scored as it is and once with each feature from its donor, in one pass, and one
    grouped reduction gives all areas.
    """
    if isinstance(scorer, PipelineModel):
        scorer = harm_probability(scorer)
    paired = with_donor_values(df, columns, row_id, seed)
    variants = F.array(
        *[
            F.struct(
                F.lit(changed).alias("feature"),
                *[F.col(f"donor.{c}" if c == changed else c).alias(c) for c in columns],
            )
            for changed in (None, *columns)
        ]
    )
    rows = paired.select(row_id, label, F.inline(variants))
    areas = grouped_area_under_roc(scorer(rows), "feature", label)
    base = F.max(F.when(F.col("feature").isNull(), F.col("auc"))).over(Window.partitionBy())
    return areas.withColumn("base_auc", base).where("feature IS NOT NULL").select(
        "feature",
        "base_auc",
        F.col("auc").alias("permuted_auc"),
        (F.col("base_auc") - F.col("auc")).alias("auc_drop"),
    )


def repeated_permutation_importance(
    scorer,
    df: DataFrame,
    columns=CATEGORICAL + NUMERIC,
    repeats=5,
    row_id=EVENT_ID,
    seed=42,
    label=HAS_HARM,
) -> DataFrame:
    """Mean and spread of the fall in the area under the curve over several permutations.

    As ``permutation_importance`` with ``repeats`` donors for each row, all from one ordered
    pass. ``sd_drop`` is the sample standard deviation, NULL for one repeat.
    """
    if isinstance(scorer, PipelineModel):
        scorer = harm_probability(scorer)
    paired = with_donor_values(df, columns, row_id, seed, repeats=repeats)
    plain = F.struct(
        F.lit(None).cast("string").alias("feature"), F.lit(0).alias("repeat"), *[F.col(c) for c in columns]
    )
    changed = [
        F.struct(
            F.lit(name).alias("feature"),
            F.lit(i + 1).alias("repeat"),
            *[(F.col("donor")[i][c] if c == name else F.col(c)).alias(c) for c in columns],
        )
        for name in columns
        for i in range(repeats)
    ]
    rows = paired.select(row_id, label, F.inline(F.array(plain, *changed)))
    rows = rows.withColumn("_variant", F.struct("feature", "repeat"))
    areas = grouped_area_under_roc(scorer(rows), "_variant", label)
    base = F.max(F.when(F.col("_variant.feature").isNull(), F.col("auc"))).over(Window.partitionBy())
    drops = areas.select("_variant.feature", base.alias("base_auc"), (base - F.col("auc")).alias("_drop"))
    return drops.where("feature IS NOT NULL").groupBy("feature").agg(
        F.max("base_auc").alias("base_auc"),
        F.avg("_drop").alias("mean_drop"),
        F.stddev_samp("_drop").alias("sd_drop"),
        F.min("_drop").alias("least_drop"),
        F.max("_drop").alias("most_drop"),
    )
