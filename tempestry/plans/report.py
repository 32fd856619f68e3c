"""The consolidated job: every report from one pass, then the harm model."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.operators.damage import relative_to_baseline
from tempestry.operators.evaluation import (
    accuracy,
    area_under_roc,
    class_distribution,
    confusion_matrix,
)
from tempestry.operators.features import SPLITS, build_features, split_name
from tempestry.operators.forest import (
    feature_importance,
    group_importance,
    results_record,
    storm_vs_location,
    top_categories,
    train_harm_model,
)
from tempestry.operators.ranking import sort_desc, top_k
from tempestry.operators.trend import spearman_test
from tempestry.plans import rollup as rolled
from tempestry.schema import (
    CZ_NAME,
    EVENT_ID,
    EVENT_TYPE,
    HAS_HARM,
    MAGNITUDE_TYPE,
    NO_MAGNITUDE_TYPE,
    STATE,
    YEAR,
)
from tempestry.sources.sinks import write_csv, write_metrics_json


def reports(rollup: DataFrame) -> dict[str, DataFrame]:
    """Every additive report by name, ordered and cut as readers expect it."""
    trend = rolled.magnitude_trend(rollup)
    by_scale = rolled.tornado_summary(rollup, "severe_scale")
    by_impact = rolled.tornado_summary(rollup, "severe_impact")
    frequency = rolled.state_event_frequency(rollup)
    means = rolled.mean_by_type(rollup)

    def top_harm(*keys):
        return top_k(rolled.harm_stats(rollup, *keys), "total_harm", keys)

    def top_impact(*keys):
        return top_k(rolled.total_impact(rollup, *keys), "total_impact", keys)

    by_type = rolled.impact_by_type(rollup)
    return {
        "magnitude_trend": trend.orderBy(YEAR),
        "max_magnitude_by_year": rolled.max_magnitude_by_year(rollup).orderBy(YEAR),
        "band_counts": rolled.band_counts(rollup).orderBy(YEAR, "band"),
        "spearman_trend": spearman_test(trend, YEAR, "avg_magnitude"),
        "tornado_summary_by_scale": sort_desc(by_scale, "tornado_count", [STATE]),
        "tornado_summary_by_impact": sort_desc(by_impact, "tornado_count", [STATE]),
        "state_event_frequency": sort_desc(frequency, "event_count", [STATE, EVENT_TYPE]),
        "flood_means": means,
        "flood_relative": relative_to_baseline(means),
        "top_impact_by_county": top_impact(STATE, CZ_NAME),
        "top_impact_by_state": top_impact(STATE),
        "top_impact_by_event_type": top_impact(EVENT_TYPE),
        "top_impact_by_type": top_k(
            by_type, by_type.injuries + by_type.deaths, [EVENT_TYPE, MAGNITUDE_TYPE]
        ),
        "harm_overview": rolled.harm_overview(rollup),
        "top_harm_by_event_type": top_harm(EVENT_TYPE),
        "top_harm_by_state": top_harm(STATE),
        "top_harm_by_county": top_harm(STATE, CZ_NAME),
        "top_harm_by_event_state": top_harm(EVENT_TYPE, STATE),
        "harm_by_magnitude_type": sort_desc(
            rolled.harm_stats(rollup, MAGNITUDE_TYPE, missing=NO_MAGNITUDE_TYPE),
            "total_harm",
            [MAGNITUDE_TYPE],
        ),
        "top_event_count_by_location": top_k(
            rolled.event_count_by_location(rollup), "event_count", [STATE, CZ_NAME]
        ),
    }


def write_reports(events: DataFrame, out: str) -> None:
    """Scan the events once, keep the rollup as a table, write each report."""
    spark = events.sparkSession
    rolled.event_rollup(events).write.mode("overwrite").parquet(f"{out}/rollup")
    rollup = spark.read.parquet(f"{out}/rollup")
    for name, frame in reports(rollup).items():
        write_csv(frame, f"{out}/{name}")


def write_model_report(events: DataFrame, out: str, row_id=EVENT_ID, **training) -> None:
    """Train the harm model and write its quality and what it relies on.

    The features are kept as a table, one partition per split: training and both
    evaluations read only their own rows, and the table outlives lost executors.
    """
    spark = events.sparkSession
    marked = build_features(events, row_id).withColumn("split", split_name(row_id))
    marked.write.mode("overwrite").partitionBy("split").parquet(f"{out}/features")
    features = spark.read.parquet(f"{out}/features")
    train, validation, test = (
        features.where(F.col("split") == name).drop("split") for name, _ in SPLITS
    )
    model = train_harm_model(train, row_id, **training)
    model.write().overwrite().save(f"{out}/model")
    quality = {}
    for name, rows in (("val", validation), ("test", test)):
        scored = model.transform(rows)
        quality[f"{name}_auc"] = area_under_roc(scored)
        quality[f"{name}_accuracy"] = accuracy(scored).head()[0]
    scored = model.transform(test)
    importances = feature_importance(model, scored)
    write_csv(class_distribution(features).orderBy(HAS_HARM), f"{out}/class_distribution")
    write_csv(
        confusion_matrix(scored).orderBy(HAS_HARM, "prediction"), f"{out}/confusion_matrix"
    )
    write_csv(importances, f"{out}/feature_importance")
    write_csv(group_importance(importances), f"{out}/group_importance")
    write_csv(storm_vs_location(importances), f"{out}/storm_vs_location")
    write_csv(top_categories(importances, EVENT_TYPE), f"{out}/top_event_importance")
    write_csv(top_categories(importances, STATE), f"{out}/top_state_importance")
    write_metrics_json(results_record(quality, importances), f"{out}/results")
