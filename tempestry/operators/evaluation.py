"""Class balance and quality of predictions."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.operators.ranking import with_running_total
from tempestry.schema import HAS_HARM


def class_distribution(df: DataFrame, label=HAS_HARM) -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("event_count"))


def confusion_matrix(df: DataFrame, label=HAS_HARM, prediction="prediction") -> DataFrame:
    """Rows per class and predicted class."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("event_count"))


def accuracy(df: DataFrame, label=HAS_HARM, prediction="prediction") -> DataFrame:
    """One row: share of rows predicted right."""
    right = F.count_if(F.col(label).cast("double") == F.col(prediction).cast("double"))
    return df.agg(F.try_divide(right, F.count(F.lit(1))).alias("accuracy"))


def grouped_area_under_roc(df: DataFrame, group, label=HAS_HARM, score="score") -> DataFrame:
    """``(group, auc)``: exact area under the ROC curve of each group, ties as half.

    Rows of equal score are combined first, then running totals by ranges of (group,
    score) tell how many rows of the other class lie below; NULL without both classes.
    """
    counts = df.groupBy(group, F.col(score).alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("_hits"), F.count_if(F.col(label) == 0).alias("_misses")
    )
    ranked = with_running_total(counts, [group, "_score"], "_misses", "_below")
    # misses of earlier groups are below too: take off the smallest total of the group
    pairs = F.sum(F.col("_hits") * (F.col("_below") + F.col("_misses") / 2))
    hits, misses = F.sum("_hits"), F.sum("_misses")
    return ranked.groupBy(group).agg(
        F.try_divide(pairs - hits * F.min("_below"), hits * misses).alias("auc")
    )


def area_under_roc(df: DataFrame, label=HAS_HARM, score="rawPrediction", bins=0) -> float:
    """Area under the ROC curve; exact with ``bins=0``.

    Equal scores are combined before the curve is built, and the curve itself
    stays distributed, so neither depends on the number of rows.
    """
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=score, metricName="areaUnderROC", numBins=bins
    )
    return evaluator.evaluate(df)
