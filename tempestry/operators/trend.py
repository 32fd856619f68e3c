"""Magnitude over the years."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tempestry.functions.coerce import safe_int
from tempestry.functions.distributions import correlation_p_value
from tempestry.functions.rules import magnitude_band
from tempestry.operators.ranking import with_running_total
from tempestry.operators.rows import magnitude_over, with_valid_magnitude
from tempestry.schema import MAGNITUDE, MAGNITUDE_EDGES, YEAR
from tempestry.session import materialize


def yearly_magnitudes(df: DataFrame) -> DataFrame:
    """Year and magnitude of rows where both are usable."""
    year = F.col(YEAR)
    if not isinstance(df.schema[YEAR].dataType, IntegralType):
        year = safe_int(year.cast("string"))
    pairs = with_valid_magnitude(df.select(year.alias(YEAR), MAGNITUDE))
    return pairs.where(F.col(YEAR).isNotNull())


def avg_magnitude_by_year(df: DataFrame) -> DataFrame:
    return yearly_magnitudes(df).groupBy(YEAR).agg(F.avg(MAGNITUDE).alias("avg_magnitude"))


def max_magnitude_by_year(df: DataFrame) -> DataFrame:
    return yearly_magnitudes(df).groupBy(YEAR).agg(F.max(MAGNITUDE).alias("max_magnitude"))


def count_over_by_year(df: DataFrame, threshold) -> DataFrame:
    """Events above the threshold per year; years with none are absent."""
    over = magnitude_over(yearly_magnitudes(df), threshold)
    return over.groupBy(YEAR).agg(F.count(F.lit(1)).alias("event_count"))


def magnitude_trend(df: DataFrame, thresholds=(50, 20)) -> DataFrame:
    """Mean and the counts above each threshold per year, in one pass.

    Unlike ``count_over_by_year``, a year with none above a threshold shows 0.
    """
    counts = [F.count_if(F.col(MAGNITUDE) > t).alias(f"over_{t}") for t in thresholds]
    return (
        yearly_magnitudes(df)
        .groupBy(YEAR)
        .agg(F.avg(MAGNITUDE).alias("avg_magnitude"), *counts)
    )


def band_counts(df: DataFrame, edges=MAGNITUDE_EDGES) -> DataFrame:
    """Events per year and magnitude band."""
    banded = yearly_magnitudes(df).select(YEAR, magnitude_band(edges=edges).alias("band"))
    return banded.groupBy(YEAR, "band").agg(F.count(F.lit(1)).alias("event_count"))


def _ranked_by_ranges(pairs: DataFrame) -> DataFrame:
    """Pairs with ``_rank_x`` and ``_rank_y``, the values of both ranked in one pass by ranges.

    Those of ``_y`` stand behind those of ``_x``: a correlation does not see that shift.
    """
    kinds = {f.name: f.dataType for f in pairs.schema.fields}
    none = {c: F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()}
    sides = (
        F.struct(F.lit(0).alias("_of"), "_x", none["_y"]),
        F.struct(F.lit(1).alias("_of"), none["_x"], "_y"),
    )
    values = pairs.select(F.inline(F.array(*sides))).groupBy("_of", "_x", "_y")
    counts = values.agg(F.count(F.lit(1)).alias("_n"))
    ranked = with_running_total(counts, ["_of", "_x", "_y"], "_n", "_before")
    rank = F.col("_before") + (F.col("_n") + 1) / 2
    ranked_x = ranked.where("_of = 0").select("_x", rank.alias("_rank_x"))
    ranked_y = ranked.where("_of = 1").select("_y", rank.alias("_rank_y"))
    return pairs.join(ranked_x, "_x").join(ranked_y, "_y")


def _average_rank(column: str):
    """Mean place of a row and its equals, over all rows: for tables of a known small size."""
    order = Window.orderBy(column)
    upto = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (F.rank().over(order) + F.count(F.lit(1)).over(upto)) / 2


def spearman_test(pairs: DataFrame, x: str, y: str, one_task=100_000) -> DataFrame:
    """Rank correlation of two columns with the number of pairs and its two-sided p-value.

    Pairs with a NULL take no part; ties stand at their average rank. The pairs are written
    once and counted: up to ``one_task`` of them, such as the years of a trend, are ranked
    in one task, more by ranges. ``rho`` is NULL if a column is constant, ``p_value`` also
    below three pairs.
    """
    pairs = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = materialize(pairs.select(F.col(x).alias("_x"), F.col(y).alias("_y")), "pairs")
    if pairs.count() <= one_task:
        both = pairs.select(_average_rank("_x").alias("_rank_x"), _average_rank("_y").alias("_rank_y"))
    else:
        both = _ranked_by_ranges(pairs)
    # F.corr fails on a constant column
    spread = F.sqrt(F.var_pop("_rank_x") * F.var_pop("_rank_y"))
    rho = F.try_divide(F.covar_pop("_rank_x", "_rank_y"), spread)
    found = both.agg(rho.alias("rho"), F.count(F.lit(1)).alias("n"))
    return found.withColumn("p_value", correlation_p_value(F.col("rho"), F.col("n")))


def spearman(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation of two columns, ties at their average rank."""
    return spearman_test(pairs, x, y).select("rho")


def spearman_trend(df: DataFrame) -> DataFrame:
    """Rank correlation of the yearly mean magnitude with the year."""
    return spearman(avg_magnitude_by_year(df), YEAR, "avg_magnitude")


def spearman_trend_test(df: DataFrame) -> DataFrame:
    """That correlation with the number of years and its two-sided p-value."""
    return spearman_test(avg_magnitude_by_year(df), YEAR, "avg_magnitude")
