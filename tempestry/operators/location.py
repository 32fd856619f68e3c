"""Attaching per-place values to events."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.schema import CZ_NAME, EVENT_COUNT_PER_CZ, STATE
from tempestry.session import materialize

PLACE = (STATE, CZ_NAME)


def location_counts(df: DataFrame, keys=PLACE, out=EVENT_COUNT_PER_CZ) -> DataFrame:
    """Events per place, over rows that name every part of the place."""
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(named).groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def attach_lookup(df: DataFrame, lookup: DataFrame, keys) -> DataFrame:
    """Left join of a big table to one with a row per key tuple.

    The lookup is computed first, as a written table whose real size the planner
    sees: below the broadcast threshold the big table is not shuffled at all,
    above it both sides are shuffled and adaptive execution splits a partition
    that one crowded key makes too large. A window over the key would instead
    put all rows of that key into one task.
    """
    return df.join(materialize(lookup, "lookup"), list(keys), "left")


def with_location_count(
    df: DataFrame, keys=PLACE, counts: DataFrame | None = None, out=EVENT_COUNT_PER_CZ
) -> DataFrame:
    """Add the number of events in the same place.

    1 where part of the place is NULL or the place is not counted. ``counts``
    supplies counts taken elsewhere, as over the training rows only.
    """
    if counts is None:
        counts = location_counts(df, keys, out)
    attached = attach_lookup(df, counts, keys)
    return attached.withColumn(out, F.coalesce(F.col(out), F.lit(1)))


def with_density(
    df: DataFrame, density: DataFrame, column: str, keys=PLACE, fallback=EVENT_COUNT_PER_CZ
) -> DataFrame:
    """Add a population density from a caller's table with one row per place.

    A place the table lacks gets the event count, the usual stand-in. A place that
    stands on several rows of the table has their mean.
    """
    density = density.groupBy(*keys).agg(F.avg(column).alias(column))
    if fallback not in df.columns:
        df = with_location_count(df, keys, out=fallback)
    attached = attach_lookup(df, density, keys)
    return attached.withColumn(
        column, F.coalesce(F.col(column).cast("double"), F.col(fallback).cast("double"))
    )
