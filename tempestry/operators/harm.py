"""Harm to people over the events that harmed someone."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.operators.rows import fill_missing, filter_harmful, with_total_harm
from tempestry.schema import (
    CZ_NAME,
    EVENT_TYPE,
    MAGNITUDE_TYPE,
    NO_MAGNITUDE_TYPE,
    STATE,
    TOTAL_HARM,
    UNKNOWN_UPPER,
)


def harmful_events(df: DataFrame) -> DataFrame:
    return filter_harmful(with_total_harm(df))


def harm_stats(df: DataFrame, *keys, missing=UNKNOWN_UPPER) -> DataFrame:
    """Per key tuple: people harmed, harmful events, people per harmful event.

    Sums are combined within each task before the shuffle, so a key that holds
    most rows sends one row per task like any other.
    """
    labelled = fill_missing(harmful_events(df), dict.fromkeys(keys, missing))
    total, events = F.sum(TOTAL_HARM), F.count(F.lit(1))
    return labelled.groupBy(*keys).agg(
        total.alias("total_harm"),
        events.alias("event_count"),
        (total / events).alias("avg_harm"),
    )


def harm_by_event_type(df: DataFrame) -> DataFrame:
    return harm_stats(df, EVENT_TYPE)


def harm_by_magnitude_type(df: DataFrame) -> DataFrame:
    return harm_stats(df, MAGNITUDE_TYPE, missing=NO_MAGNITUDE_TYPE)


def harm_by_state(df: DataFrame) -> DataFrame:
    return harm_stats(df, STATE)


def harm_by_county(df: DataFrame) -> DataFrame:
    return harm_stats(df, STATE, CZ_NAME)


def harm_by_event_state(df: DataFrame) -> DataFrame:
    return harm_stats(df, EVENT_TYPE, STATE)


def harm_overview(df: DataFrame) -> DataFrame:
    """One row: harmful events, people harmed, people per event (NULL if none)."""
    total, events = F.sum(TOTAL_HARM), F.count(F.lit(1))
    return harmful_events(df).agg(
        events.alias("events_with_harm"),
        F.coalesce(total, F.lit(0)).alias("total_harm"),
        F.try_divide(total, events).alias("avg_harm"),
    )
