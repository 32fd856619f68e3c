"""Injuries and deaths by place and by type, over all readable records."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tempestry.functions.coerce import label_or, measure_parses
from tempestry.operators.rows import with_injuries_deaths
from tempestry.schema import (
    CZ_NAME,
    EVENT_TYPE,
    HARM_COLUMNS,
    MAGNITUDE_TYPE,
    STATE,
    UNKNOWN_TITLE,
)


def impact_measures_parse(df: DataFrame) -> Column:
    """True where every text measure is blank or numeric; typed measures always are."""
    text = [c for c in HARM_COLUMNS if isinstance(df.schema[c].dataType, StringType)]
    return reduce(lambda a, b: a & b, [measure_parses(c) for c in text], F.lit(True))


def impact_records(df: DataFrame) -> DataFrame:
    """State, county, type, magnitude type, injuries and deaths of each record.

    A record with a text measure that is neither blank nor numeric is left out;
    ``split_valid_rejects`` returns such records.
    """
    return with_injuries_deaths(df.where(impact_measures_parse(df))).select(
        STATE,
        CZ_NAME,
        EVENT_TYPE,
        label_or(MAGNITUDE_TYPE, UNKNOWN_TITLE).alias(MAGNITUDE_TYPE),
        "injuries",
        "deaths",
    )


def total_impact(df: DataFrame, *keys) -> DataFrame:
    """Injuries plus deaths per key tuple."""
    impact = F.sum(F.col("injuries") + F.col("deaths"))
    return impact_records(df).groupBy(*keys).agg(impact.alias("total_impact"))


def impact_by_county(df: DataFrame) -> DataFrame:
    return total_impact(df, STATE, CZ_NAME)


def impact_by_state(df: DataFrame) -> DataFrame:
    return total_impact(df, STATE)


def impact_by_event_type(df: DataFrame) -> DataFrame:
    return total_impact(df, EVENT_TYPE)


def impact_by_type(df: DataFrame) -> DataFrame:
    """Injuries and deaths, apart, per event type and magnitude type."""
    return (
        impact_records(df)
        .groupBy(EVENT_TYPE, MAGNITUDE_TYPE)
        .agg(F.sum("injuries").alias("injuries"), F.sum("deaths").alias("deaths"))
    )
