"""How often which event happens where."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.operators.rows import fill_missing, require_complete
from tempestry.schema import CZ_NAME, EVENT_TYPE, STATE, UNKNOWN_UPPER


def state_event_frequency(df: DataFrame, keys=(STATE, EVENT_TYPE)) -> DataFrame:
    """Events per state and type, over rows that have both."""
    return (
        require_complete(df, keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def event_count_by_location(df: DataFrame, keys=(STATE, CZ_NAME)) -> DataFrame:
    """Events per place over all rows, missing parts under a label."""
    return (
        fill_missing(df, dict.fromkeys(keys, UNKNOWN_UPPER))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
