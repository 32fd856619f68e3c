"""Events of one type, and the severe ones among them, by state."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempestry.functions.coerce import label_or
from tempestry.functions.rules import severe_by_impact, severe_by_scale
from tempestry.operators.rows import filter_event_type
from tempestry.schema import STATE, TORNADO, UNKNOWN_TITLE


def _by_state(events: DataFrame, *aggregates) -> DataFrame:
    state = label_or(STATE, UNKNOWN_TITLE).alias(STATE)
    return events.groupBy(state).agg(*aggregates)


def tornado_count_by_state(df: DataFrame, event_type=TORNADO) -> DataFrame:
    count = F.count(F.lit(1)).alias("tornado_count")
    return _by_state(filter_event_type(df, event_type), count)


def severe_count_by_state(
    df: DataFrame, event_type=TORNADO, severe: Column | None = None
) -> DataFrame:
    """Severe events per state, by impact unless another rule is given."""
    if severe is None:
        severe = severe_by_impact(df)
    count = F.count(F.lit(1)).alias("severe_tornado_count")
    return _by_state(filter_event_type(df, event_type).where(severe), count)


def severe_scale_by_state(df: DataFrame, event_type=TORNADO) -> DataFrame:
    return severe_count_by_state(df, event_type, severe_by_scale())


def tornado_summary(
    df: DataFrame, event_type=TORNADO, severe: Column | None = None
) -> DataFrame:
    """All and severe events per state in one pass, by scale unless told otherwise."""
    if severe is None:
        severe = severe_by_scale()
    return _by_state(
        filter_event_type(df, event_type),
        F.count(F.lit(1)).alias("tornado_count"),
        F.count_if(severe).alias("severe_tornado_count"),
    )


def tornado_summary_joined(counts: DataFrame, severe_counts: DataFrame) -> DataFrame:
    """The same from two per-state tables: left join, no severe event as 0."""
    return counts.join(severe_counts, STATE, "left").fillna(0, ["severe_tornado_count"])
