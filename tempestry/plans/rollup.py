"""One pass over the events that serves every additive report.

Counts, sums and maxima per (year, state, county, event type, magnitude type)
are enough to derive the harm, impact, frequency, tornado, damage and trend
reports. At scale the events are scanned and shuffled once, already combined
within each task, and each report reads the small rollup. The functions here
give the same rows as the operators that read events directly.
"""

from functools import reduce
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tempestry.functions.coerce import amount_measure, label_or, safe_int
from tempestry.functions.rules import (
    band_names,
    severe_by_impact,
    severe_by_scale,
    valid_magnitude,
)
from tempestry.operators.impact import impact_measures_parse
from tempestry.operators.rows import present, with_injuries_deaths, with_total_harm
from tempestry.schema import (
    CZ_NAME,
    EVENT_TYPE,
    FLASH_FLOOD,
    FLOOD,
    IMPACT_MEASURES,
    MAGNITUDE_EDGES,
    MAGNITUDE_TYPE,
    STATE,
    TORNADO,
    TOTAL_HARM,
    UNKNOWN_TITLE,
    UNKNOWN_UPPER,
    YEAR,
)

GRAIN = (YEAR, STATE, CZ_NAME, EVENT_TYPE, MAGNITUDE_TYPE)


def _band_column(index):
    return f"band_{index}"


def event_rollup(df: DataFrame, thresholds=(50, 20), edges=MAGNITUDE_EDGES) -> DataFrame:
    """Additive measures of all events per grain tuple, missing keys as NULL."""
    year = F.col(YEAR)
    if not isinstance(df.schema[YEAR].dataType, IntegralType):
        year = safe_int(year.cast("string"))
    measures = {
        "_m": valid_magnitude(df),
        "_readable": impact_measures_parse(df),
        "_complete": reduce(lambda a, b: a & b, [present(df, m) for m in IMPACT_MEASURES]),
        "_severe_impact": severe_by_impact(df),
        "_severe_scale": severe_by_scale(),
        **{f"_v_{m}": amount_measure(df, m) for m in IMPACT_MEASURES},
    }
    rows = with_injuries_deaths(with_total_harm(df.withColumns(measures))).withColumn(YEAR, year)

    def count_if(condition, name):
        return F.count_if(condition).alias(name)

    m, harm, readable = F.col("_m"), F.col(TOTAL_HARM), F.col("_readable")
    in_band = [m < edges[0], *[(m >= a) & (m < b) for a, b in pairwise(edges)], m >= edges[-1]]
    return rows.groupBy(*GRAIN).agg(
        F.count(F.lit(1)).alias("events"),
        count_if(harm > 0, "harmful_events"),
        F.sum(harm).alias("harm"),
        count_if(readable, "readable_events"),
        F.sum(F.when(readable, F.col("injuries"))).alias("injuries"),
        F.sum(F.when(readable, F.col("deaths"))).alias("deaths"),
        count_if(F.col("_severe_impact"), "severe_impact"),
        count_if(F.col("_severe_scale"), "severe_scale"),
        F.count(m).alias("magnitudes"),
        F.sum(m).alias("magnitude_sum"),
        F.max(m).alias("magnitude_max"),
        *[count_if(m > t, f"over_{t}") for t in thresholds],
        *[count_if(inside, _band_column(i)) for i, inside in enumerate(in_band)],
        *[
            aggregate
            for c in IMPACT_MEASURES
            for aggregate in (
                F.count(F.when(F.col("_complete"), F.col(f"_v_{c}"))).alias(f"n_{c.lower()}"),
                F.sum(F.when(F.col("_complete"), F.col(f"_v_{c}"))).alias(f"sum_{c.lower()}"),
            )
        ],
        count_if(F.col("_complete"), "complete_events"),
    )


def _some(count):
    """Keep only groups that have rows of the kind the report is about."""
    return F.col(count) > 0


def harm_stats(rollup: DataFrame, *keys, missing=UNKNOWN_UPPER) -> DataFrame:
    labelled = rollup.where(_some("harmful_events")).select(
        *[label_or(k, missing).alias(k) for k in keys], "harm", "harmful_events"
    )
    total, events = F.sum("harm"), F.sum("harmful_events")
    return labelled.groupBy(*keys).agg(
        total.alias("total_harm"),
        events.alias("event_count"),
        (total / events).alias("avg_harm"),
    )


def harm_overview(rollup: DataFrame) -> DataFrame:
    total = F.coalesce(F.sum("harm"), F.lit(0))
    events = F.coalesce(F.sum("harmful_events"), F.lit(0))
    return rollup.agg(
        events.alias("events_with_harm"),
        total.alias("total_harm"),
        F.try_divide(total, events).alias("avg_harm"),
    )


def total_impact(rollup: DataFrame, *keys) -> DataFrame:
    impact = F.sum(F.col("injuries") + F.col("deaths"))
    return _readable(rollup).groupBy(*keys).agg(impact.alias("total_impact"))


def impact_by_type(rollup: DataFrame) -> DataFrame:
    return (
        _readable(rollup)
        .groupBy(EVENT_TYPE, MAGNITUDE_TYPE)
        .agg(F.sum("injuries").alias("injuries"), F.sum("deaths").alias("deaths"))
    )


def _readable(rollup: DataFrame) -> DataFrame:
    return rollup.where(_some("readable_events")).withColumn(
        MAGNITUDE_TYPE, label_or(MAGNITUDE_TYPE, UNKNOWN_TITLE)
    )


def state_event_frequency(rollup: DataFrame, keys=(STATE, EVENT_TYPE)) -> DataFrame:
    complete = reduce(lambda a, b: a & b, [present(rollup, k) for k in keys])
    return rollup.where(complete).groupBy(*keys).agg(F.sum("events").alias("event_count"))


def event_count_by_location(rollup: DataFrame, keys=(STATE, CZ_NAME)) -> DataFrame:
    labelled = rollup.select(*[label_or(k, UNKNOWN_UPPER).alias(k) for k in keys], "events")
    return labelled.groupBy(*keys).agg(F.sum("events").alias("event_count"))


def tornado_summary(rollup: DataFrame, severe="severe_scale", event_type=TORNADO) -> DataFrame:
    """``severe`` names the rule: ``severe_scale`` or ``severe_impact``."""
    state = label_or(STATE, UNKNOWN_TITLE).alias(STATE)
    return (
        rollup.where(F.col(EVENT_TYPE) == event_type)
        .groupBy(state)
        .agg(
            F.sum("events").alias("tornado_count"),
            F.sum(severe).alias("severe_tornado_count"),
        )
    )


def mean_by_type(
    rollup: DataFrame, types=(FLOOD, FLASH_FLOOD), measures=IMPACT_MEASURES
) -> DataFrame:
    """Types without a complete event are absent."""
    return (
        rollup.where(F.col(EVENT_TYPE).isin(*types) & _some("complete_events"))
        .groupBy(EVENT_TYPE)
        .agg(
            *[
                F.try_divide(F.sum(f"sum_{m.lower()}"), F.sum(f"n_{m.lower()}")).alias(
                    f"avg_{m.lower()}"
                )
                for m in measures
            ]
        )
    )


def magnitude_trend(rollup: DataFrame, thresholds=(50, 20)) -> DataFrame:
    measured = rollup.where(_some("magnitudes") & F.col(YEAR).isNotNull())
    return measured.groupBy(YEAR).agg(
        (F.sum("magnitude_sum") / F.sum("magnitudes")).alias("avg_magnitude"),
        *[F.sum(f"over_{t}").alias(f"over_{t}") for t in thresholds],
    )


def max_magnitude_by_year(rollup: DataFrame) -> DataFrame:
    measured = rollup.where(_some("magnitudes") & F.col(YEAR).isNotNull())
    return measured.groupBy(YEAR).agg(F.max("magnitude_max").alias("max_magnitude"))


def band_counts(rollup: DataFrame, edges=MAGNITUDE_EDGES) -> DataFrame:
    columns = {_band_column(i): name for i, name in enumerate(band_names(edges))}
    per_year = (
        rollup.where(F.col(YEAR).isNotNull())
        .groupBy(YEAR)
        .agg(*[F.sum(c).alias(name) for c, name in columns.items()])
    )
    long = per_year.unpivot(YEAR, list(columns.values()), "band", "event_count")
    return long.where(F.col("event_count") > 0)
