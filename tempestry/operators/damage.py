"""Mean damage and harm per event type, and relative to one type."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.functions.coerce import amount_measure
from tempestry.operators.rows import filter_event_type, require_complete
from tempestry.schema import EVENT_TYPE, FLASH_FLOOD, FLOOD, IMPACT_MEASURES


def mean_by_type(
    df: DataFrame, types=(FLOOD, FLASH_FLOOD), measures=IMPACT_MEASURES
) -> DataFrame:
    """True mean of each measure per type, over rows that have every measure.

    One pass serves all measures. A bare suffix is no number: it is left out of
    the mean of its own measure only.
    """
    complete = require_complete(filter_event_type(df, *types), measures)
    return complete.groupBy(EVENT_TYPE).agg(
        *[F.avg(amount_measure(df, m)).alias(f"avg_{m.lower()}") for m in measures]
    )


def relative_to_baseline(means: DataFrame, types=(FLOOD, FLASH_FLOOD), baseline=FLASH_FLOOD):
    """Each type's mean as a multiple of the baseline type's, to 2 decimals.

    One row per type and measure; NULL where the baseline is 0 or has no rows.
    """
    measures = [c for c in means.columns if c != EVENT_TYPE]
    long = means.unpivot(EVENT_TYPE, measures, "measure", "mean")
    wide = long.groupBy("measure").pivot(EVENT_TYPE, list(types)).agg(F.first("mean"))
    ratios = wide.select(
        "measure",
        *[
            F.round(F.try_divide(F.col(f"`{t}`"), F.col(f"`{baseline}`")), 2).alias(t)
            for t in types
        ],
    )
    return ratios.unpivot("measure", list(types), EVENT_TYPE, "ratio")
