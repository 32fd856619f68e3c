"""Event rules: what is severe, which magnitudes count, magnitude bands."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tempestry.functions.coerce import (
    amount_measure,
    int_measure,
    known_number,
    label_or,
    safe_float,
    safe_int,
)
from tempestry.schema import (
    DAMAGE_CROPS,
    DAMAGE_PROPERTY,
    DEATH_COLUMNS,
    DEFAULT_SCALE,
    INJURY_COLUMNS,
    MAGNITUDE,
    MAGNITUDE_EDGES,
    SEVERE_DAMAGE,
    SEVERE_INJURIES,
    SEVERE_SCALES,
    TOR_F_SCALE,
)


def add_up(columns) -> Column:
    return reduce(lambda left, right: left + right, columns)


def _strict_count(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, NumericType):
        return int_measure(df, name)
    return safe_int(name, default=0, kind="bigint")


def severe_by_impact(
    df: DataFrame,
    prop=SEVERE_DAMAGE,
    crop=SEVERE_DAMAGE,
    deaths=0,
    injuries=SEVERE_INJURIES,
    parse_suffix=True,
) -> Column:
    """Property or crop damage, deaths or injuries above their thresholds.

    All comparisons are strict, infinite damage exceeds every threshold and NaN
    none. ``parse_suffix=False`` reads damage as a plain
    number only, so suffixed amounts count as 0.
    """

    def damage(name):
        if parse_suffix:
            return F.coalesce(amount_measure(df, name), F.lit(0.0))
        number = known_number(safe_float(F.col(name).cast("string")))
        return F.coalesce(number, F.lit(0.0))

    return (
        (damage(DAMAGE_PROPERTY) > prop)
        | (damage(DAMAGE_CROPS) > crop)
        | (add_up(_strict_count(df, c) for c in DEATH_COLUMNS) > deaths)
        | (add_up(_strict_count(df, c) for c in INJURY_COLUMNS) > injuries)
    )


def severe_by_scale(scale=TOR_F_SCALE, severe=SEVERE_SCALES, missing=DEFAULT_SCALE) -> Column:
    """The rating is one of the severe ones; a missing rating counts as mildest."""
    return label_or(scale, missing).isin(*severe)


def valid_magnitude(df: DataFrame, magnitude=MAGNITUDE) -> Column:
    """The magnitude as double where it parses, is a number and is not 0; else NULL."""
    if isinstance(df.schema[magnitude].dataType, NumericType):
        number = F.col(magnitude).cast("double")
    else:
        number = safe_float(magnitude)
    return F.when(~F.isnan(number) & (number != 0), number)


def band_names(edges=MAGNITUDE_EDGES) -> list[str]:
    return [f"{a}\N{EN DASH}{b}" for a, b in zip((0, *edges), edges)] + [f">{edges[-1]}"]


def magnitude_band(magnitude=MAGNITUDE, edges=MAGNITUDE_EDGES) -> Column:
    """Name of the half-open band the value falls in; the last band is open-ended."""
    value = F.col(magnitude) if isinstance(magnitude, str) else magnitude
    band = F.when(value.isNull(), F.lit(None).cast("string"))
    *bounded, last = band_names(edges)
    for name, upper in zip(bounded, edges):
        band = band.when(value < upper, F.lit(name))
    return band.otherwise(F.lit(last))
