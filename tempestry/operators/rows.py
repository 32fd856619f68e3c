"""Row-level steps: filling, deriving and filtering. None of them shuffles."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from tempestry.functions.coerce import (
    bare_suffix,
    blank_to_null,
    int_measure,
    known_number,
    label_or,
    safe_float,
    safe_int,
)
from tempestry.functions.rules import add_up, valid_magnitude
from tempestry.schema import (
    DEATH_COLUMNS,
    EVENT_TYPE,
    HARM_COLUMNS,
    HAS_HARM,
    INJURY_COLUMNS,
    MAGNITUDE,
    STATE,
    TOTAL_HARM,
    YEAR,
)


def project(df: DataFrame, *columns) -> DataFrame:
    """Keep the named columns; the scan then reads only those."""
    return df.select(*columns)


def fill_missing(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace missing values: a text default also replaces empty text.

    A numeric default reads a text column as numbers, unparseable and NaN as missing.
    """

    def filled(name, default):
        kind = df.schema[name].dataType
        if isinstance(default, str):
            return label_or(name, default)
        column = F.col(name)
        if isinstance(kind, StringType):
            whole = isinstance(default, int) and not isinstance(default, bool)
            number = safe_float(column)
            column = safe_int(column, via_float=True, kind="bigint") if whole else known_number(number)
        elif isinstance(kind, (DoubleType, FloatType)):
            column = known_number(column)
        return F.coalesce(column, F.lit(default))

    return df.withColumns({name: filled(name, default) for name, default in defaults.items()})


def with_total_harm(df: DataFrame, out=TOTAL_HARM) -> DataFrame:
    """Add injuries and deaths, direct and indirect, missing as 0."""
    return df.withColumn(out, add_up(int_measure(df, c) for c in HARM_COLUMNS))


def with_has_harm(df: DataFrame, harm=TOTAL_HARM, out=HAS_HARM) -> DataFrame:
    """Add 1 where harm is above 0, else 0."""
    return df.withColumn(out, F.when(F.col(harm) > 0, 1).otherwise(0))


def with_injuries_deaths(df: DataFrame, injuries="injuries", deaths="deaths") -> DataFrame:
    """Add direct + indirect injuries and direct + indirect deaths."""
    return df.withColumns(
        {
            injuries: add_up(int_measure(df, c) for c in INJURY_COLUMNS),
            deaths: add_up(int_measure(df, c) for c in DEATH_COLUMNS),
        }
    )


def filter_harmful(df: DataFrame, harm=TOTAL_HARM) -> DataFrame:
    """Keep events that harmed someone."""
    return df.where(F.col(harm) > 0)


def filter_event_type(df: DataFrame, *types, column=EVENT_TYPE) -> DataFrame:
    """Keep events of the given types."""
    return df.where(F.col(column).isin(*types))


def present(df: DataFrame, name: str) -> Column:
    """True where the field is neither NULL nor empty text."""
    text = isinstance(df.schema[name].dataType, StringType)
    return (blank_to_null(name) if text else F.col(name)).isNotNull()


def require_complete(df: DataFrame, columns) -> DataFrame:
    """Drop rows with any listed field missing or empty."""
    return df.where(reduce(lambda a, b: a & b, [present(df, c) for c in columns]))


def require_not_null(df: DataFrame, columns=(EVENT_TYPE, STATE)) -> DataFrame:
    """Drop rows with any listed field NULL."""
    return df.dropna(subset=list(columns))


def drop_suffix_only(df: DataFrame, column) -> DataFrame:
    """Drop rows whose damage value is a suffix without a number."""
    return df.where(~F.coalesce(bare_suffix(column), F.lit(False)))


def with_valid_magnitude(df: DataFrame, magnitude=MAGNITUDE) -> DataFrame:
    """Keep rows whose magnitude parses and is not 0, as double."""
    return df.withColumn(magnitude, valid_magnitude(df, magnitude)).where(
        F.col(magnitude).isNotNull()
    )


def magnitude_over(df: DataFrame, threshold, magnitude=MAGNITUDE) -> DataFrame:
    """Keep rows strictly above the threshold."""
    return df.where(F.col(magnitude) > threshold)


def exclude_years(df: DataFrame, *years, year=YEAR) -> DataFrame:
    """Drop the given years, such as a current year that is not complete.

    Rows without a year stay.
    """
    return df.where(~F.coalesce(F.col(year).isin(*years), F.lit(False)))
