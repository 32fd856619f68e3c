"""Coercion of text to numbers and labels, as built-in column expressions.

Spark runs in ANSI mode, where a plain cast of bad text fails the job, so every
conversion goes through ``try_cast``. The ``*_measure`` helpers look at the
declared type first: a column that is already numeric costs no text handling.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType

from tempestry.schema import AMOUNT_SUFFIXES

# What counts as a number. Checking before casting keeps out spellings that only
# Java's parser takes (5d, 5f, 0x1p3) and spares the costly failure of its parse.
_NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|nan|inf(?:inity)?)\s*$"


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _to_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def blank_to_null(column) -> Column:
    """Empty text counts as missing."""
    return F.nullif(_column(column), F.lit(""))


def label_or(column, label: str) -> Column:
    """Missing or empty text becomes ``label``."""
    return F.coalesce(blank_to_null(column), F.lit(label))


def safe_float(column, default=None) -> Column:
    """Text to double; unparseable becomes ``default`` (NULL when omitted)."""
    number = _to_double(_column(column))
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def safe_int(column, default=None, via_float=False, kind="int") -> Column:
    """Text to int; unparseable becomes ``default`` (NULL when omitted).

    ``via_float`` accepts decimal text and truncates toward zero; without it
    only integer text parses. ``kind="bigint"`` is for counts, which know no bound.
    """
    text = _column(column)
    number = (_to_double(text) if via_float else text).try_cast(kind)
    return number if default is None else F.coalesce(number, F.lit(int(default)))


def measure_parses(column) -> Column:
    """True for a measure that is blank or a finite number within bigint range."""
    text = _column(column)
    blank = text.isNull() | (F.trim(text) == "")
    return blank | safe_int(text, via_float=True, kind="bigint").isNotNull()


def parse_amount(column) -> Column:
    """Damage text to double: ``50.00K``, ``2.5M``, ``1B`` or a plain number.

    The suffix is case-sensitive. A bare suffix, like any other text without a
    number, is NULL.
    """
    text = _column(column)
    suffix = F.substring(text, -1, 1)
    body = F.substring(text, F.lit(1), F.length(text) - 1)
    amount = None
    for letter, factor in AMOUNT_SUFFIXES.items():
        branch = (F if amount is None else amount).when
        amount = branch(suffix == letter, _to_double(body) * F.lit(factor))
    return amount.otherwise(_to_double(text))


def bare_suffix(column) -> Column:
    """True for a damage value that is a suffix without a number."""
    return _column(column).isin(*AMOUNT_SUFFIXES)


def int_measure(df: DataFrame, name: str) -> Column:
    """A count column as bigint, missing or unparseable as 0."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, IntegralType):
        number = column
    elif isinstance(df.schema[name].dataType, NumericType):
        number = column.try_cast("bigint")
    else:
        number = safe_int(column, via_float=True, kind="bigint")
    return F.coalesce(number, F.lit(0)).cast("bigint")


def known_number(number: Column) -> Column:
    """The number, NULL where it is NaN, which Spark orders above all numbers."""
    return F.nanvl(number, F.lit(None).cast("double"))


def amount_measure(df: DataFrame, name: str) -> Column:
    """A damage or count column as double, unparseable or NaN as NULL."""
    if isinstance(df.schema[name].dataType, NumericType):
        return known_number(F.col(name).cast("double"))
    return known_number(parse_amount(name))
