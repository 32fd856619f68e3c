"""CSV records held one per text line, with rejects kept apart."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tempestry.functions.coerce import measure_parses
from tempestry.schema import HARM_COLUMNS

# A quoted run that starts a field, or follows such a run directly (a doubled
# quote), up to its closing quote or the end of an unterminated field.
_RAGGED = "_ragged_record"
_QUOTED_RUN = r'(^|,|\G(?!^))"[^"]*+(?:"|$)'


def field_count(line="value"):
    """Number of comma-separated fields, not counting commas inside quotes."""
    text = F.col(line)
    bare = F.when(F.contains(text, F.lit('"')), F.regexp_replace(text, _QUOTED_RUN, "$1")).otherwise(text)
    return F.when(text != "", F.size(F.split(bare, ","))).when(text == "", F.lit(0))


def strip_header(lines: DataFrame, header: str | None = None, line="value") -> DataFrame:
    """Drop every line equal to the header (by default the first line).

    Lines of several files may have several headers: call it with each of them.
    """
    if header is None:
        first = lines.select(line).head()
        if first is None:
            return lines
        header = first[0]
    return lines.where(~F.col(line).eqNullSafe(F.lit(header)))


def parse_csv_lines(lines: DataFrame, columns, line="value", keep=()) -> DataFrame:
    """Parse one record per line into text columns named ``columns``.

    Quoted commas are respected. ``keep`` names columns of ``lines`` to carry
    along; ``field_count`` tells short records, whose missing fields are NULL.

    The record is unfolded by a generator, which later filters stay above: each
    line is parsed once, however many fields they look at.
    """
    fields = [StructField(c, StringType()) for c in (*columns, _RAGGED)]
    record = F.from_csv(
        F.col(line),
        StructType(fields).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
        {
            "mode": "PERMISSIVE",
            "quote": '"',
            "escape": '"',
            "columnNameOfCorruptRecord": _RAGGED,
        },
    )
    parsed = lines.select(*keep, line, F.inline(F.array(record)))
    # the parser marks ragged records; only those are worth counting
    whole = F.col(_RAGGED).isNull() & (F.col(line) != "")
    count = F.when(whole, F.lit(len(columns))).otherwise(field_count(line))
    return parsed.select(*keep, line, count.alias("field_count"), *columns)


def mark_valid(records: DataFrame, min_fields=None, measures=HARM_COLUMNS, out="valid") -> DataFrame:
    """Add whether a record is long enough and its measures are blank or numeric.

    Works on ``parse_csv_lines`` output, or on any table of text measures when
    ``min_fields`` is None. Written once, partitioned by the flag, it gives both the
    valid records and the rejects from one parse.
    """
    checks = [measure_parses(m) for m in measures]
    if min_fields is not None:
        checks.append(F.col("field_count") >= min_fields)
    valid = F.coalesce(reduce(lambda a, b: a & b, checks), F.lit(False))
    return records.withColumn(out, valid)


def split_valid_rejects(
    records: DataFrame, min_fields=None, measures=HARM_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """Records long enough whose measures are blank or numeric, and the others.

    Every input row lands in exactly one of the two. Both parse; where both are used,
    write ``mark_valid`` instead.
    """
    marked = mark_valid(records, min_fields, measures, "_valid")
    return marked.where("_valid").drop("_valid"), marked.where("NOT _valid").drop("_valid")
