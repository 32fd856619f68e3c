"""Writers: CSV, metrics as JSON, Parquet by year."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.schema import YEAR


def write_csv(df: DataFrame, path: str, single=False, limit=None, order_by=()) -> None:
    """Write CSV with a header, replacing what is there.

    ``single`` gathers the rows into one file and so needs a ``limit``: a whole
    table is never pulled through one task. A ``limit`` needs ``order_by``.
    """
    if single and limit is None:
        raise ValueError("single=True needs a limit")
    if limit is not None:
        if not order_by:
            raise ValueError("limit needs order_by: which rows stay must not be left to chance")
        df = df.orderBy(*order_by).limit(limit)
    if single:
        df = df.coalesce(1)
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_metrics_json(metrics: DataFrame, path: str) -> None:
    """Write a one-row metrics frame as a JSON record."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def write_by_year(df: DataFrame, path: str, year=YEAR) -> None:
    """Convert to Parquet partitioned by year, so year filters prune files.

    The rebalance hint shuffles by year but splits a year that is too large for
    one task, so one crowded year neither stalls the job nor makes one huge file.
    """
    (
        df.hint("rebalance", F.col(year))
        .write.mode("overwrite")
        .partitionBy(year)
        .parquet(path)
    )
