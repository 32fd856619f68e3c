"""Helpers of the corpus operators: reading tables, columns as bytes, Arrow output."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempestry.session import ship_package

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Make a session ready: smaller Arrow batches, and the package on the executors.

    Documents are long rows, and workers hold a batch in more than one form; a setting
    other than Spark's default stays. A job that was submitted with the package in
    ``--py-files`` does not need this.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")
    ship_package(spark)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bytes_of(column):
    """A text column as its UTF-8 bytes, null as none."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def emit(schema: pa.Schema, **columns):
    """One record batch with the columns of ``schema``."""
    return pa.RecordBatch.from_arrays(
        [
            c if isinstance(c, pa.Array) else pa.array(c, type=schema.field(name).type)
            for name, c in ((n, columns[n]) for n in schema.names)
        ],
        schema=schema,
    )


def _run_starts(table, keys):
    """Places where a row's ``keys`` differ from those of the row before it."""
    differs = np.zeros(max(0, table.num_rows - 1), dtype=bool)
    for key in keys:
        codes = table.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices
        differs |= np.diff(codes.to_numpy(zero_copy_only=False)) != 0
    return np.flatnonzero(differs) + 1


def groups_of(batches, keys):
    """The rows of a sorted stream, cut so that no group of ``keys`` is divided.

    Yields tables that each hold whole groups; at most one group and one incoming
    batch wait in memory, and each row is looked at once.
    """
    waiting, last = [], None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        starts = _run_starts(table, keys)
        first = [table.column(k)[0].as_py() for k in keys]
        if waiting and first != last:
            yield pa.concat_tables(waiting)
            waiting = []
        if len(starts):
            cut = int(starts[-1])
            yield pa.concat_tables([*waiting, table.slice(0, cut)])
            waiting = []
            table = table.slice(cut)
        waiting.append(table)
        last = [table.column(k)[0].as_py() for k in keys]
    if waiting:
        yield pa.concat_tables(waiting)
