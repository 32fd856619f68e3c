"""Overview, null profile, samples and reuse of a cleaned table."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.schema import EVENT_ID


def dataset_overview(df: DataFrame) -> DataFrame:
    """One row: rows, columns, partitions that hold rows, column names."""
    per_partition = df.groupBy(F.spark_partition_id().alias("partition")).count()
    return per_partition.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.count(F.lit(1)).alias("partition_count"),
        F.first(F.array(*[F.lit(c) for c in df.columns])).alias("column_names"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of each column that has nulls, in one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count").where(
        F.col("null_count") > 0
    )


def sample_events(df: DataFrame, n: int, order_by=(EVENT_ID,)) -> DataFrame:
    """The first ``n`` rows by ``order_by``: the same rows on every run."""
    return df.orderBy(*order_by).limit(n)


def cache_clean(df: DataFrame, path: str | None = None) -> DataFrame:
    """Keep a cleaned table for several analyses.

    With a path it is written once as Parquet and read back, which is the choice
    for tables larger than the cluster's memory; otherwise it is persisted,
    spilling to disk, and recomputed from its lineage if executors are lost.
    """
    if path is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
