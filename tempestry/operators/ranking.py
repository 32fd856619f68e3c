"""Ordering with a full tie-break, so results do not depend on partitioning."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tempestry.session import Scratch


def _order(by, keys):
    by = [by] if isinstance(by, str | Column) else list(by)
    columns = [F.col(c) if isinstance(c, str) else c for c in by]
    return [c.desc() for c in columns] + [F.col(k).asc() for k in keys]


def sort_desc(df: DataFrame, by, keys) -> DataFrame:
    """All rows, largest first, ties in key order."""
    return df.orderBy(*_order(by, keys))


def top_k(df: DataFrame, by, keys, k=10) -> DataFrame:
    """The ``k`` largest rows: each task keeps ``k``, nothing is fully sorted."""
    return df.orderBy(*_order(by, keys)).limit(k)


def with_running_total(df: DataFrame, order, amount=1, out="before") -> DataFrame:
    """Add the sum of ``amount`` over all rows that come earlier in ``order``.

    Rows are dealt out by ranges of the order and written with the number of their
    range, so the numbers hold. A total per range gives each range its start: a row
    per partition is all that any one task sees of the whole. ``order`` names columns
    that together tell rows apart.
    """
    amount = F.col(amount) if isinstance(amount, str) else F.lit(amount)
    scratch = Scratch(df.sparkSession)
    ranged = scratch.save(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged"
    )
    ranges = ranged.groupBy("_range").agg(F.sum(amount).alias("_total"))
    upto = F.sum("_total").over(Window.orderBy("_range"))
    ranges = ranges.select("_range", (upto - F.col("_total")).alias("_start"))
    earlier = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(amount).over(earlier), F.lit(0))
    return (
        ranged.join(ranges, "_range")
        .withColumn(out, F.col("_start") + inside)
        .drop("_range", "_start")
    )


def average_ranks(df: DataFrame, column: str, out="rank") -> DataFrame:
    """``(column, out)``: each distinct value with the average rank of its rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranked = with_running_total(counts, [column], "_n", "_before")
    return ranked.select(column, (F.col("_before") + (F.col("_n") + 1) / 2).alias(out))


def with_next_rows(df: DataFrame, order, columns, k=1, out="donors") -> DataFrame:
    """Add an array of structs of ``columns``: those of the next ``k`` rows in ``order``.

    The order is a ring: the last row is followed by the first, as often as ``k`` asks. Rows
    are dealt out by ranges and written once, whatever ``k`` is. What a range lacks at its
    end are the first rows of later ones: ``k`` rows per range are copied over.
    """
    scratch = Scratch(df.sparkSession)
    ranged = scratch.save(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged"
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    values = F.struct(*columns).alias("_values")
    placed = ranged.select("_range", values, F.row_number().over(inside).alias("_place"))
    heads = scratch.save(placed.where(F.col("_place") <= k), "heads")
    upto = F.sum("_size").over(Window.orderBy("_range"))  # a row per partition
    ranges = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    ranges = ranges.select("_range", "_size", upto.alias("_end"))
    ranges = scratch.save(ranges, "ranges")
    total = ranges.agg(F.max("_end")).head()[0] or 0
    heads = heads.join(ranges, "_range").select(
        (F.col("_end") - F.col("_size") + F.col("_place") - 1).alias("_at"), "_values"
    )
    step = F.explode(F.sequence(F.lit(1), F.lit(k))).alias("_step")
    wanted = ranges.select("_range", "_size", "_end", step)
    wanted = wanted.withColumn("_at", (F.col("_end") + F.col("_step") - 1) % F.lit(max(total, 1)))
    extra = wanted.join(heads, "_at").select(
        "_range", "_values", (F.col("_size") + F.col("_step")).alias("_place")
    )
    names = [f"_{i}" for i in range(len(df.columns))]
    row = F.struct(*[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)])
    own = ranged.select("_range", row.alias("_row"), values, F.row_number().over(inside).alias("_place"))
    both = own.unionByName(extra, allowMissingColumns=True)
    following = Window.partitionBy("_range").orderBy("_place").rowsBetween(1, k)
    both = both.withColumn(out, F.collect_list("_values").over(following)).where("_row IS NOT NULL")
    return both.select(*[F.col(f"_row.{n}").alias(c) for c, n in zip(df.columns, names)], out)


def with_next_row(df: DataFrame, order, columns, out="donor") -> DataFrame:
    """Add a struct of ``columns`` of the next row in ``order``; the last takes the first's."""
    return with_next_rows(df, order, columns, 1, out).withColumn(out, F.col(out)[0])
