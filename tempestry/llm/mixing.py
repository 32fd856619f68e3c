"""Mixing sources to target weights.

Documents get hash-random keys and are range-sorted by source and key. Sums of each
range give every range its offset within the source, so the document at which a
source's budget is used up is found by looking into a single range. Only that cut, one
row per source, goes back to the documents.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempestry.session import Scratch

WORD = r"[^\x20\x09-\x0D]+"


def word_count(column):
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def _key(seed):
    """Random order that is the same in every run: from the id alone."""
    text = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}"))
    return F.substring(F.md5(text.cast("binary")), 1, 16)


def source_targets(totals: DataFrame, weights=(1, 2, 3), epochs=3) -> DataFrame:
    """``(source, source_size)`` with the target of each source.

    Sources in code point order, null last, take the weights in turn and share the
    sum of all sizes. A target stops at ``epochs`` times its source's size and the
    excess goes to the others by weight. With the sources ordered by size per weight
    the stopped ones come first, so the common level of the rest follows from running
    sums. There is one row per source here, not per document.
    """
    everything = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * epochs
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), "turn")
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)

    def before(name):
        return F.coalesce(F.sum(name).over(earlier), F.lit(0))

    level = (F.sum("source_size").over(everything) - before("cap")).cast("double") / (
        F.sum("weight").over(everything) - before("weight")
    )
    return (
        totals.select("*", turn.alias("turn"), weight.alias("weight"), cap.alias("cap"))
        .select("*", level.alias("level"))
        .select("*", (F.col("cap") >= F.col("level") * F.col("weight")).alias("open"))
        .select("*", F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), "turn", "level"))).over(everything)["level"].alias("common"))
        .select(
            "source",
            "source_size",
            F.least(F.col("cap").cast("double"), F.col("common") * F.col("weight")).alias("target"),
        )
    )


def mix_plan(sizes: DataFrame, scratch: Scratch, weights=(1, 2, 3), epochs=3, seed=0) -> DataFrame:
    """One row per source: size, target, whole epochs, and the cut in the last epoch.

    ``sizes`` has doc_id, source, size. The cut is the key, id and size of the first
    document that does not fit whole, with the words it still gives. Rows that agree in
    source, id and size share what is left between them.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    budget = F.floor(F.col("target") + 0.5)
    plan = source_targets(totals, weights, epochs).select(
        "*",
        F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).alias("whole"),
        F.when(F.col("source_size") > 0, budget % F.col("source_size")).otherwise(0).alias("rest"),
    )
    plan = scratch.save(plan, "plan")
    ranged = scratch.save(
        sizes.where("size > 0")
        .groupBy("source", _key(seed).alias("key"), "doc_id", "size")
        .agg(F.count("*").alias("copies"))
        .repartitionByRange("source", "key", "doc_id", "size")
        .withColumn("range", F.spark_partition_id()),
        "ranged",
    )
    words = F.col("copies") * F.col("size")
    ranges = ranged.groupBy("source", "range").agg(F.sum(words).alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy("range"))
    ranges = ranges.select("*", (upto - F.col("words")).alias("skipped"))
    rest = plan.select(F.col("source").alias("plan_source"), "rest")
    cut_range = (
        ranges.join(rest, F.col("source").eqNullSafe(F.col("plan_source")))
        .where("rest >= skipped and rest < skipped + words")
        .select(F.col("plan_source"), F.col("range").alias("cut_range"), "skipped", "rest")
    )
    running = F.sum(words).over(
        Window.partitionBy("source").orderBy("key", F.col("doc_id"), "size")
    )
    cut = (
        ranged.join(
            cut_range,
            F.col("source").eqNullSafe(F.col("plan_source"))
            & (F.col("range") == F.col("cut_range")),
        )
        .select("*", (F.col("skipped") + running - words).alias("before"), words.alias("words"))
        .where("rest >= before and rest < before + words")
        .select(
            F.col("source").alias("cut_source"),
            F.struct("key", "doc_id", "size").alias("cut"),
            F.floor((F.col("rest") - F.col("before")) / F.col("copies")).alias("part"),
        )
    )
    return scratch.save(
        plan.join(cut, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source"),
        "cuts",
    )


def with_taken(sizes: DataFrame, plan: DataFrame, seed=0) -> DataFrame:
    """``sizes`` with its source's columns and ``taken``, the words the mix takes.

    The plan has a row per source, so it is joined by its real size; a source with most
    documents is a skewed key that adaptive execution splits where it is not broadcast.
    """
    here = F.struct(_key(seed).alias("key"), "doc_id", "size")
    last = F.when(here < F.col("cut"), F.col("size")).when(here == F.col("cut"), F.col("part"))
    plan = plan.withColumnRenamed("source", "plan_source")
    return (
        sizes.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
        .withColumn("taken", F.col("whole") * F.col("size") + F.coalesce(last, F.lit(0)))
        .drop("plan_source", "cut", "part", "rest")
    )


def mix_sources(docs: DataFrame, weights=(1, 2, 3), epochs=3, seed=0) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    ``docs`` needs doc_id, text and source; other columns are ignored. A null text has
    size 0 and takes 0. Null sources are one source, the last. A null id is a document
    like any other. Rows that repeat id, source and size are taken alike. Each source's
    budget is its target rounded to whole words; the document at the cut gives just the
    words that are missing, so the sum of a source's ``taken`` is its budget (less at
    most one word per repeat of that document). No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    sizes = scratch.save(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    plan = mix_plan(sizes, scratch, weights, epochs, seed)
    return with_taken(sizes, plan, seed).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def mixed_documents(docs: DataFrame, weights=(1, 2, 3), epochs=3, seed=0) -> DataFrame:
    """The mix itself: a row for each time a document is taken, columns as given.

    Documents stand in the mix once for each epoch that takes them whole; the one at the
    cut adds its first words, up to where its source's budget ends, with n_chars to
    match where there is such a column. Texts are not shuffled by a broadcast plan.
    """
    scratch = Scratch(docs.sparkSession)
    columns = docs.columns
    sized = docs.withColumn("__size", word_count("text"))
    sizes = scratch.save(sized.select("doc_id", "source", F.col("__size").alias("size")), "sizes")
    plan = mix_plan(sizes, scratch, weights, epochs, seed).select(
        F.col("source").alias("__source"),
        F.struct("whole", "cut", "part").alias("__plan"),
    )
    here = F.struct(_key(seed).alias("key"), "doc_id", F.col("__size").alias("size"))
    whole = F.col("__plan.whole") + F.when(here < F.col("__plan.cut"), 1).otherwise(0)
    part = F.when(here == F.col("__plan.cut"), F.col("__plan.part")).otherwise(0)
    times = F.flatten(
        F.array(
            F.array_repeat(F.col("__size"), F.col("__whole").cast("int")),
            F.when(F.col("__part") > 0, F.array(F.col("__part"))).otherwise(F.array().cast("array<bigint>")),
        )
    )
    pieces = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    first_words = F.array_join(F.slice(pieces, 1, F.col("__words").cast("int")), "")
    out = (
        sized.join(plan, F.col("source").eqNullSafe(F.col("__source")))
        .withColumn("__whole", whole)
        .withColumn("__part", part)
        .withColumn("__words", F.explode(times))
        .withColumn(
            "text",
            F.when(F.col("__words") < F.col("__size"), first_words).otherwise(F.col("text")),
        )
    )
    if "n_chars" in columns:
        out = out.withColumn(
            "n_chars",
            F.when(F.col("__words") < F.col("__size"), F.length("text").cast("long")).otherwise(
                F.col("n_chars")
            ),
        )
    return out.select(*columns)
