"""CSV files read by blocks, and folders that name columns."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from checks.queries import check
from checks.storm_view import storm, table
from tempestry.session import scratch_path
from tempestry.sources import read_events_csv, write_csv


@contextmanager
def block_size(spark, size):
    """Scans planned inside cut files into blocks of that size."""
    name = "spark.sql.files.maxPartitionBytes"
    kept = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, kept)


@check("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_blocks(spark, sf_dir):
    """Texts full of quotes and line breaks, each file read by many tasks."""
    path = scratch_path(spark, "blocks")
    documents = table(spark, sf_dir, "documents")
    write_csv(documents, path)
    with block_size(spark, 1 << 16):
        return read_events_csv(spark, path, documents.schema, split=True)


@check(
    "SELECT EVENT_ID, STATE, CZ_NAME, EVENT_TYPE, YEAR, 'line one' || chr(10) || 'and \"two\"' AS \"A\nB\","
    " CASE WHEN YEAR % 2 = 0 THEN 'odd, ' || CAST(EVENT_ID AS VARCHAR) END AS NOTE FROM storm"
)
def csv_blocks_by_header(spark, sf_dir):
    """Yearly folders without a year inside, two headers that differ behind a line break."""
    path = scratch_path(spark, "years")
    events = storm(spark, sf_dir).select("EVENT_ID", "STATE", "CZ_NAME", "EVENT_TYPE", "YEAR")
    events = events.withColumn("A\nB", F.lit('line one\nand "two"')).withColumn("folder", F.col("YEAR"))
    noted = events.withColumn("NOTE", F.concat(F.lit("odd, "), F.col("EVENT_ID").cast("string")))
    plain = events.where("YEAR % 2 = 1").select("EVENT_ID", "A\nB", "STATE", "CZ_NAME", "EVENT_TYPE", "YEAR")
    noted = noted.where("YEAR % 2 = 0").select("EVENT_ID", "A\nB", "CZ_NAME", "STATE", "EVENT_TYPE", "NOTE", "YEAR")
    for frame in (plain, noted):
        writer = frame.write.mode("append").partitionBy("YEAR").option("header", True)
        writer.option("quote", '"').option("escape", '"').csv(path)
    with block_size(spark, 1 << 15):
        return read_events_csv(spark, path, split=True)


@check("SELECT EVENT_ID, STATE, YEAR, 'x y' AS half FROM storm WHERE YEAR < 1998")
def csv_folder_columns(spark, sf_dir):
    """Folders of two levels whose names are columns, read by Spark's own reader."""
    path = scratch_path(spark, "folders")
    events = storm(spark, sf_dir).where("YEAR < 1998").select("EVENT_ID", "STATE", "YEAR")
    events = events.withColumn("half", F.lit("x y"))
    events.write.partitionBy("YEAR", "half").option("header", True).csv(path)
    return read_events_csv(spark, path)
