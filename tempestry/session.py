"""Session settings and the shared scratch area."""

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every run wants. Memory, cores and shuffle partitions belong to the
# cluster and are left to spark-submit; adaptive execution coalesces the many
# tiny shuffle partitions of the aggregates and splits skewed join partitions.
# Recording the Python call site of every expression slows building plans.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Remove the shuffle files of a query when it ends instead of at some later
# garbage collection.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name="tempestry", master=None, **extra):
    """Get or create the session; ``extra`` maps setting names to values."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give executors the package, once per session, for the few steps that run Python there.

    A job submitted with the package in ``--py-files`` does not need this.
    """
    context = spark.sparkContext
    if getattr(context, "_tempestry_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-"), f"tempestry-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    context.addPyFile(str(archive))
    context._tempestry_shipped = True


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors see.

    A machine-local temporary folder is used only where the setting is absent and
    the session itself runs in one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tempestry-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


class Scratch:
    """Tables and files of one computation in a folder of its own in the shared folder.

    ``save`` cuts lineage in a way that survives the loss of executors and gives the
    optimizer the table's real file size to base join decisions on; the shuffle files
    behind a saved table are removed with it. ``drop`` deletes a table that nothing
    reads any more. As a context everything goes at its end; otherwise what a returned
    result still reads goes when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/tempestry-{uuid.uuid4().hex}"
        self._files().deleteOnExit(self._path(self.root))

    def _path(self, path):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return self._path(self.root).getFileSystem(conf)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, partition_by=()) -> DataFrame:
        """Write ``df`` and return the written table."""
        kept = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.partitionBy(*partition_by).parquet(self.path(name))
        finally:
            if kept is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, kept)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            self._files().delete(self._path(self.path(name)), True)

    def close(self) -> None:
        self._files().delete(self._path(self.root), True)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.close()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the session's JVM ends."""
    return Scratch(spark).path(name)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table of its own scratch folder."""
    return Scratch(df.sparkSession).save(df, name)
