"""Features, splits and the transformers that turn them into a vector."""

from pyspark.ml.feature import Interaction, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempestry.operators.location import with_location_count
from tempestry.operators.rows import (
    fill_missing,
    require_not_null,
    with_has_harm,
    with_total_harm,
)
from tempestry.schema import (
    EVENT_COUNT_PER_CZ,
    EVENT_ID,
    EVENT_TYPE,
    HAS_HARM,
    MAGNITUDE,
    MAGNITUDE_TYPE,
    NO_MAGNITUDE_TYPE,
    STATE,
)

CATEGORICAL = (EVENT_TYPE, STATE, MAGNITUDE_TYPE)
NUMERIC = (MAGNITUDE, EVENT_COUNT_PER_CZ)
FEATURES = CATEGORICAL + NUMERIC
SPLITS = (("train", 70), ("validation", 15), ("test", 15))


def build_features(
    df: DataFrame, row_id=EVENT_ID, counts: DataFrame | None = None, place_counts=True
) -> DataFrame:
    """Row id, five features and the label, over rows with a type and a state.

    ``place_counts=False`` leaves out the event count of the place, which is computed
    and written before anything else.
    """
    rows = with_has_harm(with_total_harm(df))
    if place_counts:
        rows = with_location_count(rows, counts=counts)
    filled = fill_missing(rows, {MAGNITUDE: 0.0, MAGNITUDE_TYPE: NO_MAGNITUDE_TYPE})
    names = [c for c in FEATURES if place_counts or c != EVENT_COUNT_PER_CZ]
    return require_not_null(filled).select(row_id, *names, HAS_HARM)


def split_name(row_id=EVENT_ID, seed=42, splits=SPLITS) -> Column:
    """Split a row belongs to, from a seeded hash of its id.

    The same row lands in the same split on every run and under every
    partitioning, which a random split of an uncached table does not promise.
    """
    digest = F.md5(F.concat(F.col(row_id).cast("string"), F.lit(f":{seed}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    name, upper = None, 0
    for split, percent in splits[:-1]:
        upper += percent
        name = (F if name is None else name).when(bucket < upper, split)
    return name.otherwise(splits[-1][0])


def split3(df: DataFrame, row_id=EVENT_ID, seed=42, splits=SPLITS) -> list[DataFrame]:
    """Train, validation and test rows: disjoint, and together all rows."""
    marked = df.withColumn("split", split_name(row_id, seed, splits))
    return [marked.where(F.col("split") == name).drop("split") for name, _ in splits]


def string_indexer(columns=CATEGORICAL) -> StringIndexer:
    """Index all columns in one pass: most frequent first, ties alphabetical."""
    return StringIndexer(
        inputCols=list(columns),
        outputCols=[f"{c}_idx" for c in columns],
        handleInvalid="keep",
    )


def one_hot_encoder(columns=CATEGORICAL) -> OneHotEncoder:
    """One slot per known category; an unseen category sets none of them."""
    return OneHotEncoder(
        inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_vec" for c in columns]
    )


def assembler(columns) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="keep")


def with_interaction_product(
    df: DataFrame, left=MAGNITUDE, right=EVENT_COUNT_PER_CZ, out="MAGNITUDE_X_EVENT_COUNT"
) -> DataFrame:
    """Add the product of two numeric features."""
    return df.withColumn(out, F.col(left) * F.col(right))


def category_interaction(left=EVENT_TYPE, right=STATE, out="EVENT_TYPE_X_STATE") -> Interaction:
    """Transformer giving one slot per pair of encoded categories."""
    return Interaction(inputCols=[f"{left}_vec", f"{right}_vec"], outputCol=out)


def feature_stages(interactions=False, columns=None) -> list:
    """Index, encode and assemble; optionally with both interaction features.

    ``columns`` names the features, by default all. With interactions the input must
    carry ``with_interaction_product``.
    """
    columns = FEATURES if columns is None else columns
    categories = [c for c in CATEGORICAL if c in columns]
    stages = [string_indexer(categories), one_hot_encoder(categories)] if categories else []
    inputs = [f"{c}_vec" for c in categories] + [c for c in NUMERIC if c in columns]
    if interactions:
        stages.append(category_interaction())
        inputs += ["EVENT_TYPE_X_STATE", "MAGNITUDE_X_EVENT_COUNT"]
    return [*stages, assembler(inputs)]
