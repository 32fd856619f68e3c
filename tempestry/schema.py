"""Column names, declared types and fixed values of the event table."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

EVENT_ID = "EVENT_ID"
STATE = "STATE"
CZ_NAME = "CZ_NAME"
YEAR = "YEAR"
EVENT_TYPE = "EVENT_TYPE"
INJURIES_DIRECT = "INJURIES_DIRECT"
INJURIES_INDIRECT = "INJURIES_INDIRECT"
DEATHS_DIRECT = "DEATHS_DIRECT"
DEATHS_INDIRECT = "DEATHS_INDIRECT"
DAMAGE_PROPERTY = "DAMAGE_PROPERTY"
DAMAGE_CROPS = "DAMAGE_CROPS"
MAGNITUDE = "MAGNITUDE"
MAGNITUDE_TYPE = "MAGNITUDE_TYPE"
TOR_F_SCALE = "TOR_F_SCALE"

# Derived columns.
TOTAL_HARM = "TOTAL_HARM"
HAS_HARM = "has_harm"
EVENT_COUNT_PER_CZ = "EVENT_COUNT_PER_CZ"

INJURY_COLUMNS = (INJURIES_DIRECT, INJURIES_INDIRECT)
DEATH_COLUMNS = (DEATHS_DIRECT, DEATHS_INDIRECT)
HARM_COLUMNS = INJURY_COLUMNS + DEATH_COLUMNS
DAMAGE_COLUMNS = (DAMAGE_PROPERTY, DAMAGE_CROPS)
IMPACT_MEASURES = DAMAGE_COLUMNS + HARM_COLUMNS

# Types to declare for the columns the analyses use. Source files carry more
# columns than these; the reader keeps the others as text.
EVENT_SCHEMA = StructType(
    [
        StructField(EVENT_ID, LongType()),
        StructField(STATE, StringType()),
        StructField(CZ_NAME, StringType()),
        StructField(YEAR, IntegerType()),
        StructField(EVENT_TYPE, StringType()),
        StructField(INJURIES_DIRECT, LongType()),
        StructField(INJURIES_INDIRECT, LongType()),
        StructField(DEATHS_DIRECT, LongType()),
        StructField(DEATHS_INDIRECT, LongType()),
        StructField(DAMAGE_PROPERTY, StringType()),
        StructField(DAMAGE_CROPS, StringType()),
        StructField(MAGNITUDE, DoubleType()),
        StructField(MAGNITUDE_TYPE, StringType()),
        StructField(TOR_F_SCALE, StringType()),
    ]
)

# Labels, thresholds and category sets the results depend on.
UNKNOWN_UPPER = "UNKNOWN"
UNKNOWN_TITLE = "Unknown"
NO_MAGNITUDE_TYPE = "NONE"
DEFAULT_SCALE = "EF0"
SEVERE_SCALES = ("EF3", "EF4", "EF5")
TORNADO = "Tornado"
FLOOD = "Flood"
FLASH_FLOOD = "Flash Flood"
AMOUNT_SUFFIXES = {"K": 1e3, "M": 1e6, "B": 1e9}
SEVERE_DAMAGE = 50000
SEVERE_INJURIES = 5
MAGNITUDE_EDGES = (10, 20, 50, 100)
