"""Registry: each query as Spark steps and, where SQL can say it, as SQL."""

from functools import lru_cache

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.storm_view import STORM_SQL, storm, table
from tempestry.functions import (
    bare_suffix,
    magnitude_band,
    measure_parses,
    parse_amount,
    safe_float,
    safe_int,
    severe_by_impact,
    severe_by_scale,
)
from tempestry.operators import (
    damage,
    evaluation,
    features,
    forest,
    frequency,
    harm,
    impact,
    location,
    rows,
    tornado,
    trend,
)
from tempestry.operators.ranking import sort_desc, top_k
from tempestry.plans import rollup
from tempestry.schema import MAGNITUDE_EDGES
from tempestry.session import materialize, scratch_path
from tempestry.sources import (
    cache_clean,
    dataset_overview,
    extract_links,
    null_profile,
    parse_csv_lines,
    read_events_csv,
    read_many,
    sample_events,
    split_valid_rejects,
    strip_header,
    write_csv,
    write_metrics_json,
)

QUERIES = {}
SQL = {}


def check(sql=None, name=None, recursive=False):
    """Register a query ``(spark, sf_dir) -> DataFrame`` with its SQL.

    The SQL may use ``storm`` and the given tables.
    """
    with_ = "WITH RECURSIVE" if recursive else "WITH"

    def register(function):
        key = name or function.__name__
        QUERIES[key] = function
        if sql is not None:
            SQL[key] = f"{with_} {STORM_SQL.strip()}\n{sql.strip()}"
        return function

    return register


def on_storm(name, step, sql):
    """Register a query that is one step over the event table."""
    check(sql, name)(lambda spark, sf_dir: step(storm(spark, sf_dir)))


HARM_SQL = (
    "coalesce(INJURIES_DIRECT, 0) + coalesce(INJURIES_INDIRECT, 0)"
    " + coalesce(DEATHS_DIRECT, 0) + coalesce(DEATHS_INDIRECT, 0)"
)
INJURIES_SQL = "coalesce(INJURIES_DIRECT, 0) + coalesce(INJURIES_INDIRECT, 0)"
DEATHS_SQL = "coalesce(DEATHS_DIRECT, 0) + coalesce(DEATHS_INDIRECT, 0)"


def amount_sql(column):
    return f"""(CASE
      WHEN right({column}, 1) IN ('K', 'M', 'B')
      THEN TRY_CAST(left({column}, length({column}) - 1) AS DOUBLE)
      ELSE TRY_CAST({column} AS DOUBLE) END
      * CASE right({column}, 1) WHEN 'K' THEN 1e3 WHEN 'M' THEN 1e6 WHEN 'B' THEN 1e9
        ELSE 1.0 END)"""


SEVERE_SQL = f"""(coalesce({amount_sql('DAMAGE_PROPERTY')}, 0) > 50000
  OR coalesce({amount_sql('DAMAGE_CROPS')}, 0) > 50000
  OR {DEATHS_SQL} > 0 OR {INJURIES_SQL} > 5)"""
SCALE_SQL = "coalesce(TOR_F_SCALE, 'EF0') IN ('EF3', 'EF4', 'EF5')"
MAG_SQL = "MAGNITUDE IS NOT NULL AND NOT isnan(MAGNITUDE) AND MAGNITUDE <> 0"


# --- harm --------------------------------------------------------------------


def harm_sql(keys, missing="UNKNOWN"):
    labels = ", ".join(f"coalesce(nullif({k}, ''), '{missing}') AS {k}" for k in keys)
    names = ", ".join(keys)
    return f"""
SELECT {names}, CAST(sum(h) AS BIGINT) AS total_harm, count(*) AS event_count,
  CAST(sum(h) AS DOUBLE) / count(*) AS avg_harm
FROM (SELECT {labels}, {HARM_SQL} AS h FROM storm) WHERE h > 0 GROUP BY {names}"""


for _name, _step, _keys in (
    ("event_type", harm.harm_by_event_type, ["EVENT_TYPE"]),
    ("state", harm.harm_by_state, ["STATE"]),
    ("county", harm.harm_by_county, ["STATE", "CZ_NAME"]),
    ("event_state", harm.harm_by_event_state, ["EVENT_TYPE", "STATE"]),
):
    on_storm(
        f"harm_by_{_name}",
        lambda df, s=_step, k=_keys: sort_desc(s(df), "total_harm", k),
        harm_sql(_keys),
    )
    on_storm(
        f"top_harm_by_{_name}",
        lambda df, s=_step, k=_keys: top_k(s(df), "total_harm", k),
        harm_sql(_keys) + f" ORDER BY total_harm DESC, {', '.join(_keys)} LIMIT 10",
    )

on_storm(
    "harm_by_magnitude_type",
    lambda df: sort_desc(harm.harm_by_magnitude_type(df), "total_harm", ["MAGNITUDE_TYPE"]),
    harm_sql(["MAGNITUDE_TYPE"], "NONE"),
)
on_storm(
    "harm_overview",
    harm.harm_overview,
    f"""
SELECT count(*) AS events_with_harm, CAST(coalesce(sum(h), 0) AS BIGINT) AS total_harm,
  CAST(sum(h) AS DOUBLE) / count(*) AS avg_harm
FROM (SELECT {HARM_SQL} AS h FROM storm) WHERE h > 0""",
)
on_storm(
    "harm_overview_display",
    lambda df: harm.harm_overview(df).select(
        "events_with_harm", F.round("avg_harm", 2).alias("avg_harm_2dp")
    ),
    f"""
SELECT count(*) AS events_with_harm,
  round(CAST(sum(h) AS DOUBLE) / count(*), 2) AS avg_harm_2dp
FROM (SELECT {HARM_SQL} AS h FROM storm) WHERE h > 0""",
)
_LOCATION_COUNT_SQL = """
SELECT coalesce(nullif(STATE, ''), 'UNKNOWN') AS STATE,
  coalesce(nullif(CZ_NAME, ''), 'UNKNOWN') AS CZ_NAME, count(*) AS event_count
FROM storm GROUP BY 1, 2"""
on_storm(
    "event_count_by_location",
    lambda df: sort_desc(
        frequency.event_count_by_location(df), "event_count", ["STATE", "CZ_NAME"]
    ),
    _LOCATION_COUNT_SQL,
)
on_storm(
    "top_event_count_by_location",
    lambda df: top_k(
        frequency.event_count_by_location(df), "event_count", ["STATE", "CZ_NAME"]
    ),
    _LOCATION_COUNT_SQL + " ORDER BY event_count DESC, STATE, CZ_NAME LIMIT 10",
)


# --- impact ------------------------------------------------------------------


def impact_sql(keys):
    names = ", ".join(keys)
    return f"""
SELECT {names}, CAST(sum({HARM_SQL}) AS BIGINT) AS total_impact
FROM storm GROUP BY {names}"""


for _name, _step, _keys in (
    ("county", impact.impact_by_county, ["STATE", "CZ_NAME"]),
    ("state", impact.impact_by_state, ["STATE"]),
    ("event_type", impact.impact_by_event_type, ["EVENT_TYPE"]),
):
    on_storm(
        f"impact_by_{_name}",
        lambda df, s=_step, k=_keys: sort_desc(s(df), "total_impact", k),
        impact_sql(_keys),
    )
    on_storm(
        f"top_impact_by_{_name}",
        lambda df, s=_step, k=_keys: top_k(s(df), "total_impact", k),
        impact_sql(_keys)
        + " ORDER BY total_impact DESC, "
        + ", ".join(f"{k} NULLS FIRST" for k in _keys)
        + " LIMIT 10",
    )

_IMPACT_TYPE_SQL = f"""
SELECT EVENT_TYPE, coalesce(MAGNITUDE_TYPE, 'Unknown') AS MAGNITUDE_TYPE,
  CAST(sum({INJURIES_SQL}) AS BIGINT) AS injuries, CAST(sum({DEATHS_SQL}) AS BIGINT) AS deaths
FROM storm GROUP BY 1, 2"""
_TYPE_KEYS = ["EVENT_TYPE", "MAGNITUDE_TYPE"]
on_storm(
    "impact_by_type",
    lambda df: sort_desc(
        impact.impact_by_type(df), F.col("injuries") + F.col("deaths"), _TYPE_KEYS
    ),
    _IMPACT_TYPE_SQL,
)
on_storm(
    "top_impact_by_type",
    lambda df: top_k(impact.impact_by_type(df), F.col("injuries") + F.col("deaths"), _TYPE_KEYS),
    f"SELECT * FROM ({_IMPACT_TYPE_SQL}) ORDER BY injuries + deaths DESC,"
    " EVENT_TYPE NULLS FIRST, MAGNITUDE_TYPE LIMIT 10",
)


# --- magnitude trend -----------------------------------------------------------


def rounded(df: DataFrame, **digits) -> DataFrame:
    """Round floating columns: the two engines add in different orders."""
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


on_storm(
    "avg_magnitude_by_year",
    lambda df: rounded(trend.avg_magnitude_by_year(df), avg_magnitude=6).orderBy("YEAR"),
    f"SELECT YEAR, round(avg(MAGNITUDE), 6) AS avg_magnitude FROM storm"
    f" WHERE {MAG_SQL} GROUP BY YEAR",
)
on_storm(
    "avg_magnitude_complete_years",
    lambda df: rounded(
        rows.exclude_years(trend.avg_magnitude_by_year(df), 2001), avg_magnitude=6
    ).orderBy("YEAR"),
    f"SELECT YEAR, round(avg(MAGNITUDE), 6) AS avg_magnitude FROM storm"
    f" WHERE {MAG_SQL} AND YEAR <> 2001 GROUP BY YEAR",
)
for _t in (50, 20):
    on_storm(
        f"count_over_{_t}_by_year",
        lambda df, t=_t: trend.count_over_by_year(df, t).orderBy("YEAR"),
        f"SELECT YEAR, count(*) AS event_count FROM storm WHERE {MAG_SQL} AND MAGNITUDE > {_t}"
        " GROUP BY YEAR",
    )
on_storm(
    "magnitude_trend",
    lambda df: rounded(trend.magnitude_trend(df), avg_magnitude=6).orderBy("YEAR"),
    f"""
SELECT YEAR, round(avg(MAGNITUDE), 6) AS avg_magnitude,
  count(*) FILTER (WHERE MAGNITUDE > 50) AS over_50,
  count(*) FILTER (WHERE MAGNITUDE > 20) AS over_20
FROM storm WHERE {MAG_SQL} GROUP BY YEAR""",
)
on_storm(
    "max_magnitude_by_year",
    lambda df: trend.max_magnitude_by_year(df).orderBy("YEAR"),
    f"SELECT YEAR, max(MAGNITUDE) AS max_magnitude FROM storm WHERE {MAG_SQL} GROUP BY YEAR",
)
BAND_SQL = """CASE WHEN MAGNITUDE < 10 THEN '0–10' WHEN MAGNITUDE < 20 THEN '10–20'
  WHEN MAGNITUDE < 50 THEN '20–50' WHEN MAGNITUDE < 100 THEN '50–100' ELSE '>100' END"""
on_storm(
    "band_counts",
    lambda df: trend.band_counts(df).orderBy("YEAR", "band"),
    f"SELECT YEAR, {BAND_SQL} AS band, count(*) AS event_count FROM storm WHERE {MAG_SQL}"
    " GROUP BY 1, 2",
)
on_storm(
    "magnitude_bands",
    lambda df: rows.with_valid_magnitude(df).select(
        "EVENT_ID",
        magnitude_band().alias("band"),
        magnitude_band(edges=(20, 30, 40, 50)).alias("narrow_band"),
    ),
    f"""
SELECT EVENT_ID, {BAND_SQL} AS band,
  CASE WHEN MAGNITUDE < 20 THEN '0–20' WHEN MAGNITUDE < 30 THEN '20–30'
  WHEN MAGNITUDE < 40 THEN '30–40' WHEN MAGNITUDE < 50 THEN '40–50' ELSE '>50' END
  AS narrow_band
FROM storm WHERE {MAG_SQL}""",
)
on_storm(
    "spearman_trend",
    lambda df: rounded(trend.spearman_trend(df), rho=6),
    f"""
, yearly AS (SELECT YEAR, avg(MAGNITUDE) AS m FROM storm WHERE {MAG_SQL} GROUP BY YEAR),
ranked AS (SELECT
  rank() OVER (ORDER BY YEAR) + (count(*) OVER (PARTITION BY YEAR) - 1) / 2.0 AS ry,
  rank() OVER (ORDER BY m) + (count(*) OVER (PARTITION BY m) - 1) / 2.0 AS rm FROM yearly)
SELECT round(corr(ry, rm), 6) AS rho FROM ranked""",
)
on_storm(
    "valid_magnitudes",
    lambda df: rows.with_valid_magnitude(df.select("EVENT_ID", "MAGNITUDE")),
    f"SELECT EVENT_ID, MAGNITUDE FROM storm WHERE {MAG_SQL}",
)
on_storm(
    "magnitude_over_50",
    lambda df: rows.magnitude_over(df.select("EVENT_ID", "YEAR", "MAGNITUDE"), 50),
    "SELECT EVENT_ID, YEAR, MAGNITUDE FROM storm WHERE MAGNITUDE > 50",
)


# --- tornadoes, frequency --------------------------------------------------------

_STATE = "coalesce(nullif(STATE, ''), 'Unknown') AS STATE"
on_storm(
    "tornado_count_by_state",
    lambda df: sort_desc(tornado.tornado_count_by_state(df), "tornado_count", ["STATE"]),
    f"SELECT {_STATE}, count(*) AS tornado_count FROM storm WHERE EVENT_TYPE = 'Tornado'"
    " GROUP BY 1",
)
for _name, _step, _rule in (
    ("severe_count_by_state", tornado.severe_count_by_state, SEVERE_SQL),
    ("severe_scale_by_state", tornado.severe_scale_by_state, SCALE_SQL),
):
    on_storm(
        _name,
        lambda df, s=_step: sort_desc(s(df), "severe_tornado_count", ["STATE"]),
        f"SELECT {_STATE}, count(*) AS severe_tornado_count FROM storm"
        f" WHERE EVENT_TYPE = 'Tornado' AND {_rule} GROUP BY 1",
    )


def tornado_sql(rule, limit):
    return f"""
SELECT t.STATE, tornado_count, coalesce(severe_tornado_count, 0) AS severe_tornado_count
FROM (SELECT {_STATE}, count(*) AS tornado_count FROM storm
      WHERE EVENT_TYPE = 'Tornado' GROUP BY 1) t
LEFT JOIN (SELECT {_STATE}, count(*) AS severe_tornado_count FROM storm
      WHERE EVENT_TYPE = 'Tornado' AND {rule} GROUP BY 1) s ON t.STATE = s.STATE
ORDER BY tornado_count DESC, t.STATE LIMIT {limit}"""


on_storm(
    "tornado_summary",
    lambda df: top_k(tornado.tornado_summary(df), "tornado_count", ["STATE"]),
    tornado_sql(SCALE_SQL, 10),
)
on_storm(
    "tornado_summary_joined",
    lambda df: top_k(
        tornado.tornado_summary_joined(
            tornado.tornado_count_by_state(df), tornado.severe_scale_by_state(df)
        ),
        "tornado_count",
        ["STATE"],
    ),
    tornado_sql(SCALE_SQL, 10),
)
on_storm(
    "tornado_top12",
    lambda df: top_k(
        tornado.tornado_summary(df, severe=severe_by_impact(df)), "tornado_count", ["STATE"], 12
    ),
    tornado_sql(SEVERE_SQL, 12),
)
_FREQUENCY_SQL = """
SELECT STATE, EVENT_TYPE, count(*) AS event_count FROM storm
WHERE STATE <> '' AND EVENT_TYPE <> '' GROUP BY 1, 2"""
_PAIR = ["STATE", "EVENT_TYPE"]
on_storm(
    "state_event_frequency",
    lambda df: sort_desc(frequency.state_event_frequency(df), "event_count", _PAIR),
    _FREQUENCY_SQL,
)
on_storm(
    "state_event_top20",
    lambda df: top_k(frequency.state_event_frequency(df), "event_count", _PAIR, 20),
    _FREQUENCY_SQL + " ORDER BY event_count DESC, STATE, EVENT_TYPE LIMIT 20",
)


# --- flood damage ----------------------------------------------------------------

_MEASURES = {
    "damage_property": amount_sql("DAMAGE_PROPERTY"),
    "damage_crops": amount_sql("DAMAGE_CROPS"),
    "injuries_direct": "INJURIES_DIRECT",
    "injuries_indirect": "INJURIES_INDIRECT",
    "deaths_direct": "DEATHS_DIRECT",
    "deaths_indirect": "DEATHS_INDIRECT",
}
_COMPLETE_SQL = " AND ".join(
    f"nullif(CAST({m.upper()} AS VARCHAR), '') IS NOT NULL" for m in _MEASURES
)
_FLOODS_SQL = f"""
floods AS (SELECT * FROM storm
  WHERE EVENT_TYPE IN ('Flood', 'Flash Flood') AND {_COMPLETE_SQL})"""
on_storm(
    "flood_means",
    lambda df: rounded(damage.mean_by_type(df), **{f"avg_{m}": 6 for m in _MEASURES}),
    f", {_FLOODS_SQL} SELECT EVENT_TYPE, "
    + ", ".join(f"round(avg({sql}), 6) AS avg_{m}" for m, sql in _MEASURES.items())
    + " FROM floods GROUP BY EVENT_TYPE",
)
on_storm(
    "flood_relative",
    lambda df: damage.relative_to_baseline(damage.mean_by_type(df)),
    f", {_FLOODS_SQL}, long AS ("
    + " UNION ALL ".join(
        f"SELECT 'avg_{m}' AS measure, EVENT_TYPE, avg({sql}) AS v FROM floods"
        " GROUP BY EVENT_TYPE"
        for m, sql in _MEASURES.items()
    )
    + """)
SELECT a.measure, a.EVENT_TYPE,
  CASE WHEN b.v <> 0 THEN round(a.v / b.v, 2) END AS ratio
FROM long a JOIN long b ON a.measure = b.measure AND b.EVENT_TYPE = 'Flash Flood'""",
)


# --- scalars ---------------------------------------------------------------------

# Awkward texts mixed into the counts of the event table, by row id.
AWKWARD = (
    "12.7", " 5 ", "nan", "inf", "", "abc", "-3.9", "1e3", "50.00K", "2.5M", "1B", "K",
    "5k", "0", "5d", "7f", "  ",
)


def awkward_text(spark, sf_dir) -> DataFrame:
    df = storm(spark, sf_dir)
    text = F.element_at(
        F.array(*[F.lit(t) for t in AWKWARD]), (F.col("EVENT_ID") % 40 + 1).cast("int")
    )
    return df.withColumn(
        "RAW",
        F.when(F.col("EVENT_ID") % 40 < len(AWKWARD), text).otherwise(
            F.col("INJURIES_DIRECT").cast("string")
        ),
    )


AWKWARD_SQL = (
    ", raw_text AS (SELECT *, CASE EVENT_ID % 40 "
    + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(AWKWARD))
    + " ELSE CAST(INJURIES_DIRECT AS VARCHAR) END AS RAW FROM storm)"
)
_DOUBLE = "TRY_CAST(RAW AS DOUBLE)"
_VIA_FLOAT = (
    f"CASE WHEN isfinite({_DOUBLE}) THEN TRY_CAST(trunc({_DOUBLE}) AS INT) END"
)
_STRICT = r"CASE WHEN regexp_matches(RAW, '^\s*[+-]?\d+\s*$') THEN CAST(RAW AS INT) END"


@check(
    f"""{AWKWARD_SQL}
SELECT EVENT_ID, RAW, {_STRICT} AS int_strict, coalesce({_STRICT}, 0) AS int_strict_0,
  coalesce({_VIA_FLOAT}, 0) AS int_via_float_0,
  coalesce(isnan({_DOUBLE}), false) AS float_is_nan,
  coalesce(isinf({_DOUBLE}), false) AS float_is_inf,
  CASE WHEN isfinite({_DOUBLE}) THEN {_DOUBLE} END AS float_value,
  {_DOUBLE} IS NULL AS float_missing,
  RAW IS NULL OR trim(RAW) = '' OR ({_VIA_FLOAT}) IS NOT NULL AS readable
FROM raw_text"""
)
def safe_casts(spark, sf_dir):
    number = safe_float("RAW")
    infinite = F.abs(number) == float("inf")
    return awkward_text(spark, sf_dir).select(
        "EVENT_ID",
        "RAW",
        safe_int("RAW").alias("int_strict"),
        safe_int("RAW", 0).alias("int_strict_0"),
        safe_int("RAW", 0, via_float=True).alias("int_via_float_0"),
        F.isnan(number).alias("float_is_nan"),
        F.coalesce(infinite, F.lit(False)).alias("float_is_inf"),
        F.when(~F.isnan(number) & ~infinite, number).alias("float_value"),
        number.isNull().alias("float_missing"),
        measure_parses("RAW").alias("readable"),
    )


@check(
    f"""{AWKWARD_SQL}
SELECT EVENT_ID, {amount_sql('DAMAGE_PROPERTY')} AS property,
  {amount_sql('DAMAGE_CROPS')} AS crops,
  CASE WHEN isfinite({amount_sql('RAW')}) THEN {amount_sql('RAW')} END AS raw_amount,
  coalesce(RAW IN ('K', 'M', 'B'), false) AS raw_is_suffix
FROM raw_text""",
    name="parse_amount",
)
def parse_amounts(spark, sf_dir):
    raw = parse_amount("RAW")
    return awkward_text(spark, sf_dir).select(
        "EVENT_ID",
        parse_amount("DAMAGE_PROPERTY").alias("property"),
        parse_amount("DAMAGE_CROPS").alias("crops"),
        F.when(~F.isnan(raw) & (F.abs(raw) != float("inf")), raw).alias("raw_amount"),
        F.coalesce(bare_suffix("RAW"), F.lit(False)).alias("raw_is_suffix"),
    )


on_storm(
    "fill_missing",
    lambda df: rows.fill_missing(
        df.select("EVENT_ID", "STATE", "EVENT_TYPE", "TOR_F_SCALE", "MAGNITUDE"),
        {"STATE": "UNKNOWN", "EVENT_TYPE": "Unknown", "TOR_F_SCALE": "EF0", "MAGNITUDE": 0.0},
    ),
    """
SELECT EVENT_ID, coalesce(STATE, 'UNKNOWN') AS STATE,
  coalesce(EVENT_TYPE, 'Unknown') AS EVENT_TYPE, coalesce(TOR_F_SCALE, 'EF0') AS TOR_F_SCALE,
  coalesce(MAGNITUDE, 0.0) AS MAGNITUDE FROM storm""",
)
on_storm(
    "severe_flag",
    lambda df: df.select(
        "EVENT_ID",
        severe_by_impact(df).alias("severe"),
        severe_by_impact(df, parse_suffix=False).alias("severe_plain"),
        severe_by_scale().alias("severe_scale"),
    ),
    f"""
SELECT EVENT_ID, {SEVERE_SQL} AS severe,
  (coalesce(TRY_CAST(DAMAGE_PROPERTY AS DOUBLE), 0) > 50000
   OR coalesce(TRY_CAST(DAMAGE_CROPS AS DOUBLE), 0) > 50000
   OR {DEATHS_SQL} > 0 OR {INJURIES_SQL} > 5) AS severe_plain,
  {SCALE_SQL} AS severe_scale FROM storm""",
)
on_storm(
    "total_harm",
    lambda df: rows.with_total_harm(df).select("EVENT_ID", "TOTAL_HARM"),
    f"SELECT EVENT_ID, CAST({HARM_SQL} AS BIGINT) AS TOTAL_HARM FROM storm",
)
on_storm(
    "has_harm",
    lambda df: rows.with_has_harm(rows.with_total_harm(df)).select("EVENT_ID", "has_harm"),
    f"SELECT EVENT_ID, CASE WHEN {HARM_SQL} > 0 THEN 1 ELSE 0 END AS has_harm FROM storm",
)
on_storm(
    "injuries_deaths",
    lambda df: rows.with_injuries_deaths(df).select("EVENT_ID", "injuries", "deaths"),
    f"SELECT EVENT_ID, CAST({INJURIES_SQL} AS BIGINT) AS injuries,"
    f" CAST({DEATHS_SQL} AS BIGINT) AS deaths FROM storm",
)
on_storm(
    "filter_harmful",
    lambda df: rows.filter_harmful(rows.with_total_harm(df)).select("EVENT_ID", "TOTAL_HARM"),
    f"SELECT * FROM (SELECT EVENT_ID, CAST({HARM_SQL} AS BIGINT) AS TOTAL_HARM FROM storm)"
    " WHERE TOTAL_HARM > 0",
)
on_storm(
    "filter_event_type",
    lambda df: rows.filter_event_type(df, "Flood", "Flash Flood").select(
        "EVENT_ID", "EVENT_TYPE"
    ),
    "SELECT EVENT_ID, EVENT_TYPE FROM storm WHERE EVENT_TYPE IN ('Flood', 'Flash Flood')",
)
on_storm(
    "event_projection",
    lambda df: rows.project(df, "EVENT_ID", "STATE", "EVENT_TYPE", "YEAR"),
    "SELECT EVENT_ID, STATE, EVENT_TYPE, YEAR FROM storm",
)
on_storm(
    "require_complete",
    lambda df: rows.require_complete(df, damage.IMPACT_MEASURES).select(
        "EVENT_ID", *damage.IMPACT_MEASURES
    ),
    "SELECT EVENT_ID, DAMAGE_PROPERTY, DAMAGE_CROPS, INJURIES_DIRECT, INJURIES_INDIRECT,"
    f" DEATHS_DIRECT, DEATHS_INDIRECT FROM storm WHERE {_COMPLETE_SQL}",
)
on_storm(
    "require_not_null",
    lambda df: rows.require_not_null(df).select("EVENT_ID", "STATE", "EVENT_TYPE"),
    "SELECT EVENT_ID, STATE, EVENT_TYPE FROM storm"
    " WHERE STATE IS NOT NULL AND EVENT_TYPE IS NOT NULL",
)
on_storm(
    "drop_suffix_only",
    lambda df: rows.drop_suffix_only(df, "DAMAGE_PROPERTY").select("EVENT_ID", "DAMAGE_PROPERTY"),
    "SELECT EVENT_ID, DAMAGE_PROPERTY FROM storm"
    " WHERE coalesce(DAMAGE_PROPERTY, '') NOT IN ('K', 'M', 'B')",
)
on_storm(
    "exclude_year",
    lambda df: rows.exclude_years(
        df.withColumn("YEAR", F.when(F.col("EVENT_ID") % 7 != 0, F.col("YEAR"))), 2001
    ).select("EVENT_ID", "YEAR"),
    "SELECT * FROM (SELECT EVENT_ID, CASE WHEN EVENT_ID % 7 <> 0 THEN YEAR END AS YEAR FROM storm) WHERE YEAR IS DISTINCT FROM 2001",
)


# --- sources and sinks -----------------------------------------------------------


@check("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "documents_csv")
    documents = table(spark, sf_dir, "documents")
    write_csv(documents, path)
    return read_events_csv(spark, path, documents.schema)


@check("SELECT EVENT_ID, STATE, EVENT_TYPE, YEAR, MAGNITUDE FROM storm")
def csv_simple(spark, sf_dir):
    """One-line records without quotes, types guessed by the reader."""
    path = scratch_path(spark, "simple_csv")
    columns = ("EVENT_ID", "STATE", "EVENT_TYPE", "YEAR", "MAGNITUDE")
    write_csv(storm(spark, sf_dir).select(*columns), path)
    return read_events_csv(spark, path, multi_line=False, infer_types=True)


@check("SELECT EVENT_ID, STATE, EVENT_TYPE FROM storm ORDER BY EVENT_ID LIMIT 50")
def csv_sample_file(spark, sf_dir):
    """A small set in one CSV file, for development."""
    path = scratch_path(spark, "sample_csv")
    picked = storm(spark, sf_dir).select("EVENT_ID", "STATE", "EVENT_TYPE")
    write_csv(picked, path, single=True, limit=50, order_by=["EVENT_ID"])
    return read_events_csv(spark, path)


_LINE_FIELDS = (
    "EVENT_ID", "PLACE", "EVENT_TYPE", "INJURIES_DIRECT", "INJURIES_INDIRECT",
    "DEATHS_DIRECT", "DEATHS_INDIRECT", "MAGNITUDE_TYPE",
)
_LINE_HEADER = ",".join(_LINE_FIELDS)


def event_lines(spark, sf_dir) -> DataFrame:
    """The events as CSV lines with quoted commas and doubled quotes, under a header.

    Some lines are cut short, some carry a further field, some a bad count.
    """
    key = F.col("EVENT_ID")

    def text(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    place = F.concat(F.lit('"'), text("STATE"), F.lit(', ""'), text("CZ_NAME"), F.lit('"""'))
    injuries = F.when(key % 29 == 0, F.lit("zz")).otherwise(text("INJURIES_DIRECT"))
    head = F.concat_ws(",", text("EVENT_ID"), place, text("EVENT_TYPE"))
    tail = F.concat_ws(
        ",",
        injuries,
        *[text(c) for c in ("INJURIES_INDIRECT", "DEATHS_DIRECT", "DEATHS_INDIRECT")],
        text("MAGNITUDE_TYPE"),
    )
    line = (
        F.when(key % 23 == 0, head)
        .when(key % 37 == 0, F.concat_ws(",", head, tail, F.lit("further")))
        .otherwise(F.concat_ws(",", head, tail))
    )
    header = spark.range(1).select(F.lit(_LINE_HEADER).alias("value"))
    return storm(spark, sf_dir).select(line.alias("value")).unionByName(header)


_LINES_SQL = """
, cut AS (SELECT *, EVENT_ID % 23 = 0 AS short,
  concat(coalesce(STATE, ''), ', "', coalesce(CZ_NAME, ''), '"') AS PLACE FROM storm),
parsed AS (SELECT CAST(EVENT_ID AS VARCHAR) AS EVENT_ID, PLACE, EVENT_TYPE,
  CASE WHEN short THEN NULL WHEN EVENT_ID % 29 = 0 THEN 'zz'
    ELSE CAST(INJURIES_DIRECT AS VARCHAR) END AS INJURIES_DIRECT,
  CASE WHEN NOT short THEN CAST(INJURIES_INDIRECT AS VARCHAR) END AS INJURIES_INDIRECT,
  CASE WHEN NOT short THEN CAST(DEATHS_DIRECT AS VARCHAR) END AS DEATHS_DIRECT,
  CASE WHEN NOT short THEN CAST(DEATHS_INDIRECT AS VARCHAR) END AS DEATHS_INDIRECT,
  CASE WHEN NOT short THEN MAGNITUDE_TYPE END AS MAGNITUDE_TYPE,
  CASE WHEN short THEN 3 WHEN EVENT_ID % 37 = 0 THEN 9 ELSE 8 END AS field_count
  FROM cut)"""


def parsed_lines(spark, sf_dir):
    lines = strip_header(event_lines(spark, sf_dir), _LINE_HEADER)
    return parse_csv_lines(lines, _LINE_FIELDS).drop("value")


@check(f"{_LINES_SQL} SELECT * FROM parsed")
def csv_lines(spark, sf_dir):
    return parsed_lines(spark, sf_dir)


@check(
    f"{_LINES_SQL} SELECT * FROM parsed"
    " WHERE field_count >= 8 AND coalesce(INJURIES_DIRECT, '') <> 'zz'"
)
def valid_records(spark, sf_dir):
    return split_valid_rejects(parsed_lines(spark, sf_dir), min_fields=8)[0]


@check(
    f"{_LINES_SQL} SELECT * FROM parsed"
    " WHERE field_count < 8 OR coalesce(INJURIES_DIRECT, '') = 'zz'"
)
def rejects(spark, sf_dir):
    return split_valid_rejects(parsed_lines(spark, sf_dir), min_fields=8)[1]


_STORM_COLUMNS = (
    "EVENT_ID, STATE, CZ_NAME, YEAR, EVENT_TYPE, INJURIES_DIRECT, INJURIES_INDIRECT,"
    " DEATHS_DIRECT, DEATHS_INDIRECT, DAMAGE_PROPERTY, DAMAGE_CROPS, MAGNITUDE,"
    " MAGNITUDE_TYPE, TOR_F_SCALE"
)


@check(
    " UNION ALL ".join(
        f"SELECT '{n}' AS layout, {_STORM_COLUMNS} FROM storm" for n in ("base", "+1", "+2")
    )
)
def layout_normalized(spark, sf_dir):
    """The events written with no, one and two leading index columns, read back."""
    events = storm(spark, sf_dir)
    index = F.col("EVENT_ID")
    layouts = {
        "base": events,
        "+1": events.select(index.alias(""), "*"),
        "+2": events.select(index.alias(""), index.alias("Unnamed: 0"), "*"),
    }
    frames = []
    for name, frame in layouts.items():
        path = scratch_path(spark, "layout_csv")
        write_csv(frame, path)
        frames.append(read_events_csv(spark, path).withColumn("layout", F.lit(name)))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@check(
    f"SELECT {_STORM_COLUMNS},"
    " CASE WHEN YEAR >= 2000 THEN 'note ' || EVENT_TYPE END AS NOTE FROM storm"
)
def stacked_years(spark, sf_dir):
    """Yearly gzip files, the later ones with one more column, stacked."""
    path = scratch_path(spark, "yearly")
    events = storm(spark, sf_dir).withColumn("part", F.col("YEAR"))
    noted = events.withColumn("NOTE", F.concat(F.lit("note "), F.col("EVENT_TYPE")))
    for name, frame in (
        ("old", events.where("YEAR < 2000")),
        ("new", noted.where("YEAR >= 2000")),
    ):
        (
            frame.write.partitionBy("part")
            .option("header", True)
            .option("compression", "gzip")
            .csv(f"{path}/{name}")
        )
    return read_many(spark, [f"{path}/old/part=*", f"{path}/new/part=*"])


@check(
    """
, raw_links AS (SELECT page_id, unnest(regexp_extract_all(
    regexp_replace(html, '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', '', 'g'),
    '<a href="([^"]*)"', 1)) AS link FROM pages)
SELECT page_id, concat('https://example.org', replace(replace(replace(replace(replace(link,
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')) AS link
FROM raw_links WHERE contains(link, 'th')"""
)
def page_links(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return extract_links(pages, contains="th", base="https://example.org", keep=["page_id"])


on_storm(
    "dataset_overview",
    lambda df: dataset_overview(df.repartition(5, "EVENT_ID")).withColumn(
        "column_names", F.array_join("column_names", ",")
    ),
    f"SELECT count(*) AS row_count, 14 AS column_count, 5 AS partition_count,"
    f" '{_STORM_COLUMNS.replace(', ', ',')}' AS column_names FROM storm",
)
on_storm(
    "null_profile",
    null_profile,
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c.strip()}' AS column_name, count(*) - count({c}) AS null_count FROM storm"
        for c in _STORM_COLUMNS.split(",")
    )
    + ") WHERE null_count > 0",
)
on_storm(
    "sample_events",
    lambda df: sample_events(df, 100),
    f"SELECT {_STORM_COLUMNS} FROM storm ORDER BY EVENT_ID LIMIT 100",
)


@check(
    f"""
SELECT 'state' AS kind, STATE AS name, CAST(sum({HARM_SQL}) AS BIGINT) AS total_harm
FROM storm GROUP BY STATE
UNION ALL
SELECT 'event_type', EVENT_TYPE, CAST(sum({HARM_SQL}) AS BIGINT) FROM storm
GROUP BY EVENT_TYPE"""
)
def cached_reuse(spark, sf_dir):
    """Two reports from one cleaned table that is written once."""
    clean = cache_clean(
        rows.with_total_harm(storm(spark, sf_dir)).select("STATE", "EVENT_TYPE", "TOTAL_HARM"),
        scratch_path(spark, "clean"),
    )

    def by(kind, key):
        return clean.groupBy(F.col(key).alias("name")).agg(
            F.sum("TOTAL_HARM").alias("total_harm")
        ).withColumn("kind", F.lit(kind))

    return by("state", "STATE").unionByName(by("event_type", "EVENT_TYPE"))


# --- features and evaluation --------------------------------------------------------

FEATURE_SQL = f"""
, counted AS (SELECT *, CASE WHEN STATE IS NULL OR CZ_NAME IS NULL THEN 1
    ELSE count(*) OVER (PARTITION BY STATE, CZ_NAME) END AS n FROM storm),
features AS (SELECT EVENT_ID, EVENT_TYPE, STATE,
  coalesce(MAGNITUDE_TYPE, 'NONE') AS MAGNITUDE_TYPE, coalesce(MAGNITUDE, 0.0) AS MAGNITUDE,
  n AS EVENT_COUNT_PER_CZ, CASE WHEN {HARM_SQL} > 0 THEN 1 ELSE 0 END AS has_harm
  FROM counted WHERE EVENT_TYPE IS NOT NULL AND STATE IS NOT NULL),
bucketed AS (SELECT *,
  ('0x' || substr(md5(CAST(EVENT_ID AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 AS bucket
  FROM features),
assigned AS (SELECT *, CASE WHEN bucket < 70 THEN 'train' WHEN bucket < 85 THEN 'validation'
  ELSE 'test' END AS split, CASE WHEN MAGNITUDE > 50 THEN 1e0 ELSE 0e0 END AS prediction
  FROM bucketed)"""

on_storm(
    "location_count",
    lambda df: location.with_location_count(df).select("EVENT_ID", "EVENT_COUNT_PER_CZ"),
    f"{FEATURE_SQL} SELECT EVENT_ID, n AS EVENT_COUNT_PER_CZ FROM counted",
)
on_storm(
    "feature_table",
    features.build_features,
    f"{FEATURE_SQL} SELECT * FROM features",
)
on_storm(
    "split_assignment",
    lambda df: df.select("EVENT_ID", features.split_name().alias("split")),
    """
SELECT EVENT_ID, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'validation' ELSE 'test' END
  AS split
FROM (SELECT EVENT_ID,
  ('0x' || substr(md5(CAST(EVENT_ID AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 AS b FROM storm)""",
)
on_storm(
    "interaction_product",
    lambda df: features.with_interaction_product(features.build_features(df)).select(
        "EVENT_ID", F.round("MAGNITUDE_X_EVENT_COUNT", 4).alias("MAGNITUDE_X_EVENT_COUNT")
    ),
    f"{FEATURE_SQL} SELECT EVENT_ID,"
    " round(MAGNITUDE * EVENT_COUNT_PER_CZ, 4) AS MAGNITUDE_X_EVENT_COUNT FROM features",
)


@check(
    f"""{FEATURE_SQL}, density AS (SELECT n_name, c_mktsegment, count(*) AS people FROM customer
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT EVENT_ID, CAST(coalesce(people, n) AS DOUBLE) AS people
FROM counted LEFT JOIN density ON STATE = n_name AND CZ_NAME = c_mktsegment"""
)
def density_join(spark, sf_dir):
    """Customers per place as a density that lists every place twice."""
    density = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("STATE"), F.col("c_mktsegment").alias("CZ_NAME"))
        .agg(F.count(F.lit(1)).alias("people"))
    )
    events = storm(spark, sf_dir).select("EVENT_ID", "STATE", "CZ_NAME")
    return location.with_density(events, density.unionAll(density), "people").select("EVENT_ID", "people")


@check(
    FEATURE_SQL
    + " UNION ALL ".join(
        f"{'SELECT * FROM (' if i == 0 else ''}"
        f"SELECT '{c}' AS column_name, {c} AS category, CAST(row_number() OVER"
        f" (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS index FROM features GROUP BY {c}"
        for i, c in enumerate(("EVENT_TYPE", "STATE", "MAGNITUDE_TYPE"))
    )
    + ")"
)
def string_index(spark, sf_dir):
    table_ = features.build_features(storm(spark, sf_dir))
    indexed = features.string_indexer().fit(table_).transform(table_)
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("category"),
                F.col(f"{c}_idx").alias("index"),
            )
            for c in features.CATEGORICAL
        ]
    )
    return indexed.select(F.inline(pairs)).distinct()


def scored_events(spark, sf_dir) -> DataFrame:
    """Features with a fixed score: the magnitude; above 50 predicts harm."""
    return features.build_features(storm(spark, sf_dir), place_counts=False).select(
        "*",
        features.split_name().alias("split"),
        F.when(F.col("MAGNITUDE") > 50, 1.0).otherwise(0.0).alias("prediction"),
    )


on_storm(
    "class_distribution",
    lambda df: evaluation.class_distribution(rows.with_has_harm(rows.with_total_harm(df))).orderBy(
        "has_harm"
    ),
    f"SELECT CASE WHEN {HARM_SQL} > 0 THEN 1 ELSE 0 END AS has_harm, count(*) AS event_count"
    " FROM storm GROUP BY 1",
)


def auc_sql(where="true"):
    return f"""
(SELECT (sum(r) FILTER (WHERE has_harm = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0) FROM (
  SELECT has_harm, rank() OVER (ORDER BY MAGNITUDE)
    + (count(*) OVER (PARTITION BY MAGNITUDE) - 1) / 2.0 AS r,
    CAST(sum(has_harm) OVER () AS DOUBLE) AS n1,
    CAST(sum(1 - has_harm) OVER () AS DOUBLE) AS n0
  FROM assigned WHERE {where}) GROUP BY n1, n0)"""


@check(f"{FEATURE_SQL} SELECT round({auc_sql()}, 6) AS auc")
def auc_rank(spark, sf_dir):
    auc = evaluation.area_under_roc(scored_events(spark, sf_dir), score="MAGNITUDE")
    return spark.createDataFrame([(round(auc, 6),)], "auc double")


@check(
    f"{FEATURE_SQL} SELECT CAST(count(*) FILTER (WHERE has_harm = prediction) AS DOUBLE)"
    " / count(*) AS accuracy FROM assigned"
)
def accuracy(spark, sf_dir):
    return evaluation.accuracy(scored_events(spark, sf_dir))


@check(
    f"{FEATURE_SQL} SELECT has_harm, prediction, count(*) AS event_count FROM assigned"
    " GROUP BY 1, 2"
)
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(scored_events(spark, sf_dir)).orderBy(
        "has_harm", "prediction"
    )


# --- importances ---------------------------------------------------------------------


def harm_shares(spark, sf_dir) -> DataFrame:
    """Importance-shaped table from the events: the harm that a feature accompanies.

    Lets the importance reports be checked exactly, which a trained forest does not.
    """
    events = rows.with_total_harm(storm(spark, sf_dir))
    entries = [
        F.struct(
            F.lit(c).alias("feature_group"),
            F.col(c).alias("category"),
            F.when(F.col(c).isNotNull(), F.col("TOTAL_HARM")).alias("weight"),
        )
        for c in features.CATEGORICAL
    ] + [
        F.struct(
            F.lit(name).alias("feature_group"),
            F.lit(None).cast("string").alias("category"),
            F.when(condition, F.col("TOTAL_HARM")).alias("weight"),
        )
        for name, condition in (
            ("MAGNITUDE", F.col("MAGNITUDE") > 50),
            ("EVENT_COUNT_PER_CZ", F.col("CZ_NAME").isNotNull()),
        )
    ]
    return (
        events.select(F.inline(F.array(*entries)))
        .where("weight IS NOT NULL")
        .groupBy("feature_group", "category")
        .agg((F.sum("weight") / 1000).alias("importance"))
    )


SHARES_SQL = f"""
, harmed AS (SELECT *, {HARM_SQL} AS h FROM storm),
shares AS (
  SELECT 'EVENT_TYPE' AS feature_group, EVENT_TYPE AS category, CAST(sum(h) AS DOUBLE) / 1000 AS importance
  FROM harmed WHERE EVENT_TYPE IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'STATE', STATE, CAST(sum(h) AS DOUBLE) / 1000 FROM harmed WHERE STATE IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'MAGNITUDE_TYPE', MAGNITUDE_TYPE, CAST(sum(h) AS DOUBLE) / 1000 FROM harmed
  WHERE MAGNITUDE_TYPE IS NOT NULL GROUP BY 2
  UNION ALL SELECT 'MAGNITUDE', NULL, CAST(sum(h) AS DOUBLE) / 1000 FROM harmed WHERE MAGNITUDE > 50
  UNION ALL SELECT 'EVENT_COUNT_PER_CZ', NULL, CAST(sum(h) AS DOUBLE) / 1000 FROM harmed
  WHERE CZ_NAME IS NOT NULL),
families AS (SELECT
  sum(importance) FILTER (WHERE feature_group IN ('EVENT_TYPE', 'MAGNITUDE_TYPE', 'MAGNITUDE'))
    AS storm_importance,
  sum(importance) FILTER (WHERE feature_group IN ('STATE', 'EVENT_COUNT_PER_CZ'))
    AS location_importance,
  sum(importance) AS total FROM shares)"""


@check(
    f"""{SHARES_SQL}
SELECT round(storm_importance, 6) AS storm_importance,
  round(location_importance, 6) AS location_importance,
  round(storm_importance / total * 100, 6) AS storm_pct,
  round(location_importance / total * 100, 6) AS location_pct,
  round(abs(storm_importance - location_importance) / total * 100, 6) AS diff_pct,
  CASE WHEN storm_importance > location_importance THEN 'STORM' ELSE 'LOCATION' END
    AS more_predictive,
  CASE WHEN abs(storm_importance - location_importance) / total * 100 < 10 THEN 'slightly'
    WHEN abs(storm_importance - location_importance) / total * 100 < 30 THEN 'moderately'
    ELSE 'significantly' END AS intensity
FROM families"""
)
def storm_vs_location(spark, sf_dir):
    columns = ("storm_importance", "location_importance", "storm_pct", "location_pct", "diff_pct")
    answer = forest.storm_vs_location(harm_shares(spark, sf_dir))
    return rounded(answer, **dict.fromkeys(columns, 6))


@check(
    f"""{SHARES_SQL}
SELECT rank, category, round(importance, 6) AS importance, round(pct, 2) AS pct FROM (
  SELECT row_number() OVER (ORDER BY importance DESC, category) AS rank, category, importance,
    importance / (SELECT sum(importance) FROM shares) * 100 AS pct
  FROM shares WHERE feature_group = 'STATE') WHERE rank <= 10"""
)
def top_state_shares(spark, sf_dir):
    return rounded(forest.top_categories(harm_shares(spark, sf_dir), "STATE"), importance=6)


_RESULT_GROUPS = {
    "storm_importance": ("EVENT_TYPE", "MAGNITUDE_TYPE", "MAGNITUDE"),
    "location_importance": ("STATE", "EVENT_COUNT_PER_CZ"),
    "event_type_importance": ("EVENT_TYPE",),
    "state_importance": ("STATE",),
    "magnitude_importance": ("MAGNITUDE",),
    "event_count_importance": ("EVENT_COUNT_PER_CZ",),
}
_RESULTS = ("test_auc", "test_accuracy", "val_auc", "val_accuracy", *_RESULT_GROUPS)


def _accuracy_sql(split):
    return (
        "(SELECT CAST(count(*) FILTER (WHERE has_harm = prediction) AS DOUBLE) / count(*)"
        f" FROM assigned WHERE split = '{split}')"
    )


@check(
    FEATURE_SQL
    + SHARES_SQL
    + f"""
SELECT round({auc_sql("split = 'test'")}, 6) AS test_auc,
  round({_accuracy_sql('test')}, 6) AS test_accuracy,
  round({auc_sql("split = 'validation'")}, 6) AS val_auc,
  round({_accuracy_sql('validation')}, 6) AS val_accuracy, """
    + ", ".join(
        "round(sum(importance) FILTER (WHERE feature_group IN ("
        + ", ".join(f"'{g}'" for g in groups)
        + f")), 6) AS {name}"
        for name, groups in _RESULT_GROUPS.items()
    )
    + " FROM shares"
)
def metrics_json(spark, sf_dir):
    """The results record of the fixed score, written as JSON and read back."""
    scored = cache_clean(scored_events(spark, sf_dir), scratch_path(spark, "scored"))
    quality = {}
    for name, split in (("test", "test"), ("val", "validation")):
        part = scored.where(F.col("split") == split)
        quality[f"{name}_auc"] = evaluation.area_under_roc(part, score="MAGNITUDE")
        quality[f"{name}_accuracy"] = evaluation.accuracy(part).head()[0]
    path = scratch_path(spark, "metrics_json")
    write_metrics_json(forest.results_record(quality, harm_shares(spark, sf_dir)), path)
    schema = ", ".join(f"{name} double" for name in _RESULTS)
    return rounded(spark.read.schema(schema).json(path), **dict.fromkeys(_RESULTS, 6))


# --- random forest: no SQL states its results -----------------------------------------


@lru_cache(maxsize=4)
def _trained(application_id, spark, sf_dir):
    """The model, and the validation and test rows, trained once per session and input."""
    table_ = cache_clean(
        features.build_features(storm(spark, sf_dir)), scratch_path(spark, "features")
    )
    train, validation, test = features.split3(table_)
    model = forest.train_harm_model(train, partitions=8)
    return model, validation, test


def trained(spark, sf_dir):
    model, _, test = _trained(spark.sparkContext.applicationId, spark, sf_dir)
    return model, test


def _unseen(spark, sf_dir):
    """The validation rows."""
    return _trained(spark.sparkContext.applicationId, spark, sf_dir)[1]


def importances(spark, sf_dir):
    model, test = trained(spark, sf_dir)
    return forest.feature_importance(model, model.transform(test))


@check()
def rf_predictions(spark, sf_dir):
    model, test = trained(spark, sf_dir)
    return model.transform(test).select("EVENT_ID", "has_harm", "prediction")


@check()
def rf_quality(spark, sf_dir):
    """Both parts that the model has not seen, as the report has them."""
    model, test = trained(spark, sf_dir)
    parts = {"validation": _unseen(spark, sf_dir), "test": test}
    frames = []
    for name, part in parts.items():
        scored = materialize(model.transform(part).select("has_harm", "rawPrediction", "prediction"), "scored")
        auc = F.lit(evaluation.area_under_roc(scored)).alias("auc")
        frames.append(evaluation.accuracy(scored).select(F.lit(name).alias("part"), auc, "accuracy"))
    return frames[0].unionAll(frames[1])


@check()
def feature_importance(spark, sf_dir):
    return importances(spark, sf_dir)


@check()
def group_importance(spark, sf_dir):
    return forest.group_importance(importances(spark, sf_dir))


@check()
def top_event_importance(spark, sf_dir):
    return forest.top_categories(importances(spark, sf_dir), "EVENT_TYPE")


@check()
def top_state_importance(spark, sf_dir):
    return forest.top_categories(importances(spark, sf_dir), "STATE")


@check()
def model_storm_vs_location(spark, sf_dir):
    return forest.storm_vs_location(importances(spark, sf_dir))


@check()
def permutation_importance(spark, sf_dir):
    model, test = trained(spark, sf_dir)
    return forest.permutation_importance(model, test)


# --- rollup ---------------------------------------------------------------------------

_HARM_COUNTS = ("INJURIES_DIRECT", "INJURIES_INDIRECT", "DEATHS_DIRECT", "DEATHS_INDIRECT")
_VALUES = {c: f"CAST({c} AS DOUBLE)" for c in _HARM_COUNTS} | {
    c: amount_sql(c) for c in ("DAMAGE_PROPERTY", "DAMAGE_CROPS")
}
_ROLLED_SQL = f"""
, flagged AS (SELECT *, {HARM_SQL} AS h, {MAG_SQL} AS usable, {_COMPLETE_SQL} AS complete,
  {SEVERE_SQL} AS severe, {SCALE_SQL} AS severe_scale_,
  {', '.join(f"{v} AS v_{c.lower()}" for c, v in _VALUES.items())} FROM storm)
SELECT YEAR, STATE, CZ_NAME, EVENT_TYPE, MAGNITUDE_TYPE, count(*) AS events,
  count(*) FILTER (WHERE h > 0) AS harmful_events, CAST(sum(h) AS BIGINT) AS harm,
  count(*) AS readable_events,
  CAST(sum({INJURIES_SQL}) AS BIGINT) AS injuries, CAST(sum({DEATHS_SQL}) AS BIGINT) AS deaths,
  count(*) FILTER (WHERE severe) AS severe_impact,
  count(*) FILTER (WHERE severe_scale_) AS severe_scale,
  count(*) FILTER (WHERE usable) AS magnitudes,
  round(sum(MAGNITUDE) FILTER (WHERE usable), 4) AS magnitude_sum,
  max(MAGNITUDE) FILTER (WHERE usable) AS magnitude_max,
  count(*) FILTER (WHERE usable AND MAGNITUDE > 50) AS over_50,
  count(*) FILTER (WHERE usable AND MAGNITUDE > 20) AS over_20,
  {', '.join(
      f"count(*) FILTER (WHERE usable AND MAGNITUDE >= {a} AND MAGNITUDE < {b}) AS band_{i}"
      for i, (a, b) in enumerate(zip(("'-inf'", *MAGNITUDE_EDGES), (*MAGNITUDE_EDGES, "'inf'")))
  )},
  {', '.join(
      f"count(v_{c.lower()}) FILTER (WHERE complete) AS n_{c.lower()},"
      f" round(sum(v_{c.lower()}) FILTER (WHERE complete), 2) AS sum_{c.lower()}"
      for c in _VALUES
  )},
  count(*) FILTER (WHERE complete) AS complete_events
FROM flagged GROUP BY 1, 2, 3, 4, 5"""


@check(_ROLLED_SQL)
def event_rollup(spark, sf_dir):
    rolled = rollup.event_rollup(storm(spark, sf_dir))
    sums = {f"sum_{c.lower()}": 2 for c in _VALUES}
    return rounded(rolled, magnitude_sum=4, **sums)


# --- further forms of the inputs ------------------------------------------------------

# Fixed literals that stand in for every 23rd, 29th ... value of a text column.
_LITERALS = ("nan", "nanK", "inf", "abc", "", " ", "7.9", "3e9")
_TEXT_COLUMNS = (*_HARM_COUNTS, "DAMAGE_PROPERTY", "DAMAGE_CROPS", "MAGNITUDE")


def text_storm(spark, sf_dir) -> DataFrame:
    """The events with all measures as text, literals mixed in."""
    key = F.col("EVENT_ID")
    literal = F.element_at(F.array(*map(F.lit, _LITERALS)), (key % len(_LITERALS) + 1).cast("int"))
    return storm(spark, sf_dir).withColumns(
        {
            c: F.when(key % (11 + i) == 3, literal).otherwise(F.col(c).cast("string"))
            for i, c in enumerate(_TEXT_COLUMNS)
        }
    )


TEXT_SQL = (
    ", texts AS (SELECT * REPLACE ("
    + ", ".join(
        f"CASE WHEN EVENT_ID % {11 + i} = 3 THEN [{', '.join(repr(x) for x in _LITERALS)}]"
        f"[EVENT_ID % {len(_LITERALS)} + 1] ELSE CAST({c} AS VARCHAR) END AS {c}"
        for i, c in enumerate(_TEXT_COLUMNS)
    )
    + ") FROM storm)"
)


def _number_sql(expression):
    """Finite or infinite number, NULL for NaN and for what is none."""
    return f"(CASE WHEN NOT isnan({expression}) THEN {expression} END)"


def _text_count_sql(column):
    double = f"TRY_CAST({column} AS DOUBLE)"
    return f"coalesce(CASE WHEN isfinite({double}) THEN TRY_CAST(trunc({double}) AS BIGINT) END, 0)"


def _strict_count_sql(column):
    return rf"(CASE WHEN regexp_matches({column}, '^\s*[+-]?\d+\s*$') THEN CAST({column} AS BIGINT) ELSE 0 END)"


def _text_amount_sql(column):
    return f"coalesce({_number_sql(amount_sql(column))}, 0)"


_TEXT_HARM_SQL = "(" + " + ".join(_text_count_sql(c) for c in _HARM_COUNTS) + ")"


@check(
    f"""{TEXT_SQL}
SELECT EVENT_ID, ({_text_amount_sql('DAMAGE_PROPERTY')} > 50000 OR {_text_amount_sql('DAMAGE_CROPS')} > 50000
  OR {_strict_count_sql('DEATHS_DIRECT')} + {_strict_count_sql('DEATHS_INDIRECT')} > 0
  OR {_strict_count_sql('INJURIES_DIRECT')} + {_strict_count_sql('INJURIES_INDIRECT')} > 5) AS severe,
  CAST({_TEXT_HARM_SQL} AS BIGINT) AS TOTAL_HARM FROM texts"""
)
def severe_flag_text(spark, sf_dir):
    df = rows.with_total_harm(text_storm(spark, sf_dir))
    return df.select("EVENT_ID", severe_by_impact(df).alias("severe"), "TOTAL_HARM")


@check(
    f"""{TEXT_SQL}
SELECT EVENT_TYPE, {', '.join(
    f"round(avg({_number_sql(amount_sql(c))}) FILTER (WHERE isfinite({_number_sql(amount_sql(c))})), 4) AS avg_{c.lower()}"
    for c in ('DAMAGE_PROPERTY', 'DAMAGE_CROPS')
)}
FROM texts WHERE EVENT_TYPE IN ('Flood', 'Flash Flood') AND nullif(DAMAGE_PROPERTY, '') IS NOT NULL
  AND nullif(DAMAGE_CROPS, '') IS NOT NULL AND DAMAGE_PROPERTY <> 'inf' AND DAMAGE_CROPS <> 'inf'
GROUP BY EVENT_TYPE"""
)
def flood_means_text(spark, sf_dir):
    """A NaN is left out of the mean; infinite damage is filtered by the caller."""
    df = text_storm(spark, sf_dir).where("DAMAGE_PROPERTY <> 'inf' AND DAMAGE_CROPS <> 'inf'")
    means = damage.mean_by_type(df, measures=("DAMAGE_PROPERTY", "DAMAGE_CROPS"))
    return rounded(means, avg_damage_property=4, avg_damage_crops=4)


_TEXT_MAGNITUDE_SQL = "coalesce(" + _number_sql("TRY_CAST(MAGNITUDE AS DOUBLE)") + ", 0)"


@check(
    f"""{TEXT_SQL}
SELECT EVENT_ID, {_TEXT_MAGNITUDE_SQL} = 'inf'::DOUBLE AS infinite,
  CASE WHEN isfinite({_TEXT_MAGNITUDE_SQL}) THEN {_TEXT_MAGNITUDE_SQL} END AS MAGNITUDE,
  {_text_count_sql('DEATHS_DIRECT')} AS DEATHS_DIRECT FROM texts"""
)
def fill_missing_text(spark, sf_dir):
    filled = rows.fill_missing(text_storm(spark, sf_dir), {"MAGNITUDE": 0.0, "DEATHS_DIRECT": 0})
    infinite = F.col("MAGNITUDE") == float("inf")
    return filled.select(
        "EVENT_ID",
        infinite.alias("infinite"),
        F.when(~infinite, F.col("MAGNITUDE")).alias("MAGNITUDE"),
        "DEATHS_DIRECT",
    )


@check(
    f"""{TEXT_SQL}
, counted AS (SELECT *, CASE WHEN STATE IS NULL OR CZ_NAME IS NULL THEN 1
    ELSE count(*) OVER (PARTITION BY STATE, CZ_NAME) END AS n FROM texts)
SELECT EVENT_ID, EVENT_TYPE, STATE, coalesce(MAGNITUDE_TYPE, 'NONE') AS MAGNITUDE_TYPE,
  CASE WHEN isfinite({_TEXT_MAGNITUDE_SQL}) THEN {_TEXT_MAGNITUDE_SQL} END AS MAGNITUDE,
  n AS EVENT_COUNT_PER_CZ, CASE WHEN {_TEXT_HARM_SQL} > 0 THEN 1 ELSE 0 END AS has_harm
FROM counted WHERE EVENT_TYPE IS NOT NULL AND STATE IS NOT NULL"""
)
def feature_table_text(spark, sf_dir):
    built = features.build_features(text_storm(spark, sf_dir))
    finite = F.when(F.abs("MAGNITUDE") < float("inf"), F.col("MAGNITUDE"))
    return built.withColumn("MAGNITUDE", finite)


@check(
    f"""
, wide AS (SELECT *, YEAR * 1000 + EVENT_ID % 97 AS wide_year FROM storm),
yearly AS (SELECT wide_year, avg(MAGNITUDE) AS m FROM wide WHERE {MAG_SQL} GROUP BY wide_year),
ranked AS (SELECT
  rank() OVER (ORDER BY wide_year) + (count(*) OVER (PARTITION BY wide_year) - 1) / 2.0 AS ry,
  rank() OVER (ORDER BY m) + (count(*) OVER (PARTITION BY m) - 1) / 2.0 AS rm FROM yearly)
SELECT round(corr(ry, rm), 6) AS rho FROM ranked"""
)
def spearman_wide_years(spark, sf_dir):
    """Years far beyond 16 bits, and many of them."""
    wide = F.col("YEAR") * 1000 + (F.col("EVENT_ID") % 97).cast("int")
    return rounded(trend.spearman_trend(storm(spark, sf_dir).withColumn("YEAR", wide)), rho=6)


@check(
    f"SELECT {_STORM_COLUMNS},"
    " CASE WHEN EVENT_ID % 3 = 1 THEN 'note ' || EVENT_TYPE END AS NOTE FROM storm"
)
def mixed_headers(spark, sf_dir):
    """One folder whose files have the same columns, reordered ones, and one more."""
    path = scratch_path(spark, "mixed")
    events = storm(spark, sf_dir)
    noted = events.withColumn("NOTE", F.concat(F.lit("note "), F.col("EVENT_TYPE")))
    write_csv(events.where("EVENT_ID % 3 = 0"), f"{path}/a")
    write_csv(noted.where("EVENT_ID % 3 = 1").select("NOTE", *events.columns), f"{path}/b")
    write_csv(events.where("EVENT_ID % 3 = 2").select(*reversed(events.columns)), f"{path}/c")
    return read_events_csv(spark, path)


@check(
    "SELECT EVENT_ID, EVENT_ID % 5 IN (1, 2) AS ragged,"
    " CASE WHEN EVENT_ID % 5 <> 1 THEN 'x, y' END AS PLACE FROM storm"
)
def csv_file_rejects(spark, sf_dir):
    """Records with a field too few and a field too many, told apart from the others."""
    path = scratch_path(spark, "ragged")
    key = F.col("EVENT_ID")
    text = key.cast("string")
    line = (
        F.when(key % 5 == 1, text)
        .when(key % 5 == 2, F.concat(text, F.lit(',"x, y",7')))
        .otherwise(F.concat(text, F.lit(',"x, y"')))
    )
    # one column of whole lines, unquoted, whose name is the header of each file
    lines = storm(spark, sf_dir).select(line.alias("EVENT_ID,PLACE"))
    lines.write.csv(path, header=True, sep="\x01", quote="")
    read = read_events_csv(spark, path, multi_line=False, reject_column="rejected")
    return read.select("EVENT_ID", F.col("rejected").isNotNull().alias("ragged"), "PLACE")


@check(
    f"""{FEATURE_SQL}
, seen AS (SELECT STATE, CZ_NAME, count(*) AS m FROM storm WHERE STATE IS NOT NULL AND CZ_NAME IS NOT NULL
  AND ('0x' || substr(md5(CAST(EVENT_ID AS VARCHAR) || ':42'), 1, 8))::BIGINT % 100 < 70 GROUP BY 1, 2)
SELECT EVENT_ID, coalesce(m, 1) AS EVENT_COUNT_PER_CZ FROM storm LEFT JOIN seen USING (STATE, CZ_NAME)
WHERE EVENT_TYPE IS NOT NULL AND STATE IS NOT NULL"""
)
def train_only_counts(spark, sf_dir):
    """Place counts taken on the training rows only."""
    events = storm(spark, sf_dir)
    counts = location.location_counts(features.split3(events)[0])
    return features.build_features(events, counts=counts).select("EVENT_ID", "EVENT_COUNT_PER_CZ")


# --- vectors, a tree and donors that SQL can state ------------------------------------

_INDEX_SQL = FEATURE_SQL + "".join(
    f""", {c.lower()}_index AS (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i,
  count(*) OVER () AS n FROM features GROUP BY {c})"""
    for c in features.CATEGORICAL
)
_ENCODED_SQL = (
    f"""{_INDEX_SQL}
, encoded AS (SELECT f.*, e.i AS e, s.i AS s, m.i AS m, e.n AS ne, s.n AS ns, m.n AS nm FROM features f
  JOIN event_type_index e USING (EVENT_TYPE) JOIN state_index s USING (STATE)
  JOIN magnitude_type_index m USING (MAGNITUDE_TYPE))"""
)


def encoded(spark, sf_dir) -> DataFrame:
    rows_ = features.with_interaction_product(features.build_features(storm(spark, sf_dir)))
    stages = features.feature_stages(interactions=True)
    return Pipeline(stages=stages).fit(rows_).transform(rows_)


def slots(df: DataFrame, vector: str) -> DataFrame:
    """(EVENT_ID, slot, value) of the slots that are not 0."""
    values = df.select("EVENT_ID", F.posexplode(vector_to_array(vector)).alias("slot", "value"))
    return rounded(values.where("value <> 0"), value=4)


@check(
    f"""{_ENCODED_SQL}
SELECT EVENT_ID, 'EVENT_TYPE' AS column_name, CAST(e AS INT) AS slot, 1e0 AS value FROM encoded
UNION ALL SELECT EVENT_ID, 'STATE', CAST(s AS INT), 1e0 FROM encoded
UNION ALL SELECT EVENT_ID, 'MAGNITUDE_TYPE', CAST(m AS INT), 1e0 FROM encoded"""
)
def one_hot_slots(spark, sf_dir):
    df = encoded(spark, sf_dir)
    parts = [
        slots(df, f"{c}_vec").withColumn("column_name", F.lit(c)) for c in features.CATEGORICAL
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@check(
    f"""{_ENCODED_SQL}
SELECT EVENT_ID, CAST(e * ns + s AS INT) AS slot, 1e0 AS value FROM encoded"""
)
def category_interaction_slots(spark, sf_dir):
    return slots(encoded(spark, sf_dir), "EVENT_TYPE_X_STATE")


@check(
    f"""{_ENCODED_SQL}
SELECT EVENT_ID, CAST(slot AS INT) AS slot, round(value, 4) AS value FROM (
  SELECT EVENT_ID, unnest([e, ne + s, ne + ns + m, ne + ns + nm, ne + ns + nm + 1,
      ne + ns + nm + 2 + e * ns + s, ne + ns + nm + 2 + ne * ns]) AS slot,
    unnest([1, 1, 1, MAGNITUDE, EVENT_COUNT_PER_CZ, 1, MAGNITUDE * EVENT_COUNT_PER_CZ]) AS value FROM encoded)
WHERE value <> 0"""
)
def assembled_slots(spark, sf_dir):
    return slots(encoded(spark, sf_dir), "features")


# Gini gain of every one-hot slot of one category against its rest. The label is a
# magnitude above 20: trees merge two leaves of one prediction, as rare harm would give.
_STUMP_SQL = f"""{_ENCODED_SQL}
, trained AS (SELECT encoded.* REPLACE (CASE WHEN encoded.MAGNITUDE > 20 THEN 1 ELSE 0 END AS has_harm)
  FROM encoded JOIN assigned USING (EVENT_ID) WHERE split = 'train'),
slots AS (
  SELECT 'EVENT_TYPE' AS feature_group, EVENT_TYPE AS category, EVENT_ID, has_harm FROM trained
  UNION ALL SELECT 'STATE', STATE, EVENT_ID, has_harm FROM trained
  UNION ALL SELECT 'MAGNITUDE_TYPE', MAGNITUDE_TYPE, EVENT_ID, has_harm FROM trained),
sides AS (SELECT feature_group, category, CAST(count(*) AS DOUBLE) AS n1, CAST(sum(has_harm) AS DOUBLE) AS h1,
  (SELECT CAST(count(*) AS DOUBLE) FROM trained) AS n, (SELECT CAST(sum(has_harm) AS DOUBLE) FROM trained) AS h
  FROM slots GROUP BY 1, 2),
gains AS (SELECT *, h1 / n1 AS p1, (h - h1) / (n - n1) AS p0,
  h1 * (n1 - h1) / n1 + (h - h1) * (n - n1 - h + h1) / (n - n1) AS impurity FROM sides WHERE n1 < n),
best AS (SELECT * FROM gains ORDER BY impurity LIMIT 1)"""


def stump(spark, sf_dir):
    """One tree of depth 1 on the categories, with all rows and all features."""
    built = features.build_features(storm(spark, sf_dir))
    strong = F.when(F.col("MAGNITUDE") > 20, 1).otherwise(0)
    parts = features.split3(built.withColumn("has_harm", strong))
    model = forest.train_harm_model(
        parts[0], trees=1, depth=1, partitions=4, bootstrap=False, columns=features.CATEGORICAL
    )
    return model, parts[2]


@check(
    f"""{_STUMP_SQL}
SELECT EVENT_ID, round(CASE WHEN CASE feature_group WHEN 'EVENT_TYPE' THEN a.EVENT_TYPE WHEN 'STATE' THEN a.STATE
  ELSE a.MAGNITUDE_TYPE END = category THEN p1 ELSE p0 END, 6) AS probability
FROM assigned a, best WHERE split = 'test'"""
)
def stump_probability(spark, sf_dir):
    model, test = stump(spark, sf_dir)
    scored = forest.harm_probability(model)(test)
    return scored.select("EVENT_ID", F.round("score", 6).alias("probability"))


@check(f"{_STUMP_SQL} SELECT feature_group, category, 1e0 AS importance FROM best")
def stump_importance(spark, sf_dir):
    model, test = stump(spark, sf_dir)
    found = forest.feature_importance(model, model.transform(test))
    return found.where("importance > 0").drop("slot")


_DONOR_SQL = f"""{FEATURE_SQL}
, placed AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(EVENT_ID AS VARCHAR) || ':42'), EVENT_ID) - 1 AS p,
  count(*) OVER () AS rows_ FROM features),
paired AS (SELECT a.EVENT_ID, a.has_harm, a.MAGNITUDE, a.EVENT_COUNT_PER_CZ, b.EVENT_ID AS donor_id,
  b.MAGNITUDE AS donor_magnitude, b.EVENT_COUNT_PER_CZ AS donor_count
  FROM placed a JOIN placed b ON b.p = (a.p + 1) % a.rows_)"""


@check(f"{_DONOR_SQL} SELECT EVENT_ID, donor_id, donor_magnitude, donor_count FROM paired")
def donor_values(spark, sf_dir):
    built = features.build_features(storm(spark, sf_dir))
    paired = forest.with_donor_values(built, ("EVENT_ID", "MAGNITUDE", "EVENT_COUNT_PER_CZ"))
    return paired.select(
        "EVENT_ID",
        F.col("donor.EVENT_ID").alias("donor_id"),
        F.col("donor.MAGNITUDE").alias("donor_magnitude"),
        F.col("donor.EVENT_COUNT_PER_CZ").alias("donor_count"),
    )


def _fixed_auc_sql(score):
    return f"""(SELECT (sum(r) FILTER (WHERE has_harm = 1) - n1 * (n1 + 1) / 2.0) / (n1 * n0) FROM (
  SELECT has_harm, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS r,
    CAST(sum(has_harm) OVER () AS DOUBLE) AS n1, CAST(sum(1 - has_harm) OVER () AS DOUBLE) AS n0
  FROM paired) GROUP BY n1, n0)"""


@check(
    f"""{_DONOR_SQL}
, areas AS (SELECT {_fixed_auc_sql('MAGNITUDE + EVENT_COUNT_PER_CZ')} AS base,
  {_fixed_auc_sql('donor_magnitude + EVENT_COUNT_PER_CZ')} AS m, {_fixed_auc_sql('MAGNITUDE + donor_count')} AS c)
SELECT 'MAGNITUDE' AS feature, round(base, 6) AS base_auc, round(m, 6) AS permuted_auc, round(base - m, 6) AS auc_drop FROM areas
UNION ALL SELECT 'EVENT_COUNT_PER_CZ', round(base, 6), round(c, 6), round(base - c, 6) FROM areas"""
)
def permutation_importance_fixed(spark, sf_dir):
    """The sum of two features as a fixed score."""

    def score(df):
        return df.withColumn("score", F.col("MAGNITUDE") + F.col("EVENT_COUNT_PER_CZ"))

    built = features.build_features(storm(spark, sf_dir))
    found = forest.permutation_importance(score, built, ("MAGNITUDE", "EVENT_COUNT_PER_CZ"))
    return rounded(found, base_auc=6, permuted_auc=6, auc_drop=6)
