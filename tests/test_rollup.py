import pytest
from pyspark.sql import functions as F

from checks.storm_view import storm
from tempestry.operators import damage, frequency, harm, impact, tornado, trend
from tempestry.functions import severe_by_impact
from tempestry.plans import rollup
from tempestry.schema import HARM_COLUMNS

SF_DIR = "/root/testdata/sf0.001"


def text_events(events):
    """The same events as text, with counts and years that do not parse."""
    key = F.col("EVENT_ID")
    text = events.select(*[F.col(c).cast("string").alias(c) for c in events.columns])
    return text.withColumns(
        {
            "INJURIES_DIRECT": F.when(key % 31 == 0, "junk").otherwise(F.col("INJURIES_DIRECT")),
            "DEATHS_DIRECT": F.when(key % 37 == 0, "1.9").otherwise(F.col("DEATHS_DIRECT")),
            "YEAR": F.when(key % 41 == 0, "?").otherwise(F.col("YEAR")),
            "MAGNITUDE": F.when(key % 43 == 0, "nan").otherwise(F.col("MAGNITUDE")),
            "STATE": F.when(key % 47 == 0, "").otherwise(F.col("STATE")),
        }
    )


@pytest.fixture(scope="module", params=["typed", "text"])
def both(request, spark):
    events = storm(spark, SF_DIR)
    events = (text_events(events) if request.param == "text" else events).persist()
    yield events, rollup.event_rollup(events).persist()
    events.unpersist()


def rounded_rows(df):
    def plain(value):
        return round(value, 6) if isinstance(value, float) else value

    return sorted(
        (tuple(plain(row[c]) for c in sorted(df.columns)) for row in df.collect()),
        key=lambda t: [(v is None, str(v)) for v in t],
    )


CASES = {
    "harm_event": lambda e, r: (harm.harm_by_event_type(e), rollup.harm_stats(r, "EVENT_TYPE")),
    "harm_county": lambda e, r: (
        harm.harm_by_county(e),
        rollup.harm_stats(r, "STATE", "CZ_NAME"),
    ),
    "harm_magnitude_type": lambda e, r: (
        harm.harm_by_magnitude_type(e),
        rollup.harm_stats(r, "MAGNITUDE_TYPE", missing="NONE"),
    ),
    "harm_overview": lambda e, r: (harm.harm_overview(e), rollup.harm_overview(r)),
    "impact_county": lambda e, r: (
        impact.impact_by_county(e),
        rollup.total_impact(r, "STATE", "CZ_NAME"),
    ),
    "impact_state": lambda e, r: (impact.impact_by_state(e), rollup.total_impact(r, "STATE")),
    "impact_type": lambda e, r: (impact.impact_by_type(e), rollup.impact_by_type(r)),
    "frequency": lambda e, r: (
        frequency.state_event_frequency(e),
        rollup.state_event_frequency(r),
    ),
    "locations": lambda e, r: (
        frequency.event_count_by_location(e),
        rollup.event_count_by_location(r),
    ),
    "tornado_scale": lambda e, r: (tornado.tornado_summary(e), rollup.tornado_summary(r)),
    "tornado_impact": lambda e, r: (
        tornado.tornado_summary(e, severe=severe_by_impact(e)),
        rollup.tornado_summary(r, "severe_impact"),
    ),
    "means": lambda e, r: (damage.mean_by_type(e), rollup.mean_by_type(r)),
    "trend": lambda e, r: (trend.magnitude_trend(e), rollup.magnitude_trend(r)),
    "max": lambda e, r: (trend.max_magnitude_by_year(e), rollup.max_magnitude_by_year(r)),
    "bands": lambda e, r: (trend.band_counts(e), rollup.band_counts(r)),
}


@pytest.mark.parametrize("case", CASES)
def test_rollup_gives_the_direct_result(both, case):
    direct, derived = CASES[case](*both)
    assert rounded_rows(direct) == rounded_rows(derived)


def test_rollup_loses_no_event(both):
    events, rolled = both
    total = rolled.agg(F.sum("events"), F.sum("readable_events")).head()
    assert total[0] == events.count()
    typed = dict(events.dtypes)["INJURIES_DIRECT"] != "string"
    assert (total[1] == total[0]) == typed
    assert set(HARM_COLUMNS) <= set(events.columns)
