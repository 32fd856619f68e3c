from collections import Counter, defaultdict

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.storm_view import storm
from tempestry.functions import log_gamma, regularized_beta
from tempestry.operators import (
    damage,
    features,
    frequency,
    harm,
    impact,
    location,
    rows,
    tornado,
    trend,
)
from tempestry.operators.ranking import top_k
from tempestry.schema import EVENT_SCHEMA, HARM_COLUMNS
from tests.oracle import rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark):
    df = storm(spark, SF_DIR).persist()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def local(events):
    return events.collect()


def as_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def harm_of(row):
    return sum(row[c] or 0 for c in HARM_COLUMNS)


def test_harm_agrees_with_plain_python(events, local):
    people, count = Counter(), Counter()
    for row in local:
        if harm_of(row) > 0:
            key = (row.EVENT_TYPE or "UNKNOWN", row.STATE or "UNKNOWN")
            people[key] += harm_of(row)
            count[key] += 1
    got = {(r.EVENT_TYPE, r.STATE): r for r in harm.harm_by_event_state(events).collect()}
    assert {k: (r.total_harm, r.event_count, r.avg_harm) for k, r in got.items()} == {
        k: (people[k], count[k], people[k] / count[k]) for k in people
    }


def test_group_totals_add_up(events):
    overall = harm.harm_overview(events).head()
    for by in (
        harm.harm_by_event_type,
        harm.harm_by_magnitude_type,
        harm.harm_by_state,
        harm.harm_by_county,
    ):
        total = by(events).agg(F.sum("total_harm"), F.sum("event_count")).head()
        assert tuple(total) == (overall.total_harm, overall.events_with_harm)
    impacts = impact.impact_by_type(events).agg(F.sum("injuries") + F.sum("deaths")).head()[0]
    assert impacts == overall.total_harm
    counts = frequency.event_count_by_location(events).agg(F.sum("event_count")).head()[0]
    assert counts == events.count()


def test_overview_without_harm(events):
    nothing = harm.harm_overview(events.where("EVENT_ID < 0")).head()
    assert tuple(nothing) == (0, 0, None)


def test_text_measures_follow_each_rule(spark):
    rows_ = [
        ("A", "x", "T", "1", "0", "", "2.9", ""),
        ("A", "x", "T", "junk", "4", "0", "0", "EG"),
        ("A", None, "T", "nan", "0", "0", "1", None),
    ]
    columns = ["STATE", "CZ_NAME", "EVENT_TYPE", *HARM_COLUMNS, "MAGNITUDE_TYPE"]
    schema = ", ".join(f"{c} string" for c in columns)
    df = spark.createDataFrame(rows_, schema)
    # Harm reads unparseable as 0; impact leaves the whole record out.
    assert harm.harm_by_state(df).head()[1:3] == (3 + 4 + 1, 3)
    assert [tuple(r) for r in impact.impact_by_type(df).collect()] == [("T", "Unknown", 1, 2)]


def test_over_50_never_exceeds_over_20(events):
    for row in trend.magnitude_trend(events).collect():
        assert 0 <= row.over_50 <= row.over_20


def test_one_pass_trend_agrees_with_single_counts(events):
    merged = trend.magnitude_trend(events)
    for t in (50, 20):
        nonzero = merged.where(F.col(f"over_{t}") > 0).select("YEAR", f"over_{t}")
        single = trend.count_over_by_year(events, t)
        assert {tuple(r) for r in nonzero.collect()} == {tuple(r) for r in single.collect()}


def test_spearman_with_ties(spark):
    pairs = spark.createDataFrame(
        [(1, 5.0), (2, 5.0), (3, 7.0), (4, 1.0), (5, 9.0)], "x int, y double"
    )
    # Ranks 1..5 against 2.5, 2.5, 4, 1, 5: covariance 3.5, variances 10 and 9.5.
    assert trend.spearman(pairs, "x", "y").head()[0] == pytest.approx(3.5 / 95**0.5)


def _test_of(spark, rows):
    return tuple(trend.spearman_test(spark.createDataFrame(rows, "x int, y double"), "x", "y").head())


def test_p_values_of_ties_perfect_and_few_pairs(spark):
    rho = 3.5 / 95**0.5
    rows = [(1, 5.0), (2, 5.0), (3, 7.0), (4, 1.0), (5, 9.0), (None, 1.0), (9, None)]
    found, n, p = _test_of(spark, rows)
    angle = math.asin(rho)
    tail = 2 / math.pi * (angle + math.sin(angle) * math.cos(angle))  # three degrees of freedom
    assert n == 5 and (found, p) == pytest.approx((rho, 1 - tail), abs=1e-10)
    for sign in (1, -1):
        assert _test_of(spark, [(i, sign * i * i / 2) for i in range(6)]) == pytest.approx((sign, 6, 0), abs=1e-12)
    assert _test_of(spark, [(1, 2.0), (2, 3.0)]) == (pytest.approx(1.0), 2, None)
    assert _test_of(spark, [(1, 2.0), (2, 2.0), (3, 2.0)]) == (None, 3, None)
    assert _test_of(spark, [(None, 2.0)]) == (None, 0, None)


def test_both_ways_to_rank_agree(spark):
    rows = [(i * 37 % 50, float(i * i % 23)) for i in range(400)]
    df = spark.createDataFrame(rows, "x int, y double")
    few, many = (trend.spearman_test(df, "x", "y", n).head() for n in (400, 399))
    assert tuple(few) == pytest.approx(tuple(many)) and few.n == 400 and 0 < few.p_value < 1


def test_beta_function_at_small_large_and_end_arguments(spark):
    cases = [(0.3, 1.0, 4.0, 1 - 0.7**4), (0.7, 3.0, 1.0, 0.7**3), (0.5, 2.5, 2.5, 0.5), (0.5, 40.0, 40.0, 0.5),
             (0.25, 0.5, 0.5, 1 / 3), (0.0, 2.0, 3.0, 0.0), (1.0, 2.0, 3.0, 1.0), (0.5, 1e6, 1e6, 0.5), (0.25, 2.0, 1.0, 0.0625)]
    df = spark.createDataFrame(cases, "x double, a double, b double, expected double")
    rows = df.select(regularized_beta(F.col("x"), F.col("a"), F.col("b")), "expected").collect()
    for value, expected in rows:
        assert value == pytest.approx(expected, abs=2e-9)
    values = [0.5, 1.0, 1.5, 7.25, 300.0, 1e6]
    gammas = spark.createDataFrame([(v,) for v in values], "z double").select(log_gamma(F.col("z")))
    assert [r[0] for r in gammas.collect()] == pytest.approx([math.lgamma(v) for v in values], abs=1e-11, rel=1e-12)


def test_text_years_that_do_not_parse_are_left_out(spark):
    data = [("2020", 5.0), ("x", 6.0), (None, 7.0)]
    df = spark.createDataFrame(data, "YEAR string, MAGNITUDE double")
    assert [tuple(r) for r in trend.avg_magnitude_by_year(df).collect()] == [(2020, 5.0)]


def test_tornado_join_equals_one_pass(events):
    one_pass = tornado.tornado_summary(events)
    joined = tornado.tornado_summary_joined(
        tornado.tornado_count_by_state(events), tornado.severe_scale_by_state(events)
    )
    assert as_rows(one_pass) == as_rows(joined)


def test_means_are_true_means(spark):
    columns = [f for f in EVENT_SCHEMA if f.name in ("EVENT_TYPE", *damage.IMPACT_MEASURES)]
    values = [("Flood", 8), ("Flood", 0), ("Flood", 0), ("Flood", 0), ("Flash Flood", 4)]
    data = [
        tuple(
            {"EVENT_TYPE": kind, "DAMAGE_PROPERTY": f"{n}.0K", "DAMAGE_CROPS": f"{n}.0K"}.get(f.name, n)
            for f in columns
        )
        for kind, n in values
    ]
    df = spark.createDataFrame(data, StructType(columns))
    for order in (df, df.orderBy(F.desc("DAMAGE_PROPERTY")), df.repartition(3)):
        means = {r.EVENT_TYPE: r for r in damage.mean_by_type(order).collect()}
        assert means["Flood"].avg_injuries_direct == 2.0
        assert means["Flood"].avg_damage_property == 2000.0
    ratios = damage.relative_to_baseline(damage.mean_by_type(df)).collect()
    assert {(r.EVENT_TYPE, r.ratio) for r in ratios} == {("Flood", 0.5), ("Flash Flood", 1.0)}


def test_baseline_of_zero_gives_no_ratio(spark, events):
    flat = damage.mean_by_type(events).withColumn("avg_deaths_direct", F.lit(0.0))
    ratios = damage.relative_to_baseline(flat).where("measure = 'avg_deaths_direct'").collect()
    assert [r.ratio for r in ratios] == [None, None]


def test_bare_suffix_is_left_out_of_its_own_mean_only(spark):
    data = [("Flood", "K", "2K", 1, 0, 0, 0), ("Flood", "3K", "M", 3, 0, 0, 0)]
    df = spark.createDataFrame(
        data, "EVENT_TYPE string, " + "DAMAGE_PROPERTY string, DAMAGE_CROPS string, "
        + ", ".join(f"{c} int" for c in HARM_COLUMNS),
    )
    means = damage.mean_by_type(df).head()
    assert (means.avg_damage_property, means.avg_damage_crops, means.avg_injuries_direct) == (
        3000.0, 2000.0, 2.0,
    )


def test_ties_break_by_key(spark):
    df = spark.createDataFrame([(k, 1) for k in "dbca"], "k string, n int")
    for parts in (1, 4):
        top = top_k(df.repartition(parts), "n", ["k"], 2).collect()
        assert [r.k for r in top] == ["a", "b"]


def count_places(local):
    return Counter((r.STATE, r.CZ_NAME) for r in local if r.STATE and r.CZ_NAME)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_location_count_by_either_join(spark, events, local, threshold):
    """Broadcast and shuffled joins agree, and a NULL place counts 1."""
    expected = count_places(local)
    settings = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    )
    before = spark.conf.get(settings[0])
    for setting in settings:
        spark.conf.set(setting, threshold)
    try:
        counted = location.with_location_count(events)
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan) == (threshold == "-1")
        for row in counted.collect():
            assert row.EVENT_COUNT_PER_CZ == expected.get((row.STATE, row.CZ_NAME), 1)
    finally:
        spark.conf.set(settings[0], before)
        spark.conf.unset(settings[1])


def test_counts_may_come_from_the_training_rows(events, local):
    train = events.where("EVENT_ID % 2 = 0")
    expected = count_places([r for r in local if r.EVENT_ID % 2 == 0])
    counted = features.build_features(events, counts=location.location_counts(train))
    place = {r.EVENT_ID: (r.STATE, r.CZ_NAME) for r in local}
    for row in counted.collect():
        assert row.EVENT_COUNT_PER_CZ == expected.get(place[row.EVENT_ID], 1)


def test_one_place_with_most_rows(spark):
    """A place holding most events is spread over the tasks of a shuffled join."""
    events = spark.range(200_000).select(
        F.col("id").alias("EVENT_ID"),
        F.when(F.col("id") % 3 < 2, "HOT")
        .otherwise(F.concat(F.lit("S"), F.col("id") % 500))
        .alias("STATE"),
        F.lit("C").alias("CZ_NAME"),
        F.repeat(F.lit("x"), 50).alias("payload"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        counted = location.with_location_count(events)
        hot = counted.where("STATE = 'HOT'").select("EVENT_COUNT_PER_CZ").distinct().collect()
        assert [r[0] for r in hot] == [sum(1 for i in range(200_000) if i % 3 < 2)]
        counted.select("EVENT_ID", "EVENT_COUNT_PER_CZ", "payload").write.format("noop").mode(
            "overwrite"
        ).save()
        result = counted.select("EVENT_ID", "EVENT_COUNT_PER_CZ", "payload")
        result.collect()
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "skewed" in plan.lower()
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_density_falls_back_to_the_event_count(spark, events, local):
    expected = count_places(local)
    some = sorted(expected)[:3]
    density = spark.createDataFrame(
        [(s, c, 1000.5) for s, c in some], "STATE string, CZ_NAME string, density double"
    )
    for row in location.with_density(events, density, "density").collect():
        place = (row.STATE, row.CZ_NAME)
        assert row.density == (1000.5 if place in some else expected.get(place, 1))


def test_filters(events, local):
    assert rows.exclude_years(events, 2001, 2000).count() == sum(
        r.YEAR not in (2000, 2001) for r in local
    )
    kept = rows.drop_suffix_only(events, "DAMAGE_CROPS").count()
    assert kept == sum(r.DAMAGE_CROPS not in ("K", "M", "B") for r in local)
    assert rows.require_complete(events, ["STATE", "TOR_F_SCALE"]).count() == sum(
        bool(r.STATE and r.TOR_F_SCALE) for r in local
    )


def test_frequency_of_complete_pairs(events, local):
    expected = Counter((r.STATE, r.EVENT_TYPE) for r in local if r.STATE and r.EVENT_TYPE)
    counted = frequency.state_event_frequency(events).collect()
    got = {(r.STATE, r.EVENT_TYPE): r.event_count for r in counted}
    assert got == dict(expected)


def test_splits_do_not_depend_on_partitioning(events):
    def members(df):
        return [sorted(r.EVENT_ID for r in part.collect()) for part in features.split3(df)]

    first = members(events.repartition(1))
    assert first == members(events.repartition(7)) == members(events.orderBy(F.desc("EVENT_ID")))
    assert sorted(sum(first, [])) == sorted(r.EVENT_ID for r in events.select("EVENT_ID").collect())
    share = [len(p) / events.count() for p in first]
    assert share == pytest.approx([0.7, 0.15, 0.15], abs=0.03)
    assert members(events.repartition(2)) != [
        sorted(r.EVENT_ID for r in p.collect()) for p in features.split3(events, seed=7)
    ]


def test_bands_cover_all_magnitudes(events):
    per_band = defaultdict(int)
    for row in trend.band_counts(events).collect():
        per_band[row.YEAR] += row.event_count
    valid = trend.yearly_magnitudes(events).groupBy("YEAR").count().collect()
    assert dict(per_band) == {r[0]: r[1] for r in valid}
