"""Inputs that the event view does not have: mixed files, NaN, large counts, text."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.storm_view import storm
from tempestry.functions import severe_by_impact
from tempestry.operators import damage, evaluation, features, forest, location, rows, trend
from tempestry.operators.harm import harm_by_state
from tempestry.operators.ranking import with_next_row, with_running_total
from tempestry.plans import report, rollup
from tempestry.session import Scratch
from tempestry.sources import (
    extract_links,
    mark_valid,
    parse_csv_lines,
    read_events_csv,
    strip_header,
    write_csv,
)

SF_DIR = "/root/testdata/sf0.001"


def test_files_of_one_folder_keep_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("EVENT_ID,STATE,YEAR\n1,TEXAS,2020\n")
    (tmp_path / "b.csv").write_text("EVENT_ID,YEAR,STATE,NOTE\n2,2021,IOWA,n\n")
    (tmp_path / "c.csv").write_text("")
    for path in (str(tmp_path), str(tmp_path / "*.csv")):
        df = read_events_csv(spark, path)
        got = sorted(tuple(r) for r in df.select("EVENT_ID", "STATE", "YEAR", "NOTE").collect())
        assert got == [(1, "TEXAS", 2020, None), (2, "IOWA", 2021, "n")]


def test_ragged_records_of_a_file_are_told_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('EVENT_ID,STATE\n1,"TEXAS, S"\n2\n3,IOWA,more\n4,"two\nlines"\n')
    got = {r.EVENT_ID: r.raw for r in read_events_csv(spark, str(tmp_path), reject_column="raw").collect()}
    assert got[1] is None and got[4] is None
    assert got[2] == "2" and got[3] == "3,IOWA,more"


def test_one_line_records_of_a_large_file_are_split(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("EVENT_ID,STATE\n" + "".join(f"{i},STATE {i}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        split = read_events_csv(spark, str(path), multi_line=False)
        assert split.rdd.getNumPartitions() > 4
        assert split.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_counts_beyond_32_bits(spark):
    columns = ("INJURIES_DIRECT", "INJURIES_INDIRECT", "DEATHS_DIRECT", "DEATHS_INDIRECT")
    text = spark.createDataFrame([("TEXAS", "3e9", "", "", "1")], ["STATE", *columns])
    double = spark.createDataFrame([("TEXAS", 3e9, 0.0, 0.0, 1.0)], ["STATE", *columns])
    for df in (text, double):
        assert harm_by_state(df).head().total_harm == 3_000_000_001
    assert mark_valid(text).head().valid


def test_nan_and_infinite_damage(spark):
    columns = ["EVENT_TYPE", "DAMAGE_PROPERTY", "DAMAGE_CROPS", "INJURIES_DIRECT", "INJURIES_INDIRECT", "DEATHS_DIRECT", "DEATHS_INDIRECT"]
    values = [("nan", False), ("nanK", False), ("inf", True), ("50.01K", True), ("abc", False)]
    df = spark.createDataFrame([("Flood", v, "1K", "0", "0", "0", "0") for v, _ in values], columns)
    got = {r.DAMAGE_PROPERTY: r.s for r in df.select("*", severe_by_impact(df).alias("s")).collect()}
    assert got == dict(values)
    finite = df.where("DAMAGE_PROPERTY <> 'inf'")
    assert damage.mean_by_type(finite).head().avg_damage_property == 50010.0


def test_filling_follows_the_declared_type(spark):
    df = spark.createDataFrame([("abc",), ("nan",), (None,), ("2.5",), ("",)], "MAGNITUDE string")
    assert sorted(r[0] for r in rows.fill_missing(df, {"MAGNITUDE": 0.0}).collect()) == [0, 0, 0, 0, 2.5]
    assert sorted(r[0] for r in rows.fill_missing(df, {"MAGNITUDE": 7}).collect()) == [2, 7, 7, 7, 7]
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "MAGNITUDE double")
    assert sorted(r[0] for r in rows.fill_missing(nan, {"MAGNITUDE": 0.0}).collect()) == [0, 1]


def test_excluded_years_leave_rows_without_a_year(spark):
    df = spark.createDataFrame([(2020,), (2021,), (None,)], "YEAR int")
    assert {r.YEAR for r in rows.exclude_years(df, 2021).collect()} == {2020, None}


def test_years_of_any_size_and_both_ways_to_rank(spark):
    data = [(y, m) for y, m in zip((1, 2, 3, 40_000, 50_000), (5.0, 1.0, 2.0, 4.0, 3.0))]
    df = spark.createDataFrame(data, "YEAR int, MAGNITUDE double")
    assert trend.spearman_trend(df).head()[0] == pytest.approx(-0.1)
    events = storm(spark, SF_DIR)
    direct = trend.spearman_trend(events).head()[0]
    reported = report.reports(rollup.event_rollup(events))["spearman_trend"].head()[0]
    assert direct == pytest.approx(reported)


def test_running_totals_and_next_rows(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id").alias("v"))
    got = sorted((r.k, r.v, r.before) for r in with_running_total(df, ["k"], "v").collect())
    total = 0
    for _, v, before in got:
        assert before == total
        total += v
    nxt = {r.k: r.donor.k for r in with_next_row(df, ["k"], ["k"]).collect()}
    assert nxt == {k: (k + 1) % 1000 for k in range(1000)}
    empty = df.limit(0)
    assert with_running_total(empty, ["k"]).count() == with_next_row(empty, ["k"], ["v"]).count() == 0


def test_grouped_areas_agree_with_single_ones(spark):
    df = spark.range(600).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 31 % 17).cast("double").alias("score"), (F.col("id") % 5 == 0).cast("int").alias("has_harm")
    )
    got = {r.g: r.auc for r in evaluation.grouped_area_under_roc(df, "g").collect()}
    for g in range(3):
        assert got[g] == pytest.approx(evaluation.area_under_roc(df.where(f"g = {g}"), score="score"))
    one = df.withColumn("has_harm", F.lit(1))
    assert evaluation.grouped_area_under_roc(one, "g").where("auc IS NOT NULL").count() == 0


def test_places_that_stand_twice_do_not_multiply_events(spark):
    events = spark.createDataFrame([(1, "TEXAS", "A"), (2, "IOWA", None)], "EVENT_ID long, STATE string, CZ_NAME string")
    density = spark.createDataFrame([("TEXAS", "A", 2.0), ("TEXAS", "A", 4.0)], "STATE string, CZ_NAME string, people double")
    got = {r.EVENT_ID: r.people for r in location.with_density(events, density, "people").collect()}
    assert got == {1: 3.0, 2: 1.0}


def test_no_header_of_no_lines(spark):
    assert strip_header(spark.createDataFrame([], "value string")).count() == 0


def test_ragged_lines_are_counted(spark):
    lines = ["a,b", "a", "", '"x, y",b', "a,b,c", '"x, ""y""",b,"c,d"']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r.value: (r.field_count, r.p) for r in parse_csv_lines(df, ["p", "q"]).collect()}
    assert {v: n for v, (n, _) in got.items()} == {"a,b": 2, "a": 1, "": 0, '"x, y",b': 2, "a,b,c": 3, '"x, ""y""",b,"c,d"': 3}
    assert got['"x, ""y""",b,"c,d"'][1] == 'x, "y"'


def test_links_with_references(spark):
    html = """<a href="/a?x=1&amp;y=2&#47;&#x41;&apos;">1</a><a href='/b&#0;&#xD800;&lt;&nope;'>2</a>
      <a href="/c&amp;lt;">3</a><!-- open <a href="/never">4</a>"""
    pages = spark.createDataFrame([(html,)], "html string")
    assert [r.link for r in extract_links(pages).collect()] == ["/a?x=1&y=2/A'", "/b&#0;&#xD800;<&nope;", "/c&lt;"]


def test_a_limited_file_needs_an_order(spark, tmp_path):
    with pytest.raises(ValueError, match="order_by"):
        write_csv(spark.range(3), str(tmp_path / "x"), limit=2)


def test_scratch_tables_are_deleted(spark):
    with Scratch(spark) as scratch:
        table = scratch.save(spark.range(5), "five")
        folder = Path(scratch.root.removeprefix("file:"))
        assert table.count() == 5 and (folder / "five").exists()
        scratch.drop("five")
        assert not (folder / "five").exists()
    assert not folder.exists()


def test_unread_place_counts_are_not_computed(spark):
    built = features.build_features(storm(spark, SF_DIR), place_counts=False)
    assert "EVENT_COUNT_PER_CZ" not in built.columns
    plan = built._jdf.queryExecution().optimizedPlan().toString()
    assert "tempestry-" not in plan


def test_forest_partitions_are_a_parameter():
    import inspect

    assert inspect.signature(forest.train_harm_model).parameters["partitions"].default == 200
