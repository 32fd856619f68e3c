import csv
import gzip
import html
from html.entities import html5
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.storm_view import storm, table
from tempestry.schema import HARM_COLUMNS
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
    write_by_year,
    write_csv,
)
from tempestry.sources.links import decode_references
from tests.oracle import rows_of

SF_DIR = "/root/testdata/sf0.001"


def as_rows(df, columns=None):
    columns = columns or df.columns
    return rows_of(list(columns), [tuple(r) for r in df.select(*columns).collect()])


def test_quoted_multiline_records_survive(spark, tmp_path):
    documents = table(spark, SF_DIR, "documents")
    write_csv(documents, str(tmp_path / "d"))
    again = read_events_csv(spark, str(tmp_path / "d"), documents.schema)
    assert again.schema == documents.schema
    assert as_rows(again) == as_rows(documents)


def test_header_names_decide_not_positions(spark, tmp_path):
    base, shifted = tmp_path / "base.csv", tmp_path / "shifted.csv"
    base.write_text('STATE,YEAR,MAGNITUDE\n"TEXAS, S",2020,1.5\n')
    shifted.write_text(',Unnamed: 0,MAGNITUDE,STATE,YEAR\n0,0,1.5,"TEXAS, S",2020\n')
    for path in (base, shifted):
        df = read_events_csv(spark, str(path))
        assert df.select("STATE", "YEAR", "MAGNITUDE").head() == ("TEXAS, S", 2020, 1.5)
        assert len(df.columns) == 3


def test_bad_values_become_null_not_errors(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("EVENT_ID,YEAR,MAGNITUDE,EXTRA\n1,2020.0,x,a\ny,,3,b\n")
    rows = read_events_csv(spark, str(path)).orderBy("EXTRA").collect()
    assert [tuple(r) for r in rows] == [(1, 2020, None, "a"), (None, None, 3.0, "b")]


def test_yearly_gzip_files_with_differing_headers_stack(spark, tmp_path):
    texts = {
        "a": "STATE,YEAR\nTEXAS,1999\n",
        "b": "YEAR,STATE,NOTE\n2000,OHIO,new\n",
        "c": "STATE,YEAR\nIOWA,2001\n",
    }
    for name, text in texts.items():
        with gzip.open(tmp_path / f"{name}.csv.gz", "wt") as file:
            file.write(text)
    stacked = read_many(spark, [str(tmp_path / f"{n}.csv.gz") for n in texts])
    assert {tuple(r) for r in stacked.select("STATE", "YEAR", "NOTE").collect()} == {
        ("TEXAS", 1999, None),
        ("OHIO", 2000, "new"),
        ("IOWA", 2001, None),
    }
    plan = stacked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 2


LINES = [
    '1,"a, b",x', "3,d", "zz,e,y", '1,"un,x', "1,a,b,c,d", '1,"a ""q"" b",', ",,", 'a"b,c"d,e',
    '"x","y","z"', '"","",""', '"a""","b",c', "one", '"a,b","c,d"', '1,"""",2',
]


def test_field_count_agrees_with_a_csv_reader(spark):
    texts = [r[0] for r in table(spark, SF_DIR, "documents").select("text").collect()]
    lines = LINES + [
        line for text in texts for line in text.split("\n") if "\r" not in line and "\0" not in line
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    parsed = parse_csv_lines(df, ["a", "b", "c"]).collect()
    for row in parsed:
        fields = next(csv.reader([row.value]), [])
        assert row.field_count == len(fields), row.value


def test_fields_agree_with_a_csv_reader(spark):
    df = spark.createDataFrame([(v,) for v in LINES], "value string")
    for row in parse_csv_lines(df, ["a", "b", "c"]).collect():
        fields = (next(csv.reader([row.value])) + [None] * 3)[:3]
        assert [row.a, row.b, row.c] == [f or None for f in fields], row.value


def test_split_keeps_every_record_once(spark):
    header = "id,p," + ",".join(HARM_COLUMNS)
    lines = [header, "1,x,1,0,,0", "2,y,zz,0,0,0", "3,w", "", '4,"a,b",2.0,0,0,0,more', "5,v,nan,0,0,0"]
    df = spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1)
    records = parse_csv_lines(strip_header(df), header.split(","))
    valid, rejects = split_valid_rejects(records, min_fields=6)
    assert sorted(r.id for r in valid.collect()) == ["1", "4"]
    assert sorted(r.value for r in rejects.collect()) == ["", "2,y,zz,0,0,0", "3,w", "5,v,nan,0,0,0"]


def test_lines_are_parsed_once(spark):
    df = spark.createDataFrame([("1,2,3,4,5,6",)], "value string")
    records = parse_csv_lines(df, ["id", "p", *HARM_COLUMNS])
    plan = split_valid_rejects(records, 6)[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv") == 1


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href") is not None:
            self.found.append(dict(attrs)["href"])


def test_links_agree_with_an_html_parser(spark):
    pages = table(spark, SF_DIR, "pages").select("page_id", "html")
    awkward = spark.createDataFrame(
        [
            (-1, "<A class=x HREF='/a?b=1&amp;c=2'>t</A><a href=/plain>x</a>"),
            (-2, '<!-- <a href="/no">x</a> --><script>"<a href=\'/no\'>"</script><a href="">'),
            (-3, '<abbr href="/no"><a data-href="/no"><a\n  id="i"\n  href = "/yes&quot;">'),
        ],
        pages.schema,
    )
    everything = pages.unionByName(awkward)
    expected = []
    for row in everything.collect():
        parser = _Anchors()
        parser.feed(row.html)
        expected += [(row.page_id, "base:" + link) for link in parser.found]
    links = extract_links(everything, base="base:", keep=["page_id"])
    assert sorted(tuple(r) for r in links.collect()) == sorted(expected)
    part = extract_links(everything, contains="/th", base="base:")
    assert sorted(r.link for r in part.collect()) == sorted(e[1] for e in expected if "/th" in e[1])


def test_one_file_needs_a_bound(spark, tmp_path):
    df = spark.range(10)
    with pytest.raises(ValueError):
        write_csv(df, str(tmp_path / "x"), single=True)
    write_csv(df, str(tmp_path / "x"), single=True, limit=3, order_by=["id"])
    files = list((tmp_path / "x").glob("*.csv"))
    assert [f.read_text() for f in files] == ["id\n0\n1\n2\n"]


def test_year_partitions_prune(spark, tmp_path):
    events = storm(spark, SF_DIR)
    write_by_year(events, str(tmp_path / "by_year"))
    back = spark.read.parquet(str(tmp_path / "by_year"))
    assert as_rows(back, events.columns) == as_rows(events)
    plan = back.where("YEAR <> 2001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR" in plan


def test_inspection(spark, tmp_path):
    events = storm(spark, SF_DIR).cache()
    overview = dataset_overview(events.repartition(4)).head()
    assert overview.row_count == events.count()
    assert overview.column_names == events.columns
    assert overview.partition_count == 4
    nulls = {r.column_name: r.null_count for r in null_profile(events).collect()}
    assert nulls == {
        c: n
        for c in events.columns
        if (n := events.where(F.col(c).isNull()).count())
    }
    assert [r.EVENT_ID for r in sample_events(events, 5).collect()] == [0, 1, 2, 3, 4]
    assert as_rows(cache_clean(events, str(tmp_path / "clean"))) == as_rows(events)
    assert cache_clean(spark.range(3)).count() == 3
    events.unpersist()


def test_overview_of_no_rows(spark):
    empty = dataset_overview(spark.range(0)).head()
    assert (empty.row_count, empty.column_count) == (0, 1)


def test_ragged_lines_are_written_by_several_tasks(spark, monkeypatch):
    events = queries.storm(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(queries, "storm", lambda *_: events.repartition(5))
    got = queries.csv_file_rejects(spark, None)
    assert len(got.inputFiles()) == 5
    rows = {r.EVENT_ID: (r.ragged, r.PLACE) for r in got.collect()}
    assert len(rows) == events.count() == got.count()
    assert all(r == (i % 5 in (1, 2), None if i % 5 == 1 else "x, y") for i, r in rows.items())


def test_named_references_as_the_standard_library_has_them(spark):
    names = [f"a&{n}b" for n in html5 if n.endswith(";")]
    odd = ["&unknownname;&lt;", "&amp;lt;&amp;amp;", "&amp;#38;", "?a=1&copy=2&reg;", "&;&#;&&eacute;", "&Eacute&eacute;", None, "", "x & y;"]
    df = spark.createDataFrame([(t,) for t in names + odd], "t string")
    got = [r[0] for r in df.select(decode_references(F.col("t"))).collect()]
    assert got[: len(names)] == [html.unescape(t) for t in names]
    assert got[len(names) :] == ["&unknownname;<", "&lt;&amp;", "&#38;", "?a=1&copy=2®", "&;&#;&é", "&Eacuteé", None, "", "x & y;"]


def test_the_names_are_one_literal(spark):
    plan = spark.range(3).select(decode_references(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan
