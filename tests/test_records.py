import gzip
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from checks.ingest import block_size
from checks.storm_view import table
from tempestry.session import Scratch
from tempestry.sources import read_events_csv, records, write_csv
from tempestry.sources.records import cut_records, ends_inside, files_by_header, text_lines, whole_records
from tests.oracle import rows_of

SF_DIR = "/root/testdata/sf0.001"


def as_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def slow_ends_inside(line, inside):
    """Letter by letter: a quote at the start of a field opens, one that is not doubled closes."""
    state, i = "in" if inside else "start", 0
    while i < len(line):
        c = line[i : i + 1]
        if state == "in":
            if c == b'"' and line[i + 1 : i + 2] == b'"':
                i += 1
            elif c == b'"':
                state = "rest"
        elif c == b",":
            state = "start"
        elif state == "start":
            state = "in" if c == b'"' else "rest"
        i += 1
    return state == "in"


def test_open_quotes_of_any_line():
    r = random.Random(1)
    for _ in range(20_000):
        line = "".join(r.choice('"",ab') for _ in range(r.randint(0, 14))).encode()
        for inside in (False, True):
            assert ends_inside(line, inside) == slow_ends_inside(line, inside), (line, inside)
    assert ends_inside(b'"' + b'""' * 10**6 + b",", False) and not ends_inside(b'a,"b",' * 10**5, False)


def slow_records(text, inside):
    """Line by line: whole records, and what is left of one whose quotes stay open."""
    records, waiting, state = [], [], inside
    for line in text.split(b"\n"):
        state = slow_ends_inside(line, state)
        waiting.append(line)
        if not state:
            records.append(b"\n".join(waiting))
            waiting = []
    return records, b"\n".join(waiting) if waiting else None


def test_records_of_any_lines():
    r = random.Random(2)
    for _ in range(20_000):
        text = "".join(r.choice('"",,ab\n\n\r') for _ in range(r.randint(0, 24))).encode()
        for inside in (False, True):
            found, left = whole_records(text, inside)
            whole, open_one = slow_records(text, inside)
            assert not inside or found[:1] == whole[:1], (text, inside)
            assert [x for x in found if x] == [x for x in whole if x] and left == open_one, (text, inside)
            assert ends_inside(text, inside) == (open_one is not None), (text, inside)
    assert whole_records(b'a,"' + b"b\n" * 10**6, False)[1] == b'a,"' + b"b\n" * 10**6
    assert len([x for x in whole_records(b'1,"a\n""b"""\n' * 10**5, False)[0] if x]) == 10**5


def test_lines_of_a_block_are_looked_at_together(monkeypatch):
    """As many looks as lines until both states of a block agree, then one for all that follow."""
    line = [b'1,"a', b'""b""",c'] * 5_000
    batches = [
        pa.record_batch({"file": ["f", "f"] + ["g"] * 9_998, "start": [0, 0] + [at] * 9_998, "line": pa.array(line, pa.binary())})
        for at in (0, 0, 70)
    ]
    looks = []
    monkeypatch.setattr(records, "ends_inside", lambda text, inside: looks.append(text) or ends_inside(text, inside))
    ends = [tuple(row.values()) for batch in records._block_ends(iter(batches)) for row in batch.to_pylist()]
    assert ends == [("f", 0, False, False), ("g", 0, False, False)] * 2 + [("f", 0, False, False), ("g", 70, False, False)]
    assert len(looks) < 100


FILES = {
    "lf.csv": 'id,"t\nx",n\n1,"a\nb ""q"" c",\n\n\n2, "x",y\n3,"abc"def,z\n4,ab"c,"d\n\n"\n5,,""\n6,"one\r\ntwo",7\r\n',
    "crlf.csv": 'id,t,n\r\n1,"a\r\nb","x\ny"\r\n\r\n2,b,c\r\n3,"","z"\r\n4,"last\r\n"",",5',
    "quoted.csv": "id,t,n\n" + "".join(f'"{i}","{"text, " * (i % 7)}""{i}""\nnext","{i * i}"\n' for i in range(300)),
    "long.csv": 'id,t,n\n1,"' + "many lines,\n" * 900 + '",2\n3,"short",4\n5,"' + 'say ""no""\n' * 700 + '",6\n7,8,9\n',
}


@pytest.mark.parametrize("name", FILES)
def test_blocks_give_what_one_task_reads(spark, tmp_path, name):
    path = str(tmp_path / name)
    (tmp_path / name).write_bytes(FILES[name].encode())
    whole = read_events_csv(spark, path, schema=None)
    for size in (max(7, len(FILES[name]) // 25), 1 << 20):
        with block_size(spark, size):
            blocks = read_events_csv(spark, path, schema=None, split=True)
            assert blocks.columns == whole.columns
            assert as_rows(blocks) == as_rows(whole), size


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    documents = table(spark, SF_DIR, "documents")
    write_csv(documents, str(tmp_path / "d"))
    with block_size(spark, 10_000):
        tasks = text_lines(spark, str(tmp_path / "d"))._jdf.queryExecution().toRdd().getNumPartitions()
        assert tasks > 20
        scratch = Scratch(spark)
        assert cut_records(spark, str(tmp_path / "d"), scratch).count() == documents.count() + 1
        ends = spark.read.parquet(scratch.path("ends"))
        assert ends.count() > 20 and ends.select("start").distinct().count() > 20
        again = read_events_csv(spark, str(tmp_path / "d"), documents.schema, split=True)
        assert again.schema == documents.schema and as_rows(again) == as_rows(documents)


def test_a_task_reads_many_small_blocks(spark, tmp_path):
    documents = table(spark, SF_DIR, "documents")
    write_csv(documents, str(tmp_path / "d"))
    scratch = Scratch(spark)
    with block_size(spark, 1_000):
        records = cut_records(spark, str(tmp_path / "d"), scratch)
        assert records.count() == documents.count() + 1
    for name, blocks in (("ends", 200), ("pieces", 200)):
        written = spark.read.parquet(scratch.path(name)).withColumn("task", F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1))
        assert written.select("file", "start").distinct().count() > blocks
        assert written.select("task").distinct().count() <= spark.sparkContext.defaultParallelism


def test_a_task_reads_blocks_of_many_files(spark, tmp_path):
    for i in range(40):
        text = "".join(f'{j},"a\nb {i}"\n' for j in range(30))
        (tmp_path / f"{i:02}.csv").write_text(("EVENT_ID,NOTE\n" if i % 2 else "EVENT_ID,OTHER\n") + text)
    scratch = Scratch(spark)
    with block_size(spark, 100):
        assert cut_records(spark, str(tmp_path), scratch).where("first").count() == 40
        pieces = spark.read.parquet(scratch.path("pieces"))
        task = F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1)
        assert pieces.select(task).distinct().count() <= spark.sparkContext.defaultParallelism
        rows = read_events_csv(spark, str(tmp_path), split=True).select("EVENT_ID", "NOTE", "OTHER").collect()
    found = sorted((r.EVENT_ID, r.NOTE or r.OTHER, r.NOTE is None) for r in rows)
    assert found == sorted((j, f"a\nb {i}", i % 2 == 0) for i in range(40) for j in range(30))


def test_rejects_and_gzip_by_blocks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('EVENT_ID,STATE\n1,"x\ny"\n2\n3,a,b\n')
    with gzip.open(tmp_path / "b.csv.gz", "wt") as file:
        file.write('STATE,EVENT_ID\n"p\nq",4\n')
    (tmp_path / "empty.csv").write_text("")
    for split in (True, False):
        read = read_events_csv(spark, str(tmp_path), reject_column="raw", split=split)
        rows = {(r.EVENT_ID, r.STATE, r.raw) for r in read.collect()}
        assert rows == {(1, "x\ny", None), (2, None, "2"), (3, "a", "3,a,b"), (4, "p\nq", None)}
    with pytest.raises(ValueError):
        read_events_csv(spark, str(tmp_path), split=True, infer_types=True)


def test_headers_differ_behind_a_line_break(spark, tmp_path):
    (tmp_path / "a.csv").write_text('EVENT_ID,"A\nB",STATE,CZ_NAME\n1,x,UT,C1\n')
    (tmp_path / "b.csv").write_text('EVENT_ID,"A\nB",CZ_NAME,STATE\n2,y,C2,UT\n')
    for split in (True, False):
        rows = read_events_csv(spark, str(tmp_path), split=split).select("EVENT_ID", "STATE", "CZ_NAME").collect()
        assert sorted(map(tuple, rows)) == [(1, "UT", "C1"), (2, "UT", "C2")]


def test_folders_that_name_columns(spark, tmp_path):
    for year, place, text in ((2020, "a b+c%20d", "S,T\n1,2\n"), (2021, "__HIVE_DEFAULT_PARTITION__", "T,S,year\n3,4,1999\n")):
        folder = tmp_path / f"year={year}" / f"place={place}"
        folder.mkdir(parents=True)
        (folder / "f 1.csv").write_text(text)
    for split in (True, False):
        rows = read_events_csv(spark, str(tmp_path), schema=None, split=split).select("S", "T", F.col("year").cast("int"), "place").collect()
        assert sorted(map(tuple, rows)) == [("1", "2", 2020, "a b+c d"), ("4", "3", 1999, None)]


def test_folder_columns_are_found_once_per_file(spark, tmp_path):
    for year in (2020, 2021):
        (tmp_path / f"year={year}").mkdir()
        (tmp_path / f"year={year}" / "f.csv").write_text("S,T\n1,2\n3,4\n" if year % 2 else "S\n1\n3\n")
    read = read_events_csv(spark, str(tmp_path), schema=None, split=True)
    assert dict(read.dtypes)["year"] == "int"
    assert sorted(map(tuple, read.select("S", "year").collect())) == [("1", 2020), ("1", 2021), ("3", 2020), ("3", 2021)]
    assert "url" not in read._jdf.queryExecution().optimizedPlan().toString().lower()


def test_many_small_files_are_grouped_by_a_job(spark, tmp_path):
    names = []
    for i in range(400):
        (tmp_path / f"{i:03}.csv").write_text("a,b\n1,2\n" if i % 3 else 'b,"a\nc"\n2,1\n' + "x\n" * 1000)
        names.append(f"file:{tmp_path}/{i:03}.csv")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    groups = files_by_header(spark, names)
    assert {h: len(f) for h, f in groups.items()} == {"a,b": 266, 'b,"a\nc"': 134}
    assert sorted(f for group in groups.values() for f in group) == names
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_query_reads_by_blocks(spark):
    assert QUERIES["csv_blocks"](spark, SF_DIR).count() == table(spark, SF_DIR, "documents").count()
