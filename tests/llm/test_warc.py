import base64
import gzip
import hashlib
import random
from collections import Counter

import pytest

from tempestry.llm import warc
from tempestry.llm.common import ship
from tempestry.llm.queries import QUERIES, SQL
from tests.llm.cases import SF, prose
from tests.oracle import compare, connect

SCHEMA = "page_id long, url string, html string, key string, type string, row_id long, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", "t", 7, "p") for r in rows], SCHEMA)


def slow(rows, least=1000):
    """Rows of one id and payload: one response, the rest revisit it."""
    firsts, out = {}, Counter()
    for key, _, html in rows:
        firsts.setdefault((html or "").encode(), []).append((key is not None, key or 0))
    for body, keys in firsts.items():
        keys = [k if known else None for known, k in sorted(keys, reverse=True)]
        for i, key in enumerate(keys):
            again = len(body) >= least and i > 0
            out[(key, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", keys[0] if again else None)] += 1
    return out


def as_set(df):
    return Counter(map(tuple, df.collect()))


def test_sql(spark):
    assert compare(QUERIES["op12_warc_segments"](spark, SF), connect(SF), SQL["op12_warc_segments"]) > 0


LOOKALIKE = "before\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nbody\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n after"


def awkward_rows():
    r = random.Random(1)
    wild = "".join(r.choice(["é", "\U0001f600", "\r\n", "\0", "<p>", "WARC/", "\r\n\r\n", "0\r\n\r\n"]) for _ in range(9000))
    same = prose(3, 400)
    rows = [(None, None, None), (1, None, ""), (2, "http://x/ y\r\nWARC-Type: evil\r\n", "short"), (3, "", wild), (4, "u", wild),
            (5, "http://é", prose(9, 60_000)), (6, "u", "short"), (7, "u", LOOKALIKE), (-8, "u", "x" * 999), (9, "u", "x" * 999),
            (10, "u", "é" * 500), (11, "u", "é" * 500), (None, "u", "é" * 500)]
    return rows + [(20 + i // 3, "u", same) for i in range(30)] + [(r.randint(100, 10**12), "u", prose(i, r.randint(0, 900))) for i in range(60)]


def test_awkward_pages_round_trip(spark, tmp_path):
    ship(spark)
    rows = awkward_rows()
    table = pages(spark, rows).repartition(3)
    found = warc.archive_pages(table)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert as_set(found) == slow(rows)
    path = str(tmp_path / "archives")  # small segments that part characters, over many archives
    warc.write_archives(table, path, "page_id", "url", "html", 10**9, 7, 300, compression="none", records_per_file=40)
    assert len(list((tmp_path / "archives").glob("part-*"))) > 10
    read = warc.read_archives(spark, path).where("type <> 'warcinfo'").collect()
    assert Counter((r.row_id, r.payload.decode()) for r in read) == Counter((k if k is None else str(k), h or "") for k, _, h in rows)
    assert not any(r.problem for r in read)


def test_no_pages(spark):
    ship(spark)
    assert warc.archive_pages(pages(spark, []).limit(0)).count() == 0


def record(kind, block, **fields):
    lines = {"WARC-Type": kind, **{k.replace("_", "-"): v for k, v in fields.items()}, "Content-Length": len(block)}
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\ntransfer-ENCODING:\r\n  Chunked\r\n\r\n"


def test_archives_of_other_writers(spark, tmp_path):
    """Segments out of order and over files, one gzip member per record, damaged records."""
    ship(spark)
    body = b"0005;name=value\r\nhello\r\nA\r\n, the rest\r\n000\r\nTrailer: x\r\n\r\n"
    whole = HTTP + body
    inner = record("resource", b"a record inside\r\n\r\nWARC/1.0\r\nof another", WARC_Record_ID="<inner>")
    cut = [record("response", whole[:30], WARC_Record_ID="<seg>", WARC_Segment_Number=1)]
    more = {"WARC_Segment_Origin_ID": "<seg>"}
    cut.append(record("continuation", whole[30:60], WARC_Record_ID="<b>", WARC_Segment_Number=2, **more))
    cut.append(record("continuation", whole[60:], WARC_Record_ID="<c>", WARC_Segment_Number=3, WARC_Segment_Total_Length=len(whole), **more))
    wrong = [record("response", b"HTTP/1.1 200 OK\r\n\r\nab", WARC_Record_ID="<wrong>", WARC_Segment_Number=1)]
    wrong.append(record("continuation", b"cd", WARC_Segment_Origin_ID="<wrong>", WARC_Segment_Number=2, WARC_Segment_Total_Length=9))
    gap = [record("response", b"ab", WARC_Record_ID="<gap>", WARC_Segment_Number=1)]
    gap.append(record("continuation", b"ef", WARC_Segment_Origin_ID="<gap>", WARC_Segment_Number=3, WARC_Segment_Total_Length=6))
    orphan = record("continuation", b"zz", WARC_Segment_Origin_ID="<nobody>", WARC_Segment_Number=2, WARC_Segment_Total_Length=4)
    sha1 = base64.b32encode(hashlib.sha1(b"fine").digest()).decode()
    first = [cut[2], record("resource", inner, WARC_Record_ID="<outer>"), record("request", b"GET / HTTP/1.1\r\n\r\n", WARC_Record_ID="<get>"), cut[0]]
    second = [wrong[1], gap[1], record("resource", b"fine", WARC_Record_ID="<fine>", WARC_Payload_Digest=f"sha1:{sha1}"), cut[1], gap[0], orphan]
    second += [record("resource", b"FINE", WARC_Record_ID="<digest>", WARC_Payload_Digest=f"sha1:{sha1}"), wrong[0]]
    second += [record("response", HTTP + b"5\r\nhel", WARC_Record_ID="<chunk>"), record("resource", b"", WARC_Record_ID="<empty>")]
    torn = record("resource", b"torn off", WARC_Record_ID="<torn>")[:-9]
    (tmp_path / "a.warc").write_bytes(b"".join(first))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, second)))
    (tmp_path / "c.warc").write_bytes(record("resource", b"last", WARC_Record_ID="<last>") + torn)
    (tmp_path / "d.warc").write_bytes(b"")
    read = warc.read_archives(spark, str(tmp_path)).collect()
    got = {r.record_id: (r.payload, r.problem) for r in read}
    assert len(read) == 13 - 1 and got == {
        "<seg>": (b"hello, the rest", None), "<outer>": (inner, None), "<get>": (b"GET / HTTP/1.1\r\n\r\n", None),
        "<wrong>": (None, "segments of another total length"), "<gap>": (None, "a segment is missing or doubled"),
        "<fine>": (b"fine", None), "<digest>": (None, "payload of another digest"), "<chunk>": (None, "chunk of another length"),
        "<empty>": (b"", None), "<torn>": (None, "the file ends inside"), "<last>": (b"last", None),
        None: (None, "a segment is missing or doubled"),
    }
    with pytest.raises(Exception, match="broken record"):
        warc.archived_rows(spark, str(tmp_path)).collect()


def test_large_files_are_read_in_splits(spark, tmp_path):
    ship(spark)
    r = random.Random(4)
    payloads = [prose(i, r.randint(0, 300)).encode() for i in range(200)]
    payloads[50] = record("resource", b"inside") + b"\r\n\r\nWARC/" + record("resource", b"inside")
    (tmp_path / "one.warc").write_bytes(b"".join(record("resource", p, WARC_Record_ID=f"<{i}>") for i, p in enumerate(payloads)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        read = warc.read_archives(spark, str(tmp_path))
        assert warc._pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 5
        assert {r.record_id: (r.payload, r.problem) for r in read.collect()} == {f"<{i}>": (p, None) for i, p in enumerate(payloads)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records_that_end_at_the_end_of_a_read_buffer(spark, tmp_path):
    """Line ends of a block, those that close it and a buffer's end in any position."""
    ship(spark)
    for size in (4096, 65_536):
        for k in range(14):
            head = len(record("resource", b"0" * size, WARC_Record_ID="<a>")) - size
            first = record("resource", b"x" * (size - head - k) + b"\r\n\r\n", WARC_Record_ID="<a>")
            (tmp_path / f"{size}-{k}.warc").write_bytes(first + record("resource", b"second\n", WARC_Record_ID="<b>"))
    read = warc.read_archives(spark, str(tmp_path)).collect()
    assert Counter((r.record_id, r.problem) for r in read) == {("<a>", None): 28, ("<b>", None): 28}
    assert {r.payload for r in read if r.record_id == "<b>"} == {b"second\n"}


def test_chunks_of_any_size():
    r = random.Random(6)
    for size in (1, 3, 4096):
        for n in (0, 1, 3, 5000):
            data = r.randbytes(n)
            assert warc.dechunk(warc.chunked(data, size)) == data
    for broken in (b"", b"5\r\nhello\r\n", b"-1\r\n\r\n", b"g\r\n", b"2\r\nabc\r\n0\r\n\r\n", b"0x2\r\nab\r\n0\r\n\r\n"):
        with pytest.raises(ValueError):
            warc.dechunk(broken)
