"""WARC archives written and read by Spark's own text files.

A record ends with two empty lines, so archives are text files with that as line separator,
written and committed like any other table. A record's payload stands in an HTTP message with
chunked transfer framing; a message longer than a segment goes on in continuation records,
which may lie in other archives. Records with the same payload are written once, the others
as revisits of it.

Reading cuts files, in splits, where a record could start. A piece is a record if it has the
length that its header states; where a payload holds the look of a start, pieces are joined
in file order until the lengths agree. Segments are grouped by the record they continue,
ordered by number, held against the stated total, joined, and their chunks decoded.
"""

import base64
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempestry.llm.common import bytes_of, emit
from tempestry.session import Scratch

_END = b"\r\n\r\n"
#: Where files are cut. No beginning of it stands again inside it, so that a reader which
#: goes on from the first letter after a mismatch, as Hadoop's does at a buffer's end, finds all.
_CUT = b"\nWARC/"
_HEX = re.compile(rb"[0-9A-Fa-f]+")
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = pa.schema([("record", pa.binary())])


# --- writing ---------------------------------------------------------------------------


def record_uri(*name) -> str:
    """The record id made from a name: the same in every attempt of a task."""
    digest = hashlib.md5(":".join(map(str, name)).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest, version=4)}>"


def chunked(payload: bytes, size: int) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join([*parts, b"0\r\n\r\n"])


def _record(headers, block: bytes) -> bytes:
    """A record without the two line ends that close it. Empty headers are left out."""
    lines = [f"{k}: {v}\r\n" for k, v in (*headers, ("Content-Length", len(block))) if v is not None]
    return b"WARC/1.1\r\n" + "".join(lines).encode() + b"\r\n" + block


def _one_line(text):
    """A header value: line ends and other control characters percent-encoded."""
    return text and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def records_of(uid, row_id, url, payload, refers, date, chunk_bytes, segment_bytes):
    """The records of one row: a response in one or more segments, or a revisit."""
    headers = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", record_uri(uid)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _one_line(url)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()),
        ("Content-Type", "application/http;msgtype=response"),
        ("X-Row-ID", row_id),
    ]
    if refers is not None:
        headers += [("WARC-Refers-To", record_uri(refers)), ("WARC-Profile", _REVISIT)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block += b"Transfer-Encoding: chunked\r\n\r\n"
    if refers is None:
        block += chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield _record(headers, block)
        return
    yield _record([*headers, ("WARC-Segment-Number", 1)], block[:segment_bytes])
    for number, at in enumerate(range(segment_bytes, len(block), segment_bytes), 2):
        last = at + segment_bytes >= len(block)
        more = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", record_uri(uid, number)),
            ("WARC-Date", date),
            ("WARC-Segment-Origin-ID", record_uri(uid)),
            ("WARC-Segment-Number", number),
            ("WARC-Segment-Total-Length", len(block) if last else None),
        ]
        yield _record(more, block[at : at + segment_bytes])


def _writer(date, chunk_bytes, segment_bytes):
    def run(batches):
        info = b"software: tempestry\r\nformat: WARC File Format 1.1\r\n"
        first = True
        for batch in batches:
            records = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if first:
                    kind = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_uri("info", row[0])), ("WARC-Date", date)]
                    records.append(_record([*kind, ("Content-Type", "application/warc-fields")], info))
                    first = False
                records += records_of(*row, date, chunk_bytes, segment_bytes)
            yield emit(_RECORD, record=records)

    return run


def write_archives(
    df: DataFrame, path: str, row_id: str, url: str, content: str, least_bytes=1000,
    chunk_bytes=4096, segment_bytes=8192, date="1970-01-01T00:00:00Z", compression="gzip", records_per_file=0,
) -> None:
    """Write a record per row of ``df`` to archives in the folder ``path``.

    The payload is ``content`` in UTF-8, null as empty. Of rows with equal payloads of at
    least ``least_bytes`` the one with the largest ``row_id`` (null is smallest) holds it and
    the others revisit it; of rows that also repeat that id one is the response. A null id or
    url has no header; white space and control characters in a url are percent-encoded.
    ``records_per_file`` above 0 starts a new archive after so many records, also between
    segments. Equal payloads are told by their SHA-256.
    """
    scratch = Scratch(df.sparkSession)
    payload = bytes_of(content)
    rows = df.select(
        F.monotonically_increasing_id().alias("uid"), F.col(row_id).alias("row_id"), F.col(url).alias("url"), payload.alias("payload")
    ).withColumn("key", F.unhex(F.sha2("payload", 256)))
    rows = scratch.save(rows, "rows")
    shared = rows.where(F.length("payload") >= least_bytes).groupBy("key")
    shared = shared.agg(F.max(F.struct("row_id", "uid")).alias("first"), F.count(F.lit(1)).alias("copies"))
    shared = scratch.save(shared.where("copies > 1").select("key", F.col("first.uid").alias("first")), "shared")
    refers = F.when(F.col("first") != F.col("uid"), F.col("first"))
    told = rows.join(shared, "key", "left")
    records = told.select("uid", "row_id", "url", "payload", refers.alias("refers"))
    lines = records.mapInArrow(_writer(date, chunk_bytes, segment_bytes), "record binary")
    writer = lines.select(F.col("record").cast("string")).write.option("lineSep", _END.decode())
    writer.option("compression", compression).option("maxRecordsPerFile", records_per_file).text(path)
    scratch.close()


# --- reading ---------------------------------------------------------------------------

_PIECES_SQL = (
    "file string, split long, row long, have long, need long, type string, record_id string, row_id string,"
    " target_uri string, refers_to string, digest string, origin string, number int, total long, block binary"
)
_PIECES = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("row", pa.int64()), ("have", pa.int64()), ("need", pa.int64())]
    + [(c, pa.string()) for c in ("type", "record_id", "row_id", "target_uri", "refers_to", "digest", "origin")]
    + [("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())]
)


def _whole_number(value):
    return int(value) if value is not None and value.isascii() and value.isdigit() and len(value) < 19 else None


def _fields(head: bytes) -> dict:
    """Header fields by lower-case name; lines that start with white space go on with the last."""
    lines = re.sub(rb"\r\n[ \t]+", b" ", head).split(b"\r\n")
    pairs = (line.partition(b":") for line in lines[1:])
    return {k.strip().lower(): v.strip().decode("utf-8", "replace") for k, _, v in reversed(list(pairs))}


def parse_piece(data: bytes):
    """What a piece says of itself: the length it should have, its fields, and its block.

    ``data`` starts with a version line, with or without ``WARC/``, and may have the line
    ends that close a record behind it. The needed length is -1 if there is no header with
    a content length.
    """
    end = data.find(_END)
    if end < 0:  # a block that begins like a record is a piece of its own
        end = len(data.removesuffix(_END[:3]))
    named = _fields(data[:end])
    length = _whole_number(named.get(b"content-length"))
    if length is None:
        return -1, {}, None
    return end + 4 + length, named, data[end + 4 : end + 4 + length]


def _piece_row(file, split, row, data):
    need, named, block = parse_piece(data)
    get = named.get
    return (
        file, split, row, len(data), need, get(b"warc-type"), get(b"warc-record-id"), get(b"x-row-id"), get(b"warc-target-uri"),
        get(b"warc-refers-to"), get(b"warc-payload-digest"), get(b"warc-segment-origin-id"),
        _whole_number(get(b"warc-segment-number")), _whole_number(get(b"warc-segment-total-length")), block,
    )


def _parse(batches):
    for batch in batches:
        rows = [_piece_row(*row) for row in zip(*(c.to_pylist() for c in batch.columns))]
        if rows:
            yield emit(_PIECES, **{c: list(v) for c, v in zip(_PIECES.names, zip(*rows))})


def _pieces(spark: SparkSession, path) -> DataFrame:
    """The files cut before every look of a record's start: file, split, row, data."""
    text = spark.read.option("lineSep", _CUT.decode()).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").cast("binary").alias("data"),
    )


_CHAIN = pa.schema([("row", pa.int64()), ("head", pa.int64())])


def _chain(batches):
    """Pieces sorted by file, split and row to the row of the piece that starts their record.

    The first piece of a file starts a record, and so does each after a record's full length.
    """
    file, head, missing = None, None, 0
    for batch in batches:
        rows = []
        for here, row, have, need in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if here == file and missing > 0:
                missing -= have + len(_CUT)
            else:
                file, head = here, row
                missing = need - have
            rows.append((row, head))
        if rows:
            yield emit(_CHAIN, **{c: list(v) for c, v in zip(_CHAIN.names, zip(*rows))})


def _read_records(spark: SparkSession, path) -> DataFrame:
    """The records of archives, each in one row as ``_PIECES_SQL``.

    A record that the end of its file cuts off keeps ``have`` below ``need``; others have the
    line ends that close them on top.
    """
    cut = _pieces(spark, path)
    parsed = cut.mapInArrow(_parse, _PIECES_SQL)
    short = parsed.where("have < need").select("file").distinct()
    scratch = Scratch(spark)
    short = scratch.save(short, "short")
    if short.isEmpty():
        return parsed.where("need >= 0")
    odd = parsed.join(short, "file", "left_semi").select("file", "row", "have", "need", "split")
    order = odd.repartition("file").sortWithinPartitions("file", "split", "row")
    heads = scratch.save(order.select("file", "row", "have", "need").mapInArrow(_chain, "row long, head long"), "heads")
    joined = (
        cut.join(heads, "row")
        .groupBy("head")
        .agg(F.min_by("file", "row").alias("file"), F.min("split").alias("split"), F.sort_array(F.collect_list(F.struct("row", "data"))).alias("parts"))
        .select("file", "split", F.col("head").alias("row"), F.array_join(F.col("parts.data").cast("array<string>"), _CUT.decode()).cast("binary").alias("data"))
    )
    whole = joined.mapInArrow(_parse, _PIECES_SQL)
    return parsed.join(short, "file", "left_anti").unionByName(whole).where("need >= 0")


def dechunk(body: bytes) -> bytes:
    """The content of a body in chunked transfer framing. ValueError where it is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        size = body[at:end].split(b";")[0].strip() if end >= 0 else b""
        if not _HEX.fullmatch(size):
            raise ValueError("no chunk size")
        size, at = int(size, 16), end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk of another length")
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of a record's block: an HTTP message's body without transfer framing."""
    if not block.startswith(b"HTTP/"):
        return block
    head, _, body = block.partition(_END)
    coding = _fields(head).get(b"transfer-encoding", "")
    return dechunk(body) if coding.lower() == "chunked" else body


def _digest_agrees(stated, digest: bytes):
    kind, _, value = (stated or "").partition(":")
    if kind.lower() != "sha1" or not value:
        return True
    return value.upper() == base64.b32encode(digest).decode() or value.lower() == digest.hex()


_READ_SQL = (
    "type string, record_id string, row_id string, target_uri string, refers_to string, digest string,"
    " payload binary, payload_bytes long, payload_sha1 string, problem string"
)
_READ = pa.schema(
    [(c, pa.string()) for c in ("type", "record_id", "row_id", "target_uri", "refers_to", "digest")]
    + [("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string()), ("problem", pa.string())]
)


def _assembled(numbers, blocks, total, have, need, segmented):
    """The whole block of a record from its segments. ValueError where they don't make one."""
    if have < need:
        raise ValueError("the file ends inside")
    if segmented and numbers != list(range(1, len(numbers) + 1)):
        raise ValueError("a segment is missing or doubled")
    block = b"".join(blocks)
    if segmented and total != len(block):
        raise ValueError("segments of another total length")
    return block


def _decode(keep):
    def run(batches):
        for batch in batches:
            rows = []
            for *named, have, need, segmented, numbers, blocks, total in zip(*(c.to_pylist() for c in batch.columns)):
                payload, size, sha1, problem = None, None, None, None
                try:
                    block = _assembled(numbers, blocks, total, have, need, segmented)
                    if named[0] != "revisit":
                        payload = payload_of(block)
                        digest = hashlib.sha1(payload).digest()
                        size, sha1 = len(payload), digest.hex()
                        if not _digest_agrees(named[5], digest):
                            raise ValueError("payload of another digest")
                except ValueError as broken:
                    payload, size, sha1, problem = None, None, None, str(broken)
                rows.append((*named, payload if keep else None, size, sha1, problem))
            if rows:
                yield emit(_READ, **{c: list(v) for c, v in zip(_READ.names, zip(*rows))})

    return run


def read_archives(spark: SparkSession, path, payloads=True) -> DataFrame:
    """A row per record of the archives under ``path``, continuation records merged in theirs.

    Plain files and gzip, in one or many members. Columns: type, record_id, row_id,
    target_uri, refers_to, digest (as stated), payload, payload_bytes, payload_sha1 and
    problem. ``payloads=False`` leaves payload null. A record whose segments are incomplete,
    doubled or of another total length, whose chunks are broken, whose digest differs or
    which its file cuts off has a problem and no payload; continuations of no record are a
    record of null type. A revisit has no payload of its own. An empty folder gives no rows.
    """
    records = _read_records(spark, path)
    named = ["type", "record_id", "row_id", "target_uri", "refers_to", "digest"]
    alone = records.where("number IS NULL").select(
        *named, "have", "need", F.lit(False).alias("segmented"), F.array(F.lit(1)).alias("numbers"),
        F.array("block").alias("blocks"), F.lit(None).cast("long").alias("total"),
    )
    origin = F.col("number") == 1
    parts = records.where("number IS NOT NULL").withColumn("key", F.when(origin, F.col("record_id")).otherwise(F.col("origin")))
    ordered = F.sort_array(F.collect_list(F.struct("number", "block")))
    merged = parts.groupBy("key").agg(
        F.max(F.when(origin, F.struct(*named))).alias("named"),
        F.least(F.min(F.col("have") - F.col("need")), F.lit(0)).alias("have"),
        ordered.alias("parts"),
        F.max("total").alias("total"),
    )
    merged = merged.select(
        "named.*", "have", F.lit(0).cast("long").alias("need"), F.lit(True).alias("segmented"),
        F.col("parts.number").alias("numbers"), F.col("parts.block").alias("blocks"), "total",
    )
    return alone.unionByName(merged).mapInArrow(_decode(payloads), _READ_SQL)


def archived_rows(spark: SparkSession, path) -> DataFrame:
    """The rows that ``write_archives`` wrote: row_id, payload_bytes, payload_sha1, type, refers_to.

    The payload of a revisit is that of the record it refers to, whose row_id stands in
    refers_to. Records with a problem raise an error.
    """
    scratch = Scratch(spark)
    read = read_archives(spark, path, payloads=False).where("type IN ('response', 'revisit') OR problem IS NOT NULL")
    sound = F.when(F.col("problem").isNull(), F.col("row_id")).otherwise(
        F.raise_error(F.concat(F.lit("broken record: "), F.col("problem"))).cast("string")
    )
    read = scratch.save(read.select("type", "record_id", sound.alias("row_id"), "refers_to", "payload_bytes", "payload_sha1"), "read")
    own = read.where("type = 'response'")
    said = own.select(
        F.col("record_id").alias("refers_to"), F.col("row_id").alias("said_id"), F.col("payload_bytes").alias("said_bytes"),
        F.col("payload_sha1").alias("said_sha1"),
    )
    again = read.where("type = 'revisit'").join(said, "refers_to", "left").select(
        "row_id", F.col("said_bytes").alias("payload_bytes"), F.col("said_sha1").alias("payload_sha1"), "type", F.col("said_id").alias("refers_to")
    )
    own = own.select("row_id", "payload_bytes", "payload_sha1", "type", F.lit(None).cast("string").alias("refers_to"))
    return own.unionByName(again)


def archive_pages(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives of a scratch folder and read them back.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to. Other
    columns are ignored; nulls, equal payloads and repeated rows as ``write_archives`` says. No
    pages give no rows.
    """
    spark = pages.sparkSession
    path = Scratch(spark).path("archives")
    write_archives(pages, path, "page_id", "url", "html", **options)
    return archived_rows(spark, path).select(
        F.col("row_id").cast("long").alias("page_id"),
        "payload_bytes",
        F.col("payload_sha1").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
    )
