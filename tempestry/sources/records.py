"""CSV text cut into records, by many tasks also where quoted fields hold line breaks.

A line break ends a record unless it stands inside quotes, and whether it does depends on all
that comes before. So a first pass tells for every block of a file how it ends if it starts
outside quotes and if it starts inside; putting these together along the blocks of a file
gives the true start of each; a second pass cuts every block into records, and what crosses
from one block into the next is put together from a piece or two per block. A task reads many
small blocks one after the other.
"""

import math
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempestry.session import Scratch, ship_package

# A field that is whole: quoted up to its closing quote and on to the next comma or line end, or
# without a quote at its start, or empty. A quote inside a field that starts without one is a letter.
_CLOSED = rb'[^"]*+(?:""[^"]*+)*+"[^,\n]*+'
_FIELD = rb'(?:"' + _CLOSED + rb'|[^",\n][^,\n]*+|)'
_OUTSIDE = re.compile(_FIELD + rb"(?:[,\n]" + _FIELD + rb")*+")
_INSIDE = re.compile(_CLOSED + rb"(?:[,\n]" + _FIELD + rb")*+")
# A record to its end, or all that is left if quotes stay open; the rest of one that is open.
_WHOLE = re.compile(rb"(" + _FIELD + rb"(?:," + _FIELD + rb")*+)(?:\n|\Z)|(.+)", re.DOTALL)
_REST = re.compile(rb"(" + _CLOSED + rb"(?:," + _FIELD + rb")*+)(?:\n|\Z)")

RECORD, HEAD, MIDDLE, TAIL = range(4)

# Text a task reads, where blocks are smaller than that and all cores have some.
BYTES_PER_TASK = 32 << 20


def ends_inside(text: bytes, inside: bool) -> bool:
    """Whether quotes are open at the end of lines that start inside quotes or not."""
    if b'"' not in text:
        return inside
    found = (_INSIDE if inside else _OUTSIDE).match(text)
    return found is None or found.end() < len(text)


def whole_records(text: bytes, inside: bool) -> tuple:
    """The records of lines that start inside one or not, and what is left of one that goes on, or None.

    The first record is the rest of the one that the lines start in. Blank ones are among them.
    """
    records, at = [], 0
    if inside:
        found = _REST.match(text)
        if found is None:
            return records, text
        records.append(found[1])
        at = found.end()
        if at == found.end(1):
            return records, None
    if text.find(b'"', at) < 0:
        return records + text[at:].split(b"\n"), None
    found = _WHOLE.findall(text, at)
    left = next((left for _, left in found[-2:] if left), None)
    records.extend(record for record, left in found if not left)
    return records, left


def text_lines(spark: SparkSession, paths) -> DataFrame:
    """The lines of files: file (as a URL), start of their block, line. Only ``\\n`` parts lines."""
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(paths)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )


def _tasks(spark: SparkSession, paths) -> int:
    """The number of tasks that read files: one for some MB of text, at least one for each core."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    size = listing.agg(F.sum("length")).head()[0] or 0
    return max(spark.sparkContext.defaultParallelism, math.ceil(size / BYTES_PER_TASK))


def _runs(batches):
    """(file, start, text) of a stream: lines put together again, a block going on over batches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start, line = batch.columns
        new = [pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)) for c in (file, start)]
        at = [0, *(i + 1 for i in pc.indices_nonzero(pc.or_(*new)).to_pylist()), len(line)]
        texts = pc.binary_join(pa.ListArray.from_arrays(at, line), b"\n")
        for here, text in zip(at, texts):
            yield file[here].as_py(), start[here].as_py(), text.as_py()


def _batch(schema, rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for f, c in zip(schema, zip(*rows))], schema=schema
    )


_ENDS = pa.schema([("file", pa.string()), ("start", pa.int64()), ("after_out", pa.bool_()), ("after_in", pa.bool_())])


def _block_ends(batches):
    """How each block ends if it starts outside quotes, and if it starts inside."""
    now, out, inside = None, False, True
    for file, start, text in _runs(batches):
        if (file, start) != now:
            if now is not None:
                yield _batch(_ENDS, [(*now, out, inside)])
            now, out, inside = (file, start), False, True
        lines = [] if out == inside else text.split(b"\n")
        for i, line in enumerate(lines):
            if b'"' in line:
                out, inside = ends_inside(line, out), ends_inside(line, inside)
                if out == inside:
                    text = b"\n".join(lines[i + 1 :])
                    break
        if out == inside:  # one state from here on, whatever came before
            out = inside = ends_inside(text, out)
    if now is not None:
        yield _batch(_ENDS, [(*now, out, inside)])


def _inside_starts(ends: DataFrame) -> dict:
    """The blocks that start inside quotes, by file.

    A block leads to one state whatever came before, swaps the two, or keeps them: the state
    is that of the last block of the first kind, swapped as often as swaps follow. At most a
    number per block comes to the driver, which plans the scan with a file and two numbers
    per block.
    """
    along = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum((F.col("after_out") & ~F.col("after_in")).cast("int")).over(along) % 2 == 1
    fixed = F.when(F.col("after_out") == F.col("after_in"), F.col("after_out") != F.col("swapped"))
    states = ends.withColumn("swapped", swaps).withColumn("fixed", fixed)
    last = F.coalesce(F.last("fixed", ignorenulls=True).over(along), F.lit(False))
    states = states.withColumn("after", last != F.col("swapped"))
    before = F.lag("after", 1, False).over(Window.partitionBy("file").orderBy("start"))
    starts = states.withColumn("before", before).where("before").groupBy("file")
    return {r.file: frozenset(r.starts) for r in starts.agg(F.collect_list("start").alias("starts")).collect()}


_PIECES = pa.schema(
    [("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.binary())]
)


def _cutter(starts):
    """Lines to pieces: whole records, the end of a record that another block began (HEAD),
    a block inside one record (MIDDLE), the start of one that goes on (TAIL). Blank records
    are left out; ``first`` marks the first record of a file. ``starts`` is a broadcast, which
    a worker reads once for all its tasks."""

    def run(batches):
        inside_starts = starts.value
        now, waiting, head, first, rows = None, [], False, False, []

        def close():
            if waiting:
                rows.append((*now, MIDDLE if head else TAIL, first and not head, b"\n".join(waiting)))

        for file, start, text in _runs(batches):
            if (file, start) != now:
                close()
                now, waiting, first = (file, start), [], start == 0
                head = start in inside_starts.get(file, ())
            records, left = whole_records(text, head or bool(waiting))
            if records and (head or waiting):
                records[0] = b"\n".join([*waiting, records[0]])
                if head:
                    rows.append((*now, HEAD, False, records.pop(0)))
                waiting, head = [], False
            for record in records:
                if record not in (b"", b"\r"):
                    rows.append((*now, RECORD, first, record))
                    first = False
            if left is not None:
                waiting.append(left)
            if len(rows) >= 1000:
                yield _batch(_PIECES, rows)
                rows.clear()
        close()
        if rows:
            yield _batch(_PIECES, rows)

    return run


def cut_records(spark: SparkSession, paths, scratch: Scratch) -> DataFrame:
    """The records of CSV files, line breaks inside quotes included: file, first, text.

    ``file`` is a URL; ``first`` marks the first record of each file. A record ends at a line
    feed outside quotes, or with its file; a carriage return before that is kept. Blank lines
    are no records. Two scans read the text, each in as many tasks as ``BYTES_PER_TASK`` and
    the cores ask for, at most one per block, and the records are written once, first ones and
    those that cross blocks apart. Files that cannot be split, such as gzip, are one block.
    """
    ship_package(spark)
    tasks = _tasks(spark, paths)
    lines = text_lines(spark, paths).coalesce(tasks)
    ends = lines.mapInArrow(_block_ends, "file string, start long, after_out boolean, after_in boolean")
    starts = spark.sparkContext.broadcast(_inside_starts(scratch.save(ends, "ends").coalesce(tasks)))
    pieces = lines.mapInArrow(_cutter(starts), "file string, start long, kind int, first boolean, text binary")
    pieces = pieces.withColumn("text", F.col("text").cast("string"))
    pieces = scratch.save(pieces, "pieces", partition_by=("kind", "first"))
    # where a block stands tells the record of its pieces, so that no text is in the window
    crossing = pieces.where(F.col("kind") != RECORD).coalesce(tasks)
    order = Window.partitionBy("file").orderBy("start", "kind")
    record = F.sum((F.col("kind") == TAIL).cast("int")).over(order).alias("record")
    places = crossing.select("file", "start", "kind", record)
    parts = F.sort_array(F.collect_list(F.struct("start", "kind", "text")))
    joined = crossing.join(places, ["file", "start", "kind"]).groupBy("file", "record")
    joined = joined.agg(F.max("first").alias("first"), parts.alias("parts"))
    joined = joined.select("file", "first", F.array_join(F.col("parts.text"), "\n").alias("text"))
    joined = scratch.save(joined, "joined", partition_by=("first",)).select("file", "first", "text")
    return pieces.where(F.col("kind") == RECORD).select("file", "first", "text").unionByName(joined)


_FIRST = pa.schema([("file", pa.string()), ("text", pa.binary())])


def _first_records(stop):
    """The first record of each file; ``stop`` reads no further than the first one found."""

    def run(batches):
        now, inside, waiting, found = None, False, [], False
        for file, start, text in _runs(batches):
            if start > 0:
                if stop:
                    return
                continue
            if file != now:
                if waiting and not found:
                    yield _batch(_FIRST, [(now, b"\n".join(waiting))])
                now, inside, waiting, found = file, False, [], False
            for line in () if found else text.split(b"\n"):
                if not waiting and line in (b"", b"\r"):
                    continue
                inside = ends_inside(line, inside)
                waiting.append(line)
                if not inside:
                    found = True
                    yield _batch(_FIRST, [(file, b"\n".join(waiting))])
                    if stop:
                        return
                    break
        if waiting and not found:
            yield _batch(_FIRST, [(now, b"\n".join(waiting))])

    return run


_OPEN_COST = "spark.sql.files.openCostInBytes"


def files_by_header(spark: SparkSession, files) -> dict:
    """``files`` (names) grouped by their first record, read in a job of a task per file.

    Such a task stops after the record; where settings put several files into one task, those
    it leaves are read once more to the end. Only distinct headers with the names of their
    files come to the driver. Empty files have no header.
    """
    ship_package(spark)
    groups, left = {}, {f: None for f in files}
    kept = spark.conf.get(_OPEN_COST, None)
    for stop in (True, False):
        if not left:
            break
        try:
            if stop:
                spark.conf.set(_OPEN_COST, spark.conf.get("spark.sql.files.maxPartitionBytes"))
            found = text_lines(spark, list(left)).mapInArrow(_first_records(stop), "file string, text binary")
            name = F.try_url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))
            header = F.regexp_replace(F.col("text").cast("string"), r"\r\z", "")
            rows = found.groupBy(header.alias("header")).agg(F.collect_list(name).alias("files")).collect()
        finally:
            if kept is None:
                spark.conf.unset(_OPEN_COST)
            else:
                spark.conf.set(_OPEN_COST, kept)
        for row in rows:
            groups.setdefault(row.header, []).extend(row.files)
            for file in row.files:
                left.pop(file, None)
    return {header: sorted(names) for header, names in sorted(groups.items())}
