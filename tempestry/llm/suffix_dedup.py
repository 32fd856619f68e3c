"""Removal of repeated byte strings through suffix arrays.

Equal strings of ``length`` bytes have equal smallest grams, so the starts of all such
strings ("windows") are cut into fragments by their smallest gram, and only fragments
that share it can hold equal windows. Grams that the corpus shows once end there.
Identical fragments are reduced to a class by a partial aggregate. Classes that share
the gram and the bytes on one side of it go to a suffix array of their windows, sorted in two
stages: suffixes smaller than their successor directly, the others by scans over the
buckets of their first byte.
Neighbours in it with a common prefix of ``length`` bytes are equal windows, and all but
the first in document order are removed.
"""

import hashlib
import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.llm.common import bytes_of, emit, groups_of
from tempestry.session import Scratch

LENGTH = 100
GRAM = 32
#: Bytes of fragments whose windows are sorted at once.
BLOCK = 1 << 21

_rand = random.Random(20)
_BYTE = np.array([_rand.getrandbits(64) for _ in range(256)], dtype=np.uint64)
_BASE = _rand.getrandbits(64) | 5
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base, n):
    factors = np.full(n, base, dtype=np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


class Grams:
    """Hashes of all grams of a block of bytes, and their sliding minima."""

    def __init__(self, most, gram=GRAM, length=LENGTH):
        self.gram, self.span, self.length = gram, length - gram + 1, length
        #: Context that any window has on one side of its gram at least.
        self.side = (length - gram + 1) // 2
        self.up, self.down = _powers(_BASE, most), _powers(_UNBASE, most)

    def sums(self, block):
        out = np.zeros(len(block) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[block] * self.up[: len(block)], out=out[1:])
        return out

    def hashes(self, sums, starts, width):
        """Hash of the ``width`` bytes from each start (an array or a slice from 0)."""
        h = (sums[starts + width] - sums[starts]) * self.down[starts]
        return _mixed(h)

    def sliding_min(self, h):
        """The smallest of every ``span`` neighbours."""
        width, done = 1, h
        while 2 * width <= self.span:
            done, width = np.minimum(done[:-width], done[width:]), 2 * width
        rest = self.span - width
        return np.minimum(done[:-rest], done[rest:]) if rest else done


def _mixed(h):
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return h


_PLACE_BITS = 24  # of a gram within its block
#: Bytes of texts whose grams are hashed at once; longer texts are cut.
CUT = 1 << 20


def fragments(texts, grams):
    """The fragments of some texts, one for each gram that is the first smallest of a window.

    Returns arrays: gram, digest of all bytes, left, right, text number, start, windows.
    ``left`` and ``right`` hash the gram with the bytes beside it, 0 where no window of
    the fragment has as many: equal windows of two fragments have the gram at the same
    offset, and so agree in one of them.
    """
    length, gram, side = grams.length, grams.gram, grams.side
    block = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    none = [np.empty(0, dtype=np.int64)] * 7
    if len(block) < length:
        return none
    sums, n = grams.sums(block), len(block) - gram + 1
    h = _mixed((sums[gram:] - sums[:-gram]) * grams.down[:n])
    place = np.arange(n, dtype=np.uint64)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = grams.sliding_min((h & ~low) | place)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    valid = np.arange(len(least)) + length <= ends[owner]
    new = np.ones(len(least), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    new &= valid
    starts = np.flatnonzero(new)
    if not len(starts):
        return none
    text = owner[starts]
    stops = np.minimum(np.append(starts[1:], len(least)), ends[text] - length + 1)
    anchor = (least[starts] & low).astype(np.int64)
    before, after = anchor - starts, stops - 1 + length - gram - anchor
    left = np.where(before >= side, grams.hashes(sums, np.maximum(anchor - side, 0), side + gram), np.uint64(0))
    to = np.minimum(anchor, len(block) - gram - side)
    right = np.where(after >= side, grams.hashes(sums, np.maximum(to, 0), gram + side), np.uint64(0))
    view, digest = memoryview(block), xxhash.xxh64_intdigest
    digests = np.fromiter(
        (digest(view[a:b]) for a, b in zip(starts.tolist(), (stops + length - 1).tolist())),
        np.uint64,
        len(starts),
    )
    half = np.uint64(32)
    return [
        h[anchor].view(np.int64),
        digests.view(np.int64),
        (left >> half).astype(np.uint32).view(np.int32),
        (right >> half).astype(np.uint32).view(np.int32),
        text,
        starts - (ends - sizes)[text],
        stops - starts,
    ]


_FRAGMENT = pa.schema(
    [("gram", pa.int64()), ("digest", pa.int64()), ("left", pa.int32()), ("right", pa.int32()), ("start", pa.int32()), ("windows", pa.int16())]
)


def pieces(texts, block, length):
    """``(text number, offset, bytes)`` of at most ``block`` bytes; each window is in one piece."""
    for i, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 1), block - length + 1):
            yield i, at, text[at : at + block]


def _cut(length, gram, block=CUT):
    assert length <= block <= 1 << _PLACE_BITS

    def rows(batch, grams, held):
        owners, offsets, parts = zip(*held)
        *columns, part, start, windows = fragments(parts, grams)
        part = np.asarray(part, dtype=np.int64)
        start = start + np.array(offsets, dtype=np.int64)[part]
        names = _FRAGMENT.names
        out = emit(_FRAGMENT, **dict(zip(names, [*columns, start, windows])))
        own = pa.array(np.array(owners, dtype=np.int64)[part])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(own), batch.column("body").take(own), *out.columns],
            names=["doc_id", "body", *names],
        )

    def cut(batches):
        grams = Grams(block, gram, length)
        for batch in batches:
            held, size = [], 0
            for piece in pieces(batch.column("text").to_pylist(), block, length):
                if held and size + len(piece[2]) > block:
                    yield rows(batch, grams, held)
                    held, size = [], 0
                held.append(piece)
                size += len(piece[2])
            if held:
                yield rows(batch, grams, held)

    return cut


def _first_at_or_after(flags):
    """For each place the first one from there on that is set; the last one must be."""
    where = np.where(flags, np.arange(len(flags)), len(flags))
    return np.minimum.accumulate(where[::-1])[::-1]


def two_stage_order(text: bytes, starts, depth=LENGTH):
    """The ``starts`` (sorted) in the order of the ``depth`` bytes that follow each.

    A suffix is of the first kind if it is smaller than its successor. Those are sorted
    directly and stand at the end of the bucket of their first byte. The buckets are then
    scanned in order: every other suffix follows from the place of its successor, in a
    smaller bucket or placed before in the same one, and they fill the front of theirs.
    Successors that are no starts are carried along up to the next of the first kind.
    """
    if not len(starts):
        return starts
    end = len(text)
    b = np.frombuffer(text + bytes(depth + 2), dtype=np.uint8)
    step = np.diff(b.astype(np.int16))
    turns = step != 0
    turns[-1] = True
    small = step[_first_at_or_after(turns)] > 0
    small[end:] = True  # the empty suffix ends all chains
    till = _first_at_or_after(small)
    last = starts[np.append(starts[1:] != starts[:-1] + 1, True)]
    last = last[~small[last]]
    extra = till[last + 1] - last
    carried = np.repeat(last + 1, extra) + np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra)
    wanted = np.zeros(end + 1, dtype=bool)
    wanted[starts] = True
    carried = np.unique(carried[~wanted[carried]])
    all_of = np.sort(np.concatenate([starts, carried])) if len(carried) else starts
    n, windows = len(all_of), np.lib.stride_tricks.sliding_window_view(b, depth)

    def sort(places):
        keys = windows[all_of[places]].view(f"S{depth}").ravel()
        return places[np.argsort(keys, kind="stable")]

    direct = sort(np.flatnonzero(small[all_of]))
    first = b[all_of]
    direct_from = np.searchsorted(first[direct], np.arange(257))
    others = np.flatnonzero(~small[all_of])
    others = others[np.argsort(first[others], kind="stable")]
    others_from = np.searchsorted(first[others], np.arange(257))
    rank, order, at = np.full(n + 1, -1, dtype=np.int64), np.empty(n, dtype=np.int64), 0
    for c in range(256):
        waiting = others[others_from[c] : others_from[c + 1]]
        own = direct[direct_from[c] : direct_from[c + 1]]
        while len(waiting):
            known = rank[waiting + 1] >= 0
            ready = waiting[known]
            if not len(ready):  # zero bytes up to the end of the text
                own, waiting = sort(np.concatenate([own, waiting])), waiting[:0]
                break
            ready = ready[np.argsort(rank[ready + 1], kind="stable")]
            order[at : at + len(ready)] = ready
            rank[ready] = np.arange(at, at + len(ready))
            at, waiting = at + len(ready), waiting[~known]
        order[at : at + len(own)] = own
        rank[own] = np.arange(at, at + len(own))
        at += len(own)
    order = all_of[order]
    return order[wanted[order]]


def common_prefixes(text: bytes, order, most):
    """Common prefix of each suffix in ``order`` with the one before it, up to ``most``.

    Eight bytes at a time where all agree; counts whole groups of eight, and the rest.
    """
    out = np.zeros(len(order), dtype=np.int64)
    padded = np.frombuffer(text + bytes(most + 8), dtype=np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    going = np.arange(1, len(order))
    for k in range(0, most, 8):
        width = min(8, most - k)
        same = words[order[going] + k][:, :width] == words[order[going - 1] + k][:, :width]
        agree = np.where(same.all(axis=1), width, same.argmin(axis=1))
        out[going] = k + agree
        going = going[agree == width]
        if not len(going):
            break
    return out


def later_windows(parts, length=LENGTH):
    """Which windows of fragments have an equal one earlier: (fragment, offset) arrays.

    ``parts`` is a list of ``(order key, start, bytes)``; windows are compared by key,
    then position. A window at the very place of another is the same one.
    """
    text = b"".join(p[2] for p in parts)
    sizes = np.array([len(p[2]) for p in parts])
    froms = np.cumsum(sizes) - sizes
    counts = np.maximum(sizes - length + 1, 0)
    part_of = np.repeat(np.arange(len(parts)), counts)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + froms[part_of]
    if not len(starts):
        return starts, starts
    order = two_stage_order(text, starts, length)
    part = np.searchsorted(froms, order, side="right") - 1
    offset = order - froms[part]
    fresh = common_prefixes(text, order, length) < length
    shared = ~(fresh & np.append(fresh[1:], True))  # not alone in its group
    group, part, offset = np.cumsum(fresh)[shared], part[shared], offset[shared]
    if not len(group):
        return part, offset
    keys = {k: i for i, k in enumerate(sorted({p[0] for p in parts}))}
    doc = np.array([keys[p[0]] for p in parts])[part]
    place = np.array([p[1] for p in parts])[part] + offset
    sort = np.lexsort((place, doc, group))
    group, doc, place = group[sort], doc[sort], place[sort]
    head = np.ones(len(group), dtype=bool)
    head[1:] = group[1:] != group[:-1]
    first = np.flatnonzero(head)[np.cumsum(head) - 1]
    later = (doc != doc[first]) | (place != place[first])
    return part[sort][later], offset[sort][later]


def runs(fragment, offset):
    """Consecutive offsets of one fragment as (fragment, from, to), to inclusive."""
    if not len(fragment):
        return fragment, offset, offset
    sort = np.lexsort((offset, fragment))
    fragment, offset = fragment[sort], offset[sort]
    new = np.ones(len(fragment), dtype=bool)
    new[1:] = (fragment[1:] != fragment[:-1]) | (offset[1:] - offset[:-1] > 1)
    a = np.flatnonzero(new)
    b = np.append(a[1:], len(fragment)) - 1
    return fragment[a], offset[a], offset[b]


def _order_key(doc_id, body):
    return (doc_id is not None, doc_id or 0, body)


def _sort_fragments(length):
    def ranges(table, out):
        ids, bodies = table.column("doc_id").to_pylist(), table.column("body").to_pylist()
        starts, texts = table.column("start").to_pylist(), table.column("bytes").to_pylist()
        parts = [(_order_key(d, h), s, t) for d, h, s, t in zip(ids, bodies, starts, texts)]
        found, a, b = runs(*later_windows(parts, length))
        for f, x, y in zip(found.tolist(), a.tolist(), b.tolist()):
            out.append((ids[f], bodies[f], starts[f] + x, starts[f] + y + length))

    def sort(batches):
        for table in groups_of(batches, ("gram",)):
            grams = np.array(table.column("gram"))
            sizes = np.cumsum([len(t) for t in table.column("bytes").to_pylist()])
            cuts = np.append(np.flatnonzero(grams[1:] != grams[:-1]) + 1, len(grams))
            out, at, done = [], 0, 0
            for i, to in enumerate(cuts.tolist()):
                if i == len(cuts) - 1 or sizes[cuts[i + 1] - 1] - done > BLOCK:
                    ranges(table.slice(at, to - at), out)
                    at, done = to, sizes[to - 1]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=pa.int64()) for c in zip(*out)], names=["doc_id", "body", "a", "b"]
                )

    return sort


_READ_SQL = "gram long, doc_id long, body long, start long, bytes binary, window binary"
_READ = pa.schema(
    [(c, pa.int64()) for c in ("gram", "doc_id", "body", "start")] + [("bytes", pa.binary()), ("window", pa.binary())]
)


def _read_fragments(length):
    """The bytes of the wanted fragments of each text; of crowded grams a digest of each window."""

    def read(batches):
        for batch in batches:
            out = []
            names = ("doc_id", "body", "text", "grams", "starts", "windows", "crowded")
            for doc_id, body, text, *lists in zip(*(batch.column(c).to_pylist() for c in names)):
                for gram, a, n, crowded in zip(*lists):
                    if crowded:
                        pieces = ((s, text[s : s + length]) for s in range(a, a + n))
                        out += [(gram, doc_id, body, s, None, hashlib.blake2b(x, digest_size=16).digest()) for s, x in pieces]
                    else:
                        out.append((gram, doc_id, body, a, text[a : a + n + length - 1], None))
                if len(out) > 20_000:
                    yield emit(_READ, **dict(zip(_READ.names, zip(*out))))
                    out = []
            if out:
                yield emit(_READ, **dict(zip(_READ.names, zip(*out))))

    return read


def _later_windows(windows: DataFrame, scratch: Scratch, length) -> DataFrame:
    """Ranges of all windows (doc_id, body, start, window) but the first of each digest.

    The first places come from a partial aggregate and are joined back to the windows, so
    that a window that a third of all documents hold is a row per task in the one, and a
    skewed join in the other.
    """
    place = F.struct("doc_id", "body", "start")
    firsts = windows.groupBy("window").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = scratch.save(firsts.select("window", "first"), "firsts")
    later = windows.join(firsts, "window").where(~place.eqNullSafe(F.col("first")))
    return later.select("doc_id", "body", F.col("start").alias("a"), (F.col("start") + length).alias("b"))


def merged(ranges):
    """Overlapping or touching ``(a, b)`` joined, in order."""
    out = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def repeated_ranges(
    docs: DataFrame, scratch: Scratch, length=LENGTH, gram=GRAM, crowd=2000, most=20_000, block=CUT
) -> DataFrame:
    """Byte ranges ``(doc_id, body, a, b)`` that are to be removed; they may overlap.

    ``docs`` has doc_id, body (from ``_plain``) and text (bytes). Where over ``crowd``
    different fragments agree beside a gram, or over ``most`` meet at it, their windows are
    told apart by a 128-bit digest of each instead of being sorted, so no task sorts an
    unbounded group.
    """
    kinds = "doc_id long, body long, gram long, digest long, left int, right int, start int, windows short"
    all_of = scratch.save(docs.mapInArrow(_cut(length, gram, block), kinds), "fragments")
    shared = scratch.save(
        all_of.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "shared"
    )
    hits = scratch.save(all_of.join(shared, "gram", "left_semi"), "hits")
    scratch.drop("fragments", "shared")
    place = F.struct("doc_id", "body", "start")
    classes = scratch.save(
        hits.groupBy("gram", "digest", "left", "right", "windows").agg(
            F.min(place).alias("first"), F.count("*").alias("n")
        ),
        "classes",
    )
    copies = (
        hits.join(classes.where("n > 1").select("gram", "digest", "first"), ["gram", "digest"])
        .where(~place.eqNullSafe(F.col("first")))
        .select(
            "doc_id",
            "body",
            F.col("start").cast("long").alias("a"),
            (F.col("start") + F.col("windows") + length - 1).cast("long").alias("b"),
        )
    )
    # fragments of other content that agree with a class on one side of the gram
    sides = F.array(
        *[F.struct(F.lit(s).alias("side"), F.col(s).alias("context")) for s in ("left", "right")]
    )
    met = (
        classes.select("gram", F.inline(sides))
        .where("context <> 0")
        .groupBy("gram", "side", "context")
        .agg(F.count("*").alias("k"))
        .where("k > 1")
        .select("gram", "side", "context", "k")
    )
    met = scratch.save(met, "met")
    crowded = (F.max("k") > crowd) | (F.sum("k") > most)
    crowds = met.groupBy("gram").agg(crowded.alias("crowded"))
    wanted = (
        classes.select("gram", "digest", "first", "windows", F.inline(sides))
        .join(met, ["gram", "side", "context"])
        .groupBy("gram", "digest")
        .agg(F.first("first").alias("first"), F.first("windows").alias("windows"))
        .join(crowds, "gram")
        .groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.body").alias("body"))
        .agg(
            F.collect_list("gram").alias("grams"),
            F.collect_list("first.start").alias("starts"),
            F.collect_list("windows").alias("windows"),
            F.collect_list("crowded").alias("crowded"),
        )
    )
    read = scratch.save(_with(docs, wanted, "inner").mapInArrow(_read_fragments(length), _READ_SQL), "read")
    found = (
        read.where("window IS NULL")
        .drop("window")
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_sort_fragments(length), "doc_id long, body long, a long, b long")
    )
    found = scratch.save(found, "sorted")
    windows = read.where("window IS NOT NULL").select("doc_id", "body", "start", "window")
    if not crowds.where("crowded").isEmpty():
        found = found.union(_later_windows(windows, scratch, length))
    ranges = scratch.save(copies.union(found), "ranges")
    scratch.drop("hits", "classes", "met", "read", "sorted", "firsts")
    return ranges


def _with(docs, other, how):
    other = other.withColumnsRenamed({"doc_id": "__id", "body": "__body"})
    on = docs["doc_id"].eqNullSafe(F.col("__id")) & (docs["body"] == F.col("__body"))
    return docs.join(other, on, how).drop("__id", "__body")


_KEPT = pa.schema(
    [("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


def _keep(batches):
    for batch in batches:
        rows = []
        for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
            spans = merged((r["a"], r["b"]) for r in ranges or ())
            digest, at = hashlib.sha256(), 0
            for a, b in spans:
                digest.update(text[at:a])
                at = b
            digest.update(text[at:])
            rows.append((len(text), sum(b - a for a, b in spans), len(spans), digest.hexdigest()))
        out = emit(_KEPT, **dict(zip(_KEPT.names, zip(*rows) if rows else ((),) * 4)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out.columns], names=["doc_id", *_KEPT.names])


def _plain(docs, scratch):
    """doc_id, body and text as bytes; body tells documents of one id apart and is 0 elsewhere.

    Ids that stand for several texts are few as a rule, and their table then is small
    enough to be broadcast; otherwise the texts are shuffled once to meet it.
    """
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long"), body.alias("__body"), bytes_of("text").alias("text"))
    repeated = (
        rows.groupBy("doc_id")
        .agg(F.min("__body").alias("a"), F.max("__body").alias("b"))
        .where("a <> b")
        .select(F.col("doc_id").alias("__id"), F.lit(True).alias("__repeated"))
    )
    repeated = scratch.save(repeated, "repeated")
    body = F.when(F.col("__repeated"), F.col("__body")).otherwise(0)
    met = rows.join(repeated, rows["doc_id"].eqNullSafe(F.col("__id")), "left")
    return met.select("doc_id", body.alias("body"), "text")


def remove_repeats(docs: DataFrame, length=LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is each byte inside a string of ``length`` bytes that starts earlier too: in
    a document of smaller id, or earlier in the same one. A null text is empty. A null id
    comes before all others; documents of one id stand in the order of a hash of their
    text; rows that agree in id and text are one document listed twice and get the same
    result. Other columns are ignored. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    plain = _plain(docs, scratch)
    ranges = repeated_ranges(plain, scratch, length)
    lists = ranges.groupBy("doc_id", "body").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    return _with(plain, lists, "left").mapInArrow(
        _keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
