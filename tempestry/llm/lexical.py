"""Ranked lexical search by range-maximum tables over posting lists.

Documents are dealt into buckets of bounded size. In a bucket each term has a posting list
in document order with a sparse table, which answers where the largest impact of any range
stands. A query keeps intervals of documents with the sum of these answers over its terms,
which no document in the interval can exceed. The intervals of the largest bounds are split
first, each at the document that gives its largest impact; that document is scored exactly,
the two parts get bounds of their own, and intervals below the k-th best score are left.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempestry.llm.common import bytes_of, emit
from tempestry.session import Scratch

#: Bytes that belong to terms stand for themselves, A-Z for a-z, all others part terms.
_FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)
_SLOT_BITS = 20

_COUNTED = pa.schema(
    [("uid", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.binary())), ("counts", pa.list_(pa.int64()))]
)
_COUNTED_SQL = "uid long, id long, n long, terms array<binary>, counts array<long>"
_FOUND = pa.schema([("item", pa.int64()), ("doc_id", pa.int64()), ("uid", pa.int64()), ("score", pa.int64())])


def terms_of(text: bytes) -> list:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(_FOLD).split()


def _slot(term):
    return zlib.crc32(term) >> (32 - _SLOT_BITS)


def _counter(wanted):
    """Rows (id, text) to rows with term counts, numbered by task and place.

    ``wanted`` tells by slot which terms to keep; None keeps all.
    """

    def run(batches):
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms_of(text)
                counts = Counter(found)
                if wanted is not None:
                    counts = {t: c for t, c in counts.items() if wanted[_slot(t)]}
                rows.append((uid, key, len(found), list(counts), list(counts.values())))
                uid += 1
            if rows:
                names = _COUNTED.names
                yield emit(_COUNTED, **{c: list(v) for c, v in zip(names, zip(*rows))})

    return run


def count_terms(df: DataFrame, key: str, text: str = "text", wanted=None) -> DataFrame:
    """A row per row of ``df``: uid, id (``key``), n (terms with repeats), terms, counts."""
    return df.select(F.col(key).cast("long"), bytes_of(text)).mapInArrow(_counter(wanted), _COUNTED_SQL)


def _wanted_slots(items: DataFrame) -> bytes:
    """Which of 2^20 slots hold a term of any item: at most that many numbers, however many items."""
    slots = items.select(F.explode("terms").alias("t")).select(
        F.shiftright(F.crc32("t"), 32 - _SLOT_BITS).alias("s")
    )
    flags = bytearray(1 << _SLOT_BITS)
    for row in slots.distinct().collect():
        flags[row.s] = 1
    return bytes(flags)


class Postings:
    """Posting lists of one bucket: impacts in document order, and their sparse tables."""

    def __init__(self, terms, docs, impacts, n_docs):
        """``terms`` (Arrow, any order), ``docs`` (ordinals) and ``impacts`` run in parallel."""
        coded = terms.dictionary_encode()
        self.code = {t: i for i, t in enumerate(coded.dictionary.to_pylist())}
        self.width = n_docs + 1
        keys = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * self.width + docs
        order = np.argsort(keys, kind="stable")
        self.keys, self.impacts = keys[order], impacts[order]
        longest = np.bincount(self.keys // self.width).max() if len(keys) else 1
        levels = [np.arange(len(keys), dtype=np.int32)]
        while 2 << (len(levels) - 1) <= longest:
            last, step = levels[-1], 1 << (len(levels) - 1)
            right = np.concatenate([last[step:], last[-step:]])
            levels.append(np.where(self.impacts[right] > self.impacts[last], right, last))
        self.table = np.stack(levels)

    def largest(self, lo, hi):
        """Places of the largest impacts in the ranges lo to hi, none of them empty."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        a, b = self.table[level, lo], self.table[level, hi - (1 << level)]
        return np.where(self.impacts[b] > self.impacts[a], b, a)

    def _bounds(self, lo, hi, weights):
        """For intervals by their ranges per term: bound, and the document to split at."""
        full = hi > lo
        place = np.zeros(lo.shape, dtype=np.int64)
        place[full] = self.largest(lo[full], hi[full])
        value = np.where(full, self.impacts[place] * weights, 0)
        most = place[value.argmax(0), np.arange(lo.shape[1])]
        return value.sum(0), self.keys[most] % self.width

    def search(self, terms, weights, k, least=1, batch=128):
        """The best ``k`` documents as (score, ordinal), and how many were scored.

        Scores below ``least`` need not be found. Equal scores stand in document order.
        """
        known = [(self.code[t], w) for t, w in zip(terms, weights) if w > 0 and t in self.code]
        if not known:
            return [], 0
        codes, weights = (np.array(x, dtype=np.int64)[:, None] for x in zip(*known))
        lo = np.searchsorted(self.keys, codes * self.width)
        hi = np.searchsorted(self.keys, (codes + 1) * self.width)
        bound, split = self._bounds(lo, hi, weights)
        best, seen = [], 0
        while len(bound):
            if len(best) == k:
                least = max(least, best[-1][0])
            stay = bound >= least
            if not stay.all():
                lo, hi, bound, split = lo[:, stay], hi[:, stay], bound[stay], split[stay]
                if not len(bound):
                    break
            first = np.argpartition(-bound, batch)[:batch] if len(bound) > batch else np.arange(len(bound))
            docs, left, right = split[first], lo[:, first], hi[:, first]
            seen += len(docs)
            point = codes * self.width + docs
            place = np.searchsorted(self.keys, point)
            here = self.keys[np.minimum(place, len(self.keys) - 1)] == point
            gains = np.where(here, self.impacts[np.minimum(place, len(self.keys) - 1)], 0) * weights
            scores = gains.sum(0)
            best += [(int(s), int(d)) for s, d in zip(scores, docs) if s >= least]
            best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
            lo_new = np.concatenate([left, place + here], axis=1)
            hi_new = np.concatenate([place, right], axis=1)
            some = (hi_new > lo_new).any(0)
            lo_new, hi_new = lo_new[:, some], hi_new[:, some]
            bound_new, split_new = self._bounds(lo_new, hi_new, weights)
            rest = np.ones(len(bound), dtype=bool)
            rest[first] = False
            lo = np.concatenate([lo[:, rest], lo_new], axis=1)
            hi = np.concatenate([hi[:, rest], hi_new], axis=1)
            bound = np.concatenate([bound[rest], bound_new])
            split = np.concatenate([split[rest], split_new])
        return best, seen


def _postings(tables, n_all, l_all):
    """Index of a bucket from its document rows, with their ids and uids in ordinal order."""
    table = pa.concat_tables(tables).combine_chunks()
    ids, uids = table.column("id").to_pylist(), table.column("uid").to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, uids[i]))
    table = table.take(pa.array(order, type=pa.int64())).combine_chunks()
    terms, counts = table.column("terms").combine_chunks(), table.column("counts").combine_chunks()
    sizes = np.diff(terms.offsets.to_numpy())
    docs = np.repeat(np.arange(len(order)), sizes)
    tf = counts.flatten().to_numpy()
    m = 100 - 90 + (90 * table.column("n").to_numpy() * n_all) // l_all
    impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * m[docs])
    index = Postings(terms.flatten(), docs, impacts, len(order))
    return index, [ids[i] for i in order], [uids[i] for i in order]


def _searcher(k, n_all, l_all, remembered):
    """Rows sorted by bucket and kind, documents before items, to the bucket's best rows.

    Scores that an item reached in earlier buckets of the task are a bound for later ones.
    """

    def run(batches):
        now, tables, index, ids, uids = None, [], None, [], []
        reached = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            at = table.column("bucket").to_numpy() * 2 + table.column("kind").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1), len(at)]
            for start, end in zip(cuts, cuts[1:]):
                bucket, kind = divmod(int(at[start]), 2)
                if bucket != now:
                    now, tables, index = bucket, [], None
                part = table.slice(start, end - start)
                if kind == 0:
                    tables.append(part)
                    continue
                if not tables:
                    continue
                if index is None:
                    index, ids, uids = _postings(tables, n_all, l_all)
                rows = []
                for item, terms, weights in zip(*(part.column(c).to_pylist() for c in ("uid", "terms", "counts"))):
                    earlier = reached.get(item, [])
                    least = earlier[-1] if len(earlier) == k else 1
                    best, _ = index.search(terms, weights, k, least)
                    rows += [(item, ids[d], uids[d], s) for s, d in best]
                    if item in reached or len(reached) < remembered:
                        reached[item] = sorted(earlier + [s for s, _ in best], reverse=True)[:k]
                if rows:
                    yield emit(_FOUND, **{c: list(v) for c, v in zip(_FOUND.names, zip(*rows))})

    return run


def search(docs: DataFrame, items: DataFrame, k=10, bucket_docs=2048, remembered=10_000) -> DataFrame:
    """The best ``k`` documents of each item: item_id, rank, doc_id, score.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored.
    Null and empty texts have no terms: such documents count nowhere and are not found, such
    items give no rows, nor do items whose terms no document has. Equal scores stand by
    ascending doc_id, null last. Rows that repeat an id are documents, or items, of their own.
    Either table empty gives no rows.

    Only terms whose slot some item uses are kept; df and the join of weights are by the
    terms themselves. Each item meets each bucket, which is what a set of queries against all
    rows costs; a bucket of about ``bucket_docs`` documents is all that a task holds.
    ``remembered`` bounds for how many items a task keeps reached scores, which spares work only.
    """
    scratch = Scratch(docs.sparkSession)
    asked = scratch.save(count_terms(items, "item_id"), "items")
    counted = scratch.save(count_terms(docs, "doc_id", wanted=_wanted_slots(asked)).where("n > 0"), "counted")
    n_all, l_all = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).head()
    wanted = asked.select("uid", F.explode("terms").alias("term"))
    df = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.floor(1000 * F.ln((2 * F.lit(n_all) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = wanted.join(df, "term").select("uid", "term", weight.alias("weight"))
    pair = F.collect_list(F.struct("term", "weight"))
    weighed = scratch.save(weighed.groupBy("uid").agg(pair.alias("pairs")), "weighed")
    buckets = max(1, -(-n_all // bucket_docs))
    asking = weighed.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))).alias("bucket"), F.lit(1).alias("kind"),
        "uid", F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("n"),
        F.col("pairs.term").alias("terms"), F.col("pairs.weight").alias("counts"),
    )
    dealt = counted.where(F.size("terms") > 0).select(
        F.pmod(F.xxhash64("uid"), F.lit(buckets)).alias("bucket"), F.lit(0).alias("kind"), *counted.columns
    )
    found = (
        dealt.unionByName(asking)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "kind")
        .mapInArrow(_searcher(k, n_all, l_all, remembered), "item long, doc_id long, uid long, score long")
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "uid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = asked.select(F.col("uid").alias("item"), F.col("id").alias("item_id"))
    return ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
