"""Interpolated modified Kneser-Ney bigram model in memory-mapped hash arrays.

Tasks count the word pairs of their training documents and send them on by shard, sorted
and packed. Each shard adds its parts and writes its pairs as a sorted array of hashes
with a parallel array of counts; what it knows of single words (how often, after how
many words, before how many, and how many of those pairs came once, twice or more) goes
to word shards, which write arrays of the same kind. Scoring workers map all arrays into
memory and look up whole batches of sorted hashes. Neither driver nor task ever holds
the model.
"""

import os
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempestry.llm.common import bytes_of, emit, groups_of
from tempestry.session import Scratch

WORD_BITS = 48
_END = np.uint64(1)  # hashes of words have their lowest bits free of 0 and 1
_START = np.uint64(0)
#: Shards over which the pairs of one first word spread, so that no word fills a shard.
SPREAD = 16
#: Tokens counted at once by a task, and scored at once by a worker.
BLOCK = 2_000_000


def folder_of(uri):
    """A folder of the shared file system as the path under which it is mounted."""
    parts = urlparse(uri)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory mapping needs a mounted shared folder, not {parts.scheme}://")
    return parts.path


def word_hashes(text: bytes):
    """48-bit hashes of the words of a text in A-Z lower case, then the end."""
    words = text.lower().split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    h >>= np.uint64(64 - WORD_BITS)
    return np.append(np.maximum(h, np.uint64(2)), _END)


def pair_keys(first, second):
    """One 64-bit hash for each pair of words."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def pair_shards(first, second, shards):
    x = (first * np.uint64(0x94D049BB133111EB)) >> np.uint64(20)
    return ((x + (second % np.uint64(SPREAD))) % np.uint64(shards)).astype(np.int64)


def word_shards(words, shards):
    """Shards that are ranges of the hash."""
    return (words * np.uint64(shards) >> np.uint64(WORD_BITS)).astype(np.int64)


def _packed(words):
    """Hashes as six bytes each."""
    return np.ascontiguousarray(words.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpacked(data):
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view(np.uint64).ravel()


def _numbers(data, kind=np.uint32):
    return np.frombuffer(data, kind)


_PARTS = pa.schema(
    [("shard", pa.int32()), ("firsts", pa.binary()), ("sizes", pa.binary()), ("seconds", pa.binary()), ("counts", pa.binary())]
)


def _counted(first, second, shards):
    """One packed row per shard with the distinct pairs of a block."""
    key = pair_keys(first, second)
    _, index, counts = np.unique(key, return_index=True, return_counts=True)
    first, second = first[index], second[index]
    shard = pair_shards(first, second, shards)
    sort = np.lexsort((first, shard))
    first, second, shard, counts = first[sort], second[sort], shard[sort], counts[sort].astype(np.uint32)
    bounds = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
    rows = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        heads = np.flatnonzero(np.diff(first[a:b], prepend=first[a] + np.uint64(1)))
        sizes = np.diff(np.append(heads, b - a)).astype(np.uint32)
        rows.append(
            (int(shard[a]), _packed(first[a:b][heads]), sizes.tobytes(), _packed(second[a:b]), counts[a:b].tobytes())
        )
    return emit(_PARTS, **dict(zip(_PARTS.names, zip(*rows))))


def _count_pairs(shards):
    def count(batches):
        held, tokens = [], 0

        def block():
            second = np.concatenate(held)
            first = np.empty_like(second)
            first[0] = _START
            first[1:] = np.where(second[:-1] == _END, _START, second[:-1])
            return _counted(first, second, shards)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.append(word_hashes(text))
                tokens += len(held[-1])
                if tokens >= BLOCK:
                    yield block()
                    held, tokens = [], 0
        if held:
            yield block()

    return count


def _store(folder, name, **arrays):
    """Write arrays so that a repeated task leaves the same files."""
    for kind, values in arrays.items():
        path = os.path.join(folder, f"{name}.{kind}.npy")
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            np.save(out, values)
        os.replace(part, path)


def _sums(keys, *columns):
    """Distinct keys, sorted, with the sums of each column."""
    sort = np.argsort(keys, kind="stable")
    keys = keys[sort]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    return keys[heads], *(np.add.reduceat(c[sort], heads) if len(keys) else c for c in columns)


_WORD_PARTS = pa.schema(
    [("shard", pa.int32()), ("as_first", pa.bool_()), ("words", pa.binary()), ("numbers", pa.binary()), ("kinds", pa.binary())]
)
_GLOBAL = pa.schema([("of_pairs", pa.bool_()), ("numbers", pa.list_(pa.int64()))])


def _histogram(counts):
    """How many are 1, 2, 3, 4, and how many there are."""
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(counts)]


def _write_pairs(folder, word_parts):
    def write(batches):
        for table in groups_of(batches, ("shard",)):
            shards = np.array(table.column("shard"))
            for shard in np.unique(shards).tolist():
                rows = table.filter(pa.array(shards == shard))
                firsts, seconds, counts = [], [], []
                for row in range(rows.num_rows):
                    sizes = _numbers(rows.column("sizes")[row].as_py())
                    firsts.append(np.repeat(_unpacked(rows.column("firsts")[row].as_py()), sizes))
                    seconds.append(_unpacked(rows.column("seconds")[row].as_py()))
                    counts.append(_numbers(rows.column("counts")[row].as_py()))
                first, second = np.concatenate(firsts), np.concatenate(seconds)
                key = pair_keys(first, second)
                sort = np.argsort(key, kind="stable")
                key, first, second = key[sort], first[sort], second[sort]
                heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
                count = np.add.reduceat(np.concatenate(counts)[sort].astype(np.int64), heads)
                first, second = first[heads], second[heads]
                kind = np.uint32 if count.max() < 1 << 32 else np.uint64
                _store(folder, f"pairs-{shard}", keys=key[heads], counts=count.astype(kind))
                yield from _word_rows(first, second, count, word_parts)
                yield emit(
                    _WORD_PARTS, shard=[-1], as_first=[False], words=[b""], kinds=[b""],
                    numbers=[np.array(_histogram(count), np.int64).tobytes()],
                )

    return write


def _word_rows(first, second, count, parts):
    one = np.ones(len(count), np.int64)
    kinds = [(count == 1).astype(np.int64), (count == 2).astype(np.int64), (count > 2).astype(np.int64)]
    rows = []
    for as_first, words, numbers in (
        (True, first, (count, *kinds)),
        (False, second, (count, one)),
    ):
        words, *sums = _sums(words, *numbers)
        shard = word_shards(words, parts)
        bounds = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard)).tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            data = np.stack([s[a:b] for s in sums]).astype(np.int64).tobytes()
            rows.append((int(shard[a]), as_first, _packed(words[a:b]), data, b""))
    yield emit(_WORD_PARTS, **dict(zip(_WORD_PARTS.names, zip(*rows))))


def _write_words(folder):
    def write(batches):
        for table in groups_of(batches, ("shard",)):
            shards = np.array(table.column("shard"))
            for shard in np.unique(shards).tolist():
                rows = table.filter(pa.array(shards == shard))
                if shard < 0:
                    sums = sum(_numbers(x.as_py(), np.int64) for x in rows.column("numbers"))
                    yield emit(_GLOBAL, of_pairs=[True], numbers=[sums.tolist()])
                    continue
                words, columns = [], []
                for row in range(rows.num_rows):
                    word = _unpacked(rows.column("words")[row].as_py())
                    data = _numbers(rows.column("numbers")[row].as_py(), np.int64).reshape(-1, len(word))
                    empty = np.zeros_like(word, dtype=np.int64)
                    as_first = rows.column("as_first")[row].as_py()
                    words.append(word)
                    columns.append(np.stack([empty, empty, *data] if as_first else [*data, *[empty] * 4]))
                word, *sums = _sums(np.concatenate(words), *np.concatenate(columns, axis=1))
                _store(folder, f"words-{shard}", keys=word, numbers=np.stack(sums, axis=1))
                seen, after = sums[0], sums[1]
                known = seen > 0
                globals_ = [int(seen.sum()), int(known.sum()), int(after.sum()), *_histogram(after[known])]
                yield emit(_GLOBAL, of_pairs=[False], numbers=[globals_])

    return write


def discounts(n1, n2, n3, n4):
    """The three discounts of modified Kneser-Ney from counts of counts.

    Where a count of counts is missing the estimate falls back on half of what it
    discounts, and it always stays within 0 and that.
    """
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    raw = (
        1 - 2 * y * n2 / n1 if n1 and n2 else 0.5,
        2 - 3 * y * n3 / n2 if n2 and n3 else 1.0,
        3 - 4 * y * n4 / n3 if n3 and n4 else 1.5,
    )
    return np.array([0.0] + [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)])


class KneserNey:
    """The trained model: a folder of arrays and a few totals."""

    def __init__(self, folder, pair_parts, word_parts, pairs, words):
        self.folder, self.pair_parts, self.word_parts = folder, pair_parts, word_parts
        self.stored = frozenset(os.listdir(folder))  # as many names as there are shards
        self.tokens, self.vocabulary, self.pairs = words[:3]
        self.high = discounts(*pairs[:4])
        self.low = discounts(*words[3:7])
        several = words[7] - sum(words[3:5])
        left = self.low[1] * words[3] + self.low[2] * words[4] + self.low[3] * several
        self.floor = left / self.pairs / (self.vocabulary + 1) if self.pairs else 1.0
        self._maps = {}

    def __getstate__(self):
        return {**self.__dict__, "_maps": {}}

    def _map(self, name):
        """A stored array, None for a shard that holds nothing.

        An array that training stored and this worker does not see is an error: without the
        shared folder every count would be 0.
        """
        if name not in self._maps:
            stored = f"{name}.npy" in self.stored
            self._maps[name] = np.load(os.path.join(self.folder, f"{name}.npy"), mmap_mode="r") if stored else None
        return self._maps[name]

    def _look_up(self, kind, values, keys, shards, width):
        """Rows of the arrays for sorted-by-shard keys, zeros for those not stored."""
        out = np.zeros((len(keys), width) if width > 1 else len(keys), dtype=np.int64)
        bounds = np.append(np.flatnonzero(np.diff(shards, prepend=-1)), len(shards)).tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            stored = self._map(f"{kind}-{shards[a]}.keys")
            if stored is None or not len(stored):
                continue
            at = np.minimum(np.searchsorted(stored, keys[a:b]), len(stored) - 1)
            hit = stored[at] == keys[a:b]
            out[a:b][hit] = self._map(f"{kind}-{shards[a]}.{values}")[at[hit]]
        return out

    def words(self, words):
        """For distinct sorted words: count, words before, count as first, ones, twos, more."""
        return self._look_up("words", "numbers", words, word_shards(words, self.word_parts), 6)

    def pair_counts(self, first, second):
        key = pair_keys(first, second)
        _, index, back = np.unique(key, return_index=True, return_inverse=True)
        first, second, key = first[index], second[index], key[index]
        shard = pair_shards(first, second, self.pair_parts)
        sort = np.lexsort((key, shard))
        counts = np.empty(len(key), np.int64)
        counts[sort] = self._look_up("pairs", "counts", key[sort], shard[sort], 1)
        return counts[back]

    def probabilities(self, first, second):
        """Count and probability of each token ``second`` after ``first``."""
        distinct, back = np.unique(np.concatenate([first, second]), return_inverse=True)
        known = self.words(distinct)
        before, word = known[back[: len(first)]], known[back[len(first) :]]
        after = word[:, 1]
        low = self.floor
        if self.pairs:
            low = np.maximum(after - self.low[np.minimum(after, 3)], 0) / self.pairs + self.floor
        count = self.pair_counts(first, second)
        total = before[:, 2]
        seen = np.maximum(total, 1)
        high = np.maximum(count - self.high[np.minimum(count, 3)], 0) / seen
        rest = before[:, 3:] @ self.high[1:] / seen
        return word[:, 0], np.where(total > 0, high + rest * low, low)


def train(docs: DataFrame, scratch: Scratch, parts=None) -> KneserNey:
    """Count all of ``docs`` (column text, bytes) and store the model in the shared folder.

    ``parts`` is the number of shards, by default the session's shuffle partitions.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(parts, (1 << 64 - WORD_BITS) - 1)
    folder = os.path.join(folder_of(scratch.root), "model")
    os.makedirs(folder, exist_ok=True)
    totals = (
        docs.select("text")
        .mapInArrow(_count_pairs(parts), "shard int, firsts binary, sizes binary, seconds binary, counts binary")
        .repartition(parts, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_write_pairs(folder, parts), "shard int, as_first boolean, words binary, numbers binary, kinds binary")
        .repartition(parts, "shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_write_words(folder), "of_pairs boolean, numbers array<long>")
    )
    sums = {True: np.zeros(5, np.int64), False: np.zeros(8, np.int64)}
    numbers = scratch.save(totals, "totals").select("of_pairs", F.posexplode("numbers").alias("i", "n"))
    for of_pairs, i, n in numbers.groupBy("of_pairs", "i").agg(F.sum("n")).collect():
        sums[of_pairs][i] = n
    return KneserNey(folder, parts, parts, sums[True].tolist(), sums[False].tolist())


_SCORES = pa.schema(
    [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def _score(model):
    def rows(batch, from_row, tokens):
        second = np.concatenate(tokens)
        first = np.empty_like(second)
        first[0] = _START
        first[1:] = np.where(second[:-1] == _END, _START, second[:-1])
        count, probability = model.probabilities(first, second)
        base = np.log10((count + 0.1) / (model.tokens + 0.1 * (model.vocabulary + 1)))
        sizes = np.array([len(t) for t in tokens])
        heads = np.cumsum(sizes) - sizes
        out = emit(
            _SCORES,
            n_tokens=sizes,
            n_known=np.add.reduceat((count > 0).astype(np.int64), heads),
            train_tokens=np.full(len(sizes), model.tokens),
            base_score=np.add.reduceat(base, heads),
            score=np.add.reduceat(np.log10(probability), heads),
        )
        own = [batch.column(c).slice(from_row, len(tokens)) for c in ("doc_id", "held_out")]
        return pa.RecordBatch.from_arrays([*own, *out.columns], names=["doc_id", "held_out", *_SCORES.names])

    def score(batches):
        for batch in batches:
            held, size, start = [], 0, 0
            for i, text in enumerate(batch.column("text").to_pylist()):
                held.append(word_hashes(text))
                size += len(held[-1])
                if size >= BLOCK // 3:
                    yield rows(batch, start, held)
                    held, size, start = [], 0, i + 1
            if held:
                yield rows(batch, start, held)

    return score


def score_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from documents whose crc32 of the id as text is no multiple of 10
    and scores all. Perplexity is ``10 ** (-score / n_tokens)``. Null and empty texts are
    one end token. A null id counts as the text '' (crc32 0, held out). Repeated rows
    count as often as they stand. With nothing to learn from, every token has the same
    probability. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    plain = docs.select("doc_id", held.alias("held_out"), bytes_of("text").alias("text"))
    model = train(plain.where(~F.col("held_out")), scratch)
    kind = docs.schema["doc_id"].dataType.simpleString()
    scores = plain.mapInArrow(
        _score(model),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    scores = scratch.save(scores, "scores")
    scratch.drop("model")
    return scores
