"""Best-fit packing of token sequences by exact complements.

Only the number of pieces of each length matters to the plan, and there are at most as
many lengths as a sequence has places. Sums of single lengths, pairs and triples are
looked up for combinations that fill a sequence exactly and are used as often as the
counts allow; what is left goes best-fit. Pieces find their place by their rank among
the pieces of their length.
"""

import base64
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tempestry.llm.common import emit
from tempestry.session import Scratch

#: Vocabulary of the registered query, and the same as ranks, which is faster to use.
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
CAPACITY = 2048


class WordCache:
    """Ids of texts as little-endian 32-bit bytes, word by word with a bounded memory.

    A space that a non-space follows always starts a token, so a text may be cut there
    and equal words give equal ids. Texts with other runs of white space around spaces
    are encoded whole. Texts that hold one of the tokens the tokenizer's file adds to its
    vocabulary, such as a mark of the end, go to the tokenizer itself.
    """

    _whole = re.compile(r" (?:\s|$)")

    def __init__(self, ranks_path, tokenizer_path, most=200_000):
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._added = re.compile("|".join(map(re.escape, added))) if added else None
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.most, self.known = most, {}

    def _encode(self, text):
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self._added and self._added.search(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if text[0] == " " or self._whole.search(text):
            return self._encode(text)
        first, *rest = text.split(" ")
        known = self.known
        if len(known) > self.most:
            known.clear()
        out = [self._encode(first)]
        for word in rest:
            found = known.get(word)
            if found is None:
                found = known[word] = self._encode(" " + word)
            out.append(found)
        return b"".join(out)


_PIECES = pa.schema(
    [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)


def cut(total, capacity=CAPACITY):
    """(start, length) of the pieces of ``total`` ids; only the first may be shorter."""
    first = total % capacity or capacity
    return [(0, first)] + [(a, capacity) for a in range(first, total, capacity)]


def token_pieces(docs: DataFrame, ranks_path, tokenizer_path, capacity=CAPACITY, key="doc_id") -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32.

    The ids of a text, then id 0; a null text is empty and gives the id 0 alone.
    """
    kind = docs.schema[key].dataType.simpleString()

    def pieces(batches):
        cache = WordCache(ranks_path, tokenizer_path)
        for batch in batches:
            rows, owner = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = cache.ids(text or "") + b"\0\0\0\0"
                for k, (a, n) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((k, a, n, zlib.crc32(ids[4 * a : 4 * (a + n)])))
                    owner.append(i)
            columns = zip(*rows) if rows else ((),) * 4
            out = emit(_PIECES, **dict(zip(_PIECES.names, columns)))
            keys = batch.column(0).take(pa.array(owner, type=pa.int64()))
            yield pa.RecordBatch.from_arrays([keys, *out.columns], names=[key, *_PIECES.names])

    return docs.select(key, "text").mapInArrow(
        pieces, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long"
    )


def plan_sequences(counts, capacity=CAPACITY):
    """Patterns ``(times, lengths)`` that use every piece of ``counts`` {length: number}.

    Every pattern's lengths sum to at most ``capacity``. The number of patterns depends on
    the number of lengths, not on the number of pieces.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, number in counts.items():
        left[length] += number
    patterns = []

    def use(*lengths):
        need = {n: lengths.count(n) for n in lengths}
        times = min(int(left[n]) // k for n, k in need.items())
        if times > 0:
            for n, k in need.items():
                left[n] -= times * k
            patterns.append((times, list(lengths)))

    use(capacity)
    for a in range(capacity - 1, (capacity - 1) // 2, -1):
        if left[a] and left[capacity - a]:
            use(a, capacity - a)
    for a in range(capacity - 2, (capacity - 1) // 3, -1):
        rest = capacity - a
        high = min(a, rest - 1)
        low = (rest + 1) // 2
        if left[a] and high >= low:
            b = np.arange(low, high + 1)
            for b in b[(left[b] > 0) & (left[rest - b] > 0)].tolist():
                if not left[a]:
                    break
                use(a, b, rest - b)
    open_bins = [[] for _ in range(capacity + 1)]  # by free space: [times, lengths]
    for length in range(capacity, 0, -1):
        number, room = int(left[length]), length
        while number and room <= capacity:
            if not open_bins[room]:
                room += 1
                continue
            times, lengths = open_bins[room].pop()
            taken = min(times, number)
            if times > taken:
                open_bins[room].append((times - taken, lengths))
            open_bins[room - length].append((taken, [*lengths, length]))
            number -= taken
        if number:
            each = capacity // length
            if number // each:
                open_bins[capacity - each * length].append((number // each, [length] * each))
            if number % each:
                open_bins[capacity - number % each * length].append((1, [length] * (number % each)))
    return patterns + [b for bins in open_bins for b in bins]


def _places(patterns):
    """The plan as sorted arrays: from (length, rank) on, first sequence and offset."""
    used, rows, sequence = {}, [], 0
    for times, lengths in patterns:
        offset = 0
        for length in lengths:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, offset))
            used[length] = rank + times
            offset += length
        sequence += times
    rows.sort()
    return [np.array(c, dtype=np.int64) for c in (zip(*rows) if rows else ((),) * 4)]


_PLACED = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack_documents(
    docs: DataFrame, ranks_path=None, capacity=CAPACITY, key="doc_id", tokenizer_path=None
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    Documents of more than ``capacity`` ids are cut into pieces of that length, the first
    of which may be shorter; no other document is cut. Sequences hold at most ``capacity``
    ids without gaps. Null and empty texts are pieces of length 1. Null and repeated keys
    are rows like any other, other columns are ignored. No rows give no rows.
    """
    spark = docs.sparkSession
    ranks_path = ranks_path or public_tokenizers.path(RANKS)
    tokenizer_path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    scratch = Scratch(spark)
    pieces = scratch.save(
        token_pieces(docs, ranks_path, tokenizer_path, capacity, key).withColumn("part", F.spark_partition_id()),
        "pieces",
    )
    parts = scratch.save(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "parts")
    counts = dict(parts.groupBy("length").agg(F.sum("n")).collect())  # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(_places(plan_sequences(counts, capacity)))
    upto = F.sum("n").over(Window.partitionBy("length").orderBy("part"))
    before = parts.select("length", "part", (upto - F.col("n")).alias("before"))
    order = Window.partitionBy("length", "part").orderBy(key, "piece")
    ranked = pieces.join(before, ["length", "part"]).withColumn(
        "rank", F.col("before") + F.row_number().over(order) - 1
    )
    columns = [key, *_PIECES.names]
    kinds = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in columns)

    def place(batches):
        lengths, ranks, sequences, offsets = plan.value
        keys = (lengths << 44) + ranks
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("rank"))
            at = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            out = emit(_PLACED, sequence_id=sequences[at] + rank - ranks[at], offset=offsets[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *out.columns], names=[*columns, *_PLACED.names]
            )

    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")
