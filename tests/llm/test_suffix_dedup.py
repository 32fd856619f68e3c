import hashlib
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tempestry.llm import suffix_dedup
from tempestry.session import Scratch
from tests.llm.cases import SF, awkward, documents, empty, prose


def slow(rows, length):
    """Brute force over every window; rows of one id and text count as one document."""
    order = sorted({(d is not None, d or 0, h, t) for d, h, t in rows})
    seen, result = set(), {}
    for known, d, h, t in order:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            window = t[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        result[known, d, h] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((d, *result[d is not None, d or 0, h]) for d, h, t in rows), key=str)


def check(docs, length=100):
    plain = suffix_dedup._plain(docs, Scratch(docs.sparkSession)).collect()
    got = [tuple(r) for r in suffix_dedup.remove_repeats(docs, length).collect()]
    assert sorted(got, key=str) == slow([(r.doc_id, r.body, bytes(r.text)) for r in plain], length)


def test_tables(spark):
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_awkward_rows(spark):
    check(awkward(spark))
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_shared_passages_periods_and_overlaps(spark):
    r, passage = random.Random(3), prose(9, 40)
    rows = [(i, prose(100 + i, r.randint(0, 30)) + passage[: 99 + i % 4] + prose(200 + i, 20)) for i in range(40)]
    rows += [(50, "x" * 400), (51, "xy" * 90), (52, "y" + "xy" * 60), (53, "abcdefg" * 60), (54, "z" * 99), (55, "z" * 100)]
    rows += [(56, passage + passage), (57, passage), (58, (passage + "é") * 3), (-1, passage[10:200])]
    check(documents(spark, rows))


def test_crowded_grams_are_dealt_by_window(spark):
    passage = prose(7, 12)[:60]
    rows = [(i, prose(i, 10) + passage + prose(1000 + i % 7, 10)) for i in range(60)]
    docs = documents(spark, rows)
    plain = suffix_dedup._plain(docs, Scratch(spark))
    few = suffix_dedup.repeated_ranges(plain, Scratch(spark), crowd=3)
    many = suffix_dedup.repeated_ranges(plain, Scratch(spark), crowd=2000)
    total = suffix_dedup.repeated_ranges(plain, Scratch(spark), crowd=2000, most=5)

    def covered(ranges):
        return {(r.doc_id, i) for r in ranges.collect() for i in range(r.a, r.b)}

    assert covered(few) == covered(many) == covered(total)
    check(docs)


def test_texts_longer_than_a_block_are_cut(spark):
    passage = prose(11, 60)
    rows = [(i, prose(300 + i, 40 * i) + passage + prose(400 + i, 70) + passage[20:]) for i in range(9)]
    rows += [(20, "q" * 1500), (21, "uvw" * 300), (22, prose(308, 320)[50:1400])]
    plain = suffix_dedup._plain(documents(spark, rows), Scratch(spark))

    def covered(block):
        found = suffix_dedup.repeated_ranges(plain, Scratch(spark), block=block).collect()
        return {(r.doc_id, i) for r in found for i in range(r.a, r.b)}

    want, seen = set(), set()
    for d, text in rows:
        for i in range(len(text) - 99):
            if text[i : i + 100] in seen:
                want.update((d, x) for x in range(i, i + 100))
            seen.add(text[i : i + 100])
    assert covered(128) == covered(333) == want


def test_places_past_the_bits_of_a_place(monkeypatch):
    """A passage past 2 ^ (bits of a place) bytes has the grams it has elsewhere."""
    monkeypatch.setattr(suffix_dedup, "_PLACE_BITS", 20)
    passage = prose(12, 200).encode()
    texts = [passage, bytes(i * i * 31 % 251 for i in range((1 << 20) + 500)) + passage]
    batch = pa.RecordBatch.from_pydict({"doc_id": [0, 1], "body": [0, 0], "text": texts})
    found = pa.Table.from_batches(suffix_dedup._cut(100, 32)([batch])).to_pylist()
    grams = [{r["gram"] for r in found if r["doc_id"] == d} for d in (0, 1)]
    assert grams[0] and grams[0] <= grams[1]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.lists(st.sampled_from(b"ab\0"), max_size=80).map(bytes)), st.integers(1, 9), st.randoms())
def test_two_stage_order_is_the_order_of_the_suffixes(text, depth, r):
    starts = np.array(sorted(r.sample(range(len(text)), r.randint(0, len(text)))), dtype=np.int64)
    for some in (starts, np.arange(len(text))):
        got = suffix_dedup.two_stage_order(text, some, depth).tolist()
        assert sorted(got) == some.tolist()
        keys = [text[i : i + depth].ljust(depth, b"\0") for i in got]
        assert keys == sorted(keys)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(b"abc"), max_size=40).map(bytes), max_size=6), st.integers(4, 9))
def test_equal_windows_share_a_gram_and_a_side(texts, length):
    grams = suffix_dedup.Grams(1000, 2, length)
    found = suffix_dedup.fragments(texts, grams)
    got, by_window = [], {}
    for gram, digest, left, right, t, start, n in zip(*(c.tolist() for c in found)):
        for i in range(start, start + n):
            got.append((t, i))
            by_window.setdefault(texts[t][i : i + length], []).append((gram, digest, left, right))
    assert sorted(got) == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - length + 1)]
    for group in by_window.values():
        gram, digest, left, right = group[0]
        for other in group[1:]:
            assert other[0] == gram
            assert other[1] == digest or (left and other[2] == left) or (right and other[3] == right)
