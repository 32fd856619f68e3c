import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tempestry.llm import packing
from tests.llm.cases import SF, awkward, documents, empty

RANKS = public_tokenizers.path(packing.RANKS)
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a\n  b", "a \nb", "x\n \ny", "it's  'tis 'll", "\x1c a \x1cb", "\xa0 é  z", "<|endoftext|> x", "a <|endoftext|> b", "a<|endoftext|><|endoftext|>\n  c d", "<|endoftext|", "x <|endoftext |> y",
       "12 345,6", "tab\t tab", "　 wide", "日本語 テキスト", "a\r\n\r\n b", "😀 😀😀", "x" * 3000, " ." * 50, "don't can't"]


def test_ids_are_those_of_the_tokenizer(tokenizer):
    cache, r = packing.WordCache(RANKS, TOKENIZER, most=50), random.Random(1)
    parts = [" ", "\n", "a", "b'", "s ", "é", "1", ".", "\t", "\xa0", "the"]
    texts = ODD + ["".join(r.choice(parts) for _ in range(40)) for _ in range(800)]
    texts += ["".join(r.choice([*parts, "<|endoftext|>", "<|end", "oftext|>"]) for _ in range(20)) for _ in range(400)]
    for text in texts:
        assert np.frombuffer(cache.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def check(docs, tokenizer):
    got = packing.pack_documents(docs).collect()
    want = Counter()
    for r in docs.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        n = len(ids)
        cuts = [0] + list(range(n % 2048 or 2048, n, 2048)) + [n]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), sum(r.length for r in got)


def test_tables(spark, tokenizer):
    used, total = check(spark.read.parquet(f"{SF}/documents.parquet"), tokenizer)
    assert used <= -(-total // 2048) + 2


def test_awkward_rows(spark, tokenizer):
    check(awkward(spark), tokenizer)
    check(documents(spark, list(enumerate(ODD))), tokenizer)
    assert packing.pack_documents(empty(spark)).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_plans_use_every_piece_and_few_sequences(seed):
    r, capacity = random.Random(seed), [16, 64, 2048][seed % 3]
    counts = {r.randint(1, capacity): r.randint(1, 10 ** (seed % 5)) for _ in range(r.randint(1, 200))}
    plan = packing.plan_sequences(counts, capacity)
    used = Counter()
    for times, lengths in plan:
        assert times > 0 and sum(lengths) <= capacity
        for n in lengths:
            used[n] += times
    assert used == Counter(counts)
    total, big = sum(n * c for n, c in counts.items()), sum(c for n, c in counts.items() if 2 * n > capacity)
    assert sum(t for t, _ in plan) <= max(-(-total // capacity) * 1.25 + 2, big + 1)


def test_exact_fillings_come_before_best_fit():
    plan = packing.plan_sequences({10: 2, 6: 2, 5: 1, 4: 1, 1: 1, 7: 1, 3: 1}, 10)
    assert [(t, sorted(lengths)) for t, lengths in plan[:3]] == [(2, [10]), (1, [3, 7]), (1, [4, 6])]
    assert sum(t for t, _ in plan) == 6
