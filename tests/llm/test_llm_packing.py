import bisect
import random
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from kassa.llm import packing
from kassa.llm.queries import bpe_encoder

vocabularies = pytest.importorskip("public_tokenizers")


def one_by_one(lengths, size):
    """Best-fit decreasing over a sorted list of rooms: number of bins."""
    rooms, bins = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, n)
        if at == len(rooms):
            bins, room = bins + 1, size
        else:
            room = rooms.pop(at)
        if room > n:
            bisect.insort(rooms, room - n)
    return bins


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70), st.lists(st.integers(1, 70), max_size=300))
def test_plan_is_best_fit_decreasing(size, lengths):
    lengths = [min(n, size) for n in lengths]
    plan, end = packing.best_fit_decreasing(Counter(lengths), size), defaultdict(int)
    assert plan["n"].sum() == len(lengths)
    for length, rows in plan.groupby("length"):
        assert sorted(i for r in rows.itertuples() for i in range(r.first, r.first + r.n)) == list(range(lengths.count(length)))
    for r in plan.itertuples():
        for i in range(r.n):
            bin_, offset = r.bin + i // r.each, r.offset + i % r.each * r.length
            assert offset == end[bin_]  # gapless
            end[bin_] += r.length
    assert all(x <= size for x in end.values()) and len(end) == one_by_one(lengths, size)


def test_tree_finds_the_tightest():
    rng, tree, held = random.Random(1), packing.CapacityTree(100), set()
    for _ in range(3000):
        c = rng.randrange(101)
        held ^= {c}
        tree.put(c, c in held)
        least = rng.randrange(101)
        assert tree.tightest(least) == min((x for x in held if x >= least), default=None)


@cache
def encoders():
    return bpe_encoder()(), packing.json_encoder(vocabularies.path("byte_bpe_50k.json"))()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \n\t\xa0'aAé1漢\u2028\u3000sdll", max_size=60))
def test_fast_encoder_equals_the_tokenizers_library(text):
    fast, exact = encoders()
    assert fast(text) == exact(text)


def test_special_tokens_are_read_as_the_library_reads_them():
    text = "a<|endoftext|> b"
    assert bpe_encoder()()(text) == packing.json_encoder(vocabularies.path("byte_bpe_50k.json"))()(text)


def test_packed_sequences_hold_every_document(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc de") for _ in range(rng.choice([0, 3, 40, 70, 300]))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)

    def load():
        return lambda t: [b for b in t.encode()]
    packed = packing.pack(docs, load, size=64).cache()
    rows = packed.collect()
    parts = defaultdict(list)
    for r in rows:
        parts[r.doc_id].append((r.piece, r.start, r.length, np.frombuffer(r.ids, "<u4")))
        assert r.length == 64 or r.piece == 0
    for i, text in enumerate(texts):
        pieces = sorted(parts[i], key=lambda p: p[0])
        assert [p[0] for p in pieces] == list(range(len(pieces)))
        assert np.concatenate([p[3] for p in pieces]).tolist() == [*text.encode(), 0]
        assert [p[1] for p in pieces] == np.cumsum([0, *[p[2] for p in pieces]])[:-1].tolist()
    lengths = [r.length for r in rows]
    assert len({r.sequence_id for r in rows}) == one_by_one(lengths, 64)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset:r.offset + r.length].tolist() == np.frombuffer(r.ids, "<u4").tolist()
    assert sum(map(len, whole.values())) == sum(lengths)
