"""Minimum bin slack: the plan against brute force, the rows against the texts."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from kassa.llm import slack_packing
from kassa.llm.common import table
from kassa.llm.queries import bpe_encoder, op11_min_slack_packing

pytest.importorskip("public_tokenizers")


def sums(counts, size):
    """All sums that some multiset of the counts reaches."""
    found = {0}
    for x, n in counts.items():
        found = {s + x * i for s in found for i in range(n + 1) if s + x * i <= size}
    return found


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 40), st.dictionaries(st.integers(1, 40), st.integers(1, 5), min_size=1, max_size=6))
def test_window_has_least_slack(size, counts):
    counts = {x: n for x, n in counts.items() if x <= size}
    if not counts:
        return
    sub = slack_packing.SubsetSums(size)
    sub.update({x: 1 for x in range(1, size + 1)})  # another state before
    sub.update(counts)
    window, longest = sub.fullest(), max(counts)
    assert all(n <= counts[x] for x, n in window.items()) and window[longest]
    rest = {x: n - (x == longest) for x, n in counts.items()}
    assert sum(x * n for x, n in window.items()) == longest + max(s for s in sums(rest, size - longest))


def unrolled(plan):
    """(origin, number) -> [(start, length, bin, offset)]"""
    out = defaultdict(list)
    for r in plan.itertuples():
        for i in range(r.n):
            t = r.skip + i
            out[r.origin, r.first + i].append((r.start, r.length, r.bin + t // r.each, r.offset + t % r.each * r.length))
    return out


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 64), st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=9))
def test_plan_is_gapless_and_unpadded(size, counts):
    counts = {x: n for x, n in counts.items() if x <= size}
    plan = slack_packing.minimum_bin_slack(counts, size)
    pieces, bins = unrolled(plan), defaultdict(list)
    assert set(pieces) == {(x, i) for x, n in counts.items() for i in range(n)}
    for (length, _), parts in pieces.items():
        at = 0
        for start, n, b, offset in sorted(parts):
            assert start == at
            at += n
            bins[b].append((offset, n))
        assert at == length
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == size or at & (at - 1) == 0  # no padding
    lengths = np.array([x for x, _ in pieces], np.int64)
    numbers = np.array([i for _, i in pieces], np.int64)
    got = defaultdict(list)
    for piece, *part in zip(*[c.tolist() for c in slack_packing.Places(plan)(lengths, numbers)]):
        got[int(lengths[piece]), int(numbers[piece])].append(tuple(part))
    assert {k: sorted(v) for k, v in pieces.items()} == dict(got)


def test_plan_does_not_grow_with_the_documents():
    plans = [slack_packing.minimum_bin_slack({x: n * (x % 7 + 1) for x in range(1, 257)}, 256) for n in (100, 100_000)]
    assert len(plans[1]) < 2 * len(plans[0]) + 1000


def test_query_against_texts(spark):
    """Every id in one piece, in order; the right checksums; no padding."""
    d = "/root/testdata/sf0.001"
    encode = bpe_encoder()()
    rows = op11_min_slack_packing(spark, d).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    docs = table(spark, d, "documents").select("doc_id", "text").collect()
    assert {r.doc_id for r in docs} == set(pieces)
    for doc in docs:
        ids, at = np.array(encode(doc.text or "") + [1], "<u4"), 0
        for r in sorted(pieces[doc.doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at == 2048 or at & (at - 1) == 0
    assert len(bins) <= sum(r.length for r in rows) // 2048 + 11


def test_edges(spark):
    schema = "doc_id long, text string, length string, ids string, part string"
    rows = [(1, None, "a", "b", "c"), (1, "", None, None, None), (None, "word " * 5000, "x", "y", "z"), (4, "<|endoftext|>", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    got = slack_packing.pack(docs, bpe_encoder(), with_ids=True).collect()
    assert [(r.length, list(np.frombuffer(r.ids, "<u4"))) for r in got if r.doc_id == 1] == [(1, [1]), (1, [1])]
    whole = sorted((r.start, r.ids) for r in got if r.doc_id is None)
    ids = np.array(bpe_encoder()()("word " * 5000) + [1], "<u4").tobytes()
    assert b"".join(bytes(x) for _, x in whole) == ids
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in got)
    empty = slack_packing.pack(docs.limit(0), bpe_encoder(), with_ids=False)
    assert empty.count() == 0 and empty.columns[:3] == ["doc_id", "start", "length"]
