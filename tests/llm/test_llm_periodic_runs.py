"""Periodic runs against brute force, whole and word by word."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from kassa.llm import periodic_runs
from kassa.llm.common import table
from kassa.llm.queries import op12_periodic_runs, planted


def brute(words, least, exponent):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            a = i
            while i < n and words[i] == words[i - q]:
                i += 1
            if i - a + q >= max(least, exponent * q) and i > a:
                found.append((a - q, i - a + q, q))
            i += 1
    inside = lambda r, s: s[0] <= r[0] and r[0] + r[1] <= s[0] + s[1] and s[2] < r[2] and r[2] % s[2] == 0
    return sorted((r for r in found if not any(inside(r, s) for s in found)), key=lambda r: (r[0], r[2]))


def texts(rng, n):
    words = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(n)]
    for _ in range(rng.randrange(5)):
        a, p = rng.randrange(max(1, n)), rng.randint(1, max(1, n // 4))
        for i in range(a + p, min(n, a + p * rng.randint(2, 7) + rng.randint(0, p))):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("least, exponent", [(24, 3), (2, 2), (6, 2), (10, 4)])
def test_runs_against_brute_force(least, exponent):
    rng = random.Random(least * 10 + exponent)
    many = [texts(rng, rng.randrange(150)) for _ in range(400)]
    want = [brute(w, least, exponent) for w in many]
    assert periodic_runs.runs_of_each(many, least, exponent) == want
    for words, runs in zip(many, want):
        catcher, i = periodic_runs.RunCatcher(least, exponent), 0
        while i < len(words):
            n = rng.choice([1, 1, 2, 5, 60])
            catcher.append(np.array(words[i:i + n], np.int64))
            i += n
            if rng.random() < 0.05:  # what is known at any time is that of the words so far
                assert catcher.runs() == brute(words[:i], least, exponent)
        assert catcher.runs() == runs


def test_equal_fingerprints_change_nothing(monkeypatch):
    """Fingerprints only propose."""
    monkeypatch.setattr(periodic_runs, "mixed", lambda x: x & np.uint64(1))
    rng = random.Random(4)
    many = [texts(rng, rng.randrange(120)) for _ in range(150)]
    assert periodic_runs.runs_of_each(many, 6, 2) == [brute(w, 6, 2) for w in many]


def test_long_texts():
    assert periodic_runs.find_runs([0] * 300_000) == [(0, 300_000, 1)]
    rng = random.Random(1)
    period, head = [rng.randrange(9) for _ in range(4001)], [10 + i for i in range(1000)]
    assert [r for r in periodic_runs.find_runs(head + period * 5 + [99] + head) if r[2] > 30] == [(1000, 5 * 4001, 4001)]


def expected(doc_id, text):
    words = periodic_runs.words_of(text or "")
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words, 24, 3)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r) for r in op12_periodic_runs(spark, d).collect()}
    docs = table(spark, d, "documents").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    short = [r for r in docs if len((r.text or "").split()) < 700]
    assert len(short) > 150 and sum(got[r.doc_id][1] > 0 for r in short) > 5
    for r in short:
        assert got[r.doc_id] == expected(r.doc_id, r.text)


def test_edges(spark):
    rows = [(1, None, "x", 1), (2, "", None, None), (3, "a " * 24, None, None), (3, "a " * 24, None, None), (None, "b c\x0b" * 30, "y", 2)]
    got = periodic_runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")).collect()
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.kept_text) for r in got) == [
        ("1", 0, [], ""), ("2", 0, [], ""), ("3", 24, [(0, 24, 1)], "a"), ("3", 24, [(0, 24, 1)], "a"),
        ("None", 30, [(0, 30, 1)], "b c")]
    assert planted(None, [b"a"]) == [b"a"]
    assert periodic_runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
