"""Exact, near and line dedup, and connected components, against brute force."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kassa.llm import components, exact_dedup, line_dedup, minhash

WORDS = ["".join("aeiou"[(i // 5 ** k) % 5] + "bdlnrst"[(i // 7 ** k) % 7] for k in range(4)) for i in range(3000)]


def find(parent, x):
    while parent.setdefault(x, x) != x:
        x = parent[x]
    return x


def joined(pairs, nodes=()):
    parent = {n: n for n in nodes}
    for a, b in pairs:
        a, b = sorted((find(parent, a), find(parent, b)))
        parent[b] = a
    return {n: find(parent, n) for n in list(parent)}


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1060)] + \
        [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    got = components.connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()
    want = joined([p for p in pairs if p[0] != p[1]])
    assert {r.node: r.component for r in got} == want and len(got) == len(want)


def near_copies(rng):
    texts = []
    for _ in range(60):
        base = prose(rng, rng.choice([2, 10, 60, 120]))
        texts.append(base)
        for _ in range(rng.choice([0, 0, 1, 8])):
            w = base.split()
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            texts.append("  ".join(w).upper())
    hot = prose(rng, 100).split()
    for _ in range(80):
        w = list(hot)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(100)] = rng.choice(WORDS)
        texts.append("\n".join(w))
    return texts + [None, "", "one", "ONE", "two words"]


@pytest.mark.parametrize("blocks", [(4096, 256, 1_000_000, 50_000, 256, 128), (3, 2, 200, 100, 256, 128), (3, 2, 200, 100, 3, 4), (4096, 256, 1_000_000, 50_000, 9, 5)])
def test_near_duplicates(spark, monkeypatch, blocks):
    """The same result whether hot buckets and components are cut into blocks
    or not, and met by pivots first or not."""
    for name, value in zip(("BUCKET_BLOCK", "BUCKET_SPREAD", "SET_BLOCK", "SET_SPREAD", "HOT_MEMBERS", "HOT_SLICE"), blocks):
        monkeypatch.setattr(minhash, name, value)
    texts = near_copies(random.Random(4))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs, 3, 85, 100).collect()}
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))} if w else set())
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    want = joined(links, range(len(sets)))
    assert len(links) > 300
    assert got == {i: (len(s), want[i], want[i] == i) for i, s in enumerate(sets)}


def test_pivots_leave_little_of_a_hot_group(spark):
    """Members that resemble a pivot meet the others no more: rows to compare
    grow with the group's size. A chain, of which no pivot sees much, is
    compared in blocks as a whole, so no link of it is lost."""
    n = 3000
    members = spark.range(n).selectExpr("7L as key", "id as rep", "1 as weight")
    data = lambda f: spark.createDataFrame([(i, f(i)) for i in range(n)], "rep long, data binary")

    def run(f, agree):
        near = lambda x: minhash.agreeing(minhash.rows_of(x), agree)
        links, blocks = minhash.with_pivots(members, "key", data(f), near, 4096, 256)
        rows = blocks.join(data(f), "rep").select("key", "i", "j", "rep", "class", "data").sortWithinPartitions("key", "i", "j")
        found = minhash.bucket_links(rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"), agree)
        edges = [(r.u, r.v) for r in links.union(found).collect()]
        return blocks.count(), set(joined(edges, range(n)).values())
    rows, parts = run(lambda i: bytes([1] * 9 + [i % 251]), 9)
    assert rows == 0 and parts == {0}
    rows, parts = run(lambda i: bytes([1] * 9 + [i % 251]) if i % 500 else bytes([2] * 10), 9)
    assert rows <= 2 * n and parts == {0, 1}
    rows, parts = run(lambda i: i.to_bytes(2, "big") + (i + 1).to_bytes(2, "big"), 4)
    assert rows >= n and parts == set(range(n))


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("abÉ漢 \n\t\x0b") for _ in range(5000)) + "x" * 9000 + " " + "x" * 9001
    whole = minhash.word_hashes(text)
    monkeypatch.setattr(minhash, "PIECE_BYTES", 17)
    assert whole.tolist() == minhash.word_hashes(text).tolist()
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    assert len(whole) == len(words) and len(set(whole.tolist())) == len(set(words))


def test_chunks_cover_the_text_and_follow_its_content(spark):
    rng = random.Random(6)
    text = prose(rng, 4000) + "\n" + "z" * 20_000
    shifted = "inserted " + text
    a, b = [r[0] for r in spark.createDataFrame([(text,), (shifted,)], "t string").select(exact_dedup.chunks(F.col("t"))).collect()]
    assert "".join(a) == text and "".join(b) == shifted and max(map(len, a)) <= exact_dedup.MAX_CHARS + 8
    assert len(set(a) & set(b)) > len(a) / 2


@pytest.mark.parametrize("fingerprint", [F.xxhash64, lambda c: F.length(c).cast("long") % 3])
def test_exact_dedup_verifies_fingerprints(spark, fingerprint):
    """Also with fingerprints that collide all the time."""
    rng = random.Random(7)
    texts = [prose(rng, rng.choice([1, 200, 900])) for _ in range(60)]
    texts += [rng.choice(texts) for _ in range(60)] + [None, "", " "] + [texts[0] + "x", "y" + texts[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    want = {i: (max(g), len(g), i == max(g)) for g in groups.values() for i in g}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs, fingerprint).collect()}
    assert got == want


def test_line_dedup_deletes_repeated_runs_only(spark):
    rng = random.Random(8)
    passage = [prose(rng, 20), "", prose(rng, 25), prose(rng, 18)]  # 63 words in three lines
    single = prose(rng, 55)
    docs, clean = [], []
    for i in range(40):
        own = [prose(rng, rng.choice([3, 12, 40])) for _ in range(6)] + ["All rights reserved."]
        clean.append(own)
        lines = list(own)
        if i % 3 == 0:
            at = rng.randrange(6)
            lines[at:at] = passage
        if i % 4 == 0:
            lines.insert(0, single)
        docs.append(lines)
    docs.append(docs[3])        # an exact copy
    docs.append([single] * 4)   # a text that repeats itself
    table = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(docs)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in line_dedup.dedup_lines(table).collect()}
    for i in range(40):
        first = i in (0,)
        assert got[i].text.split("\n") == (docs[i] if first else clean[i]), i
    assert got[40].text == "" and got[41].text == ""
    assert sum(s.words for s in got[3].removed_spans) == 63


def test_line_dedup_is_complete_for_whole_passages(spark):
    """Against the definition: every line of a run of 50 words or more that
    stands at an earlier place too. Nothing else is deleted, and what matches
    with an earlier passage as a whole always is."""
    rng = random.Random(9)
    pool = [[prose(rng, rng.choice([4, 9, 30])) for _ in range(rng.choice([4, 7]))] for _ in range(12)]
    docs = [[x for _ in range(rng.choice([1, 2, 3])) for x in ([prose(rng, 15)] + rng.choice(pool))] for _ in range(60)]
    table = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: r.removed_spans for r in line_dedup.dedup_lines(table).collect()}
    seen, missed, total = set(), 0, 0
    for d, lines in enumerate(docs):
        n, gone = [len(x.split()) for x in lines], set()
        fresh = []
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                if sum(n[i:j + 1]) >= 50:
                    run = tuple(lines[i:j + 1])
                    if run in seen:
                        gone |= set(range(i, j + 1))
                    fresh.append(run)
                    seen.add(run)  # later places of the same document come after this one
        cut = {i for s in got[d] for i in range(s.first, s.last + 1)}
        assert cut <= gone, d
        missed, total = missed + len(gone - cut), total + len(gone)
    assert total > 200 and missed <= 0.02 * total


def repeated_lines(docs, run_words=50):
    """By definition: the lines of each document that are part of a run of
    ``run_words`` words or more which stands at an earlier place too."""
    seen, out = set(), []
    for lines in docs:
        n, gone = [len(x.split()) for x in lines], set()
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                if sum(n[i:j + 1]) >= run_words:
                    run = tuple(lines[i:j + 1])
                    if run in seen:
                        gone |= set(range(i, j + 1))
                    seen.add(run)
        out.append(gone)
    return out


def deleted_lines(spark, docs):
    table = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate(docs)], "doc_id long, text string").repartition(3)
    return [{i for s in r.removed_spans for i in range(s.first, s.last + 1)}
            for r in line_dedup.dedup_lines(table).orderBy("doc_id").collect()]


def test_line_dedup_core_in_another_context(spark):
    """The first place of the shared core stands in a context of its own."""
    rng = random.Random(10)
    core, after, before = prose(rng, 45), prose(rng, 10), prose(rng, 8)
    docs = [[prose(rng, 12), core, prose(rng, 20)]]
    docs += [[core, after, prose(rng, 20)] for _ in range(30)]
    docs += [[prose(rng, 20), before, core, prose(rng, 30)] for _ in range(30)]
    want = repeated_lines(docs)
    assert want[0] == want[1] == want[31] == set() and want[2] == {0, 1} and want[32] == {1, 2}
    assert deleted_lines(spark, docs) == want
    # stock lines of many lengths in any order
    pool = [prose(rng, n) for n in (3, 7, 11, 16, 22, 28, 34, 41, 45, 48)]
    docs = [[rng.choice(pool) if rng.random() < 0.9 else prose(rng, 6) for _ in range(9)] for _ in range(120)]
    want = repeated_lines(docs)
    assert sum(map(len, want)) > 100
    assert deleted_lines(spark, docs) == want


def test_line_dedup_keeps_stock_lines_from_different_places(spark):
    """Neighbouring passages of fewer than 50 words, each seen at another
    place, aren't a repeated run; with one of 50 words only that one is."""
    rng = random.Random(11)
    x, y, long = prose(rng, 45), prose(rng, 45), prose(rng, 52)
    own = lambda: prose(rng, 20)
    docs = [[own(), x, own()], [own(), y, own()], [own(), long, own()], [own(), x, y, own()], [own(), x, long, y, own()], [x, y]]
    want = repeated_lines(docs)
    assert want == [set(), set(), set(), set(), {2}, {0, 1}]
    assert deleted_lines(spark, docs) == want


def test_pipeline_near_dedup_goes_by_row(spark):
    """One row of every group is left: also of repeated rows and of rows
    without doc_id; a text of its own stays, whatever its doc_id."""
    import corpus_pipeline
    rng = random.Random(12)
    a, b, c, d, e = (prose(rng, 80) for _ in range(5))
    rows = [(1, a), (2, b), (2, b), (3, a), (3, c), (None, a), (None, d), (None, d), (5, e), (4, e + " end"), (6, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("x")).repartition(3)
    out = corpus_pipeline.remove_near_duplicates(spark, docs, "")
    assert out.dtypes == docs.dtypes
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(1, a), (2, b), (3, c), (None, d), (4, e + " end"), (6, None), (None, None)], key=repr)
    assert corpus_pipeline.remove_near_duplicates(spark, docs.limit(0), "").collect() == []
