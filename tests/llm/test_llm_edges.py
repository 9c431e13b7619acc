"""Every operator on nulls, empty and long texts, ties, repeated rows, empty
tables and extra columns whose names clash with the operators' own."""

import pytest
from pyspark.sql import functions as F

from kassa.llm import exact_dedup, license_scan, line_dedup, minhash, mixing, packing, quality, topk, toxicity, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} all rights reserved" for i in range(30_000)) + " " + "x" * 200_000
ROWS = [(1, "One two three four five six.", "en", "a", 28), (2, None, None, None, None), (3, "", "en", "b", 0),
        (4, "   \n\t ", "en", "b", 6), (None, "One two three four five six.", "en", "a", 28), (5, LONG, "en", "a", len(LONG)),
        (6, "One two three four five six.", "en", "a", 28), (6, "One two three four five six.", "en", "a", 28),
        (7, "éàü ß 漢字 \U0001f600 \x00 <|endoftext|>", None, "c", None), (None, None, None, None, None), (8, LONG, "en", "a", len(LONG))]
CLASHES = ["spans", "removed_spans", "hits", "_w", "_h", "_d", "size", "taken", "ord", "target", "rep", "key", "keys", "n", "i", "j",
           "row", "recipe", "fp", "chunk", "kept", "score", "x", "y", "fold", "ids", "length", "part", "place", "id", "v", "dim",
           "norm", "block", "host", "path", "rule", "share", "shard", "quota", "word", "pos", "idx", "label", "_text", "copies"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 1), (5, 0, 1), (3, None, None), (None, 1, 1), (4, 0, 0), (99, 1, 1)],
                                 "doc_id long, quality int, toxic int")


def scored_quality(docs, labels):
    stats = quality.document_statistics(docs)
    return quality.score_statistics(stats, quality.fit(stats, labels))


OPERATORS = {
    "packing": lambda d, l: packing.pack(d, lambda: lambda text: [b + 1 for b in text.encode()]),
    "licenses": lambda d, l: license_scan.scan_licenses(d),
    "quality": scored_quality,
    "exact": lambda d, l: exact_dedup.exact_dedup(d),
    "toxicity": lambda d, l: toxicity.score(d, toxicity.fit(d, l)),
    "minhash": lambda d, l: minhash.near_duplicates(d),
    "mixing": lambda d, l: mixing.mix_sources(d),
    "lines": lambda d, l: line_dedup.dedup_lines(d),
}


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_hostile_rows(spark, docs, labels, name):
    got = OPERATORS[name](docs, labels)
    n = got.count()
    assert n == len(ROWS) if name != "packing" else n >= len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, docs, labels, name):
    assert OPERATORS[name](docs.limit(0), labels).collect() == []
    assert OPERATORS[name](docs.limit(0), labels.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["licenses", "exact", "minhash", "mixing", "lines", "quality", "packing"])
def test_clashing_columns(spark, docs, labels, name):
    few = docs.where("doc_id is null or doc_id not in (5, 8)")
    more = few.select("*", *[F.lit("clash").alias(c) for c in CLASHES])
    plain, odd = OPERATORS[name](few, labels), OPERATORS[name](more, labels)
    if name == "lines":
        assert set(odd.columns) == set(more.columns)
        odd = odd.select(*plain.columns)
    assert rows(odd) == rows(plain)


def test_urls(spark):
    pages = spark.createDataFrame([(1, None), (2, "no scheme"), (3, "http://"), (None, "http://A.Example.COM"), (4, "x://b.net?q=/"),
                                   (4, "x://b.net?q=/"), (5, "http://b.net/" + "a" * 300_000)], "page_id long, url string")
    got = url_filter.filter_urls(pages, ["example.net/en/"], ["net/"])
    assert got.count() == 7
    by = {(r.page_id, r.host): r for r in got.collect()}
    assert by[(1, "")].path == "" and by[(1, "")].rule is None
    assert (None, "a.example.com") in by and by[(4, "b.net")].rule is None and by[(5, "b.net")].rule == "net/"
    assert url_filter.filter_urls(pages.limit(0), [], ["net/"]).collect() == []
    more = pages.select("*", *[F.lit(1).alias(c) for c in CLASHES if c != "host"], F.lit("x").alias("host"))
    assert rows(url_filter.filter_urls(more, ["example.net/en/"], ["net/"])) == rows(got)


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = spark.createDataFrame([
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, []), (50, [0.0, 0.0]), (100, [1.0, 2.0, 3.0]), (1, [1.0, 0.0])],
        "vec_id long, embedding array<float>")
    query = F.col("vec_id") % 50 == 0
    got = [tuple(r) for r in topk.exact_topk(vectors, query, k=2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 65536), (0, 2, 1, 65536), (50, 1, 0, 0), (50, 2, 1, 0), (100, 1, 7, 14 * 65536)]
    assert topk.exact_topk(vectors.limit(0), query).collect() == []
    more = vectors.select("*", *[F.lit(1).alias(c) for c in CLASHES])
    assert [tuple(r) for r in topk.exact_topk(more, query, k=2).orderBy("query_id", "rank").collect()] == got


def test_defined_results(spark, docs, labels):
    exact = [r for r in exact_dedup.exact_dedup(docs).collect()]
    same = [r for r in exact if r.keep_id == 6]
    assert len(same) == 4 and {r.group_size for r in same} == {4} and [r.doc_id for r in same if r.kept] == [6, 6]
    assert {r.doc_id for r in exact if r.n_chunks == 0} == {2, 3, None}
    near = {r.doc_id: r for r in minhash.near_duplicates(docs).where("doc_id is not null").collect()}
    assert near[2].n_shingles == 0 and near[2].component_id == 2 and near[2].kept
    assert near[6].component_id == 1 and not near[6].kept and near[8].component_id == 5
    mixed = mixing.mix_sources(docs).collect()
    assert all(r.taken == 0 for r in mixed if r.size == 0) and all(r.taken <= 3 * r.size for r in mixed)
    scan = {r.doc_id: r for r in license_scan.scan_licenses(docs).where("doc_id is not null").collect()}
    assert scan[2].n_words == 0 and scan[2].first_word is None and scan[2].labels == "" and scan[2].score == 0
    assert scan[5].n_base == 30_000 and scan[5].base_labels == "reserved"
    lines = {r.doc_id: r for r in line_dedup.dedup_lines(docs).where("doc_id is not null").collect()}
    assert lines[2].text is None and lines[3].text == "" and lines[1].text == ROWS[0][1]
    assert lines[8].text == "" and len(lines[8].removed_spans) == 1 and lines[5].text == LONG
    pieces = packing.pack(docs, lambda: lambda text: [b + 1 for b in text.encode()]).where("doc_id = 2").collect()
    assert [(p.piece, p.length, bytes(p.ids)) for p in pieces] == [(0, 1, b"\0\0\0\0")]
