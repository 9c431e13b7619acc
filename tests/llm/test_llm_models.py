"""Quality and toxicity by held-out accuracy, and the pipeline."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kassa.llm import line_dedup, minhash, quality, toxicity
from kassa.llm.common import table

SF = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    n1 = (y == 1).sum()
    return (rank[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


@pytest.fixture(scope="module")
def stats(spark):
    return quality.document_statistics(table(spark, SF, "documents")).cache()


def test_quality_on_held_out_rows(spark, stats):
    labels = table(spark, SF, "labels")
    got = quality.score_statistics(stats, quality.fit(stats, labels))
    rows = got.join(labels, "doc_id").collect()
    for r in rows[:50]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in rows if r.held_out]
    score, y = np.array([r.score for r in held]), np.array([r.quality for r in held])
    assert auc(score, y) > 0.95 and ((score >= 0.5) == y).mean() > 0.93 and 0 <= score.min() and score.max() <= 1
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)


def test_quality_never_learns_from_held_out_labels(spark, stats):
    labels = table(spark, SF, "labels")
    other = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, round(r.score, 9)) for r in quality.score_statistics(stats, quality.fit(stats, x)).collect()) for x in (labels, other))
    assert a == b


def test_quality_fit_reads_labelled_texts_only(spark, stats):
    """The statistics of the documents that may be learned from give the model
    that those of all documents give."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    clash = docs.withColumn("_known", F.lit(1)).withColumn("y", F.lit(2))
    some = quality.labelled(clash.unionByName(clash.limit(3).withColumn("doc_id", F.lit(None).cast("long"))), labels)
    assert {r.doc_id for r in some.collect()} == {r.doc_id for r in docs.join(labels.where("quality IS NOT NULL"), "doc_id").where(~quality.held_out()).collect()}
    a, b = quality.fit(stats, labels), quality.fit(quality.document_statistics(some), labels)
    x = np.stack([r.x for r in stats.collect()])
    assert np.allclose(a(x), b(x), atol=1e-6)


def test_quality_without_labels(spark, stats):
    none = table(spark, SF, "labels").limit(0)
    assert {r.score for r in quality.score_statistics(stats.limit(20), quality.fit(stats, none)).collect()} == {0.5}


def test_normal_equations_are_summed_over_tasks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(500, quality.N_STATISTICS)), rng.integers(0, 2, 500)
    rows = spark.createDataFrame([(r.tolist(), float(t), i % quality.FOLDS) for i, (r, t) in enumerate(zip(x, y))],
                                 "x array<double>, y double, fold int").repartition(9)
    f = quality.Features(x.mean(0), x.std(0))
    systems = quality.normal_equations(rows, f)
    z = f(x)
    for fold, s in enumerate(systems):
        at = np.arange(500) % quality.FOLDS == fold
        assert np.allclose(s, z[at].T @ np.hstack([z[at], y[at, None]]))


def test_isotonic_is_monotone_and_keeps_the_mean():
    rng = np.random.default_rng(2)
    p, w = np.sort(rng.random(60)), rng.integers(1, 9, 60)
    m = np.clip(p + rng.normal(size=60) * 0.3, 0, 1)
    at, value = quality.isotonic(p, m, w)
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()


def test_random_features_approximate_the_gaussian_kernel():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, quality.N_STATISTICS)) * 0.7
    z = quality.Features(np.zeros(quality.N_STATISTICS), np.ones(quality.N_STATISTICS), n=20_000)(x)[:, :-1]
    near = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * quality.N_STATISTICS))
    assert abs(z @ z.T - near).max() < 0.05


INSULTS = ["grobnik", "plontered", "vexilous", "snarvish"]


def test_long_clean_texts_stay_clean(spark):
    """Clean labelled texts repeated and joined to megabytes stay below the
    threshold; toxic ones repeated stay above it."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(docs, labels)
    rows = docs.join(labels.where("toxic IS NOT NULL"), "doc_id").where("length(text) > 500").orderBy("doc_id").select("text", "toxic").collect()
    clean, toxic = [r.text for r in rows if not r.toxic], [r.text for r in rows if r.toxic]
    low = [t for t in clean[:25] if model(t) < 0.5]
    assert len(low) >= 23
    assert max(model(t * 100) for t in low) < toxicity.TOXIC_FROM
    joined = "\n".join(clean) * 4
    assert len(joined) > 1_500_000 and model(joined) < toxicity.TOXIC_FROM
    high = [t for t in toxic if model(t) > 0.9][:10]
    assert len(high) >= 5 and min(model(t * 50) for t in high) >= toxicity.TOXIC_FROM


def toxic_corpus(rng, n):
    words = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.choice([2, 4, 6, 8]))) for _ in range(2000)]
    texts, y = [], []
    for i in range(n):
        w = rng.choices(words, k=rng.choice([30, 80, 400]))
        y.append(int(i % 5 == 0))
        for _ in range(3 * y[-1]):
            w.insert(rng.randrange(len(w)), rng.choice(INSULTS))
        texts.append(" ".join(w))
    return texts, np.array(y)


def test_toxicity_on_held_out_texts_and_misspellings():
    rng = random.Random(4)
    texts, y = toxic_corpus(rng, 900)
    cut = [toxicity.sampled_passages(t) for t in texts[:600]]
    model = toxicity.train([p for ps in cut for p in ps], np.repeat(y[:600], [len(ps) for ps in cut]))
    score = np.array([model(t) for t in texts[600:]])
    assert ((score >= toxicity.TOXIC_FROM) == y[600:]).mean() > 0.98
    seen = set(" ".join(texts[:600]).split())
    other = ["".join(rng.choices("abcdefghilmnoprstu", k=8)) for _ in range(500)]
    usual = np.quantile([model.passages(w)[0] for w in other], 0.99)
    edits = {w[:i] + x + w[j:] for w in INSULTS for i in range(1, len(w) - 1) for j, x in ((i + 1, ""), (i, w[i]), (i + 1, "e"))} - seen - set(INSULTS)
    assert np.mean([model.passages(w)[0] > usual for w in edits]) > 0.75  # spellings it has never met


def test_long_texts_are_scored_whole(monkeypatch):
    value = np.random.default_rng(5).normal(size=toxicity.BUCKETS)
    model, rng = toxicity.Toxicity(value, -4.0), random.Random(5)
    text = " ".join("".join(rng.choices("abcdeé", k=5)) for _ in range(400))
    whole = np.sort(model.passages(text))
    monkeypatch.setattr(toxicity, "PIECE", 100)
    assert np.allclose(np.sort(model.passages(text)), whole) and model("") == 0 and model("...") == 0


def test_toxicity_query_on_whole_table(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.toxic for r in held]) > 0.85
    assert np.mean([r.predicted for r in held if not r.toxic]) < 0.03


def test_pipeline_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    seen = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if i < 4:
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(i)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(i)))
        seen.append((before, docs))
    (a, b) = seen[0]
    stats = quality.document_statistics(a)
    keep = quality.score_statistics(stats, quality.fit(stats, table(spark, sf, "labels"))).where("predicted = 1")
    assert {r.doc_id for r in b.collect()} == {r.doc_id for r in keep.collect()}
    (a, b) = seen[1]
    cut = {r.doc_id: (r.text, len(r.removed_spans)) for r in line_dedup.dedup_lines(a).collect()}
    want = {i: t for i, (t, n) in cut.items() if n == 0 or t.strip()}
    assert {r.doc_id: r.text for r in b.collect()} == want and all(r.n_chars == len(r.text) for r in b.collect() if cut[r.doc_id][1])
    (a, b) = seen[2]
    assert {r.doc_id for r in b.collect()} == {r.doc_id for r in minhash.near_duplicates(a).where("kept").collect()}
    (a, b) = seen[3]
    old = {r.doc_id: r for r in a.collect()}
    assert all(r == old[r.doc_id] for r in b.collect())
    words = lambda rows: sum(len(r.text.split()) for r in rows)
    assert abs(words(b.collect()) - words(a.collect())) < 0.15 * words(a.collect())
    (a, b) = seen[4]
    pieces = b.collect()
    assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)
    assert sum(r.start == 0 for r in pieces) == a.count()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert docs.count() == 0


def test_queries_match_their_twins(spark):
    from kassa.llm.oracle import ORACLE
    from kassa.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, sf)
        columns = ", ".join(f'"{c}"' for c in got.columns)
        want = con.execute(f"SELECT {columns} FROM ({sql})").fetchall()
        tidy = lambda rows: sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in rows)
        assert tidy(got.collect()) == tidy(want), name
