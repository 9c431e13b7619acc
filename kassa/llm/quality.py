"""Quality classifier: random Fourier features, ridge, isotonic calibration.

A text becomes a vector of document statistics. Random Fourier features
approximate a Gaussian kernel over them; each task sums its part of the normal
equations, the sums of all tasks are added up, and one small system gives the
ridge weights. Scores of the training rows from models that haven't seen them
(FOLDS folds, by subtracting a fold's sums) are put in bins, and isotonic
regression over the bins turns a ridge score into a probability.

All labelled rows that may be learned from take part; what comes to the driver
is the system (FEATURES squared numbers a fold) and the bins.

Defined results: a null text is the empty text, whose statistics are all 0,
and it is scored like any other; without any label every score is 0.5; several
labels of a document count by their mean, null labels not at all; rows that
share doc_id are scored each by its own text; a row without doc_id is never
learned from; an empty table gives an empty result; other columns pass by
unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import id_text, keep, small_batches, text_of, with_ids
from .minhash import word_hashes

FEATURES = 256
FOLDS = 5
RIDGE = 1.0
BINS = 512
CLIP = 5.0  # of a standardised statistic

_KIND = np.zeros(256, np.int8)  # of a byte: 0 other control, 1 letter, 2 capital, 3 digit, 4 white space, 5 sentence mark, 6 symbol
_KIND[[9, 10, 11, 12, 13, 32]] = 4
_KIND[33:127] = 6
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 5
_KIND[48:58], _KIND[65:91], _KIND[97:123], _KIND[128:] = 3, 2, 1, 1


def statistics(text: str) -> np.ndarray:
    """The document statistics of a whole text."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words = word_hashes(text)
    n = len(words)
    if not n:
        return np.zeros(N_STATISTICS)
    bytes_ = np.bincount(b, minlength=256)
    share = np.bincount(_KIND, weights=bytes_, minlength=7) / len(b)
    letters = max(1, bytes_[_KIND == 1].sum() + bytes_[_KIND == 2].sum())
    p = bytes_[bytes_ > 0] / len(b)
    _, times = np.unique(words, return_counts=True)
    top = np.sort(times)[::-1][:10]
    pairs = len(np.unique(words[:-1] * np.uint64(31) + words[1:])) if n > 1 else 1
    space = _KIND[b] == 4
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    lengths = ends - starts
    last, before = _KIND[b[ends - 1]], _KIND[b[np.maximum(ends - 2, starts)]]
    capital = (_KIND[b[starts]] == 2).mean()
    alone = ((lengths == 1) & (last == 6)).mean()  # a symbol that stands as a word
    lines = text.split("\n")
    return np.array([
        np.log1p(n), np.log1p(len(b)), lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        share[1], bytes_[_KIND == 2].sum() / letters, share[3], share[4], share[5], share[6],
        (last >= 5).mean(), ((last >= 5) & (before >= 5)).mean(), capital, alone,
        len(times) / n, len(times) / n ** 0.75, times.max() / n, top.sum() / n, pairs / max(1, n - 1),
        (words[1:] == words[:-1]).mean() if n > 1 else 0.0, -(p * np.log2(p)).sum(),
        np.log1p(len(lines)), n / len(lines), len(set(lines)) / len(lines), (lengths <= 3).mean(), (bytes_[128:].sum()) / len(b)])


N_STATISTICS = 27


def document_statistics(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [statistics(t) for t in batch["_text"]]})
    small_batches(docs.sparkSession)
    return with_ids(docs.select(id_text(), text_of().alias("_text")).mapInPandas(run, "doc_id string, x array<double>"))


class Features:
    """Standardisation and the random Fourier map, with a constant beside."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, n: int = FEATURES, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, np.where(std > 1e-9, std, 1.0)
        self.w = rng.normal(size=(len(mean), n)) / np.sqrt(len(mean))
        self.b = rng.uniform(0, 2 * np.pi, n)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -CLIP, CLIP)
        return np.hstack([np.sqrt(2 / len(self.b)) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])


def normal_equations(rows: DataFrame, features: Features) -> list[np.ndarray]:
    """Per fold the matrix [Z'Z | Z'y]; each task sums the rows that it reads,
    a row of the matrix at a time is then summed over the tasks."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {}
        for batch in batches:
            z, y, fold = features(np.stack(batch["x"].to_list())), batch["y"].to_numpy(), batch["fold"].to_numpy()
            for f in np.unique(fold):
                at = fold == f
                sums[f] = sums.get(f, 0) + z[at].T @ np.hstack([z[at], y[at, None]])
        for f, s in sums.items():
            yield pd.DataFrame({"fold": int(f), "i": range(len(s)), "row": list(s)})

    def total(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": group["fold"][:1], "i": group["i"][:1], "row": [np.sum(group["row"].to_list(), axis=0)]})
    schema, n = "fold int, i int, row array<double>", FEATURES + 1
    parts = rows.select("x", "y", "fold").mapInPandas(part, schema)
    out = [np.zeros((n, n + 1)) for _ in range(FOLDS)]
    for r in parts.groupBy("fold", "i").applyInPandas(total, schema).collect():  # FOLDS * (FEATURES + 1) rows
        out[r["fold"]][r["i"]] = r["row"]
    return out


def solved(system: np.ndarray) -> np.ndarray:
    n = len(system)
    return np.linalg.solve(system[:, :n] + RIDGE / n * np.eye(n), system[:, n])


def isotonic(position: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (positions, values) of the blocks, to be
    interpolated between."""
    blocks: list[list[float]] = []
    for p, m, w in zip(position, mean, weight):
        blocks.append([p * w, m * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    at = np.array(blocks)
    return at[:, 0] / at[:, 2], at[:, 1] / at[:, 2]


class Model:
    def __init__(self, features: Features | None, weights, at, value):
        self.features, self.weights, self.at, self.value = features, weights, at, value

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), 0.5)
        s = self.ridge(x)
        # a thousandth of the raw score keeps the order within an isotonic block
        return np.clip(0.999 * np.interp(s, self.at, self.value) + 0.001 * np.clip(s, 0, 1), 0, 1)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learnable(labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id and y, the mean label, of the documents that may be learned from."""
    return labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(F.col(label).cast("double")).alias("y")).where(~held_out())


def labelled(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id and text of the documents that may be learned from: a fit alone
    needs the statistics of no others."""
    ids = learnable(labels, label).select(F.col("doc_id").alias("_known"))
    return docs.select("doc_id", "text").join(ids, F.col("doc_id").cast("long") == F.col("_known"), "left_semi")


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """``stats`` (doc_id, x) of the documents, or of those in ``labelled``,
    ``labels`` (doc_id, ``label``)."""
    rows = keep(stats.join(learnable(labels, label), "doc_id").withColumn(
        "fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int")), "labelled")
    sums = rows.agg(*[f(F.col("x")[i]).alias(f"{f.__name__}{i}") for i in range(N_STATISTICS) for f in (F.avg, F.stddev_pop)]).first()
    if sums["avg0"] is None:
        return Model(None, None, None, None)
    features = Features(np.array([sums[f"avg{i}"] for i in range(N_STATISTICS)]),
                        np.array([sums[f"stddev_pop{i}"] for i in range(N_STATISTICS)]))
    systems = normal_equations(rows, features)
    whole = sum(systems)
    without = [solved(whole - s) for s in systems]

    @F.pandas_udf("double")
    def unseen(x: pd.Series, fold: pd.Series) -> pd.Series:
        z = features(np.stack(x.to_list()))
        return pd.Series((z * np.stack([without[f] for f in fold])).sum(1))
    s = F.least(F.greatest(unseen("x", "fold"), F.lit(-0.5)), F.lit(1.5))
    bins = sorted((r["bin"], r["s"], r["y"], r["n"]) for r in rows.select("y", s.alias("s")).withColumn(
        "bin", F.floor((F.col("s") + 0.5) / 2 * BINS)).groupBy("bin").agg(
        F.avg("s").alias("s"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).collect())  # at most BINS + 1 rows
    _, at, mean, n = map(np.array, zip(*bins))
    return Model(features, solved(whole), *isotonic(at, mean, n))


def score_statistics(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of 0.5)."""
    @F.pandas_udf("double")
    def score(x: pd.Series) -> pd.Series:
        return pd.Series(model(np.stack(x.to_list())) if len(x) else [], dtype=float)
    return stats.select("doc_id", held_out().alias("held_out"), score("x").alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def text_score(model: Model):
    """Column function: the score of a text column, where the text lies."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model(np.stack([statistics(t or "") for t in text])) if len(text) else [], dtype=float)
    return score
