"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (with its ends marked) and itself,
hashed into a table of embeddings; a window's vector is the mean of its words',
a word's the mean of its bag, and a linear softmax over two classes judges the
window. A passage of some PASSAGE words is toxic if any of its windows is (noisy
or). A text's logit is the mean over the TOP_SHARE of its passages that look
worst: a share of them, not a number, so however long a clean text is, or how
often it is repeated, its worse half stays as it was, while a text that is toxic
throughout, if only by a word here and there, has such words in most passages.

Embeddings and softmax are trained jointly, in numpy, on the passages of a
bounded sample of labelled rows; a random half of every bag is left out at each
step, so that no n-gram is relied on alone and an unseen misspelling is known by
the n-grams it shares.

The sample is the documented bound of what the driver holds: at most
SAMPLE_ROWS labelled texts, taken in the order of a hash of doc_id, and of a text
with more than SAMPLE_PASSAGES passages so many of them, at equal steps from its
beginning to its end. Every whole text is scored.

Defined results: a null text is the empty text; a text without words has no
passage and scores 0; without labels of both classes every score is 0; several
labels of a document count as toxic if their mean is one half or more, null
labels not at all; rows that share doc_id are scored each by its own text; a
row without doc_id is never learned from; an empty table gives an empty
result; other columns pass by unread.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import id_text, small_batches, text_of, with_ids
from .minhash import mixed
from .quality import held_out

BUCKETS = 1 << 17
DIMENSIONS = 4
GRAMS = (3, 4, 5)
WINDOW, PASSAGE, TOP_SHARE = 1, 80, 0.5
SAMPLE_ROWS, SAMPLE_PASSAGES = 3000, 12
STEPS, RATE, DROP, DECAY = 100, 0.5, 0.5, 0.1
MISSPELT = 0.7   # of the longer words of a text that is learned from once more
TOXIC_FROM = 0.7
PIECE = 1 << 20  # characters that are hashed at a time
U = np.uint64


class Bags:
    """The words of a text and the table places of their bags: ``gram`` and
    ``of`` (word number) by n-gram, ``n`` words, ``key`` a hash of each."""

    def __init__(self, text: str):
        c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        c = np.where((c >= 65) & (c <= 90), c + 32, c)
        inner = (c >= 128) | ((c >= 97) & (c <= 122)) | ((c >= 48) & (c <= 57))
        edge = np.diff(np.concatenate(([False], inner, [False])).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.n = len(starts)
        # words side by side, each between two marks
        lengths = ends - starts + 2
        first = np.concatenate(([0], np.cumsum(lengths)))
        s = np.zeros(first[-1], U)
        word = np.repeat(np.arange(self.n), lengths)
        place = np.arange(first[-1]) - first[word] if self.n else np.zeros(0, int)
        body = (place > 0) & (place < lengths[word] - 1) if self.n else np.zeros(0, bool)
        s[body] = c[inner]
        left = lengths[word] - place if self.n else place  # characters from here to the end of the word
        self.key = np.add.reduceat(mixed(s * U(0x9E3779B97F4A7C15) + place.astype(U)), first[:-1]) if self.n else np.zeros(0, U)
        grams, of = [self.key], [np.arange(self.n)]
        h = mixed(s + U(1))
        for k in range(2, max(GRAMS) + 1):
            h = mixed(h[:-1] * U(0x9E3779B97F4A7C15) + s[k - 1:]) if len(h) > 1 else h[:0]
            if k in GRAMS:
                ok = np.flatnonzero(left[:len(h)] >= k)
                grams.append(h[ok] + U(k))
                of.append(word[ok])
        self.gram = (mixed(np.concatenate(grams)) % U(BUCKETS)).astype(np.int32)
        self.of = np.concatenate(of)


def pieces(text: str) -> Iterator[str]:
    """Parts of a long text, cut at white space."""
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def passage_starts(n: int) -> np.ndarray:
    """First words of the passages of a text of n words, all of nearly the same
    length, so that no short one is left at the end."""
    passages = max(1, round(n / PASSAGE))
    return np.arange(passages) * n // passages


class Toxicity:
    def __init__(self, value: np.ndarray | None, bias: float = 0.0):
        self.value, self.bias = value, bias  # embedding times softmax weights, a number for each place of the table

    def passages(self, text: str) -> np.ndarray:
        """The logit of each passage of a text."""
        words = []
        for part in pieces(text):
            bags = Bags(part)
            if bags.n:
                words.append(np.bincount(bags.of, self.value[bags.gram], bags.n) / np.bincount(bags.of, minlength=bags.n))
        if not words:
            return np.zeros(0)
        word = np.concatenate(words)
        at = np.arange(0, len(word), WINDOW)
        window = np.add.reduceat(word, at) / np.diff(np.append(at, len(word))) + self.bias
        none = np.add.reduceat(np.logaddexp(0, window), np.unique(passage_starts(len(word)) // WINDOW))  # -log P(no window is toxic)
        return np.log(np.maximum(-np.expm1(-none), 1e-300)) + none

    def __call__(self, text: str) -> float:
        logits = self.passages(text) if self.value is not None else ()
        if not len(logits):
            return 0.0
        k = max(1, round(TOP_SHARE * len(logits)))
        worst = np.partition(logits, len(logits) - k)[len(logits) - k:].mean()
        return float(1 / (1 + np.exp(-np.clip(worst, -500, 500))))


WORD = re.compile(r"[a-zA-Z0-9\x80-\U0010ffff]+")  # as Bags takes them


def sampled_passages(text: str, most: int = SAMPLE_PASSAGES) -> list[str]:
    """The passages of a text, at most so many, at equal steps."""
    words = WORD.findall(text)
    if not words:
        return []
    at = np.append(passage_starts(len(words)), len(words))
    n = len(at) - 1
    chosen = np.arange(n) if n <= most else np.linspace(0, n - 1, most).round().astype(int)
    return [" ".join(words[at[i]:at[i + 1]]) for i in chosen]


def misspelt(text: str, rng: random.Random) -> str:
    """The text with one inner letter of most longer words dropped, doubled,
    swapped or replaced."""
    def edit(m: re.Match) -> str:
        w = m[0]
        if len(w) < 4 or rng.random() > MISSPELT:
            return w
        i = rng.randrange(1, len(w) - 1)
        return (w[:i] + w[i + 1:], w[:i] + w[i] + w[i:], w[:i] + w[i + 1] + w[i] + w[i + 2:],
                w[:i] + rng.choice(w) + w[i + 1:])[rng.randrange(4)]
    return re.sub(r"[^\W\d_]+", edit, text)


def train(texts: list[str], toxic: np.ndarray, seed: int = 3) -> Toxicity:
    """Full-gradient steps (Adagrad) on the log likelihood of the passages'
    labels (``texts`` are passages). The toxic ones and as many others are
    learned from once more with misspellings in them."""
    if not (toxic == 1).any() or not (toxic == 0).any():
        return Toxicity(None)
    rng, pick = np.random.default_rng(seed), random.Random(seed)
    again = [*np.flatnonzero(toxic == 1), *np.flatnonzero(toxic == 0)[:(toxic == 1).sum()]]
    texts = [*texts, *[misspelt(texts[i], pick) for i in again]]
    toxic = np.concatenate([toxic, toxic[again]])
    number, grams, owners, words, window, doc, n_windows = {}, [], [], [], [], [], 0
    for d, text in enumerate(texts):
        bags = Bags(text)
        if not bags.n:
            continue
        keys, first, own = np.unique(bags.key, return_index=True, return_inverse=True)
        known = len(number)
        at = np.array([number.setdefault(k, len(number)) for k in keys.tolist()], np.int32)
        mine = np.full(bags.n, -1, np.int32)  # each word's bag is held once
        mine[first[at >= known]] = at[at >= known]
        new = mine[bags.of] >= 0
        grams.append(bags.gram[new])
        owners.append(mine[bags.of[new]])
        words.append(at[own])
        part = np.arange(bags.n, dtype=np.int32) // WINDOW
        window.append(part + np.int32(n_windows))
        n = int(part[-1]) + 1
        doc.append(np.full(n, d, np.int32))
        n_windows += n
    n_words = len(number)
    del number
    gram, owner, words, window, doc = map(np.concatenate, (grams, owners, words, window, doc))
    del grams, owners
    per_window = np.bincount(window, minlength=n_windows).astype(np.float32)
    toxic_window = (toxic[doc] == 1)
    table = rng.normal(0, 0.1, (DIMENSIONS, BUCKETS)).astype(np.float32)
    soft = np.outer(rng.uniform(0.5, 1, DIMENSIONS), [-1, 1])
    bias = -np.log(max(1.0, n_windows / len(texts)))  # a text's windows together start at about even odds
    grown, grown_soft, grown_bias = np.full_like(table, 1e-6), np.full_like(soft, 1e-6), 1e-6
    for _ in range(STEPS):
        keep = np.flatnonzero(rng.random(len(gram), np.float32) >= DROP)
        g, o = gram[keep], owner[keep]
        kept = np.maximum(np.bincount(o, minlength=n_words), 1)
        direction = soft[:, 1] - soft[:, 0]
        z, vec = np.full(n_windows, bias), []
        for k in range(DIMENSIONS):
            word = np.bincount(o, table[k][g], n_words) / kept
            vec.append((np.bincount(window, word[words], n_windows) / per_window).astype(np.float32))
            z += direction[k] * vec[-1]
        p = 1 / (1 + np.exp(-z))
        none = np.exp(-np.bincount(doc, np.logaddexp(0, z), len(texts)))[doc]  # probability that no window is toxic
        slope = np.where(toxic_window, -p * none / np.maximum(1 - none, 1e-9), p) / len(texts)
        of_soft = np.array([v @ slope for v in vec])
        of_word = np.bincount(words, (slope / per_window)[window], n_words) / kept
        of_gram = np.bincount(g, of_word[o], BUCKETS)
        step = direction[:, None] * of_gram + DECAY / len(texts) * table
        grown += step ** 2
        table -= (RATE * step / np.sqrt(grown) * (of_gram != 0)).astype(np.float32)
        both = np.stack([-of_soft, of_soft], 1)
        grown_soft += both ** 2
        soft -= RATE * both / np.sqrt(grown_soft)
        grown_bias += slope.sum() ** 2
        bias -= RATE * slope.sum() / np.sqrt(grown_bias)
    return Toxicity((soft[:, 1] - soft[:, 0]) @ table.astype(np.float64), float(bias))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Toxicity:
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y")).where(~held_out()))
    ids = (docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(known, "doc_id")
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).dropDuplicates(["doc_id"]))  # those that have a text
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text")).join(F.broadcast(ids), "doc_id")
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": batch["doc_id"], "y": batch["y"], "passages": [sampled_passages(t) for t in batch["_text"]]})
    sample = (labelled.mapInPandas(cut, "id long, y int, passages array<string>")
              .orderBy(F.xxhash64("id"), "id", "passages").limit(rows).collect())  # at most ``rows`` texts of SAMPLE_PASSAGES passages
    texts, toxic = [p for r in sample for p in r["passages"]], [r["y"] for r in sample for _ in r["passages"]]
    return train(texts, np.array(toxic, int))


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from a score of TOXIC_FROM)."""
    spark = docs.sparkSession
    small_batches(spark)
    weights = spark.sparkContext.broadcast((model.value, model.bias))  # a number for each place of a table of fixed size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here = Toxicity(*weights.value)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": [here(t) for t in batch["_text"]]})
    scored = with_ids(docs.select(id_text(), text_of().alias("_text")).mapInPandas(run, "doc_id string, score double"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))
