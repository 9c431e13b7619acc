"""Periodic runs of words, by online dyadic square catching.

Words are appended a stretch at a time (one word or a whole text: the result
is the same). For every power of two m the text is seen as blocks of m words; a
completed block has a catcher, which watches for the block's words to come
again at a distance of 2m to 4m words (1 to 3 for m = 1). Any square of such a
half length has a whole block in its left half, so none escapes. Fingerprints of
2m words are made of two of m words, and a hit arms a comparison of the text
with itself at that distance: backwards as far as the words agree, and forwards
with each word that is appended. A comparison that has agreed for a whole
distance has caught a square, each further word another one; the squares of one
comparison overlap and merge into one run. Fingerprints only propose: all words
are compared, so equal fingerprints of different words can't change a result.

A run is a stretch with smallest period q (words q apart are identical) that no
neighbouring word extends. Runs of at least ``exponent`` periods and ``words``
words are kept. Distances that are multiples of the period of a run already
known there are passed over, so a long run costs its length once a level.

Defined results: a null text is the empty text, which has no words and no runs;
rows that share doc_id are treated each by itself, rows without doc_id too; an
empty table gives an empty result; other columns pass by unread.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import id_text, small_batches, text_of, with_ids

WORDS, EXPONENT = 24, 3
JOINED = 1 << 15  # words of short texts that are searched at a time
U = np.uint64
SCHEMA = "doc_id string, n_words long, runs array<struct<start:long,length:long,period:long>>, kept_text string"


def words_of(text: str) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0x9E3779B97F4A7C15)
    return x ^ (x >> U(29))


@dataclass
class Comparison:
    """Words from ``start`` on equal those ``period`` before, up to ``end``."""

    start: int
    end: int
    period: int

    def run(self) -> tuple[int, int, int]:
        return self.start - self.period, self.end - self.start + self.period, self.period


class RunCatcher:
    """Runs of at least ``exponent`` periods (2 or more) and ``words`` words of
    a sequence of word numbers that grows by ``append``. ``longest``: no run
    has more words, if that is known."""

    def __init__(self, words: int = WORDS, exponent: int = EXPONENT, longest: int | None = None):
        self.least, self.exponent, self.longest = words, exponent, longest
        self.text = np.zeros(0, np.int64)
        self.levels: list[np.ndarray] = []  # fingerprints of 2**k words, by first word
        self.caught: list[Comparison] = []

    def append(self, new: np.ndarray) -> None:
        old = len(self.text)
        self.text = np.concatenate([self.text, new])
        for c in self.caught:
            if c.end == old:  # still open: each new word advances it
                c.end = self.forward(old, c.period)
        m, k = 1, 0
        longest = len(self.text) if self.longest is None else self.longest
        while m == 1 or self.exponent * 2 * m <= longest:
            self.complete(k, m)
            for blocks in ((1, 2, 3) if m == 1 else (2, 3)):
                self.catch(k, m, blocks, old)
            m, k = 2 * m, k + 1

    def complete(self, k: int, m: int) -> None:
        """Fingerprints of the stretches of m words that are now complete."""
        if k == len(self.levels):
            self.levels.append(np.zeros(0, U))
        have, n = len(self.levels[k]), len(self.text) - m + 1
        if n > have:
            if k == 0:
                more = mixed(self.text[have:n].astype(U) + U(1))
            else:
                half = self.levels[k - 1]
                more = mixed(half[have:n] * U(0xD6E8FEB86659FD93) + half[have + m // 2:n + m // 2])
            self.levels[k] = np.concatenate([self.levels[k], more])

    def needed(self, period: int) -> int:
        """Words that have to agree with those a period before."""
        return max(self.least, self.exponent * period) - period

    def catch(self, k: int, m: int, blocks: int, old: int) -> None:
        """Blocks of m words that come again with their copy beginning
        ``blocks`` blocks further on: distances blocks*m to blocks*m + m - 1."""
        prints = self.levels[k]
        alike = max(1, (self.needed(blocks * m) - m + 1) // m)  # blocks in a row that any run kept has
        begin = max(blocks * m, old - (alike + 1) * m + 1)  # earlier ones were complete before this append
        at = np.arange(begin, len(prints) - (alike - 1) * m)
        if not len(at):
            return
        hit = prints[begin:len(prints) - (alike - 1) * m] == np.repeat(
            prints[::m], m)[:len(prints)][begin - blocks * m:len(prints) - (alike - 1) * m - blocks * m] if m > 1 else (
            prints[begin:len(prints) - (alike - 1)] == prints[begin - blocks:len(prints) - (alike - 1) - blocks])
        at = at[hit]
        for i in range(1, alike):
            if not len(at):
                return
            at = at[prints[at + i * m] == prints[(at // m - blocks + i) * m]]
        if len(at):
            self.arm(at, at - (at // m - blocks) * m, m)

    def arm(self, at: np.ndarray, period: np.ndarray, m: int) -> None:
        """Comparisons at the positions and distances that aren't explained by
        a run that is known already."""
        order = np.lexsort((period, at))
        at, period = at[order], period[order]
        open_ = np.ones(len(at), bool)
        for c in self.caught:
            self.pass_over(c, at, period, open_, m)
        for i in range(len(at)):
            if open_[i]:
                p, q = int(at[i]), int(period[i])
                end = self.forward(p, q)
                if end - p < m:
                    continue  # equal fingerprints of different words
                c = Comparison(self.backward(p, q), end, q)
                if c.end - c.start >= self.needed(q):
                    self.caught.append(c)
                    self.pass_over(c, at, period, open_, m)
                else:  # the rest of this stretch of agreement is as short
                    self.pass_over(c, at, period, open_, m, multiples=False)

    @staticmethod
    def pass_over(c: Comparison, at: np.ndarray, period: np.ndarray, open_: np.ndarray, m: int, multiples: bool = True) -> None:
        lo, hi = np.searchsorted(at, [c.start, c.end])
        q = period[lo:hi]
        inside = (at[lo:hi] - q >= c.start - c.period) & (at[lo:hi] + m <= c.end)
        open_[lo:hi] &= ~(inside & ((q % c.period == 0) if multiples else (q == c.period)))

    def forward(self, at: int, period: int) -> int:
        """The first place from ``at`` on whose word differs from that a
        period before."""
        step, n = 64, len(self.text)
        while at < n:
            to = min(n, at + step)
            unlike = self.text[at:to] != self.text[at - period:to - period]
            i = int(unlike.argmax())
            if unlike[i]:
                return at + i
            at, step = to, 2 * step
        return n

    def backward(self, at: int, period: int) -> int:
        """The least place such that all words from it up to ``at`` equal
        those a period before."""
        step = 64
        while at > period:
            to = max(period, at - step)
            unlike = self.text[to:at] != self.text[to - period:at - period]
            if unlike.any():
                return at - int(unlike[::-1].argmax())
            at, step = to, 2 * step
        return at

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period), by start, then period."""
        return sorted({c.run() for c in self.caught if c.end - c.start >= self.needed(c.period)}, key=lambda r: (r[0], r[2]))


def find_runs(words: list, least: int = WORDS, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """The runs of a list of words."""
    return runs_of_each([words], least, exponent)[0]


def runs_of_each(texts: list[list], least: int = WORDS, exponent: int = EXPONENT) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words. Short texts are searched side by side,
    as one sequence with a word between them that occurs nowhere else (so no run
    crosses it), JOINED words at a time."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    side, total = [], 0
    for i in sorted((i for i, t in enumerate(texts) if len(t) >= least), key=lambda i: len(texts[i])):
        if side and total + len(texts[i]) > JOINED:
            _search(texts, side, out, least, exponent)
            side, total = [], 0
        side.append(i)
        total += len(texts[i])
    if side:
        _search(texts, side, out, least, exponent)
    return out


def _search(texts: list[list], side: list[int], out: list, least: int, exponent: int) -> None:
    number: defaultdict = defaultdict()
    number.default_factory = number.__len__  # words are numbered as they appear
    numbers, begins = [], []
    for i in side:
        begins.append(len(numbers))
        numbers += map(number.__getitem__, texts[i])
        numbers.append(-1 - i)
    catcher = RunCatcher(least, exponent, longest=max(len(texts[i]) for i in side))
    catcher.append(np.array(numbers, np.int64))
    runs = catcher.runs()
    for (start, length, period), d in zip(runs, np.searchsorted(begins, [r[0] for r in runs], "right") - 1):
        out[side[d]].append((start - begins[d], length, period))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words left when of each run only the first period stays."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def periodic_runs(docs: DataFrame, edit: Callable[[str | None, list[bytes]], list[bytes]] | None = None,
                  least: int = WORDS, exponent: int = EXPONENT) -> DataFrame:
    """A row per document: doc_id, n_words, runs (start, length, period; by
    start, then period) and kept_text, its words with every run collapsed to
    its first period, joined by one space. ``edit`` may change a document's
    words (given its id as text) before they are searched."""
    small_batches(docs.sparkSession)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [words_of(t) for t in batch["_text"]]
            if edit is not None:
                texts = [edit(d, t) for d, t in zip(batch["doc_id"], texts)]
            rows = []
            for doc_id, words, runs in zip(batch["doc_id"], texts, runs_of_each(texts, least, exponent)):
                kept = b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass")
                rows.append((doc_id, len(words), [{"start": s, "length": n, "period": q} for s, n, q in runs], kept))
            yield pd.DataFrame(rows, columns=["doc_id", "n_words", "runs", "kept_text"])
    return with_ids(docs.select(id_text(), text_of().alias("_text")).mapInPandas(search, SCHEMA))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact exponent, of equals the first; null
    without runs."""
    ahead = lambda r, best: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(ahead(r, best), r).otherwise(best))


def listed(runs: Column) -> Column:
    """``start,length,period`` and a line feed for every run."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return F.array_join(F.transform(runs, line), "")
