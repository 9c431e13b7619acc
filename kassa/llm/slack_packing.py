"""Packing by minimum bin slack, with documents cut where a window needs it.

Each window takes the longest remaining piece, and of the others the multiset
of lengths that fills it closest to capacity. A subset-sum dynamic program
finds it: bit t of a Python integer is set if some multiset of the remaining
lengths, counts respected, adds up to t; shifts and ors add a length, and the
counts are read off backwards, longest length first. Documents may be cut, so
what a window still lacks is cut from the longest piece left, and the rest of
that piece goes back. The very last tokens, less than a window, are dealt to
sequences of the powers of two that add up to them. No sequence needs padding.

The choices depend on lengths only, and there are at most ``size`` of those.
Tasks tokenize and number their pieces within each length, a histogram with one
row a length goes to the driver, the same window is repeated while the counts
allow (so the plan doesn't grow with the number of documents), and tasks look up
where their pieces go. Ids move only for lengths of which some piece is cut.

Defined results: a null or empty text holds the end id alone; rows that share
doc_id are packed each by itself, though their pieces can't be told apart by
id; an empty table gives an empty result; other columns pass by unread.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import id_text, keep, small_batches, text_of, with_ids

SEQUENCE = 2048
END_ID = 1
ITEMS = "doc_id string, start long, length long, doc_tokens long, ids binary, part int, place long"
RUN = ["origin", "first", "n", "start", "length", "bin", "each", "skip", "offset"]


class SubsetSums:
    """Which sums up to ``size`` the remaining lengths reach. ``prefix[i]`` is
    the bitset of the ``i`` least lengths, so only what lies above a changed
    length is computed anew."""

    def __init__(self, size: int):
        self.size, self.mask = size, (1 << size + 1) - 1
        self.lengths: list[int] = []
        self.limits: list[int] = []
        self.prefix = [1]

    def plus(self, bits: int, length: int, copies: int) -> int:
        """With up to ``copies`` of a length more, by powers of two."""
        step = 1
        while copies > 0:
            step = min(step, copies)
            bits |= bits << length * step & self.mask
            copies, step = copies - step, 2 * step
        return bits

    def update(self, counts: dict[int, int]) -> None:
        lengths = sorted(counts)
        limits = [min(counts[x], self.size // x) for x in lengths]
        same, known = 0, min(len(lengths), len(self.lengths))
        while same < known and lengths[same] == self.lengths[same] and limits[same] == self.limits[same]:
            same += 1
        self.lengths, self.limits = lengths, limits
        del self.prefix[same + 1:]
        for x, most in zip(lengths[same:], limits[same:]):
            self.prefix.append(self.plus(self.prefix[-1], x, most))

    def fullest(self) -> dict[int, int]:
        """The multiset (length -> copies) with the longest length in it that
        leaves the least slack."""
        top = len(self.lengths) - 1
        longest = self.lengths[top]
        room = self.size - longest
        again = min(self.limits[top] - 1, room // longest)
        reach = self.plus(self.prefix[top], longest, again) & (1 << room + 1) - 1
        left, chosen = reach.bit_length() - 1, Counter({longest: 1})
        for i in range(top, -1, -1):
            if not left:
                break
            x = self.lengths[i]
            for copies in range(min(again if i == top else self.limits[i], left // x), -1, -1):
                if self.prefix[i] >> left - copies * x & 1:
                    break
            if copies:
                chosen[x] += copies
                left -= copies * x
        return chosen


class Pool:
    """Remaining pieces by length. A segment (origin, first, n, start) stands
    for the pieces numbered first to first + n - 1 among those that were
    ``origin`` long, from their token ``start`` on."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {x: n for x, n in counts.items() if n}
        self.segments = {x: [(x, 0, n, 0)] for x, n in self.counts.items()}

    def put(self, length: int, segment: tuple[int, int, int, int]) -> None:
        self.segments.setdefault(length, []).append(segment)
        self.counts[length] = self.counts.get(length, 0) + segment[2]

    def take(self, length: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        self.counts[length] -= n
        while n:
            origin, first, m, start = self.segments[length].pop()
            if m > n:
                self.segments[length].append((origin, first + n, m - n, start))
                m = n
            n -= m
            yield origin, first, m, start
        if not self.counts[length]:
            del self.counts[length], self.segments[length]


def minimum_bin_slack(counts: dict[int, int], size: int = SEQUENCE) -> pd.DataFrame:
    """The plan for ``counts`` pieces of each length, in runs: of the pieces
    numbered ``first`` to ``first + n - 1`` among those of length ``origin``,
    the ``length`` tokens from ``start`` on. The i-th of them is number t =
    skip + i of its window's kind: sequence ``bin + t // each``, place ``offset
    + t % each * length``."""
    pool, sums, runs, bins = Pool(counts), SubsetSums(size), [], 0

    def lay(length: int, n: int, each: int, offset: int, cut: int = 0) -> None:
        skip = 0
        for origin, first, m, start in pool.take(length, n):
            runs.append((origin, first, m, start, cut or length, bins, each, skip, offset))
            if cut:
                pool.put(length - cut, (origin, first, m, start + cut))
            skip += m

    while pool.counts:
        sums.update(pool.counts)
        window = sums.fullest()
        slack = size - sum(x * n for x, n in window.items())
        spare = max((x for x, n in pool.counts.items() if n > window.get(x, 0)), default=0) if slack else 0
        if slack and not spare:  # all that is left, less than a window
            bins += _powers_of_two(pool, runs, bins)
            break
        needed = Counter(window)
        if slack:  # every piece left is longer than the slack, or it would have been taken
            needed[spare] += 1
        times = min(pool.counts[x] // n for x, n in needed.items())
        offset = 0
        for x, n in sorted(window.items(), reverse=True):
            lay(x, times * n, n, offset)
            offset += x * n
        if slack:
            lay(spare, times, 1, offset, cut=slack)
        bins += times
    return pd.DataFrame(runs, columns=RUN).astype("int64")


def _powers_of_two(pool: Pool, runs: list, bins: int) -> int:
    """Lay out what is left in sequences whose lengths are the powers of two
    that add up to it; returns their number."""
    left = sum(x * n for x, n in pool.counts.items())
    ends = np.cumsum([1 << i for i in range(left.bit_length() - 1, -1, -1) if left >> i & 1])
    at, now = 0, 0
    for x in sorted(pool.counts, reverse=True):
        for origin, first, m, start in list(pool.take(x, pool.counts[x])):
            for number in range(first, first + m):
                done = 0
                while done < x:
                    n = min(x - done, int(ends[now]) - at)
                    begin = int(ends[now - 1]) if now else 0
                    runs.append((origin, number, 1, start + done, n, bins + now, 1, 0, at - begin))
                    at, done = at + n, done + n
                    now += at == ends[now]
    return len(ends)


class Places:
    """The plan by piece: ``rows`` sorted by (origin, number interval, start),
    each interval of piece numbers with all runs that hold parts of them."""

    def __init__(self, plan: pd.DataFrame):
        rows = []
        for _, runs in plan.groupby("origin"):
            runs = list(runs[RUN].itertuples(index=False, name=None))
            edges = sorted({r[1] for r in runs} | {r[1] + r[2] for r in runs})
            number = {e: i for i, e in enumerate(edges)}
            for r in runs:
                rows += [(r[0], edges[i], *r) for i in range(number[r[1]], number[r[1] + r[2]])]
        table = np.array(sorted(rows, key=lambda r: (r[0], r[1], r[5])), np.int64).reshape(-1, 2 + len(RUN))
        self.rows = table[:, 2:]
        self.keys, self.begin, self.count = np.unique(table[:, 0] << 44 | table[:, 1], return_index=True, return_counts=True)

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, ...]:
        """For pieces by (length, number): which piece, start, length,
        sequence, offset of every part, the parts of a piece in order."""
        at = np.searchsorted(self.keys, length << 44 | number, "right") - 1
        n = self.count[at]
        piece = np.repeat(np.arange(len(at)), n)
        row = self.rows[np.repeat(self.begin[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        _, first, _, start, taken, bin_, each, skip, offset = row.T
        t = skip + number[piece] - first
        return piece, start, taken, bin_ + t // each, offset + t % each * taken


def tokenize(docs: DataFrame, encoder: Callable, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """A row for every full window of a document and for what is left of it:
    doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), and
    ``place``, its number among the rows of its length in the task ``part``."""
    def items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, seen = encoder(), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["_text"]):
                ids = np.array(encode(text) + [end_id], "<u4")
                for start in range(0, len(ids), size):
                    piece = ids[start:start + size]
                    rows.append((doc_id, start, len(piece), len(ids), piece.tobytes(), part, seen[len(piece)]))
                    seen[len(piece)] += 1
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in ITEMS.split(", ")])
    small_batches(docs.sparkSession)
    return with_ids(docs.select(id_text(), text_of().alias("_text")).mapInPandas(items, ITEMS))


def place(items: DataFrame, places, whole: bool, begins: DataFrame) -> DataFrame:
    """The pieces of ``items``. ``whole``: none of them is cut, so the ids stay
    behind; otherwise they travel, and each piece gets its own."""
    out = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    numbered = items.join(begins.hint("shuffle_hash"), ["length", "part"]).select(
        id_text(), "start", "length", "doc_tokens", F.col("ids_crc32") if whole else F.col("ids"), (F.col("begin") + F.col("place")).alias("number"))

    def laid(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            piece, start, length, bin_, offset = places.value(batch["length"].to_numpy(), batch["number"].to_numpy())
            got = pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[piece], "start": batch["start"].to_numpy()[piece] + start, "length": length,
                                "doc_tokens": batch["doc_tokens"].to_numpy()[piece], "sequence_id": bin_, "offset": offset})
            if whole:
                got["ids_crc32"] = batch["ids_crc32"].to_numpy()[piece]
            else:
                ids = batch["ids"].to_list()
                got["ids"] = [ids[p][4 * a:4 * (a + n)] for p, a, n in zip(piece, start, length)]
                got["ids_crc32"] = [zlib.crc32(x) for x in got["ids"]]
            yield got
    return with_ids(numbered.mapInPandas(laid, out if whole else out + ", ids binary"))


def pack(docs: DataFrame, encoder: Callable, size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and its ids. Without ``with_ids`` only the ids of
    lengths that the plan cuts take part in the shuffle."""
    spark = docs.sparkSession
    items = keep(tokenize(docs, encoder, size, end_id), "items").withColumn("ids_crc32", F.crc32("ids"))
    per_part = keep(items.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "item-lengths")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= size rows
    plan = minimum_bin_slack(counts, size)
    places = spark.sparkContext.broadcast(Places(plan))  # bounded by the lengths, not by the documents
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    begins = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    if with_ids:
        return place(items, places, False, begins)
    cut = sorted({int(x) for x in plan.loc[plan["length"] != plan["origin"], "origin"]})
    is_cut = F.col("length").isin(cut)
    light = place(items.where(~is_cut).drop("ids"), places, True, begins)
    return light.unionByName(place(items.where(is_cut), places, False, begins).drop("ids")) if cut else light
