"""Best-fit packing of documents into fixed-length token sequences.

Best-fit decreasing: pieces are placed from the longest to the shortest, each
into the open bin with the least room that still takes it. A segment tree over
the possible remaining capacities finds that bin in logarithmic time.

What the rule decides depends on the piece lengths only, and those are bounded
by the sequence length. So tasks tokenize and number their pieces within each
length, a histogram with one row a length goes to the driver, the rule runs
over runs of equal lengths (its plan is bounded by the square of the sequence
length, whatever the number of documents), and tasks look up the place of each
of their pieces. Texts and ids are never shuffled.

Defined results: a null or empty text is one piece holding the end id alone; a
text longer than a sequence is cut into pieces of full length of which the
first may be shorter; rows that share doc_id are packed each by itself, though
their pieces can't be told apart by id; an empty table gives an empty result;
other columns pass by unread.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import id_text, keep, small_batches, text_of, with_ids

SEQUENCE = 2048
END_ID = 0
PIECES = "doc_id string, piece int, start long, length long, ids binary, part int, place long"


class CapacityTree:
    """Segment tree over capacities 0..size: a leaf is set while some open bin
    has just that much room left."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.full = np.zeros(2 * self.leaves, bool)

    def put(self, at: int, value: bool) -> None:
        i = at + self.leaves
        self.full[i] = value
        while i > 1:
            i //= 2
            self.full[i] = self.full[2 * i] or self.full[2 * i + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest set capacity of at least ``least``."""
        i = least + self.leaves
        if self.full[i]:
            return least
        while i > 1:
            if i % 2 == 0 and self.full[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.full[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], size: int = SEQUENCE) -> pd.DataFrame:
    """The plan for ``counts`` pieces of each length: runs of (length, first,
    n, bin, each, offset). The pieces of that length numbered first to first +
    n - 1 go to bins from ``bin`` on, ``each`` of them to a bin, side by side
    from ``offset``.

    Same placements as taking the pieces one by one: best fit fills the
    tightest bin until the length no longer fits, then turns to the next bin
    with as little room, so equal bins are handled as one run."""
    tree, open_bins = CapacityTree(size), {}  # capacity -> [(first bin, number of bins)]
    runs, bins = [], 0

    def opened(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            if capacity not in open_bins:
                open_bins[capacity] = []
                tree.put(capacity, True)
            open_bins[capacity].append((first, n))

    for length in sorted(counts, reverse=True):
        left, done = counts[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, each = size, size // length
                first, n = bins, -(-left // each)
                bins += n
            else:
                each = capacity // length
                first, n = open_bins[capacity].pop()
                if not open_bins[capacity]:
                    del open_bins[capacity]
                    tree.put(capacity, False)
            whole = min(n, left // each)
            if whole:
                runs.append((length, done, whole * each, first, each, size - capacity))
                opened(capacity - each * length, first, whole)
                done, left = done + whole * each, left - whole * each
            if left and whole < n:  # the last bin of the run takes fewer
                runs.append((length, done, left, first + whole, left, size - capacity))
                opened(capacity - left * length, first + whole, 1)
                done, left, whole = done + left, 0, whole + 1
            opened(capacity, first + whole, n - whole) if capacity < size else None
    return pd.DataFrame(runs, columns=["length", "first", "n", "bin", "each", "offset"]).astype("int64")


def tiktoken_encoder(ranks: str, pattern: str) -> Callable[[], Callable[[str], list[int]]]:
    """Byte-level BPE from a rank file; special tokens' strings are ordinary text."""
    def load():
        import tiktoken
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=merges, special_tokens={}).encode_ordinary
    return load


def json_encoder(path: str) -> Callable[[], Callable[[str], list[int]]]:
    """A tokenizer in the tokenizers library's own format."""
    def load():
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
    return load


def byte_bpe_encoder(path: str, ranks: str, pattern: str, special: tuple[str, ...]) -> Callable[[], Callable[[str], list[int]]]:
    """The ids of the tokenizer at ``path``. Texts without its special tokens'
    strings are encoded from the rank file of the same vocabulary, which gives
    the same ids in a quarter of the time."""
    exact, fast = json_encoder(path), tiktoken_encoder(ranks, pattern)

    def load():
        encode, rest = fast(), []

        def ids(text: str) -> list[int]:
            if not any(s in text for s in special):
                return encode(text)
            if not rest:
                rest.append(exact())
            return rest[0](text)
        return ids
    return load


def tokenize(docs: DataFrame, encoder: Callable, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids (little-endian
    unsigned 32-bit), and ``place``, its number among the pieces of its length
    in the task ``part``."""
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, seen = encoder(), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["_text"]):
                ids = np.array(encode(text) + [end_id], "<u4")
                ends = range(len(ids), 0, -size)  # full pieces from the end
                for piece, end in enumerate(reversed(ends)):
                    start = max(0, end - size)
                    rows.append((doc_id, piece, start, end - start, ids[start:end].tobytes(), part, seen[end - start]))
                    seen[end - start] += 1
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in PIECES.split(", ")])
    small_batches(docs.sparkSession)
    return with_ids(docs.select(id_text(), text_of().alias("_text")).mapInPandas(pieces, PIECES))


def place(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Adds sequence_id and offset to rows with length, part and place (and
    whatever else, which is best little: the rows are shuffled once)."""
    spark = pieces.sparkSession
    per_part = keep(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= size rows
    runs = best_fit_decreasing(counts, size).sort_values(["length", "first"])
    plan = spark.sparkContext.broadcast({c: runs[c].to_numpy() for c in runs})  # bounded by size squared, often some 10 kB
    # where each task's pieces of a length begin among all pieces of that length
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    begins = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    numbered = pieces.join(begins.hint("shuffle_hash"), ["length", "part"]).withColumn("number", F.col("begin") + F.col("place"))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        runs, n, i = plan.value, length.to_numpy(), number.to_numpy()
        run = np.searchsorted(runs["length"] << 44 | runs["first"], n << 44 | i, "right") - 1
        i, each = i - runs["first"][run], runs["each"][run]
        return pd.DataFrame({"sequence_id": runs["bin"][run] + i // each, "offset": runs["offset"][run] + i % each * n})
    return (numbered.withColumn("at", placed("length", "number"))
            .select(*[c for c in pieces.columns if c not in ("part", "place")], "at.sequence_id", "at.offset"))


def pack(docs: DataFrame, encoder: Callable, size: int = SEQUENCE, end_id: int = END_ID,
         with_ids: bool = True) -> DataFrame:
    """A row per piece of every document: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset, and its ids. Without ``with_ids`` the ids
    stay where the tasks wrote them and don't take part in the shuffle."""
    pieces = keep(tokenize(docs, encoder, size, end_id), "pieces").withColumn("ids_crc32", F.crc32("ids"))
    return place(pieces if with_ids else pieces.drop("ids"), size)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (its pieces joined in the order of their offsets) and
    doc_ids; each sequence gathers at most its fixed number of ids."""
    return (packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
                    F.transform("p", lambda x: x["doc_id"]).alias("doc_ids")))
