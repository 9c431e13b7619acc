"""Near-duplicate detection by MinHash.

1. Each text becomes the set of its distinct word shingles (64-bit hashes), and
   a signature: the minima of many universal hashes over the set. Equal sets
   are joined at once; from here on one document stands for them.
2. Banding: documents that agree on all minima of some band meet in a bucket.
   The number of bands is chosen so that a pair at the threshold is missed
   with probability one in a million.
3. Signature verification: in a bucket, documents are connected step by step
   from one to all that agree with it on enough minima (a bound that a true
   link fails with a probability below one in a million). A bucket returns a
   forest, never its pairs. Components of these forests hold all links.
4. In each such component the full sets are compared, again from one document
   to all not yet reached, and the links are exact.
5. Components of the exact links, by alternating large-star and small-star.

The members of a large bucket or component are first compared with a few
pivots of it; members linked with the same pivot form a class and needn't be
compared with each other. The classes, and the members no pivot reached, are
cut into blocks of bounded size; every pair of blocks is a unit of work of its
own, but for two blocks of one class. So no task gets a whole hot group, no
link between blocks is lost, and a group whose members resemble a pivot takes
work linear in its size.

Defined results: a null text is the empty text; a text without words has an
empty set and is linked with nothing; a text of fewer words than a shingle has
the whole sequence as its only shingle; rows that share doc_id are one node;
rows without doc_id take the component of equal sets, null if there is none;
an empty table gives an empty result; other columns pass by unread.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import drop_kept, id_text, keep, small_batches, text_of, with_ids
from .components import connected_components

BAND_ROWS = 4
MISSED = 1e-6
BUCKET_BLOCK, BUCKET_SPREAD = 4096, 256          # signatures: most of a block, fewest of a group that is cut
SET_BLOCK, SET_SPREAD = 1_000_000, 50_000        # the same in shingles
PIVOTS, HOT_MEMBERS, HOT_SLICE = 4, 256, 128     # of a large group; fewest members of one; members that meet its pivots in a task
HOT_SPREAD = 16                                  # as the other spreads, in members of a group that met its pivots: most copies fall away
NO_CLASS = -1
PIECE_BYTES = 4_000_000   # of a text that is hashed at a time

U = np.uint64
_BASE, _PART = 0x9E3779B97F4A7C15, 4096


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U)
    x = 1
    for i in range(n):
        out[i] = x
        x = x * base % 2 ** 64
    return out


_NEAR, _FAR = _powers(_BASE, _PART), _powers(pow(_BASE, _PART, 2 ** 64), _PART)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix64 generator, a bijection of 64-bit numbers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased.
    White space is ASCII, so the UTF-8 bytes are searched."""
    raw, out, at = text.encode("utf-8", "surrogatepass"), [], 0
    while at < len(raw):
        end = min(len(raw), at + PIECE_BYTES)
        while end < len(raw) and not (raw[end] == 32 or 9 <= raw[end] <= 13):
            end += 1  # to the end of the word
        b = np.frombuffer(raw, np.uint8, end - at, at)
        at = end
        space = (b == 32) | ((b >= 9) & (b <= 13))
        edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(starts):
            continue
        b = np.where((b >= 65) & (b <= 90), b + 32, b)[~space].astype(U) + U(1)
        lengths = ends - starts
        first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(len(b)) - np.repeat(first, lengths)
        b *= _NEAR[place % _PART]
        if lengths.max() > _PART:
            b *= _FAR[place // _PART % _PART]
        out.append(mixed(np.add.reduceat(b, first)))
    return np.concatenate(out) if out else np.zeros(0, U)


def shingle_set(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's ``k``-word shingles."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = min(k, len(words))
    x = np.full(len(words) - n + 1, n, U)
    for i in range(n):
        x = mixed(x * U(_BASE) + words[i:len(words) - n + 1 + i])
    return np.unique(x)


class Signatures:
    """Universal hashes h(x) = (a x + b) >> 32 with odd random a; ``bands``
    bands of ``BAND_ROWS`` minima; ``agree`` minima that two signatures must
    share at least to be considered."""

    def __init__(self, similarity: float, seed: int = 7):
        self.bands = math.ceil(math.log(MISSED) / math.log(1 - similarity ** BAND_ROWS))
        n = self.bands * BAND_ROWS
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 2 ** 63, n, U) * U(2) + U(1)
        self.b = rng.integers(0, 2 ** 63, n, U) * U(2)
        self.agree = math.floor(n * similarity - 5.2 * math.sqrt(n * similarity * (1 - similarity)))

    def minima(self, x: np.ndarray) -> np.ndarray:
        low = np.full(len(self.a), 2 ** 32, U)
        for i in range(0, len(x), 2048):
            low = np.minimum(low, ((self.a[:, None] * x[None, i:i + 2048] + self.b[:, None]) >> U(32)).min(1))
        return low

    def band_keys(self, low: np.ndarray) -> np.ndarray:
        key = np.arange(self.bands, dtype=U)
        for i in range(BAND_ROWS):
            key = mixed(key * U(_BASE) + low[i::BAND_ROWS])
        return key.view(np.int64)


def signatures(docs: DataFrame, k: int, hashes: Signatures) -> DataFrame:
    """doc_id, n_shingles, set_id (128-bit hash of the set), keys (band keys)
    and minima (low byte of each)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["_text"]:
                x = shingle_set(text, k)
                low = hashes.minima(x) if len(x) else None
                rows.append((len(x), hashlib.blake2b(x.tobytes(), digest_size=16).digest(),
                             hashes.band_keys(low) if len(x) else [], low.astype(np.uint8).tobytes() if len(x) else b""))
            out = pd.DataFrame(rows, columns=["n_shingles", "set_id", "keys", "minima"])
            out.insert(0, "doc_id", batch["doc_id"])
            yield out
    return with_ids(docs.select(id_text(), text_of().alias("_text")).mapInPandas(
        run, "doc_id string, n_shingles long, set_id binary, keys array<long>, minima binary"))


def in_blocks(members: DataFrame, size: str, most: int, spread: int) -> DataFrame:
    """Deals the members of each group to pairs of its blocks: adds the
    columns i <= j, and a row for every pair that the member's block is in.
    The number of blocks grows with the square root of the group's ``size``,
    which spreads a hot group over tasks at little copying, and from where a
    block would hold more than ``most``, in proportion."""
    blocks = F.greatest(F.ceil(F.col(size) / most), F.ceil(F.sqrt(F.col(size) / spread)))
    return (members.withColumn("_n", blocks).withColumn("_own", F.pmod(F.xxhash64("rep"), F.col("_n")))
            .withColumn("_other", F.explode(F.when((F.col("_n") == 1), F.array(F.lit(0).cast("long")))
                                            .otherwise(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))))
            .withColumn("i", F.least("_own", "_other")).withColumn("j", F.greatest("_own", "_other"))
            .where((F.col("_n") == 1) | (F.col("i") < F.col("j"))).drop("_n", "_own", "_other"))


def pivot_slices(members: DataFrame, group: str, most: int) -> DataFrame:
    """Rows of large groups (columns ``group``, rep, weight, n members, total
    weight) dealt to slices, each with a copy of the group's pivots, whose
    column ``pivot`` is their number; that of members is ``NO_CLASS``."""
    slices = F.greatest(F.ceil(F.col("n") / HOT_SLICE), F.ceil(F.col("total") / most))
    drawn = [F.min_by("rep", F.xxhash64("rep", F.lit(p))) for p in range(PIVOTS)]
    pivots = members.groupBy(group).agg(F.array_distinct(F.array(*drawn)).alias("pivots"), F.first(slices).alias("slices"))
    copies = pivots.select(group, F.posexplode("pivots").alias("pivot", "rep"), "slices").select(
        group, F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"), "rep", F.lit(0).alias("weight"), "pivot")
    return members.select(group, F.pmod(F.xxhash64("rep"), slices).alias("slice"), "rep", "weight", F.lit(NO_CLASS).alias("pivot")).union(copies)


def class_blocks(classed: DataFrame, group: str, most: int, spread: int) -> DataFrame:
    """Deals the members of large groups (columns ``group``, rep, weight,
    class) to pairs of blocks, as ``in_blocks`` does, but for pairs of blocks
    of one class, whose members are linked already. Blocks are smaller than
    there, as few members have more than one other block to meet."""
    parts = classed.groupBy(group, "class").agg(F.sum("weight").alias("part"), F.count(F.lit(1)).alias("n"))
    sums = parts.groupBy(group).agg(F.sum("part").alias("total"), F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("class", "part"))).alias("parts"))  # at most PIVOTS + 1
    blocks = F.greatest(F.ceil(F.col("total") / most), F.ceil(F.sqrt(F.col("total") / spread)), F.ceil(F.sqrt(F.col("n") / HOT_SPREAD)))
    layout = sums.where((F.size("parts") > 1) | (F.col("parts")[0]["class"] == NO_CLASS)).select(group, F.flatten(F.transform(
        "parts", lambda p: F.array_repeat(p["class"], F.ceil(p["part"] * blocks / F.col("total")).cast("int")))).alias("blocks"))
    numbers = F.sequence(F.lit(0), F.size("blocks") - 1)
    mine = F.filter(numbers, lambda x: F.get("blocks", x) == F.col("class"))
    met = classed.join(layout, group).withColumn("_own", F.get(mine, F.pmod(F.xxhash64("rep"), F.size(mine)).cast("int")))
    others = F.filter(numbers, lambda x: (x != F.col("_own")) & ((F.col("class") == NO_CLASS) | (F.get("blocks", x) != F.col("class"))))
    met = met.withColumn("_other", F.explode(F.when(F.size("blocks") == 1, F.array("_own")).otherwise(others)))
    return met.select(group, F.least("_own", "_other").cast("long").alias("i"), F.greatest("_own", "_other").cast("long").alias("j"), "rep", "class")


def with_pivots(members: DataFrame, group: str, payload: DataFrame, near, most: int, spread: int) -> tuple[DataFrame, DataFrame]:
    """Groups whose members are (``group``, rep, weight), of one or more rows
    each: the links with pivots of large groups, and the blocks (``group``, i,
    j, rep, class) to compare. ``payload`` holds rep and data, and
    ``near(list of data)`` gives the test of ``forest``."""
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("total"))
    sized = keep(members.join(sizes.where("n > 1"), group).select(group, "rep", "weight", "n", "total"), "members")
    hot = F.col("n") > HOT_MEMBERS
    usual = in_blocks(sized.where(~hot), "total", most, spread).select(group, "i", "j", "rep", F.lit(NO_CLASS).alias("class"))
    keys = [group, "slice"]

    def classes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in groups(batches, keys):
            at, rep, weight, pivot = bounds_of(frame, keys), *(frame[c].to_numpy() for c in ("rep", "weight", "pivot"))
            for a, b in zip(at[:-1], at[1:]):
                test, heads, rest = near(frame["data"].iloc[a:b]), np.flatnonzero(pivot[a:b] != NO_CLASS), np.flatnonzero(pivot[a:b] == NO_CLASS)
                for p in heads[np.argsort(pivot[a:b][heads])]:
                    hit = test(p, rest)
                    yield pd.DataFrame({group: frame[group].iloc[a], "rep": rep[a + rest[hit]], "weight": weight[a + rest[hit]],
                                        "class": pivot[a + p], "pivot": rep[a + p]})
                    rest = rest[~hit]
                yield pd.DataFrame({group: frame[group].iloc[a], "rep": rep[a + rest], "weight": weight[a + rest], "class": NO_CLASS, "pivot": rep[a + rest]})
    slices = pivot_slices(sized.where(hot), group, most).join(payload, "rep").select(*keys, "pivot", "rep", "weight", "data")
    met = keep(slices.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(
        classes, f"{group} long, rep long, weight long, class int, pivot long"), "classes")
    links = met.where("rep <> pivot").select(F.col("rep").alias("u"), F.col("pivot").alias("v")).distinct()
    return links, usual.union(class_blocks(met, group, most, spread))


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Consecutive rows with the same keys, from sorted batches: frames of one
    or more whole groups."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[keys].iloc[-1]
        same = (batch[keys] == last).all(axis=1).to_numpy()
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
            held = []
        elif held and not (held[-1][keys].iloc[-1] == last).all():
            yield pd.concat(held, ignore_index=True)
            held = []
        held.append(batch.iloc[cut:])
    if held:
        yield pd.concat(held, ignore_index=True)


def bounds_of(frame: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Where groups start, and the end."""
    change = (frame[keys].to_numpy()[1:] != frame[keys].to_numpy()[:-1]).any(axis=1)
    return np.concatenate(([0], np.flatnonzero(change) + 1, [len(frame)]))


def forest(n: int, near) -> list[tuple[int, int]]:
    """Spanning forest of 0..n-1; ``near(i, rest)`` tells which of the indices
    ``rest`` are linked with i. Whoever is reached isn't compared again but
    with those not yet reached, so a group of near copies takes few rounds."""
    out, rest = [], np.arange(n)
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            out += [(i, int(j)) for j in rest[hit]]
            queue += list(rest[hit])
            rest = rest[~hit]
    return out


LINKS = "u long, v long"


def same_class(near, classes: np.ndarray):
    """``near``, or linked already by a pivot of both."""
    if (classes == NO_CLASS).all():
        return near
    return lambda i, rest: near(i, rest) | ((classes[rest] == classes[i]) & (classes[i] != NO_CLASS))


def agreeing(low: np.ndarray, agree: int):
    """Test of ``forest`` on rows of minima."""
    return lambda i, rest: (low[rest] == low[i]).sum(1) >= agree


def rows_of(minima) -> np.ndarray:
    return np.frombuffer(b"".join(minima), np.uint8).reshape(len(minima), -1)


def bucket_links(members: DataFrame, agree: int) -> DataFrame:
    """Signature verification: key, i, j, rep, class, data (minima), sorted ->
    forest links."""
    keys = ["key", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in groups(batches, keys):
            at, rep, classes = bounds_of(frame, keys), frame["rep"].to_numpy(), frame["class"].to_numpy()
            low = rows_of(frame["data"])
            size = np.diff(at)
            two = at[:-1][size == 2]
            two = two[(low[two] == low[two + 1]).sum(1) >= agree]
            out = [(rep[two], rep[two + 1])]
            for a, n in zip(at[:-1][size > 2], size[size > 2]):
                links = forest(n, same_class(agreeing(low[a:a + n], agree), classes[a:a + n]))
                if links:
                    u, v = np.array(links).T
                    out.append((rep[a + u], rep[a + v]))
            yield pd.DataFrame({"u": np.concatenate([x for x, _ in out]), "v": np.concatenate([x for _, x in out])})
    return members.mapInPandas(run, LINKS)


def resembling(sets: list[np.ndarray], numerator: int, denominator: int):
    """Test of ``forest``: denominator * intersection >= numerator * union."""
    size = np.array([len(x) for x in sets])
    shingles, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[number] > 1  # the others only count in the sizes
    owner = np.repeat(np.arange(len(sets)), size)[shared]
    number = number[shared]
    first = np.searchsorted(owner, np.arange(len(sets) + 1))
    mark = np.zeros(len(shingles), bool)

    def near(i, rest):
        mark[number[first[i]:first[i + 1]]] = True
        hits = np.concatenate(([0], np.cumsum(mark[number])))
        mark[number[first[i]:first[i + 1]]] = False
        both = hits[first[rest + 1]] - hits[first[rest]]
        return denominator * both >= numerator * (size[i] + size[rest] - both)
    return near


def sets_of(data) -> list[np.ndarray]:
    return [np.frombuffer(x, U) for x in data]


def shingle_sets(texts: DataFrame, k: int) -> DataFrame:
    """rep, _text -> rep, data: the full shingle set."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["data"] = [shingle_set(t, k).tobytes() for t in batch.pop("_text")]
            yield batch
    return texts.select("rep", "_text").mapInPandas(run, "rep long, data binary")


def verified_links(members: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """component, i, j, rep, class, data (full shingle sets), sorted -> exact
    links."""
    keys = ["component", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in groups(batches, keys):
            at, rep, classes, out = bounds_of(frame, keys), frame["rep"].to_numpy(), frame["class"].to_numpy(), []
            sets = sets_of(frame["data"])
            for a, b in zip(at[:-1], at[1:]):
                links = forest(b - a, same_class(resembling(sets[a:b], numerator, denominator), classes[a:b]))
                out += [(rep[a + u], rep[a + v]) for u, v in links]
            yield pd.DataFrame(out, columns=["u", "v"]).astype("int64")
    return members.mapInPandas(run, LINKS)


def near_duplicates(docs: DataFrame, k: int = 5, numerator: int = 80, denominator: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: components of the documents
    whose shingle sets have denominator * intersection >= numerator * union.
    One document of each component, the one with the least id, is kept."""
    small_batches(docs.sparkSession)
    hashes = Signatures(numerator / denominator)
    signed = keep(signatures(docs, k, hashes), "signatures")
    reps = keep(signed.where("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"),
        F.first("minima").alias("minima")).where("rep is not null"), "representatives")

    def compared(blocks: DataFrame, keys: list[str], payload: DataFrame) -> DataFrame:
        rows = blocks.join(payload, "rep").select(*keys, "rep", "class", "data")
        return rows.repartition(*keys).sortWithinPartitions(*keys)

    in_bands = reps.select(F.explode("keys").alias("key"), "rep", F.lit(1).alias("weight"))
    minima, agree = reps.select("rep", F.col("minima").alias("data")), hashes.agree
    by_pivot, blocks = with_pivots(in_bands, "key", minima, lambda data: agreeing(rows_of(data), agree), BUCKET_BLOCK, BUCKET_SPREAD)
    near = keep(bucket_links(compared(blocks, ["key", "i", "j"], minima), agree).union(by_pivot).distinct(), "near")
    nearby = keep(connected_components(near), "nearby")

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), text_of().alias("_text"))
    members = nearby.withColumnRenamed("node", "rep").join(reps.select("rep", F.col("n").alias("weight")), "rep")
    sets = keep(shingle_sets(texts.join(nearby.select(F.col("node").alias("rep")).hint("shuffle_hash"), "rep"), k), "sets")
    by_pivot, blocks = with_pivots(members, "component", sets, lambda data: resembling(sets_of(data), numerator, denominator), SET_BLOCK, SET_SPREAD)
    links = keep(verified_links(compared(blocks, ["component", "i", "j"], sets), numerator, denominator).union(by_pivot).distinct(), "links")
    found = keep(connected_components(links), "components")
    for done in (near, nearby, sets, links):
        drop_kept(done)

    classes = reps.select("set_id", "rep").join(found, reps["rep"] == found["node"], "left").select(
        "set_id", F.coalesce("component", "rep").alias("component_id"))
    return signed.join(classes, "set_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", F.when(F.col("n_shingles") == 0, F.col("doc_id"))).alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
