"""Alignment of two tokenizers over the same texts.

Both token sequences of a text are cut into groups at the byte offsets where
a token of each ends. Tokens that end together are linked, and an id pair's
count is the number of its links in the whole corpus.

Identity fast path: an array gives for each A id the B id of the same bytes.
A group of one token each with that very pair is counted in a vector as long
as A's vocabulary, so a task sends a number per id however often it occurs; the
links of all other groups go into the pair shuffle, counted per task first.

Of two tokens that end together the shorter one's bytes end the longer one's,
so the vocabularies alone bound the different pairs: an end of a token's bytes
is one A id or at most two B ids (a piece, or a byte piece), which makes fewer
than two pairs for each byte of the vocabularies' tokens. That table is small
whatever the corpus; it goes to the driver and from there to the tasks, which
score the links that they wrote in the first pass.

Texts are encoded by chunks, which begin at a space after a character that is
not white space; neither tokenizer has a token across such a place (checked
for B's pieces, true of A's pattern), so the ids are those of the whole text
and a group never spans two chunks. Frequent chunks are encoded once.

Defined results: texts that are null, empty, or whose tokens' bytes aren't
those of the space and the text have no tokens: zeros and an empty digest; rows
that share doc_id count each by itself, rows without doc_id too; an empty table
gives an empty result; other columns pass by unread.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import id_text, keep, small_batches, with_ids

ALIGNED = "doc_id string, n_a long, n_b long, n_groups long, groups string, same binary, rest binary"
KNOWN_CHARS = 1 << 21  # of chunks that a task remembers, before it starts anew
AT_ONCE = 1 << 18      # characters of new chunks that are encoded side by side


@dataclass(frozen=True)
class Tokenizer:
    """``encode`` gives the ids of a text, ``tokens`` each id's bytes."""

    encode: Callable[[str], list[int]]
    tokens: list[bytes]


def byte_bpe(ranks: str, pattern: str) -> Callable[[], Tokenizer]:
    """Byte-level BPE from a rank file, whose tokens are bytes already. Strings
    of special tokens are plain text."""
    def load() -> Tokenizer:
        import tiktoken
        with open(ranks, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        tokens = [b""] * (max(merges.values()) + 1)
        for token, number in merges.items():
            tokens[number] = token
        return Tokenizer(tiktoken.Encoding("aligned", pat_str=pattern, mergeable_ranks=merges, special_tokens={}).encode_ordinary, tokens)
    return load


def sentence_pieces(model: str) -> Callable[[], Tokenizer]:
    """A sentencepiece model, which puts a space before the text: U+2581 stands
    for a space, <0xHH> for a byte."""
    def load() -> Tokenizer:
        import sentencepiece
        p = sentencepiece.SentencePieceProcessor(model_file=model)

        def token(i: int) -> bytes:
            piece = p.id_to_piece(i)
            byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            return bytes.fromhex(byte[1]) if byte else piece.replace("▁", " ").encode()
        pieces = [p.id_to_piece(i) for i in range(p.vocab_size())]
        if any(re.search("[^▁]▁", x) for x in pieces):
            raise ValueError("a piece goes on after a space: texts can't be encoded by chunks")
        return Tokenizer(p.encode, [token(i) for i in range(len(pieces))])
    return load


def identity_map(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each A id the B id of the same bytes (the greatest, so a piece goes
    before its byte piece), else -1."""
    of = {token: i for i, token in enumerate(b)}
    return np.array([of.get(token, -1) if token else -1 for token in a], np.int64)


#: Of a text or chunk: A tokens, B tokens, groups, the groups as text, identity
#: links (A ids) and other links (A and B id) as 32-bit integers.
Groups = tuple[int, int, int, str, bytes, bytes]


class Aligner:
    """Groups of texts. What is known of a chunk is kept, and the new chunks of
    many texts are encoded and cut into groups side by side."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        self.a, self.b = a, b
        self.identity = identity_map(a.tokens, b.tokens)
        self.length_a, self.length_b = (np.array([len(t) for t in x.tokens]) for x in (a, b))
        # an id's text before the next id of the group, and at the end of its part
        n_a, n_b = len(a.tokens), len(b.tokens)
        self.written = [f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;")) for end in ends for i in range(n)]
        self.last_a, self.first_b, self.last_b = n_a, 2 * n_a, 2 * n_a + n_b
        self.known: dict[str, Groups | None] = {}
        self.held = 0

    def side_by_side(self, parts: list[str]) -> list[Groups] | None:
        """The groups of parts that begin with a space each; None if bytes
        differ somewhere."""
        joined = "".join(parts)
        raw = joined.encode("utf-8", "surrogatepass")
        try:
            a, b = self.a.encode(joined), self.b.encode(joined[1:])  # B adds the first space itself
        except UnicodeEncodeError:  # a lone surrogate has no bytes
            return None
        if b"".join(map(self.a.tokens.__getitem__, a)) != raw or b"".join(map(self.b.tokens.__getitem__, b)) != raw:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        of_a, of_b = np.searchsorted(end_a, common), np.searchsorted(end_b, common)  # the last tokens of the groups
        ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in parts])
        group = np.searchsorted(common, ends)  # the last groups of the parts
        if not np.array_equal(common[group], ends):
            return None
        one = (np.diff(of_a, prepend=-1) == 1) & (np.diff(of_b, prepend=-1) == 1) & (self.identity[a[of_a]] == b[of_b])
        same = a[of_a[one]].astype("<i4").tobytes()
        rest = np.stack([a[of_a[~one]], b[of_b[~one]]], 1).astype("<i4").tobytes()
        # the tokens in the order in which they are written: a group's of A, then its of B
        text = np.zeros(len(a) + len(b), np.int64)
        group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        b_before, a_until = np.concatenate(([0], of_b[:-1] + 1)), of_a + 1
        is_last_a, is_last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        is_last_a[of_a], is_last_b[of_b] = True, True
        text[np.arange(len(a)) + b_before[group_a]] = a + self.last_a * is_last_a
        text[np.arange(len(b)) + a_until[group_b]] = b + np.where(is_last_b, self.last_b, self.first_b)
        words = list(map(self.written.__getitem__, text.tolist()))
        cuts = [np.concatenate(([0], x)).tolist() for x in (
            of_a[group] + 1, of_b[group] + 1, group + 1, np.cumsum(one)[group], np.cumsum(~one)[group])]
        return [(a1 - a0, b1 - b0, g1 - g0, "".join(words[a0 + b0:a1 + b1])[:-1], same[4 * s0:4 * s1], rest[8 * r0:8 * r1])
                for (a0, b0, g0, s0, r0), (a1, b1, g1, s1, r1) in zip(zip(*cuts), zip(*[c[1:] for c in cuts]))]

    def learn(self, parts: list[str]) -> None:
        found = self.side_by_side(parts)
        if found is not None:
            self.known.update(zip(parts, found))
        elif len(parts) == 1:
            self.known[parts[0]] = None
        else:  # find the parts whose bytes differ
            self.learn(parts[:len(parts) // 2])
            self.learn(parts[len(parts) // 2:])

    def __call__(self, texts: list[str | None]) -> Iterator[Groups]:
        if self.held > KNOWN_CHARS:
            self.known.clear()
            self.held = 0
        parts = [list(chunks(t)) if t else [] for t in texts]
        new, size = [], 0
        for c in dict.fromkeys(c for cs in parts for c in cs if c not in self.known):
            new.append(c)
            size += len(c)
            if size > AT_ONCE:
                self.held += size
                self.learn(new)
                new, size = [], 0
        if new:
            self.held += size
            self.learn(new)
        for text, cs in zip(texts, parts):
            found = [self.known[c] for c in cs]
            if None in found:  # perhaps the bytes of the whole are right all the same
                found = self.side_by_side([" " + text]) or []
            if not found:
                yield 0, 0, 0, "", b"", b""
                continue
            n_a, n_b, n, words, same, rest = zip(*found)
            yield sum(n_a), sum(n_b), sum(n), ";".join(words), b"".join(same), b"".join(rest)


def chunks(text: str) -> Iterator[str]:
    """Space and text, cut before every space that follows a character which
    is not white space."""
    pending = ""
    for part in text.split(" "):
        pending += " " + part
        if part and not part[-1].isspace():
            yield pending
            pending = ""
    if pending:
        yield pending


def align(docs: DataFrame, a: Callable[[], Tokenizer], b: Callable[[], Tokenizer]) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, groups
    (``a1,a2|b1;a3|b2,b3``), and its links: ``same`` (A ids of identity links)
    and ``rest`` (A and B id of the others) as 32-bit integers."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(a(), b())
        for batch in batches:
            rows = [(d, *g) for d, g in zip(batch["doc_id"], aligner(batch["_text"].to_list()))]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in ALIGNED.split(", ")])
    return with_ids(docs.select(id_text(), F.col("text").cast("string").alias("_text")).mapInPandas(run, ALIGNED))


def link_counts(aligned: DataFrame, n_a: int) -> DataFrame:
    """(a, b, n) over all links; b is null for identity links. A task sums its
    identity links in a vector of ``n_a`` numbers, and its other pairs by
    sorting what it has gathered whenever that grows long."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vector = np.zeros(n_a, np.int64)
        keys, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            vector += np.bincount(np.frombuffer(b"".join(batch["same"]), "<i4"), minlength=n_a)
            rest = np.frombuffer(b"".join(batch["rest"]), "<i4").astype(np.int64).reshape(-1, 2)
            new, n = np.unique(rest[:, 0] << 32 | rest[:, 1], return_counts=True)
            keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            times = np.bincount(at, np.concatenate([times, n]), len(keys)).astype(np.int64)
        seen = np.flatnonzero(vector)
        yield pd.DataFrame({"a": seen, "b": pd.array([None] * len(seen), "Int64"), "n": vector[seen]})
        yield pd.DataFrame({"a": keys >> 32, "b": pd.array(keys & 0xFFFFFFFF, "Int64"), "n": times})
    return aligned.select("same", "rest").mapInPandas(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


class Counts:
    """Of all links: ``same`` by A id, ``pairs`` and ``times`` of the others by
    pair, ``best``: the highest count of each B id."""

    def __init__(self, table: pd.DataFrame, identity: np.ndarray, n_b: int):
        plain = table["b"].isna().to_numpy(bool)
        self.same, self.identity = np.zeros(len(identity), np.int64), identity
        self.same[table["a"].to_numpy()[plain]] = table["n"].to_numpy()[plain]
        others = table[~plain].astype("int64")
        pairs = others["a"].to_numpy() << 32 | others["b"].to_numpy()
        order = np.argsort(pairs)
        self.pairs, self.times = pairs[order], others["n"].to_numpy()[order]
        self.best = np.zeros(n_b, np.int64)
        np.maximum.at(self.best, identity[identity >= 0], self.same[identity >= 0])
        np.maximum.at(self.best, self.pairs & 0xFFFFFFFF, self.times)

    def __call__(self, same: bytes, rest: bytes) -> tuple[int, int, int]:
        """Links, those that are their B id's best, sum of their counts."""
        a = np.frombuffer(same, "<i4")
        others = np.frombuffer(rest, "<i4").astype(np.int64).reshape(-1, 2)
        n = np.concatenate([self.same[a], self.times[np.searchsorted(self.pairs, others[:, 0] << 32 | others[:, 1])]])
        best = self.best[np.concatenate([self.identity[a], others[:, 1]])]
        return len(n), int((n == best).sum()), int(n.sum())


def align_corpus(docs: DataFrame, a: Callable[[], Tokenizer], b: Callable[[], Tokenizer]) -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups) and the id pairs (a, b, n, best) of the corpus."""
    spark = docs.sparkSession
    first, second = a(), b()
    identity, n_b = identity_map(first.tokens, second.tokens), len(second.tokens)
    aligned = keep(align(docs, a, b), "aligned")
    counted = keep(link_counts(aligned, len(identity)), "link-counts")
    counts = Counts(counted.toPandas(), identity, n_b)  # bounded by the vocabularies, see above
    sent = spark.sparkContext.broadcast(counts)

    @F.pandas_udf("n_links long, n_best long, count_sum long")
    def scored(same: pd.Series, rest: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sent.value(s, r) for s, r in zip(same, rest)], columns=["n_links", "n_best", "count_sum"]).astype("int64")
    documents = aligned.withColumn("_s", scored("same", "rest")).select(
        "doc_id", "n_a", "n_b", "n_groups", "_s.n_links", "_s.n_best", "_s.count_sum", "groups")
    known = identity >= 0
    pairs = np.concatenate([np.flatnonzero(known & (counts.same > 0)) << 32 | identity[known & (counts.same > 0)], counts.pairs])
    times = np.concatenate([counts.same[known & (counts.same > 0)], counts.times])
    table = pd.DataFrame({"a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "n": times, "best": times == counts.best[pairs & 0xFFFFFFFF]})
    return documents, spark.createDataFrame(table, "a long, b long, n long, best boolean")
