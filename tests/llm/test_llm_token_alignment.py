"""Token alignment against a plain version that encodes whole texts."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from kassa.llm import token_alignment
from kassa.llm.common import table
from kassa.llm.queries import op13_token_alignment

vocabularies = pytest.importorskip("public_tokenizers")
A = token_alignment.byte_bpe(vocabularies.path("byte_bpe_50k.tiktoken"), vocabularies.PATTERN)
B = token_alignment.sentence_pieces(vocabularies.path("piece_bpe_32k.model"))

ODD = ["  a  b ", " \n x\n y", "<|endoftext|> a<s>b </s>", "▁x y", "a ▁b c", "x   y  z", "ﬁ 1½ é é ​ q", "a\tb\r\nc", "\x00 a",
       " ", "\n", "日本 語\n\n \n x", "🙂 🙃🙃  \t .", None, ""]


def byte_table():
    """Byte-level decoding: printable bytes stand for themselves, the others
    for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def plain():
    """text -> (A ids, B ids, [(group's A ids, group's B ids)]), by the
    tokenizers library's file and the pieces' text."""
    from tokenizers import Tokenizer
    import sentencepiece
    first = Tokenizer.from_file(vocabularies.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=vocabularies.path("piece_bpe_32k.model"))
    of = byte_table()

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def groups(text):
        if not text:
            return [], [], []
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        of_a, of_b = [bytes(of[c] for c in first.id_to_token(i)) for i in a], [piece(i) for i in b]
        if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
            return [], [], []
        end_a, end_b = np.cumsum([len(x) for x in of_a]), np.cumsum([len(x) for x in of_b])
        out, i, k = [], 0, 0
        for end in sorted(set(end_a.tolist()) & set(end_b.tolist())):
            i2, k2 = np.searchsorted(end_a, end) + 1, np.searchsorted(end_b, end) + 1
            out.append((a[i:i2], b[k:k2]))
            i, k = i2, k2
        return a, b, out
    return groups


def written(groups):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


def test_chunks_against_whole_texts(plain):
    import pyarrow.parquet as pq
    texts = [t for t in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"])["text"].to_pylist() if t][:60] + ODD
    aligner = token_alignment.Aligner(A(), B())
    for text, (n_a, n_b, n, groups, same, rest) in zip(texts, aligner(texts)):
        a, b, want = plain(text)
        assert (n_a, n_b, n, groups) == (len(a), len(b), len(want), written(want))
        pairs = [(x[-1], y[-1]) for x, y in want]
        links = [(i, aligner.identity[i]) for i in np.frombuffer(same, "<i4")] + [tuple(p) for p in np.frombuffer(rest, "<i4").reshape(-1, 2)]
        assert Counter(links) == Counter(pairs)
        assert all(aligner.a.tokens[x] == aligner.b.tokens[y] for x, y in links[:len(same) // 4])
    assert [next(iter(aligner([t]))) for t in texts] == list(aligner(texts))  # what is known changes nothing


def test_identity_map_prefers_pieces():
    a, b = A(), B()
    same = token_alignment.identity_map(a.tokens, b.tokens)
    assert all(a.tokens[i] == b.tokens[k] for i, k in enumerate(same) if k >= 0)
    for byte in (65, 97):
        at = a.tokens.index(bytes([byte]))
        assert B().tokens[same[at]] == bytes([byte]) and same[at] > 258  # the piece, not the byte piece


def test_query_against_plain_version(spark, plain):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: plain(r.text) for r in table(spark, d, "documents").select("doc_id", "text").collect()}
    count = Counter((x[-1], y[-1]) for _, _, groups in docs.values() for x, y in groups)
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    got = op13_token_alignment(spark, d).collect()
    assert len(got) == len(docs)
    for r in got:
        a, b, groups = docs[r.doc_id]
        links = [(x[-1], y[-1]) for x, y in groups]
        digest = hashlib.sha256(written(groups).encode()).hexdigest() if groups else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (
            len(a), len(b), len(groups), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), digest)


def test_edges(spark):
    rows = [(1, None, 5, "s"), (2, "", None, None), (3, "a b", 1, "x"), (3, "a b", 1, "x"), (None, "▁", None, None)]
    documents, pairs = token_alignment.align_corpus(spark.createDataFrame(rows, "doc_id long, text string, n_a long, same string"), A, B)
    got = sorted((str(r.doc_id), r.n_a, r.n_links, r.count_sum, r.groups) for r in documents.collect())
    assert got[0] == ("1", 0, 0, 0, "") and got[1] == ("2", 0, 0, 0, "") and got[4] == ("None", 0, 0, 0, "")
    assert got[2] == got[3] and got[2][1:4] == (2, 2, 4)
    assert sorted(r.n for r in pairs.collect()) == [2, 2]
    documents, pairs = token_alignment.align_corpus(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert documents.count() == 0 and pairs.count() == 0


def test_long_texts_come_in_batches_of_their_own(spark):
    """Arrow batches are bounded by bytes, so giant texts don't meet in one."""
    import pandas as pd
    from kassa.llm.common import small_batches
    small_batches(spark)
    docs = spark.range(12, numPartitions=1).selectExpr("id", "repeat('x', 6000000) AS text")

    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"n": [len(b)]})
    assert max(r.n for r in docs.mapInPandas(sizes, "n long").collect()) <= 3
