"""License scan by a positional index of rare words, in DataFrame functions only.

The words of the licence templates form a small vocabulary. One pass over the
texts keeps, for each file, where vocabulary words stand; everything else works
on those short lists.

A corpus count gives each vocabulary word its inverse document frequency. The
index has postings (template, place) for the words of highest IDF of each
template, taken from its mandatory key phrases. A file's words are looked up in
it: each hit proposes the start ``position - place`` of a template, and a start
that all of the template's postings propose is a candidate (the intersection by
relative position). Only for files with candidates, the other words are looked
up too: a candidate stays if all words of the key phrases stand at their places,
and MATCH_SHARE of all the template's words do, counted from that one start.

Defined results: a null text is the empty text and has no words; words are
numbered from 0; a document without a phrase has null first_word and
last_word, empty labels and score 0; repeated rows give repeated results; an
empty table gives an empty result; other columns pass by unread.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, keep, text_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrase and label.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    """A licence wording: its words by place (None: any word may stand there)
    and the key phrases, place and words, that have to stand in a match."""

    label: str
    words: tuple[str | None, ...]
    keys: tuple[tuple[int, tuple[str, ...]], ...]


def template(label: str, wording: str, *keys: str) -> Template:
    """``wording`` in lower case, ``*`` for any word; ``keys`` are parts of it."""
    words = wording.split()
    found = []
    for key in keys:
        k = key.split()
        at = next(i for i in range(len(words)) if words[i:i + len(k)] == k)
        found.append((at, tuple(k)))
    return Template(label, tuple(None if w == "*" else w for w in words), tuple(found))


# Wordings by which common licences are declared. Stop words are
# left open, which keeps the lists of word places short.
TEMPLATES = (
    template("gpl-3.0", "licensed under * gnu general public license version 3", "gnu general public license version 3"),
    template("gpl-2.0", "licensed under * gnu general public license version 2", "gnu general public license version 2"),
    template("lgpl", "under * gnu lesser general public license", "gnu lesser general public license"),
    template("mit", "under * mit license", "mit license"),
    template("mit", "permission * hereby granted free * charge * any person obtaining * copy", "hereby granted free", "person obtaining"),
    template("apache-2.0", "under * apache license version 2 0", "apache license version 2 0"),
    template("bsd", "redistribution * use * source * binary forms * * without modification * permitted",
             "redistribution", "binary forms", "without modification"),
    template("mpl-2.0", "subject * * terms * * mozilla public license v 2 0", "mozilla public license v 2 0"),
    template("cc-by-4.0", "under cc by 4 0", "cc by 4 0"),
    template("cc-by-sa-4.0", "under cc by sa 4 0", "cc by sa 4 0"),
    template("cc-by-nc-4.0", "under cc by nc 4 0", "cc by nc 4 0"),
    template("cc-by-nd-4.0", "under cc by nd 4 0", "cc by nd 4 0"),
)
RAREST = 3        # words of a template that have postings in the index
MATCH_SHARE = 0.6  # of a template's words that have to stand at their places from a start


def vocabulary(templates=TEMPLATES, base=BASE) -> list[str]:
    return sorted({w for t in templates for w in t.words if w} | {w for p in base for w in p.split()})


def word_hits(docs: DataFrame, vocab: list[str], carry: list[str]) -> DataFrame:
    """``_row`` (a number of the row), the carried columns as _c0, _c1.., n_words, and ``hits``: (pos, word number) of every
    vocabulary word, in order. The only pass over the texts."""
    numbers = F.create_map(*[F.lit(x) for i, w in enumerate(vocab) for x in (w, i)])
    words = F.regexp_extract_all(ascii_lower(text_of()), F.lit(WORD), F.lit(0))
    named = [F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]
    carry = ["_row", *[f"_c{i}" for i in range(len(carry))]]
    return (docs.select(F.monotonically_increasing_id().alias("_row"), *named, words.alias("_w"))
            .select(*carry, F.size("_w").cast("long").alias("n_words"),
                    F.filter(F.transform("_w", lambda w, i: F.when(w.isin(vocab), F.struct(i.alias("pos"), w.alias("word")))),
                             lambda h: h.isNotNull()).alias("_h"))
            .select(*carry, "n_words",
                    F.transform("_h", lambda h: F.struct(h.pos.alias("pos"), numbers[h.word].alias("word"))).alias("hits")))


def inverse_document_frequency(hits: DataFrame, vocab: list[str]) -> dict[str, float]:
    """Over all documents; one number a vocabulary word comes to the driver."""
    n = hits.count()
    seen = dict(hits.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h.word))).alias("word"))
                .groupBy("word").count().collect())
    return {w: log((1 + n) / (1 + seen.get(i, 0))) for i, w in enumerate(vocab)}


def phrase_starts(hits: Column, words: tuple[str, ...], vocab: list[str]) -> Column:
    """Where the words stand consecutively. All of them are vocabulary words,
    so neighbours in the text are neighbours in ``hits``."""
    n = [vocab.index(w) for w in words]

    def stands(h, i):
        at = h.word == n[0]
        for k in range(1, len(n)):
            nxt = F.get(hits, i + k)
            at = at & F.coalesce((nxt.word == n[k]) & (nxt.pos == h.pos + k), F.lit(False))
        return at
    return F.transform(F.filter(hits, stands), lambda h: h.pos)


def rare_places(t: Template, idf: dict[str, float], rarest: int = RAREST) -> list[int]:
    """Places of the words of highest IDF among a template's key phrases."""
    needed = {p + i for p, k in t.keys for i in range(len(k))}
    return sorted(needed, key=lambda p: (-idf[t.words[p]], p))[:rarest]


def postings(templates, vocab: list[str], places) -> dict[int, list[tuple[int, int]]]:
    """Word number -> (template number, place), of the places that
    ``places(template)`` names."""
    out: dict[int, list[tuple[int, int]]] = {}
    for i, t in enumerate(templates):
        for p in places(t):
            out.setdefault(vocab.index(t.words[p]), []).append((i, p))
    return out


def proposed(hits: DataFrame, index: dict[int, list[tuple[int, int]]]) -> DataFrame:
    """_row, template, start and place for every hit that has postings. The
    index is as long as the templates' wordings, not data."""
    listed = F.create_map(*[x for w, ps in index.items() for x in (
        F.lit(w), F.array(*[F.struct(F.lit(t).alias("template"), F.lit(p).alias("place")) for t, p in ps]))])
    of = lambda h: F.transform(listed[h["word"]], lambda p: F.struct(
        p["template"].alias("template"), (h["pos"] - p["place"]).alias("start"), p["place"].alias("place")))
    found = F.flatten(F.transform(F.filter("hits", lambda h: h["word"].isin(*index)), of))
    return hits.select("_row", F.explode(found).alias("p")).select("_row", "p.template", "p.start", "p.place")


def template_matches(hits: DataFrame, templates, vocab: list[str], idf: dict[str, float], index=None) -> DataFrame:
    """_row, template, start, share: the starts that the index proposes and
    that hold the key phrases and enough of the other words. ``index`` replaces
    the postings of the rare words."""
    rare = [rare_places(t, idf) for t in templates]
    if index is None:
        index = postings(templates, vocab, lambda t: rare_places(t, idf))
    number = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("template") + 1)
    at = ["_row", "template", "start"]
    candidates = proposed(hits, index).groupBy(*at).agg(F.count(F.lit(1)).alias("votes")).where(
        F.col("votes") == number([len(r) for r in rare])).drop("votes")
    every = postings(templates, vocab, lambda t: [p for p, w in enumerate(t.words) if w])
    keys = [{p + i for p, k in t.keys for i in range(len(k))} for t in templates]
    is_key = F.lit(False)
    for i, places in enumerate(keys):
        is_key = is_key | ((F.col("template") == i) & F.col("place").isin(*places))
    near = hits.join(candidates.select("_row").distinct().hint("shuffle_hash"), "_row", "left_semi")
    seen = proposed(near, every).join(candidates, at, "left_semi").groupBy(*at).agg(
        F.count(F.lit(1)).alias("n"), F.sum(is_key.cast("int")).alias("key_words"))
    share = F.col("n") / number([float(sum(1 for w in t.words if w)) for t in templates])
    return seen.where(F.col("key_words") == number([len(k) for k in keys])).select(*at, share.alias("share")).where(
        F.col("share") >= MATCH_SHARE)


def span(starts: Column, n: int, label: str) -> Column:
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.lit(n).alias("length"), F.lit(label).alias("label")))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, base=BASE, carry: list[str] | None = None) -> DataFrame:
    """doc_id (or ``carry``), n_words, n_base, first_word, last_word,
    base_labels, labels, score, and ``spans``: (label, start, length) of every
    place found, base phrases and templates, in order."""
    carry = carry or ["doc_id"]
    vocab = vocabulary(templates, base)
    hits = keep(word_hits(docs, vocab, carry), "license-hits")
    idf = inverse_document_frequency(hits, vocab)
    row = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("template") + 1)
    matches = template_matches(hits, templates, vocab, idf).withColumns(
        {"length": row([len(t.words) for t in templates]), "label": row([t.label for t in templates])})
    matches = keep(matches.groupBy("_row").agg(F.collect_list(F.struct("start", "length", "label")).alias("found"),
                                               F.max("share").alias("best")), "license-matches")
    col, none = F.col("hits"), F.array().cast("array<int>")
    phrases = [(f"_b{i}", p.split(), label) for i, (p, label) in enumerate(base.items())]
    found = hits
    for name, words, _ in phrases:
        found = found.withColumn(name, F.when(F.size(col) >= len(words), phrase_starts(col, tuple(words), vocab)).otherwise(none))
    found = found.drop("hits").join(matches.hint("shuffle_hash"), "_row", "left")
    every = F.concat(*[F.col(name) for name, _, _ in phrases])
    of_base = F.filter(F.array(*[F.when(F.size(name) > 0, F.lit(label)) for name, _, label in phrases]), lambda x: x.isNotNull())
    of_templates = F.coalesce(F.transform("found", lambda m: m["label"]), F.array().cast("array<string>"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    spans = F.array_sort(F.concat(F.coalesce("found", F.array().cast(matches.schema["found"].dataType)),
                                  *[span(F.col(name), len(w), label) for name, w, label in phrases]))
    best = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size(every) > 0, F.lit(0.5)).otherwise(0.0))
    return found.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        joined(of_base).alias("base_labels"), joined(F.concat(of_base, of_templates)).alias("labels"), best.alias("score"), spans.alias("spans"))
