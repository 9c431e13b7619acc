"""Line dedup by winnowing, in DataFrame functions only.

The unit is the line; blank lines don't count. A gram is the fewest lines from
a line on that hold GRAM_WORDS words together, and its hash is made of the
hashes of these lines. In every stretch of lines that holds RUN_WORDS words
the gram of least hash is selected (the last one of equals). Any run of
RUN_WORDS words or more that two places share therefore has a selected gram in
common: the fingerprints are guaranteed.

Documents with a fingerprint that stands at several places are compared by the
hashes of whole runs: for every line, the fewest lines from it on and the
fewest lines up to it that hold RUN_WORDS words. Any run of RUN_WORDS words or
more is the union of such shortest runs inside it, so a line is deleted if and
only if it is part of a run of RUN_WORDS words or more that stands at an earlier
place too (documents in the order of doc_id), whatever surrounds it there. The
first place of a run stays; deleted runs that touch are one span.

Only line hashes and places are shuffled until the texts are cut; every window
spans one document.

Defined results: a null text stays null and an empty one empty; a text of
fewer words than RUN_WORDS stays as it is; lines are equal when identical;
rows that share doc_id and text are one document and get the same result;
documents without doc_id come last in order; an empty table gives an empty
result; other columns are kept as they are, whatever their names, but for
``text`` and ``removed_spans``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import drop_kept, keep, text_of, whole_row

WORD = r"[^\x20\x09-\x0D]+"
RUN_WORDS = 50
GRAM_WORDS = 40
LAST = 2 ** 63 - 1  # the place of documents without doc_id

DOC = ["_d", "_h"]


def line_hash(text: Column) -> Column:
    """The whole MD5: with 128 bits, lines and runs that differ don't meet by
    chance in a corpus of any size."""
    return F.md5(text)


def keyed(docs: DataFrame) -> DataFrame:
    """Adds what names a document: its id (for the order) and a hash that
    tells rows apart which share it."""
    return docs.withColumns({"_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), "_h": F.xxhash64("doc_id", text_of())})


def lines(docs: DataFrame, run_words: int, gram_words: int) -> DataFrame:
    """A row per line that has words: document, pos (its line number), idx
    (its number among such lines), start (words before it), n (words), line
    (hash), and ``pick``: the (gram hash, -idx) selected in the stretch that
    starts at this line."""
    found = (keyed(docs.select("doc_id", "text")).select(*DOC, F.posexplode(F.split(text_of(), "\n")).alias("pos", "_l"))
             .select(*DOC, "pos", line_hash(F.col("_l").cast("binary")).alias("line"), F.regexp_count("_l", F.lit(WORD)).alias("n"))
             .where("n > 0").repartition(*DOC).dropDuplicates([*DOC, "pos"]))
    doc = W.partitionBy(*DOC)
    by_pos, by_word = doc.orderBy("pos"), doc.orderBy("start")
    placed = (found.withColumn("idx", F.row_number().over(by_pos) - 1)
              .withColumn("start", F.sum("n").over(by_pos) - F.col("n"))
              .withColumn("total", F.sum("n").over(doc)))
    gram = F.concat_ws(",", F.collect_list("line").over(by_word.rangeBetween(0, gram_words - 1)))
    grams = placed.withColumn("gram", F.when(F.col("start") + gram_words <= F.col("total"), line_hash(gram.cast("binary"))))
    pick = F.min(F.when(F.col("gram").isNotNull(), F.struct("gram", (-F.col("idx")).alias("back")))).over(
        by_word.rangeBetween(0, run_words - gram_words))
    return grams.withColumn("pick", F.when(F.col("start") + run_words <= F.col("total"), pick)).select(
        *DOC, "pos", "idx", "start", "n", "line", "pick")


def repeated_prints(found: DataFrame) -> DataFrame:
    """Documents that hold a fingerprint which stands at several places."""
    picked = found.where("pick is not null").select(
        *DOC, F.col("pick.gram").alias("gram"), F.col("pick.back").alias("back")).distinct()
    several = picked.groupBy("gram").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("gram")
    return picked.join(several, "gram").select(*DOC).distinct()


def whole_runs(found: DataFrame, run_words: int) -> DataFrame:
    """A row per shortest run: document, first and last idx, first and last
    line number, words before it and up to its end, and ``key``: its
    fingerprint and the hash of all its lines. Every line starts one (the
    fewest lines from it on that hold run_words words) and ends one (the fewest
    up to it), named once where the two are the same."""
    near = found.join(repeated_prints(found), DOC).withColumn("end", F.col("start") + F.col("n"))
    on = W.partitionBy(*DOC).orderBy("start").rangeBetween(0, run_words - 1)
    back = W.partitionBy(*DOC).orderBy("end").rangeBetween(1 - run_words, 0)
    at = F.struct("idx", "pos", "start", "end", F.col("pick.gram").alias("gram"))
    hashed = lambda w: line_hash(F.concat_ws(",", F.collect_list("line").over(w)).cast("binary"))
    both = near.select(*DOC, at.alias("at"), F.last(at).over(on).alias("to"), hashed(on).alias("ahead"), F.first(at).over(back).alias("since"),
                       F.lag("end").over(W.partitionBy(*DOC).orderBy("end")).alias("before"), hashed(back).alias("behind"))
    run = lambda a, b, h: F.struct(a["idx"].alias("lo"), b["idx"].alias("hi"), a["pos"].alias("first"), b["pos"].alias("last"),
                                   a["start"].alias("start"), b["end"].alias("end"), F.struct(a["gram"].alias("gram"), h.alias("run")).alias("key"))
    at, to, since = F.col("at"), F.col("to"), F.col("since")
    starts = to["end"] - at["start"] >= run_words
    ends = (at["end"] - since["start"] >= run_words) & (F.col("before") - since["start"] >= run_words)
    runs = F.array(F.when(starts, run(at, to, F.col("ahead"))), F.when(ends, run(since, at, F.col("behind"))))
    return both.select(*DOC, F.explode(F.filter(runs, lambda r: r.isNotNull())).alias("r")).select(*DOC, "r.*")


def repeated_runs(runs: DataFrame) -> DataFrame:
    """document, ``spans``: (first, last line number, words) of its repeated
    runs, in order."""
    place = F.struct(*DOC, "lo")
    # written, so that the join below has two plain inputs and AQE can split a hot key
    origin = keep(runs.groupBy("key").agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("times")).where("times > 1")
                  .select("key", "origin"), "origin")
    later = runs.join(origin, "key").where(place != F.col("origin")).select(*DOC, "lo", "hi", "first", "last", "start", "end")
    doc = W.partitionBy(*DOC).orderBy("lo", "hi")
    reached = F.max("hi").over(doc.rowsBetween(W.unboundedPreceding, -1))
    apart = F.coalesce(F.col("lo") > reached + 1, F.lit(True)).cast("int")
    united = (later.withColumn("apart", apart).withColumn("group", F.sum("apart").over(doc.rowsBetween(W.unboundedPreceding, 0)))
              .groupBy(*DOC, "group").agg(F.min("first").alias("first"), F.max("last").alias("last"),
                                          (F.max("end") - F.min("start")).alias("words")))
    return united.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("first", "last", "words"))).alias("spans"))


def dedup_lines(docs: DataFrame, run_words: int = RUN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """The rows of ``docs`` with repeated runs cut from ``text``, and
    ``removed_spans``: (first, last line number, words) of what was cut, empty
    where nothing was."""
    if not 0 < gram_words <= run_words:
        raise ValueError("gram_words has to lie between 1 and run_words")
    found = keep(lines(docs, run_words, gram_words), "lines")
    runs = keep(whole_runs(found, run_words), "runs")
    drop_kept(found)
    spans = keep(repeated_runs(runs), "spans")
    drop_kept(runs)
    row, none = whole_row(docs), F.array().cast(spans.schema["spans"].dataType)
    inside = lambda i: F.exists("spans", lambda s: (s["first"] <= i) & (i <= s["last"]))
    text = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.filter(F.split("row.text", "\n"), lambda x, i: ~inside(i)), "\n"))
    named = keyed(docs.select("doc_id", "text", row.alias("row"))).select(*DOC, "row").join(spans.hint("shuffle_hash"), DOC, "left")
    return named.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns if c != "removed_spans"],
                        F.coalesce("spans", none).alias("removed_spans"))
