"""Benchmark decontamination: windows of benchmark words found in documents.

Words are runs of digits, a-z (after folding A-Z) and letters beyond ASCII. An item's windows are its runs
of ``width`` consecutive words; a shorter item is one window. The n-grams of ``ANCHOR`` words inside windows
go to every executor as a hash set. A document need not be looked up at each word: with a step of
width - ANCHOR + 1 words, exactly one n-gram of the document's grid lies inside any window, and
where that one is met, the whole window is compared word by word. Nothing but hits and
one row per document is shuffled.

Null and empty texts have no words; items without words have no windows; null item ids hit, but
are not listed. Rows that repeat id and text give one row. Rows with a null id are reported under
the null id, one for each text. Empty tables on either side give no hits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower

#: Fixed value: what a word is, in lower case and in any case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 13
#: Words of the n-grams that are looked up; all words of a shorter window.
ANCHOR = 5
#: N-grams with their windows sent to every executor at once, of a few hundred bytes each. More are cut
#: by their hash into slices of this size, each with a pass of its own over the documents.
BROADCAST_ANCHORS = 300_000
#: Stands first among a document's windows, so that one without hits keeps its row.
HEAD = 0


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _grid(length: int, words: Column) -> Column:
    """``(at, hash)`` of every n-gram on a document's grid for windows of ``length`` words."""
    size = min(ANCHOR, length)
    grid = F.sequence(F.lit(1), F.size(words) - size + 1, F.lit(length - size + 1))
    found = F.transform(grid, lambda at: F.struct(at.alias("at"), F.xxhash64(F.slice(words, at, size), F.lit(length)).alias("hash")))
    return F.when(F.size(words) >= length, found).otherwise(F.array().cast("array<struct<at:int,hash:bigint>>"))


def anchors_of(benchmark: DataFrame, id: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``(hash, before, window, items)``: each distinct window with the items that hold it, once for each of
    its n-grams; ``before`` is the number of words in front of the n-gram."""
    items = benchmark.select(F.col(id).alias("item"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(width))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    every = items.select("item", "words", length.alias("length"), F.explode(starts).alias("at"))
    every = every.select("item", F.slice("words", F.col("at"), F.col("length")).alias("window"))
    every = every.groupBy("window").agg(F.collect_set("item").alias("items"))
    size = F.least(F.size("window"), F.lit(ANCHOR))
    every = every.select("window", "items", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("window") - size)).alias("before"))
    return every.select(
        F.xxhash64(F.slice("window", F.col("before") + 1, F.col("size")), F.size("window")).alias("hash"), "before", "window", "items"
    )


def hits(
    docs: DataFrame,
    benchmark: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """Per document: ``id``, ``text_hash``, ``n_words``, ``n_hit``, ``spans`` (first word from 1, and length
    of each hit window, in order) and ``items`` (sorted as strings)."""
    anchors = anchors_of(benchmark, item_id, item_text, width)
    shape = anchors.groupBy(F.size("window").alias("length")).count().collect()  # at most ``width`` rows
    slices = max(1, -(-sum(r["count"] for r in shape) // BROADCAST_ANCHORS))

    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("words"))
    head = F.array(F.struct(F.lit(0).alias("at"), F.lit(HEAD).cast("long").alias("hash")))
    grids = [_grid(r["length"], F.col("words")) for r in sorted(shape)]
    rows = rows.select("id", "text_hash", "words", F.concat(head, *grids).alias("own"))
    # the outer form: for the plain one the optimizer adds a filter that would work all this out a second time
    rows = rows.select("id", "text_hash", "words", F.inline_outer("own"))

    first = docs.sparkSession.range(1).select(
        F.lit(HEAD).cast("long").alias("hash"),
        F.lit(0).alias("before"),
        F.array().cast("array<string>").alias("window"),
        F.array().cast(anchors.schema["items"].dataType).alias("items"),
    )
    length, start = F.size("window"), F.col("at") - F.col("before")
    same = F.slice("words", F.greatest(start, F.lit(1)), length) == F.col("window")
    agrees = F.when(length == 0, F.col("at") == 0).otherwise((start >= 1) & same)
    parts = []
    for part in range(slices):
        some = anchors.where(F.pmod("hash", F.lit(slices)) == part) if slices > 1 else anchors
        met = rows.join(F.broadcast(some.unionByName(first)), "hash").where(agrees)
        span = F.struct(start.alias("at"), length.alias("length"))
        parts.append(met.select("id", "text_hash", F.size("words").alias("n_words"), span.alias("span"), "items"))
    found = reduce(DataFrame.unionByName, parts)
    found = found.groupBy("id", "text_hash").agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(F.col("span.length") > 0, F.col("span")))).alias("spans"),
        F.flatten(F.collect_set("items")).alias("items"),
    )
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("covered"))
    covered = F.aggregate(
        "spans",
        start,
        lambda s, x: F.struct(
            F.greatest(s["end"], x["at"] + x["length"]).alias("end"),
            (s["covered"] + F.greatest(F.lit(0), x["at"] + x["length"] - F.greatest(s["end"], x["at"]))).alias("covered"),
        ),
        lambda s: s["covered"].cast("long"),
    )
    items = F.array_sort(F.array_distinct(F.transform("items", lambda i: i.cast("string"))))
    return found.select("id", "text_hash", "n_words", covered.alias("n_hit"), "spans", items.alias("items"))


def is_contaminated(percent: int = 5) -> Column:
    """At least ``percent`` of the words are hit."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", percent: int = 5) -> DataFrame:
    """``docs`` less the contaminated rows, all columns kept."""
    bad = hits(docs, benchmark, id, text).where(is_contaminated(percent)).select(
        F.col("id").alias("__id"), F.col("text_hash").alias("__hash")
    )
    same = docs[id].eqNullSafe(bad["__id"]) & (F.xxhash64(docs[text]) == bad["__hash"])
    return docs.join(bad, same, "left_anti")


def remove_spans(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the hit words cut out of the texts; what stands between words stays."""
    bad = hits(docs, benchmark, id, text).where("n_hit > 0").select(
        F.col("id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans")
    )
    same = docs[id].eqNullSafe(bad["__id"]) & (F.xxhash64(docs[text]) == bad["__hash"])
    both = docs.join(bad, same, "left")
    gaps = F.split(text, ANY_CASE_WORD, -1)
    own = F.regexp_extract_all(text, F.lit(ANY_CASE_WORD), F.lit(0))
    hit = lambda i: F.exists("__spans", lambda s: (s["at"] <= i + 1) & (i + 1 < s["at"] + s["length"]))
    kept = F.transform(own, lambda w, i: F.when(hit(i), F.lit("")).otherwise(w))
    cut = F.array_join(F.flatten(F.zip_with(gaps, kept, lambda g, w: F.array(g, F.coalesce(w, F.lit(""))))), "")
    new = F.when(F.col("__spans").isNull(), docs[text]).otherwise(cut)
    return both.select(*[new.alias(c) if c == text else docs[c] for c in docs.columns])
