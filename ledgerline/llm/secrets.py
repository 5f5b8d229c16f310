"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

The patterns find what announces itself. Other strings are scored by two first-order Markov
models over the characters of identifiers: the log-likelihood ratio of a string is the sum of
one table entry per pair of neighbours. A string is reported once its ratio outweighs the
prior odds of meeting a secret. Counts of neighbours come from labelled samples by one
aggregation; the table has one entry for each pair of characters.

All of it is column expressions over the whole text, row by row: nothing is shuffled.

Null texts are empty. Every row gives one row. Offsets count code points, ends exclusive.
A text of n characters with m reported spans costs n * m at most to place them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import let, quoted, without

# The patterns, their least lengths, and the order of kinds.
KEY = "|".join(["[pP][aA][sS][sS][wW][oO][rR][dD]", "[pP][aA][sS][sS][wW][dD]", "[sS][eE][cC][rR][eE][tT]", "[tT][oO][kK][eE][nN]", "[aA][pP][iI]_?[kK][eE][yY]"])
ASSIGN = rf"""({KEY})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ["assign", "access", "hex", "markov"]

#: Strings that the models judge: identifier characters, so many at least, a letter among them. Short ones are left to
#: the likelihood ratio.
LEAST = 8
#: Values of the patterns that are taken for random: shorter ones are often words.
LEAST_RANDOM = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: One string in so many is taken to be a secret before its characters are seen.
PRIOR = 1_000_000
#: Documents from which the query takes its labelled strings: those of least hash.
SAMPLE_DOCS = 2_000
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _places(text: Column, pattern: str, found: Column, kind: int, keep=None) -> Column:
    """Spans of all matches of a pattern, ``found`` being their texts; ``keep`` judges a match."""
    parts = F.zip_with(
        F.split(text, pattern, -1),
        found,
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(hit), F.lit(0)).alias("hit")),
    )
    marked = F.transform(found, lambda hit, i: F.struct((F.lit(True) if keep is None else keep(hit)).alias("kept"), i.alias("i")))

    def placed(lengths: Column):
        def place(m):
            before = F.aggregate(F.slice(lengths, F.lit(1), m["i"] + 1), F.lit(0), lambda n, x: n + x["gap"] + x["hit"])
            size = F.get(lengths, m["i"])["hit"]
            return F.struct((before - size).alias("start"), F.lit(kind).alias("kind"), before.alias("end"))

        return place

    def spans(chosen: Column) -> Column:
        some = let(parts, lambda lengths: F.transform(chosen, placed(lengths)))
        return F.when(F.size(chosen) > 0, some).otherwise(F.array().cast(SPAN))

    return let(F.filter(marked, lambda m: m["kept"]), spans)


def _matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def base_spans(docs: DataFrame, text: str = "text", spans: str = "base") -> DataFrame:
    """``docs`` with the spans of the fixed patterns, by start, then kind."""
    kept = without(docs, spans)
    whole = F.coalesce(quoted(text), F.lit(""))
    found = kept.select(
        "*",
        whole.alias("__text"),
        _matches(whole, ASSIGN).alias("__assign"),
        _matches(whole, ACCESS).alias("__access"),
        _matches(whole, HEX).alias("__hex"),
    )
    long_enough = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= ASSIGN_LEAST
    all_spans = F.concat(
        _guarded("__assign", ASSIGN, 0, long_enough), _guarded("__access", ACCESS, 1), _guarded("__hex", HEX, 2)
    )
    return found.select(*[quoted(c) for c in kept.columns], F.array_sort(all_spans).alias(spans))


def _guarded(found: str, pattern: str, kind: int, keep=None) -> Column:
    """No second look at texts without a match."""
    spans = _places(F.col("__text"), pattern, F.col(found), kind, keep)
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPAN))


class Model:
    """Log-likelihood ratio of random against ordinary, by pair of neighbours."""

    def __init__(self, counts: dict[tuple[bool, int, int], int]):
        size = len(ALPHABET)
        self.table = []
        logs = {}
        for random in (True, False):
            for a in range(1, size + 1):
                own = [counts.get((random, a, b), 0) + 0.5 for b in range(1, size + 1)]
                total = sum(own)
                logs[random, a] = [math.log(n / total) for n in own]
        for a in range(1, size + 1):
            self.table += [round(x - y, 3) for x, y in zip(logs[True, a], logs[False, a], strict=True)]

    def score(self, string: Column) -> Column:
        table = F.split(F.lit(",".join(map(str, self.table))), ",").cast("array<double>")
        code = lambda i: F.instr(F.lit(ALPHABET), F.substring(string, i, 1))
        return F.aggregate(
            F.sequence(F.lit(1), F.length(string) - 1),
            F.lit(0.0),
            lambda s, i: s + F.element_at(table, (code(i) - 1) * len(ALPHABET) + code(i + 1)),
        )


def train(labelled: DataFrame) -> Model:
    """From ``(string, random)``: strings over ALPHABET of two characters or more and a boolean label.

    Other strings and null labels are left out. Only counts per pair of characters reach the driver.
    """
    fit = labelled.where(F.col("string").rlike(rf"\A[A-Za-z0-9+/_=-]{{2,}}\z") & F.col("random").isNotNull())
    pairs = fit.select("random", "string", F.explode(F.sequence(F.lit(1), F.length("string") - 1)).alias("i"))
    code = lambda at: F.expr(f"instr('{ALPHABET}', substring(string, {at}, 1))")
    counted = pairs.groupBy("random", code("i").alias("a"), code("i + 1").alias("b")).count().collect()
    return Model({(r["random"], r["a"], r["b"]): r["count"] for r in counted})


def labelled_strings(docs: DataFrame, id: str = "doc_id", text: str = "text", most: int = SAMPLE_DOCS) -> DataFrame:
    """Labelled strings from the ``most`` documents of least hash.

    Random: values that the patterns found there, and digests of the ids in hex, base64 and capitals.
    Ordinary: the other identifiers of 4 characters or more, alone and joined with the next one in three fashions, and in capitals, as headings and constants have them.
    """
    ids = docs.select(F.xxhash64(id, text).alias("__h")).orderBy("__h").limit(most)
    some = docs.select(id, text, F.xxhash64(id, text).alias("__h")).join(ids, "__h", "left_semi")
    values = some.select(F.explode(_matches(F.coalesce(F.col(text), F.lit("")), f"{ASSIGN}|{ACCESS}|{HEX}")).alias("v"))
    values = values.select(F.regexp_extract("v", r"([A-Za-z0-9+/_=-]+)\z", 1).alias("string")).where(f"length(string) >= {LEAST_RANDOM}")
    digest = F.sha2(F.concat_ws("/", F.col(id).cast("string"), F.xxhash64(text).cast("string")), 256)
    # a second digest renders hex as capitals and digits, as access keys are
    capitals = F.translate(F.upper(F.substring(F.base64(F.unhex(digest)), 1, 40)), "+/=", "XYZ")
    digests = some.select(F.explode(F.array(digest, F.base64(F.unhex(digest)), capitals)).alias("string"))
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    own = some.select(F.array_distinct(_matches(plain, "[A-Za-z]{4,}")).alias("ws"))
    # the outer form: for the plain one the optimizer adds a filter that would work all this out a second time
    own = own.select(F.explode_outer(F.transform("ws", lambda w, i: F.struct(w.alias("w"), F.get("ws", i + 1).alias("next"), i.alias("i")))).alias("x"))
    own = own.where("x is not null").select("x.w", F.coalesce("x.next", "x.w").alias("next"), "x.i")
    joined = F.array(
        F.col("w"),
        F.lower(F.concat_ws("_", "w", "next")),
        F.concat(F.lower("w"), F.initcap("next")),
        F.lower(F.concat_ws("-", "w", F.col("i").cast("string"))),
        F.upper(F.concat_ws("_", "w", "next")),
    )
    ordinary = own.select(F.explode(joined).alias("string"))
    return (
        values.unionByName(digests).withColumn("random", F.lit(True)).unionByName(ordinary.withColumn("random", F.lit(False)))
    )


def scan(docs: DataFrame, model: Model, text: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """``docs`` with ``base`` (spans of the patterns) and ``spans`` (those and the models')."""
    kept = base_spans(without(docs, base, spans), text, base)
    whole = F.coalesce(quoted(text), F.lit(""))
    found = kept.select("*", whole.alias("__text"), _matches(whole, CANDIDATE).alias("__strings"))
    least = math.log(PRIOR)
    likely = lambda hit: F.when(hit.rlike("[A-Za-z]"), model.score(hit) >= least).otherwise(False)
    found = found.withColumn("__new", _guarded("__strings", CANDIDATE, 3, likely))
    apart = F.filter(
        "__new",
        lambda n: ~F.exists(base, lambda b: (b["start"] < n["end"]) & (n["start"] < b["end"])),
    )
    return found.select(*[quoted(c) for c in kept.columns], F.array_sort(F.concat(quoted(base), apart)).alias(spans))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each run of overlapping spans replaced by ``mark``."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s, x):
        apart = x["start"] >= s["at"]
        more = F.concat(s["out"], text.substr(s["at"] + 1, x["start"] - s["at"]), F.lit(mark))
        return F.struct(F.greatest(s["at"], x["end"]).alias("at"), F.when(apart, more).otherwise(s["out"]).alias("out"))

    rest = lambda s: F.concat(s["out"], text.substr(s["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, rest)).otherwise(text)
