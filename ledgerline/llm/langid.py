"""Language identification of texts that may mix languages.

The script of a word narrows the languages it may be in. Each of those scores the word by an even mix of
two models learned from labelled rows: the share of the word among the language's words, and a
character trigram model with back-off. Viterbi then labels the words of a text, each change of
language costing ``SWITCH`` nats. The text's language is the one with most letters; the score is its
share of them.

Models come from a bounded sample: at most ``TRAIN_DOCS`` labelled texts for each language,
those of least hash. Only their counts reach the driver.

Null texts and texts without a letter are ``und`` with score 0. A text whose script no language uses gets
the first language with score 0. Without any labelled row everything is ``und``. Ties go to the language
first in order. Every row gives one row; columns that carry an output's name are replaced.
"""

from __future__ import annotations

import bisect
import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (as pa.compute)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.bpe import chunks
from ledgerline.llm.common import broadcast_if_small, give_back, staged, without

UNKNOWN = "und"
TRAIN_DOCS = 1_500
#: Parts of a language in which the sample is looked for first.
SAMPLE_PARTS = 256
#: Sampled texts' hashes (some 30 bytes each) sent to every executor; with more languages they are shuffled.
BROADCAST_MARKS = 300_000
#: Words seen less often in the sample have no share of their own.
LEAST_COUNT = 4
SWITCH = 8.0
#: A language uses a script if at least this share of its letters is in it.
SCRIPT_SHARE = 0.02
NOT_A_CANDIDATE = -60.0
REMEMBERED = 50_000
CHUNK = 1 << 20

#: First code points of script ranges; a range ends where the next begins.
SCRIPTS = [
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0780, "other"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "other"),
    (0x0B80, "tamil"),
    (0x0C00, "other"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
    (0x32000, "other"),
]
STARTS, NAMES = [s for s, _ in SCRIPTS], [n for _, n in SCRIPTS]
WORD = re.compile(r"[^\W\d_]+")
BEGIN, END = "\x02", "\x03"


def script(char: str) -> str:
    return NAMES[bisect.bisect_right(STARTS, ord(char)) - 1]


class Model:
    """Scores of words in each language."""

    def __init__(self, words: dict[str, dict[str, int]], totals: dict[str, int], grams: dict[str, dict[str, int]]):
        self.languages = sorted(totals)
        self.words, self.totals, self.grams = words, totals, grams
        self.contexts, self.scripts = {}, {}
        for lang in self.languages:
            contexts: dict[str, int] = {}
            letters: dict[str, int] = {}
            for gram, n in grams[lang].items():
                contexts[gram[:-1]] = contexts.get(gram[:-1], 0) + n
                if len(gram) == 1 and gram != END:
                    letters[script(gram)] = letters.get(script(gram), 0) + n
            self.contexts[lang] = contexts
            self.scripts[lang] = {s for s, n in letters.items() if n >= SCRIPT_SHARE * sum(letters.values())}
        self.share_rows = {w: i for i, w in enumerate(sorted(set().union(*self.words.values())), 1)}
        self.shares = np.zeros((len(self.share_rows) + 1, len(self.languages)))  # the first row is of unknown words
        for x, lang in enumerate(self.languages):
            for word, n in self.words[lang].items():
                self.shares[self.share_rows[word], x] = n / max(1, self.totals[lang])
        self.uses = np.array([[name in self.scripts[x] for x in self.languages] for name in NAMES], bool)
        self.clear()
        self.forget_spelling()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.languages)), np.float32)
        self.sizes = np.zeros(0, np.int64)

    def forget_spelling(self) -> None:
        self.spelling: dict[int, int] = {}
        self.gram_scores = np.zeros((0, len(self.languages)))

    def _gram(self, lang: str, gram: str) -> float:
        """Log-probability of a trigram's last character after the other two."""
        grams, contexts = self.grams[lang], self.contexts[lang]
        p = (grams.get(gram[2], 0) + 0.1) / (contexts.get("", 0) + 100)
        for part in (gram[1:], gram):
            p = (grams.get(part, 0) + 2 * p) / (contexts.get(part[:-1], 0) + 2)
        return math.log(p)

    def _learn(self, words: set[str]) -> None:
        """Score words not met before."""
        if len(self.places) > REMEMBERED:
            self.clear()
        if len(self.spelling) > REMEMBERED:
            self.forget_spelling()
        new = [w for w in words if w not in self.places]
        if not new:
            return
        points = np.frombuffer("".join([BEGIN * 2 + w + END for w in new]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        ends = np.cumsum(sizes + 3)
        within = np.ones(len(points), bool)  # places where a trigram begins that doesn't reach into the next word
        within[ends - 1] = within[ends - 2] = False
        # a trigram is one number: 21 bits a character
        grams = ((points[:-2] << 42) | (points[1:-1] << 21) | points[2:])[within[:-2]]
        grams = pa.array(grams).dictionary_encode()
        each = grams.dictionary.to_pylist()
        fresh = [g for g in each if g not in self.spelling]
        if fresh:
            self.spelling.update(zip(fresh, range(len(self.spelling), len(self.spelling) + len(fresh)), strict=True))
            texts = ["".join(chr(g >> bits & 0x1FFFFF) for bits in (42, 21, 0)) for g in fresh]
            rows = np.array([[self._gram(lang, g) for lang in self.languages] for g in texts])
            self.gram_scores = np.concatenate([self.gram_scores, rows])
        at = np.fromiter(map(self.spelling.__getitem__, each), np.int64, len(each))[grams.indices.to_numpy()]
        spelled = np.add.reduceat(self.gram_scores[at], np.cumsum(sizes + 1) - sizes - 1)
        row = self.share_rows.get
        shares = self.shares[np.fromiter([row(w, 0) for w in new], np.int64, len(new))]
        scores = np.maximum(np.log(0.5 * shares + 0.5 * np.exp(spelled) + 1e-300), NOT_A_CANDIDATE)
        may = self.uses[np.searchsorted(STARTS, points[ends - sizes - 1], "right") - 1]
        scores = np.where(may, scores, NOT_A_CANDIDATE)
        scores[~may.any(1)] = 0
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        self.scores = np.concatenate([self.scores, scores.astype(np.float32)])
        self.sizes = np.concatenate([self.sizes, sizes])

    def label(self, texts: list[str]):
        """For each text: language, score, and spans ``(first word, words, language)``."""
        if not self.languages:
            yield from [(UNKNOWN, 0.0, [])] * len(texts)
            return
        found = [WORD.findall(t.lower()) for t in texts]
        for at, words in enumerate(found):
            if words and not any(c.isalpha() for w in words for c in w):
                found[at] = []  # other numerals only
        flat = list(chain.from_iterable(found))
        self._learn(set(flat))
        ids = np.fromiter(map(self.places.__getitem__, flat), np.int64, len(flat))
        scores, sizes = self.scores[ids], self.sizes[ids]
        counted = np.where(scores.any(1), sizes, 0)
        ends = np.cumsum([len(words) for words in found]).tolist()
        cut = [slice(end - len(words), end) for words, end in zip(found, ends, strict=True)]
        labels = viterbi([scores[c] for c in cut], SWITCH)
        for own, c in zip(labels, cut, strict=True):
            if not len(own):
                yield UNKNOWN, 0.0, []
                continue
            letters = np.bincount(own, counted[c], len(self.languages))
            best = int(letters.argmax())
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            spans = zip(cuts.tolist(), np.diff(cuts, append=len(own)).tolist(), own[cuts].tolist(), strict=True)
            yield self.languages[best], float(letters[best] / sizes[c].sum()), [(a, n, self.languages[x]) for a, n, x in spans]


def viterbi(scores: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """Best label of every row of every matrix; a change between rows costs ``switch``.

    All texts advance together, longest first, so that those still running stay in front.
    """
    lengths = np.array([len(s) for s in scores])
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = lengths[order]
    total = int(lengths.sum())
    if not total:
        return [np.zeros(0, np.int64) for _ in scores]
    size = scores[int(order[0])].shape[1]
    running = np.searchsorted(-sorted_lengths, -np.arange(sorted_lengths[0]), "left")  # texts longer than t
    offsets = np.concatenate([[0], np.cumsum(running)])
    flat = np.empty((total, size), np.float32)
    place = [offsets[:n] + rank for rank, n in enumerate(sorted_lengths.tolist())]
    for rank, text in enumerate(order.tolist()):
        flat[place[rank]] = scores[text]
    stayed, came = np.empty((total, size), bool), np.empty(total, np.int16)  # whether a label came from itself, and the best one before
    value = flat[: running[0]].copy()
    final = np.zeros(len(scores), np.int64)
    running, offsets, places = running.tolist(), offsets.tolist(), np.arange(len(scores))
    for t, n in enumerate(running):
        if t:
            if n < running[t - 1]:
                final[n : running[t - 1]] = value[n:].argmax(1)
                value = value[:n]
            here = slice(offsets[t], offsets[t + 1])
            moved = value.max(1, keepdims=True) - switch
            came[here] = value.argmax(1)
            np.greater_equal(value, moved, out=stayed[here])
            value = np.maximum(value, moved)
            value += flat[here]
    final[: running[-1]] = value.argmax(1)
    chosen = np.empty(total, np.int64)
    for t in range(len(running) - 1, -1, -1):
        n, begin = running[t], offsets[t]
        own = final[:n]
        chosen[begin : begin + n] = own
        if t:
            rows = slice(begin, begin + n)
            own[:] = np.where(stayed[rows][places[:n], own], own, came[rows])
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(scores)
    for rank, text in enumerate(order.tolist()):
        out[text] = chosen[place[rank]]
    return out


def held_out(id: Column) -> Column:
    """One id in five, by its checksum; a null id is not held out."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = TRAIN_DOCS) -> Model:
    """From labelled texts; rows without label or text are left out."""
    fit = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    marks = fit.select("lang", F.xxhash64("text").alias("mark")).groupBy("lang", "mark").agg(F.count("*").alias("n"))
    # a language's least hashes are among the least of its parts, so no task ever sees a whole language
    part = F.pmod(F.xxhash64("mark"), F.lit(SAMPLE_PARTS))
    for keys in (["lang", "part"], ["lang"]):
        before = Window.partitionBy(*keys).orderBy("mark").rowsBetween(Window.unboundedPreceding, -1)
        marks = marks.withColumn("part", part).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < most)
    marks = staged(marks.select("lang", "mark"), "marks")
    some = fit.withColumn("mark", F.xxhash64("text")).join(broadcast_if_small(marks, BROADCAST_MARKS), ["lang", "mark"], "left_semi")
    some = staged(some.select("lang", "text").distinct(), "sample")
    found = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    words = some.select("lang", F.explode_outer(found).alias("word")).where("word is not null")
    words = staged(words.groupBy("lang", "word").count(), "words")
    padded = F.concat(F.lit(BEGIN * 2), "word", F.lit(END))
    at = F.explode(F.sequence(F.lit(3), F.length("word") + 3)).alias("at")
    each = words.select("lang", "count", padded.alias("padded"), at)
    cut = [F.expr(f"substring(padded, at - {back}, {back + 1})") for back in range(3)]
    grams = each.select("lang", "count", F.explode(F.array(*cut)).alias("gram")).groupBy("lang", "gram").agg(F.sum("count").alias("n"))
    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("count").alias("n")).collect()}
    by_word: dict[str, dict[str, int]] = {x: {} for x in totals}
    by_gram: dict[str, dict[str, int]] = {x: {} for x in totals}
    for r in words.where(F.col("count") >= LEAST_COUNT).collect():
        by_word[r.lang][r.word] = r["count"]
    for r in grams.collect():
        by_gram[r.lang][r.gram] = r.n
    return Model(by_word, totals, by_gram)


SPANS = T.ArrayType(
    T.StructType([T.StructField("first", T.IntegerType()), T.StructField("words", T.IntegerType()), T.StructField("lang", T.StringType())])
)


def identify(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score", spans: str = "lang_spans") -> DataFrame:
    """``docs`` with the language of each text, its share of the letters, and the spans of words by language."""
    kept = without(docs, pred, score, spans)
    place = kept.columns.index(text)
    parts = model.words, model.totals, model.grams

    def run(batches):
        own = Model(*parts)
        for batch in batches:
            sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(place)), 0))
            for begin, end in chunks(sizes, CHUNK):
                part = batch.slice(begin, end - begin)
                texts = [t or "" for t in part.column(place).to_pylist()]
                langs, scores, labelled = zip(*own.label(texts), strict=True)
                flat = [span for one in labelled for span in one]
                first, words, names = zip(*flat, strict=True) if flat else ((), (), ())
                structs = pa.StructArray.from_arrays(
                    [pa.array(first, pa.int32()), pa.array(words, pa.int32()), pa.array(names, pa.string())], ["first", "words", "lang"]
                )
                ends = np.cumsum([0] + [len(one) for one in labelled]).astype(np.int32)
                added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.ListArray.from_arrays(pa.array(ends), structs)]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, pred, score, spans])
        del own
        pa.default_memory_pool().release_unused()
        give_back()

    schema = T.StructType(
        [*kept.schema.fields, T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType()), T.StructField(spans, SPANS)]
    )
    return kept.mapInArrow(run, schema)
