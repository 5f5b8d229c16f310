"""From raw documents to token ids, stage by stage.

Each stage works on all rows its predecessor kept; all but the last return the columns of ``documents``.
Rows that share a doc_id are one document to the second stage: they stay or go together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, decontaminate, langid, neardup, secrets
from ledgerline.llm.common import staged

#: Texts of which no language has this share of the letters go.
LEAST_SHARE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter or without a main language go."""
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs, model, pred="__lang", score="__share", spans="__spans")
    return found.where((F.col("__lang") != langid.UNKNOWN) & (F.col("__share") >= LEAST_SHARE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least id stays of each group that shares four fifths of its runs of five words."""
    gone = neardup.near_duplicates(docs, k=5).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    return decontaminate.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are blotted out; n_chars follows the text."""
    found = secrets.scan(docs, secrets.train(secrets.labelled_strings(docs)), base="__base", spans="__spans")
    found = found.withColumn("__new", secrets.redacted(F.col("text"), F.col("__spans")))
    changed = {"text": F.col("__new"), "n_chars": F.when(F.size("__spans") > 0, F.length("__new").cast("long")).otherwise(F.col("n_chars"))}
    return found.select(*[changed[c].alias(c) if c in changed else found[c] for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text; a text that its ids don't give back ends the job."""
    where = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = bpe.decode(bpe.encode(docs, *where), *where)
    same = F.coalesce(F.col("decoded") == F.col("text").cast("binary"), F.octet_length("decoded") == 0)
    ids = F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("ids don't give back their text")).cast("array<int>"))
    return both.select("doc_id", ids.alias("ids"), F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("languages", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("secrets", secret_strings),
    ("bpe", encode),
]

#: Models, sketches and BPE aren't SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder before the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
