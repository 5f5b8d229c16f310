"""Session set-up shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Whether what a query has shuffled goes when the query ends, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(app: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    The time zone has to be UTC; adaptive execution splits skewed join partitions
    and coalesces small ones, so ``spark.sql.shuffle.partitions`` may be set high.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone on a session somebody else made."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read: the cluster's checkpoint folder.

    Only where a session has none (tests on one machine) a temporary one is made.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can read")
    folder = os.path.join(tempfile.mkdtemp(prefix="ledgerline-"), "shared")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Frees the disk that a query run inside has shuffled to as soon as it ends; for queries whose result is stored."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
