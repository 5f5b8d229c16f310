"""The message feed as a data source: sent batches are committed one by one, and each once.

A task writes its messages, in the order it gets them, to one file below ``<path>/parts``. Committing a batch writes
``<path>/batches/<id>.json``, the list of its files in the order of their partitions, so a reader sees all of a batch or
nothing. A batch that was committed before is not sent again: what a replay wrote is deleted. Files that no batch lists
(of tasks that were lost) are never read.

``read_feed`` gives the committed messages with their place, as a table or as a stream whose offset is the last batch.
Sort what is sent by ``feed.in_sending_order``; its ranges are the partitions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamArrowWriter,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

NAME = "ledger_feed"
MESSAGES = "type string, block bigint, trx_index bigint, message string"
PLACED = f"batch bigint, part int, row bigint, {MESSAGES}"
PARTS, BATCHES = "parts", "batches"


@dataclass
class Sent(WriterCommitMessage):
    """What one task wrote; no file if it had no rows."""

    partition: int
    file: str | None
    rows: int


@dataclass
class Part(InputPartition):
    batch: int
    part: int
    file: str | None


class Outbox:
    """Files of a feed; ``path`` may be any that pyarrow can open."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _open(self):
        from pyarrow import fs as filesystems

        if "://" in self.path:
            return filesystems.FileSystem.from_uri(self.path)
        return filesystems.LocalFileSystem(), self.path.removeprefix("file:")

    def send(self, batches: Iterator) -> Sent:
        from pyarrow import parquet
        from pyspark import TaskContext

        fs, root = self._open()
        name, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if writer is None:
                    fs.create_dir(f"{root}/{PARTS}", recursive=True)
                    writer = parquet.ParquetWriter(f"{root}/{PARTS}/{name}", batch.schema, filesystem=fs)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Sent(TaskContext.get().partitionId(), name if rows else None, rows)

    def commit(self, sent: list[Sent | None], batch: int) -> None:
        if batch in self.committed():
            self.discard(sent)
            return
        fs, root = self._open()
        fs.create_dir(f"{root}/{BATCHES}", recursive=True)
        written = sorted((one for one in sent if one is not None and one.file), key=lambda one: one.partition)
        listed = {"rows": sum(one.rows for one in written), "files": [one.file for one in written]}
        draft = f"{root}/{BATCHES}/_{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as out:
            out.write(json.dumps(listed).encode())
        fs.move(draft, f"{root}/{BATCHES}/{batch}.json")

    def discard(self, sent: list[Sent | None]) -> None:
        fs, root = self._open()
        for one in sent:
            if one is not None and one.file:
                fs.delete_file(f"{root}/{PARTS}/{one.file}")

    def committed(self) -> list[int]:
        from pyarrow import fs as filesystems

        fs, root = self._open()
        found = fs.get_file_info(filesystems.FileSelector(f"{root}/{BATCHES}", allow_not_found=True))
        names = [info.base_name.removesuffix(".json") for info in found if info.base_name.endswith(".json")]
        return sorted(int(name) for name in names if name.lstrip("-").isdigit())

    def parts(self, after: int | None = None, through: int | None = None) -> list[Part]:
        fs, root = self._open()
        out = []
        for batch in self.committed():
            if (after is not None and batch <= after) or (through is not None and batch > through):
                continue
            with fs.open_input_stream(f"{root}/{BATCHES}/{batch}.json") as text:
                out += [Part(batch, i, file) for i, file in enumerate(json.loads(text.read())["files"])]
        return out or [Part(-1, 0, None)]  # one part without rows keeps an empty feed an empty table

    def read(self, part: Part) -> Iterator:
        import pyarrow as pa
        from pyarrow import parquet

        if part.file is None:
            return
        fs, root = self._open()
        row = 0
        with fs.open_input_file(f"{root}/{PARTS}/{part.file}") as handle:
            for batch in parquet.ParquetFile(handle).iter_batches():
                n = batch.num_rows
                place = [pa.array([part.batch] * n, pa.int64()), pa.array([part.part] * n, pa.int32()), pa.array(range(row, row + n), pa.int64())]
                yield pa.RecordBatch.from_arrays(place + batch.columns, names=["batch", "part", "row", *batch.schema.names])
                row += n


class FeedSource(DataSource):
    """Options: ``path``; when a table is written ``batch``, the number it is committed under."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return PLACED

    def _outbox(self) -> Outbox:
        return Outbox(self.options["path"])

    def reader(self, schema) -> DataSourceReader:
        return FeedReader(self._outbox())

    def streamReader(self, schema) -> DataSourceStreamReader:
        return FeedStream(self._outbox())

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("messages that were sent can't be replaced")
        return FeedWriter(self._outbox(), int(self.options["batch"]))

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return FeedStreamWriter(self._outbox())


class FeedReader(DataSourceReader):
    def __init__(self, outbox: Outbox):
        self.outbox = outbox

    def partitions(self) -> list[InputPartition]:
        return self.outbox.parts()

    def read(self, partition: Part):
        return self.outbox.read(partition)


class FeedStream(DataSourceStreamReader):
    def __init__(self, outbox: Outbox):
        self.outbox = outbox

    def initialOffset(self) -> dict:
        return {"batch": -1}

    def latestOffset(self) -> dict:
        return {"batch": max([-1, *self.outbox.committed()])}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.outbox.parts(start["batch"], end["batch"])

    def read(self, partition: Part):
        return self.outbox.read(partition)


class FeedWriter(DataSourceArrowWriter):
    def __init__(self, outbox: Outbox, batch: int):
        self.outbox, self.batch = outbox, batch

    def write(self, iterator) -> Sent:
        return self.outbox.send(iterator)

    def commit(self, messages) -> None:
        self.outbox.commit(messages, self.batch)

    def abort(self, messages) -> None:
        self.outbox.discard(messages)


class FeedStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, outbox: Outbox):
        self.outbox = outbox

    def write(self, iterator) -> Sent:
        return self.outbox.send(iterator)

    def commit(self, messages, batchId: int) -> None:
        self.outbox.commit(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self.outbox.discard(messages)


def send(feed: DataFrame, path: str, batch: int) -> None:
    """Send messages as batch ``batch``; nothing happens if that batch was sent before."""
    feed.sparkSession.dataSource.register(FeedSource)
    rows = feed.select("type", "block", "trx_index", "message")
    rows.write.format(NAME).option("path", path).option("batch", batch).mode("append").save()


def send_stream(messages: DataFrame, path: str, checkpoint: str, **trigger):
    """Send a stream of messages, one commit a micro-batch; returns the running query."""
    messages.sparkSession.dataSource.register(FeedSource)
    rows = messages.select("type", "block", "trx_index", "message")
    query = rows.writeStream.format(NAME).option("path", path).option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).start()


def read_feed(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Committed messages and their place; sent in the order of ``batch``, ``part``, ``row``."""
    spark.dataSource.register(FeedSource)
    return (spark.readStream if stream else spark.read).format(NAME).option("path", path).load()
