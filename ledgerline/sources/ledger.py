"""A ledger folder as a data source of its own: blocks and their actions under one offset.

``<path>/headers`` holds a row for every block arrival ``(arrival_seq, block_num, ts, native_hash)``, ``<path>/actions`` the
actions; both are Parquet files, flat or in segment folders, that are only ever added. A block's actions are written before
its header. Rows have the columns of ``schemas.ACTIONS``: every block is one row without an action, so that empty
blocks are there as well, and one row for each action.

The offset of a stream is the last arrival: a batch takes the blocks after it, as far as arrivals are there without a hole, and their
actions, from files that came at any time. Files are listed anew for each batch, and each file's footer is read once.
``spark.read`` takes pushed bounds on block and arrival numbers and pushed equality of contract or action names:
files and row groups without such rows aren't read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from ledgerline import constants as K
from ledgerline import schemas as S

NAME = "ledger"
HEADERS, ACTIONS = "headers", "actions"
#: Columns whose bounds are taken from the engine, and what their comparisons are called here.
BOUNDED = ("arrival_seq", "block_num")
NAMED = ("account", "name")
SIGNS = {EqualTo: "==", In: "in", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass
class Part(InputPartition):
    """One file, and the comparisons its rows have to meet."""

    kind: str
    file: str
    terms: tuple


class Folder:
    """Files of a ledger with the ranges that their footers tell."""

    def __init__(self, path: str, kinds: tuple[str, ...] = (HEADERS, ACTIONS)):
        self.path, self.kinds = path.rstrip("/"), kinds
        self.known: dict[str, dict] = {}

    def files(self, kind: str) -> list[dict]:
        """``{file, arrival_seq: (least, largest), block_num: …}`` of each file that holds rows."""
        from pyarrow import fs as filesystems

        fs, root = filesystems.FileSystem.from_uri(self.path) if "://" in self.path else (filesystems.LocalFileSystem(), self.path)
        chosen = filesystems.FileSelector(f"{root}/{kind}", recursive=True, allow_not_found=True)
        out = []
        for info in fs.get_file_info(chosen):
            hidden = any(part[:1] in ("_", ".") for part in info.path.removeprefix(root).split("/") if part)
            if hidden or not info.path.endswith(".parquet"):
                continue
            if info.path not in self.known:
                self.known[info.path] = self._footer(fs, info.path)
            if self.known[info.path]["rows"]:
                out.append(self.known[info.path])
        return out

    @staticmethod
    def _footer(fs, file: str) -> dict:
        from pyarrow import parquet

        with fs.open_input_file(file) as handle:
            meta = parquet.ParquetFile(handle).metadata
        out = {"file": file, "rows": meta.num_rows}
        names = {meta.schema.column(i).path: i for i in range(meta.num_columns)}
        for column in BOUNDED:
            stats = [meta.row_group(g).column(names[column]).statistics for g in range(meta.num_row_groups)] if column in names else []
            known = bool(stats) and all(s is not None and s.has_min_max for s in stats)
            out[column] = (min(s.min for s in stats), max(s.max for s in stats)) if known else None
        return out

    def parts(self, terms: tuple) -> list[Part]:
        """Files that may hold rows which meet all comparisons."""
        names_given = any(column in NAMED for column, _, _ in terms)
        out = []
        for kind in self.kinds:
            if kind == HEADERS and names_given:
                continue  # blocks have no contract
            for file in self.files(kind):
                if all(_may_hold(file.get(column), sign, value) for column, sign, value in terms):
                    out.append(Part(kind, file["file"], terms))
        return out

    def through(self, after: int) -> int:
        """The last arrival up to which headers are there without a hole."""
        spans = sorted(f["arrival_seq"] for f in self.files(HEADERS) if f["arrival_seq"])
        for least, largest in spans:
            if least > after + 1:
                break
            after = max(after, largest)
        return after

    def read(self, part: Part):
        """Record batches of a file in the columns of ``schemas.ACTIONS``."""
        import pyarrow as pa
        from pyarrow import dataset
        from pyarrow import fs as filesystems
        from pyspark.sql.pandas.types import to_arrow_schema

        fs = filesystems.FileSystem.from_uri(self.path)[0] if "://" in self.path else filesystems.LocalFileSystem()
        wanted = to_arrow_schema(S.ACTIONS)
        renamed = {"block_ts": "ts", "block_id": "native_hash"} if part.kind == HEADERS else {}
        source = dataset.dataset(part.file, filesystem=fs, format="parquet")
        held = {name: renamed.get(name, name) for name in wanted.names if renamed.get(name, name) in source.schema.names}
        keep = None
        for column, sign, value in part.terms:
            field = dataset.field(held.get(column, column))
            compare = {"==": field == value, ">": field > value, ">=": field >= value, "<": field < value, "<=": field <= value} if sign != "in" else {}
            term = field.isin(list(value)) if sign == "in" else compare[sign]
            keep = term if keep is None else keep & term
        for batch in source.to_batches(columns=list(held.values()), filter=keep):
            if not batch.num_rows:
                continue
            columns = [
                batch.column(held[f.name]).cast(f.type) if f.name in held else pa.nulls(batch.num_rows, f.type) for f in wanted
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=wanted)


def _may_hold(span: tuple | None, sign: str, value) -> bool:
    if span is None:
        return True
    least, largest = span
    if sign == "in":
        return any(least <= v <= largest for v in value)
    return {
        "==": lambda: least <= value <= largest,
        ">": lambda: largest > value,
        ">=": lambda: largest >= value,
        "<": lambda: least < value,
        "<=": lambda: least <= value,
    }[sign]()


class LedgerSource(DataSource):
    """``spark.read.format("ledger")`` and ``spark.readStream.format("ledger")``.

    Options: ``path``; ``rows``, ``headers`` or ``actions`` for one kind of rows only; ``after``, the last arrival that a new
    stream leaves out (-1: none); ``start`` and ``stop``, block numbers.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return S.ACTIONS

    def _folder(self) -> Folder:
        kind = self.options.get("rows")
        return Folder(self.options["path"], (kind,) if kind else (HEADERS, ACTIONS))

    def _bounds(self) -> tuple:
        terms = []
        if self.options.get("start"):
            terms.append(("block_num", ">=", int(self.options["start"])))
        if int(self.options.get("stop") or 0) > 0:
            terms.append(("block_num", "<=", int(self.options["stop"])))
        return tuple(terms)

    def reader(self, schema: StructType) -> DataSourceReader:
        return LedgerReader(self._folder(), self._bounds())

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return LedgerStream(self._folder(), self._bounds(), int(self.options.get("after") or -1))


class LedgerReader(DataSourceReader):
    def __init__(self, folder: Folder, terms: tuple):
        self.folder, self.terms = folder, terms

    def pushFilters(self, filters: list[Filter]):
        for one in filters:
            column = one.attribute[0] if len(getattr(one, "attribute", ())) == 1 else None
            if isinstance(one, IsNotNull) and column in BOUNDED:
                continue  # numbers of blocks and arrivals always are there
            if type(one) in SIGNS and (column in BOUNDED or (column in NAMED and type(one) in (EqualTo, In))):
                value = one.value
                self.terms += ((column, SIGNS[type(one)], value),)
            else:
                yield one

    def partitions(self) -> list[InputPartition]:
        # one part without rows keeps an empty ledger an empty table
        return self.folder.parts(self.terms) or [Part("", "", ())]

    def read(self, partition: Part):
        return self.folder.read(partition) if partition.file else iter(())


class LedgerStream(DataSourceStreamReader):
    def __init__(self, folder: Folder, terms: tuple, after: int):
        self.folder, self.terms, self.after = folder, terms, after
        self.seen = after

    def initialOffset(self) -> dict:
        return {"through": self.after}

    def latestOffset(self) -> dict:
        self.seen = self.folder.through(self.seen)
        return {"through": self.seen}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        span = (("arrival_seq", ">", start["through"]), ("arrival_seq", "<=", end["through"]))
        return self.folder.parts(self.terms + span) or [Part("", "", ())]

    def read(self, partition: Part):
        return self.folder.read(partition) if partition.file else iter(())


def read_ledger(
    spark: SparkSession, path: str, stream: bool = False, rows: str | None = None, start: int | None = None, stop: int | None = None
) -> DataFrame:
    """Blocks (rows without an action) and actions of a ledger folder, as a table or as a stream."""
    spark.dataSource.register(LedgerSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = (spark.readStream if stream else spark.read).format(NAME).option("path", path)
    for name, value in {"rows": rows, "start": start, "stop": stop}.items():
        if value is not None:
            reader = reader.option(name, value)
    return reader.load()


def write_ledger(actions: DataFrame | None, headers: DataFrame, path: str, per_segment: int = K.BLOCKS_PER_SEGMENT) -> None:
    """Add arrivals to a ledger folder: actions first, then the headers that announce them."""
    from ledgerline.functions.text import segment_of
    from pyspark.sql import functions as F

    if actions is not None:
        parted = actions.select(*S.ACTIONS.names, segment_of(F.col("block_num"), per_segment).alias("segment"))
        parted.sortWithinPartitions("arrival_seq").write.mode("append").partitionBy("segment").parquet(f"{path}/{ACTIONS}")
    heads = headers.select("arrival_seq", "block_num", "ts", "native_hash", segment_of(F.col("block_num"), per_segment).alias("segment"))
    heads.sortWithinPartitions("arrival_seq").write.mode("append").partitionBy("segment").parquet(f"{path}/{HEADERS}")
