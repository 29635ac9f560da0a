"""A partitioned topic in a shared folder, and the streaming source that reads it.

An append writes Parquet files of runs of records, counts them, and then commits one
file that names them with the offsets that they begin at: until then no reader sees
any of it. Offsets are dense within a partition and follow the order that the records
were given in, however many tasks wrote them.

The source plans a batch as a range of offsets for each partition, maxOffsetsPerTrigger
of them in all, shared out by how much each partition still has (but one from each that
has any); ranges are cut into tasks of rowsPerTask, so a hot partition is read by many. Each
planned range is noted in the folder of the option progress (if given), which a
restarted query takes up its steps from; what it has read is known from its checkpoint.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

RECORD = "key string, value string, source_file string, line_no bigint, produced_at timestamp"
SCHEMA = f"partition int, offset bigint, {RECORD}"
_COMMITS = "_commits"


def file_store(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if "://" not in path and not path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(path)


@dataclass(frozen=True)
class Segment:
    """A file of records of one partition, from the offset `first` on."""

    partition: int
    first: int
    rows: int
    file: str


@lru_cache(maxsize=4096)
def _committed(path: str, name: str) -> tuple[Segment, ...]:
    """The segments of a commit, which never changes."""
    store, at = file_store(path)
    with store.open_input_stream(f"{at}/{_COMMITS}/{name}") as file:
        return tuple(Segment(**s) for s in json.loads(file.read())["segments"])


def segments(path: str) -> list[Segment]:
    """What was committed to the topic, by partition and offset."""
    store, at = file_store(path)
    found = store.get_file_info(pyarrow.fs.FileSelector(f"{at}/{_COMMITS}", allow_not_found=True))
    out = []
    for info in sorted(found, key=lambda f: f.base_name):
        if info.base_name.endswith(".json"):
            out += _committed(path, info.base_name)
    return sorted(out, key=lambda s: (s.partition, s.first))


def ends(found: list[Segment]) -> dict[int, int]:
    """The offset past the last record of each partition."""
    out: dict[int, int] = {}
    for s in found:
        out[s.partition] = max(out.get(s.partition, 0), s.first + s.rows)
    return out


def partition_of(key: Column, partitions: int) -> Column:
    """Where a key goes, unless its record names a partition."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


def append(records: DataFrame, path: str, files: int | None = None) -> dict[int, int]:
    """Append records (RECORD's columns and partition), in the order of source_file and
    line_no; returns the ends of the partitions. Appends to one topic follow each other."""
    spark = records.sparkSession
    names = [c.split()[0] for c in RECORD.split(", ")]
    data = f"{path.rstrip('/')}/data-{uuid4().hex}"
    # The records are made once; the check, the ranges' sample and the ordering each read them.
    stage = f"{path.rstrip('/')}/staged-{uuid4().hex}"
    records.select(F.col("partition").cast("int").alias("partition"), *names).write.parquet(stage)
    try:
        rows = spark.read.schema(f"partition int, {RECORD}").parquet(stage)
        if not rows.filter("partition IS NULL OR partition < 0").isEmpty():
            raise ValueError("every record needs a partition that isn't negative")
        order = ("partition", "source_file", "line_no")
        by_order = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
        # A file is a run of one partition, and a later file of it a later run.
        by_order.sortWithinPartitions(*order).write.partitionBy("partition").parquet(data)
    finally:
        store, staged = file_store(stage)
        store.delete_dir(staged)
    stored = spark.read.schema(f"{RECORD}, partition int").option("basePath", data).parquet(data)
    counted = stored.groupBy("partition", F.col("_metadata.file_path").alias("file")).agg(F.min(F.struct("source_file", "line_no")).alias("least"), F.count(F.lit(1)).alias("n"))
    at, out = ends(segments(path)), []
    for r in counted.orderBy("partition", "least", "file").collect():  # a row a file that was just written
        first = at.get(r["partition"], 0)
        out.append({"partition": r["partition"], "first": first, "rows": r["n"], "file": r["file"]})
        at[r["partition"]] = first + r["n"]
    _commit(path, {"segments": out})
    return at


def _commit(path: str, content: dict) -> None:
    store, at = file_store(path)
    store.create_dir(f"{at}/{_COMMITS}", recursive=True)
    number = len([f for f in store.get_file_info(pyarrow.fs.FileSelector(f"{at}/{_COMMITS}")) if f.base_name.endswith(".json")])
    hidden = f"{at}/{_COMMITS}/.{uuid4().hex}"
    with store.open_output_stream(hidden) as file:
        file.write(json.dumps(content).encode())
    store.move(hidden, f"{at}/{_COMMITS}/{number:012d}.json")  # seen whole or not at all


class Range(InputPartition):
    """Offsets [first, first + rows) of one partition, out of one file from its row `skip` on."""

    def __init__(self, partition: int, first: int, rows: int, file: str, skip: int):
        super().__init__((partition, first, rows, file, skip))
        self.partition, self.first, self.rows, self.file, self.skip = partition, first, rows, file, skip


def planned(found: list[Segment], start: dict[int, int], end: dict[int, int], rows_per_task: int) -> list[Range]:
    """The ranges that hold the offsets from start to end, one of rows_per_task or fewer a task."""
    out = []
    for s in found:
        a, b = max(start.get(s.partition, 0), s.first), min(end.get(s.partition, 0), s.first + s.rows)
        while a < b:
            n = min(rows_per_task, b - a)
            out.append(Range(s.partition, a, n, s.file, a - s.first))
            a += n
    return out


def admitted(at: dict[int, int], last: dict[int, int], most: int | None) -> dict[int, int]:
    """Where the next batch ends: all there is, or `most` records shared out by what each
    partition still has, one at least where there is any."""
    waiting = {p: n - at.get(p, 0) for p, n in last.items() if n > at.get(p, 0)}
    total = sum(waiting.values())
    if most is None or total <= most:
        return {p: max(last.get(p, 0), at.get(p, 0)) for p in {*last, *at}}
    return at | {p: at.get(p, 0) + max(1, most * n // total) for p, n in waiting.items()}


def _rows(part: Range) -> Iterator[pa.RecordBatch]:
    store, at = file_store(part.file)
    with store.open_input_file(at) as file:
        table = pq.ParquetFile(file)
        group, before = 0, 0
        while before + table.metadata.row_group(group).num_rows <= part.skip:
            before += table.metadata.row_group(group).num_rows
            group += 1
        skip, left, offset = part.skip - before, part.rows, part.first
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in table.iter_batches(batch_size=16_384, row_groups=range(group, table.metadata.num_row_groups), columns=names):
            if skip >= len(batch):
                skip -= len(batch)
                continue
            batch = batch.slice(skip, left)
            skip = 0
            n = len(batch)
            own = [pa.array([part.partition] * n, pa.int32()), pa.array(range(offset, offset + n), pa.int64())]
            columns = [batch.column(c) for c in names]
            columns[-1] = columns[-1].cast(pa.timestamp("us", tz="UTC"))
            yield pa.RecordBatch.from_arrays([*own, *columns], names=["partition", "offset", *names])
            left, offset = left - n, offset + n
            if not left:
                return


class _Reader:
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.rows_per_task = int(options.get("rowspertask", 250_000))
        self.own = {int(p) for p in options["partitions"].split(",")} if options.get("partitions") else None

    def segments(self) -> list[Segment]:
        """Those of the partitions that are read."""
        return [s for s in segments(self.path) if self.own is None or s.partition in self.own]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _rows(partition)


class TopicBatch(_Reader, DataSourceReader):
    """Everything that is committed when the job begins."""

    def partitions(self) -> list[Range]:
        found = self.segments()
        # A source must have a task; that of an empty topic reads nothing.
        return planned(found, {}, {s.partition: s.first + s.rows for s in found}, self.rows_per_task) or [Range(0, 0, 0, "", 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _rows(partition) if partition.rows else iter(())


class TopicStream(_Reader, DataSourceStreamReader):
    """Offsets are {partition: the next one to read}."""

    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        most = options.get("maxoffsetspertrigger")
        self.most = int(most) if most else None
        self.progress = options.get("progress")
        self.at = self._noted()

    def _noted(self) -> dict[int, int]:
        if self.progress:
            store, at = file_store(self.progress)
            if store.get_file_info(f"{at}/planned.json").type == pyarrow.fs.FileType.File:
                with store.open_input_stream(f"{at}/planned.json") as file:
                    return {int(p): n for p, n in json.loads(file.read()).items()}
        return {}

    def _note(self) -> None:
        if self.progress:
            store, at = file_store(self.progress)
            store.create_dir(at, recursive=True)
            with store.open_output_stream(f"{at}/.planned") as file:
                file.write(json.dumps(self.at).encode())
            store.move(f"{at}/.planned", f"{at}/planned.json")

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {str(p): n for p, n in sorted(admitted(self.at, ends(self.segments()), self.most).items())}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        a, b = ({int(p): n for p, n in x.items()} for x in (start, end))
        self.at = {p: max(self.at.get(p, 0), b.get(p, 0)) for p in {*self.at, *b}}
        self._note()
        return planned(self.segments(), a, b, self.rows_per_task)


class PartitionedTopic(DataSource):
    """format("logloom_topic"); options path, partitions (all unless
    named, by commas), maxOffsetsPerTrigger, rowsPerTask, progress."""

    @classmethod
    def name(cls) -> str:
        return "logloom_topic"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> dict[str, str]:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> TopicBatch:
        return TopicBatch(self._options())

    def streamReader(self, schema) -> TopicStream:
        return TopicStream(self._options())


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    """The topic's records with partition and offset."""
    spark.dataSource.register(PartitionedTopic)
    return spark.read.format("logloom_topic").option("path", path).load()


def topic_stream(spark: SparkSession, path: str, per_trigger: int | None = None, progress: str | None = None, rows_per_task: int | None = None, partitions: tuple[int, ...] = ()) -> DataFrame:
    """The same as a stream, from the first record or where its checkpoint left off; of some partitions if named."""
    spark.dataSource.register(PartitionedTopic)
    options = {"path": path, "maxOffsetsPerTrigger": per_trigger, "progress": progress, "rowsPerTask": rows_per_task, "partitions": ",".join(map(str, partitions)) or None}
    return spark.readStream.format("logloom_topic").options(**{k: v for k, v in options.items() if v is not None}).load()
