"""A log of topics and partitions in files, read as a batch or a stream by offsets.

``root/<topic>/<partition>/<base>-<count>-<batch>.jsonl`` holds ``count`` records from offset ``base`` on, one JSON object a
line with ``key``, ``value`` (null in a tombstone) and ``timestamp`` in milliseconds. Files are complete when they carry
their name, so all offsets follow from a listing. Paths are anything that ``pyarrow.fs`` opens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "event_log"
SCHEMA = "topic string, partition int, offset bigint, key string, value string, timestamp timestamp"
SEGMENT = re.compile(r"([^/]+)/(\d+)/(\d{20})-(\d+)-(-?\d+)\.jsonl$")
ROWS = 10_000


@dataclass(frozen=True)
class Segment:
    topic: str
    partition: int
    base: int
    count: int
    batch: int
    path: str


@dataclass
class Range(InputPartition):
    """Offsets ``start`` to ``end`` (exclusive) of one segment."""

    segment: Segment
    start: int
    end: int


def segments(root: str, topics: list[str] | None = None) -> list[Segment]:
    """All segments in order, of the given topics or of every topic there is."""
    store, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")
    found = []
    for info in store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)):
        if info.is_file and (m := SEGMENT.search(info.path)) and (topics is None or m[1] in topics):
            found.append(Segment(m[1], int(m[2]), int(m[3]), int(m[4]), int(m[5]), info.path))
    return sorted(found, key=lambda s: (s.topic, s.partition, s.base))


def ends(found: list[Segment]) -> dict[str, int]:
    """``topic/partition`` -> the offset after the last record."""
    return {f"{s.topic}/{s.partition}": s.base + s.count for s in found}


class _Log:
    def __init__(self, options: Mapping[str, str]):
        if "path" not in options:
            raise ValueError("the event log needs a path")
        self.root = options["path"]
        self.topics = [t.strip() for t in options["subscribe"].split(",")] if "subscribe" in options else None
        self.lossy = str(options.get("failOnDataLoss", "true")).lower() == "false"
        self.begin = options.get("startingOffsets", "earliest")

    def found(self) -> list[Segment]:
        return segments(self.root, self.topics)

    def ranges(self, start: Mapping[str, int], end: Mapping[str, int]) -> list[Range]:
        out, first = [], {}
        for s in self.found():
            key = f"{s.topic}/{s.partition}"
            first.setdefault(key, s.base)
            low, high = max(s.base, start.get(key, 0)), min(s.base + s.count, end.get(key, 0))
            if low < high:
                out.append(Range(s, low, high))
        lost = {k: n for k, n in first.items() if start.get(k, 0) < min(n, end.get(k, 0))}
        lost |= {k: start.get(k, 0) for k, n in end.items() if k not in first and start.get(k, 0) < n}
        if lost and not self.lossy:
            raise ValueError(f"records from before these offsets are gone: {lost}; failOnDataLoss=false goes on without them")
        return out

    def records(self, part: Range) -> Iterator[pa.RecordBatch]:
        """The records of a range. A line that is no record comes as its text; a record without a value has a null one."""
        store, _ = fs.FileSystem.from_uri(self.root if "://" in self.root else f"file://{self.root}")
        rows: list[tuple] = []
        s = part.segment
        with store.open_input_stream(s.path) as stream:
            for i, line in enumerate(_lines(stream)):
                offset = s.base + i
                if offset < part.start:
                    continue
                if offset >= part.end:
                    break
                rows.append((s.topic, s.partition, offset, *_record(line)))
                if len(rows) == ROWS:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)


def _lines(stream: pa.NativeFile) -> Iterator[bytes]:
    rest = b""
    while block := stream.read(1 << 20):
        *whole, rest = (rest + block).split(b"\n")
        yield from whole
    if rest:
        yield rest


def _record(line: bytes) -> tuple[str | None, str | None, datetime | None]:
    text = line.decode("utf-8", "replace")
    try:
        record = json.loads(text)
    except ValueError:
        record = None
    if not isinstance(record, dict):
        return None, text, None
    at = record.get("timestamp")
    when = datetime.fromtimestamp(at / 1000, timezone.utc) if isinstance(at, (int, float)) else None
    return _text(record.get("key")), _text(record.get("value")), when


def _text(x: object) -> str | None:
    return x if x is None or isinstance(x, str) else json.dumps(x)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()), ("value", pa.string()),
             ("timestamp", pa.timestamp("us", "UTC"))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*rows), kinds)], names=[n for n, _ in kinds])


class _BatchReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.log = _Log(options)

    def partitions(self) -> list[Range]:
        return self.log.ranges(ends([]), ends(self.log.found())) or []

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        return self.log.records(part) if part is not None else iter(())


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.log = _Log(options)

    def initialOffset(self) -> dict:
        return ends(self.log.found()) if self.log.begin == "latest" else {}

    def latestOffset(self) -> dict:
        return ends(self.log.found())

    def partitions(self, start: dict, end: dict) -> list[Range]:
        return self.log.ranges(start, end)

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        return self.log.records(part)


class EventLog(DataSource):
    """``spark.read`` or ``spark.readStream.format("event_log")`` with ``path``, ``subscribe`` (topics, commas between; without
    it every topic), ``startingOffsets`` (earliest, latest) and ``failOnDataLoss``. A partition or topic that appears later
    is read from its beginning."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(self.options)


def read_log(spark: SparkSession, path: str, topics: list[str] | None = None, stream: bool = True, **options: str) -> DataFrame:
    """The records of the log as a stream, or all of them as a batch."""
    spark.dataSource.register(EventLog)
    reader = (spark.readStream if stream else spark.read).format(FORMAT).option("path", path).options(**options)
    return (reader.option("subscribe", ",".join(topics)) if topics else reader).load()


def append_log(df: DataFrame, path: str, batch_id: int, partitions: int = 4) -> None:
    """Append rows (topic, key, value and, if there is one, timestamp in milliseconds) as batch ``batch_id``.

    Rows go to a partition of their topic by key, without one by value. A partition's rows are written by one task as one
    segment, whose name it gets when it is complete; a partition that has the batch already is left alone, so a repeated
    batch adds nothing. A task keeps a file open for each of its partitions and passes rows on as they come, so it holds no
    more of a large batch than of a small one.
    """
    known = segments(path)
    base = ends(known)
    done = {f"{s.topic}/{s.partition}" for s in known if s.batch == batch_id}
    part = F.pmod(F.xxhash64(F.coalesce("key", "value")), F.lit(partitions)).cast("int")
    at = F.col("timestamp").cast("bigint") if "timestamp" in df.columns else F.lit(None).cast("bigint")
    rows = df.select("topic", part.alias("partition"), F.to_json(
        F.struct("key", "value", at.alias("timestamp")), {"ignoreNullFields": "false"}).alias("line"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
        files, counts = {}, {}
        for batch in batches:
            for topic, number, line in zip(*(c.to_pylist() for c in batch.columns)):
                at = f"{topic}/{number}"
                if at in done:
                    continue
                if at not in files:
                    store.create_dir(f"{root}/{at}", recursive=True)
                    files[at], counts[at] = store.open_output_stream(f"{root}/{at}/.writing-{batch_id}"), 0
                files[at].write(line.encode() + b"\n")
                counts[at] += 1
        for at, out in files.items():
            out.close()
            store.move(f"{root}/{at}/.writing-{batch_id}", f"{root}/{at}/{base.get(at, 0):020d}-{counts[at]}-{batch_id}.jsonl")
        yield from ()

    rows.repartition("topic", "partition").mapInArrow(write, "done boolean").count()
