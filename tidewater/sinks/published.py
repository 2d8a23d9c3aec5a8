"""A sink that publishes each batch once.

Tasks write their rows as Parquet files under ``staging``; nothing of it counts yet. The commit, which Spark runs once all
tasks have ended well, puts one small file under ``batches`` that names the files of the attempts that count. A failed or
repeated attempt leaves files that no batch names, and a batch that has been published is not published again.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import TypeVar

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

FORMAT = "published"
Result = TypeVar("Result")


@dataclass
class Staged(WriterCommitMessage):
    files: list[str]
    rows: int


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def retried(step: Callable[[], Result], retries: int, wait: float) -> Result:
    """The result of a step that may fail ``retries`` times with an error of input or output, with growing pauses."""
    for i in range(retries + 1):
        try:
            return step()
        except OSError:
            if i == retries:
                raise
            time.sleep(wait * 2**i)
    raise AssertionError


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str], schema: StructType):
        self.path, self.batch = options["path"], options["batchid"]
        self.rows = int(options.get("batchsize", "100000"))
        self.retries, self.wait = int(options.get("retries", "3")), float(options.get("retrywait", "1"))
        self.schema = schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = _store(self.path)
        schema, files, total = to_arrow_schema(self.schema), [], 0
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            name = f"staging/{self.batch}/{uuid.uuid4().hex}.parquet"

            def put() -> None:
                store.create_dir(f"{root}/staging/{self.batch}", recursive=True)
                with store.open_output_stream(f"{root}/{name}") as out:
                    pq.write_table(pa.Table.from_batches(held).cast(schema), out)

            retried(put, self.retries, self.wait)
            files.append(name)

        count = 0
        for batch in iterator:
            for start in range(0, batch.num_rows, self.rows):
                part = batch.slice(start, self.rows)
                held.append(part)
                count += part.num_rows
                total += part.num_rows
                if count >= self.rows:
                    flush()
                    held, count = [], 0
        if held:
            flush()
        return Staged(files, total)

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = _store(self.path)
        target = f"{root}/batches/{self.batch}.json"
        if store.get_file_info(target).type != fs.FileType.NotFound:
            self.abort(messages)
            return
        done = [m for m in messages if m is not None]
        text = json.dumps({"files": sorted(f for m in done for f in m.files), "rows": sum(m.rows for m in done)})

        def put() -> None:
            store.create_dir(f"{root}/batches", recursive=True)
            name = f"{root}/batches/.{self.batch}-{uuid.uuid4().hex}"
            with store.open_output_stream(name) as out:
                out.write(text.encode())
            store.move(name, target)

        retried(put, self.retries, self.wait)

    def abort(self, messages: list[Staged | None]) -> None:
        store, root = _store(self.path)
        for name in (f for m in messages if m is not None for f in m.files):
            store.delete_file(f"{root}/{name}")


class Published(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, schema)


def publish(df: DataFrame, path: str, batch_id: int | str, batch_size: int = 100_000, retries: int = 3, retry_wait: float = 1.0) -> None:
    """Write rows as one batch: all of them or none, and once, whatever fails or is repeated on the way.

    ``batch_size`` rows go to a file; a failing write is tried ``retries`` times more with growing pauses, before the task
    fails and Spark tries it again. Use the id of the micro-batch, or the day of a load.
    """
    df.sparkSession.dataSource.register(Published)
    df.write.format(FORMAT).mode("append").option("path", path).option("batchId", str(batch_id)).option(
        "batchSize", batch_size).option("retries", retries).option("retryWait", retry_wait).save()


def read_published(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all published batches."""
    store, root = _store(path)
    files = []
    for info in store.get_file_info(fs.FileSelector(f"{root}/batches", allow_not_found=True)):
        if info.base_name.endswith(".json") and not info.base_name.startswith("."):
            with store.open_input_stream(info.path) as f:
                files += json.loads(f.read())["files"]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f}" for f in sorted(files)])
