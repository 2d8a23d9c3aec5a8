"""Keyed store: a table with one row per key, kept up to date by micro-batches.

Keys are dealt to a fixed number of buckets. A batch rewrites the buckets that its keys fall into, under a folder of its
own, and leaves the files of all others as they are; a manifest says which batch holds each bucket. A manifest counts once
Spark's own ``_SUCCESS`` marker is there, so readers see all of a batch or nothing, and a batch that is repeated after a
failure writes its folder anew. A committed batch is not merged again. The merge is one distributed aggregate by key.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a new store; aim at some hundred megabytes a bucket.
BUCKETS = 16
BATCH, BUCKET = "of_batch", "of_bucket"
Merge = Callable[[DataFrame], DataFrame]


class Manifest(NamedTuple):
    batch: int
    buckets: int
    keys: list[str]
    schema: T.StructType
    #: bucket -> the batch whose folder holds it; buckets without rows are left out
    held: dict[int, int]


def merge_into(
    spark: SparkSession, df: DataFrame, keys: Sequence[str], path: str, batch_id: int, merge: Merge, buckets: int = BUCKETS
) -> DataFrame:
    """Merge rows into the store and return the stored rows of the buckets that ``df`` touches.

    ``merge`` gets the rows of the batch (``__batch`` 1) and the stored rows of their buckets (``__batch`` 0) and returns
    one row per key. ``buckets`` counts for a new store only; :func:`rebucket` changes it. Batch ids must not go back: a new
    stream, which counts from 0 again, needs a store of its own.
    """
    current = _manifest(spark, path)
    if current and batch_id < current.batch:
        raise ValueError(f"batch {batch_id} is older than the store in {path}, which has batch {current.batch}")
    if {BATCH, BUCKET} & set(df.columns):
        raise ValueError(f"the columns {BATCH} and {BUCKET} are taken by the store")
    count = current.buckets if current else buckets
    bucket = F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
    if current is None:
        touched = set(range(count))
    else:
        df = df.persist()
        touched = {r[0] for r in df.select(bucket).distinct().collect()}
    try:
        if current is None or batch_id > current.batch:
            held = current.held if current else {}
            rows = df.withColumn("__batch", F.lit(1))
            if old := {b: v for b, v in held.items() if b in touched}:
                rows = rows.unionByName(_read(spark, path, current, old).withColumn("__batch", F.lit(0)), allowMissingColumns=True)
            current = _commit(spark, path, batch_id, merge(rows), list(keys), count, {b: v for b, v in held.items() if b not in touched},
                              current)
    finally:
        df.unpersist()
    return _read(spark, path, current, {b: v for b, v in current.held.items() if b in touched})


def _commit(spark: SparkSession, path: str, batch_id: int, merged: DataFrame, keys: list[str], count: int, kept: dict[int, int],
            current: Manifest | None) -> Manifest:
    """Write the merged buckets, then the manifest that names them."""
    folder = f"{path}/data/{BATCH}={batch_id}"
    bucket = F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
    merged.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    written = {int(n.split("=")[1]): batch_id for n in _names(spark, folder) if n.startswith(f"{BUCKET}=")}
    fields = {f.name: f for f in [*(current.schema if current else []), *merged.schema]}
    out = Manifest(batch_id, count, keys, T.StructType(list(fields.values())), kept | written)
    line = json.dumps({**out._asdict(), "schema": out.schema.jsonValue(), "held": sorted(out.held.items())})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest/v={batch_id}")
    return out


def upsert_snapshot(
    spark: SparkSession,
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    path: str,
    batch_id: int,
    skip_nulls: bool = False,
    deleted: Column | None = None,
    last_batch_wins: bool = True,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Merge rows into the store and return the stored rows of the buckets they touch.

    Within a batch the newest row by ``order`` wins, and it replaces the stored row; with ``last_batch_wins``
    off it replaces the stored row only if it is newer by ``order``. With ``skip_nulls`` each column keeps its
    last value that is not null. Keys whose newest row is ``deleted`` are removed.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct("__batch", *order) if last_batch_wins else F.struct(*order, "__batch")

    def merge(rows: DataFrame) -> DataFrame:
        if skip_nulls:
            value = [F.max(F.when(F.col(c).isNotNull(), F.struct(rank, F.col(c).alias("v"))))["v"].alias(c) for c in rest]
        else:
            value = [F.max_by(c, rank).alias(c) for c in rest]
        gone = F.lit(False) if deleted is None else deleted & (F.col("__batch") == 1)
        merged = rows.withColumn("__gone", gone).groupBy(*keys).agg(*value, F.max_by("__gone", rank).alias("__gone"))
        return merged.where(~F.coalesce("__gone", F.lit(False))).drop("__gone")

    return merge_into(spark, df, keys, path, batch_id, merge, buckets)


def upsert_cells(
    spark: SparkSession, df: DataFrame, key: str, cells: str, at: str, path: str, batch_id: int, buckets: int = BUCKETS
) -> DataFrame:
    """One row per key with a map of its cells, each with the time it was set: ``key``, ``at`` (the newest), ``cells``.

    ``cells`` of ``df`` maps column names to values; a cell of a later batch, or of a later time within one, replaces the
    stored cell, and cells that a batch does not name stay. Returns the stored rows of the buckets that the rows touch.
    """
    timed = df.select(key, F.col(at).alias("at"), F.transform_values(cells, lambda k, v: F.struct(F.col(at).alias("at"), v.alias("value"))).alias("cells"))

    def merge(rows: DataFrame) -> DataFrame:
        each = rows.select(key, "__batch", F.explode("cells").alias("name", "cell"))
        newest = each.groupBy(key, "name").agg(F.max(F.struct("__batch", "cell")).getField("cell").alias("cell"))
        return newest.groupBy(key).agg(F.max("cell.at").alias("at"), F.map_from_entries(F.collect_list(F.struct("name", "cell"))).alias("cells"))

    return merge_into(spark, timed, [key], path, batch_id, merge, buckets)


def snapshot_writer(
    keys: Sequence[str], order: Sequence[str], path: str, skip_nulls: bool = False,
    prepare: Callable[[DataFrame], DataFrame] | None = None, buckets: int = BUCKETS,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges every micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        upsert_snapshot(batch.sparkSession, rows, keys, order, path, batch_id, skip_nulls, buckets=buckets)

    return write


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    current = _manifest(spark, path)
    if current is None:
        raise FileNotFoundError(f"no snapshot in {path}")
    return _read(spark, path, current, current.held)


def scan_snapshot(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Rows of the current version; the limit is for looking at a few of them."""
    df = read_snapshot(spark, path)
    return df if limit is None else df.limit(limit)


def rebucket(spark: SparkSession, path: str, batch_id: int, buckets: int) -> None:
    """Deal the whole store to another number of buckets, as a batch of its own."""
    current = _manifest(spark, path)
    if current is None or batch_id <= current.batch:
        raise ValueError("a store can be dealt anew by a batch after its last one")
    _commit(spark, path, batch_id, _read(spark, path, current, current.held), current.keys, buckets, {}, current)


def vacuum(spark: SparkSession, path: str, keep: int = 3) -> list[int]:
    """Remove the manifests but the last ``keep`` and the buckets that none of those names. Run it when no reader may still
    use an older one. Returns the batches whose manifests went."""
    versions = _versions(spark, path)
    stay = {(b, v) for n in versions[-keep:] for b, v in _manifest(spark, path, n).held.items()}
    for n in versions[:-keep]:
        _fs(spark, path).delete(_path(spark, f"{path}/manifest/v={n}"), True)
    for batch in _names(spark, f"{path}/data"):
        number = int(batch.split("=")[1])
        if number > versions[-1]:
            continue
        for name in _names(spark, f"{path}/data/{batch}"):
            if name.startswith(f"{BUCKET}=") and (int(name.split("=")[1]), number) not in stay:
                _fs(spark, path).delete(_path(spark, f"{path}/data/{batch}/{name}"), True)
    return versions[:-keep]


def _read(spark: SparkSession, path: str, manifest: Manifest, held: dict[int, int]) -> DataFrame:
    folders = [f"{path}/data/{BATCH}={v}/{BUCKET}={b}" for b, v in sorted(held.items())]
    if not folders:
        return spark.createDataFrame([], manifest.schema)
    return spark.read.schema(manifest.schema).parquet(*folders)


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    if version is None:
        versions = _versions(spark, path)
        if not versions:
            return None
        version = versions[-1]
    read = json.loads(spark.read.text(f"{path}/manifest/v={version}").first()[0])
    return Manifest(read["batch"], read["buckets"], read["keys"], T.StructType.fromJson(read["schema"]), dict(map(tuple, read["held"])))


def _versions(spark: SparkSession, path: str) -> list[int]:
    root = f"{path}/manifest"
    return sorted(int(n[2:]) for n in _names(spark, root)
                  if n.startswith("v=") and _fs(spark, path).exists(_path(spark, f"{root}/{n}/_SUCCESS")))


def _names(spark: SparkSession, path: str) -> Iterable[str]:
    fs, root = _fs(spark, path), _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
