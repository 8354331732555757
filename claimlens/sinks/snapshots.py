"""Snapshot tables (K08): in-place updates without touching what is being read.

A table's rows lie in ``SHARDS`` shards by a hash of their key.  Data folders are
immutable; a version is one small file that names the folder of each shard.  An
update writes new folders for the shards that hold changed keys alone and then adds a
version file, so readers of an older version are not disturbed and a
failed update leaves no trace but unused folders.  A version's number is claimed by
creating a lock file, which fails if another writer was first.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

SHARDS = 64
_SHARD = "snapshot_shard"


def _shard(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(SHARDS)).cast("int")


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, folder = _hadoop(spark, f"{path}/_versions")
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, ascending."""
    return sorted(int(n.split(".")[0]) for n in _names(spark, path) if n.endswith(".json"))


def _manifest(spark: SparkSession, path: str, version: int | None) -> dict:
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"{path} has no version {version or ''}".rstrip())
    row = spark.read.text(f"{path}/_versions/{version or known[-1]:08d}.json", wholetext=True).first()
    return json.loads(row["value"])


def _commit(spark: SparkSession, path: str, version: int, manifest: dict) -> int:
    """Make a version readable; fails if another writer has taken its number."""
    folder = f"{path}/_versions"
    fs, lock = _hadoop(spark, f"{folder}/{version:08d}.lock")
    fs.create(lock, False).close()              # raises if it exists
    _, draft = _hadoop(spark, f"{folder}/{uuid.uuid4().hex}.draft")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not fs.rename(draft, _hadoop(spark, f"{folder}/{version:08d}.json")[1]):
        raise IOError(f"version {version} of {path} was not written")
    return version


def _write(rows: DataFrame, path: str) -> str:
    folder = f"data/{uuid.uuid4().hex}"
    # AQE splits a shard that one key makes large
    rows.hint("rebalance", _SHARD).write.partitionBy(_SHARD).parquet(f"{path}/{folder}")
    return folder


def _shards_of(spark: SparkSession, path: str, folder: str) -> dict:
    fs, place = _hadoop(spark, f"{path}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()]
    return {n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith(f"{_SHARD}=")}


def create(df: DataFrame, path: str, key: str) -> int:
    """Write ``df`` as version 1 of a new table with that key column."""
    spark = df.sparkSession
    folder = _write(df.withColumn(_SHARD, _shard(key)), path)
    return _commit(spark, path, 1, {"key": key, "schema": df.schema.json(), "shards": _shards_of(spark, path, folder)})


def read(spark: SparkSession, path: str, version: int | None = None, shards=None) -> DataFrame:
    """Rows of a version (the last by default), or of some of its shards."""
    manifest = _manifest(spark, path, version)
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    folders = [f for s, f in manifest["shards"].items() if shards is None or int(s) in shards]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in folders])


def update(spark: SparkSession, path: str, changes: DataFrame, column: str) -> int:
    """A new version in which ``column`` has the value of ``changes`` (key,
    column) wherever that is not null; of several values of a key the largest.
    Keys that the table lacks change nothing; null keys neither."""
    version = versions(spark, path)[-1]
    manifest = _manifest(spark, path, version)
    key = manifest["key"]
    values = changes.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(column).alias("_new"))
    touched = {r[0] for r in values.select(_shard(key)).distinct().collect()}        # at most SHARDS rows
    old = read(spark, path, version, touched)
    rows = old.join(values, key, "left").withColumn(column, F.coalesce(F.col("_new").cast(old.schema[column].dataType), column)).select(*old.columns)
    folder = _write(rows.withColumn(_SHARD, _shard(key)), path)
    return _commit(spark, path, version + 1, manifest | {"shards": manifest["shards"] | _shards_of(spark, path, folder)})
