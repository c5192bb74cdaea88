"""The result table as snapshots: one current row per contract, in the files that a manifest names.

Contracts are dealt to buckets by a hash of their id.  A merge rewrites the buckets that its rows belong to, in one shuffle, and
leaves all other files where they are; readers open one file set without ranking versions.  A snapshot is a small
manifest, which holds one folder per bucket and the last batch of each run.  It is written beside the others and renamed into place, which
fails where another merge was first; a merge that dies earlier leaves the table as it was, and ``vacuum`` removes what it wrote.

The folder's file system must rename atomically, as HDFS and local disks do.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..fields import SLA_FIELDS, FieldConfig, result_schema
from ..session import written

DATA, MANIFESTS, BUCKET = "data", "manifests", "bucket"


def create(spark: SparkSession, path: str, buckets: int, fields: FieldConfig = SLA_FIELDS) -> None:
    """An empty table of so many buckets, where there is none; a bucket is merged by one task, so it should fit one."""
    if not _versions(spark, path):
        _commit(spark, path, {"version": 0, "buckets": buckets, "columns": result_schema(fields).names, "files": {}, "runs": {}})


def read(spark: SparkSession, path: str, fields: FieldConfig = SLA_FIELDS, version: int | None = None) -> DataFrame:
    """The current rows, or those of an earlier version that is still kept."""
    return _rows(spark, path, manifest(spark, path, version), fields)


def lookup(spark: SparkSession, path: str, contract_ids: list[str], fields: FieldConfig = SLA_FIELDS) -> DataFrame:
    """The rows of a few contracts; only their buckets are opened."""
    now = manifest(spark, path)
    asked = spark.createDataFrame([(c,) for c in contract_ids], "contract_id string").select(_bucket(now)).distinct()
    return _rows(spark, path, now, fields, [r[0] for r in asked.collect()]).where(F.col("contract_id").isin(contract_ids))


def merge(rows: DataFrame, path: str, run_id: str, batch_id: int, fields: FieldConfig = SLA_FIELDS) -> int:
    """Merge a batch and return the version that holds it.

    The newest row by ``created_at`` stays, of equally new ones a row of the batch; rows of the batch that are equally new are told apart by
    their values.  A batch whose number its run has reached is not merged again.
    """
    spark = rows.sparkSession
    now = manifest(spark, path)
    if now["runs"].get(run_id, -1) >= batch_id:
        return now["version"]
    names = result_schema(fields).names
    batch = written(_newest(rows.select(*names, _bucket(now), F.lit(1).alias("_new"))), "merge")
    touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]  # as many numbers as buckets, at most
    files = dict(now["files"])
    if touched:
        before = _rows(spark, path, now, fields, touched).select(*names, _bucket(now), F.lit(0).alias("_new"))
        folder = f"{DATA}/{uuid.uuid4().hex}"
        merged = before.unionByName(batch).repartition(F.col(BUCKET))
        _newest(merged).drop("_new").write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
        files.update((str(b), f"{folder}/{BUCKET}={b}") for b in touched)
    _commit(spark, path, {**now, "version": now["version"] + 1, "files": files, "runs": {**now["runs"], run_id: batch_id}})
    return now["version"] + 1


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove the manifests before the last ``keep`` and all files that the kept ones do not name; no merge may run meanwhile."""
    versions = _versions(spark, path)
    fs = _fs(spark, path)
    live = {name for v in versions[-keep:] for name in manifest(spark, path, v)["files"].values()}
    for version in versions[:-keep]:
        fs.delete(_path(spark, f"{path}/{MANIFESTS}/{version:020d}.json"), False)
    removed = 0
    for folder in _names(spark, f"{path}/{DATA}"):
        buckets = [n for n in _names(spark, f"{path}/{DATA}/{folder}") if n.startswith(f"{BUCKET}=")]
        dead = [b for b in buckets if f"{DATA}/{folder}/{b}" not in live]
        for name in ([""] if len(dead) == len(buckets) else dead):
            fs.delete(_path(spark, f"{path}/{DATA}/{folder}/{name}".rstrip("/")), True)
        removed += len(dead)
    return removed


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """What a version, by default the last, consists of."""
    versions = _versions(spark, path)
    if not versions or (version is not None and version not in versions):
        raise ValueError(f"no table, or no such version, at {path}")
    name = f"{path}/{MANIFESTS}/{versions[-1] if version is None else version:020d}.json"
    return json.loads(spark.read.text(name, wholetext=True).first()[0])


def _bucket(now: dict):
    return F.pmod(F.xxhash64("contract_id"), F.lit(now["buckets"])).cast("int").alias(BUCKET)


def _rows(spark: SparkSession, path: str, now: dict, fields: FieldConfig, buckets: list[int] | None = None) -> DataFrame:
    schema = result_schema(fields)
    if now["columns"] != schema.names:
        raise ValueError(f"the table at {path} has other columns: {now['columns']}")
    wanted = now["files"] if buckets is None else {str(b) for b in buckets}
    folders = [f"{path}/{folder}" for bucket, folder in now["files"].items() if bucket in wanted]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _newest(rows: DataFrame) -> DataFrame:
    """One row per contract; rows dealt by bucket are not shuffled again."""
    order = [F.col("created_at").desc_nulls_last(), F.col("_new").desc(), F.xxhash64(*[c for c in rows.columns if c != BUCKET])]
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy(BUCKET, "contract_id").orderBy(*order)))
    return ranked.where("_n = 1").drop("_n")


# --- files of the manifests ---------------------------------------------------------------------------------


def _path(spark: SparkSession, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)


def _fs(spark: SparkSession, name: str):
    return _path(spark, name).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _fs(spark, folder), _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [int(name.removesuffix(".json")) for name in _names(spark, f"{path}/{MANIFESTS}") if name.endswith(".json")]


def _commit(spark: SparkSession, path: str, now: dict) -> None:
    """Write a manifest under a name of its own and rename it to its version's; an error where that version is there."""
    fs, hadoop = _fs(spark, path), spark.sparkContext._jvm.org.apache.hadoop.fs
    temporary = _path(spark, f"{path}/{MANIFESTS}/{uuid.uuid4().hex}.tmp")
    out = fs.create(temporary, False)
    out.write(bytearray(json.dumps(now).encode()))
    out.close()
    target = _path(spark, f"{path}/{MANIFESTS}/{now['version']:020d}.json")
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    files = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(temporary), fs.makeQualified(target), plain)
