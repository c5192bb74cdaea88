"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


def local_session(app: str = "clauseloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and single-machine runs; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, wherever they run; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="clauseloom-")) / "clauseloom"), "zip", root, "clauseloom")
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


_LOCAL_FOLDER: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets one temporary folder for the process; on a cluster this is an error,
    since each executor would write to its own disk.
    """
    folder = spark.conf.get(SHARED_FOLDER, None) or spark.sparkContext.getConf().get(SHARED_FOLDER)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {SHARED_FOLDER} to a folder that the driver and all executors share; the master is {master}")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="clauseloom-"))
    return _LOCAL_FOLDER[0]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_path(spark: SparkSession, folder: str) -> str | None:
    """``folder`` as a path of the operating system, where Spark finds it on a disk or a mount; none for other stores."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
