"""Queries of this subpackage by name, each with its SQL where SQL can say it."""

from __future__ import annotations

import functools
import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, wherever they run; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="clauseloom-")) / "clauseloom"), "zip", root, "clauseloom")
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")

        @functools.wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return function(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def discard(stored: DataFrame) -> None:
    """Delete the files of a table that ``session.written`` gave, once all that is made of it is written itself."""
    context = stored.sparkSession.sparkContext
    for folder in {name.rsplit("/", 1)[0] for name in stored.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
