"""Session settings, the shared scratch folder and what becomes of its tables, and the size check in front of every broadcast."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Row, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Parquet looks at the size of a page or row group only after 100 rows, which of packed blocks are 100 MB; writers and readers hold whole pages.
PAGES = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(32 << 20)}


def builder(app_name: str = "marquee") -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new path under ``spark.checkpoint.dir``; a local folder only when Spark itself runs on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"marquee-{label}-") + "/out"
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")


def file_system(spark: SparkSession, path: str):
    """The file system that ``path`` lies in, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def rows_within(df: DataFrame, bound: int) -> list[Row] | None:
    """The rows of ``df`` when there are at most ``bound`` of them, else None. Never fetches more than ``bound + 1``."""
    rows = df.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None


@contextmanager
def no_shuffle_files_left(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when their job ends: jobs that write their results would leave those of all of them until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


#: Tables staged in the innermost open ``passing`` block, with their paths.
_passing: ContextVar[list[tuple[DataFrame, str]] | None] = ContextVar("passing", default=None)


@contextmanager
def passing() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables staged inside are deleted when the block ends, except those handed to the function that it yields: these belong to the block around
    it, or stay. No plan that runs later may read the others."""
    outer, mine = _passing.get(), []
    token = _passing.set(mine)

    def keep(table: DataFrame) -> DataFrame:
        for entry in [x for x in mine if x[0] is table]:
            mine.remove(entry)
            if outer is not None:
                outer.append(entry)
        return table

    try:
        yield keep
    finally:
        _passing.reset(token)
        for table, path in mine:
            fs, place = file_system(table.sparkSession, path)
            fs.delete(place, True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the scratch folder and read back: for costly rows that a later plan reads several times."""
    path = scratch_dir(df.sparkSession, label)
    with no_shuffle_files_left(df.sparkSession):
        df.write.options(**PAGES).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    if (tables := _passing.get()) is not None:
        tables.append((table, path))
    return table
