"""Streaming landing: new files in, each document landed once per freshness window, merged batch by batch."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from marquee import constants as K


def read_stream(spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def thin(docs: DataFrame, key: list[str], hours: int) -> DataFrame:
    """Documents of each key in the order of ``fetched_at``: one lands when more than ``hours`` have passed since the last that landed.

    Which of them land depends on the one before, so each key is walked in order. Rows are dealt by key and sorted on the JVM; a
    task holds one Arrow batch and one time, however many documents a key has. Of equal times the smallest content lands.
    """
    rest = [c for c in docs.columns if c not in key and c != "fetched_at"]
    name, at = F.to_json(F.struct(*key)).alias("_key"), F.unix_micros("fetched_at").alias("_at")
    rows = docs.filter(F.col("fetched_at").isNotNull()).select("*", name, at).repartition("_key")
    rows = rows.sortWithinPartitions("_key", "_at", *([F.xxhash64(*rest)] if rest else []), *key)
    gap = hours * 3_600_000_000
    n = len(docs.columns)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_at = None
        for batch in batches:
            keep = []
            for k, t in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist()):
                lands = k != last_key or t - last_at > gap
                if lands:
                    last_key, last_at = k, t
                keep.append(lands)
            yield pa.RecordBatch.from_arrays(batch.columns[:n], names=batch.schema.names[:n]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(walk, docs.schema)


def land_stream(docs: DataFrame, key: list[str], target: str, checkpoint: str, hours: int = K.FRESH_HOURS) -> StreamingQuery:
    """Land the documents that are new: more than ``hours`` away from every landed document of the same key.

    ``docs`` carries ``fetched_at``. One rule holds inside a micro-batch (``thin``) and against earlier ones, where it looks to both
    sides, so a late document lands unless one of its own time has. Every micro-batch writes its own ``batch_id`` folder in
    overwrite mode, so a batch that is repeated after a failure lands the same rows once. Landed documents are looked
    up in the folders of earlier batches; those are split by day, and only the days that the batch reaches are read.
    """
    window = F.make_dt_interval(hours=F.lit(hours))
    day = F.to_date("fetched_at")

    def land(batch: DataFrame, batch_id: int) -> None:
        fresh = batch
        ends = None
        if batch_id > 0:
            ends = batch.agg(
                F.to_date(F.min("fetched_at") - window).alias("first"), F.to_date(F.max("fetched_at") + window).alias("last")
            ).first()
        if ends is not None and ends["first"] is not None:
            layout = [*batch.schema.fields, StructField("batch_id", LongType()), StructField("day", DateType())]
            landed = (
                batch.sparkSession.read.schema(StructType(layout))
                .parquet(target)
                .filter((F.col("batch_id") < batch_id) & F.col("day").between(F.lit(ends["first"]), F.lit(ends["last"])))
                .select(*[F.col(c).alias(f"_{c}") for c in key], F.col("fetched_at").alias("_landed"))
            )
            same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key])
            near = F.col("_landed").between(F.col("fetched_at") - window, F.col("fetched_at") + window)
            fresh = batch.join(landed, same & near, "left_anti")
        thin(fresh, key, hours).withColumn("day", day).write.mode("overwrite").partitionBy("day").parquet(f"{target}/batch_id={batch_id}")

    return (
        docs.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_within_window(docs: DataFrame, key: list[str], hours: int = K.FRESH_HOURS) -> DataFrame:
    """In-stream alternative that keeps ``hours`` of state; Spark drops rows that arrive later than that."""
    return docs.withWatermark("fetched_at", f"{hours} hours").dropDuplicatesWithinWatermark(key)
