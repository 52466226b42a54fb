"""Running a stream over all available input and reading back what it produced."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.session import scratch


REPORTS = "spark.sql.streaming.numRecentProgressUpdates"
BUCKETS = 64  # parts of an upserted table; a batch rewrites those its keys fall into


def start_append(stream: DataFrame, root: str, by: Sequence[str] = ()) -> StreamingQuery:
    """Append mode into a file sink, which records each batch once even when it is retried."""
    # All reports of the run are kept, so that counts over them miss no batch.
    stream.sparkSession.conf.set(REPORTS, str(2**31 - 1))
    job = (
        stream.writeStream.format("parquet")
        .partitionBy(*by)
        .outputMode("append")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{root}/rows")
    )
    job.awaitTermination()
    return job


STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def append(stream: DataFrame, name: str, by: Sequence[str] = (), store: str | None = None) -> DataFrame:
    """Drain in append mode and read the sink; ``store`` names a state store for this job alone."""
    spark = stream.sparkSession
    root = scratch(spark, name)
    usual = spark.conf.get(STORE)
    if store:
        spark.conf.set(STORE, store)
    try:
        start_append(stream, root, by)
    finally:
        spark.conf.set(STORE, usual)
    return spark.read.schema(stream.schema).parquet(f"{root}/rows")


def progress_counts(job: StreamingQuery) -> tuple[int, int]:
    """(rows read, rows dropped behind the watermark) over the batches of a run."""
    read = sum(int(p["numInputRows"]) for p in job.recentProgress)
    dropped = sum(int(op["numRowsDroppedByWatermark"]) for p in job.recentProgress for op in p["stateOperators"])
    return read, dropped


def upsert(stream: DataFrame, name: str, keys: Sequence[str], mode: str = "update") -> DataFrame:
    """Update or complete mode: the latest row per key over all batches.

    Keys are dealt to buckets by a hash. A batch merges its rows into the buckets it touches and
    writes those under its own number; a bucket is read where it was written last. A batch that
    runs twice starts from the batches before it and overwrites its own folder. In complete mode
    each batch is the whole result.
    """
    spark = stream.sparkSession
    root = scratch(spark, name)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket")
    written = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())])

    def newest(before: int | None) -> DataFrame:
        """The rows of every bucket, from the last batch (before a number) that wrote it."""
        rows = spark.read.schema(written).parquet(f"{root}/rows")
        rows = rows if before is None else rows.filter(F.col("batch") < before)
        place = ["batch"] if mode == "complete" else ["bucket", "batch"]
        last = rows.groupBy(*place[:-1]).agg(F.max("batch").alias("batch"))
        return rows.join(F.broadcast(last), place)  # a row per bucket at most

    def store(batch: DataFrame, number: int) -> None:
        new = batch.select("*", bucket)
        if mode != "complete" and number > 0:
            touched = F.broadcast(new.select("bucket").distinct())
            old = newest(number).join(touched, "bucket", "left_semi").select(*new.columns)
            same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
            new = new.unionByName(old.alias("o").join(new.select(*keys).alias("n"), same, "left_anti"))
        new.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/rows/batch={number}")

    job = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )
    job.awaitTermination()
    return newest(None).drop("batch", "bucket").select(*stream.columns)


def ingest(stream: DataFrame, day, name: str, column: str = "load_date") -> DataFrame:
    """New files into a day-partitioned table; a repeated batch rewrites its own files."""
    return append(stream.withColumn(column, day), name, [column])
