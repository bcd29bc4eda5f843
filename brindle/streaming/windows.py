"""Incremental twins of batch operators on Structured Streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.session import shared_folder


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream; its schema is that of the files there."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new folder on the storage all executors share (session.shared_folder)."""
    return f"{shared_folder(spark, 'brindle-stream-').rstrip('/')}/stream-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists on the file system its address names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def drain(stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what is there now and return the result it has written.

    complete: every trigger replaces the result; append: every trigger adds a folder named after it, so a trigger
    that is run again after a failure replaces its own rows only.
    """
    spark = stream.sparkSession
    folder = work_folder(spark)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out" if mode == "complete" else f"{folder}/out/batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/checkpoint").foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    if not exists(spark, f"{folder}/out"):
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(f"{folder}/out" if mode == "complete" else f"{folder}/out/batch=*")


def instants(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP, which watermarks need; times without a zone are UTC whatever the session's zone."""
    plain = dict(events.dtypes)[ts] == "timestamp_ntz"
    return events.withColumn(ts, (F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts) if plain else F.col(ts)).cast("timestamp"))


def tumbling(events: DataFrame, width: str = "1 day") -> DataFrame:
    return instants(events).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.unix_micros("w.start").alias("start_us"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "7 days", step: str = "1 day") -> DataFrame:
    return instants(events).groupBy(F.window("ts", width, step).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.unix_micros("w.start").alias("start_us"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return instants(events).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select(F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "user_id", "n")


def first_deliveries(events: DataFrame, keys: list[str], late: str = "10 days") -> DataFrame:
    """Each key once, repeats within the lateness bound dropped by a state that forgets older keys."""
    return instants(events).withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def latest_values(events: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Keyed current state: the latest value of each key, kept by mergeable state of one row per key."""
    return instants(events).groupBy(key).agg(F.max(F.struct("ts", *fields)).alias("r")).select(key, F.unix_micros("r.ts").alias("t"), *[f"r.{f}" for f in fields])
