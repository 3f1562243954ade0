"""Incremental intake with Structured Streaming: late rows tolerated, redelivered rows dropped, upserts in micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.upsert import merge_rows
from quern.session import shared_dir


def read_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream over a folder of Parquet files, with zone-less times as instants (a watermark needs them)."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    df = reader.parquet(path)
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)})


def deduplicated(stream: DataFrame, key: str, time: str, lateness: str = "6 hours") -> DataFrame:
    """Each key once, as long as repeats arrive within the watermark's delay; state older than that is dropped."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, time: str, by: str, width: str = "1 day", lateness: str = "6 hours") -> DataFrame:
    return stream.withWatermark(time, lateness).groupBy(F.window(time, width), by).agg(F.count(F.lit(1)).alias("n"))


def run_available(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process what is there, then stop; the rows written, read back. Checkpoint and sink lie in the shared folder."""
    import uuid

    spark = stream.sparkSession
    at = f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"
    query = stream.writeStream.format("parquet").option("path", f"{at}/rows").option("checkpointLocation", f"{at}/state").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/rows")


def run_updates(stream: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """An aggregation in update mode over what is there, then the latest row of each combination of keys: windows that the watermark has not closed
    are given, too. Every micro-batch writes its own folder, so a batch that is repeated after a failure replaces itself."""
    import uuid

    spark = stream.sparkSession
    at = f"{shared_dir(spark)}/stream-{name}-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("__batch", F.lit(number)).write.mode("overwrite").parquet(f"{at}/rows/part={number}")

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{at}/state").outputMode("update").trigger(availableNow=True).start()
    query.awaitTermination()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/rows")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], stream.schema)
    rows = spark.read.parquet(f"{at}/rows").drop("part")
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*stream.columns), "__batch").alias("r"))
    return latest.select("r.*")


def upsert_stream(stream: DataFrame, target: str, checkpoint: str, key: list[str], update: list[str], once: bool = True):
    """foreachBatch upsert into a Parquet table of versioned folders: a batch that is replayed after a failure writes the same version again."""
    spark = stream.sparkSession

    def apply(batch: DataFrame, number: int) -> None:
        jvm = spark._jvm
        before = jvm.org.apache.hadoop.fs.Path(f"{target}/v{number - 1}")
        fs = before.getFileSystem(spark._jsc.hadoopConfiguration())
        current = spark.read.parquet(before.toString()) if fs.exists(before) else batch.limit(0)
        merge_rows(current, batch, key, update).write.mode("overwrite").parquet(f"{target}/v{number}")

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
