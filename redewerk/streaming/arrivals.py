"""Append-only arrivals as a stream: each run takes what is new since the last and merges it into the ledger.

The batch comparison of snapshots stays authoritative for changed and missing files, which a
file stream cannot see.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.sinks import VersionedTable


def arrivals(spark: SparkSession, folder: str, schema: str, names: str = "*.parquet") -> DataFrame:
    """A stream over the Parquet files of a folder, those added later included."""
    return spark.readStream.schema(schema).option("pathGlobFilter", names).parquet(folder)


def merged(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """Ledger (stem, first_seen, last_seen, n) with a batch (stem, seen): first_seen stays, last_seen grows."""
    b = batch.where("stem is not null").groupBy("stem").agg(F.min("seen").alias("first_seen"), F.max("seen").alias("last_seen"), F.count("*").alias("n"))
    return ledger.unionByName(b).groupBy("stem").agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("n").alias("n"))


LEDGER = "stem string, first_seen timestamp_ntz, last_seen timestamp_ntz, n bigint, batch bigint"


def keep_ledger(stream: DataFrame, table: VersionedTable, checkpoint: str) -> StreamingQuery:
    """Run through all that has arrived and stop. A batch that runs again after a failure is recognised by its number and not counted twice."""

    def take(batch: DataFrame, number: int) -> None:
        now = table.read(LEDGER)
        last = now.agg(F.max("batch")).first()[0]
        if last is not None and last >= number:
            return
        table.write(merged(now.drop("batch"), batch).withColumn("batch", F.lit(number).cast("bigint")))

    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts by key and time window; rows later than ``late`` behind the watermark are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))
