"""The session all queries are written for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(name: str = "redewerk", **settings: str) -> SparkSession:
    """A session with the fixed settings; ``settings`` (dots as ``__``) add to them."""
    b = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def kept(df: DataFrame) -> DataFrame:
    """``df`` made once for several uses: checkpointed in the shared folder the session names (``spark.checkpoint.dir``), so that lost executors cost nothing; cached where it names none."""
    spark = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(at)
    return df.checkpoint() if spark.sparkContext.getCheckpointDir() else df.persist()
