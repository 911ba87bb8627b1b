"""Segments to speakers by overlap in time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Seconds of a time bucket. Both sides meet by session and bucket, so a long session is spread over tasks.
BUCKET_S = 60.0
#: An interval over more buckets (a wrong end, as a rule) meets the other side by session instead of being repeated in each.
MOST_BUCKETS = 1440


def _spread(df: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """(rows of usual length with each ``bucket`` they touch, rows over more than MOST_BUCKETS)."""
    lo, hi = (F.floor(F.col(c) / BUCKET_S) for c in (start, end))
    long = hi - lo > MOST_BUCKETS
    return df.where(~long).withColumn("bucket", F.explode(F.sequence(lo, F.greatest(lo, hi)))), df.where(long)


def overlap_assigned(segments: DataFrame, turns: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``overlap_speaker``: of the turn with the largest positive overlap, the earlier one if equal; null if none.

    Null times overlap nothing.
    """
    every_s = segments.where("start is not null and end is not null").select(*keys, "ord", F.col("start").alias("s0"), F.col("end").alias("s1"))
    every_t = turns.where("start is not null and end is not null and end > start").select(*keys, F.col("start").alias("t0"), F.col("end").alias("t1"), "speaker")
    (s, long_s), (t, long_t) = _spread(every_s, "s0", "s1"), _spread(every_t, "t0", "t1")
    cols = [*keys, "ord", "s0", "s1", "t0", "t1", "speaker"]
    met = s.join(t, [*keys, "bucket"]).select(*cols).unionByName(long_s.join(every_t, keys).select(*cols)).unionByName(s.drop("bucket").distinct().join(long_t, keys).select(*cols))
    met = met.withColumn("overlap", F.least("s1", "t1") - F.greatest("s0", "t0")).where("overlap > 0")
    best = met.groupBy(*keys, "ord").agg(F.max_by("speaker", F.struct("overlap", -F.col("t0"), -F.col("t1"), "speaker")).alias("overlap_speaker"))
    return segments.join(best, [*keys, "ord"], "left")


def assigned(segments: DataFrame, turns: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``speaker``: by overlap; a gap goes on with the speaker before; a gap at the beginning takes the
    turn whose middle is nearest (if both have times); UNKNOWN without turns."""
    s = overlap_assigned(segments.drop("speaker"), turns, keys)
    w = W.partitionBy(*keys).orderBy("ord")
    first = s.withColumn("rn", F.row_number().over(w)).where("rn = 1 and overlap_speaker is null and start is not null and end is not null").select(*keys, "ord", ((F.col("start") + F.col("end")) / 2).alias("mid"))
    t = turns.where("start is not null and end is not null").select(*keys, ((F.col("start") + F.col("end")) / 2).alias("tmid"), F.col("start").alias("t0"), F.col("speaker").alias("sp"))
    near = first.join(t, keys).groupBy(*keys, "ord").agg(F.min_by("sp", F.struct(F.abs(F.col("mid") - F.col("tmid")), "t0", "sp")).alias("near"))
    s = s.join(near, [*keys, "ord"], "left").withColumn("known", F.coalesce("overlap_speaker", "near"))
    s = s.withColumn("speaker", F.coalesce(F.last("known", ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0)), F.lit("UNKNOWN")))
    return s.drop("known", "near", "overlap_speaker")
