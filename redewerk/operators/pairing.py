"""Pairing of transcripts with minutes, and of labels with persons."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions.similarity import token_sort


def exact_pairs(left: DataFrame, right: DataFrame, key: str = "key") -> DataFrame:
    """Left rows with the right row of the same key, of several the last by name; null if there is none."""
    r = right.withColumn("_rn", F.row_number().over(W.partitionBy(key).orderBy(F.col("name").desc()))).where("_rn = 1").select(key, F.col("name").alias("partner"))
    return left.join(r, key, "left")


def fuzzy_pairs(left: DataFrame, right: DataFrame, threshold: float = 90.0, guard: bool = True) -> DataFrame:
    """(name, partner, score) of (block, name, key) rows: greedy and one to one.

    Equal keys pair first. The rest pair within a block (as the committee), left names in order, each with the
    unused partner of the highest similarity from the threshold on. guard: keys whose numbers differ don't pair.
    A block holds the unpaired files of one committee.
    """
    same = left.select("block", "name", "key").join(right.select("block", F.col("name").alias("partner"), "key"), ["block", "key"])
    same = same.withColumn("a", F.dense_rank().over(W.partitionBy("block", "key").orderBy("name"))).withColumn("b", F.dense_rank().over(W.partitionBy("block", "key").orderBy("partner")))
    sure = same.where("a = b").select("name", "partner", F.lit(100.0).alias("score"))
    rest_l = left.join(sure.select("name"), "name", "left_anti").select("block", F.lit(0).alias("side"), "name", "key")
    rest_r = right.join(sure.select(F.col("partner").alias("name")), "name", "left_anti").select("block", F.lit(1).alias("side"), "name", "key")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("partner", T.StringType()), T.StructField("score", T.DoubleType())])

    def claim(pdf: pd.DataFrame) -> pd.DataFrame:
        import re

        lefts = sorted(pdf[pdf.side == 0][["name", "key"]].itertuples(index=False, name=None))
        rights = sorted(pdf[pdf.side == 1][["name", "key"]].itertuples(index=False, name=None))
        used, out = set(), []
        for name, key in lefts:
            best, score = None, 0.0
            for partner, other in rights:
                if partner in used or (guard and re.findall(r"\d+", key) != re.findall(r"\d+", other)):
                    continue
                s = token_sort(key, other)
                if s > score:
                    best, score = partner, s
            if best is not None and score >= threshold:
                used.add(best)
                out.append((name, best, score))
        return pd.DataFrame(out, columns=schema.names)

    return sure.unionByName(rest_l.unionByName(rest_r).groupBy("block").applyInPandas(claim, schema))


def best_assignment(scores: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """(keys, label, person, score) from (keys, label, rank, person, score): labels by rank, each takes its best free person from the threshold on."""
    schema = scores.select(*keys, "label", "person", "score").schema

    def claim(pdf: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for _, g in pdf.sort_values(["rank", "label"]).groupby("label", sort=False):
            g = g[~g["person"].isin(used)].sort_values(["score", "person"], ascending=[False, True])
            if len(g) and g["score"].iloc[0] >= threshold:
                used.add(g["person"].iloc[0])
                out.append(g.iloc[[0]])
        return pd.concat(out)[schema.names] if out else pdf.head(0)[schema.names]

    return scores.groupBy(*keys).applyInPandas(claim, schema)
