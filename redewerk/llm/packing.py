"""Problem 8: filling fixed-capacity containers with items.

Only the length of an item in tokens matters, so packing works on the histogram of
lengths, whose size is bounded by the capacity whatever the number of items. Minimum bin
slack: the longest length left opens a container, and a bitset subset-sum over a window of
the other lengths, with their counts, picks the multiset that fills the rest best; the
choice is read back from the bitsets and used as often as the counts allow. Items are then
numbered within their length over range partitions and looked up in the plan.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import cut, read, written

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Lengths in a window. If they can't fill a container, all lengths are taken.
WINDOW = 64


# --- fixed values: how the byte-level vocabularies part a text before it is encoded -------------
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@lru_cache(maxsize=2)
def tokenizer(path: str) -> tiktoken.Encoding:
    """The byte-level tokenizer of a vocabulary file, which all executors must find at this path."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("documents", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_of(spark: SparkSession) -> str:
    """The vocabulary file the session names (``spark.redewerk.vocabulary``), else the one of this environment."""
    return spark.conf.get("spark.redewerk.vocabulary", VOCABULARY)


def token_counts(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, tokens) of the documents with a text. Repeated rows count once."""
    path = vocabulary or vocabulary_of(documents.sparkSession)

    @F.pandas_udf(T.IntegerType())
    def count(text: pd.Series) -> pd.Series:
        enc = tokenizer(path)
        return text.map(lambda t: len(enc.encode_ordinary(t))).astype("int32")

    # counted where the texts are read: only numbers are shuffled
    d = documents.where("doc_id is not null and text is not null").select("doc_id", count("text").alias("tokens"))
    return d.groupBy("doc_id").agg(F.min("tokens").alias("tokens"))


def cut_text(text: str, size: int, vocabulary: str) -> list[tuple[int, str, int]]:
    """(piece, text, tokens) of a text cut after every ``size`` tokens; the pieces give the text when joined.

    A character of which a cut falls between the bytes goes to the piece in which it begins.
    """
    enc = tokenizer(vocabulary)
    tokens = enc.encode_ordinary(text)
    ends = np.cumsum([len(enc.decode_single_token_bytes(t)) for t in tokens]) if tokens else np.zeros(0, dtype=int)
    raw = text.encode()
    out, start = [], 0
    for k in range(0, len(tokens), size):
        end = int(ends[min(k + size, len(tokens)) - 1])
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        out.append((k // size, raw[start:end].decode(), min(size, len(tokens) - k)))
        start = end
    return out


def best_fill(room: int, lengths: list[int], counts: dict[int, int]) -> dict[int, int]:
    """The multiset of the lengths, no more of each than counted, whose sum comes closest to room from below."""
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for n in lengths:
        left = min(counts[n], room // n) if n else 0
        k = 1
        while left > 0 and not reach >> room & 1:
            k = min(k, left)
            steps.append((n, k, reach))
            reach |= reach << n * k & mask
            left -= k
            k *= 2
    at, used = reach.bit_length() - 1, {}
    for n, k, before in reversed(steps):
        if not before >> at & 1:
            used[n] = used.get(n, 0) + k
            at -= n * k
    return used


def plan(histogram: dict[int, int], capacity: int, window: int = WINDOW) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: number}) of the kinds of containers that take all items. Each kind uses up a length, so there are at most as many kinds as lengths plus one a leftover."""
    counts = {n: c for n, c in histogram.items() if 0 < n <= capacity and c > 0}
    out = []
    while counts:
        top = max(counts)
        counts[top] -= 1
        if not counts[top]:
            del counts[top]
        room = capacity - top
        fit = sorted((n for n in counts if n <= room), reverse=True)
        use: dict[int, int] = {}
        if fit:
            # the longest that fit, and the shortest to close the gap
            near = fit if len(fit) <= window else fit[: window // 2] + fit[-window // 2 :]
            use = best_fill(room, near, counts)
            if len(near) < len(fit) and sum(n * k for n, k in use.items()) < room:
                use = best_fill(room, fit, counts)
        use[top] = use.get(top, 0) + 1
        counts[top] = counts.get(top, 0) + 1
        times = min(counts[n] // k for n, k in use.items())
        for n, k in use.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        out.append((times, use))
    return out


_RANKED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("tokens", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("rank", T.LongType())])


def _ranks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), {}
    for pdf in parts:
        within = pdf.groupby("tokens").cumcount() + pdf["tokens"].map(seen).fillna(0).astype("int64")
        for n, c in pdf["tokens"].value_counts().items():
            seen[n] = seen.get(n, 0) + c
        yield pdf.assign(part=part, rank=within)[_RANKED.names]


def packed(items: DataFrame, capacity: int) -> DataFrame:
    """(container, doc_id, piece, tokens) from (doc_id, tokens).

    A text above the capacity is split into pieces of the capacity and a rest; no other is
    split. Texts of no tokens need no container and give no rows.
    """
    spark = items.sparkSession
    d = items.where("tokens > 0")
    n_pieces = F.ceil(F.col("tokens") / capacity).cast("int")
    p = d.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0), n_pieces - 1)).alias("piece"))
    p = p.select("doc_id", "piece", F.least(F.lit(capacity), F.col("tokens") - F.col("piece") * capacity).cast("int").alias("tokens"))
    line = p.repartitionByRange("tokens", "doc_id", "piece").sortWithinPartitions("tokens", "doc_id", "piece").mapInPandas(_ranks, _RANKED)
    line = written(line, "ranked")
    # per task at most as many rows as lengths; a length is in few tasks
    per = line.groupBy("tokens", "part").agg(F.count("*").alias("n")).orderBy("tokens", "part").collect()
    histogram: dict[int, int] = {}
    before: dict[tuple[int, int], int] = {}
    for r in per:
        before[r["tokens"], r["part"]] = histogram.get(r["tokens"], 0)
        histogram[r["tokens"]] = histogram.get(r["tokens"], 0) + r["n"]
    steps: dict[int, list[tuple[int, int, int]]] = {}
    given: dict[int, int] = {}
    base = 0
    for times, use in plan(histogram, capacity):
        for n, k in use.items():
            steps.setdefault(n, []).append((given.get(n, 0), k, base))
            given[n] = given.get(n, 0) + k * times
        base += times
    shared = spark.sparkContext.broadcast((before, {n: np.array(s) for n, s in steps.items()}))
    schema = T.StructType([T.StructField("container", T.LongType()), *_RANKED.fields[:3]])

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, of = shared.value
        for pdf in parts:
            out = np.empty(len(pdf), dtype="int64")
            for (n, part), rows in pdf.groupby(["tokens", "part"]).indices.items():
                rank = pdf["rank"].to_numpy()[rows] + starts[n, part]
                s = of[n]
                j = np.searchsorted(s[:, 0], rank, side="right") - 1
                out[rows] = s[j, 2] + (rank - s[j, 0]) // s[j, 1]
            yield pdf.assign(container=out)[schema.names]

    return line.mapInPandas(place, schema)


def containers(documents: DataFrame, limits: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(strategy, container, doc_id, piece, start, tokens) for each capacity of purpose ``containers``; start: the token of the text with which the piece begins."""
    sizes = cut(token_counts(documents, vocabulary))
    out: DataFrame | None = None
    for r in limits.where("purpose = 'containers' and max_size > 0").select("strategy", "max_size").distinct().orderBy("strategy").collect():
        one = packed(sizes, r["max_size"]).select(F.lit(r["strategy"]).alias("strategy"), "container", "doc_id", "piece", (F.col("piece") * F.lit(r["max_size"]).cast("bigint")).alias("start"), "tokens")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else documents.sparkSession.createDataFrame([], "strategy string, container bigint, doc_id bigint, piece int, start bigint, tokens int")


def filled(documents: DataFrame, limits: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(strategy, container, tokens, parts): each container with the texts and pieces of texts it holds, parts (doc_id, piece, text).

    A container holds no more than its capacity, so this brings together bounded rows only.
    """
    path = vocabulary or vocabulary_of(documents.sparkSession)
    plan = written(containers(documents, limits, path), "containers")
    sizes = limits.where("purpose = 'containers' and max_size > 0").select("strategy", F.col("max_size").alias("size")).distinct()
    piece = T.ArrayType(T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("tokens", T.IntegerType())]))

    @F.pandas_udf(piece)
    def pieces(text: pd.Series, size: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("piece", "text", "tokens"), x)) for x in cut_text(t, int(n), path)] for t, n in zip(text, size)])

    texts = documents.where("doc_id is not null and text is not null").groupBy("doc_id").agg(F.first("text").alias("text"))
    split = plan.where("start > 0").select("strategy", "doc_id").distinct().join(sizes, "strategy").join(texts, "doc_id")
    cut_up = split.select("strategy", "doc_id", F.explode(pieces("text", "size")).alias("x")).select("strategy", "doc_id", "x.piece", "x.text")
    whole = plan.join(split.select("strategy", "doc_id"), ["strategy", "doc_id"], "left_anti").join(texts, "doc_id")
    part = plan.join(cut_up, ["strategy", "doc_id", "piece"]).select("strategy", "container", "tokens", "doc_id", "piece", "text").unionByName(whole.select("strategy", "container", "tokens", "doc_id", "piece", "text"))
    return part.groupBy("strategy", "container").agg(F.sum("tokens").alias("tokens"), F.array_sort(F.collect_list(F.struct("doc_id", "piece", "text"))).alias("parts"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containers(read(spark, sf_dir, "documents"), read(spark, sf_dir, "size_limits"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, items, tokens and unused tokens for each capacity."""
    limits = read(spark, sf_dir, "size_limits")
    c = containers(read(spark, sf_dir, "documents"), limits)
    per = c.groupBy("strategy", "container").agg(F.count("*").alias("items"), F.sum("tokens").alias("tokens"))
    cap = limits.where("purpose = 'containers'").groupBy("strategy").agg(F.min("max_size").alias("capacity"))
    per = per.join(cap, "strategy")
    return per.groupBy("strategy").agg(
        F.max("capacity").alias("capacity"), F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"),
        F.sum(F.col("capacity") - F.col("tokens")).alias("unused"), F.max("tokens").alias("fullest"),
    )


def p8_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every container with its tokens and its texts put together, parted by blank lines."""
    f = filled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "size_limits"))
    return f.select("strategy", "container", "tokens", F.size("parts").alias("items"), F.array_join(F.transform("parts", lambda x: x["text"]), "\n\n").alias("text"))


def queries() -> dict:
    return {"p8_containers": p8_containers, "p8_fill": p8_fill, "p8_texts": p8_texts}


def oracle_sql() -> dict[str, str]:
    return {}
