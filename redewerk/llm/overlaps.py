"""Problem 2: the same or almost the same transcript in train and in another split.

Transcripts are folded to words. Equal word sequences form a class; only one of each
class is compared. Two texts whose longest common subsequence reaches four fifths of the
longer one have as many words in common, so they share a known number of the rarest ones
(prefix filter); this holds for any edits and any group of copies. Texts of fitting length
meet in blocks; every pair that shares so many is verified on the whole texts: first the bag
of words, then the longest common subsequence, must reach four fifths of the longer transcript.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import ROLE_USER, content_of, cut, folded, part_count, read, stem_key, written

#: Words are ordered by the number of texts that hold them if this is a larger share of all texts. As a transcript
#: holds at most its length of words, there are at most (mean length / share) such words. Others come first.
RANKED_SHARE = 0.001
#: Texts of a block. Each block of one side meets those of the other side with a length that can agree.
BLOCK = 2000


def transcript(messages: Column) -> Column:
    """The user message; of a framed one the part between ``Transkript:`` and the closing ``Zusammenfassung:``."""
    text = content_of(messages, ROLE_USER)
    inner = F.regexp_extract(text, r"(?s)Transkript:(.*)Zusammenfassung:\s*$", 1)
    opened = F.regexp_extract(text, r"(?s)Transkript:(.*)$", 1)
    return F.when(inner != "", inner).when(text.contains("Transkript:"), opened).otherwise(text)


def note_split(note: Column) -> Column:
    """What a free note of the held-out list says: ``train`` (released), ``validation`` or ``test``."""
    n = F.lower(note)
    released = n.rlike(r"releas|lifted|trained on again|aufgehoben|freigegeben|wieder im training|jetzt training")
    return F.when(released, "train").when(n.rlike(r"valid|\bval\b"), "validation").when(n.isNotNull(), "test")


def splits_of(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """(rec_id, split, source, words): split by the held-out list, else the column; words folded.

    A sitting listed with several notes is tested rather than validated, and validated rather
    than released. Rows of the same rec_id count once. Unknown and null splits stay null.
    """
    order = F.array(F.lit("test"), F.lit("validation"), F.lit("train"))
    notes = manifest.select(stem_key(F.col("stem")).alias("sitting"), note_split(F.col("split_note")).alias("note"))
    notes = notes.where("sitting is not null and note is not null").groupBy("sitting").agg(F.min(F.array_position(order, F.col("note"))).alias("rank"))
    own = F.lower(F.trim("split"))
    own = F.when(own.isin("train", "training"), "train").when(own.isin("val", "valid", "validation", "dev"), "validation").when(own == "test", "test")
    r = records.where("rec_id is not null").select("rec_id", stem_key(F.col("meta.stem")).alias("sitting"), own.alias("own"), "source", transcript(F.col("messages")).alias("words"))
    r = r.dropDuplicates(["rec_id"]).withColumn("words", folded(F.col("words")))
    r = r.join(notes, "sitting", "left")
    return r.select("rec_id", F.when(F.col("rank") == 1, "test").when(F.col("rank") == 2, "validation").when(F.col("rank") == 3, "train").otherwise(F.col("own")).alias("split"), "source", "words")


def need(n: int) -> int:
    """Words that a text agreeing with one of ``n`` words has in common with it, at least."""
    return -(-4 * n // 5)


def ranks(texts: DataFrame) -> dict[tuple[str, int], int]:
    """How many texts hold a word for the k-th time, by (word, k), where these are more than RANKED_SHARE of the texts."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        times = Counter(x for b in batches for s in b["words"] for x in Counter(s.split(" ")).items())
        yield pd.DataFrame([(w, k, n) for (w, k), n in times.items()], columns=["w", "times", "n"])

    c = texts.select("words").mapInPandas(counted, "w string, times int, n bigint").groupBy("w", "times").agg(F.sum("n").alias("n"))
    c = c.select("w", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("k"), "n").groupBy("w", "k").agg(F.sum("n").alias("n"))
    return {(r["w"], r["k"]): r["n"] for r in c.where(F.col("n") > RANKED_SHARE * texts.count()).collect()}


def prefix(words: list[str], rank: dict[tuple[str, int], int]) -> list[int]:
    """Hashes of the rarest words, the k-th standing of a word as a word of its own.

    If all but ``n - need(n)`` words are shared, then at least l of the first ``n - need(n) + l`` are; l is ``n // 5``.
    """
    n = len(words)
    own = sorted((rank.get((w, k), 0), w, k) for w, m in Counter(words).items() for k in range(1, m + 1))
    return [xxhash.xxh3_64_intdigest(f"{w}\x1f{k}") - (1 << 63) for _, w, k in own[: n - need(n) + n // 5]]


def agreement_reached(a: list[str], b: list[str]) -> bool:
    """Whether the longest common subsequence reaches four fifths of the longer list."""
    longer = max(len(a), len(b))
    least = need(longer)
    if min(len(a), len(b)) < least or sum((Counter(a) & Counter(b)).values()) < least:
        return False
    at: dict[str, int] = defaultdict(int)
    for j, w in enumerate(b):
        at[w] |= 1 << j
    full = (1 << len(b)) - 1
    v = full
    for w in a:
        u = v & at.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count() >= least


def block_pairs(both: pd.DataFrame) -> pd.DataFrame:
    """(a, b): classes of two blocks (one with ``ev``, one without) that agree."""
    ev, tr = both[both["ev"]], both[~both["ev"]]
    of: dict[int, list[int]] = defaultdict(list)
    texts = [w.split(" ") for w in tr["words"]]
    for j, p in enumerate(tr["prefix"]):
        for h in p:
            of[h].append(j)
    posts = {h: np.array(x, dtype=np.int32) for h, x in of.items()}
    n = np.array([len(x) for x in texts])
    cls, out = tr["cls"].to_numpy(), []
    for a, words, p in zip(ev["cls"], ev["words"], ev["prefix"]):
        hit = [posts[h] for h in p if h in posts]
        x = words.split(" ")
        m = len(x)
        # very short texts need not share any of the rarest
        shared = np.bincount(np.concatenate(hit), minlength=len(n)) if hit else np.zeros(len(n), dtype=int)
        fit = (shared >= np.minimum(m, n) // 5) & (5 * m >= 4 * n) & (5 * n >= 4 * m) & (cls != a)
        out += [(a, cls[j]) for j in np.flatnonzero(fit) if agreement_reached(x, texts[j])]
    return pd.DataFrame(out, columns=["a", "b"], dtype=object)


def class_pairs(sides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(member table rec_id, cls, in_train), (pairs of a class a not only of train and a class b of train that agree, each of which may be met in both directions)."""
    texts = sides.where("words <> ''").withColumn("cls", F.md5("words")).withColumn("in_train", F.coalesce(F.col("split") == "train", F.lit(False)))
    texts = written(texts, "transcripts")
    members = texts.select("rec_id", "cls", "in_train", "split", "source")
    classes = texts.groupBy("cls").agg(F.max("in_train").alias("t"), F.max(~F.col("in_train")).alias("e"), F.first("words").alias("words"))
    classes = written(classes, "classes")
    rank = sides.sparkSession.sparkContext.broadcast(ranks(classes))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def prefixes(s: pd.Series) -> pd.Series:
        return pd.Series([np.array(prefix(x.split(" "), rank.value), dtype=np.int64) for x in s], dtype=object)

    # texts that agree are of the same band of lengths or of neighbouring ones
    band = F.floor(F.log(F.size(F.split("words", " ")).cast("double")) / math.log(1.2500001)).cast("int")
    g = written(classes.select("cls", "t", "e", "words", band.alias("band"), prefixes("words").alias("prefix")), "prefixes")
    size = g.groupBy("band").agg(F.sum(F.col("e").cast("int")).alias("ne"), F.sum(F.col("t").cast("int")).alias("nt")).collect()
    meet = [
        (e["band"], i, -(-e["ne"] // BLOCK), t["band"], j, -(-t["nt"] // BLOCK))
        for e in size for t in size if abs(e["band"] - t["band"]) <= 1
        for i in range(-(-e["ne"] // BLOCK)) for j in range(-(-t["nt"] // BLOCK))
    ]
    blocks = [(k, *x) for k, x in enumerate(meet)]
    at = sides.sparkSession.createDataFrame(blocks, "block int, eb int, ei int, en int, tb int, ti int, tn int")
    sort = F.abs(F.xxhash64("cls") % F.lit(1 << 30))
    side = lambda ev: ["block", "cls", "words", "prefix", F.lit(ev).alias("ev")]
    ev = g.where("e").join(F.broadcast(at), (F.col("band") == F.col("eb")) & (sort % F.col("en") == F.col("ei"))).select(*side(True))
    tr = g.where("t").join(F.broadcast(at), (F.col("band") == F.col("tb")) & (sort % F.col("tn") == F.col("ti"))).select(*side(False))
    parts = max(1, min(len(blocks), 4 * part_count(sides)))
    return members, cut(ev.unionByName(tr).repartition(parts, "block").groupBy("block").applyInPandas(block_pairs, "a string, b string"))


def overlaps(sides: DataFrame) -> DataFrame:
    """(eval_rec, train_rec): all pairs of a record in train and one not in train whose transcripts agree.

    Blank and missing transcripts agree with none.
    """
    members, pairs = class_pairs(sides)
    ev = members.where("not in_train").select(F.col("rec_id").alias("eval_rec"), F.col("cls").alias("a"))
    tr = members.where("in_train").select(F.col("rec_id").alias("train_rec"), F.col("cls").alias("b"))
    same = ev.join(tr, F.col("a") == F.col("b")).select("eval_rec", "train_rec")
    near = pairs.join(ev, "a").join(tr, "b").select("eval_rec", "train_rec")
    return same.unionByName(near.distinct())


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = overlaps(splits_of(read(spark, sf_dir, "records"), read(spark, sf_dir, "manifest")))
    return pairs.select(F.least("eval_rec", "train_rec").alias("rec_a"), F.greatest("eval_rec", "train_rec").alias("rec_b"))


def report(sides: DataFrame) -> DataFrame:
    """(split, source, eval_records, train_records, pairs): overlaps of evaluation records, counted by classes of equal transcripts; no pair of records is made."""
    members, pairs = class_pairs(sides)
    n = members.groupBy("cls").agg(F.count_if("in_train").alias("t"))
    ev = members.where("not in_train").groupBy("cls", F.coalesce("split", F.lit("none")).alias("split"), "source").agg(F.count("*").alias("e"))
    # a class that holds both sides overlaps with itself
    same = members.groupBy("cls").agg(F.max("in_train").alias("t"), F.max(~F.col("in_train")).alias("e")).where("t and e").select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    links = cut(pairs.unionByName(same).distinct().join(n.select(F.col("cls").alias("b"), "t"), "b"))
    met = ev.withColumnRenamed("cls", "a").join(links.groupBy("a").agg(F.sum("t").alias("t")), "a")
    counts = met.groupBy("split", "source").agg(F.sum("e").alias("eval_records"), F.sum(F.col("e") * F.col("t")).alias("pairs"))
    train = ev.withColumnRenamed("cls", "a").join(links, "a").select("split", "source", "b", "t").distinct().groupBy("split", "source").agg(F.sum("t").alias("train_records"))
    on = counts["split"].eqNullSafe(train["split"]) & counts["source"].eqNullSafe(train["source"])
    return counts.join(train, on).select(counts["split"], counts["source"], "eval_records", "train_records", "pairs")


def p2_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping evaluation and train records per split and source of the evaluation record."""
    return report(splits_of(read(spark, sf_dir, "records"), read(spark, sf_dir, "manifest")))


def queries() -> dict:
    return {"p2_found": p2_found, "p2_report": p2_report}


def oracle_sql() -> dict[str, str]:
    return {}
