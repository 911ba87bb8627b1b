"""The dataset build from transcripts and minutes to records, rejects and summary, as one declared plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical_key, estimated_tokens
from ..operators import cleaning, dataset, sections
from ..operators.pairing import fuzzy_pairs
from ..operators.turns import render
from ..session import kept


@dataclass
class Options:
    granularity: str = "per-top"
    include_untagged: bool = False
    share: float = 0.1
    min_words: int = 32
    cap: int = 65536
    val_cap: int = 8192
    seed: int = 42
    render_fallback: bool = False
    threshold: float = 90.0
    institutions: tuple[str, ...] = ()
    system: str = "Du fasst Ausschusssitzungen zusammen."


@dataclass
class Built:
    """records: kept. rejects: dropped or moved to train. recovered: ledger rows of sittings that became whole documents."""

    records: DataFrame
    rejects: DataFrame
    summary: DataFrame
    untagged: DataFrame
    recovered: DataFrame


def paired_texts(transcripts: DataFrame, minutes: DataFrame, threshold: float) -> DataFrame:
    """(stem, k, transcript, body): each transcript with the one minutes of its key, or else the free ones most alike by name."""
    named = lambda d: d.select(F.col("stem").alias("name"), F.col("k").alias("key"), F.substring_index("k", " ", 1).alias("block")).distinct()
    pairs = fuzzy_pairs(named(transcripts), named(minutes), threshold)
    t = transcripts.select(F.col("stem").alias("name"), "stem", "k", F.col("text").alias("transcript"))
    m = minutes.select(F.col("stem").alias("partner"), "body")
    return pairs.select("name", "partner").join(t, "name").join(m, "partner").select("stem", "k", "transcript", "body")


def build(transcripts: DataFrame, minutes: DataFrame, manifest: DataFrame, exclusions: DataFrame, o: Options | None = None) -> Built:
    """transcripts, minutes: (stem, text), one row a file. exclusions: (stem, top). Held-out sittings are left out before anything is read.

    Sittings without an aligned item are rejected, or become one whole document each if asked for.
    """
    o = o or Options()
    key = canonical_key(F.col("stem"))
    t = dataset.held_out(transcripts, manifest).withColumn("k", key)
    m = dataset.held_out(minutes, manifest).withColumn("k", key)
    m = cleaning.clean_minutes(m.withColumn("text", F.regexp_replace("text", r"(?s)\A---\n.*?\n---\n", "")), institutions=o.institutions).where("body <> ''")
    # both sides are read and cleaned once
    paired = kept(paired_texts(t, kept(m.select("stem", "k", "body")), o.threshold))
    src = sections.transcript_sections(paired.select("stem", "transcript"), ["stem"], "transcript").withColumnRenamed("section", "source")
    tgt = sections.merged_sections(paired.select("stem", "body"), ["stem"], "body").withColumnRenamed("section", "target")
    both = src.join(tgt, ["stem", "top"]).join(paired.select("stem", "body"), "stem")
    item = both.select("stem", "top", F.lit("per-top").alias("strategy"), "source", "target", sections.title_of(F.col("body"), F.col("top")).alias("title"))
    shown = render(item.withColumn("_id", F.concat_ws("#", "stem", "top")), "_id", "source")
    item = item.withColumn("_id", F.concat_ws("#", "stem", "top")).join(shown, "_id").withColumn("user", dataset.user_message(F.col("title"), F.col("rendered"))).drop("_id", "rendered", "title", "source")
    item = kept(item)
    untagged = dataset.untagged_sessions(paired, item)
    if o.include_untagged or o.granularity == "document":
        whole = paired if o.granularity == "document" else paired.join(untagged, "stem", "left_semi")
        doc = whole.select("stem", F.lit(None).cast("int").alias("top"), F.lit("document-fallback").alias("strategy"), F.col("body").alias("target"), F.col("transcript").alias("user"))
        if o.render_fallback:
            doc = doc.join(render(whole.select("stem", "transcript"), "stem", "transcript"), "stem").withColumn("user", F.col("rendered")).drop("rendered")
        item = doc if o.granularity == "document" else item.unionByName(doc.select(*item.columns))
    item = item.withColumn("assistant", F.col("target")).withColumn("seq_tokens", estimated_tokens(F.concat_ws("\n", F.lit(o.system), "user", "target")))
    rows = dataset.split_with_overflow(dataset.judged(item, exclusions, o.min_words, o.cap), o.share, o.seed, o.val_cap)
    good = dataset.chat_record(rows.where("reason is null"), o.system)
    good = good.withColumn("meta", F.struct("meta.*", F.col("seq_tokens").cast("int").alias("seq_tokens")))
    numbers = good.select("stem", "split", "meta.src_tokens", "meta.tgt_tokens", "seq_tokens")
    rejects = dataset.reject_ledger(rows)
    # sittings without an aligned item are rejects, or were recovered, which the report of a build lists too
    recovered = dataset.untagged_rejects(untagged, True).where(F.lit(o.include_untagged))
    if o.granularity != "document" and not o.include_untagged:
        rejects = rejects.unionByName(dataset.untagged_rejects(untagged))
    return Built(good.select("stem", "top", "split", "messages", "meta"), rejects, dataset.summary(numbers, ["src_tokens", "tgt_tokens", "seq_tokens"]), untagged, recovered)
