"""Candidates to chat records: messages, filters with reasons, pinned split, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import canonical_key, pinned_split, word_count

# --- fixed values: the frame of the user message, and the order of the reasons --------------
FRAME = ("Erstelle eine Zusammenfassung für folgenden Tagesordnungspunkt:\n\nTOP: ", "\n\nTranskript:\n", "\n\nZusammenfassung:")
REASONS = ["speaker-excluded", "short-target", "over-cap", "no-aligned-tops", "val-overflow"]


def user_message(title: Column, transcript: Column) -> Column:
    return F.concat(F.lit(FRAME[0]), title, F.lit(FRAME[1]), transcript, F.lit(FRAME[2]))


def chat_record(rows: DataFrame, system: str) -> DataFrame:
    """Adds ``messages`` and ``meta`` to rows with stem, top, strategy, user, assistant. Counts are of words."""
    msg = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    rows = rows.withColumn("messages", F.array(msg("system", F.lit(system)), msg("user", F.col("user")), msg("assistant", F.col("assistant"))))
    return rows.withColumn("meta", F.struct("stem", "top", "strategy", word_count(F.col("user")).alias("src_tokens"), word_count(F.col("assistant")).alias("tgt_tokens")))


def folded_chat(messages: Column) -> tuple[Column, Column]:
    """(prompt, answer): system and user contents with a blank line between, and the assistant's; joined within a role."""
    text = lambda role: F.array_join(F.transform(F.filter(messages, lambda m: F.lower(m["role"]) == role), lambda m: F.coalesce(m["content"], F.lit(""))), "")
    return F.btrim(F.concat(text("system"), F.lit("\n\n"), text("user")), F.lit(" \n\t\r")), text("assistant")


def training_text(rendered: Column, bos: str = "<bos>") -> Column:
    """A rendered chat without one leading begin mark."""
    return F.when(rendered.startswith(bos), F.substring(rendered, F.lit(len(bos) + 1), F.length(rendered))).otherwise(rendered)


def held_out(rows: DataFrame, manifest: DataFrame, stem: str = "stem") -> DataFrame:
    """Rows whose sitting is not listed, in whatever spelling."""
    named = manifest.where("stem is not null").select(canonical_key(F.col("stem")).alias("_k")).distinct()
    return rows.withColumn("_k", canonical_key(F.col(stem))).join(named, "_k", "left_anti").drop("_k")


def exclusion_rows(exclusions: DataFrame) -> DataFrame:
    """(stem, top) of a map of arrays; entries that are no number don't exclude items."""
    return exclusions.select("stem", F.explode("tops").alias("t")).select("stem", F.col("t").try_cast("int").alias("top")).where("top is not null").distinct()


def judged(candidates: DataFrame, exclusions: DataFrame, min_words: int = 32, cap: int = 65536) -> DataFrame:
    """Adds ``reason``: null for kept candidates (stem, top, target, seq_tokens), else the first of excluded speaker, short target, over the cap. A target of exactly the least words and a sequence of exactly the cap are kept."""
    ex = exclusions.select("stem", "top", F.lit(1).alias("_ex")).distinct()
    c = candidates.join(ex, ["stem", "top"], "left")
    reason = F.when(F.col("_ex") == 1, REASONS[0]).when(word_count(F.coalesce("target", F.lit(""))) < min_words, REASONS[1]).when(F.col("seq_tokens") > cap, REASONS[2])
    return c.withColumn("reason", reason).drop("_ex")


def split_with_overflow(kept: DataFrame, share: float = 0.1, seed: int = 42, val_cap: int = 8192) -> DataFrame:
    """Adds ``split``; a validation record above its cap goes to train (cap 0: never)."""
    own = pinned_split(canonical_key(F.col("stem")), share, seed)
    over = (F.lit(val_cap) > 0) & (F.col("seq_tokens") > val_cap)
    return kept.withColumn("overflow", (own == "val") & F.coalesce(over, F.lit(False))).withColumn("split", F.when(F.col("overflow"), "train").otherwise(own))


def reject_ledger(rows: DataFrame) -> DataFrame:
    """(stem, top, reason, seq_tokens, disposition), all strings, of judged and split rows."""
    why = F.coalesce("reason", F.when(F.col("overflow"), REASONS[4]))
    return rows.withColumn("reason", why).where("reason is not null").select(
        "stem", F.coalesce(F.col("top").cast("string"), F.lit("document")).alias("top"), "reason", F.coalesce(F.col("seq_tokens").cast("string"), F.lit("-")).alias("seq_tokens"),
        F.when(F.col("reason") == REASONS[4], "rerouted").otherwise("dropped").alias("disposition"),
    )


def untagged_rejects(untagged: DataFrame, recovered: bool = False) -> DataFrame:
    """Rows of the reject ledger for sittings without an aligned item: dropped, or recovered as whole documents."""
    return untagged.select("stem", F.lit("*").alias("top"), F.lit(REASONS[3]).alias("reason"), F.lit("-").alias("seq_tokens"), F.lit("recovered" if recovered else "dropped").alias("disposition"))


def held_out_manifest(examples: DataFrame, note: str) -> DataFrame:
    """The nine columns of the held-out list from (example, stem, source, transcript, minutes): counts of the tagged transcript, and the words of its cleaned minutes."""
    from ..functions.text import words

    tags = F.regexp_extract_all("transcript", F.lit(r"<SD-SPK>([^<]*)</SD>"), F.lit(1))
    return examples.select(
        "example", "stem", "source", F.regexp_count("transcript", F.lit("<SD-TOP>")).alias("tops"), F.size(F.array_distinct(tags)).alias("speakers"),
        F.size(F.array_distinct(F.regexp_extract_all("transcript", F.lit(r"(SPEAKER_\d+)"), F.lit(1)))).alias("invented_speakers"), F.size(words(F.col("transcript"))).alias("transcript_words"), F.size(words(F.col("minutes"))).alias("gold_words"),
        F.lit(note).alias("split_note"),
    )


def only(rows: DataFrame, part: str | None, column: str = "example") -> DataFrame:
    """Rows whose name holds a text; all without one."""
    return rows.where(F.col(column).contains(part)) if part else rows


def ledger_order(ledger: DataFrame) -> DataFrame:
    """By reason in fixed order, stem, and item as text (10 before 2)."""
    rank = F.array_position(F.array(*[F.lit(r) for r in REASONS]), F.col("reason"))
    return ledger.orderBy(rank, "stem", "top")


def reject_tally(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("reason").agg(F.count("*").alias("n"))


def merged_exclusions(speaker: DataFrame, length: DataFrame) -> DataFrame:
    """(stem, tops array<string>) of both sets: numbers in order, then words."""
    u = speaker.select("stem", F.col("top").cast("string").alias("top")).union(length.select("stem", F.col("top").cast("string"))).distinct()
    key = F.struct(F.col("top").try_cast("int").isNull().alias("word"), F.coalesce(F.col("top").try_cast("int"), F.lit(0)).alias("n"), "top")
    return u.groupBy("stem").agg(F.array_sort(F.collect_list(key)).alias("ts")).select("stem", F.transform("ts", lambda t: t["top"]).alias("tops"))


def summary(kept: DataFrame, columns: list[str]) -> DataFrame:
    """(split, sessions, records, and least, upper median and largest of each column)."""
    aggs = [F.count_distinct("stem").alias("sessions"), F.count("*").alias("records")]
    for c in columns:
        # counts by value: the median needs no list of all values
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    base = kept.groupBy("split").agg(*aggs)
    for c in columns:
        base = base.join(upper_median(kept, ["split"], c).withColumnRenamed("median", f"{c}_median"), "split", "left")
    return base


def upper_median(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, median): of an even number of values the larger middle one. Runs over the counts of distinct values."""
    from pyspark.sql import Window as W

    n = rows.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("n"))
    w = W.partitionBy(*keys)
    upto = F.sum("n").over(w.orderBy(column).rowsBetween(W.unboundedPreceding, 0))
    n = n.withColumn("upto", upto).withColumn("all", F.sum("n").over(w))
    return n.where(F.col("upto") > F.floor(F.col("all") / 2)).groupBy(*keys).agg(F.min(column).alias("median"))


def untagged_sessions(candidates: DataFrame, aligned: DataFrame) -> DataFrame:
    """Sessions without an aligned item, distinct, by name."""
    return candidates.select("stem").distinct().join(aligned.select("stem").distinct(), "stem", "left_anti").orderBy("stem")
