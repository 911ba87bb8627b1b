"""Degeneration metrics of generated text, flags, comparison with gold and between presets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import words

# --- fixed values: leaks and counted shapes ---------------------------------------------
STAMP_LEAK = r"[\[(]\d{1,2}:\d{2}:\d{2}"
TAG_LEAK = r"<SD-[A-Z]+>"
SECTION_HEAD = r"(?im)^##\s*Zu\s+TOP\s*\d+"
VOTES = r"\d{1,3}\s+:\s+\d{1,3}\s+:\s+\d{1,3}"


def gibberish(token: Column) -> Column:
    """Over 30 characters; or at least 4 with at most two different ones or less than two fifths letters and digits."""
    n = F.length(token)
    return (n > 30) | ((n >= 4) & ((F.size(F.array_distinct(F.split(token, ""))) <= 2) | (F.length(F.regexp_replace(token, r"[^\p{L}\p{N}]", "")) < 0.4 * n)))


def longest_repeat(text: Column) -> Column:
    """Longest run of equal non-empty stripped lines; 0 without any. A fold over the lines."""
    ls = F.filter(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r"))), lambda x: x != "")
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a: Column, x: Column) -> Column:
        run = F.when(a["last"].eqNullSafe(x), a["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.aggregate(ls, start, step, lambda a: a["best"])


def metrics(text: Column) -> dict[str, Column]:
    """The counts of a text by name; gibberish as a count, to be rounded for display only."""
    toks = words(text)
    return {
        "chars": F.length(text), "words": F.size(toks), "lines": F.when(text == "", 0).otherwise(F.size(F.split(F.regexp_replace(text, r"\n\z", ""), "\n"))),
        "timestamp_leaks": F.regexp_count(text, F.lit(STAMP_LEAK)), "tag_leaks": F.regexp_count(text, F.lit(TAG_LEAK)), "max_repeat": longest_repeat(text),
        "top_sections": F.regexp_count(text, F.lit(SECTION_HEAD)), "vote_triples": F.regexp_count(text, F.lit(VOTES)), "gibberish": F.size(F.filter(toks, gibberish)),
    }


def degenerate(stamps: Column, tags: Column, repeat: Column, gib: Column, n_words: Column) -> Column:
    return (stamps > 0) | (tags > 0) | (repeat >= 3) | (gib * 10 >= F.greatest(n_words, F.lit(1)))


def gold_ratio(rows: DataFrame, gold: DataFrame, key: str) -> DataFrame:
    """Adds ``gold_words`` (1 where missing or 0) and ``ratio`` of words to it."""
    g = gold.select(key, F.col("words").alias("_g"))
    j = rows.join(g, key, "left").withColumn("gold_words", F.coalesce(F.nullif("_g", F.lit(0)), F.lit(1)))
    return j.drop("_g").withColumn("ratio", F.col("words") / F.col("gold_words"))


def preset_delta(rows: DataFrame, keys: list[str], values: list[str], base: str = "baseline", other: str = "antirep") -> DataFrame:
    """Other minus base of each value, where both presets are there; of repeated rows the last by name."""
    last = rows.groupBy(*keys, "decode").agg(*[F.max_by(v, "name").alias(v) for v in values])
    a, b = (last.where(F.col("decode") == d).select(*keys, *[F.col(v).alias(f"{v}_{s}") for v in values]) for d, s in ((base, "a"), (other, "b")))
    return a.join(b, keys).select(*keys, *[(F.col(f"{v}_b") - F.col(f"{v}_a")).alias(f"{v}_delta") for v in values])


def latest_run(names: DataFrame, name: str = "name") -> DataFrame:
    """The largest name that begins with a digit."""
    return names.where(F.col(name).rlike(r"^\d")).agg(F.max(name).alias("latest"))


def output_name(example: Column, framework: Column, granularity: Column, decode: Column) -> Column:
    return F.concat(F.concat_ws("__", example, framework, granularity, decode), F.lit(".md"))


def framework_of(adapter: Column, known: list[str], default: str = "peft") -> Column:
    out = F.lit(default)
    for k in reversed(known):
        out = F.when(adapter.startswith(k), k).otherwise(out)
    return out


def markdown_table(rows: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """(text): a report as one Markdown table, nulls as dashes. For reports, whose size is that of a listing."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in columns]), F.lit(" |"))
    g = rows.select(F.struct(*order).alias("_o"), line.alias("_l")).agg(F.array_sort(F.collect_list(F.struct("_o", "_l"))).alias("x"))
    head = f"| {' | '.join(columns)} |\n|{'---|' * len(columns)}"
    return g.select(F.concat_ws("\n", F.array(F.lit(head)), F.transform("x", lambda x: x["_l"])).alias("text"))


def comparison(rows: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """One row an output: its metrics, words against gold, and whether it degenerated. rows: keys, text; gold: key ``example``, words."""
    m = metrics(F.col("text"))
    r = rows.select(*keys, *[c.alias(k) for k, c in m.items()])
    r = gold_ratio(r, gold, "example").withColumn("degenerate", degenerate(F.col("timestamp_leaks"), F.col("tag_leaks"), F.col("max_repeat"), F.col("gibberish"), F.col("words")))
    return r.withColumn("ratio", F.round("ratio", 2))
