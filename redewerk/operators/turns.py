"""Speaker-tagged transcripts: lines, turns, rendering, islands and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# --- fixed values: the markup of transcripts --------------------------------------
SPEAKER_TAG = r"^\s*<SD-SPK>\s*(.*?)\s*</SD>"
TOP_TAG = r"(?s)<SD-TOP>.*?</SD>"
TOP_NUMBER = r"<SD-TOP>.*?(\d+).*?</SD>"
SEGMENT_LINE = r"^\[[0-9:.]+ --> [0-9:.]+\]\s*(.*)$"
LEADING_STAMP = r"^\[\d{2}:\d{2}:\d{2}(?:\.\d+)?\s*-->\s*\d{2}:\d{2}:\d{2}(?:\.\d+)?\]\s*"
FRONT_MATTER = r"(?s)\A---\n.*?\n---\n"


def lines(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """One row a line with its position ``pos``. Null texts give none."""
    return docs.select(*keys, F.posexplode(F.split(F.col(text), r"\r?\n")).alias("pos", "line"))


def parse_turns(docs: DataFrame, key: str = "stem", text: str = "text") -> DataFrame:
    """(key, turn_ix, label, lines, text, top): turns opened by speaker tags.

    Text is what stands behind stamps, joined by one blank; other lines stay in ``lines`` only.
    top is the number of the last agenda tag before the turn. Lines before the first tag are no turn.
    """
    ln = lines(docs.withColumn(text, F.regexp_replace(text, FRONT_MATTER, "")), [key], text)
    w = W.partitionBy(key).orderBy("pos")
    tag = F.regexp_extract(F.trim("line"), SPEAKER_TAG, 1)
    is_tag = F.trim("line").rlike(SPEAKER_TAG)
    number = F.when(F.col("line").rlike(TOP_NUMBER), F.regexp_extract("line", TOP_NUMBER, 1).cast("int"))
    ln = ln.select(key, "pos", "line", is_tag.alias("is_tag"), tag.alias("label"), number.alias("n"))
    ln = ln.withColumn("turn_ix", F.sum(F.col("is_tag").cast("int")).over(w)).withColumn("top", F.last("n", ignorenulls=True).over(w))
    said = F.trim(F.regexp_extract(F.trim("line"), SEGMENT_LINE, 1))
    g = ln.where("turn_ix > 0").groupBy(key, "turn_ix").agg(
        F.max(F.when(F.col("is_tag"), F.col("label"))).alias("label"),
        F.array_sort(F.collect_list(F.when(~F.col("is_tag"), F.struct("pos", "line", said.alias("said"))))).alias("ls"),
        F.max(F.when(F.col("is_tag"), F.coalesce("top", F.lit(-1)))).alias("top"),
    )
    return g.select(
        key, F.col("turn_ix").cast("int").alias("turn_ix"), "label", F.transform("ls", lambda x: x["line"]).alias("lines"),
        F.array_join(F.filter(F.transform("ls", lambda x: x["said"]), lambda s: s != ""), " ").alias("text"),
        F.nullif("top", F.lit(-1)).alias("top"),
    )


def render(docs: DataFrame, key: str = "stem", text: str = "text") -> DataFrame:
    """(key, rendered): ``Name: text`` lines, consecutive speech of one speaker merged; untagged beginnings have no name.

    A fold over the lines of each text, with no shuffle.
    """
    ls = F.split(F.regexp_replace(text, TOP_TAG, ""), r"\r?\n")
    start = F.struct(F.lit("").alias("speaker"), F.lit(None).cast("string").alias("last"), F.lit("").alias("out"))

    def step(acc: Column, raw: Column) -> Column:
        line = F.trim(raw)
        is_tag = line.rlike(SPEAKER_TAG)
        said = F.trim(F.regexp_replace(line, LEADING_STAMP, ""))
        skip = (line == "") | (~is_tag & (said == ""))
        same = acc["last"].eqNullSafe(acc["speaker"])
        named = F.when(acc["speaker"] != "", F.concat(acc["speaker"], F.lit(": "), said)).otherwise(said)
        grown = F.when(same, F.concat(acc["out"], F.lit(" "), said)).when(acc["last"].isNull(), named).otherwise(F.concat(acc["out"], F.lit("\n"), named))
        return F.struct(
            F.when(is_tag, F.regexp_extract(line, SPEAKER_TAG, 1)).otherwise(acc["speaker"]).alias("speaker"),
            F.when(skip | is_tag, acc["last"]).otherwise(acc["speaker"]).alias("last"),
            F.when(skip | is_tag, acc["out"]).otherwise(grown).alias("out"),
        )

    return docs.select(key, F.aggregate(ls, start, step, lambda a: a["out"]).alias("rendered"))


def islands(rows: DataFrame, part: list[str], order: str, value: str) -> DataFrame:
    """Adds ``island``: numbers the runs of equal (null-safe) values in order."""
    w = W.partitionBy(*part).orderBy(order)
    new = (~F.col(value).eqNullSafe(F.lag(value).over(w))) | F.lag(F.lit(1)).over(w).isNull()
    return rows.withColumn("island", F.sum(new.cast("int")).over(w).cast("int"))


def carried(rows: DataFrame, part: list[str], order: str, value: str, name: str) -> DataFrame:
    """Adds ``name``: the last known value up to the row."""
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(W.partitionBy(*part).orderBy(order).rowsBetween(W.unboundedPreceding, 0)))


def speaker_groups(rows: DataFrame, part: list[str], order: str = "ord") -> DataFrame:
    """(part, island, speaker, start, end, segments): consecutive segments of one speaker. Groups without any text are dropped after grouping."""
    g = islands(rows, part, order, "speaker").groupBy(*part, "island")
    g = g.agg(F.first("speaker").alias("speaker"), F.min("start").alias("start"), F.max("end").alias("end"), F.array_sort(F.collect_list(F.struct(order, "start", "end", "text"))).alias("segments"))
    return g.where(F.exists("segments", lambda s: F.trim(s["text"]) != ""))


def placeholders(docs: DataFrame, names: list[str], key: str = "stem", text: str = "text") -> DataFrame:
    """(key, text, labels): every numbered label replaced by an invented name, in order of first appearance. The longest labels go first, so SPEAKER_1 leaves SPEAKER_10 alone."""
    table = F.array(*[F.lit(n) for n in names])
    labels = F.array_distinct(F.regexp_extract_all(text, F.lit(r"SPEAKER_\d+"), F.lit(0)))
    pairs = F.transform(labels, lambda x, i: F.struct((-F.length(x)).alias("len"), x.alias("label"), F.get(table, F.pmod(i, F.lit(len(names)))).alias("name")))
    out = F.aggregate(F.array_sort(pairs), F.col(text), lambda t, p: F.replace(t, p["label"], p["name"]))
    return docs.select(key, out.alias("text"), F.transform(pairs, lambda p: F.struct(p["label"].alias("label"), p["name"].alias("name"))).alias("labels"))


def relabelled(docs: DataFrame, mapping: DataFrame, key: str = "stem", text: str = "text") -> DataFrame:
    """(key, text): speaker tags whose label is in ``mapping`` (key, label, name) get the name; other lines stay."""
    m = mapping.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("label", "name"))).alias("names"))
    d = docs.select(key, F.col(text).alias("_t")).join(m, key, "left")
    new = F.transform(
        F.split("_t", "\n"),
        lambda x: F.coalesce(F.when(F.trim(x).rlike(SPEAKER_TAG), F.concat(F.lit("<SD-SPK>"), F.element_at("names", F.regexp_extract(F.trim(x), SPEAKER_TAG, 1)), F.lit("</SD>"))), x),
    )
    return d.select(key, F.when(F.col("names").isNull(), F.col("_t")).otherwise(F.array_join(new, "\n")).alias(text))
