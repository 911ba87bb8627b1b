"""Agenda sections of transcripts and minutes: boundaries, slices, titles, merging of passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# --- fixed values: headings of the minutes, transition verbs, title stops -------------
TOP_HEADING = r"(?im)^[ \t]*#{1,6}[ \t]*zu\s+TOP\s*(\d+)\b"
DECISIONS = r"(?im)^##\s*Beschlüsse und Festlegungen"
DISCUSSION = r"(?im)^##\s*Aus der Beratung"
ATTACHMENT = r"(?im)^##\s*Anlage"
ANNOUNCED = r"(?i)\b(?:TOP|Tagesordnungspunkt)\s*(\d+)"
TRANSITION = r"(?iU)\b(rufe|aufrufen|aufzurufen|kommen|komme|beginnen|widmen|weiterverfahren|fortfahren|nächste[rns]?|eintreten|eintritt)\b"
TITLE_STOP = (
    r"(?i)^(Der |Die |Das |Herr |Frau |Vorsitzend|Stellv|Bericht\b|Minister|Staatssekret|Abgeordnet|Er |Sie |Es |Auf |"
    r"Zunächst|Eingangs|Im Anschluss|Einleitend|Anschließend)"
)
TRIM_SET = " :-–"


def rising(rows: DataFrame, keys: list[str], order: list[str], number: str) -> DataFrame:
    """Keeps the rows whose number is larger than all before it and than 0."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("_m", F.coalesce(F.max(number).over(w), F.lit(0))).where(F.col(number) > F.col("_m")).drop("_m")


def sliced(docs: DataFrame, keys: list[str], boundary: str, number: str, text: str = "text") -> DataFrame:
    """(keys, top, section): text from each kept boundary to the next.

    boundary is a pattern of no width, number finds the number at a piece's beginning. The text is cut before every boundary; a piece whose number does not rise belongs to the section
    before it; what stands before the first kept boundary is dropped. One fold a text, no shuffle.
    """
    pieces = F.split(text, boundary)
    start = F.struct(F.lit(0).alias("last"), F.array().cast("array<struct<top:int,section:string>>").alias("out"))

    def step(acc: Column, piece: Column) -> Column:
        n = F.nullif(F.regexp_extract(piece, number, 1), F.lit("")).try_cast("int")
        opens = F.coalesce(n > acc["last"], F.lit(False))
        last = F.element_at(acc["out"], -1)
        grown = F.concat(F.slice(acc["out"], F.lit(1), F.size(acc["out"]) - 1), F.array(F.struct(last["top"].alias("top"), F.concat(last["section"], piece).alias("section"))))
        new = F.concat(acc["out"], F.array(F.struct(n.alias("top"), piece.alias("section"))))
        return F.struct(F.when(opens, n).otherwise(acc["last"]).alias("last"), F.when(opens, new).when(F.size(acc["out"]) > 0, grown).otherwise(acc["out"]).alias("out"))

    out = F.aggregate(pieces, start, step, lambda a: a["out"])
    return docs.select(*keys, F.explode(out).alias("x")).select(*keys, F.col("x.top").alias("top"), F.btrim(F.col("x.section"), F.lit(" \n\t\r")).alias("section"))


def minutes_sections(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Sections of minutes at their headings only."""
    return sliced(docs, keys, r"(?im)(?=^[ \t]*#{1,6}[ \t]*zu\s+TOP\s*\d+\b)", r"(?i)\A[ \t]*#{1,6}[ \t]*zu\s+TOP\s*(\d+)\b", text)


def transcript_sections(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Sections of transcripts at agenda tags that hold a number."""
    return sliced(docs, keys, r"(?=<SD-TOP>)", r"(?s)\A<SD-TOP>[^<]*?(\d+)[^<]*</SD>", text)


def passes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``decision`` and ``discussion``: the two passes of minutes, up to the first attachment."""
    end = F.regexp_instr(text, F.lit(ATTACHMENT))
    t = F.when(end > 0, F.substring(F.col(text), F.lit(1), end - 1)).otherwise(F.col(text))
    b, r = F.regexp_instr(t, F.lit(DECISIONS)), F.regexp_instr(t, F.lit(DISCUSSION))
    decision = F.when(r > 0, F.when(b > 0, F.substring(t, b, F.greatest(r - b, F.lit(0)))).otherwise(F.substring(t, F.lit(1), r - 1))).otherwise(F.when(b > 0, F.substring(t, b, F.length(t))).otherwise(F.lit("")))
    return docs.withColumn("decision", decision).withColumn("discussion", F.when(r > 0, F.substring(t, r, F.length(t))).otherwise(F.lit("")))


def title_of(minutes: Column, top: Column) -> Column:
    """Title behind ``Zu TOP n`` (not of ``n:`` or a longer number); ``TOP n`` without one."""
    pattern = F.concat(F.lit(r"(?im)^#*\s*Zu\s+TOP\s*"), top.cast("string"), F.lit(r"(?![\d:.])\s+(.+)$"))
    t = F.call_function("regexp_extract", minutes, pattern, F.lit(1))
    t = F.btrim(F.regexp_replace(t, r"\s+", " "), F.lit(TRIM_SET))
    return F.when(t != "", t).otherwise(F.concat(F.lit("TOP "), top.cast("string")))


def heading_and_body(section: Column) -> tuple[Column, Column]:
    """(title, body) of a section. Up to three short paragraphs continue a title begun in the heading."""
    s = F.regexp_replace(section, r"^\n+", "")
    head = r"(?i)\A#{1,6}[ \t]*Zu\s+TOP\s*(\d+)[ \t]*:?[ \t]*([^\n]*)"
    has = s.rlike(head)
    inline = F.trim(F.regexp_extract(s, head, 2))
    rest = F.regexp_replace(F.regexp_replace(s, head, ""), r"^\n+", "")
    paras = F.split(rest, r"\n\s*\n")

    def goes_on(p: Column, i: Column) -> Column:
        x = F.btrim(p, F.lit(" \n\t"))
        return (i < 3) & (x != "") & (F.length(x) <= 120) & ~x.startswith("#") & ~x.rlike(r"[.!?]$") & ~x.rlike(TITLE_STOP)

    flags = F.transform(paras, goes_on)
    n = F.when(inline == "", 0).otherwise(F.coalesce(F.nullif(F.array_position(flags, F.lit(False)), F.lit(0)) - 1, F.size(paras))).cast("int")
    title = F.concat_ws(" ", F.array(inline), F.slice(paras, F.lit(1), n))
    title = F.btrim(F.regexp_replace(title, r"\s+", " "), F.lit(TRIM_SET))
    body = F.btrim(F.array_join(F.slice(paras, n + 1, F.greatest(F.size(paras) - n, F.lit(0))), "\n\n"), F.lit(" \n\t"))
    return F.when(has, title).otherwise(F.lit("")), F.when(has, body).otherwise(F.btrim(section, F.lit(" \n\t")))


def canonical(rows: DataFrame) -> DataFrame:
    """Adds ``section``: one heading, the decision, and the discussion behind a separator if both exist. Expects top, decision, discussion."""
    (bt, bb), (rt, rb) = (heading_and_body(F.coalesce(c, F.lit(""))) for c in ("decision", "discussion"))
    title = F.when(rt != "", rt).otherwise(bt)
    head = F.rtrim(F.concat(F.lit("## Zu TOP "), F.col("top").cast("string"), F.lit(":"), F.when(title != "", F.concat(F.lit(" "), title)).otherwise(F.lit(""))))
    tail = F.when(rb != "", F.when(bb != "", F.concat(F.lit("Aus der Beratung\n\n"), rb)).otherwise(rb))
    return rows.withColumn("section", F.concat_ws("\n\n", head, F.nullif(bb, F.lit("")), tail))


def merged_sections(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, top, section): both passes split on their own and merged by number; without either heading, one pass over all."""
    p = passes(docs.select(*keys, F.col(text).alias("text")))
    two = p.where("decision <> '' or discussion <> ''")
    one = p.where("decision = '' and discussion = ''")
    dec = minutes_sections(two, keys, "decision").withColumnRenamed("section", "decision")
    dis = minutes_sections(two, keys, "discussion").withColumnRenamed("section", "discussion")
    both = dec.join(dis, [*keys, "top"], "full").select(*keys, "top", "decision", "discussion")
    single = minutes_sections(one, keys).select(*keys, "top", F.lit("").alias("decision"), F.col("section").alias("discussion"))
    return canonical(both.unionByName(single)).select(*keys, "top", "section")


def announced(turns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, turn_ix, top): item numbers announced behind a transition verb, rising over turns and places."""
    t = turns.where(F.col("text").rlike(TRANSITION)).select(*keys, "turn_ix", F.posexplode(F.regexp_extract_all("text", F.lit(ANNOUNCED), F.lit(1))).alias("k", "n"))
    return rising(t.select(*keys, "turn_ix", "k", F.col("n").try_cast("int").alias("top")), keys, ["turn_ix", "k"], "top").drop("k")


def placed(tags: DataFrame, turns: DataFrame, keys: list[str], keep_ties: bool = False) -> DataFrame:
    """Agenda tags (keys, top, turn_ix) that can be inserted: in agenda order, with rising turns (ties lose unless kept), none beyond the last turn."""
    last = turns.groupBy(*keys).agg(F.max("turn_ix").alias("_last"))
    t = tags.join(last, keys).where("turn_ix between 0 and _last").drop("_last")
    w = W.partitionBy(*keys).orderBy("top").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.max("turn_ix").over(w), F.lit(-1))
    return t.withColumn("_b", before).where(F.col("turn_ix") >= F.col("_b") if keep_ties else F.col("turn_ix") > F.col("_b")).drop("_b")
