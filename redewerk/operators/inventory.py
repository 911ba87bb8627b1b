"""Files of sittings: names, stems, staging, the ledger and its differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import kept

# --- fixed values: shapes of file and folder names ------------------------------------
DROP_NAME = r"(?i)^(\d+)\s*\.\s*([A-Za-zÄÖÜäöüß]+)\s+(?:vom|am)\s+(\d{2})\.(\d{2})\.(\d{4})(?:\s+Teil\s+(\d+))?(?:\s+\((\d+)\))?(?:-(\d+))?\s*\.(mp3|pdf)$"
PERIOD_PREFIX = r"(?i)^\s*0?\d{1,2}\s*\.?\s*WP\b\.?\s*"
PERIOD_DIR = r"(?i)^\s*0?(\d{1,2})\s*\.?\s*WP\s*$"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def drop_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds sitting, abbr, date, part, dup, ext read from the file name; all null where it has another shape."""
    name = file_name(F.col(path))
    g = lambda i: F.nullif(F.regexp_extract(name, DROP_NAME, i), F.lit(""))
    day = F.concat_ws("-", g(5), g(4), g(3))
    ok = name.rlike(DROP_NAME)
    return files.withColumns(
        {
            "sitting": g(1).try_cast("int"), "abbr": F.upper(g(2)), "date": F.when(ok, day), "part": F.coalesce(g(6), g(8)).try_cast("int"),
            "dup": g(7).try_cast("int"), "ext": F.lower(g(9)),
        }
    )


def period_of(date: Column, last_year: int = 2024, before: str = "7", after: str = "8") -> Column:
    """The electoral period by the year of an ISO date."""
    return F.when(F.substring(date, 1, 4).try_cast("int") <= last_year, before).otherwise(after)


def drop_sessions(parts: DataFrame) -> DataFrame:
    """(abbr, sitting, date, n_pdf, n_audio, pdfs, audios, pdf_sizes): files grouped to sittings; lists in the order part, copy, name. Unreadable names are left out."""
    order = F.struct(F.coalesce("part", F.lit(0)).alias("part"), F.coalesce("dup", F.lit(0)).alias("dup"), "path")
    of = lambda ext: F.transform(F.array_sort(F.collect_list(F.when(F.col("ext") == ext, order))), lambda x: x["path"])
    return parts.where("sitting is not null").groupBy("abbr", "sitting", "date").agg(
        F.count_if(F.col("ext") == "pdf").alias("n_pdf"), F.count_if(F.col("ext") == "mp3").alias("n_audio"), of("pdf").alias("pdfs"), of("mp3").alias("audios"),
        F.count_distinct(F.when(F.col("ext") == "pdf", F.col("length"))).alias("pdf_sizes"), F.count_if((F.col("ext") == "mp3") & F.col("dup").isNotNull()).alias("n_dup"),
    )


def import_flags(s: DataFrame) -> DataFrame:
    """Adds ``flags`` of an import: missing, several or repeated files; OK without any."""
    f = [
        F.when(F.col("n_pdf") == 0, "MISSING_PDF"), F.when(F.col("n_audio") == 0, "MISSING_AUDIO"),
        F.when(F.col("n_audio") > 1, F.concat(F.lit("MULTIPART("), F.col("n_audio").cast("string"), F.lit(")"))),
        F.when(F.col("n_dup") > 0, "DUP_AS_MULTIPART"),
        F.when((F.col("n_pdf") > 1) & (F.col("pdf_sizes") == 1), "DUP_PDF_SAME").when(F.col("n_pdf") > 1, "MULTI_PDF_DIFFER"),
    ]
    return s.withColumn("flags", F.coalesce(F.nullif(F.concat_ws(";", *f), F.lit("")), F.lit("OK")))


def stem_fields(rows: DataFrame, path: str = "raw_dir") -> DataFrame:
    """Adds abbr, wp, sitting, stem read from ``Committee/[N. WP/]Session``; ``x`` for a sitting without number."""
    parts = F.split(F.col(path), "/")
    top, last = F.get(parts, F.lit(0)), F.element_at(parts, -1)
    inside = F.regexp_extract(top, r"\(([^)]*)\)", 1)
    abbr = F.regexp_replace(F.when(top.rlike(r"\([^)]*\)"), F.get(F.split(inside, r"[,/;]"), F.lit(0))).otherwise(top), r"\s+", "")
    wp = F.regexp_extract(F.get(F.filter(parts, lambda p: p.rlike(PERIOD_DIR)), F.lit(0)), PERIOD_DIR, 1)
    sitting = F.nullif(F.regexp_extract(F.regexp_replace(last, PERIOD_PREFIX, ""), r"(\d+)", 1), F.lit(""))
    rows = rows.withColumns({"d_abbr": abbr, "d_wp": F.nullif(wp, F.lit("")), "d_sitting": sitting.try_cast("int")})
    return rows.withColumn("d_stem", F.concat_ws("_", "d_abbr", "d_wp", F.coalesce(F.col("d_sitting").cast("string"), F.lit("x"))))


def picked_protocol(files: DataFrame, keys: list[str], path: str = "path") -> DataFrame:
    """(keys, pdf_src): a full protocol before others before an attachment, then by name."""
    name = F.lower(file_name(F.col(path)))
    rank = F.when(name.contains("gesamt") | name.contains("protokoll"), 0).when(name.contains("anlage"), 1).otherwise(2)
    return files.where(F.lower(path).endswith(".pdf")).groupBy(*keys).agg(F.min_by(path, F.struct(rank, file_name(F.col(path)))).alias("pdf_src"))


def numbered_parts(files: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds ``part_no`` and the label ``ptNN`` in order."""
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return files.withColumn("part_no", rn).withColumn("part_label", F.concat(F.lit("pt"), F.lpad(F.col("part_no").cast("string"), 2, "0")))


def first_wins(rows: DataFrame, stem: str, order: str) -> DataFrame:
    """Adds ``collides_with``: for all but the first row of a stem the first one's ``order`` value."""
    w = W.partitionBy(stem).orderBy(order)
    return rows.withColumn("collides_with", F.when(F.row_number().over(w) > 1, F.first(order).over(w)))


def committee_index(folders: DataFrame, name: str = "name") -> DataFrame:
    """(code, folder): every code in the parentheses of a folder name (all of it without any), upper case; the first folder wins."""
    inside = F.regexp_extract(name, r"\(([^)]*)\)", 1)
    codes = F.when(F.col(name).rlike(r"\([^)]*\)"), F.split(inside, r"[,/;]")).otherwise(F.array(F.col(name)))
    c = folders.select(F.col(name).alias("folder"), F.explode(codes).alias("code")).select("folder", F.upper(F.regexp_replace("code", r"\s+", "")).alias("code"))
    return c.where("code <> ''").groupBy("code").agg(F.min("folder").alias("folder"))


def trainable(sessions: DataFrame) -> DataFrame:
    """Sittings with minutes and at least one recording."""
    return sessions.where(F.col("pdf_src").isNotNull() & (F.size(F.coalesce("audio_src", F.array().cast("array<string>"))) > 0))


def ledger_diff(old: DataFrame, new: DataFrame, signature: list[str], prune: bool = False) -> DataFrame:
    """(stem, state, first_seen, last_seen): NEW, UNCHANGED, CHANGED or MISSING by stem; repeated stems of the new side DUPLICATE but for the first.

    first_seen of a known sitting stays, last_seen is the new one. Missing sittings stay unless pruned.
    """
    w = W.partitionBy("stem").orderBy("first_seen", *signature)
    n = new.withColumn("_rn", F.row_number().over(w))
    dup = n.where("_rn > 1").select("stem", F.lit("DUPLICATE").alias("state"), "first_seen", "last_seen")
    n, o = n.where("_rn = 1").drop("_rn"), old
    j = o.select(F.col("stem").alias("_os"), F.struct(*signature).alias("_old"), F.col("first_seen").alias("_f"), F.col("last_seen").alias("_l")).join(
        n.select(F.col("stem").alias("_ns"), F.struct(*signature).alias("_new"), "first_seen", "last_seen"), F.col("_os") == F.col("_ns"), "full"
    )
    state = F.when(F.col("_os").isNull(), "NEW").when(F.col("_ns").isNull(), "MISSING").when(F.col("_old").eqNullSafe(F.col("_new")), "UNCHANGED").otherwise("CHANGED")
    out = j.select(F.coalesce("_ns", "_os").alias("stem"), state.alias("state"), F.coalesce("_f", "first_seen").alias("first_seen"), F.when(F.col("_ns").isNull(), F.col("_l")).otherwise(F.col("last_seen")).alias("last_seen"))
    return (out.where("state <> 'MISSING'") if prune else out).unionByName(dup)


def ingest_report(rows: DataFrame) -> DataFrame:
    """The ten columns of the ingest report from stem, committee, wp, sitting, pdf_src, audio_src, state, collides_with; dashes for nulls."""
    n_audio = F.size(F.coalesce("audio_src", F.array().cast("array<string>")))
    flags = F.concat_ws(
        ";", F.when(F.col("sitting").isNull(), "NO_SITTING_NUM"), F.when(F.col("collides_with").isNotNull(), F.concat(F.lit("COLLISION_WITH("), "collides_with", F.lit(")"))),
        F.when(F.col("pdf_src").isNull(), "MISSING_PDF"), F.when(n_audio == 0, "MISSING_AUDIO"), F.when(n_audio > 1, F.concat(F.lit("MULTIPART("), n_audio.cast("string"), F.lit(")"))),
    )
    dash = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    return rows.select(
        "stem", "committee", dash("wp").alias("wp"), dash("sitting").alias("sitting"), F.col("pdf_src").isNotNull().cast("bigint").alias("n_pdf"), n_audio.cast("bigint").alias("n_audio"),
        F.coalesce(F.nullif(flags, F.lit("")), F.lit("OK")).alias("flags"), "state", dash("pdf_src").alias("pdf_src"), F.coalesce(F.nullif(F.array_join("audio_src", ";"), F.lit("")), F.lit("-")).alias("audio_src"),
    )


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``position`` (from 0) in order. Range partitions count on their own; only their sizes pass through the driver."""
    spark = rows.sparkSession
    line = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    # kept, so that both passes see the same ranges
    line = kept(line)
    at, before = 0, []
    for r in line.groupBy("_p").count().orderBy("_p").collect():
        before.append((r["_p"], at))
        at += r["count"]
    starts = spark.createDataFrame(before, "_p int, _b bigint")
    return line.join(F.broadcast(starts), "_p").withColumn("position", F.col("_b") + F.col("_m")).drop("_p", "_m", "_b")


def shards(rows: DataFrame, order: str, n: int) -> DataFrame:
    """Adds ``shard``: the position in order modulo n."""
    return positions(rows, [order]).withColumn("shard", F.pmod("position", F.lit(n)).cast("int")).drop("position")
