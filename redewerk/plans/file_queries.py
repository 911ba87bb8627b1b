"""Queries of sources and sinks: what is written to the shared folder is read back and must be what the tables hold."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .. import schemas
from ..operators import providers
from ..sources import files, sinks
from . import queries as Q
from .queries import query


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder the session names for shared files; one of this machine only where it names none, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="redewerk-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root}/{name}-{uuid.uuid4().hex}"


_TEXTS = "(select doc_id, text from documents where text is not null and trim(text, ' ' || chr(10) || chr(9) || chr(13)) <> '')"


def _texts(t):
    return t("documents").where(F.col("text").isNotNull() & (F.btrim("text", F.lit(" \n\t\r")) != "")).select("doc_id", "text")


def _files(t):
    """A folder with one Markdown file a document, with a header of its number, in sub-folders by the last digit."""
    d = _texts(t)
    at = folder(d.sparkSession, "markdown")
    body = sinks.with_front_matter({"doc": F.col("doc_id"), "art": F.lit("Beleg: eins")}, F.col("text"))
    rows = d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".MD")).alias("name"), body.alias("text"))
    sinks.write_files(rows, at).write.format("noop").mode("overwrite").save()
    return d.sparkSession, at


@query("doc:s text:s art:s", f"select doc_id::varchar as doc, text, 'Beleg: eins' as art from {_TEXTS}")
def markdown_files(t):
    """Documents as files with a header, read back whole."""
    spark, at = _files(t)
    w = files.whole_texts(spark, at).withColumn("h", files.front_matter(F.col("text")))
    return w.select(F.col("h")["doc"].alias("doc"), files.without_front_matter(F.col("text")).alias("text"), F.col("h")["art"].alias("art"))


@query("name:s length:i", f"select 'd' || doc_id || '.MD' as name, octet_length(encode('---' || chr(10) || 'doc: ' || doc_id || chr(10) || 'art: Beleg: eins' || chr(10) || '---' || chr(10) || text)) as length from {_TEXTS}")
def file_listing(t):
    """The files of a folder by suffix, in any case."""
    spark, at = _files(t)
    return files.listing(spark, at, [".md"]).select(F.element_at(F.split("path", "/"), -1).alias("name"), "length")


@query("name:s size:i", f"select 'd' || doc_id || '.MD' as name, length(trim(replace(text, '&', ''), ' ')) as size from {_TEXTS}")
def converted_files(t):
    """Files run through a converter of bytes to text; too short ones fail."""
    spark, at = _files(t)
    raw = spark.read.format("binaryFile").load(at).select("path", "content")
    done = providers.converted(raw, least=1)
    text = F.regexp_replace(files.without_front_matter(F.col("value")), "&", "")
    return done.where("error is null").select(F.element_at(F.split("path", "/"), -1).alias("name"), F.length(F.trim(text)).alias("size"))


@query("raw_dir:s pdfs:i audios:i", r"select regexp_replace(path, '/[^/]*$', '') as raw_dir, count(*) filter (lower(path) like '%.pdf') as pdfs, count(*) filter (lower(path) like '%.mp3') as audios from " + Q.FILES + r" where contains(path, '/') and regexp_matches(lower(path), '\.(mp3|pdf)$') group by 1")
def session_discovery(t):
    """Folders that hold a recording or minutes."""
    f = Q.drop_files(t).where(F.col("path").contains("/")).select(F.concat(F.lit("/wurzel/daten/"), "path").alias("path"))
    return files.sessions(f, "daten").select("raw_dir", F.size("pdfs").alias("pdfs"), F.size("audios").alias("audios"))


@query("path:s", "select distinct path from " + Q.FILES)
def path_list(t):
    f = Q.drop_files(t).select("path").distinct()
    at = folder(f.sparkSession, "list")
    f.select(F.concat(F.lit("# Kommentar\n\n  "), "path", F.lit("  ")).alias("value")).write.text(at)
    return files.path_list(f.sparkSession, at)


@query("stem:s", "select distinct stem from manifest where trim(stem) <> '' union select 'X_9_9'")
def holdout_file(t):
    m = t("manifest").select("example", "stem", "source")
    at = folder(m.sparkSession, "manifest")
    sinks.write_tsv(m.where("stem is not null"), at, ["example"])
    return files.manifest(m.sparkSession, at, ["X_9_9"])


@query("stem:s tops:s", "select stem, string_agg(x, ',' order by x) as tops from (select distinct stem, coalesce(top::varchar, 'document') as x from " + Q.REC + " where stem is not null) group by stem")
def exclusions_file(t):
    r = Q.records(t).where("stem is not null").select("stem", F.coalesce(F.col("top").cast("string"), F.lit("document")).alias("top")).distinct()
    at = folder(r.sparkSession, "exclusions")
    g = r.groupBy("stem").agg(F.array_sort(F.collect_list("top")).alias("tops"))
    g.select(F.to_json(F.map_from_arrays(F.array("stem"), F.array("tops"))).alias("value")).write.text(at)
    lines = g.sparkSession.read.text(at)
    one = folder(r.sparkSession, "exclusions")
    # one file with one map, as it is kept by hand
    lines.agg(F.concat(F.lit("{"), F.array_join(F.transform(F.collect_list("value"), lambda v: F.substring(v, F.lit(2), F.length(v) - 2)), ","), F.lit("}")).alias("value")).write.text(one)
    return files.exclusions(r.sparkSession, one).select("stem", F.array_join("tops", ",").alias("tops"))


@query("stem:s committee:s sitting:i n_audio:i", f"select stem, min(committee) as committee, min(sitting) as sitting, min(len(audio_src)) as n_audio from {Q.LED} group by stem")
def ledger_file(t):
    led = Q.ledger(t).groupBy("stem").agg(F.min("committee").alias("committee"), F.min("sitting").alias("sitting"), F.min(F.size("audio_src")).alias("n"))
    led = led.select("stem", "committee", "sitting", F.transform(F.sequence(F.lit(1), F.greatest("n", F.lit(1))), lambda i: i.cast("string")).alias("a"), "n")
    led = led.withColumn("audio_src", F.slice("a", F.lit(1), F.greatest("n", F.lit(0)))).drop("a", "n")
    at = folder(led.sparkSession, "ledger")
    entry = F.struct(F.col("stem").alias("k"), F.struct("stem", "committee", "sitting", "audio_src").alias("v"))
    led.agg(F.map_from_entries(F.collect_list(entry)).alias("sessions")).select(F.to_json(F.struct(F.lit(1).alias("version"), "sessions")).alias("value")).write.text(at)
    return files.ledger(led.sparkSession, at).select("stem", "committee", "sitting", F.size("audio_src").alias("n_audio"))


@query("place:i example:s gold:s", """select row_number() over (order by length, example) - 1 as place, example, gold from (select example, min(transcript_words) as length, case when min(coalesce(gold_words, 0)) > 1000 then '/e/' || example || '/b_Protokoll.md' end as gold
 from manifest where transcript_words is not null group by example)""")
def example_discovery(t):
    """Evaluation examples with a transcript, the shortest first."""
    m = t("manifest").groupBy("example").agg(F.min("transcript_words").alias("n"), F.min(F.coalesce("gold_words", F.lit(0))).alias("g"))
    path = lambda x: F.concat(F.lit("/e/"), "example", F.lit(x))
    rows = m.where("n is not null").select(path("/a_Transkript.md").alias("path"), F.col("n").alias("length"))
    rows = rows.unionByName(m.where("n is not null and g > 1000").select(path("/b_Protokoll.md").alias("path"), F.lit(5).alias("length"))).unionByName(m.where("n is null").select(path("/c_Protokoll.md").alias("path"), F.lit(1).alias("length")))
    from ..operators.inventory import positions

    return positions(files.examples(rows), ["length", "example"]).select(F.col("position").alias("place"), "example", "gold")


@query("stem:s user:s answer:s split:s", f"select coalesce(stem, '-') as stem, \"user\", answer, coalesce(split, '-') as split from {Q.REC}")
def jsonl_files(t):
    """Chat records written as JSON lines by split and read back."""
    r = Q.records(t).withColumn("split", F.coalesce("split", F.lit("-"))).withColumn("meta", F.struct(F.col("stem").alias("stem"), F.col("top").cast("int").alias("top")))
    msg = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    r = r.withColumn("messages", F.array(msg("user", "user"), msg("assistant", "answer")))
    at = folder(r.sparkSession, "jsonl")
    sinks.write_jsonl(r, at)
    back = r.sparkSession.read.schema(f"{schemas.RECORD}, split string").json(at)
    return back.select(F.coalesce("meta.stem", F.lit("-")).alias("stem"), F.col("messages")[0]["content"].alias("user"), F.col("messages")[1]["content"].alias("answer"), "split")


@query("stem:s reason:s n:s", "select stem, reason, n from (select stem, reason, count(*)::varchar as n from " + Q._REJ + " where stem is not null group by all)")
def report_files(t):
    """The reject ledger written as a report with tabs and read back."""
    r = Q.dataset.reject_ledger(Q._candidates(t)).where("stem is not null").groupBy("stem", "reason").agg(F.count("*").alias("n"))
    at = folder(r.sparkSession, "report")
    sinks.write_tsv(r, at, ["stem", "reason"])
    return r.sparkSession.read.option("sep", "\t").option("header", "true").schema("stem string, reason string, n string").csv(at)


@query("stem:s text:s", f"select stem, string_agg('<SD-SPK>P' || pt || '_SPEAKER_01</SD>' || chr(10) || n || ' Segmente', chr(10) || chr(10) order by pt) as text from (select stem, pt, count(*) as n from {Q.SEG} group by stem, pt) group by stem")
def merged_parts(t):
    """The parts of a transcript put together in the order of their numbers."""
    p = Q.segments(t).groupBy("stem", "pt").agg(F.count("*").alias("n"))
    p = p.select("stem", F.concat("stem", F.lit(".pt"), F.lpad(F.col("pt").cast("string"), 2, "0"), F.lit(".md")).alias("path"), F.concat(F.lit("---\nteil: 1\n---\n<SD-SPK>SPEAKER_01</SD>\n"), F.col("n").cast("string"), F.lit(" Segmente")).alias("text"))
    return files.merged_parts(p, ["stem"])


@query("stem:s text:s", f"""select stem, 'Kopf' || chr(10) || string_agg('<SD-SPK>' || coalesce(speaker, '-') || '</SD>' || chr(10) || lines, chr(10) || chr(10) order by island) || chr(10) as text
 from (select stem, island, any_value(speaker) as speaker, string_agg('[00:00:00.000 --> 00:00:01.000] ' || text, chr(10) order by pt, ord) as lines from (select *, sum(case when rn = 1 or speaker is distinct from before then 1 else 0 end) over (partition by stem order by pt, ord) as island
  from (select *, lag(speaker) over (partition by stem order by pt, ord) as before, row_number() over (partition by stem order by pt, ord) as rn from (select stem, pt, ord, coalesce(speaker, '-') as speaker, text from {Q.SEG} where trim(coalesce(text, '')) <> ''))) group by stem, island) group by stem""")
def transcript_markdown(t):
    """Transcripts in markup from speaker groups over all parts of a sitting."""
    # the place in the sitting, counted: a number made of part and position would end at some part or mix parts
    at = F.row_number().over(W.partitionBy("stem").orderBy(F.col("pt").asc_nulls_last(), F.col("ord").asc_nulls_last()))
    s = Q.segments(t).where("trim(coalesce(text, '')) <> ''").select("stem", at.alias("ord"), F.coalesce("speaker", F.lit("-")).alias("speaker"), F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), "text")
    return sinks.transcript_markdown(Q.turns.speaker_groups(s, ["stem"]), "stem", F.lit("Kopf\n"))
