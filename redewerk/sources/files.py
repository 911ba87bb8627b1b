"""Readers: listings, whole texts, manifests, ledgers, front matter. Schemas are explicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def listing(spark: SparkSession, path: str, suffixes: list[str] | None = None) -> DataFrame:
    """path, length, modificationTime of all files below ``path``; contents are not read. Case of the suffix doesn't matter."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    if suffixes:
        d = d.where(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin([s.lower() for s in suffixes]))
    return d


def sessions(files: DataFrame, root: str) -> DataFrame:
    """Folders that directly hold a recording or a PDF: raw_dir below root, and their files."""
    rel = F.regexp_replace("path", "^.*" + root.rstrip("/").rsplit("/", 1)[-1] + "/", "")
    d = files.withColumn("raw_dir", F.regexp_replace(rel, r"/[^/]*$", "")).where(F.lower("path").rlike(r"\.(mp3|pdf)$"))
    return d.groupBy("raw_dir").agg(
        F.array_sort(F.collect_list(F.when(F.lower("path").endswith(".pdf"), F.col("path")))).alias("pdfs"), F.array_sort(F.collect_list(F.when(F.lower("path").endswith(".mp3"), F.col("path")))).alias("audios")
    )


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): one row a file."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def without_front_matter(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n", "")


def front_matter(text: Column) -> Column:
    """The header between ``---`` lines as a map; values behind the first ``: ``. Indented lines are skipped, of repeated keys the last stays; unterminated headers give an empty map."""
    head = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---\n", 1)
    ls = F.filter(F.split(head, "\n"), lambda x: x.contains(": ") & ~x.rlike(r"^\s"))
    pairs = F.transform(ls, lambda x: F.struct(F.trim(F.substring_index(x, ": ", 1)).alias("k"), F.trim(F.regexp_replace(x, r"^.*?: ", "")).alias("v")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def path_list(spark: SparkSession, path: str) -> DataFrame:
    """Paths of a list: one a line, blank lines and comments skipped."""
    return spark.read.text(path).select(F.trim("value").alias("path")).where("path <> '' and path not like '#%'")


def manifest(spark: SparkSession, path: str, more: list[str] | None = None) -> DataFrame:
    """Stems of a held-out list with tabs, by the header ``stem`` or else the second column, and those given."""
    rows = spark.read.csv(path, sep="\t", header=False)
    head = rows.first()
    names = list(head) if head else []
    at = names.index("stem") if "stem" in names else min(1, len(rows.columns) - 1)
    stems = rows.select(F.col(rows.columns[at]).alias("stem")).where(F.col("stem") != "stem")
    return stems.union(spark.createDataFrame([(m,) for m in more or []], "stem string")).where("trim(stem) <> ''").distinct()


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Sessions of a ledger in JSON; a broken one is empty."""
    raw = spark.read.text(path, wholetext=True)
    kinds = f"version int, sessions map<string, struct<{_colons(schemas.LEDGER)}>>"
    return raw.select(F.from_json("value", kinds).alias("j")).select(F.explode("j.sessions").alias("stem", "s")).select("s.*")


def _colons(ddl: str) -> str:
    """A column list as the fields of a struct type: ``name: type``."""
    out, depth, field = [], 0, ""
    for c in ddl + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            name, kind = field.strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            field = ""
        else:
            field += c
    return ", ".join(out)


def exclusions(spark: SparkSession, path: str) -> DataFrame:
    """(stem, tops array<string>) of a JSON map whose lists mix numbers and words."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string, array<string>>")).alias("stem", "tops"))


def examples(files: DataFrame) -> DataFrame:
    """(example, transcript, gold, length): of each folder the first transcript and, if any, gold; folders without transcript drop out; shortest transcript first."""
    name = F.element_at(F.split("path", "/"), -1)
    d = files.withColumn("example", F.element_at(F.split("path", "/"), -2)).withColumn("kind", F.when(F.lower(name).contains("transkript"), "t").when(F.lower(name).contains("protokoll"), "g"))
    g = d.groupBy("example").agg(
        F.min(F.when(F.col("kind") == "t", F.col("path"))).alias("transcript"), F.min(F.when(F.col("kind") == "g", F.col("path"))).alias("gold"),
        F.min_by("length", F.when(F.col("kind") == "t", F.col("path"))).alias("length"),
    )
    return g.where("transcript is not null").orderBy("length", "example")


def merged_parts(parts: DataFrame, keys: list[str], inner_headers: bool = False) -> DataFrame:
    """(keys, text): parts ``ptNN`` joined by a blank line in numeric order. Headers of later parts go unless kept; labels get their part's number in front then."""
    no = F.regexp_extract("path", r"\.pt(\d+)\.", 1).try_cast("int")
    text = F.col("text") if inner_headers else without_front_matter(F.col("text"))
    p = parts.withColumn("_no", F.coalesce(no, F.lit(0))).withColumn("text", text)
    if not inner_headers:
        p = p.withColumn("text", F.regexp_replace("text", F.lit(r"(<SD-SPK>)\s*(SPEAKER_)"), F.concat(F.lit("$1P"), F.col("_no").cast("string"), F.lit("_$2"))))
    g = p.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_no", "text"))).alias("ps"))
    return g.select(*keys, F.array_join(F.transform("ps", lambda x: x["text"]), "\n\n").alias("text"))
