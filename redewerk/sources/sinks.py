"""Writers: chat records, reports, markdown, versioned tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(records: DataFrame, path: str, overwrite: bool = False) -> None:
    """JSON lines in a folder a split; null fields are left out, characters are not escaped. Refuses to overwrite unless told."""
    line = F.to_json(F.struct("messages", "meta"))
    records.select("split", line.alias("value")).write.partitionBy("split").mode("overwrite" if overwrite else "errorifexists").text(path)


def write_tsv(report: DataFrame, path: str, order: list[str], overwrite: bool = True) -> None:
    """A report as one file with tabs and a header, nulls as dashes. For reports, whose size is that of a listing."""
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in report.columns]
    report.select(*cols).repartition(1).sortWithinPartitions(*order).write.option("sep", "\t").option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").mode("overwrite" if overwrite else "errorifexists").csv(path)


def transcript_markdown(groups: DataFrame, key: str, header: Column) -> DataFrame:
    """(key, text): header, then for each group its speaker tag and stamped lines. Expects island, speaker, segments (start, end, text) and a header column."""
    from ..functions.text import clock

    line = lambda s: F.concat(F.lit("["), clock(s["start"]), F.lit(" --> "), clock(s["end"]), F.lit("] "), s["text"])
    block = F.concat(F.lit("<SD-SPK>"), F.col("speaker"), F.lit("</SD>\n"), F.array_join(F.transform(F.filter("segments", lambda s: F.trim(s["text"]) != ""), line), "\n"))
    g = groups.select(key, "island", block.alias("b")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("island", "b"))).alias("bs"))
    return g.select(key, F.concat(header, F.array_join(F.transform("bs", lambda x: x["b"]), "\n\n"), F.lit("\n")).alias("text"))


def with_front_matter(fields: dict[str, Column], body: Column) -> Column:
    return F.concat(F.lit("---\n"), *[F.concat(F.lit(f"{k}: "), F.coalesce(v.cast("string"), F.lit("")), F.lit("\n")) for k, v in fields.items()], F.lit("---\n"), body)


def write_files(rows: DataFrame, folder: str, name: str = "name", text: str = "text") -> DataFrame:
    """One file a row, written by the tasks to a shared folder (a path or the URI of a file system); a task that runs again writes the same. Gives (name, bytes)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        from pyarrow import fs as pafs

        fs, base = pafs.FileSystem.from_uri(folder if "://" in folder else "file://" + os.path.abspath(folder))
        fs.create_dir(base)
        for pdf in parts:
            sizes = []
            for n, t in zip(pdf[name], pdf[text]):
                raw, tmp = t.encode(), f"{base}/.{n}.{os.getpid()}"
                with fs.open_output_stream(tmp) as f:
                    f.write(raw)
                fs.move(tmp, f"{base}/{n}")
                sizes.append(len(raw))
            yield pd.DataFrame({"name": pdf[name], "bytes": sizes})

    return rows.select(name, text).mapInPandas(run, "name string, bytes bigint")


class VersionedTable:
    """A table as folders v1, v2 ...; a version is there once its marker is, so readers never see half of one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def version(self) -> int:
        fs, p = self._fs(self.path)
        return max((int(x.getPath().getName()[5:]) for x in fs.listStatus(p) if x.getPath().getName().startswith("done-")), default=0) if fs.exists(p) else 0

    def read(self, schema: str) -> DataFrame:
        v = self.version()
        return self.spark.read.schema(schema).parquet(f"{self.path}/v{v}") if v else self.spark.createDataFrame([], schema)

    def write(self, df: DataFrame) -> int:
        v = self.version() + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{v}")
        fs, p = self._fs(f"{self.path}/done-{v}")
        fs.create(p).close()
        return v


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose output is not there yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def staged(sessions: DataFrame, existing: DataFrame) -> DataFrame:
    """(stem, kind, part, src_path, status): what links and copies would be made; existing (stem, kind, part, src_path) tells what is there, differing sources included."""
    pdf = sessions.where("pdf_src is not null").select("stem", F.lit("pdf").alias("kind"), F.lit(0).alias("part"), F.col("pdf_src").alias("src_path"))
    audio = sessions.select("stem", F.lit("audio").alias("kind"), F.posexplode("audio_src").alias("part", "src_path"))
    plan = pdf.unionByName(audio)
    e = existing.select("stem", "kind", "part", F.col("src_path").alias("_have"))
    status = F.when(F.col("_have").isNull(), "linked").when(F.col("_have") == F.col("src_path"), "exists").otherwise("EXISTS_DIFFERS")
    return plan.join(e, ["stem", "kind", "part"], "left").withColumn("status", status).drop("_have")


def copied(plan: DataFrame, existing: DataFrame) -> DataFrame:
    """Adds ``status`` to (dst_path, length): ``copied``, ``exists`` if a file of the same size is there, else EXISTS_DIFFERS. existing: (dst_path, length)."""
    e = existing.select("dst_path", F.col("length").alias("_have"))
    status = F.when(F.col("_have").isNull(), "copied").when(F.col("_have") == F.col("length"), "exists").otherwise("EXISTS_DIFFERS")
    return plan.join(e, "dst_path", "left").withColumn("status", status).drop("_have")
