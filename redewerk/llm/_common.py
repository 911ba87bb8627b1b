"""Helpers shared by the training-data operators: tables, shared folder, text keys."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: stand-ins typed where the value is not known -------------------
UNKNOWN = ["", "?", "-", "–", "—", "n.n.", "nn", "n. n.", "unbekannt", "unknown", "k. a.", "k.a.", "n/a", "na", "none", "null", "keine angabe"]
# --- fixed values: role names of the three speakers of a chat record -----------------
ROLE_USER = ["user", "human"]
ROLE_ASSISTANT = ["assistant", "model"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only where the session names none, as in tests, a folder of this machine is set.
    """
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not set_dir:
        set_dir = "file://" + tempfile.mkdtemp(prefix="redewerk-")
        spark.conf.set("spark.checkpoint.dir", set_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(set_dir)
    return set_dir


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again (columns can then be pruned)."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def known(c: Column) -> Column:
    """``c``, or null where it is blank or a stand-in for "unknown"."""
    return F.when(~F.lower(F.trim(c)).isin(UNKNOWN), c)


def stem_key(c: Column) -> Column:
    """One spelling for all spellings of a sitting: ``CODE_wp_number``; null if not given."""
    parts = r"(?iU)^[\s_\-]*(\p{L}{2,})[\s_\-]+0*(\d+)[\s_\-]+0*(\d+)(?!\d)"
    own = F.concat_ws("_", F.upper(F.regexp_extract(c, parts, 1)), F.regexp_extract(c, parts, 2), F.regexp_extract(c, parts, 3))
    bare = F.trim(F.regexp_replace(F.upper(c), r"(?U)[\W_]+", " "))
    return F.when(c.rlike(parts), own).when(known(c).isNotNull() & (bare != ""), bare)


def plain_key(c: Column) -> Column:
    """Case, blanks, punctuation, path separators, file endings and leading zeros don't tell values apart."""
    x = F.regexp_replace(F.lower(F.trim(c)), r"\.(mp3|wav|m4a|ogg|flac)$", "")
    x = F.trim(F.regexp_replace(x, r"(?U)[\W_]+", " "))
    x = F.regexp_replace(x, r"\b0+(?=\d)", "")
    return F.when(known(c).isNotNull() & (x != ""), x)


def folded(c: Column) -> Column:
    """Lower case words with ä/ae, ö/oe, ü/ue, ß/ss spelled alike, parted by one blank."""
    x = F.lower(c)
    for a, b in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("ä", "ae"), ("ö", "oe"), ("ü", "ue")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))


def content_of(messages: Column, roles: list[str]) -> Column:
    """Content of the first message by one of ``roles`` (null if there is none)."""
    return F.get(F.filter(messages, lambda m: F.lower(F.trim(m["role"])).isin(roles)), F.lit(0))["content"]


def part_count(df: DataFrame, least: int = 1) -> int:
    """Shuffle partitions of the session, for explicit repartitioning."""
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
