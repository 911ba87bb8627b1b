"""Problem 4: splitting oversized items at natural boundaries.

Content-defined chunking over the words of a message: a rolling hash over a window of
words sets landmarks that depend on the words alone; a cut goes to the natural
boundary (speaker turn, paragraph, sentence) nearest to the first landmark between the
least and the largest size, of two as near to the stronger one. After an edit, cuts fall back onto the same places within a few
pieces, so distant pieces stay as they were.
"""

from __future__ import annotations

import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import read

WINDOW = 8
BASE, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
TURN, PARAGRAPH, SENTENCE, NONE = 3, 2, 1, 0
_TURN = re.compile(r"[^\W\d_][^\n:]{0,80}:(?:\s|$)")
_PIECE = T.ArrayType(
    T.StructType(
        [T.StructField("piece_no", T.IntegerType()), T.StructField("text", T.StringType()), T.StructField("words", T.IntegerType())]
        + [T.StructField("overlap", T.IntegerType()), T.StructField("boundary", T.IntegerType())]
    )
)


def boundaries(text: str, spans: list[tuple[int, int]]) -> list[int]:
    """For each word the strength of the boundary before it."""
    out = []
    for k, (a, _) in enumerate(spans):
        if k == 0:
            out.append(TURN)
            continue
        end = spans[k - 1][1]
        gap = text[end:a]
        if "\n" in gap and _TURN.match(text, a):
            out.append(TURN)
        elif gap.count("\n") > 1:
            out.append(PARAGRAPH)
        elif text[end - 1] in ".!?…" or (text[end - 1] in "“”\"')»" and end > 1 and text[end - 2] in ".!?…"):
            out.append(SENTENCE)
        else:
            out.append(NONE)
    return out


def landmarks(words: list[str], every: int) -> list[bool]:
    """Whether the rolling hash over the WINDOW words up to each word hits one value in ``every``."""
    top, h, out = pow(BASE, WINDOW, 1 << 64), 0, []
    x = [xxhash.xxh3_64_intdigest(w) for w in words]
    for i, v in enumerate(x):
        h = (h * BASE + v) & MASK
        if i >= WINDOW:
            h = (h - x[i - WINDOW] * top) & MASK
        out.append((h ^ h >> 29) % every == 0)
    return out


def cuts(text: str, spans: list[tuple[int, int]], limit: int, overlap: int) -> list[int]:
    """Word numbers at which pieces begin. A piece's own words plus the overlap stay within the limit."""
    n = len(spans)
    most = max(1, limit - overlap)
    least = max(1, most // 3)
    strength = boundaries(text, spans)
    mark = landmarks([text[a:b] for a, b in spans], max(2, most // 3))
    at = [0]
    while n - at[-1] > (most if len(at) > 1 else limit):
        lo, hi = at[-1] + least, at[-1] + most
        target = next((i for i in range(lo, hi) if mark[i]), hi)
        at.append(min((i for i in range(lo, hi + 1) if strength[i] != NONE), key=lambda i: (abs(i - target), -strength[i], i), default=target))
    return at


def split_text(text: str | None, limit: int | None, overlap: int | None) -> list[tuple[int, str, int, int, int]]:
    """(piece_no, text, words, overlap, boundary) of each piece.

    A text within the limit, a blank one or one without a limit is one piece; null gives none.
    Words are runs of non-blank characters. An overlap that would fill the limit is cut to half of it.
    """
    if text is None:
        return []
    spans = [m.span() for m in re.finditer(r"\S+", text)]
    if not limit or limit < 1 or len(spans) <= limit:
        return [(0, text, len(spans), 0, TURN)]
    overlap = min(max(0, overlap or 0), limit // 2)
    at = cuts(text, spans, limit, overlap)
    strength, out = boundaries(text, spans), []
    for k, (a, b) in enumerate(zip(at, at[1:] + [len(spans)])):
        first = max(0, a - overlap) if k else 0
        end = spans[b][0] if b < len(spans) else len(text)
        out.append((k, text[spans[first][0] if k else 0 : end].rstrip() if b < len(spans) else text[spans[first][0] if k else 0 :], b - first, a - first, strength[a]))
    return out


@F.pandas_udf(_PIECE)
def _split(text: pd.Series, limit: pd.Series, overlap: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("piece_no", "text", "words", "overlap", "boundary"), p)) for p in split_text(t, int(m), int(o))] for t, m, o in zip(text, limit, overlap)])


def pieces(records: DataFrame, limits: DataFrame) -> DataFrame:
    """(rec_id, msg_pos, piece_no, text, words, overlap, boundary) of the messages above their limit.

    Limits: rows of purpose ``pieces``; case and ``_``/``-`` of the strategy don't matter, a null or
    unlisted one means ``per-top``. Rows of the same rec_id count once; null contents and
    messages within the limit give no rows. Pieces are numbered in order; joined without their
    overlaps they give the words of the message.
    """
    key = F.regexp_replace(F.lower(F.trim("strategy")), r"[_\s]+", "-")
    lim = limits.where(F.lower("purpose") == "pieces").groupBy(key.alias("strategy")).agg(F.min("max_size").alias("max_size"), F.min("overlap_size").alias("overlap_size"))
    r = records.where("rec_id is not null")
    own = F.regexp_replace(F.lower(F.trim("meta.strategy")), r"[_\s]+", "-")
    msg = r.select("rec_id", own.alias("strategy"), F.posexplode("messages").alias("msg_pos", "m")).select("rec_id", "strategy", "msg_pos", F.col("m.content").alias("text"))
    msg = msg.where("text is not null").withColumn("n", F.size(F.split(F.trim(F.regexp_replace("text", r"(?U)\s+", " ")), " ")))
    listed = msg.join(lim, "strategy", "left")
    base = lim.select(F.col("strategy").alias("instead"), F.col("max_size").alias("base_size"), F.col("overlap_size").alias("base_overlap"))
    listed = listed.withColumn("instead", F.when(F.col("max_size").isNull(), "per-top")).join(base, "instead", "left")
    msg = listed.withColumn("limit", F.coalesce("max_size", "base_size")).withColumn("overlap", F.coalesce("overlap_size", "base_overlap", F.lit(0))).where("n > limit")
    # only what is above its limit is shuffled; of rows of the same rec_id one counts
    msg = msg.dropDuplicates(["rec_id", "msg_pos"])
    return msg.select("rec_id", "msg_pos", F.explode(_split("text", "limit", "overlap")).alias("p")).select("rec_id", "msg_pos", "p.*")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pieces(read(spark, sf_dir, "records"), read(spark, sf_dir, "size_limits"))
    return p.where("piece_no = 1").select("rec_id", "msg_pos")


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces(read(spark, sf_dir, "records"), read(spark, sf_dir, "size_limits"))


def queries() -> dict:
    return {"p4_found": p4_found, "p4_pieces": p4_pieces}


def oracle_sql() -> dict[str, str]:
    found = r"""
    with r as (select distinct on (rec_id) rec_id, messages, coalesce(replace(lower(trim(meta.strategy)), '_', '-'), 'per-top') as strategy
               from records where rec_id is not null),
    m as (select rec_id, strategy, unnest(range(len(messages)))::int as msg_pos, unnest(messages).content as text from r)
    select rec_id, msg_pos from m
    left join (select lower(strategy) as strategy, max_size from size_limits where purpose = 'pieces') l using (strategy)
    where len(regexp_extract_all(text, '[^\s\x0B\x1C-\x1F\x85\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'))
          > coalesce(max_size, (select max_size from size_limits where purpose = 'pieces' and strategy = 'per-top'))
    """
    return {"p4_found": found}
