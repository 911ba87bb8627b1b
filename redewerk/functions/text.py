"""Column expressions over text. All stay in the JVM."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"[\s\x1c-\x1f\x85\x{A0}]+"


def words(c: Column) -> Column:
    """Blank-separated words."""
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def sentence_runs(c: Column) -> Column:
    """Number of runs of sentence ends."""
    return F.regexp_count(c, F.lit(r"[.!?]+"))


def estimated_tokens(c: Column) -> Column:
    """A quarter of the characters."""
    return F.floor(F.length(c) / 4).cast("int")


def squeezed(c: Column) -> Column:
    """Blanks collapsed and cut off the ends."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def normalised_stem(c: Column) -> Column:
    """Pairing key of a file stem: lower case, role words and punctuation gone; underscores stay."""
    x = F.replace(F.replace(F.lower(c), F.lit("transkript"), F.lit("")), F.lit("protokoll"), F.lit(""))
    return squeezed(F.regexp_replace(x, r"[^\p{L}\p{N}_\s]", " "))


def canonical_key(c: Column) -> Column:
    """The pairing key with underscores as blanks: equal for all spellings of a held-out stem."""
    return squeezed(F.replace(normalised_stem(c), F.lit("_"), F.lit(" ")))


def prompt_hash(c: Column) -> Column:
    """First twelve hex digits of the SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 12)


def pinned_number(key: Column, seed: int = 42) -> Column:
    """A number from 0 to 9999 that depends on seed and key alone: eight bytes of the MD5, big-endian."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key))
    # in halves, as Spark has no unsigned 64-bit number
    hi, lo = (F.conv(F.substring(h, at, 8), 16, 10).cast("bigint") for at in (1, 9))
    return F.pmod(F.pmod(hi, F.lit(10000)) * F.lit((1 << 32) % 10000) + F.pmod(lo, F.lit(10000)), F.lit(10000)).cast("int")


def pinned_split(key: Column, share: float = 0.1, seed: int = 42) -> Column:
    """``val`` or ``train``; stays the same whatever else is in the corpus."""
    return F.when(pinned_number(key, seed) < round(share * 10000), "val").otherwise("train")


def clock(seconds: Column) -> Column:
    """HH:MM:SS.mmm from whole milliseconds; negative counts as 0."""
    ms = F.round(F.greatest(seconds, F.lit(0.0)) * 1000).cast("bigint")
    part = lambda div, mod: F.pmod(F.floor(ms / div), F.lit(mod)) if mod else F.floor(ms / div)
    return F.format_string("%02d:%02d:%02d.%03d", part(3600000, 0), part(60000, 60), part(1000, 60), F.pmod(ms, F.lit(1000)))


def json_span(c: Column) -> Column:
    """From the first ``{`` to the last ``}``; empty if there is none."""
    return F.regexp_extract(c, r"(?s)\{.*\}", 0)


def hyperlinks_unwrapped(c: Column) -> Column:
    return F.regexp_replace(c, r"\[([^\]]*)\]\((?:https?:|mailto:)[^)]*\)", "$1")


@F.pandas_udf(T.StringType())
def html_unescaped(s: pd.Series) -> pd.Series:
    """HTML entities as characters."""
    return s.map(lambda x: html.unescape(x) if isinstance(x, str) else None)
