"""Cleaning of minutes: page furniture, footnotes, codes, hyphenation. The order of the steps is part of the result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import hyperlinks_unwrapped
from .sections import DECISIONS

# --- fixed values: shapes of page furniture ------------------------------------------
PLAIN_FOOTER = (
    r"(?m)(?:^[ \t]*#{0,6}[ \t]*[A-ZÄÖÜ][A-ZÄÖÜ0-9/-]{1,9}[ \t]*\n\s*)?"
    r"^[ \t]*#{0,6}[ \t]*\d{1,3}\.\s*\((?:öffentliche|nichtöffentliche|Sonder-)[^\n]*Sitzung[^\n]*\n"
    r"(?:[ \t]*\n)*(?:^[ \t]*#{0,6}[ \t]*\d{1,2}\.\d{1,2}\.\d{4}[ \t]*\n)?"
)
RATIFIED = r"(?m)^[ \t]*\(Dieses\s+Protokoll\s+wurde\s+durch\b[^\n]*?§\s?83[^\n]*?best[äa]tigt\.\)[ \t]*$\n?"
BULLET_TOP = r"(?m)^[ \t]*[-*][ \t]*(Zu\s+TOP\b[^\n]*)$"
CODE = r"(?:P-)?[A-ZÄÖÜ]{2,6}(?:ü|[0-9]{1,3})?"
CODE_LINE = r"(?m)^[ \t]*(?:#{1,6}|[-*])?[ \t]*(" + CODE + r")\.?[ \t]*$\n?"
EMPTY_HEADING = r"(?m)^[ \t]*#{1,6}[ \t]*$\n?"
IMAGE = r"(?m)^[ \t]*<!-- image -->[ \t]*\n?"
FOOTNOTE = r"(?m)^\d{1,3}\s+(?=.*(?:Vgl\.|Anlage)).*$"
FOOTNOTE_MARK = r"(?m)([.!?])[ \t]+\d{1,3}[ \t]*$"
ATTACHMENT_MARK = r"[ \t]*\(Anlage\)"
NUMBER_LINE = r"(?m)^[ \t]*(?:#{1,6}[ \t]*)?P-[A-ZÄÖÜ]{2,6}[ \t]+\d{1,2}/\d{1,3}[ \t]*$\n?"
ATTACHMENTS = r"(?ims)^##\s*Anlage.*\z"
PAGE_TABLE = (r"(?m)^\|[^\n]*", r"[^\n]*S\.\s*\d+[^\n]*\|\n\|[-:\s|]+\|\n\|[^\n]*\|[ \t]*\n?")
NAME_LINE = (r"(?m)^[ \t]*(?:#{1,6}[ \t]*)?", r"[ \t]*$\n?")
CODE_END = (r"(?m)[ \t]+", r"\.?[ \t]*$")
MULTI_SPACE = r"(?<=\S) {2,}(?=\S)"
SPLIT_HYPHEN = r"(?<=[a-zäöüß])- +(?!(?:und|oder|bzw\.?|sowie)\b)(?=[a-zäöüß])"


def cover_and_body(text: Column) -> tuple[Column, Column, Column]:
    """(cover, body, matched): split at the heading of the decisions; without it the body is empty."""
    at = F.regexp_instr(text, F.lit(DECISIONS))
    cover = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text)
    return cover, F.when(at > 0, F.substring(text, at, F.length(text))).otherwise(F.lit("")), at > 0


def without_attachments(c: Column) -> Column:
    return F.regexp_replace(c, ATTACHMENTS, "")


def _any(names: Sequence[str]) -> str:
    """A pattern for any of the names as they are."""
    return "(?:" + "|".join(r"\Q" + n.replace(r"\E", "") + r"\E" for n in names) + ")"


def without_page_tables(c: Column, institutions: Sequence[str] = ()) -> Column:
    """Page footers set as a table of three rows that begins with the name of an institution and a page number."""
    return F.regexp_replace(c, PAGE_TABLE[0] + _any(institutions) + PAGE_TABLE[1], "") if institutions else c


def without_institution_lines(c: Column, institutions: Sequence[str] = ()) -> Column:
    """Lines that hold the name of an institution alone, and lines with the number of the minutes."""
    x = F.regexp_replace(c, NAME_LINE[0] + _any(institutions) + NAME_LINE[1], "") if institutions else c
    return F.regexp_replace(x, NUMBER_LINE, "")


def without_codes(c: Column) -> Column:
    """Lines that hold a committee code alone go, and these codes (longest first) at the ends of other lines."""
    codes = F.array_distinct(F.regexp_extract_all(c, F.lit(CODE_LINE), F.lit(1)))
    by_length = F.transform(F.array_sort(F.transform(codes, lambda x: F.struct((-F.length(x)).alias("n"), x.alias("x")))), lambda s: s["x"])
    return F.aggregate(by_length, F.regexp_replace(c, CODE_LINE, ""), lambda t, code: F.regexp_replace(t, F.concat(F.lit(CODE_END[0]), code, F.lit(CODE_END[1])), F.lit("")))


def without_footnotes(c: Column) -> Column:
    x = F.regexp_replace(c, FOOTNOTE, "")
    return F.regexp_replace(F.regexp_replace(x, FOOTNOTE_MARK, "$1"), ATTACHMENT_MARK, "")


def hyphens_joined(c: Column) -> Column:
    return F.regexp_replace(c, SPLIT_HYPHEN, "")


def spaces_collapsed(c: Column) -> Column:
    return F.regexp_replace(c, MULTI_SPACE, " ")


def blank_lines_collapsed(c: Column) -> Column:
    return F.concat(F.btrim(F.regexp_replace(c, r"\n{3,}", "\n\n"), F.lit(" \n\t\r")), F.lit("\n"))


def cleaned(body: Column, institutions: Sequence[str] = ()) -> Column:
    """All steps in their order. One pass is the contract; a second may change more. institutions: names whose page furniture is taken out; nothing is guessed."""
    x = without_attachments(body)
    x = without_page_tables(x, institutions)
    x = F.regexp_replace(x, PLAIN_FOOTER, "")
    x = without_institution_lines(x, institutions)
    x = F.regexp_replace(x, RATIFIED, "")
    x = F.regexp_replace(x, BULLET_TOP, "## $1")
    x = without_codes(x)
    x = F.regexp_replace(x, IMAGE, "")
    x = hyperlinks_unwrapped(x)
    x = without_footnotes(x)
    x = F.regexp_replace(x, EMPTY_HEADING, "")
    x = spaces_collapsed(x)
    x = hyphens_joined(x)
    return blank_lines_collapsed(x)


def clean_minutes(docs: DataFrame, text: str = "text", institutions: Sequence[str] = ()) -> DataFrame:
    """Adds ``cover``, ``body`` (cleaned, empty without the heading of the decisions) and ``matched``."""
    cover, body, matched = cover_and_body(F.col(text))
    return docs.withColumns({"cover": cover, "matched": matched}).withColumn("body", F.when(matched, cleaned(body, institutions)).otherwise(F.lit("")))
