"""Problem 9: evaluation passages that occur, wholly or partly, in documents.

One Aho-Corasick automaton holds every run of 13 words of the held-out passages, each known
word standing for one character. Each text is read once; hits are joined to the longest
passage runs and their offsets given in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import read

#: Consecutive words that make a quotation.
RUN = 13
#: Words of passages in one automaton. More passages are searched in several passes.
BLOCK_WORDS = 1_000_000

_WORD = re.compile(r"[^\W_](?:[^\W_]|[̀-ͯ])*")
_FOLD = str.maketrans({"ä": "ae", "ö": "oe", "ü": "ue", "ß": "ss"})


def fold(text: str) -> str:
    w = text.replace("\u0345", "").casefold().replace("ä", "ae").replace("ö", "oe").replace("ü", "ue")
    return w.translate(_FOLD)


class Automaton:
    """Finds runs of RUN words of (item_id, passage) pairs in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        self.codes: dict[str, str] = {}
        self.found = ahocorasick.Automaton()
        runs: dict[str, list[tuple[int, int]]] = {}
        for item, passage in items:
            code = "".join(self.codes.setdefault(w, chr(0x100 + len(self.codes) + (0x800 if len(self.codes) >= 0xD700 else 0))) for w in _WORD.findall(fold(passage or "")))
            for k in range(len(code) - RUN + 1):
                runs.setdefault(code[k : k + RUN], []).append((item, k))
        for code, at in runs.items():
            self.found.add_word(code, at)
        self.empty = not runs
        if runs:
            self.found.make_automaton()

    def spans(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, words) of the longest runs of a passage in the text; start and end count characters of the text."""
        if self.empty or not text:
            return []
        get = self.codes.get
        # the whole text is folded at once; folding joins or parts no words
        code = "".join([get(w, "\0") for w in _WORD.findall(fold(text))])
        open_runs: dict[tuple[int, int], list[int]] = {}
        done: list[tuple[int, int, int]] = []
        for end, at in self.found.iter(code):
            for item, k in at:
                key = (item, end - k)
                run = open_runs.get(key)
                if run and end <= run[1] + 1:
                    run[1] = end
                else:
                    if run:
                        done.append((item, *run))
                    open_runs[key] = [end - RUN + 1, end]
        done += [(item, *run) for (item, _), run in open_runs.items()]
        if not done:
            return []
        places = [m.span() for m in _WORD.finditer(text)]
        return sorted((item, places[a][0], places[b][1], b - a + 1) for item, a, b in done)


_SPANS = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "item_id")] + [T.StructField(c, T.IntegerType()) for c in ("start", "end", "words")])
_built: dict[str, Automaton] = {}


def digest(rows: list[tuple[int, str]]) -> str:
    """Tells blocks of items apart, also those of other calls in the same worker."""
    h = xxhash.xxh3_128()
    for item, passage in rows:
        h.update(f"{item}\x1f{passage}\x1e")
    return h.hexdigest()


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, words) of every passage run of at least RUN words in a document.

    Case, punctuation, spacing, line breaks and the spelling of umlauts and ß don't matter.
    Null and blank texts and shorter passages give nothing; repeated rows count once.
    """
    spark = documents.sparkSession
    items = items.where("item_id is not null and passage is not null").select("item_id", "passage").distinct()
    words = items.select(F.sum(F.size(F.split("passage", r"\s+"))).alias("n")).first()["n"] or 0
    blocks = -(-words // BLOCK_WORDS)
    sizes = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))))
    out: DataFrame | None = None
    for block in range(blocks):
        # about BLOCK_WORDS words
        rows = sorted((r["item_id"], r["passage"]) for r in sizes.where(F.col("block") == block).select("item_id", "passage").collect())
        shared, key = spark.sparkContext.broadcast(rows), digest(rows)

        def scan(parts: Iterator[pd.DataFrame], shared=shared, key=key) -> Iterator[pd.DataFrame]:
            if key not in _built:
                _built.clear()
                _built[key] = Automaton(shared.value)
            auto = _built[key]
            for pdf in parts:
                hits = [(d, *s) for d, t in zip(pdf["doc_id"], pdf["text"]) for s in auto.spans(t)]
                yield pd.DataFrame(hits, columns=_SPANS.names)

        found = documents.where("doc_id is not null and text is not null").select("doc_id", "text").mapInPandas(scan, _SPANS)
        out = found if out is None else out.unionByName(found)
    return out.distinct() if out is not None else spark.createDataFrame([], _SPANS)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()


def p9_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_items"))


def queries() -> dict:
    return {"p9_found": p9_found, "p9_spans": p9_spans}


def oracle_sql() -> dict[str, str]:
    words = r"list_filter(regexp_split_to_array(replace(replace(replace(replace(lower({0}), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), 'ß', 'ss'), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    found = f"""
    with d as (select doc_id, {words.format("text")} as w from documents where text is not null),
    dg as (select distinct doc_id, array_to_string(w[i:i + 12], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
    e as (select item_id, {words.format("passage")} as w from eval_items where passage is not null),
    eg as (select distinct item_id, array_to_string(w[i:i + 12], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 11)) as i from e))
    select distinct doc_id, item_id from dg join eg using (g)
    """
    return {"p9_found": found}
