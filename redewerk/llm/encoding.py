"""Problem 10: garbled text from wrong character encoding.

Garbled and clean spellings that are equal once all non-ASCII characters are taken out are near-twins.
Twins are joined word by word over all texts (documents are often garbled only in part, and
have no twin as a whole): each spelling with the one of its twins that has the fewest non-ASCII characters and, of these,
is most frequent. Their characters are aligned between the ASCII characters they share,
and the counted replacements kept where a chain of encodings in fact turns one into
the other; runs of characters teach their single characters too. The learned replacements are then applied to all texts, and the chains they
belong to to the characters that no twin showed.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import read, written

# --- fixed values: encodings texts are written in or taken for ---------------------------
ENCODINGS = ("utf-8", "latin-1", "cp1252", "cp1250", "iso8859-2", "iso8859-15", "cp850", "cp852", "cp437", "mac_roman", "mac_latin2", "cp1251", "koi8-r", "iso8859-5", "cp866", "cp1254", "cp1257", "iso8859-9", "cp1253")
#: Different words that must show a replacement, or others of its chain of encodings.
SUPPORT = 2
#: Occurrences that make a word frequent.
USUAL = 20
LOST = "�"

_NON_ASCII = re.compile(r"[^\x00-\x7f]+")
# ASCII blanks only: other blanks may be bytes of a garbled character
_TOKEN = re.compile(r"[^ \t\n\r\f\v]+")
_EDGE = "\"'.,;:!()[]{}<>/*_-`~#$%&+=|\\"


def to_bytes(s: str, enc: str) -> bytes:
    """Encoded; control characters that the encoding lacks stand for their own byte, as lenient decoders leave them."""
    try:
        return s.encode(enc)
    except UnicodeEncodeError:
        return b"".join(c.encode("latin-1") if 0x80 <= ord(c) < 0xA0 else c.encode(enc) for c in s)


def to_text(b: bytes, enc: str) -> str:
    try:
        return b.decode(enc)
    except UnicodeDecodeError:
        if enc == "utf-8":
            raise
        return "".join(chr(x) if 0x80 <= x < 0xA0 and not _can(x, enc) else bytes([x]).decode(enc) for x in b)


def _can(x: int, enc: str) -> bool:
    try:
        bytes([x]).decode(enc)
        return True
    except UnicodeDecodeError:
        return False


Chain = tuple[str, ...]  # written as, read as, written as, read as ...
SINGLE: tuple[Chain, ...] = tuple((a, b) for a in ENCODINGS for b in ENCODINGS if a != b and b != "utf-8")
DOUBLE: tuple[Chain, ...] = tuple(("utf-8", b, "utf-8", d) for b in ENCODINGS[1:] for d in ENCODINGS[1:])


def garble(s: str, chain: Chain) -> str | None:
    try:
        for a, b in zip(chain[::2], chain[1::2]):
            s = to_text(to_bytes(s, a), b)
        return s
    except UnicodeError:
        return None


def ungarble(s: str, chain: Chain) -> str | None:
    try:
        for a, b in reversed(list(zip(chain[::2], chain[1::2]))):
            s = to_text(to_bytes(s, b), a)
        return s
    except UnicodeError:
        return None


def skeleton(token: str) -> str:
    """The token without non-ASCII characters and without question marks inside it."""
    return "".join(c for c in token if c < "\x80" and c != "?")


def core(token: str) -> str:
    """The token without ASCII punctuation around it; a question mark stays where a letter follows it."""
    t = token.strip(_EDGE)
    return t.rstrip("?" + _EDGE) if t.endswith("?") else t


def notable(t: str) -> bool:
    """Whether a core has non-ASCII characters, or a question mark in place of a letter."""
    return not t.isascii() or ("?" in t and bool(re.search(r"\?[^\W\d_]", t)) and not t.startswith("??"))


def runs(token: str) -> list[str]:
    """What stands before each character of the skeleton and after the last."""
    out = [""]
    for c in token:
        if c < "\x80" and c != "?":
            out.append("")
        else:
            out[-1] += c
    return out


def aligned(bad: str, good: str) -> list[tuple[str, str]]:
    """Replacements between twins."""
    return [(x, y) for x, y in zip(runs(bad), runs(good)) if x != y and x and y]


def explaining(bad: str, good: str) -> list[Chain]:
    """Chains that turn good into bad; double ones only where no single one does."""
    single = [c for c in SINGLE if garble(good, c) == bad]
    return single or [c for c in DOUBLE if garble(good, c) == bad]


_TOKENS = T.StructType([T.StructField("token", T.StringType()), T.StructField("n", T.LongType())])


def _tokens(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        n: Counter[str] = Counter()
        for t in pdf["text"]:
            n.update(x for w in _TOKEN.findall(t) if (x := core(w)) and notable(x))
        yield pd.DataFrame(list(n.items()), columns=["token", "n"])


_ALIGNED = T.ArrayType(T.StructType([T.StructField("bad", T.StringType()), T.StructField("good", T.StringType())]))


@F.pandas_udf(T.StringType())
def _skeleton(s: pd.Series) -> pd.Series:
    return s.map(skeleton)


@F.pandas_udf(_ALIGNED)
def _aligned(bad: pd.Series, good: pd.Series) -> pd.Series:
    return pd.Series([[{"bad": x, "good": y} for x, y in aligned(b, g)] for b, g in zip(bad, good)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _runs(s: pd.Series) -> pd.Series:
    return s.map(lambda t: sorted({r for r in runs(t) if r}))


def single(bad: str, good: str, chain: Chain) -> list[tuple[str, str]]:
    """The replacements of single characters behind the one of a run."""
    out = []
    for c in set(good):
        x = garble(c, chain)
        if x is not None and x != c and x in bad:
            out.append((x, c))
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("bad", T.StringType()), T.StructField("good", T.StringType()), T.StructField("chain", T.StringType())])))
def _explained(bad: pd.Series, good: pd.Series) -> pd.Series:
    """Replacements of single characters with the chains that make them; lost characters without chain."""

    def one(b: str, g: str) -> list[dict]:
        if set(b) <= {"?", LOST}:
            return [{"bad": b[0], "good": "", "chain": ""}]
        return [{"bad": x, "good": c, "chain": ">".join(chain)} for chain in explaining(b, g) for x, c in single(b, g, chain)]

    return pd.Series([one(b, g) for b, g in zip(bad, good)])


def learned(texts: DataFrame) -> tuple[dict[str, str], dict[str, str], dict[Chain, int], dict[str, int], str]:
    """(replacements bad -> good, those whose bad is also written rightly, chains with their support, lost marks, usual characters) from the twins in all texts.

    Their number is bounded by the encodings and the characters written in the texts, not by the texts.
    """
    types = written(texts.mapInPandas(_tokens, _TOKENS).groupBy("token").agg(F.sum("n").alias("n")), "tokens")
    types = types.withColumn("skeleton", _skeleton("token")).where(F.length("skeleton") >= 2).withColumn("odd", F.length("token") - F.length("skeleton"))
    fit = types.where(~F.col("token").contains("?") & ~F.col("token").contains(LOST))
    best = fit.groupBy("skeleton").agg(F.min_by(F.struct("token", "n", "odd"), F.struct("odd", -F.col("n"), "token")).alias("x")).select("skeleton", F.col("x.token").alias("clean"), F.col("x.n").alias("most"), F.col("x.odd").alias("clean_odd"))
    pairs = types.join(best, "skeleton").where(F.col("token") != F.col("clean"))
    step = pairs.select("skeleton", F.explode(_aligned("token", "clean")).alias("x")).groupBy("x.bad", "x.good").agg(F.count_distinct("skeleton").alias("words"))
    step = written(step.select("words", F.explode(_explained("bad", "good")).alias("x")).groupBy("x.bad", "x.good", "x.chain").agg(F.sum("words").alias("words")), "replacements")
    rightly = best.select("skeleton", F.explode(_runs("clean")).alias("bad")).groupBy("bad").agg(F.count("*").alias("right"))
    step = step.join(rightly, "bad", "left").orderBy(F.col("words").desc(), "bad", "good", "chain")
    rows = step.collect()
    lost = {r["bad"]: r["words"] for r in rows if not r["chain"] and r["words"] >= SUPPORT}
    chains: Counter[Chain] = Counter()
    for r in rows:
        if r["chain"]:
            chains[tuple(r["chain"].split(">"))] += r["words"]
    replace: dict[str, str] = {}
    doubtful: dict[str, str] = {}
    for r in rows:
        bad = r["bad"]
        if not r["chain"] or chains[tuple(r["chain"].split(">"))] < SUPPORT or bad in replace or bad in doubtful:
            continue
        (doubtful if (r["right"] or 0) > r["words"] else replace)[bad] = r["good"]
    # characters of frequent words: what a chain leads back to must consist of them
    usual = best.where(F.col("most") >= USUAL).select(F.explode(F.split(F.regexp_replace("clean", r"[\x00-\x7f]", ""), "")).alias("c")).where("c <> ''").distinct()
    return replace, doubtful, dict(chains), lost, "".join(sorted(r["c"] for r in usual.collect()))


class Mender:
    """Applies replacements and chains to texts."""

    def __init__(self, replace: dict[str, str], doubtful: dict[str, str], chains: dict[Chain, int], lost: dict[str, int], usual: str):
        self.replace, self.doubtful, self.lost = replace, doubtful, set(lost)
        self.by_bad: dict[str, list[Chain]] = {}
        self.rank = chains
        self.letters = ({c for g in replace.values() for c in g} | set(usual)) - {chr(c) for c in range(0x80, 0xA0)}
        for b, g in replace.items():
            self.by_bad[b] = [c for c in explaining(b, g) if c in chains]
        longest = sorted(replace, key=len, reverse=True)
        self.pattern = re.compile("|".join(map(re.escape, longest))) if longest else None

    def run(self, run: str, chain: Chain | None, sure: bool) -> str | None:
        """A run of non-ASCII characters as it was before, or None if it isn't known to be garbled.

        Characters that are also written rightly are touched only in a word that is garbled for sure:
        documents are often garbled in part.
        """
        if run in self.replace:
            return self.replace[run]
        if not sure and set(run) <= self.letters:
            return None
        if run in self.doubtful:
            good = self.doubtful[run]
            return good if sure and chain is not None and garble(good, chain) == run else None
        if chain is not None:
            back = ungarble(run, chain)
            if back is not None and back != run and LOST not in back and set(back) <= self.letters:
                return back
        if self.pattern is not None:
            parts, at = [], 0
            for m in self.pattern.finditer(run):
                if m.start() != at:
                    return None
                parts.append(self.replace[m[0]])
                at = m.end()
            if parts and at == len(run):
                return "".join(parts)
        return None

    def text(self, text: str) -> tuple[str, int, int]:
        """(mended text, replacements made, characters lost for good)."""
        votes: Counter[Chain] = Counter()
        words = 0
        for m in _NON_ASCII.finditer(text):
            # a sign that stands alone says nothing
            near = text[max(0, m.start() - 1) : m.start()] + text[m.end() : m.end() + 1]
            if m[0] in self.by_bad and any(c.isalnum() for c in near):
                words += 1
                votes.update(self.by_bad[m[0]])
        chain = max(votes, key=lambda c: (votes[c], self.rank.get(c, 0), c)) if votes else None
        made = 0

        def mend(word: re.Match) -> str:
            nonlocal made
            if word[0].isascii():
                return word[0]
            sure = any(r in self.replace for r in _NON_ASCII.findall(word[0]))

            def one(m: re.Match) -> str:
                nonlocal made
                back = self.run(m[0], chain, sure)
                if back is None:
                    return m[0]
                made += 1
                return back

            return _NON_ASCII.sub(one, word[0])

        out = _TOKEN.sub(mend, text) if words else text
        gone = out.count(LOST)
        for w in _TOKEN.findall(text):
            x = core(w)
            if "?" in x and re.search(r"[^\W\d_]\?[a-zäöüßąćęłńóśźż]|(?<![\w?])\?[a-zäöüßąćęłńóśźż]{2}", x) and "?" in self.lost:
                gone += len(re.findall(r"\?(?=[^\W\d_])", x))
        return out, made, gone


_MENDED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lossy", T.IntegerType()), T.StructField("replaced", T.IntegerType()), T.StructField("text", T.StringType())])


def mended(documents: DataFrame) -> DataFrame:
    """(doc_id, lossy, replaced, text) of every affected document: the text as far as it can be won back, lossy 1 if characters are lost.

    Foreign letters and signs by themselves, null and blank texts give no rows. Repeated rows count once.
    """
    d = documents.where("doc_id is not null and text is not null").select("doc_id", "text")
    d = written(d.where(F.col("text").rlike(r"[^\x00-\x7f]|\?\p{L}")).dropDuplicates(["doc_id"]), "texts")
    shared = documents.sparkSession.sparkContext.broadcast(learned(d.select("text")))

    def apply(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mender = Mender(*shared.value)
        for pdf in parts:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                out, made, gone = mender.text(text)
                if made or gone:
                    rows.append((doc, int(gone > 0), made, out))
            yield pd.DataFrame(rows, columns=_MENDED.names)

    return d.mapInPandas(apply, _MENDED)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mended(read(spark, sf_dir, "documents")).select("doc_id", "lossy")


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mended(read(spark, sf_dir, "documents"))


def queries() -> dict:
    return {"p10_found": p10_found, "p10_restored": p10_restored}


def oracle_sql() -> dict[str, str]:
    return {}
