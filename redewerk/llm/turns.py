"""Problem 7: speech transcripts into clean speaker turns.

Texts are cleaned of stamps, speaker labels, fillers and sounds; the speaker is the number given,
or the number that a name goes with elsewhere in the same part. The segments are sorted
over range partitions, so that one part of any length is spread over tasks; each task gives
the turns within its range, and only the turns at the edges of ranges, a few a task, are put
together at the end. Before that, the clock of each part is repaired, from its numbers alone and over
the whole part: resets are added up and the remaining disorder is levelled by isotonic regression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import read, written

_STAMP = r"[\[(<]?\s*\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?(?:\s*-{1,2}>\s*\d{1,2}:\d{2}:\d{2}(?:[.,]\d{1,3})?)?\s*[\])>]?"
_SOUND = r"\[[^\]\n]*\]|\((?!\p{Lu}{2,5}\))[^)\n]*\)|<[^>\n]*>|\*[^*\n]*\*|[♪♫]+"
_FILLER = r"(?<![\p{L}\p{N}-])(?:ä+h+m*|ö+h+m*|äm+|e+h+m+|h+m+|m+h+m+|u+h+m*)(?![\p{L}\p{N}-])[,.…]*"
_LABEL = r"(?:speaker|spk|sprecher(?:in)?|s)[\s_\-]*0*(\d{1,4})"
#: A clock that falls back by more seconds has been reset.
RESET_S = 30.0


def clean(text: Column) -> Column:
    """The words spoken: without stamps, leading speaker label, sounds and fillers."""
    x = F.regexp_replace(text, _STAMP, " ")
    x = F.regexp_replace(x, rf"(?i)^\s*{_LABEL}\s*:", " ")
    x = F.regexp_replace(x, _SOUND, " ")
    x = F.regexp_replace(x, rf"(?iu){_FILLER}", " ")
    x = F.regexp_replace(x, r"(?U)\s+([,.;:?!])", "$1")
    x = F.regexp_replace(x, r"^[\s,.;…]+", "")
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def number_of(c: Column) -> Column:
    """The diarisation number a label consists of, or null."""
    return F.regexp_extract(c, rf"(?i)^\s*{_LABEL}\s*:?\s*$", 1).try_cast("int")


def name_parts(label: str | None) -> tuple[str, str, str] | None:
    """(surname, given name or initial, party) of a typed name, folded; None if it holds no name."""
    if not label or not label.strip():
        return None
    s = label.casefold().replace("ä", "ae").replace("ö", "oe").replace("ü", "ue").replace("ß", "ss")
    party = "".join(re.findall(r"\(([^)]*)\)", s)).strip()
    s = re.sub(r"\([^)]*\)|:", " ", s)
    left, comma, right = s.partition(",")
    words = [w for w in re.split(r"\s+", s.replace(",", " ").strip()) if w and w.rstrip(".") not in {"abg", "herr", "herrn", "frau", "hr", "fr", "dr", "prof", "abgeordnete", "abgeordneter"}]
    if not words:
        return None
    if comma and left.split():
        return left.split()[-1], (right.split() or [""])[0], party
    return words[-1], words[0] if len(words) > 1 else "", party


def _fits(a: tuple[str, str, str], b: tuple[str, str, str]) -> int:
    """How well two names may stand for one person: 0 not at all."""
    if a[0] != b[0] or (a[2] and b[2] and a[2] != b[2]):
        return 0
    if not a[1] or not b[1]:
        return 1 + (a[2] == b[2])
    x, y = a[1].rstrip("."), b[1].rstrip(".")
    if x == y:
        return 4 + (a[2] == b[2])
    return 2 + (a[2] == b[2]) if (len(x) == 1 or len(y) == 1) and x[0] == y[0] else 0


_NAMED = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("no", T.IntegerType())]))


@F.pandas_udf(_NAMED)
def _numbers(seen: pd.Series, names: pd.Series) -> pd.Series:
    """For each name of a part the number it goes with: the best fitting names vote."""

    def one(pairs: list, asked: list) -> list:
        known = [(p, int(x["no"]), int(x["n"])) for x in pairs if (p := name_parts(x["name"]))]
        out = []
        for name in asked:
            own, votes = name_parts(name), {}
            for p, no, n in known:
                if own and (f := _fits(own, p)):
                    key = (f,)
                    votes.setdefault(key, {}).setdefault(no, 0)
                    votes[key][no] += n
            if votes:
                best = votes[max(votes)]
                out.append({"name": name, "no": min(best, key=lambda k: (-best[k], k))})
        return out

    return pd.Series([one(p if p is not None else [], a) for p, a in zip(seen, names)])


def cleaned(segments: DataFrame) -> DataFrame:
    """(stem, pt, ord, start_s, end_s, no, text): one row a segment (re-deliveries count once) with the speaker's number, if any, and clean text.

    Rows without stem, pt or ord are left out. Blank and null texts are segments without speech.
    """
    s = segments.where("stem is not null and pt is not null and ord is not null")
    inside = F.regexp_extract(F.regexp_replace("text", rf"^(\s*{_STAMP})+", ""), rf"(?i)^\s*{_LABEL}\s*:", 1).try_cast("int")
    no = F.coalesce(number_of(F.col("speaker")), number_of(F.col("label")), inside)
    name = lambda c: F.when(number_of(F.col(c)).isNull() & F.col(c).rlike(r"\p{L}"), F.trim(c))
    s = s.select("stem", "pt", "ord", "start_s", "end_s", no.alias("no"), F.coalesce(name("label"), name("speaker")).alias("name"), clean(F.col("text")).alias("text"))
    # of several deliveries the one that tells most, as a whole
    most = F.struct(F.col("no").isNotNull(), F.col("name").isNotNull(), F.col("start_s").isNotNull(), F.col("end_s").isNotNull(), "text", "no", "name", "start_s", "end_s")
    s = s.groupBy("stem", "pt", "ord").agg(F.max_by(F.struct("start_s", "end_s", "no", "name", "text"), most).alias("x")).select("stem", "pt", "ord", "x.*")
    s = written(s, "segments")
    pairs = s.where("name is not null").groupBy("stem", "pt", "name", "no").agg(F.count("*").alias("n"))
    part = pairs.groupBy("stem", "pt").agg(
        F.collect_list(F.when(F.col("no").isNotNull(), F.struct("name", "no", "n"))).alias("seen"), F.collect_set("name").alias("names")
    )
    of = part.select("stem", "pt", F.explode(_numbers("seen", "names")).alias("x")).select("stem", "pt", F.col("x.name").alias("name"), F.col("x.no").alias("named"))
    s = s.join(of, ["stem", "pt", "name"], "left")
    return s.select("stem", "pt", "ord", "start_s", "end_s", F.coalesce("no", "named").alias("no"), "text")


def isotonic(y: np.ndarray) -> np.ndarray:
    """Least squares non-decreasing fit (pool adjacent violators)."""
    mean, size = [], []
    for v in y:
        mean.append(float(v))
        size.append(1)
        while len(mean) > 1 and mean[-2] > mean[-1]:
            m, n = mean.pop(), size.pop()
            mean[-1] = (mean[-1] * size[-1] + m * n) / (size[-1] + n)
            size[-1] += n
    return np.repeat(mean, size)


def clock_and_shift(start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start times with resets added up, gaps interpolated and disorder levelled; and what resets add to each row. All unknown stays unknown."""
    known = np.flatnonzero(~np.isnan(start))
    if not len(known):
        return start, np.zeros(len(start))
    t, shift, add, last = start.astype(float).copy(), np.zeros(len(start)), 0.0, None
    for i in known:
        if last is not None and start[i] < last - RESET_S and start[i] < RESET_S:
            add += last
            shift[i:] = add
        last = start[i]
        t[i] += add
    t[known] = isotonic(t[known])
    return np.interp(np.arange(len(t)), known, t[known]), shift


def clock(start: np.ndarray) -> np.ndarray:
    """The start times of :func:`clock_and_shift`."""
    return clock_and_shift(start)[0]


_TIMES = T.StructType([T.StructField("stem", T.StringType()), T.StructField("pt", T.IntegerType()), T.StructField("ord", T.IntegerType()), T.StructField("start_s", T.DoubleType()), T.StructField("end_s", T.DoubleType())])


def _clocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (stem, pt, ord, start_s, end_s), each part in one task and in order, with the clock of the whole part; ends are not before starts."""
    held: list[tuple] = []

    def part() -> pa.RecordBatch:
        stem, pt, order, start, end = zip(*held)
        at, shift = clock_and_shift(np.array(start, dtype=float))
        end = np.array(end, dtype=float) + shift
        end = np.where(np.isnan(end), at, np.fmax(end, at))
        return pa.RecordBatch.from_arrays([pa.array(stem, pa.string()), pa.array(pt, pa.int32()), pa.array(order, pa.int32()), pa.array(at, pa.float64()), pa.array(end, pa.float64())], names=_TIMES.names)

    for b in batches:
        done = []
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and row[:2] != held[-1][:2]:
                done.append(part())
                held = []
            held.append(row)
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if held:
        yield part()


_TURN = T.StructType(
    [T.StructField("stem", T.StringType()), T.StructField("pt", T.IntegerType()), T.StructField("first_ord", T.IntegerType()), T.StructField("last_ord", T.IntegerType()), T.StructField("speaker_no", T.IntegerType())]
    + [T.StructField("start_s", T.DoubleType()), T.StructField("end_s", T.DoubleType()), T.StructField("text", T.StringType()), T.StructField("edge", T.BooleanType()), T.StructField("task", T.LongType()), T.StructField("k", T.IntegerType())]
)


_ARROW = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.string(), pa.bool_(), pa.int64(), pa.int32()]
_SPOKEN = re.compile(r"\w")


def _part_turns(rows: list[tuple], first: bool, last: bool, task: int) -> list[tuple]:
    """Turns of the rows (stem, pt, ord, start_s, end_s, no, text) of one part within a task. Those that rows of other tasks may touch are marked as edges."""
    stem, pt = rows[0][:2]
    out: list[list] = []
    for _, _, o, at, stop, no, text in rows:
        if text is None or not _SPOKEN.search(text):
            continue
        if out and (no is None or no == out[-1][4]):
            x = out[-1]
            x[3], x[6] = o, max(x[6], stop)
            x[7].append(text)
        else:
            out.append([stem, pt, o, o, no, float(at), float(stop), [text]])
    turns = []
    for k, x in enumerate(out):
        # the first, the one after a first without speaker, and the last
        edge = (first and (k == 0 or (k == 1 and out[0][4] is None))) or (last and k == len(out) - 1)
        turns.append((*x[:7], " ".join(x[7]), edge, task, k))
    return turns


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get().partitionId()
    held: list[tuple] = []
    first = True

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], names=_TURN.names)

    for b in batches:
        done: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if held and (row[0] != held[-1][0] or row[1] != held[-1][1]):
                done += _part_turns(held, first, False, task)
                held, first = [], False
            held.append(row)
        if done:
            yield batch(done)
    if held and (done := _part_turns(held, first, True, task)):
        yield batch(done)


def _joined(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Put the edge turns, in order, together where they continue each other."""
    out: list[dict] = []
    for pdf in parts:
        for x in pdf.to_dict("records"):
            p = out[-1] if out else None
            no = None if pd.isna(x["speaker_no"]) else int(x["speaker_no"])
            near = p is not None and (p["stem"], p["pt"]) == (x["stem"], x["pt"]) and (x["task"] != p["task"] or x["k"] == p["k"] + 1)
            if near and (no is None or no == p["speaker_no"]):
                p |= {"last_ord": x["last_ord"], "end_s": max(p["end_s"], x["end_s"]), "text": f"{p['text']} {x['text']}", "task": x["task"], "k": x["k"]}
            else:
                out.append(x | {"speaker_no": no})
    frame = pd.DataFrame(out, columns=_TURN.names)
    frame["speaker_no"] = frame["speaker_no"].astype("Int32")
    yield frame


def turns(segments: DataFrame) -> DataFrame:
    """(stem, pt, first_ord, last_ord, speaker_no, start_s, end_s, text): the longest runs of speech by one speaker.

    Segments without speech are left out and interrupt nothing. A segment with no speaker goes on
    with the one before; speaker_no is null only before the first known speaker of a part.
    """
    rows = written(cleaned(segments), "clean")
    times = rows.select(*_TIMES.names).repartition("stem", "pt").sortWithinPartitions("stem", "pt", "ord").mapInArrow(_clocked, _TIMES)
    rows = rows.drop("start_s", "end_s").join(times, ["stem", "pt", "ord"]).select(*_TIMES.names, "no", "text")
    rows = rows.repartitionByRange("stem", "pt", "ord").sortWithinPartitions("stem", "pt", "ord")
    found = written(rows.mapInArrow(_turns, _TURN), "turns")
    # at most three turns a task: the number of tasks bounds what comes together here
    edges = found.where("edge").coalesce(1).sortWithinPartitions("stem", "pt", "first_ord").mapInPandas(_joined, _TURN)
    return found.where("not edge").unionByName(edges).drop("edge", "task", "k")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(read(spark, sf_dir, "segments")).select("stem", "pt", "first_ord", "last_ord", "speaker_no")


def p7_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(read(spark, sf_dir, "segments"))


def queries() -> dict:
    return {"p7_found": p7_found, "p7_turns": p7_turns}


def oracle_sql() -> dict[str, str]:
    return {}
