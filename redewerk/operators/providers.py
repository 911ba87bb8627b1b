"""Steps that need a model or a codec: the interface, a deterministic stand-in, and how a table runs through it.

A provider is built once a Python worker and called with batches; a failure becomes a value
of the row (``error``), never of the job.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Llm(Protocol):
    def complete(self, prompt: str) -> str: ...


class TokenCounter(Protocol):
    def count(self, text: str) -> int: ...


class Converter(Protocol):
    def convert(self, content: bytes, name: str) -> str: ...


class Generator(Protocol):
    def generate(self, system: str, user: str, preset: dict) -> str: ...


class Asr(Protocol):
    def transcribe(self, content: bytes) -> list[tuple[float, float, str]]: ...


class Diariser(Protocol):
    def diarise(self, content: bytes, least: int | None, most: int | None) -> list[tuple[float, float, str]]: ...


# --- fixed values: the two decoding presets --------------------------------------------
PRESETS = {
    "baseline": {"do_sample": False, "repetition_penalty": 1.0, "no_repeat_ngram_size": 0},
    "antirep": {"do_sample": False, "repetition_penalty": 1.1, "no_repeat_ngram_size": 6},
}


class TableLlm:
    """Answers by the hash of the prompt; ``{}`` for others."""

    def __init__(self, answers: dict[str, str]):
        self.answers = answers

    def complete(self, prompt: str) -> str:
        return self.answers.get(hashlib.sha256(prompt.encode()).hexdigest()[:12], "{}")


class Announced:
    """Stands in for a model that places agenda items: at the first turn shown in which ``TOP n`` is said."""

    def complete(self, prompt: str) -> str:
        turns = re.findall(r"(?m)^T(\d+) \[[^\]]*\] (.*)$", prompt)
        items = re.findall(r"(?m)^TOP (\d+):", prompt)
        return json.dumps({n: next((f"T{i}" for i, text in turns if re.search(rf"\bTOP {n}\b", text)), None) for n in items})


class LastClose:
    """Stands in for a model that finds the end of the item before: the last numbered line that begins with ``Damit``."""

    def complete(self, prompt: str) -> str:
        return json.dumps({"last_prev_line": max((int(i) for i in re.findall(r"(?m)^(\d+)\. Damit", prompt)), default=0)})


class InOrder:
    """Stands in for a model that names speakers: the open labels in order are the names in order, for certain."""

    def complete(self, prompt: str) -> str:
        labels = re.findall(r"(?m)^\[([^\]]+)\] ", prompt)
        names = [x for x in prompt.rsplit("NAMEN: ", 1)[-1].split("; ") if x]
        return json.dumps({a: {"name": n, "confidence": "certain"} for a, n in zip(labels, names)}, ensure_ascii=False)


class QuarterTokens:
    """A token for each four characters begun."""

    def count(self, text: str) -> int:
        return -(-len(text) // 4)


class PlainText:
    """Bytes as UTF-8 text with HTML entities resolved; tags stay unless stripped."""

    def __init__(self, strip_tags: bool = False):
        self.strip_tags = strip_tags

    def convert(self, content: bytes, name: str) -> str:
        text = html.unescape(content.decode("utf-8"))
        return re.sub(r"<[^>]+>", "", text) if self.strip_tags else text


class FirstSentences:
    """Stands in for a model: the first sentences of what follows ``Transkript:``."""

    def __init__(self, n: int = 2):
        self.n = n

    def generate(self, system: str, user: str, preset: dict) -> str:
        body = user.split("Transkript:\n", 1)[-1].split("\n\nZusammenfassung:", 1)[0]
        return " ".join(re.split(r"(?<=[.!?])\s+", body.strip())[: self.n])


class SecondsPerLine:
    """Stands in for speech recognition and diarisation: a second for each line ``label: text``."""

    def transcribe(self, content: bytes) -> list[tuple[float, float, str]]:
        return [(float(i), i + 1.0, line.split(":", 1)[-1].strip()) for i, line in enumerate(content.decode("utf-8").splitlines()) if line.strip()]

    def diarise(self, content: bytes, least: int | None = None, most: int | None = None) -> list[tuple[float, float, str]]:
        return [(float(i), i + 1.0, line.split(":", 1)[0].strip()) for i, line in enumerate(content.decode("utf-8").splitlines()) if line.strip()]


def applied(
    rows: DataFrame, inputs: list[str], build: Callable[[], object], call: Callable[..., object], output: T.DataType = T.StringType(), transient: tuple[type[Exception], ...] = (), tries: int = 3, wait_s: float = 1.0,
) -> DataFrame:
    """Adds ``value`` and ``error``: ``call(provider, *inputs)`` of each row.

    An error of a kind in ``transient`` is tried again, up to ``tries`` times with linearly growing waits; any other error, and one
    that stays, becomes the row's error and the batch goes on. If a whole task is lost, Spark runs it again.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("value", output), T.StructField("error", T.StringType())])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        provider = build()

        def one(args: tuple) -> tuple[object, str | None]:
            for k in range(1, tries + 1):
                try:
                    return call(provider, *args), None
                except Exception as e:  # noqa: BLE001
                    if k == tries or not isinstance(e, transient):
                        return None, f"{type(e).__name__}: {e}"
                    time.sleep(wait_s * k)
            return None, "not tried"

        for pdf in parts:
            out = [one(args) for args in zip(*(pdf[c] for c in inputs))]
            yield pdf.assign(value=pd.Series([v for v, _ in out], index=pdf.index, dtype=object), error=pd.Series([e for _, e in out], index=pdf.index, dtype=object))

    return rows.mapInPandas(run, schema)


def asked(rows: DataFrame, prompt: str, answers: DataFrame) -> DataFrame:
    """Adds ``value``: the answer of a table (prompt_hash, response) to each row's prompt, ``{}`` where it has none."""
    from ..functions.text import prompt_hash

    a = answers.select("prompt_hash", "response").dropDuplicates(["prompt_hash"])
    return rows.withColumn("prompt_hash", prompt_hash(F.col(prompt))).join(a, "prompt_hash", "left").withColumn("value", F.coalesce("response", F.lit("{}"))).drop("prompt_hash", "response")


def exit_code(done: DataFrame) -> int:
    """What a run over rows with ``error`` ends with: 0, or 2 if some failed."""
    return 0 if done.where("error is not null").isEmpty() else 2


def context_window(models: dict[str, dict], model: str, default: int = 4096) -> int:
    """The context length in tokens of a model's configuration, that of its text part first; the default where it is not given."""
    own = models.get(model, {})
    sub = own.get("text_config") or own
    return int(sub.get("max_position_embeddings") or own.get("max_position_embeddings") or default)


def prompt_room(limit: int, output: int, least: int = 256) -> int:
    """Tokens left for the prompt beside the output, at least ``least``."""
    return max(least, limit - output)


def json_answer(text: str) -> dict:
    """The object from the first ``{`` to the last ``}``; empty on any failure."""
    m = re.search(r"\{.*\}", text or "", re.DOTALL)
    try:
        out = json.loads(m[0]) if m else {}
        return out if isinstance(out, dict) else {}
    except ValueError:
        return {}


def counted(rows: DataFrame, column: str, build: Callable[[], TokenCounter] | None = None) -> DataFrame:
    """Adds ``seq_tokens``: by the provider, or the estimate of a token for each four characters begun, which needs no Python."""
    if build is None:
        return rows.withColumn("seq_tokens", F.ceil(F.length(F.coalesce(column, F.lit(""))) / 4).cast("int"))
    out = applied(rows, [column], build, lambda p, t: p.count(t or ""), T.IntegerType())
    return out.withColumnRenamed("value", "seq_tokens").drop("error")


def converted(files: DataFrame, build: Callable[[], Converter] = PlainText, least: int = 50) -> DataFrame:
    """Adds ``value`` (text) and ``error``; fewer than ``least`` characters without the blanks around are a failure."""
    out = applied(files, ["content", "path"], build, lambda p, c, n: p.convert(bytes(c), n))
    short = F.length(F.trim("value")) < least
    return out.withColumn("error", F.coalesce("error", F.when(F.coalesce(short, F.lit(True)), F.lit("too short")))).withColumn("value", F.when(F.col("error").isNull(), F.col("value")))


# --- fixed values: what a model answers where it knows no name ------------------------------------
NO_NAME = ["", "null", "none", "unbekannt"]


def certain(answers: DataFrame, response: str = "value") -> DataFrame:
    """One row for each label of an answer ``{label: {"name", "confidence", "role"}}`` whose confidence is ``certain`` and which gives a name: columns label, name and role added.

    What is no object, or another shape, gives no rows.
    """
    shape = "map<string, struct<name: string, confidence: string, role: string>>"
    a = answers.select("*", F.explode(F.from_json(F.regexp_extract(response, r"(?s)\{.*\}", 0), shape)).alias("label", "_a"))
    role = F.trim(F.coalesce("_a.role", F.lit("")))
    a = a.where((F.lower("_a.confidence") == "certain") & ~F.lower(F.trim("_a.name")).isin(NO_NAME))
    return a.withColumn("name", F.trim("_a.name")).withColumn("role", F.when(F.lower(role).isin(NO_NAME), F.lit("")).otherwise(role)).drop("_a")


def accepted_placements(answers: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, top, turn_ix) from answers in item order: turns must not fall. A window by item over a session's answers."""
    from pyspark.sql import Window as W

    before = F.coalesce(F.max("turn_ix").over(W.partitionBy(*keys).orderBy("top").rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    return answers.where("turn_ix is not null").withColumn("_b", before).where("turn_ix >= _b").drop("_b")


def summarised(sections: DataFrame, system: str, build: Callable[[], Generator] = FirstSentences, preset: str = "baseline") -> DataFrame:
    """(stem, summary) from (stem, top, title, text): one call an item in order; a heading is added where the answer has none. Rows with null top are whole documents without heading."""
    from .dataset import user_message

    s = sections.withColumn("user", user_message(F.coalesce("title", F.concat(F.lit("TOP "), F.col("top").cast("string")), F.lit("TOP 1")), F.col("text")))
    out = applied(s.select("stem", "top", "user"), ["user"], build, lambda p, u: p.generate(system, u, PRESETS[preset]))
    has = F.col("value").rlike(r"(?im)^##\s*Zu\s+TOP\s*\d+") | F.col("top").isNull()
    body = F.when(has, F.col("value")).otherwise(F.concat(F.lit("## Zu TOP "), F.col("top").cast("string"), F.lit("\n\n"), F.col("value")))
    g = out.withColumn("body", F.coalesce(body, F.lit(""))).groupBy("stem").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("top", F.lit(0)).alias("top"), "body"))).alias("bs"))
    return g.select("stem", F.array_join(F.transform("bs", lambda b: b["body"]), "\n\n").alias("summary"))


def decoded_segments(tokens: list[tuple[str, float | None]], offset: float = 0.0, window: float = 30.0) -> tuple[list[tuple[float, float, str]], float]:
    """Segments of one decoded window of (text, timestamp or None), and how far to go on.

    Text between two timestamps is a segment. A window that ends in an open segment goes on from
    its beginning; one that would not advance goes on by its whole length.
    """
    out, start, words = [], None, []
    for text, at in tokens:
        if at is None:
            words.append(text)
        elif start is None:
            start, words = at, []
        else:
            if "".join(words).strip():
                out.append((offset + start, offset + at, "".join(words).strip()))
            start, words = None, []
    advance = start if start is not None and start > 0 else window
    if start is not None and "".join(words).strip() and advance == window:
        out.append((offset + start, offset + window, "".join(words).strip()))
    return out, offset + advance
