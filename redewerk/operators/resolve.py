"""Anonymous labels to persons: tiers that each leave alone what an earlier tier fixed."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..functions.similarity import token_set, token_set_ratio
from ..session import kept
from .pairing import best_assignment
from .people import canonical_name

# --- fixed values: cues of the chair, and of a speaker introducing themselves -------------
CUE = (
    r"(?iU)(das wort|hat das wort|spricht für|spricht jetzt|erteile|rufe|bitten|\bbitte\b|am mikrofon|das wort geht an|übergeben|"
    r"fortsetzen|fort\.|setzen die aussprache)"
)
DEFER = r"(?iU)(\bsie\b|\bihnen\b|noch mal|nochmal|auf meiner liste|wir sammeln|sammeln wir|der reihe nach)"
INTRODUCED = r"(?i:mein name ist|ich heiße|ich heisse|ich bin)\s+([A-ZÄÖÜ][\p{L}\p{N}_.\-']*(?:\s+(?:[A-ZÄÖÜ][\p{L}\p{N}_.\-']*|von|van|de|der|zu))*)"
TEXT_CAP = 6000
MAX_UNRESOLVED_SENTENCES = 12


def introductions(turns: DataFrame, people: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, key, method, score): the first turn in which a label names itself with a surname of one bearer."""
    t = turns.select(*keys, "turn_ix", "label", F.posexplode(F.regexp_extract_all("text", F.lit(INTRODUCED), F.lit(1))).alias("k", "name"))
    _, surname = canonical_name(F.regexp_replace("name", r"\.$", ""))
    t = t.select(*keys, "turn_ix", "k", "label", surname.alias("surname")).join(people.where("n_same = 1").select(*keys, "surname", "key"), [*keys, "surname"])
    return t.groupBy(*keys, "label").agg(F.min_by("key", F.struct("turn_ix", "k")).alias("key")).select(*keys, "label", "key", F.lit("self-intro").alias("method"), F.lit(1.0).alias("score"))


def handoffs(turns: DataFrame, keys: list[str]) -> DataFrame:
    """Turns followed by another label, with a cue and no deferral: keys, turn_ix, text, next_label."""
    w = W.partitionBy(*keys).orderBy("turn_ix")
    t = turns.withColumn("next_label", F.lead("label").over(w))
    return t.where(F.col("next_label").isNotNull() & (F.col("next_label") != F.col("label")) & F.col("text").rlike(CUE) & ~F.col("text").rlike(DEFER))


def chair_votes(turns: DataFrame, people: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, key, votes): for the label after a hand-off, the person whose surname stands last in it."""
    h = handoffs(turns, keys).select(*keys, "turn_ix", "next_label", F.posexplode(F.split(F.lower("text"), r"[^\p{L}\p{N}_\-]+")).alias("pos", "surname"))
    # surnames are single words: an equi-join instead of a search for each
    # persons without session are known to all sessions
    on = [*[k for k in keys if k in people.columns], "surname"]
    hit = h.join(people.where("n_same = 1 and length(surname) >= 3").select(*on, "key"), on).groupBy(*keys, "turn_ix", "next_label").agg(F.max_by("key", "pos").alias("key"))
    return hit.groupBy(*keys, F.col("next_label").alias("label"), "key").agg(F.count("*").alias("votes"))


def vote_winners(votes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, key, score, conflict): the person of the most votes; a tie for the first place has no winner."""
    w = W.partitionBy(*keys, "label").orderBy(F.col("votes").desc(), "key")
    v = votes.withColumn("rn", F.row_number().over(w)).withColumn("second", F.lead("votes").over(w))
    v = v.where("rn = 1 and (second is null or votes > second)")
    return v.select(*keys, "label", "key", F.col("votes").cast("double").alias("score"), F.col("second").isNotNull().alias("conflict"))


def cue_counts(turns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, cues): turns with a cue, the last turn of a session not counted."""
    w = W.partitionBy(*keys).orderBy("turn_ix")
    t = turns.withColumn("_next", F.lead("turn_ix").over(w)).where("_next is not null").where(F.col("text").rlike(CUE))
    return t.groupBy(*keys, "label").agg(F.count("*").alias("cues"), F.min("turn_ix").alias("first_ix"))


def chair_zip(counts: DataFrame, chairs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, key, method, score): busiest unresolved labels (two cues or more) with the free chairs, rank by rank."""
    c = counts.where("cues >= 2").join(done.select(*keys, "label"), [*keys, "label"], "left_anti")
    c = c.withColumn("r", F.row_number().over(W.partitionBy(*keys).orderBy(F.col("cues").desc(), "first_ix")))
    p = chairs.join(done.select(*keys, "key"), [*keys, "key"], "left_anti")
    p = p.withColumn("r", F.row_number().over(W.partitionBy(*keys).orderBy("rank")))
    return c.join(p, [*keys, "r"]).select(*keys, "label", "key", F.lit("chair-vorsitz").alias("method"), F.col("cues").cast("double").alias("score"))


def content_scores(turns: DataFrame, body: DataFrame, people: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, rank, person, score): what a label says against the sentences that name a person, both capped."""
    # a running length leaves out what the cap would cut anyway, before turns are brought together
    w = W.partitionBy(*keys, "label").orderBy("turn_ix").rowsBetween(W.unboundedPreceding, -1)
    head = turns.withColumn("_before", F.coalesce(F.sum(F.length("text") + 1).over(w), F.lit(0))).where(F.col("_before") <= TEXT_CAP)
    said = head.groupBy(*keys, "label").agg(F.array_sort(F.collect_list(F.struct("turn_ix", "text"))).alias("ts"), F.min("turn_ix").alias("rank"))
    said = said.select(*keys, "label", "rank", F.substring(F.array_join(F.transform("ts", lambda x: F.concat(F.lit(" "), x["text"])), ""), 1, TEXT_CAP).alias("said"))
    said = said.where(F.trim("said") != "").join(done.select(*keys, "label"), [*keys, "label"], "left_anti")
    sent = body.select(*keys, F.posexplode(F.split("body", r"(?<=[.!?])\s+")).alias("pos", "s"))
    word = sent.select(*keys, "pos", "s", F.explode(F.array_distinct(F.split(F.lower("s"), r"[^\p{L}\p{N}_\-]+"))).alias("surname"))
    p = people.where("n_same = 1").select(*keys, "surname", F.col("key").alias("person")).join(done.select(*keys, F.col("key").alias("person")), [*keys, "person"], "left_anti")
    ref = word.join(p, [*keys, "surname"]).groupBy(*keys, "person").agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("ss"))
    ref = ref.select(*keys, "person", F.substring(F.array_join(F.transform("ss", lambda x: x["s"]), " "), 1, TEXT_CAP).alias("ref"))
    return said.join(ref, keys).select(*keys, "label", "rank", "person", token_set_ratio("said", "ref").alias("score"))


def content_matched(scores: DataFrame, keys: list[str], threshold: float = 75.0) -> DataFrame:
    m = best_assignment(scores, keys, threshold)
    return m.select(*keys, "label", F.col("person").alias("key"), F.lit("content").alias("method"), F.round("score", 1).alias("score"))


def resolved(
    turns: DataFrame, people: DataFrame, chairs: DataFrame, body: DataFrame | None, keys: list[str], threshold: float = 75.0, minutes: DataFrame | None = None, build=None, answers: DataFrame | None = None,
) -> DataFrame:
    """(keys, label, key, method, score): the tiers one after the other; none changes what an earlier one fixed.

    body: minutes for the content tier. minutes (keys, top, section) and build (a model) add the tier by items, answers the one by the transcript.
    """
    cols = [*keys, "label", "key", "method", "score"]
    # each tier reads what the earlier ones fixed: small tables, made once
    done = kept(introductions(turns, people, keys).select(*cols))
    won = vote_winners(chair_votes(turns, people, keys), keys).withColumn("method", F.lit("chair")).select(*cols)
    done = kept(done.unionByName(won.join(done.select(*keys, "label"), [*keys, "label"], "left_anti")))
    done = kept(done.unionByName(chair_zip(cue_counts(turns, keys), chairs, done, keys).select(*cols)))
    if body is not None:
        done = kept(done.unionByName(content_matched(content_scores(turns, body, people, done, keys), keys, threshold).select(*cols)))
    if minutes is not None and build is not None:
        done = kept(done.unionByName(protocol_tier(turns, minutes, people, done, keys, build).select(*cols)))
    if answers is not None:
        done = kept(done.unionByName(transcript_tier(turns, people, done, answers, keys).select(*cols)))
    return done


def snapped(answers: DataFrame, people: DataFrame, done: DataFrame, keys: list[str], threshold: float = 85.0, new: bool = False) -> DataFrame:
    """(keys, label, key) of the named labels (keys, label, name), by label: the free person (keys, key, full) of the same canonical key, else the free one of the highest token-set similarity from the threshold on.

    new: a name that fits no person is a person of its own, unless taken. Persons of ``done`` are taken. One session's names and persons come together.
    """
    key, _ = canonical_name(F.col("name"))
    a = answers.select(*keys, F.lit(0).alias("_side"), "label", F.col("name").alias("full"), key.alias("key")).distinct()
    p = people.select(*keys, F.lit(1).alias("_side"), F.lit("").alias("label"), "full", "key").join(done.select(*keys, "key"), [*keys, "key"], "left_anti").select(*a.columns)
    taken = done.select(*keys, F.lit(2).alias("_side"), F.lit("").alias("label"), F.lit("").alias("full"), "key")
    schema = answers.select(*keys, "label").schema.add("key", T.StringType())

    def claim(pdf: pd.DataFrame) -> pd.DataFrame:
        free = dict(sorted(zip(pdf[pdf["_side"] == 1]["key"], pdf[pdf["_side"] == 1]["full"])))
        used, out = set(pdf[pdf["_side"] == 2]["key"]), []
        for r in pdf[pdf["_side"] == 0].sort_values(["label", "key"]).itertuples(index=False):
            hit = r.key if r.key in free else None
            if hit is None and free:
                best = max(free, key=lambda k: token_set(r.full.lower(), free[k].lower()))
                hit = best if token_set(r.full.lower(), free[best].lower()) >= threshold else None
            if hit is None and new and r.key and r.key not in used:
                hit = r.key
            if hit is not None:
                free.pop(hit, None)
                used.add(hit)
                out.append((*(getattr(r, k) for k in keys), r.label, hit))
        return pd.DataFrame(out, columns=schema.names)

    return a.unionByName(p).unionByName(taken).groupBy(*keys).applyInPandas(claim, schema)


def transcript_prompts(turns: DataFrame, done: DataFrame, keys: list[str], said_cap: int = 1500) -> DataFrame:
    """(keys, prompt): of each session with unresolved labels what these say (turns until the cap is reached), and what was said before them; asks who they are.

    The answer is ``{label: {"name", "role", "confidence"}}``.
    """
    t = turns.where("trim(coalesce(text, '')) <> ''").join(done.select(*keys, "label"), [*keys, "label"], "left_anti")
    w = W.partitionBy(*keys, "label").orderBy("turn_ix")
    t = t.withColumn("_before", F.coalesce(F.sum(F.length("text") + 1).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).where(F.col("_before") <= said_cap)
    said = t.groupBy(*keys, "label").agg(F.array_sort(F.collect_list(F.struct("turn_ix", "text"))).alias("ts")).select(*keys, "label", F.array_join(F.transform("ts", lambda x: x["text"]), " ").alias("said"))
    before = handoff_context(turns, keys).select(*keys, "label", F.array_join("contexts", " … ").alias("before"))
    line = F.concat(F.lit("["), F.col("label"), F.lit("] "), F.col("said"), F.coalesce(F.concat(F.lit("\n  davor: "), F.nullif("before", F.lit(""))), F.lit("")))
    g = said.join(before, [*keys, "label"], "left").groupBy(*keys).agg(F.array_sort(F.collect_list(line)).alias("ls"))
    ask = "Wer spricht? Nur Namen, die im Transkript fallen. Nur JSON {Label: {name, role, confidence: certain oder unsure}}."
    return g.select(*keys, F.concat(F.lit(ask + "\n\n"), F.array_join("ls", "\n")).alias("prompt"))


def transcript_tier(turns: DataFrame, people: DataFrame, done: DataFrame, answers: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, label, key, method, score) of the labels that a model names for certain from the transcript: persons of the directory or new ones. answers: table (prompt_hash, response)."""
    from .providers import asked, certain

    named = certain(asked(transcript_prompts(turns, done, keys), "prompt", answers)).select(*keys, "label", "name")
    named = named.join(done.select(*keys, "label"), [*keys, "label"], "left_anti")
    return snapped(named, people, done, keys, new=True).select(*keys, "label", "key", F.lit("transcript-llm").alias("method"), F.lit(1.0).alias("score"))


def protocol_prompt(top: int, said: dict[str, str], section: str, candidates: list[str], known: dict[str, str]) -> str:
    """Asks which of the candidates the open labels of an item are, by the minutes; answer ``{label: {"name", "confidence"}}``."""
    return "\n".join([
        f"Wer spricht zu TOP {top}? Nur JSON {{Label: {{name, confidence: certain oder unsure}}}}.", "", "PROTOKOLL:", section[:8000], "", "BEKANNT: " + "; ".join(f"{a}={b}" for a, b in sorted(known.items())), "",
        *(f"[{label}] {text[:2500]}" for label, text in sorted(said.items())), "", "NAMEN: " + "; ".join(candidates),
    ])


def protocol_tier(turns: DataFrame, minutes: DataFrame, people: DataFrame, done: DataFrame, keys: list[str], build) -> DataFrame:
    """(keys, label, key, method, score): a model is asked item by item, by the minutes' section (keys, top, section), for the labels still open; ends when none is.

    Each answer narrows the next question, so one session is asked by one task, which holds its capped texts.
    """
    from .providers import NO_NAME, json_answer

    t = turns.where("top is not null and trim(coalesce(text, '')) <> ''").groupBy(*keys, "top", "label").agg(F.array_sort(F.collect_list(F.struct("turn_ix", F.substring("text", 1, 2500).alias("text")))).alias("ts"))
    t = t.select(*keys, "top", "label", F.substring(F.array_join(F.transform("ts", lambda x: x["text"]), " "), 1, 2500).alias("said"))
    t = t.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("top", "label", "said"))).alias("ts"))
    m = minutes.groupBy(*keys).agg(F.collect_list(F.struct("top", F.substring("section", 1, 8000).alias("section"))).alias("ms"))
    p = people.groupBy(*keys).agg(F.array_sort(F.collect_set(F.struct("key", "full"))).alias("ps"))
    d = done.groupBy(*keys).agg(F.collect_list(F.struct("label", "key")).alias("ds"))
    rows = t.join(m, keys, "left").join(p, keys).join(d, keys, "left")
    schema = rows.select(*keys).schema.add("label", T.StringType()).add("key", T.StringType()).add("method", T.StringType()).add("score", T.DoubleType())

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = build()
        for pdf in parts:
            out = []
            for r in pdf.to_dict("records"):
                full = {x["key"]: x["full"] for x in r["ps"]}
                fixed = {x["label"]: x["key"] for x in (r["ds"] if r["ds"] is not None else ())}
                section = {int(x["top"]): x["section"] for x in (r["ms"] if r["ms"] is not None else ())}
                every = {x["label"] for x in r["ts"]}
                for top in sorted({int(x["top"]) for x in r["ts"]}):
                    said = {x["label"]: x["said"] for x in r["ts"] if x["top"] == top and x["label"] not in fixed}
                    if not said:
                        continue
                    taken = set(fixed.values())
                    free = {k: f for k, f in full.items() if k not in taken}
                    answer = json_answer(model.complete(protocol_prompt(top, said, section.get(top, ""), list(free.values()), {a: full.get(k, k) for a, k in fixed.items()})))
                    for label, info in answer.items():
                        if label in fixed or not isinstance(info, dict) or str(info.get("confidence", "")).lower() != "certain" or str(info.get("name") or "").strip().lower() in NO_NAME or not free:
                            continue
                        name = str(info["name"]).strip().lower()
                        hit = max(free, key=lambda k: (k == name, token_set(name, free[k].lower())))
                        if hit == name or token_set(name, free[hit].lower()) >= 85:
                            fixed[label] = hit
                            free.pop(hit)
                            out.append((*(r[k] for k in keys), label, hit, "llm", 1.0))
                    if every <= set(fixed):
                        break
            yield pd.DataFrame(out, columns=schema.names)

    return rows.mapInPandas(run, schema)


def excluded_items(turns: DataFrame, done: DataFrame, keys: list[str], most: int = MAX_UNRESOLVED_SENTENCES) -> DataFrame:
    """(keys, top): items with a turn of an unresolved label longer than ``most`` sentences. Turns before the first item count for none."""
    t = turns.where(F.col("top").isNotNull() & (F.regexp_count("text", F.lit(r"[.!?]+")) > most))
    return t.join(done.select(*keys, "label"), [*keys, "label"], "left_anti").select(*keys, "top").distinct()


def handoff_context(turns: DataFrame, keys: list[str], chars: int = 300) -> DataFrame:
    """(keys, label, contexts): the last characters of the turns before a label's turns by another label, distinct in order."""
    w = W.partitionBy(*keys).orderBy("turn_ix")
    t = turns.withColumn("before", F.lag("text").over(w)).withColumn("by", F.lag("label").over(w)).where("by is not null and by <> label")
    g = t.groupBy(*keys, "label").agg(F.array_sort(F.collect_list(F.struct("turn_ix", F.right("before", F.lit(chars)).alias("c")))).alias("cs"))
    return g.select(*keys, "label", F.array_distinct(F.transform("cs", lambda x: x["c"])).alias("contexts"))


def session_report(turns: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, resolved, total, labels): the labels of each session with their person, by label."""
    labels = turns.select(*keys, "label").distinct().join(done, [*keys, "label"], "left")
    return labels.groupBy(*keys).agg(
        F.count("key").alias("resolved"), F.count("*").alias("total"), F.array_sort(F.collect_list(F.struct("label", "key", "method", "score"))).alias("labels")
    )
