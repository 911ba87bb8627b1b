"""Problem 6: broken prompt and response pairs.

Copies show in the size of the response compressed with its prompt as zstandard
dictionary; empty answers, refusals and foreign languages by dictionaries; truncation by a
model of terminal contexts: how often, over all different responses, a last word is the end of one,
responses that come to the same end (near copies) counting once.
"""

from __future__ import annotations

import re

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import ROLE_ASSISTANT, ROLE_USER, content_of, read, written
from .names import distance

#: A response that its prompt compresses to this part of its own compressed size is a copy.
COPY_AT = 0.4
#: Fewer bytes tell nothing about copying.
LEAST_BYTES = 60
#: To be a terminal, a last word must end a response in this share of its occurrences, so many times,
#: and end this share of all different responses (so there are at most 1 / OF_ALL terminals).
TERMINAL_SHARE, TERMINAL_TIMES, OF_ALL = 0.3, 3, 0.005
#: Words before the last one that tell near copies: a word in COPY_SHARE of the responses with the same last word
#: is of their common text, and a response of which these make up COPY_SHARE is one of the copies.
BEFORE, COPY_SHARE = 40, 0.5
#: A word after which a lower case word or a number stands in this share of its occurrences, so many times, ends no sentence.
GOES_ON_SHARE, GOES_ON_TIMES = 0.3, 3
#: German has at least this share of its function words, or of capitals within sentences; shorter texts tell nothing.
GERMAN_SHARE, LEAST_WORDS = 0.15, 6
#: Other languages have at least this share of short words that are no German function words.
OTHER_SHARE = 0.1

# --- fixed values: what stands for an empty answer (folded) ---------------------------
STANDINS = {"leer", "kein text", "keine angabe", "k a", "n a", "na", "entfällt", "none", "null", "empty", "no text", "tbd", "todo", "ohne inhalt", "brak", "geen"}
# --- fixed values: offices that sign minutes ("gez. Schriftführung") --------------------
SIGNED_BY = ["schriftführung", "schriftführer", "schriftführerin", "protokollführung", "protokollführer", "protokollführerin", "vorsitz", "vorsitzender", "vorsitzende"]
# --- fixed values: first person ways to say that something can't or won't be done, by language ---------
DECLINES = [
    r"\bich (?:\S+ ){0,3}?(?:kann|könnte|möchte|darf|werde|will|muss)\b|\b(?:kann|könnte|möchte|darf|werde|will|muss) ich\b|\bich bin (?:leider )?(?:nicht|außerstande)|\bes ist mir (?:leider )?nicht|\bich (?:lehne|verweigere)|\btut mir leid|\bbedau(?:re|ere)|\bwir können\b",
    r"\b(?:i|we) (?:\S+ )?(?:can ?not|can't|won't|will not|must decline|have to decline|refuse|am unable|are unable|am not able|am not allowed)|\bi('m| am) (?:\S+ )?(?:sorry|unable|not able|afraid)|\b(?:unable|not able) to\b",
    r"\bnie (?:mogę|jestem w stanie|wolno mi)|\bmuszę odmówić|\bprzykro mi|\bprzepraszam", r"\b(?:ik kan|kan ik|ik mag|mag ik|ik wil)\b|\bhet spijt me", r"\bje (?:ne peux|ne suis|refuse|dois refuser)|\bdésolée?",
    r"\bno (?:puedo|me es posible)|\blo siento", r"\bnon (?:posso|sono in grado)|\bmi dispiace", r"\bnão posso|\blamento", r"\bnemohu|\bomlouvám se", r"\bjag kan (?:tyvärr )?inte", r"\bjeg kan (?:desværre |dessverre )?ikke",
]
# --- fixed values: words for what is asked of the one who answers (beginnings, or within a word after +) ------
TASKS = [
    "+zusammenfass", "+zusammenzufass", "helf", "behilflich", "bearbeit", "erstell", "verfass", "beantwort", "anfrage", "aufgabe", "diesen text", "diesem text", "diesen inhalt", "diesem inhalt", "angaben mach", "niederschrift", "nachkomm", "ablehn", "zugriff",
    "help", "assist", "request", "summar", "comply", "provide", "process", "answer", "transcript", "content", "streszcz", "pomóc", "prośb", "zadani", "odpowied", "samenvat", "helpen", "verzoek", "résum", "aider", "demande", "resum", "ayudar", "solicitud",
    "riassum", "aiutar", "richiest", "ajudar", "pedido", "shrn", "pomoci", "žádost", "sammanfatt", "hjälpa", "opsummer", "oppsummer", "hjælpe", "hjelpe",
]
# --- fixed values: what only a machine that declines says of itself ----------------------------------
MACHINE = [r"\bals (?:ki|künstliche intelligenz|sprachmodell)\b", r"\bübersteigt meine (?:möglichkeiten|fähigkeiten)", r"\bas an? (?:ai|artificial intelligence|language model)\b", r"\bjako (?:model językowy|sztuczna inteligencja|jazykový model)", r"\bals taalmodel\b", r"\ben tant qu[e'] ?(?:ia|intelligence artificielle|modèle de langage)", r"\bcomo modelo de (?:lenguaje|linguagem)", r"\bcome modello linguistico"]
# --- fixed values: negations that make a way to decline one ------------------------------------------
NEGATIONS = r"\b(?:nicht|kein\w*|außerstande|ablehn\w*|abzulehnen|lehne|verweiger\w*|übersteigt|not|cannot|can't|won't|unable|decline|refuse|nie|odmówić|niet|geen|pas|refus\w*|no|non|não|nemohu|inte|ikke)\b|n't\b"
# --- fixed values: frequent function words of the languages -----------------------------
FUNCTION_WORDS = {
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sei werde hätten wurde sodass ab kein keine laut habe ihr wir ich".split(),
    "en": "the of and to in that is was for it with as on be at by this had not are but from or have an they which one were all their there been has would will more no if out so said what its about than into them can only other the should".split(),
    "nl": "de het een van en in is dat op te zijn met voor niet aan er om ook als dan maar bij of uit nog worden door naar heeft tot zal werd wel over hij ze wij geen meer deze kost moet wordt uit".split(),
    "pl": "i w na z do się nie że jest to o jak ale po co tak za od przez przy dla są był była było który która tylko jego już lub oraz ponieważ będzie zgłosili więcej ma prosi temat około".split(),
    "fr": "le la les de des et en un une du dans que qui pour pas sur est par au avec ce il sont plus ne se".split(),
    "es": "el la los de y en que un una del por con para las no se al lo es más como su".split(),
}
_OF_WORD: dict[str, set[str]] = {}
for _lang, _ws in FUNCTION_WORDS.items():
    for _w in _ws:
        _OF_WORD.setdefault(_w, set()).add(_lang)
_GERMAN = frozenset(FUNCTION_WORDS["de"])
_DECLINE, _MACHINE, _NEGATION = re.compile("|".join(DECLINES)), re.compile("|".join(MACHINE)), re.compile(NEGATIONS)
_TASK = re.compile("|".join(re.escape(t[1:]) if t[0] == "+" else r"\b" + re.escape(t) for t in TASKS))
_QUOTED = re.compile(r"„[^“”\"]*[“”\"]|»[^«]*«|\"[^\"]*\"")
_SENTENCE = re.compile(r"(?<=[.!?;])\s+")
_SIGNED = re.compile(rf"\n\s*gez\.\s+({'|'.join(SIGNED_BY)})\s*$")
_HEADING = re.compile(r"(?m)^\s*#{1,6}\s.*$")


def body(text: str | None) -> str:
    """The response without headings."""
    return _HEADING.sub("", text or "").strip()


def is_empty(text: str | None) -> bool:
    """Nothing said beyond a heading or a stand-in."""
    words = re.findall(r"[^\W_]+", body(text).lower())
    return not words or " ".join(words) in STANDINS


def is_refusal(text: str) -> bool:
    """Whether a sentence outside quotations, wherever it stands, declines in the first person what is asked of the one who answers.

    To decline something else ("ich kann dem Antrag nicht zustimmen") is speech.
    """
    b = _QUOTED.sub(" ", re.sub(r"\s+", " ", body(text)).replace("’", "'")).lower()
    if not (_MACHINE.search(b) or _DECLINE.search(b)):
        return False
    for s in _SENTENCE.split(b):
        if _NEGATION.search(s) and (_MACHINE.search(s) or (_DECLINE.search(s) and _TASK.search(s))):
            return True
    return False


def folded_words(text: str) -> str:
    return " ".join(re.findall(r"[^\W_]+", text.lower()))


def copy_ratio(response: str, prompt: str | None) -> float:
    """Compressed size with the prompt as dictionary against without. 1 if there is no prompt.

    Of fewer than LEAST_BYTES, which compress to no less, only the whole request or one of its lines but the title is a copy (0).
    """
    raw = response.encode()
    if not prompt or not prompt.strip():
        return 1.0
    if len(raw) < LEAST_BYTES:
        own = folded_words(response)
        lines = [x for x in prompt.split("\n") if not x.startswith("TOP:")]
        return 0.0 if own and own in {folded_words(x) for x in (prompt, *lines)} else 1.0
    known = zstandard.ZstdCompressionDict(prompt.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return len(zstandard.ZstdCompressor(level=3, dict_data=known).compress(raw)) / len(zstandard.ZstdCompressor(level=3).compress(raw))


def is_german(text: str) -> bool:
    """Whether the body is German, or too short to tell.

    No German has few German function words, few capitals within sentences (German nouns) and other short words,
    whichever language it is in; or more function words of another listed language than German ones.
    """
    b = body(text)
    tokens = re.findall(r"[^\W\d_]+", b)
    if len(tokens) < LEAST_WORDS:
        return True
    score: dict[str, float] = {}
    for w in tokens:
        own = _OF_WORD.get(w.lower(), ())
        for lang in own:
            score[lang] = score.get(lang, 0.0) + 1 / len(own)
    known = sum(w.lower() in _GERMAN for w in tokens) / len(tokens)
    inner = re.findall(r"(?<=[^\W\d_][ ,])[ ]?[^\W\d_]+", b)
    capitals = sum(w.strip()[0].isupper() for w in inner) / max(1, len(inner))
    short = sum(len(w) <= 3 and w.islower() and w not in _GERMAN for w in tokens) / len(tokens)
    if known < GERMAN_SHARE and capitals < GERMAN_SHARE and short >= OTHER_SHARE:
        return False
    return known >= GERMAN_SHARE or max(score.values(), default=0.0) < 2 or max(score, key=lambda k: (score[k], k == "de")) == "de"


def last_word(text: str) -> str:
    """Last blank-separated word with digits as 0, lower case."""
    parts = text.split()
    return re.sub(r"\d", "0", parts[-1].lower()) if parts else ""


def ends_well(word: str, terminals: frozenset[str], goes_on: bool = False) -> bool:
    """A terminal of the model (up to two misread characters in a long one), or a word of letters with the end of a sentence that is no abbreviation (goes_on)."""
    core = word.rstrip("“”\"')]»*_ ")
    if core[-1:] in {".", "!", "?"} and len(re.sub(r"[\W\d_]", "", core)) >= 3 and not goes_on:
        return True
    return word in terminals or any(len(t) >= 8 and distance(word, t, 2) <= 2 for t in terminals)


def defect(response: str | None, prompt: str | None, terminals: frozenset[str], goes_on: bool = False) -> str | None:
    """The defect of one pair, if any."""
    if is_empty(response):
        return "empty"
    if copy_ratio(response, prompt) <= COPY_AT:
        return "copy"
    if is_refusal(response):
        return "refusal"
    if not is_german(response):
        return "language"
    return None if _SIGNED.search(response.lower()) or ends_well(last_word(response), terminals, goes_on) else "truncated"


def ends_model(pairs: DataFrame) -> tuple[frozenset[str], DataFrame]:
    """(the terminals, words ``last`` that don't end a sentence) of (response, last).

    Each different response is counted once, and a group of near copies once. All words are counted before they
    meet those that are the last of some response.
    """
    d = pairs.where("response is not null").groupBy(F.md5("response").alias("id")).agg(F.first("response").alias("response"), F.first("last").alias("last"))
    words = F.split(F.regexp_replace(F.regexp_replace("response", r"(?U)\s+$", ""), r"\d", "0"), r"(?U)\s+")
    d = written(d.select("id", "last", F.transform(words, F.lower).alias("ws"), words.alias("cased")), "responses")
    ends = d.groupBy("last").agg(F.count("*").alias("ends"))
    follows = F.arrays_zip(F.col("ws").alias("w"), F.slice("cased", 2, F.size("cased")).alias("next"))
    every = d.select(F.explode(follows).alias("x")).groupBy(F.col("x.w").alias("last"))
    every = every.agg(F.count("*").alias("seen"), F.count_if(F.col("x.next").rlike(r"^[\p{Ll}0-9]")).alias("on"))
    seen = written(every.join(ends, "last"), "ends")
    goes_on = seen.where((F.col("on") >= GOES_ON_TIMES) & (F.col("on") >= GOES_ON_SHARE * F.col("seen"))).select("last", F.lit(True).alias("goes_on"))
    least = max(TERMINAL_TIMES, OF_ALL * d.count())
    model = F.broadcast(seen.where((F.col("ends") >= least) & (F.col("ends") >= TERMINAL_SHARE * F.col("seen"))).select("last", "ends"))
    before = F.array_distinct(F.slice("ws", F.greatest(F.lit(1), F.size("ws") - BEFORE), F.least(F.lit(BEFORE), F.size("ws") - 1)))
    w = written(d.join(model, "last").select("id", "last", "ends", F.explode_outer(before).alias("w")), "contexts")
    common = w.groupBy("last", "w", "ends").agg(F.count("*").alias("n")).where(F.col("n") >= COPY_SHARE * F.col("ends")).select("last", "w", F.lit(1).alias("same"))
    copy = w.join(common, ["last", "w"], "left").groupBy("last", "id").agg((F.count("same") >= COPY_SHARE * F.count("*")).alias("copy"))
    own = copy.groupBy("last").agg((F.count_if(~F.col("copy")) + F.max(F.col("copy").cast("int"))).alias("own"))
    return frozenset(x["last"] for x in own.where(F.col("own") >= least).select("last").collect()), goes_on


def defects(records: DataFrame) -> DataFrame:
    """(rec_id, defect) of every defective pair: empty, copy, refusal, language or truncated, the first that holds.

    Null, blank and missing responses are empty; without a prompt nothing is a copy. Rows of
    the same rec_id count once.
    """
    r = records.where("rec_id is not null").select("rec_id", content_of(F.col("messages"), ROLE_ASSISTANT).alias("response"), content_of(F.col("messages"), ROLE_USER).alias("prompt")).dropDuplicates(["rec_id"])
    word = F.regexp_replace(F.lower(F.element_at(F.split(F.regexp_replace("response", r"(?U)\s+$", ""), r"(?U)\s+"), -1)), r"\d", "0")
    r = written(r.withColumn("last", F.coalesce(word, F.lit(""))), "pairs")
    known, goes_on = ends_model(r.select("response", "last"))
    terminals = r.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf(T.StringType())
    def judged(response: pd.Series, prompt: pd.Series, on: pd.Series) -> pd.Series:
        return pd.Series([defect(x, y, terminals.value, bool(g)) for x, y, g in zip(response, prompt, on)], dtype=object)

    r = r.join(goes_on, "last", "left").withColumn("goes_on", F.coalesce("goes_on", F.lit(False)))
    return r.select("rec_id", judged("response", "prompt", "goes_on").alias("defect")).where("defect is not null")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defects(read(spark, sf_dir, "records"))


def queries() -> dict:
    return {"p6_found": p6_found}


def oracle_sql() -> dict[str, str]:
    return {}
