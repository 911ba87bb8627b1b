"""Problem 5: noise in text from scanned pages.

Page numbers, running headers and words divided at line ends are taken out of the lines
first. A running header is told by the page, not by its words: an unfilled line amid lines that
run on without it, the same line (up to misread characters) elsewhere, or a line beside a page number.
Misread characters are then corrected by a noisy channel: a word's candidates are the words of
the corpus from which it arises by character confusions, whose probabilities are estimated from the
corpus; they are weighed with the unigram and bigram likelihood of the corpus, and the best
sequence is decoded by Viterbi. Counts cover all texts; copies of a text tell about its misreadings once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import ROLE_ASSISTANT, content_of, read, written

# --- fixed values: what is read -> what stood there, with how often in a thousand a character is so misread ---
CONFUSIONS = {
    ("1", "l"): 10, ("1", "i"): 2, ("!", "i"): 10, ("!", "l"): 2, ("|", "l"): 6, ("|", "I"): 4, ("0", "o"): 10, ("0", "O"): 8, ("5", "S"): 10, ("5", "s"): 4,
    ("8", "B"): 10, ("9", "g"): 10, ("6", "ö"): 8, ("6", "b"): 4, ("B", "ß"): 6, ("c", "e"): 6, ("e", "c"): 3, ("f", "t"): 5, ("t", "f"): 3, ("rn", "m"): 6, ("m", "rn"): 4,
    ("cl", "d"): 5, ("d", "cl"): 3, ("li", "h"): 6, ("h", "li"): 2, ("ii", "ü"): 6, ("I", "l"): 5, ("l", "I"): 4, ("i", "l"): 3, ("l", "i"): 3, ("a", "ä"): 4, ("o", "ö"): 4, ("u", "ü"): 4,
    ("ﬂ", "fl"): 10, ("ﬁ", "fi"): 10, ("ﬀ", "ff"): 10, ("vv", "w"): 5, ("nn", "m"): 2, ("ni", "m"): 3, ("in", "m"): 3, ("ri", "n"): 3, ("n", "ri"): 2, ("u", "n"): 3, ("n", "u"): 3, ("h", "b"): 2, ("b", "h"): 2,
    ("s", "f"): 2, ("ss", "ß"): 2, ("fs", "ß"): 3, ("6", "o"): 1, ("4", "A"): 4, ("7", "T"): 3, ("2", "Z"): 4, ("3", "E"): 2, ("q", "g"): 3, ("y", "v"): 2, ("é", "e"): 3, ("á", "a"): 3,
}
# --- fixed values: words after which a hyphen at the line end stays (Orts- und ...) ----------------
JOINING = ("und", "oder", "bzw", "sowie", "bis", "noch", "als", "wie")

#: Log odds below which no context makes a candidate likely.
HOPELESS = -14.0
#: Share of the bigram in the interpolated likelihood of a word; the rest is the unigram's.
BIGRAM = 0.7
#: Occurrences as which the prior of a confusion counts.
PRIOR_TIMES = 100.0
#: How many times more often than on the average a badly read text is misread.
BADLY = 12.0
#: Times a word that stands nowhere else counts, and one with signs that stand in no clean word.
UNSEEN, ODD_SEEN = 0.5, 0.0005
#: Pairs of words (some 40 bytes each) that are broadcast at most.
BROADCAST_ROWS = 500_000
#: Characters by which a filled line may miss the width (misread characters change lengths).
SLACK = 3
#: Signs that stand in no clean word between or before letters.
ODD = re.compile(r"[^\W\d_][0-9!|]|[0-9!|][^\W\d_]|[ﬀ-ﬄ]")
_TRIM = re.compile(r"^[^\w!|]+|[^\w|]+$")
_PAGE = re.compile(r"(?i)\s*(?:[S5]e[i!l1]te\s+\d+(?:\s+v[o0]n\s+\d+)?|[-–—]\s*\d{1,4}\s*[-–—]|[S5]\.\s*\d{1,4}|\[\d{1,4}\]|\d{1,4}\s*/\s*\d{1,4}|\d{1,4})\s*")
_CLOSED = re.compile(r"[.!?…][“”\"')»\]]*$")
_TWO = re.compile(r"[^\W\d_]{2}[.!?] +[A-ZÄÖÜ]")
_ITEM = re.compile(r"\s*(?:[-*•–]|\d{1,3}[.)]|\|)\s")
_HYPHEN_END = re.compile(r"([^\W\d_][\w!|]*)([-‐¬=­])\s*$")
_HYPHEN_IN = re.compile(r"(?<![\w-])([^\W\d_][\w!|]*)(?:- |¬ ?|­ ?|= )(?=([a-zäöüß][\w!|]*))")


def is_page(line: str) -> bool:
    return bool(_PAGE.fullmatch(line))


# --- fixed values: signs read for letters, and letters that are taken for each other, as one letter ----
_SIGNS = str.maketrans({"1": "l", "!": "i", "|": "l", "0": "o", "5": "s", "8": "b", "9": "g", "6": "b", "4": "a", "7": "t", "2": "z", "3": "e"})
_ALIKE = str.maketrans({"e": "c", "f": "t", "ö": "o", "ä": "a", "n": "u", "ü": "u", "ß": "b", "q": "g", "y": "v", "j": "i", "l": "i", "é": "c", "á": "a"})


def skeleton(line: str) -> str:
    """One spelling for all readings of a line that differ in misread characters or in numbers."""
    out = []
    for w in line.lower().split():
        if any(c.isalpha() for c in w):
            w = w.translate(_SIGNS)
            for seen, true in (("li", "h"), ("ii", "u"), ("rn", "m"), ("cl", "d"), ("vv", "w")):
                w = w.replace(seen, true)
            out.append(w.translate(_ALIKE))
        else:
            out.append(re.sub(r"\d+", "0", w))
    return " ".join(out)


_DIVIDED = re.compile(r"[-‐¬­=] [^\W\d_]+$")


def reach(line: str) -> int:
    """The length of a line as it was printed: the rest of a divided word may have been pulled up to it."""
    x = line.rstrip()
    m = _DIVIDED.search(x)
    return m.start() + 1 if m else len(x)


def line_width(lines: list[str]) -> int | None:
    """The width to which the lines were wrapped: the one that most lines fill, as their next word would not have fitted; None without any."""
    votes: Counter[int] = Counter()
    for a, b in zip(lines, lines[1:]):
        if a.strip() and b.strip():
            n = reach(a)
            votes.update(range(n, n + len(b.split(None, 1)[0]) + 1))
    if not votes:
        return None
    most = max(votes.values())
    best = sorted(w for w, n in votes.items() if n == most)
    return best[len(best) // 2]


def page_lines(lines: list[str]) -> set[int]:
    """Numbers of the lines that are page numbers, in a text of more lines."""
    body = [i for i, x in enumerate(lines) if x.strip()]
    return {i for i in body if is_page(lines[i])} if len(body) > 1 else set()


def marked(lines: list[str]) -> tuple[set[int], dict[int, tuple[bool, bool, bool, bool]]]:
    """(numbers of lines that are page numbers, {number of a line that may be a running header: (sure, beside a page number, open, amid)}).

    Open is a line without the end of a sentence that is too long for the width or leaves room for the next word. Amid is one
    if the line before and the one after are consecutive lines of one paragraph; sure is an open one amid. A
    bare number counts as page number only on a line of its own in a text of more lines.
    """
    body = [i for i, x in enumerate(lines) if x.strip()]
    pages = page_lines(lines)
    if len(body) < 2:
        return pages, {}
    near = {j for a, b in zip(body, body[1:]) if (a in pages) != (b in pages) for j in (a, b)} - pages
    flow = [i for i in body if i not in pages]
    width = line_width([x for i, x in enumerate(lines) if i not in pages])
    out: dict[int, tuple[bool, bool, bool, bool]] = {}
    after: str | None = None  # the next line that is no sure header
    for k, i in reversed(list(enumerate(flow))):
        line, following = lines[i].strip(), after
        after = lines[i]
        # the end of a sentence, two sentences, items of a list, and lines that begin or end within a sentence are speech
        if _CLOSED.search(line) or _TWO.search(line) or _ITEM.match(lines[i]) or not any(c.isalpha() for c in line):
            continue
        if line[0].islower() or line.endswith((",", "-", "¬", "­", "=")) or _DIVIDED.search(line):
            continue
        before = lines[flow[k - 1]] if k else None
        loose = amid = False
        if following is not None and width is not None and not _ITEM.match(following):
            word = len(following.split(None, 1)[0])
            n = reach(line)
            loose = n > width + SLACK or n + 1 + word < width
            if before is not None and not before.startswith("#"):
                goes_on = not _CLOSED.search(before.strip()) or following.strip()[0].islower()
                n = reach(before)
                amid = goes_on and n - SLACK <= width <= n + word + SLACK
        out[i] = (loose and amid, i in near, loose or following is None, amid)
        if loose and amid:
            after = following
    return pages, out


def structure(text: str | None, headers: set[int] | None = None) -> tuple[list[str], set[str]]:
    """(paragraphs and headings, kinds of damage taken out): lines joined, page furniture gone, divided words whole.

    headers: numbers of the lines that are running headers; the sure ones of this text if not given.
    Null and blank texts give no paragraphs.
    """
    kinds: set[str] = set()
    if text is None or not text.strip():
        return [], kinds
    lines = text.split("\n")
    if headers is None:
        pages, may = marked(lines)
        headers = {i for i, (sure, *_) in may.items() if sure}
    else:
        pages = page_lines(lines)
    kept: list[str] = []
    for k, line in enumerate(lines):
        if k in pages:
            kinds.add("pageno")
        elif k in headers:
            kinds.add("header")
        else:
            kept.append(line)
            continue
        # what stood around page furniture was one paragraph if its line broke off there
        if kept and not kept[-1].strip() and len(kept) > 1 and kept[-2].strip() and kept[-2].rstrip()[-1] not in ".!?:“)" and not kept[-2].startswith("#"):
            kept.pop()
    paragraphs: list[str] = []
    width = max(map(len, kept), default=0)
    for line in kept:
        s = line.strip()
        if not s:
            paragraphs.append("")
            continue
        if not paragraphs or paragraphs[-1] == "" or s.startswith("#") or (paragraphs[-1].startswith("#") and len(paragraphs[-1]) + 1 + len(s.split(" ", 1)[0]) <= width):
            paragraphs.append(s)
            continue
        last = paragraphs[-1]
        m = _HYPHEN_END.search(last)
        nxt = s.split(" ", 1)[0]
        if m and nxt[0].islower() and nxt.strip(".,;:()„“") not in JOINING and not (m[2] in "-‐" and last[: m.start()].endswith("-")):
            kinds.add("hyphen")
            paragraphs[-1] = last[: m.end(1)] + s
        elif m and m[2] in "-‐" and last[: m.start()].endswith("-"):
            paragraphs[-1] = last + s
        elif m and m[2] in "¬­":
            kinds.add("hyphen")
            paragraphs[-1] = last[: m.end(1)] + s
        elif m and m[2] in "-‐" and nxt[0].isupper():
            paragraphs[-1] = last + s
        else:
            paragraphs[-1] = last + " " + s

    whole: list[str] = []
    for p in filter(None, paragraphs):
        if whole and (m := _HYPHEN_END.search(whole[-1])) and p[0].islower() and p.split(" ", 1)[0] not in JOINING:
            kinds.add("hyphen")
            whole[-1] = whole[-1][: m.end(1)] + p
        else:
            whole.append(p)

    def joined(m: re.Match) -> str:
        if m[2] in JOINING:
            return m[0]
        kinds.add("hyphen")
        return m[1]

    return [_HYPHEN_IN.sub(joined, p) for p in whole], kinds


def bare(token: str) -> str:
    """A blank-separated token without the punctuation around it; empty if it holds no letter."""
    w = _TRIM.sub("", token)
    return w if any(c.isalpha() for c in w) else ""


_VARIANTS: dict[str, list[str]] = {}
for _seen, _true in CONFUSIONS:
    _VARIANTS.setdefault(_seen, []).append(_true)
Channel = dict[tuple[str, str], float]
#: Log probability of each confusion before any text is seen.
PRIOR: Channel = {k: math.log(n / 1000) for k, n in CONFUSIONS.items()}


def candidates(word: str, channel: Channel = PRIOR) -> dict[str, tuple[float, tuple[tuple[str, str], ...]]]:
    """Words from which ``word`` may have arisen by up to two confusions, with the log probability of these, and them.

    Signs that stand in no clean word must all be undone.
    """
    def step(w: str, odd_only: bool) -> Iterator[tuple[str, tuple[str, str]]]:
        for i in range(len(w)):
            for size in (1, 2):
                seen = w[i : i + size]
                if odd_only and not (len(seen) == 1 and (seen in "0123456789!|" or seen in "ﬂﬁﬀ")):
                    continue
                for true in _VARIANTS.get(seen, ()):
                    yield w[:i] + true + w[i + size :], (seen, true)

    out: dict[str, tuple[float, tuple]] = {}

    def add(w: str, used: tuple) -> None:
        p = sum(channel[x] for x in used)
        if w != word and not ODD.search(w) and p > out.get(w, (-99.0,))[0]:
            out[w] = (p, used)

    odd = bool(ODD.search(word))
    for w, x in step(word, odd):
        add(w, (x,))
        if odd or len(word) > 3:
            for w2, y in step(w, bool(ODD.search(w))):
                add(w2, (x, y))
    return out


_FOUND = "h string, line int, skeleton string, sure boolean, beside boolean, loose boolean, amid boolean"


def _marked(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        rows = []
        for h, text in zip(pdf["h"], pdf["text"]):
            lines = text.split("\n")
            rows += [(h, i, skeleton(lines[i]), *how) for i, how in marked(lines)[1].items()]
        yield pd.DataFrame(rows, columns=["h", "line", "skeleton", "sure", "beside", "loose", "amid"])


def running_headers(texts: DataFrame) -> DataFrame:
    """(h, headers): numbers of the lines of each text (h, text) that are running headers.

    These are the sure ones, and those amid a paragraph that stand twice in a text; lines of the same skeleton as one of these, anywhere; and lines beside a page
    number, if more than half of the lines of this skeleton are, it is open or stands twice in a text, and is no heading with ``#``.
    """
    may = written(texts.mapInPandas(_marked, _FOUND), "lines")
    per = may.groupBy("skeleton", "h").agg((F.max("sure") | (F.max("amid") & (F.count("*") > 1))).alias("known"), F.count_if("beside").alias("at"), F.count("*").alias("n"), F.max("loose").alias("loose"))
    per = per.groupBy("skeleton").agg(F.max("known").alias("known"), (2 * F.sum("at") > F.sum("n")).alias("at_pages"), (F.max("loose") | (F.max("n") > 1)).alias("loose"))
    per = per.where("known or (at_pages and loose)").select("skeleton", "known")
    j = may.select("h", "line", "skeleton", "beside").join(per, "skeleton").where("known or (beside and line > 0 and not startswith(skeleton, '#'))")
    return j.groupBy("h").agg(F.collect_list("line").alias("headers"))


_STRUCTURE = "h string, copies bigint, paragraphs array<string>, kinds array<string>, words array<string>"


def _structured(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        rows = []
        for h, copies, text, headers in zip(pdf["h"], pdf["copies"], pdf["text"], pdf["headers"]):
            paragraphs, kinds = structure(text, set() if headers is None else {int(i) for i in headers})
            rows.append((h, copies, paragraphs, sorted(kinds), [w for p in paragraphs for t in p.split() if (w := bare(t))]))
        yield pd.DataFrame(rows, columns=["h", "copies", "paragraphs", "kinds", "words"])


def decode(words: list[str], options: dict[str, dict[str, float]], pairs: dict[tuple[str, str], float]) -> list[str]:
    """The likeliest true words of a line. options: per word the candidates with channel and unigram log
    probability together, against the word as it stands; pairs: what the bigram of two neighbours adds."""
    if not any(w in options for w in words):
        return words
    states: list[list[str]] = []
    back: list[list[int]] = []
    score = [0.0]
    before = [""]
    for w in words:
        own = options.get(w, {w: 0.0})
        now, new, came = list(own), [], []
        for c in now:
            s, k = max((score[k] + pairs.get((a, c), 0.0), -k) for k, a in enumerate(before))
            new.append(s + own[c])
            came.append(-k)
        states.append(now)
        back.append(came)
        score, before = new, now
    k = max(range(len(score)), key=lambda i: (score[i], -i))
    out = []
    for now, came in zip(reversed(states), reversed(back)):
        out.append(now[k])
        k = came[k]
    return out[::-1]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("cand", T.StringType()), T.StructField("used", T.ArrayType(T.StringType()))])))
def _cands(words: pd.Series) -> pd.Series:
    return words.map(lambda w: [{"cand": c, "used": [f"{a}>{b}" for a, b in used]} for c, (_, used) in candidates(w).items()])


def confusable(words: DataFrame) -> DataFrame:
    """(word, n, odd, cand, m, copies, used): words of the corpus from which a word of the corpus (word, n, copies) may have arisen, and how.

    n, m: places in different texts. A candidate must stand in as many different places as the word unless
    this has signs that stand in no clean word.
    """
    odd = F.col("word").rlike(r"\p{L}[0-9!|]|[0-9!|]\p{L}|[ﬀ-ﬄ]")
    opts = words.where(F.length("word") > 1).select("word", "n", odd.alias("odd"), F.explode(_cands("word")).alias("o")).select("word", "n", "odd", "o.cand", "o.used")
    return opts.join(words.select(F.col("word").alias("cand"), F.col("n").alias("m"), "copies"), "cand").where("odd or m >= n")


#: Per confusion how often it was made, and how often what stood there occurs.
Counts = dict[tuple[str, str], tuple[float, float]]


def misreadings(met: DataFrame, counts: Counts | None = None) -> DataFrame:
    """Adds to :func:`confusable` rows ``weight``, the log odds of the candidate, by channel and unigram (copies count),
    against the word standing there by right; and ``real``.

    A confusion's probability is taken from other words than the one in question (its prior counts as PRIOR_TIMES
    occurrences). The places in which badly read texts put the word (BADLY times the channel, with three standard
    deviations) don't count for it; real tells whether others are left.
    """
    made, had, prior = (F.create_map(*[x for k, n in CONFUSIONS.items() for x in (F.lit(">".join(k)), F.lit(f(k, n)))]) for f in (
        lambda k, n: float(counts[k][0]) if counts else 0.0, lambda k, n: float(counts[k][1]) if counts else 0.0, lambda k, n: PRIOR_TIMES * n / 1000,
    ))
    one = lambda u: F.log((F.greatest(F.element_at(made, u) - F.col("n"), F.lit(0.0)) + F.element_at(prior, u)) / (F.element_at(had, u) + PRIOR_TIMES))
    p = F.aggregate(F.transform("used", one), F.lit(0.0), lambda x, y: x + y)
    e = BADLY * F.col("m") * F.exp("p")
    rest = F.col("n") - 1 - e - 3 * F.sqrt(e)
    # the place in question tells nothing about how often the word stands there by right
    right = F.log(F.when(F.col("odd"), ODD_SEEN * F.col("n")).otherwise(F.greatest(rest, F.lit(UNSEEN))))
    x = met.withColumn("p", p).withColumn("weight", F.col("p") + F.log("copies") - right).withColumn("real", ~F.col("odd") & (rest > UNSEEN))
    return x.where(F.col("weight") > HOPELESS)


def estimated(words: DataFrame, met: DataFrame, rounds: int = 2) -> Counts:
    """How often the likeliest candidates use each confusion, and how often what stood there occurs. As many numbers as
    confusions come to the driver."""
    true = sorted({t for _, t in CONFUSIONS})
    count = [F.sum(F.col("n") * (F.length("word") - F.length(F.replace("word", F.lit(t), F.lit("")))) / len(t)).alias(f"c{i}") for i, t in enumerate(true)]
    row = words.agg(*count).first()
    had = {t: row[f"c{i}"] or 0.0 for i, t in enumerate(true)}
    counts = None
    for _ in range(rounds):
        best = misreadings(met, counts).groupBy("word").agg(F.max("n").alias("n"), F.max_by("used", "weight").alias("used"), F.max("weight").alias("weight")).where("weight > 0")
        made = {r["u"]: r["n"] for r in best.select("n", F.explode("used").alias("u")).groupBy("u").agg(F.sum("n").alias("n")).collect()}
        counts = {k: (made.get(">".join(k), 0), had[k[1]]) for k in CONFUSIONS}
    return counts


_REPAIRED = "h string, text string, kinds array<string>"


def _decoded(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        rows = []
        for h, paragraphs, kinds, opts, grams in zip(pdf["h"], pdf["paragraphs"], pdf["kinds"], pdf["opts"], pdf["grams"]):
            options: dict[str, dict[str, float]] = {}
            for o in opts if opts is not None else ():
                options.setdefault(o["word"], {o["word"]: 0.0})[o["cand"]] = o["weight"]
            # what a word stands beside tells nothing for it if all its places are misreadings
            real = {o["word"]: True for o in opts if o["real"]} if opts is not None else {}
            pairs = {(g["a"], g["b"]): g["more"] for g in (grams if grams is not None else ()) if not g["own"] or all(x not in options or x in real for x in (g["a"], g["b"]))}
            out, changed = [], False
            for p in paragraphs:
                tokens = p.split()
                words = [bare(t) for t in tokens]
                if options:
                    true = decode(words, options, pairs)
                    changed |= true != words
                    tokens = [t.replace(w, c, 1) if w != c else t for t, w, c in zip(tokens, words, true)]
                out.append(" ".join(tokens))
            rows.append((h, "\n\n".join(out), [*kinds, "ocr"] if changed else list(kinds)))
        yield pd.DataFrame(rows, columns=["h", "text", "kinds"])


def repaired(texts: DataFrame) -> DataFrame:
    """(rec_id, text, kinds) from (rec_id, text): continuous paragraphs, and the damage that was mended.

    Null texts come out empty without damage; rows of the same rec_id count once.
    """
    # each different text is mended once
    ids = texts.where("rec_id is not null").select("rec_id", F.md5(F.coalesce("text", F.lit(""))).alias("h")).groupBy("rec_id").agg(F.min("h").alias("h"))
    ids = written(ids, "texts")
    once = texts.where("rec_id is not null").select(F.coalesce("text", F.lit("")).alias("text")).groupBy(F.md5("text").alias("h")).agg(F.first("text").alias("text"))
    once = written(once.join(ids.groupBy("h").agg(F.count("*").alias("copies")), "h"), "once")
    docs = once.join(running_headers(once), "h", "left").select("h", "copies", "text", "headers").mapInPandas(_structured, _STRUCTURE)
    docs = written(docs, "structured")
    words = docs.select("copies", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum("copies").alias("copies"))
    words = written(words, "words")
    met = written(confusable(words), "confusable")
    wrong = written(misreadings(met, estimated(words, met)).select("word", "cand", "weight", "real"), "misreadings")
    # words of each text that have candidates
    held = docs.select("h", F.explode(F.array_distinct("words")).alias("word"))
    opts = held.join(wrong, "word").groupBy("h").agg(F.collect_list(F.struct("word", "cand", "weight", "real")).alias("opts"))
    opts = written(opts, "options")
    hit = docs.join(opts, "h")
    # neighbours of these words, with each candidate, whose frequency over the corpus is asked for
    row = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda i: F.struct(F.get("words", i - 1).alias("a"), F.get("words", i).alias("b")))
    mine = hit.where(F.size("words") > 1).select("h", "opts", F.explode(row).alias("g")).select("h", F.col("g.a").alias("a0"), F.col("g.b").alias("b0"), "opts")
    with_cands = lambda c: F.concat(F.array(F.col(c)), F.transform(F.filter("opts", lambda o: o["word"] == F.col(c)), lambda o: o["cand"]))
    mine = mine.withColumn("as", with_cands("a0")).withColumn("bs", with_cands("b0")).where("size(as) > 1 or size(bs) > 1")
    # as they stand, or with a candidate: the place itself doesn't count for how it stands
    own = (F.col("a") == F.col("a0")) & (F.col("b") == F.col("b0"))
    asked = mine.select("h", "a0", "b0", F.explode("as").alias("a"), "bs").select("h", "a0", "b0", "a", F.explode("bs").alias("b")).select("h", "a", "b", own.alias("own")).distinct()
    asked = written(asked, "asked")
    next_to = docs.where(F.size("words") > 1).select("copies", F.explode(row).alias("g")).select("g.a", "g.b", "copies")
    # only what is asked for is counted: found by broadcast if it is small, else by hash
    wanted = asked.select("a", "b").distinct()
    wanted = F.broadcast(wanted) if asked.count() <= BROADCAST_ROWS else wanted
    counts = next_to.join(wanted, ["a", "b"], "left_semi").groupBy("a", "b").agg(F.count("*").alias("n"), F.sum("copies").alias("c"))
    every = words.agg(F.sum("copies")).first()[0] or 1
    of = lambda x: words.select(F.col("word").alias(x), F.col("copies").alias(f"c{x}"))
    counts = counts.join(of("a"), "a").join(of("b"), "b")
    lift = lambda c: F.log(BIGRAM * c * every / (F.col("ca") * F.col("cb")) + (1 - BIGRAM)) - math.log(1 - BIGRAM)
    counts = counts.select("a", "b", lift(F.col("c")).alias("by_c"), lift(F.col("n") - 1).alias("by_n"))
    grams = asked.join(counts, ["a", "b"]).select("h", "a", "b", F.when(F.col("own"), F.col("by_n")).otherwise(F.col("by_c")).alias("more"), "own").where("more > 0")
    grams = grams.groupBy("h", "a", "b").agg(F.min("more").alias("more"), F.max("own").alias("own")).groupBy("h").agg(F.collect_list(F.struct("a", "b", "more", "own")).alias("grams"))
    full = docs.select("h", "paragraphs", "kinds").join(opts, "h", "left").join(grams, "h", "left")
    return ids.join(full.mapInPandas(_decoded, _REPAIRED), "h").select("rec_id", "text", "kinds")


def answers(records: DataFrame) -> DataFrame:
    """(rec_id, text) of the assistant."""
    return records.where("rec_id is not null").select("rec_id", content_of(F.col("messages"), ROLE_ASSISTANT).alias("text"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(answers(read(spark, sf_dir, "records"))).select("rec_id", F.explode("kinds").alias("kind"))


def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mended text of every damaged record."""
    return repaired(answers(read(spark, sf_dir, "records"))).where("size(kinds) > 0").select("rec_id", "text", F.concat_ws(",", F.array_sort("kinds")).alias("kinds"))


def queries() -> dict:
    return {"p5_found": p5_found, "p5_repaired": p5_repaired}


def oracle_sql() -> dict[str, str]:
    return {}
