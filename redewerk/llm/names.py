"""Problem 3: variant spellings of names typed by people.

Each typed name is read into a form (person or organisation, given name or kind of
organisation, family name or subject and place, party). Family names meet by MinHash
bands over padded q-grams; the number of bands follows from the collision curve and the
wanted recall. Pairs of forms are verified by the Monge-Elkan similarity of their parts,
and star clustering makes the best supported complete form of each neighbourhood a
centre to which the others go.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ._common import cut, part_count, read, written

# --- fixed values: widely known German short forms of given names; others are learned from the lists themselves ----
NICKNAMES = {
    "alex": "alexandra alexander", "andi": "andreas andrea", "anni": "anna", "basti": "sebastian", "benni": "benjamin", "bernd": "bernhard", "betti": "elisabeth", "burgl": "walburga", "charly": "charlotte karl", "chris": "christian christiane", "christl": "christiane christina",
    "conny": "cornelia", "doro": "dorothea", "elli": "elisabeth", "else": "elisabeth", "evi": "eva", "ferdl": "ferdinand", "fine": "josephine", "flori": "florian", "franzi": "franziska", "fritz": "friedrich", "gabi": "gabriele", "gerd": "gerhard",
    "gitti": "brigitte", "grete": "margarete", "gretel": "margarete", "gustl": "august auguste", "hannes": "johannes", "hans": "johannes", "heidi": "adelheid", "heiner": "heinrich", "heinz": "heinrich", "hias": "matthias", "inge": "ingeborg", "jochen": "joachim",
    "josi": "josephine", "jupp": "josef", "kathi": "katharina", "kati": "katharina", "klaus": "nikolaus", "leni": "helene magdalena", "leo": "leonhard leopold", "lilli": "elisabeth", "lisa": "elisabeth", "lisbeth": "elisabeth", "liesel": "elisabeth", "loni": "apollonia",
    "lotte": "charlotte", "manni": "manfred", "matze": "matthias", "max": "maximilian", "micha": "michael", "moni": "monika", "niko": "nikolaus", "otti": "ottilie", "poldi": "leopold", "resi": "theresia therese", "rosi": "rosemarie", "rudi": "rudolf", "sandra": "alexandra",
    "sanne": "susanne", "schorsch": "georg", "sepp": "josef", "sigi": "siegfried", "steffi": "stefanie", "susi": "susanne", "thea": "dorothea", "theo": "theodor", "tina": "christina martina", "toni": "anton antonia", "traudl": "gertraud", "uli": "ulrich ulrike", "ulla": "ursula",
    "uschi": "ursula", "uwe": "ulrich", "vroni": "veronika", "wiggerl": "ludwig", "willi": "wilhelm", "wolle": "wolfgang", "xaver": "franz", "yvi": "yvonne", "zenzi": "kreszentia",
}
# --- fixed values: kinds of organisations and their short forms (folded) -------------
ORG_KINDS = {
    "arbeitsgemeinschaft": "ag arge arbeitsgem", "buergerinitiative": "bi buergerini", "genossenschaft": "gen genoss", "landesverband": "lv landesverb",
    "zweckverband": "zv zweckverb", "fachvereinigung": "fv fachver", "verein": "ver", "verband": "verb", "stiftung": "stift", "interessengemeinschaft": "ig",
}
# --- fixed values: words before or after a name that don't belong to it ----------------
TITLES = {"dr", "prof", "ing", "dipl", "med", "jur", "mag", "abg", "abgeordnete", "abgeordneter", "abgeordnete(r)", "herr", "herrn", "frau", "hr", "fr", "mdl", "mdb"}
# --- fixed values: roles that are offices, not parties (beginnings, folded) -----------
OFFICES = ("vors", "mitgl", "stellv", "gast", "sachverst", "schriftf", "minist", "staats", "vertret", "beisitz", "protokoll", "obmann", "sprecher")

Q = 2
ROWS = 2
#: A pair of family names whose q-gram sets are similar to this degree must meet ...
MEET_AT = 0.4
#: ... with this probability.
RECALL = 0.999
BANDS = math.ceil(math.log(1 - RECALL) / math.log(1 - MEET_AT**ROWS))
MIN_SCORE = 0.7
#: Monge-Elkan similarity that family names must reach before their edits are counted.
ELKAN = 0.8
#: A given name is a short form of another if it stands beside it, with the same family name in the same list, so many times and in this
#: share of its family names, and the other is this many times more frequent.
SHORT_TIMES, SHORT_SHARE, FULLER = 3, 0.3, 2

_SHORT_KIND = {s: k for k, v in ORG_KINDS.items() for s in (k, *v.split())}


def fold(s: str) -> str:
    s = s.casefold().replace("ä", "ae").replace("ö", "oe").replace("ü", "ue").replace("ß", "ss").replace("̈", "e")
    return re.sub(r"ph(?=\w)", "f", re.sub(r"\s+", " ", s)).strip()


def distance(a: str, b: str, most: int) -> int:
    """Edits (insert, delete, change, swap of neighbours) from a to b, or most + 1 if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if before and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new.append(d)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


def kind_of(token: str) -> str | None:
    """The kind of organisation a folded token stands for, typing errors included."""
    t = token.replace("-", "").rstrip(".")
    if t in _SHORT_KIND:
        return _SHORT_KIND[t]
    if len(t) >= 9:
        for k in ORG_KINDS:
            if distance(t, k, 2) <= 2:
                return k
    return None


def parsed(name: str | None) -> tuple | None:
    """(kind, given, family, party, swappable) of a typed name; None for blank names.

    kind ``o`` (organisation): given is the kind of organisation, family subject and place.
    kind ``p`` (person): given may be empty, an initial or short form ending in a full stop.
    swappable: two bare words, of which either may be the family name.
    """
    if name is None or not name.strip():
        return None
    party = "".join(x for x in re.findall(r"\(([^)]*)\)", name) if x != "r")
    s = re.sub(r"\([^)]*\)|\([^)]*$", " ", re.sub(r"\(r\)", "", name))
    s = fold(re.sub(r"(?i)\b(dr|prof|ing|dipl)\.", r"\1. ", s))
    s, club = re.subn(r"\be\.? ?v\.?(?=$|[\s,])", " ", s)
    left, comma, right = (x.strip() for x in s.partition(","))
    words = [w for w in re.split(r"[\s,;]+", s) if w]
    kinds = [(i, kind_of(w)) for i, w in enumerate(words)]
    org = next(((i, k) for i, k in kinds if k), None)
    if org is None:
        for i, w in enumerate(words):
            head, dash, tail = w.rpartition("-")
            if dash and (k := kind_of(tail)):
                words[i], org = head, (None, k)
    if org is not None and (club or len(words) + (org[0] is None) >= 2):
        rest = [w for i, w in enumerate(words) if i != org[0]]
        return ("o", org[1], " ".join(sorted(rest)), fold(party), False)
    if club:
        return ("o", "", " ".join(sorted(words)), fold(party), False)

    def bare(x: str) -> list[str]:
        return [w for w in x.split() if w.rstrip(".:") not in TITLES and w.strip(".:-")]

    if comma and bare(left):
        family, given = bare(left), bare(right.replace(",", " "))
    else:
        own = bare(s.replace(",", " "))
        family, given = own[-1:], own[:-1]
    if not family:
        return None
    long = [g for g in given if len(g.rstrip(".")) > 1]
    first = (long or given or [""])[0]
    if len(first.rstrip(".")) == 1:
        first = first[0] + "."
    swappable = not comma and len(bare(s)) == 2 and not first.endswith(".")
    return ("p", first, " ".join(family).strip(".:"), fold(party), swappable)


_FULL = {fold(k): set(fold(v).split()) for k, v in NICKNAMES.items()}


def full_names(given: str, learned: tuple[str, ...] | list[str] = ()) -> set[str]:
    """The folded full names a folded given name may stand for."""
    return _FULL.get(given, set()) | set(learned) or {given}


def winkler(a: str, b: str) -> float:
    """Jaro-Winkler similarity."""
    if a == b:
        return 1.0
    reach, used, m = max(len(a), len(b)) // 2 - 1, [False] * len(b), []
    for i, x in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == x:
                used[j] = True
                m.append(x)
                break
    if not m:
        return 0.0
    t = sum(x != y for x, y in zip(m, (b[j] for j in range(len(b)) if used[j]))) / 2
    jaro = (len(m) / len(a) + len(m) / len(b) + (len(m) - t) / len(m)) / 3
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return jaro + min(p, 4) * 0.1 * (1 - jaro)


def given_likeness(a: str, b: str, full_a: tuple[str, ...] | list[str] = (), full_b: tuple[str, ...] | list[str] = ()) -> float:
    """1 for the same given name (short forms count), less for typing errors, abbreviations and none; 0 if they can't be the same.

    full_a, full_b: full names learned for a and b. The beginning of a name, of two letters or more, may be a short form.
    """
    if not a or not b:
        return 0.55
    if a.endswith(".") or b.endswith("."):
        x, y = sorted(((a, full_a), (b, full_b)), key=lambda g: (not g[0].endswith("."), len(g[0])))
        stem = x[0].rstrip(".")
        fits = any(f.startswith(stem) for f in full_names(y[0].rstrip("."), y[1]) | {y[0].rstrip(".")})
        return (0.8 if len(stem) > 1 else 0.75) if fits else 0.0
    if full_names(a, full_a) & full_names(b, full_b):
        return 1.0
    most = 1 if min(len(a), len(b)) < 5 else 2
    near = min(distance(x, y, most) for x in full_names(a, full_a) | {a} for y in full_names(b, full_b) | {b})
    if near > most:
        x, y = sorted((a, b), key=len)
        return 0.8 if len(x) > 1 and y.startswith(x) else 0.0
    return 1 - 0.08 * near


def monge_elkan(a: list[str], b: list[str]) -> float:
    """Mean over the words of ``a``, each with its best partner in ``b``."""
    return sum(max(winkler(p, q) for q in b) for p in a) / len(a)


def family_likeness(a: str, b: str) -> float:
    """Monge-Elkan similarity of the words, or of the names written as one word; 0 if it is small, or beyond two edits in all."""
    if a == b:
        return 1.0
    x, y = a.split(" "), b.split(" ")
    one, two = "".join(x), "".join(y)
    like = max(monge_elkan(x, y), 0.95 * winkler(one, two)) if len(x) == len(y) else 0.95 if distance(one, two, 1) <= 1 else 0.0
    if like < ELKAN:
        return 0.0
    most = 1 if len(a) < 6 else 2
    if len(x) == len(y) and distance(a, b, most) > most and distance(" ".join(sorted(x)), " ".join(sorted(y)), most) > most:
        return 0.0
    return like


def bands(family: str, salt: str) -> list[int]:
    """Keys of the MinHash bands of the padded q-grams."""
    s = f"{'#' * (Q - 1)}{family}{'#' * (Q - 1)}"
    grams = np.array([xxhash.xxh3_64_intdigest(s[i : i + Q]) for i in range(len(s) - Q + 1)], dtype=np.uint64)
    mins = (grams[:, None] * _FACTORS + _TERMS >> np.uint64(7)).min(axis=0)
    rows, head = mins.reshape(BANDS, ROWS), salt.encode() + b"|"
    return [xxhash.xxh3_64_intdigest(head + b.to_bytes(2, "big") + rows[b].tobytes()) - (1 << 63) for b in range(BANDS)]


_R = np.random.default_rng(11)
_NUMBERS = _R.integers(1, 2**63, size=(BANDS * ROWS, 2)).astype(np.uint64)
_FACTORS, _TERMS = _NUMBERS[:, 0] | np.uint64(1), _NUMBERS[:, 1]

_PARSED = T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "given", "family", "party")] + [T.StructField("swappable", T.BooleanType())])


@F.pandas_udf(_PARSED)
def _parse(s: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parsed(x) or (None,) * 5 for x in s], columns=["kind", "given", "family", "party", "swappable"])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _bands(salt: pd.Series, family: pd.Series) -> pd.Series:
    return pd.Series([bands(f, s) for s, f in zip(salt, family)])


@F.pandas_udf(T.DoubleType())
def _family(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([family_likeness(x, y) for x, y in zip(a, b)], dtype=float)


@F.pandas_udf(T.DoubleType())
def _given(kind: pd.Series, a: pd.Series, b: pd.Series, fa: pd.Series, fb: pd.Series) -> pd.Series:
    return pd.Series([(1.0 if x == y else 0.6 if not x or not y else 0.0) if k == "o" else given_likeness(x, y, () if f is None else f, () if g is None else g) for k, x, y, f, g in zip(kind, a, b, fa, fb)], dtype=float)


@F.pandas_udf(T.IntegerType())
def _complete(kind: pd.Series, given: pd.Series, party: pd.Series, full: pd.Series) -> pd.Series:
    def one(k: str, g: str, p: str, f) -> int:
        if k == "o":
            return 2 + bool(g)
        return (0 if not g else 1 if g.endswith(".") or full_names(g, () if f is None else list(f)) != {g} else 2) * 2 + bool(p)

    return pd.Series([one(*x) for x in zip(kind, given, party, full)], dtype="int32")


def short_forms(forms: DataFrame) -> DataFrame:
    """(given, full array<string>): given names that stand, with the same family name in the same list, beside a more frequent given name too often for chance."""
    g = written(forms.where("kind = 'p' and length(given) > 1 and not endswith(given, '.')").select("block", "family", "given").distinct(), "given")
    n = g.groupBy("given").agg(F.count("*").alias("n"))
    a, b = g.withColumnRenamed("given", "a"), g.withColumnRenamed("given", "b")
    # the given names of one family name in one list
    both = a.join(b, ["block", "family"]).where("a <> b").groupBy("a", "b").agg(F.count("*").alias("times")).where(F.col("times") >= SHORT_TIMES)
    both = both.join(n.select(F.col("given").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("given").alias("b"), F.col("n").alias("nb")), "b")
    return both.where((F.col("times") >= SHORT_SHARE * F.col("na")) & (F.col("nb") >= FULLER * F.col("na"))).groupBy(F.col("a").alias("given")).agg(F.array_sort(F.collect_list("b")).alias("full"))


def forms_of(attendance: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mention table mention_id, form), (forms form, block, kind, given, family, party, n, full: full names learned for a short form).

    Rows of the same mention count once; mentions without a readable name stand alone
    and are in neither. Null committee or wp is a block of its own.
    """
    m = attendance.where("mention_id is not null").dropDuplicates(["mention_id"])
    m = m.select("mention_id", F.concat_ws("|", F.coalesce("committee", F.lit("?")), F.coalesce(F.col("wp").cast("string"), F.lit("?"))).alias("block"), "full_name", F.lower(F.trim("role")).alias("role"))
    names = m.select("full_name").distinct().withColumn("p", _parse("full_name")).where("p.kind is not null").select("full_name", "p.*")
    names = written(names, "names")
    # which of two bare words is the family name: the one that more often stands last
    two = names.where("swappable").select(F.explode(F.array(F.struct(F.col("given").alias("w"), F.lit(-1).alias("v")), F.struct(F.col("family").alias("w"), F.lit(1).alias("v")))).alias("x"))
    sure = names.where("kind = 'p' and not swappable and given <> ''").select(F.explode(F.array(F.struct(F.col("given").alias("w"), F.lit(-3).alias("v")), F.struct(F.col("family").alias("w"), F.lit(3).alias("v")))).alias("x"))
    lean = cut(two.unionByName(sure).groupBy("x.w").agg(F.sum("x.v").alias("lean")))
    a, b = (lean.select(F.col("w").alias(k), F.col("lean").alias(f"{k}_lean")) for k in ("given", "family"))
    names = names.join(a, "given", "left").join(b, "family", "left")
    turn = F.col("swappable") & (F.col("given_lean") - F.col("family_lean") >= 3)
    names = names.select("full_name", "kind", F.when(turn, F.col("family")).otherwise(F.col("given")).alias("given"), F.when(turn, F.col("given")).otherwise(F.col("family")).alias("family"), "party")
    role = F.regexp_replace("role", r"[\s\-]*fraktion$", "")
    role = F.when(~F.coalesce(role, F.lit("")).rlike("^(" + "|".join(OFFICES) + ")"), role)
    m = m.join(names, "full_name").withColumn("party", F.coalesce(F.nullif("party", F.lit("")), role, F.lit("")))
    m = m.withColumn("party", F.when(F.col("kind") == "p", F.regexp_replace("party", "ü", "ue")).otherwise(F.lit("")))
    m = written(m.select("mention_id", F.sha1(F.concat_ws("\x1f", "block", "kind", "given", "family", "party")).alias("form"), "block", "kind", "given", "family", "party"), "mentions")
    forms = m.groupBy("form").agg(*[F.first(c).alias(c) for c in ("block", "kind", "given", "family", "party")], F.count("*").alias("n"))
    forms = cut(forms)
    return m.select("mention_id", "form"), cut(forms.join(short_forms(forms), "given", "left"))


def likely_pairs(forms: DataFrame) -> DataFrame:
    """(a, b, score): pairs of different forms, each in both directions, that may stand for the same entity."""
    fam = forms.groupBy("block", "kind", "family").agg(F.sum("n").alias("n"))
    spread = fam.groupBy("kind", "family").agg(F.sum("n").alias("all"))
    fam = cut(fam.join(spread, ["kind", "family"]).withColumn("id", F.xxhash64("block", "kind", "family")))
    # few narrow rows make much work: as many tasks as the session has
    keyed = fam.select("id", "block", "kind", "family").repartition(part_count(forms), "id")
    keyed = written(keyed.select("id", F.explode(_bands(F.concat_ws("|", "block", "kind"), "family")).alias("band")), "bands")
    met = keyed.select("band", F.col("id").alias("a")).join(keyed.select("band", F.col("id").alias("b")), "band").where("a < b").select("a", "b").distinct()
    of = lambda x, y: fam.select(F.col("id").alias(x), F.col("block").alias(f"b{y}"), F.col("kind").alias(f"k{y}"), F.col("family").alias(f"f{y}"), F.col("all").alias(f"n{y}"), F.col("n").alias(f"m{y}"))
    met = met.join(of("a", "a"), "a").join(of("b", "b"), "b").where("ba = bb and ka = kb").select(F.col("ba").alias("block"), F.col("ka").alias("kind"), "fa", "fb", "na", "nb", "ma", "mb")
    met = met.repartition(part_count(forms))
    # a spelling found often, here and all over, is a name of its own, not an error for the other
    rare = (F.least("na", "nb") * 4 <= F.greatest("na", "nb")) | (F.least("ma", "mb") <= 2)
    like = met.withColumn("like", _family("fa", "fb")).where((F.col("like") > 0) & rare)
    like = like.select("block", "kind", "fa", "fb", "like")
    both = like.unionByName(like.select("block", "kind", F.col("fb").alias("fa"), F.col("fa").alias("fb"), "like"))
    links = cut(both.unionByName(fam.select("block", "kind", F.col("family").alias("fa"), F.col("family").alias("fb"), F.lit(1.0).alias("like"))))
    a = forms.select("block", "kind", F.col("family").alias("fa"), F.col("form").alias("a"), F.col("given").alias("ga"), F.col("party").alias("pa"), F.col("full").alias("la"))
    b = forms.select("block", "kind", F.col("family").alias("fb"), F.col("form").alias("b"), F.col("given").alias("gb"), F.col("party").alias("pb"), F.col("full").alias("lb"))
    pairs = links.join(a, ["block", "kind", "fa"]).join(b, ["block", "kind", "fb"]).where("a <> b and (pa = pb or pa = '' or pb = '')")
    pairs = pairs.withColumn("g", _given("kind", "ga", "gb", "la", "lb"))
    score = (F.col("like") + F.col("g")) / 2 + F.when((F.col("pa") == F.col("pb")) & (F.col("pa") != ""), 0.1).otherwise(0.0)
    return cut(pairs.where((F.col("g") > 0) & ((F.col("like") + F.col("g")) / 2 >= MIN_SCORE)).select("a", "b", score.alias("score")))


def star_clusters(forms: DataFrame, pairs: DataFrame) -> DataFrame:
    """(form, centre). A form is a centre if no free neighbour is more complete or better supported; the others go to the nearest centre."""
    rank = F.struct(_complete("kind", "given", "party", "full").alias("c"), F.col("n"), F.col("form"))
    free = cut(forms.select("form", rank.alias("rank")))
    done: DataFrame | None = None
    while not free.isEmpty():
        ra, rb = (free.select(F.col("form").alias(x), F.col("rank").alias(f"r{x}")) for x in "ab")
        near = pairs.join(ra, "a").join(rb, "b")
        beaten = near.where("rb > ra").select("a").distinct()
        centre = cut(free.join(beaten, free["form"] == beaten["a"], "left_anti"))
        to = pairs.join(centre.select(F.col("form").alias("b"), F.col("rank").alias("rb")), "b").join(centre.select(F.col("form").alias("a")), "a", "left_anti")
        to = to.join(free.select(F.col("form").alias("a")), "a", "left_semi")
        went = to.groupBy("a").agg(F.max_by("b", F.struct(F.round("score", 6), "rb")).alias("centre")).select(F.col("a").alias("form"), "centre")
        step = cut(went.unionByName(centre.select("form", F.col("form").alias("centre"))))
        free = cut(free.join(step.select("form"), "form", "left_anti"))
        done = step if done is None else done.unionByName(step)
    return done if done is not None else forms.select("form", F.col("form").alias("centre"))


def linked(attendance: DataFrame) -> DataFrame:
    """(mention_id, entity): one row a mention with a readable name; entity is the smallest mention_id of its kind."""
    mentions, forms = forms_of(attendance)
    of = star_clusters(forms, likely_pairs(forms))
    m = mentions.join(of, "form").select("mention_id", "centre")
    first = m.groupBy("centre").agg(F.min("mention_id").alias("entity"))
    return m.join(first, "centre").select("mention_id", "entity")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = cut(linked(read(spark, sf_dir, "attendance")))
    a, b = (m.select("entity", F.col("mention_id").alias(f"mention_{x}")) for x in "ab")
    return a.join(b, "entity").where("mention_a < mention_b").select("mention_a", "mention_b")


def p3_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every mention with its entity and the number of the entity's mentions."""
    m = cut(linked(read(spark, sf_dir, "attendance")))
    return m.join(m.groupBy("entity").agg(F.count("*").alias("mentions")), "entity").select("mention_id", "entity", "mentions")


def queries() -> dict:
    return {"p3_found": p3_found, "p3_entities": p3_entities}


def oracle_sql() -> dict[str, str]:
    return {}
