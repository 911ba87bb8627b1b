"""Persons named in minutes: parsing of names, the directory, the chair."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: word lists and shapes of names ------------------------------------
TITLES = ["dr.", "prof.", "habil.", "dr", "prof", "präsidentin", "präsident", "vizepräsidentin", "vizepräsident", "alterspräsident", "alterspräsidentin"]
OFFICE_WORDS = [
    "abgeordneter", "abgeordnete", "minister", "ministerin", "staatssekretär", "staatssekretärin", "staatsministerin", "staatsminister", "vorsitzender",
    "vorsitzende", "altersvorsitzender", "altersvorsitzende", "herr", "frau", "parlamentarischer", "parlamentarische",
]
PARTICLES = ["von", "van", "de", "der", "den", "zu", "zur", "zum", "la", "le", "di", "da"]
NAME_TOKEN = r"^[A-ZÄÖÜ][\p{L}\p{N}_.\-']*$"
NAME_UNIT = r"((?:[A-ZÄÖÜ][\p{L}\p{N}_.\-']*|da|de|den|der|di|la|le|van|von|zu|zum|zur)(?:\s+(?:[A-ZÄÖÜ][\p{L}\p{N}_.\-']*|da|de|den|der|di|la|le|van|von|zu|zum|zur))*)\s*\(([^)]{1,60})\)"
PARTY = r"\b(SPD|CDU|AfD|BSW|GRÜNE|Grüne|FDP|Linke|DIE LINKE|fraktionslos)\b"
OFFICE = r"(?iu)(minister|staatssekretär|staatssekretaer|ministerium|staatskanzlei|landesregierung|regierung|präsident|beauftragt)"


def name_and_role(c: Column) -> tuple[Column, Column]:
    """``Name (role)`` in two; without parentheses the role is empty."""
    shape = r"(?s)^(.*?)\s*\((.*)\)\s*$"
    return F.when(c.rlike(shape), F.trim(F.regexp_extract(c, shape, 1))).otherwise(F.trim(c)), F.trim(F.regexp_extract(c, shape, 2))


def name_tokens(c: Column) -> Column:
    """Words of a name without role and titles."""
    bare, _ = name_and_role(c)
    return F.filter(F.split(bare, r"\s+"), lambda t: (t != "") & ~F.lower(t).isin(TITLES))


def canonical_name(c: Column) -> tuple[Column, Column]:
    """(key, surname): lower case, without role and titles; all words if nothing but titles is there."""
    bare, _ = name_and_role(c)
    own = name_tokens(c)
    toks = F.when(F.size(own) > 0, own).otherwise(F.filter(F.split(bare, r"\s+"), lambda t: t != ""))
    return F.lower(F.array_join(toks, " ")), F.lower(F.coalesce(F.get(toks, F.size(toks) - 1), F.lit("")))


def like_person(c: Column) -> Column:
    """One to five words, the last with a capital, the others with one or particles."""
    t = name_tokens(c)
    ok = F.forall(t, lambda x: x.rlike(NAME_TOKEN) | F.lower(x).isin(PARTICLES))
    return F.coalesce(F.size(t).between(1, 5) & ok & F.get(t, F.size(t) - 1).rlike(NAME_TOKEN), F.lit(False))


def display_name(c: Column) -> Column:
    """Without leading words of office."""
    words = "|".join(OFFICE_WORDS)
    return F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), rf"(?iu)^(?:(?:{words})(?:\s+|$))+", "")


def with_role(full: Column, role: Column) -> Column:
    return F.when(F.coalesce(role, F.lit("")) != "", F.concat(full, F.lit(" ("), role, F.lit(")"))).otherwise(full)


def _units(text: str) -> Column:
    full, role = (F.regexp_extract_all(text, F.lit(NAME_UNIT), F.lit(i)) for i in (1, 2))
    return F.arrays_zip(full.alias("full"), role.alias("role"))


def mentions(docs: DataFrame, keys: list[str], cover: str = "cover", body: str = "body") -> DataFrame:
    """(keys, pos, full, role): persons of the cover with their party, then those of the body with their office, in order."""
    c = docs.select(*keys, F.lit(0).alias("src"), F.posexplode(_units(cover)).alias("k", "x")).where(F.col("x.role").rlike(PARTY) & ~F.lower("x.role").contains("antrag"))
    b = docs.select(*keys, F.lit(1).alias("src"), F.posexplode(_units(body)).alias("k", "x")).where(F.col("x.role").rlike(OFFICE))
    # of a body capture: the surname, titles and particles before it, and at most one given name
    titled = "|".join([*(t.replace(".", r"\.") for t in TITLES), *PARTICLES])
    trim = rf"(?iu)((?:(?:{titled})\s+)*(?:\S+\s+)?(?:(?:{titled})\s+)*\S+)$"
    b = b.withColumn("full", F.regexp_extract(F.trim("x.full"), trim, 1))
    both = c.withColumn("full", F.trim("x.full")).unionByName(b)
    full = display_name(F.col("full"))
    both = both.select(*keys, F.struct("src", "k").alias("pos"), full.alias("full"), F.trim("x.role").alias("role"))
    return both.where(like_person(F.col("full")) & (F.size(name_tokens(F.col("full"))) >= 2))


def merged(rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """(full, role) of one surname in order: the same person if the given names of one are among the other's; the longer name and the first role stay."""
    people: list[list] = []
    for full, role in rows:
        given = {t.lower() for t in full.split() if t.lower() not in TITLES}
        given -= {full.split()[-1].lower()}
        for p in people:
            if given <= p[2] or p[2] <= given:
                if len(full) > len(p[0]):
                    p[0], p[2] = full, given
                p[1] = p[1] or role
                break
        else:
            people.append([full, role, given])
    return [(p[0], p[1]) for p in people]


def directory(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, surname, full, role, key, n_same): the persons of a session; n_same tells how many bear the surname.

    The merge depends on the order, so the mentions of one session and surname are folded together.
    """
    _, surname = canonical_name(F.col("full"))
    g = found.select(*keys, surname.alias("surname"), "pos", "full", "role").groupBy(*keys, "surname").agg(F.array_sort(F.collect_list(F.struct("pos", "full", "role"))).alias("ms"))

    @F.pandas_udf("array<struct<full: string, role: string>>")  # built when called, where a session is
    def fold(ms: pd.Series) -> pd.Series:
        return ms.map(lambda xs: [{"full": f, "role": r} for f, r in merged([(x["full"], x["role"]) for x in xs])])

    g = g.withColumn("people", fold("ms"))
    d = g.select(*keys, "surname", F.size("people").alias("n_same"), F.explode("people").alias("p"))
    key, _ = canonical_name(F.col("p.full"))
    return d.select(*keys, "surname", "p.full", "p.role", key.alias("key"), "n_same")


def chairs(docs: DataFrame, people: DataFrame, keys: list[str], cover: str = "cover") -> DataFrame:
    """(keys, rank, key): persons named under the heading of the chair, with a party and a surname of one bearer, distinct and in order."""
    from pyspark.sql import Window as W

    region = F.regexp_extract(cover, r"(?ims)^Vorsitz\s*:(.*?)(?=^(?:Protokoll|Anwesend|Stellv|##\s)|\z)", 1)
    d = docs.withColumn("_r", region).select(*keys, F.posexplode(_units("_r")).alias("k", "x")).where(F.col("x.role").rlike(PARTY))
    _, surname = canonical_name(F.col("x.full"))
    d = d.select(*keys, "k", surname.alias("surname")).join(people.where("n_same = 1").select(*keys, "surname", "key"), [*keys, "surname"])
    d = d.groupBy(*keys, "key").agg(F.min("k").alias("k"))
    return d.select(*keys, F.row_number().over(W.partitionBy(*keys).orderBy("k")).alias("rank"), "key")
