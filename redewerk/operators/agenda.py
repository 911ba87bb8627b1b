"""Agendas on cover pages, and windows of turns under a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the shapes of agenda lines, and what is no title ------------------
SHAPES = (r"^-\s*(\d+)(?:\.\d+)?\s+(.+)$", r"^\|\s*(\d+)(?:\.\d+)?\s*\|\s*([^|]+?)\s*\|", r"^(\d+)\.\s+(\S.*)$", r"^(\d+)\s+(\S.*)$")
BARE = r"^(\d+)$"
NO_TITLE = r"^(\(|\d|(?i:\(?(teilweise\s+)?(öffentlich|nicht)))"
CLOSE_CUE = (
    r"(?iu)(schließ\w*\b[^.]{0,40}\btagesordnungspunkt|\bdamit\b[^.]{0,50}\b(abgelehnt|angenommen|beschlossen|abgestimmt)|"
    r"\btagesordnungspunkt\b[^.]{0,20}\bgeschlossen)"
)
# --- fixed values: how much of a turn and of a section a model is shown, and tokens of a window ------------
TURN_CAP, ANCHOR_CAP, BUDGET = 300, 400, 24000


def parsed_agenda(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, top, title): the first title of each number behind the first mention of the agenda.

    Bullet, table row, ordinal, plain, or a bare number whose title is the next line with text. Titles
    that begin with a parenthesis, a digit or a mark of (non-)publicity don't count. A fold over the lines.
    """
    at = F.regexp_instr(text, F.lit(r"(?im)Tagesordnung"))
    rest = F.when(at > 0, F.substring(F.col(text), at + F.length(F.lit("Tagesordnung")), F.length(text))).otherwise(F.lit(""))
    ls = F.transform(F.split(rest, r"\r?\n"), lambda x: F.btrim(x, F.lit(" \t\r")))
    start = F.struct(F.lit(None).cast("int").alias("open"), F.array().cast("array<struct<top:int,title:string>>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        n, title = F.lit(None).cast("int"), F.lit(None).cast("string")
        for shape in reversed(SHAPES):
            hit = s.rlike(shape)
            n, title = F.when(hit, F.regexp_extract(s, shape, 1).try_cast("int")).otherwise(n), F.when(hit, F.trim(F.regexp_extract(s, shape, 2))).otherwise(title)
        waiting = acc["open"].isNotNull()
        no = F.when(waiting, acc["open"]).otherwise(n)
        name = F.when(waiting, F.nullif(s, F.lit(""))).otherwise(title)
        good = no.isNotNull() & name.isNotNull() & ~F.coalesce(name.rlike(NO_TITLE), F.lit(True)) & ~F.exists(acc["out"], lambda o: o["top"] == no)
        bare = ~waiting & n.isNull() & s.rlike(BARE)
        opened = F.when(bare, F.regexp_extract(s, BARE, 1).try_cast("int")).when(waiting & (s == ""), acc["open"])
        return F.struct(opened.alias("open"), F.when(good, F.concat(acc["out"], F.array(F.struct(no.alias("top"), name.alias("title"))))).otherwise(acc["out"]).alias("out"))

    return docs.select(*keys, F.explode(F.aggregate(ls, start, step, lambda a: a["out"])).alias("x")).select(*keys, "x.top", "x.title")


def budget_windows(turns: DataFrame, keys: list[str], order: str, cost: Column, budget: int, base: int = 0) -> DataFrame:
    """(keys, order, window): greedy windows whose costs, with ``base`` for what each window shows besides, stay within the budget; each has at least one turn. A fold over each session's turns (cost and position only)."""
    g = turns.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), cost.cast("bigint").alias("c")))).alias("ts"))
    start = F.struct(F.lit(-1).alias("w"), F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<int>").alias("out"))

    def step(a: Column, t: Column) -> Column:
        new = (a["w"] < 0) | (a["sum"] + t["c"] > budget)
        w = F.when(new, a["w"] + 1).otherwise(a["w"])
        return F.struct(w.alias("w"), F.when(new, t["c"] + base).otherwise(a["sum"] + t["c"]).alias("sum"), F.concat(a["out"], F.array(w)).alias("out"))

    out = F.aggregate("ts", start, step, lambda a: a["out"])
    pairs = F.arrays_zip(F.transform("ts", lambda t: t["o"]).alias("o"), out.alias("w"))
    return g.select(*keys, F.explode(pairs).alias("x")).select(*keys, F.col("x.o").alias(order), F.col("x.w").alias("window"))


def turn_cost(text: Column, cap: int = TURN_CAP) -> Column:
    """A quarter of the capped characters plus eight."""
    return F.floor(F.length(F.substring(text, 1, cap)) / 4) + 8


def split_turns(turns: DataFrame, at: DataFrame, keys: list[str]) -> DataFrame:
    """Turns cut before a line: ``at`` (keys, turn_ix, line_ix). Both halves keep the speaker; turns are numbered anew."""
    from pyspark.sql import Window as W

    t = turns.join(at, [*keys, "turn_ix"], "left")
    inside = F.col("line_ix").between(1, F.size("lines") - 1)
    halves = F.when(inside, F.array(F.slice("lines", F.lit(1), F.col("line_ix")), F.slice("lines", F.col("line_ix") + 1, F.size("lines") - F.col("line_ix")))).otherwise(F.array(F.col("lines")))
    t = t.select(*keys, "turn_ix", "label", F.posexplode(halves).alias("half", "lines"))
    return t.withColumn("new_ix", F.row_number().over(W.partitionBy(*keys).orderBy("turn_ix", "half")))


def placement_prompt(agenda: list[tuple[int, str]], anchors: dict[int, str], turns: list[tuple[int, str, str]]) -> str:
    """Asks at which of the turns (number, label, text) the discussion of each item (number, title) begins; answer ``{item: turn or null}``."""
    items = [f"TOP {n}: {title}" + (f" | {anchors[n]}" if n in anchors else "") for n, title in agenda]
    said = [f"T{i} [{label}] {text[:TURN_CAP]}" for i, label, text in turns]
    return "\n".join(["Bei welchem Redebeitrag beginnt die Beratung jedes Punktes? Nicht fallend; gemeinsam beratene Punkte haben denselben. Nur JSON {Punkt: Nummer oder null}.", "", *items, "", *said])


def accepted(proposed: dict, pending: list[int], first: int, last: int, floor: int) -> list[tuple[int, int]]:
    """(item, turn) of an answer that count, in the order of the items: within the window and not before the one accepted last. Keys and values may be written as ``TOP 1`` and ``T6``."""
    import re

    at = {int(k[0]): int(v[0]) for a, b in proposed.items() if (k := re.search(r"\d+", str(a))) and b is not None and (v := re.search(r"\d+", str(b)))}
    out = []
    for n in pending:
        i = at.get(n)
        if i is not None and first <= i <= last and i >= floor:
            out.append((n, i))
            floor = i
    return out


def placed_by_model(turns: DataFrame, agenda: DataFrame, anchors: DataFrame, keys: list[str], build, budget: int = BUDGET) -> DataFrame:
    """(keys, top, turn_ix): where a model sees each agenda item (keys, top, title) begin in the turns (keys, turn_ix, label, text).

    anchors (keys, top, section) are shown beside the items. Windows of turns follow one another; each asks for the items not
    placed yet, so a session's windows are asked in order by one task, which holds the capped texts of one session.
    """
    from .providers import json_answer

    t = turns.select(*keys, "turn_ix", "label", F.substring(F.coalesce("text", F.lit("")), 1, TURN_CAP).alias("text"))
    t = t.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("turn_ix", "label", "text"))).alias("ts"))
    a = agenda.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("top", "title"))).alias("items"))
    s = anchors.select(*keys, "top", F.substring(F.regexp_replace("section", r"\s+", " "), 1, ANCHOR_CAP).alias("s")).groupBy(*keys).agg(F.collect_list(F.struct("top", "s")).alias("anchors"))
    rows = t.join(a, keys).join(s, keys, "left")
    schema = rows.select(*keys).schema.add("top", T.IntegerType()).add("turn_ix", T.IntegerType())

    def run(parts):
        import pandas as pd

        model = build()
        for pdf in parts:
            out = []
            for r in pdf.to_dict("records"):
                ts = [(int(x["turn_ix"]), x["label"], x["text"]) for x in r["ts"]]
                items = [(int(x["top"]), x["title"]) for x in r["items"]]
                show = {} if r["anchors"] is None else {int(x["top"]): x["s"] for x in r["anchors"]}
                base, found, floor, at = len(placement_prompt(items, show, [])) // 4, {}, 0, 0
                while at < len(ts) and len(found) < len(items):
                    end, cost = at, base
                    while end < len(ts) and (end == at or cost + len(ts[end][2]) // 4 + 8 <= budget):
                        cost += len(ts[end][2]) // 4 + 8
                        end += 1
                    pending = [x for x in items if x[0] not in found]
                    answer = json_answer(model.complete(placement_prompt(pending, show, ts[at:end])))
                    for n, i in accepted(answer, [n for n, _ in pending], ts[at][0], ts[end - 1][0], floor):
                        found[n], floor = i, i
                    at = end
                out += [(*(r[k] for k in keys), n, i) for n, i in found.items()]
            yield pd.DataFrame(out, columns=schema.names)

    return rows.mapInPandas(run, schema)


def boundary_prompt(lines: list[str]) -> str:
    """Asks for the last of the numbered lines that still belongs to the item before; answer ``{"last_prev_line": n}``."""
    return "\n".join(["Welches ist die letzte Zeile, die noch zum vorherigen Punkt gehört (0: keine)? Nur JSON {\"last_prev_line\": N}.", "", *(f"{i}. {x}" for i, x in enumerate(lines, 1))])


def boundary_cuts(turns: DataFrame, tops: DataFrame, keys: list[str], build) -> DataFrame:
    """(keys, turn_ix, line_ix): turns that open an item but close the one before (by the cue), and how many of their lines a model leaves to that one.

    turns: keys, turn_ix, text, lines (what is said in each line). The first item of a session has none before it. No line or all lines make no cut.
    """
    from pyspark.sql import Window as W

    from .providers import applied, json_answer

    first = F.row_number().over(W.partitionBy(*keys).orderBy("turn_ix", "top")) == 1
    opening = tops.withColumn("_first", first).where("not _first").select(*keys, "turn_ix").distinct()
    t = turns.where(F.col("text").rlike(CLOSE_CUE) & (F.size("lines") > 1)).join(opening, [*keys, "turn_ix"]).select(*keys, "turn_ix", "lines")

    def ask(model, lines) -> int | None:
        n = json_answer(model.complete(boundary_prompt(list(lines)))).get("last_prev_line")
        return n if isinstance(n, int) and not isinstance(n, bool) else None

    out = applied(t, ["lines"], build, ask, T.IntegerType())
    return out.where((F.col("value") > 0) & (F.col("value") < F.size("lines"))).select(*keys, "turn_ix", F.col("value").alias("line_ix"))


def moved_tops(tops: DataFrame, cuts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, top, turn_ix) after :func:`split_turns`: an item whose turn was cut begins with the second half, later ones move on by the cuts before them."""
    j = tops.join(cuts.select(*keys, F.col("turn_ix").alias("_c")), keys, "left")
    return j.groupBy(*keys, "top", "turn_ix").agg(F.count_if(F.col("_c") <= F.col("turn_ix")).alias("_n")).select(*keys, "top", (F.col("turn_ix") + F.col("_n")).cast("int").alias("turn_ix"))


def tag_report(agenda: DataFrame, tops: DataFrame, keys: list[str], method: str) -> DataFrame:
    """(keys, cover_tops, transcript_tops, cover_only, transcript_only, agenda_titles, method): one row a session with an agenda or a tag."""
    a = agenda.groupBy(*keys).agg(F.array_sort(F.collect_set("top")).alias("cover_tops"), F.map_from_entries(F.array_sort(F.collect_set(F.struct("top", "title")))).alias("agenda_titles"))
    t = tops.groupBy(*keys).agg(F.array_sort(F.collect_set("top")).alias("transcript_tops"))
    none = F.array().cast("array<int>")
    j = a.join(t, keys, "full").withColumns({"cover_tops": F.coalesce(F.col("cover_tops").cast("array<int>"), none), "transcript_tops": F.coalesce(F.col("transcript_tops").cast("array<int>"), none)})
    return j.select(*keys, "cover_tops", "transcript_tops", F.array_except("cover_tops", "transcript_tops").alias("cover_only"), F.array_except("transcript_tops", "cover_tops").alias("transcript_only"), "agenda_titles", F.lit(method).alias("method"))
