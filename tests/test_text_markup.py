"""Turns, rendering, sections, cleaning and agendas on small invented texts."""

import random

from pyspark.sql import functions as F

from redewerk.functions import similarity as sim
from redewerk.functions import text as X
from redewerk.operators import agenda, cleaning, dataset, intervals, sections, turns

TRANSCRIPT = """---
model: x
---
vorab
<SD-TOP>TOP 1</SD>
<SD-SPK>Anna Ast (SPV)</SD>
[00:00:01.000 --> 00:00:02.000] Guten Tag.
Zwischenzeile
<SD-SPK>Anna Ast (SPV)</SD>
[00:00:03.000 --> 00:00:04.000] Weiter so.

<SD-TOP>TOP 2</SD>
<SD-SPK>SPEAKER_01</SD>
[00:00:05.000 --> 00:00:06.000] Danke."""


def one(df):
    return [tuple(r) for r in df.collect()]


def test_turns(spark):
    d = spark.createDataFrame([("s", TRANSCRIPT), ("leer", ""), ("null", None)], "stem string, text string")
    got = sorted(one(turns.parse_turns(d).select("stem", "turn_ix", "label", "text", "top")))
    assert got == [("s", 1, "Anna Ast (SPV)", "Guten Tag.", 1), ("s", 2, "Anna Ast (SPV)", "Weiter so.", 1), ("s", 3, "SPEAKER_01", "Danke.", 2)]


def test_render_merges_and_keeps_all_lines(spark):
    d = spark.createDataFrame([("s", TRANSCRIPT.split("---\n")[-1]), ("leer", "")], "stem string, text string")
    got = dict(one(turns.render(d)))
    assert got["s"] == "vorab\nAnna Ast (SPV): Guten Tag. Zwischenzeile Weiter so.\nSPEAKER_01: Danke."
    assert got["leer"] == ""


def test_placeholders_longest_first(spark):
    d = spark.createDataFrame([("s", "SPEAKER_10 dann SPEAKER_1 dann SPEAKER_10")], "stem string, text string")
    assert one(turns.placeholders(d, ["A", "B"]).select("text")) == [("A dann B dann A",)]


def test_sections_rise(spark):
    text = "vor\n## Zu TOP 1 Erstes\na\n## Zu TOP 3\nb\n## Zu TOP 2 zurück\nc\n## Zu TOP 0\n## Zu TOP 4\n"
    d = spark.createDataFrame([("s", text), ("n", None), ("o", "ohne")], "stem string, text string")
    got = one(sections.minutes_sections(d, ["stem"]).orderBy("top"))
    assert [(t, s.split("\n")[0]) for _, t, s in got] == [(1, "## Zu TOP 1 Erstes"), (3, "## Zu TOP 3"), (4, "## Zu TOP 4")]
    assert "c" in got[1][2] and "TOP 0" in got[1][2]


def test_sections_against_greedy(spark):
    rnd = random.Random(3)
    texts, want = [], {}
    for i in range(60):
        ns = [rnd.randint(0, 9) for _ in range(rnd.randint(0, 12))]
        texts.append((i, "".join(f"<SD-TOP>TOP {n}</SD>x{k} " for k, n in enumerate(ns))))
        last, kept = 0, []
        for n in ns:
            if n > last:
                kept.append(n)
                last = n
        want[i] = kept
    got = {}
    for i, t, _ in one(sections.transcript_sections(spark.createDataFrame(texts, "stem int, text string"), ["stem"]).orderBy("stem", "top")):
        got.setdefault(i, []).append(t)
    assert got == {k: v for k, v in want.items() if v}


def test_merged_sections(spark):
    text = (
        "## Beschlüsse und Festlegungen\n\n## Zu TOP 1:\n\nAngenommen.\n\n## Zu TOP 3:\n\nVertagt.\n\n"
        "## Aus der Beratung\n\n## Zu TOP 1 Haushalt\n\nund Nachtrag\n\nDer Vorsitzende eröffnet.\n\n## Zu TOP 2 Wege\n\nText.\n\n## Anlage\n\nweg"
    )
    d = spark.createDataFrame([("s", text), ("e", "## Zu TOP 7 Nur eins\n\nText.")], "stem string, text string")
    got = {(s, t): x for s, t, x in one(sections.merged_sections(d, ["stem"]))}
    assert got["s", 1] == "## Zu TOP 1: Haushalt und Nachtrag\n\nAngenommen.\n\nAus der Beratung\n\nDer Vorsitzende eröffnet."
    assert got["s", 2] == "## Zu TOP 2: Wege\n\nText." and got["s", 3] == "## Zu TOP 3:\n\nVertagt."
    assert got["e", 7] == "## Zu TOP 7: Nur eins\n\nText."


def test_titles(spark):
    m = "## Zu TOP 1: Beschluss\n## Zu TOP 11 Elf\n## Zu TOP 1   Der   Titel –\n"
    d = spark.createDataFrame([(m, 1), (m, 11), (m, 2)], "m string, n int")
    assert [r[0] for r in d.select(sections.title_of(F.col("m"), F.col("n"))).collect()] == ["Der Titel", "Elf", "TOP 2"]


def test_cleaning_steps(spark):
    body = (
        "Deckblatt\n## Beschlüsse und Festlegungen\n- Zu TOP 1\nDie  Schul- kinder und Bildungs- und Sport. 12\n12 Vgl. Anlage 3\n[Link](https://x.test)\n"
        "HA\nText am Ende HA\n##\n<!-- image -->\n7. (öffentliche) Sitzung des HA\n01.02.2036\n(Anlage) Schluss\n\n\n\n## Anlage 1\nweg"
    )
    r = cleaning.clean_minutes(spark.createDataFrame([(body,), ("nichts",)], "text string")).select("cover", "body", "matched").collect()
    assert r[0]["cover"] == "Deckblatt\n" and r[0]["matched"]
    assert r[0]["body"].split("\n")[:4] == ["## Beschlüsse und Festlegungen", "## Zu TOP 1", "Die Schulkinder und Bildungs- und Sport.", ""]
    for gone in ("Vgl", "https", "image", "Sitzung", "(Anlage)", "weg", "Ende HA"):
        assert gone not in r[0]["body"]
    assert r[1]["body"] == "" and not r[1]["matched"]


def test_agenda(spark):
    cover = "Kopf 1 x\nTagesordnung:\n- 1 Erster\n| 2 | Zweiter | x |\n3. Dritter\n4\n\nVierter\n5 (öffentlich)\n2. Nochmal\n6.1 Sechster\n"
    d = spark.createDataFrame([("s", cover), ("n", None)], "stem string, text string")
    assert sorted(one(agenda.parsed_agenda(d, ["stem"]).select("top", "title"))) == [(1, "Erster"), (2, "Zweiter"), (3, "Dritter"), (4, "Vierter")]


def test_budget_windows(spark):
    d = spark.createDataFrame([("s", i, c) for i, c in enumerate([5, 5, 5, 20, 1, 1])], "stem string, ord int, c int")
    assert [r["window"] for r in agenda.budget_windows(d, ["stem"], "ord", F.col("c"), 10).orderBy("ord").collect()] == [0, 0, 1, 2, 3, 3]


def test_split_turns(spark):
    t = spark.createDataFrame([("s", 1, "A", ["x", "y", "z"]), ("s", 2, "B", ["w"])], "stem string, turn_ix int, label string, lines array<string>")
    at = spark.createDataFrame([("s", 1, 2)], "stem string, turn_ix int, line_ix int")
    assert [(r["label"], r["lines"]) for r in agenda.split_turns(t, at, ["stem"]).orderBy("new_ix").collect()] == [("A", ["x", "y"]), ("A", ["z"]), ("B", ["w"])]


def test_tags_placed(spark):
    t = spark.createDataFrame([("s", i) for i in range(6)], "stem string, turn_ix int")
    tags = spark.createDataFrame([("s", 1, 0), ("s", 2, 2), ("s", 3, 2), ("s", 4, 9), ("s", 5, 4)], "stem string, top int, turn_ix int")
    assert sorted(r["top"] for r in sections.placed(tags, t, ["stem"]).collect()) == [1, 2, 5]
    assert sorted(r["top"] for r in sections.placed(tags, t, ["stem"], keep_ties=True).collect()) == [1, 2, 3, 5]


def test_intervals_against_sweep(spark):
    rnd = random.Random(7)
    segs, trns, want = [], [], {}
    for s in range(30):
        own = []
        for k in range(rnd.randint(0, 6)):
            a = rnd.randint(0, 300)
            own.append((float(a), float(a + rnd.randint(1, 90)), f"S{k}"))
        trns += [(str(s), *t) for t in own]
        now = None
        at = 0
        for o in range(rnd.randint(1, 8)):
            a = at + rnd.randint(0, 40)
            b = a + rnd.randint(1, 70)
            at = a
            segs.append((str(s), o, float(a), float(b), "x"))
            best = max(((min(b, t[1]) - max(a, t[0]), -t[0], -t[1], t[2]) for t in own), default=(0,))
            if best[0] > 0:
                now = best[3]
            elif now is None and own and o == 0:
                now = min(own, key=lambda t: (abs((a + b) / 2 - (t[0] + t[1]) / 2), t[0], t[2]))[2]
            want[str(s), o] = now or "UNKNOWN"
    a = spark.createDataFrame(segs, "session string, ord int, start double, end double, text string")
    t = spark.createDataFrame(trns, "session string, start double, end double, speaker string")
    assert {(r["session"], r["ord"]): r["speaker"] for r in intervals.assigned(a, t, ["session"]).collect()} == want


def test_speaker_groups_drop_after_grouping(spark):
    d = spark.createDataFrame([("s", 0, 0.0, 1.0, "A", "x"), ("s", 1, 1.0, 2.0, "B", " "), ("s", 2, 2.0, 3.0, "A", "y"), ("s", 3, 3.0, 4.0, "A", "")], "session string, ord int, start double, end double, speaker string, text string")
    assert [(r["speaker"], r["start"], r["end"]) for r in turns.speaker_groups(d, ["session"]).orderBy("island").collect()] == [("A", 0.0, 1.0), ("A", 2.0, 4.0)]


def test_pinned_split_is_md5(spark):
    import hashlib

    keys = [f"abc {i}" for i in range(200)]
    got = {r[0]: r[1] for r in spark.createDataFrame([(k,) for k in keys], "k string").select("k", X.pinned_number(F.col("k"))).collect()}
    assert got == {k: int.from_bytes(hashlib.md5(f"42:{k}".encode()).digest()[:8], "big") % 10000 for k in keys}


def test_clock(spark):
    d = spark.createDataFrame([(0.42,), (-3.0,), (59.9996,), (3723.5,)], "x double")
    assert [r[0] for r in d.select(X.clock(F.col("x"))).collect()] == ["00:00:00.420", "00:00:00.000", "00:01:00.000", "01:02:03.500"]


def test_similarity():
    assert round(sim.token_sort("ard_1_", "ard_11_"), 1) == 92.3
    assert sim.token_set("a b c", "c b a") == 100.0 and sim.token_set("", "a") == 0.0
    assert sim.token_set("x y", "x y z") == 100.0


def test_filters_in_order(spark):
    c = [("a", 1, " ".join(["w"] * 31), 10), ("a", 2, " ".join(["w"] * 32), 10), ("a", 3, "kurz", 10), ("b", 1, " ".join(["w"] * 40), 100), ("b", 2, " ".join(["w"] * 40), 101), ("b", None, None, None)]
    cand = spark.createDataFrame(c, "stem string, top int, target string, seq_tokens int")
    ex = spark.createDataFrame([("a", 3), ("a", 3)], "stem string, top int")
    got = {(r["stem"], r["top"]): r["reason"] for r in dataset.judged(cand, ex, 32, 100).collect()}
    assert got == {("a", 1): "short-target", ("a", 2): None, ("a", 3): "speaker-excluded", ("b", 1): None, ("b", 2): "over-cap", ("b", None): "short-target"}
    rows = dataset.split_with_overflow(dataset.judged(cand, ex, 32, 100), 1.0, 42, 50)
    led = {(r["stem"], r["top"]): (r["reason"], r["disposition"]) for r in dataset.reject_ledger(rows).collect()}
    assert led["b", "1"] == ("val-overflow", "rerouted") and led["b", "document"][0] == "short-target" and ("a", "2") not in led


def test_upper_median(spark):
    d = spark.createDataFrame([("g", x) for x in (1, 2, 3, 4)] + [("h", 5)], "g string, x int")
    assert dict(one(dataset.upper_median(d, ["g"], "x"))) == {"g": 3, "h": 5}


def test_exclusions_numbers_before_words(spark):
    a = spark.createDataFrame([("s", 10), ("s", 2)], "stem string, top int")
    b = spark.createDataFrame([("s", "document"), ("s", "2")], "stem string, top string")
    assert dataset.merged_exclusions(a, b).collect()[0]["tops"] == ["2", "10", "document"]
