"""The training-data operators against brute force, round trips and the edge cases they define."""

import random
from collections import Counter

import pytest

pytest.importorskip("redewerk.llm")

from pyspark.sql import functions as F  # noqa: E402

from redewerk.llm import defects, encoding, leaks, names, overlaps, packing, pieces, scans, splits, turns  # noqa: E402

MSG = "array<struct<role: string, content: string>>"
META = "struct<stem: string, top: int, strategy: string, src_tokens: int, tgt_tokens: int, seq_tokens: int>"
REC = f"rec_id bigint, messages {MSG}, meta {META}, split string, author string, source string, built_at timestamp"
MAN = "example string, stem string, split_note string"


def record(i, stem=None, author=None, source=None, user="u", answer="a", split="train", strategy=None):
    msgs = None if user is None and answer is None else [("system", "s"), ("user", user), ("assistant", answer)]
    return (i, msgs, (stem, 1, strategy, 1, 1, 1), split, author, source, None)


def frame(spark, rows, schema=REC, extra=True):
    d = spark.createDataFrame(rows, schema)
    # columns that clash with names used inside must not matter
    return d.withColumn("words", F.lit("x")).withColumn("key", F.lit(1)).withColumn("cls", F.lit(1)) if extra else d


# ------------------------------------------------------------------ 1
def components(rows):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for i, keys in rows:
        find(("r", i))
        for k in keys:
            parent[find(("r", i))] = find(k)
    groups = {}
    for i, _ in rows:
        groups.setdefault(find(("r", i)), set()).add(i)
    return {i: min(g) for g in groups.values() for i in g}, {min(g): len(g) for g in groups.values()}


def test_groups_against_union_find(spark, tmp_path):
    rnd = random.Random(1)
    rows, keys = [], []
    for i in range(300):
        s, a, r = rnd.randint(1, 150), rnd.randint(1, 200), rnd.randint(1, 250)
        stem = rnd.choice([f"ABC_1_{s}", f"abc_1_{s}_", f"  abc 1 {s} ", f"ABC-1-{s}", f"ABC_1_{s}_Transkript.pt03.md", None])
        author = rnd.choice([f"PF-{a:06}", f" PF {a:06}", f"pf_{a:06}", "N.N.", "?", "-", "unbekannt", None])
        source = rnd.choice([f"aufnahme/{r:08}.mp3", f"Aufnahme\\{r:08}.MP3", f"aufnahme/{r:08}", None])
        rows.append(record(i, stem, author, source))
        keys.append((i, [k for k in (stem and ("s", s), author and author[-1].isdigit() and ("a", a), source and ("q", r)) if k]))
    rows += rows[:5]
    want, size = components(keys)
    man = frame(spark, [("x", "abc 1 7", "n")], MAN)
    held = {want[i] for i, k in keys if ("s", 7) in k}
    got = splits.found(frame(spark, rows), man, splits.ComponentStore(spark, f"file://{tmp_path}/c")).collect()
    assert {(r["rec_id"], r["group_id"], r["held"]) for r in got} == {(i, g, int(g in held)) for i, g in want.items() if size[g] > 1}
    assert len(got) == len({r["rec_id"] for r in got})


def test_splits_incremental(spark, tmp_path):
    man = frame(spark, [("x", "ABC_1_1", "n")], MAN)
    store = splits.ComponentStore(spark, f"file://{tmp_path}/c")
    first = [record(i, f"ABC_2_{i // 2}") for i in range(2000)] + [record(5000, "ABC_1_1"), record(5001, "abc_1_1_")]
    state, _ = splits.update(store.read(), frame(spark, first), man)
    state = store.write(state)
    n = {r["split"]: r["n"] for r in state.comps.groupBy("split").agg(F.sum("n").alias("n")).collect()}
    assert abs(n["train"] - 1602) < 20 and abs(n["validation"] - 200) < 20 and abs(n["test"] - 200) < 20
    of = {r["comp"]: r["split"] for r in state.comps.collect()}
    assert of[5000] != "train"
    train = [c for c, s in of.items() if s == "train"][:2]
    test = next(c for c, s in of.items() if s == "test" and c != 5000)
    # joins two of train: stays; joins train with test: quarantine; new ones: filled
    second = [record(9000, f"ABC_2_{train[0] // 2}", "PF-1"), record(9001, f"ABC_2_{train[1] // 2}", "PF-1"), record(9002, f"ABC_2_{train[1] // 2}", None, "a/77.mp3"), record(9004, None, None, None)]
    later, _ = splits.update(store.read(), frame(spark, second), man)
    later = store.write(later)
    now = {r["comp"]: (r["split"], r["n"]) for r in later.comps.collect()}
    assert now[min(train)] == ("train", 7) and max(train) not in now and 9004 in now
    assert all(now[c][0] == s for c, s in of.items() if c in now)
    third = [record(9100, f"ABC_2_{train[0] // 2}", "PF-2"), record(9101, f"ABC_2_{test // 2}", "PF-2")]
    last, _ = splits.update(store.read(), frame(spark, third), man)
    assert {r["comp"]: r["split"] for r in last.comps.collect()}[min(min(train), test)] == splits.QUARANTINE


def test_splits_delivered_again(spark, tmp_path):
    man = frame(spark, [], MAN)
    store = splits.ComponentStore(spark, f"file://{tmp_path}/c")
    rows = [record(1), record(2, "ABC_1_2"), record(3, "ABC_1_2"), record(4, None, "PF-4"), record(5, "ABC_1_9", "PF-5")]
    store.write(splits.update(store.read(), frame(spark, rows), man)[0])
    # a second delivery changes nothing; a corrected record ties its old component to another; late ones join
    assert {(r["rec_id"], r["group_id"]) for r in splits.found(frame(spark, rows), man, store).collect()} == {(2, 2), (3, 2)}
    got = {(r["rec_id"], r["group_id"]) for r in splits.found(frame(spark, [record(4, "ABC_1_9"), record(0, None, "PF-4"), record(1)]), man, store).collect()}
    assert got == {(4, 4), (0, 4)}
    state = store.read()
    assert {r["rec_id"]: r["comp"] for r in state.records.collect()} == {0: 4, 1: 1, 2: 2, 3: 2, 4: 4, 5: 4}
    assert {r["comp"]: r["n"] for r in state.comps.collect()} == {1: 1, 2: 2, 4: 3}
    assert {r["comp"] for r in state.keys.collect()} == {1, 2, 4}


def test_splits_with_hot_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(splits, "LEAST_HOT", 100)
    rows = [record(i, "ABC_1_1" if i % 3 else f"ABC_2_{i}", f"PF-{i // 6}") for i in range(4000)]
    man = frame(spark, [], MAN)
    got = splits.found(frame(spark, rows), man, splits.ComponentStore(spark, f"file://{tmp_path}/c")).collect()
    assert {(r["rec_id"], r["group_id"]) for r in got} == {(i, 0) for i in range(4000)}


def test_splits_empty(spark, tmp_path):
    man = frame(spark, [], MAN)
    assert splits.found(frame(spark, []), man, splits.ComponentStore(spark, f"file://{tmp_path}/c")).count() == 0
    one = splits.found(frame(spark, [record(1), record(None, "A_1_1")]), man, splits.ComponentStore(spark, f"file://{tmp_path}/d"))
    assert one.count() == 0


def test_roots_of_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901)], "a bigint, b bigint")
    assert {r["node"]: r["root"] for r in splits.roots_of(e).collect()} == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


# ------------------------------------------------------------------ 2
def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_overlaps_against_brute_force(spark):
    rnd = random.Random(4)
    vocab = [f"wort{i}" for i in range(300)]
    texts = []
    for i in range(60):
        if i % 3 and texts:
            t = [w if rnd.random() > rnd.choice([0.05, 0.15, 0.3]) else rnd.choice(vocab) for w in rnd.choice(texts)]
        else:
            t = [rnd.choice(vocab) for _ in range(rnd.randint(60, 90))]
        texts.append(t)
    texts += [texts[0], texts[3]]
    rows = []
    for i, t in enumerate(texts):
        s = " ".join(t)
        s = f"Bitte:\n\nTOP: x\n\nTranskript:\n{s.upper()}!\n\nZusammenfassung:" if i % 2 else s.replace(" ", ",  ")
        rows.append(record(i, f"ABC_1_{i}", user=s, split=["train", "val", None][i % 3] if i < 60 else "val"))
    rows += [record(100, user=None, answer=None), record(101, user=""), record(102, user="kurz", split="val"), record(103, user="Kurz!"), rows[0]]
    man = frame(spark, [("x", "abc 1 3", "test set only, do not train"), ("y", "ABC-1-1", "released to train after review")], MAN)
    side = {i: (r[3] == "train") for i, r in enumerate(rows[:62])}
    side[3], side[1] = False, True
    want = {(a, b) for a in range(62) for b in range(a + 1, 62) if side[a] != side[b] and lcs(texts[a], texts[b]) >= 0.8 * max(len(texts[a]), len(texts[b]))}
    pairs = overlaps.overlaps(overlaps.splits_of(frame(spark, rows), man))
    got = {tuple(sorted((r["eval_rec"], r["train_rec"]))) for r in pairs.collect()}
    assert (102, 103) in got
    assert got - {(102, 103)} == want and len(want) > 5


def test_report_counts_pairs(spark):
    rnd = random.Random(30)
    base = [" ".join(rnd.choice("abcdefghij") * 3 for _ in range(40)) for _ in range(3)]
    near = base[0].replace("aaa", "zzz", 1)
    rows = [record(i, user=rnd.choice([*base, near, f"nur hier {i}"]), split=rnd.choice(["train", "train", "val", "test", None]), source=rnd.choice(["q1", "q2", None])) for i in range(120)]
    sides = overlaps.splits_of(frame(spark, rows), frame(spark, [], MAN))
    of = {r[0]: (r[3] if r[3] in ("train", "test") else "validation" if r[3] == "val" else "none", r[5]) for r in rows}
    want = {}
    for p in overlaps.overlaps(sides).collect():
        g = want.setdefault(of[p["eval_rec"]], (set(), set(), []))
        g[0].add(p["eval_rec"]), g[1].add(p["train_rec"]), g[2].append(1)
    got = {(r["split"], r["source"]): (r["eval_records"], r["train_records"], r["pairs"]) for r in overlaps.report(sides).collect()}
    assert got == {k: tuple(map(len, v)) for k, v in want.items()} and len(got) > 5


def test_agreement():
    a = [str(i) for i in range(10)]
    assert overlaps.agreement_reached(a, a[:8]) and not overlaps.agreement_reached(a, a[:7]) and overlaps.agreement_reached(a, a[2:])
    assert not overlaps.agreement_reached(a, list(reversed(a)))


@pytest.mark.parametrize("edits", [0.08, 0.15])
def test_overlaps_in_large_group_of_copies(spark, edits):
    rnd = random.Random(20)
    vocab = [f"wort{i}" for i in range(3000)]
    base = [rnd.choice(vocab) for _ in range(100)]
    texts = [[rnd.choice(vocab) if rnd.random() < rnd.uniform(0.08, edits) else w for w in base] for _ in range(60)]
    # every fifth word of a copy edited leaves no run of five words
    texts += [[f"neu{i}" if i % 5 == 2 else w for i, w in enumerate(base)], base]
    texts += [[rnd.choice(vocab) for _ in range(100)] for _ in range(124)]
    rows = [record(i, user=" ".join(t), split="val" if i % 4 == 0 or i == 61 else "train") for i, t in enumerate(texts)]
    side = {r[0]: r[3] == "train" for r in rows}
    want = {(a, b) for a in range(186) for b in range(a + 1, 186) if side[a] != side[b] and overlaps.agreement_reached(texts[a], texts[b])}
    got = overlaps.overlaps(overlaps.splits_of(frame(spark, rows), frame(spark, [], MAN))).collect()
    assert {tuple(sorted((r["eval_rec"], r["train_rec"]))) for r in got} == want and (60, 61) not in got and len(want) > 50


# ------------------------------------------------------------------ 3
def test_names(spark):
    m = [
        (1, "Dr. Theodor Grubenmeißner", "KLP"), (2, "Grubenmeissner, T.", "klp"), (3, "GRUBENMEISZNER Theodor".replace("SZ", "SS"), None), (4, "Theo Grubenmeißnre (KLP)", None), (5, "Abg. Grubenmeißner", "KLP-Fraktion"),
        (6, "Nikolaus Karstpfeil", "SPV"), (7, "Benedikt Karstpfeil", "LBU"), (8, "B. Karstpfeil (LBU)", "Mitglied"), (9, "Karstpfeil, Niko", None), (10, "Gen. Radverkehr Langwarft e.V.", "Gast"),
        (11, "Langwarft, Genossenschaft Radverkehr", None), (12, "Radverkehr-Genossenschaft Langwarft", "gast"), (13, "Genossenschaft Radverkehr Kurzwarft", "Gast"), (14, None, None), (15, " ", None), (1, "Dr. Theodor Grubenmeißner", "KLP"),
        (16, "Theodor Grubenmeißner", "KLP"), (17, "Theodor Grubenmeißner", None),
    ]
    rows = [(i, "s", "ABC", 1, n, r, None) for i, n, r in m] + [(50, "s", "ABC", 2, "Theodor Grubenmeißner", "KLP", None), (51, "s", None, None, "Theodor Grubenmeißner", "KLP", None)]
    d = frame(spark, rows, "mention_id bigint, stem string, committee string, wp int, full_name string, role string, surname string")
    of = {r["mention_id"]: r["entity"] for r in names.linked(d).collect()}
    assert {i for i, e in of.items() if e == of[1]} == {1, 2, 3, 4, 5, 16, 17}
    assert {i for i, e in of.items() if e == of[6]} == {6, 9} and {i for i, e in of.items() if e == of[7]} == {7, 8}
    assert {i for i, e in of.items() if e == of[10]} == {10, 11, 12} and of[13] == 13
    assert 14 not in of and 15 not in of and of[50] == 50 and of[51] == 51
    assert names.linked(d.limit(0)).count() == 0


def test_given_names():
    assert names.given_likeness("josi", names.fold("Josephine")) == 1.0 and names.given_likeness("fine", "josi") == 1.0
    assert names.given_likeness("m.", "margarete") > 0 and names.given_likeness("jos.", "johannes") == 0.0 and names.given_likeness("theodor", "theoor") > 0.9
    assert names.parsed("Sandmeißner, H.")[1:3] == ("h.", "sandmeissner") and names.parsed("Dr.Abgeordnete(r) Bornfuß (NDL)")[1:4] == ("", "bornfuss", "ndl")


def test_short_forms_are_learned(spark):
    rnd = random.Random(24)
    part = lambda: "".join(rnd.choice("bdfgklmnrst") + rnd.choice("aeiou") for _ in range(4))
    rows = []
    for i in range(24):
        f = part()
        rows += [(f"Quirinus {f}",), (f"Zacki {f}" if i < 8 else f"Quirinus {f}",), (f"Alma {part()}",)]
    d = frame(spark, [(i, "s", "ABC", 1, n.title(), None, None) for i, (n,) in enumerate(rows)], "mention_id bigint, stem string, committee string, wp int, full_name string, role string, surname string")
    of = {r["mention_id"]: r["entity"] for r in names.linked(d).collect()}
    assert all(of[3 * i] == of[3 * i + 1] == 3 * i and of[3 * i + 2] % 3 == 2 for i in range(24))


def test_typed_names_recall(spark):
    """Single typing errors anywhere in a name: every variant goes to its person, against brute force over all pairs."""
    rnd = random.Random(25)
    part = lambda: "".join(rnd.choice("bdfgklmnrst") + rnd.choice("aeiou") for _ in range(5))
    rows, want = [], {}
    for p in range(150):
        given, family = part(), part()
        for _ in range(4):
            x = f"{given} {family}"
            if rows and _:
                i = rnd.randrange(1, len(x) - 1)
                x = rnd.choice([x[:i] + x[i + 1 :], x[:i] + rnd.choice("abcdefg") + x[i:], x]) if " " not in x[i - 1 : i + 1] else x
            want[len(rows)] = p
            rows.append((len(rows), "s", "ABC", 1, x.title(), None, None))
    d = frame(spark, rows, "mention_id bigint, stem string, committee string, wp int, full_name string, role string, surname string")
    of = {r["mention_id"]: r["entity"] for r in names.linked(d).collect()}
    pairs = [(a, b) for a in want for b in want if a < b and want[a] == want[b]]
    assert sum(of[a] == of[b] for a, b in pairs) >= 0.97 * len(pairs)
    assert all(want[i] == want[e] for i, e in of.items())


def test_bands_recall():
    rnd = random.Random(2)
    met = n = 0
    for _ in range(300):
        a = "".join(rnd.choice("abcdefghiklmnoprstuw") for _ in range(rnd.randint(8, 13)))
        i = rnd.randrange(1, len(a) - 1)
        b = rnd.choice([a[:i] + a[i + 1 :], a[:i] + "x" + a[i + 1 :], a[:i] + a[i + 1] + a[i] + a[i + 2 :]])
        n += 1
        met += bool(set(names.bands(a, "s")) & set(names.bands(b, "s")))
    assert met / n > 0.97


def test_distance():
    assert names.distance("abcd", "abdc", 2) == 1 and names.distance("abcd", "axcd", 2) == 1 and names.distance("abc", "xyz", 2) == 3


# ------------------------------------------------------------------ 4
def test_pieces_round_trip():
    rnd = random.Random(5)
    for limit, overlap in ((50, 10), (30, 0), (7, 6), (20, 50)):
        for style in ("turns", "plain", "nothing"):
            words = [f"w{rnd.randint(0, 99)}" + ("." if style == "plain" and rnd.random() < 0.1 else "") for _ in range(400)]
            text = " ".join(f"\nAnna Ast (SPV): {w}" if style == "turns" and rnd.random() < 0.05 else w for w in words)
            got = pieces.split_text(text, limit, overlap)
            assert all(len(p[1].split()) == p[2] <= limit for p in got)
            assert [w for p in got for w in p[1].split()[p[3] :]] == text.split()
            own = [p[2] - p[3] for p in got]
            assert [p[3] for p in got] == [min(overlap, limit // 2, sum(own[:k])) for k in range(len(got))]


def test_pieces_edits_stay_local():
    rnd = random.Random(6)
    words = [f"w{rnd.randint(0, 999)}" + ("." if rnd.random() < 0.1 else "") for _ in range(3000)]
    a = {p[1] for p in pieces.split_text(" ".join(words), 200, 20)}
    words[700:701] = ["neu", "ein", "gefügt"]
    b = {p[1] for p in pieces.split_text(" ".join(words), 200, 20)}
    assert len(a - b) <= 6


def test_pieces_edge_cases(spark):
    assert pieces.split_text(None, 5, 1) == [] and len(pieces.split_text("", 5, 1)) == 1 and len(pieces.split_text("a b c d e", 5, 1)) == 1
    lim = spark.createDataFrame([("pieces", "per-top", 5, 1, "words"), ("pieces", "document-fallback", 8, 1, "words"), ("containers", "x", 2, 0, "tokens")], "purpose string, strategy string, max_size int, overlap_size int, unit string")
    rows = [record(1, user="a b c d e", answer="a b c d e f"), record(2, user="a " * 7, strategy="DOCUMENT_FALLBACK"), record(3, user="a " * 6, strategy="Per-Top"), record(4, user=None, answer=None), record(1, user="a b c d e", answer="a b c d e f"), record(5, user="a b c\td\n\ne f")]
    got = {(r["rec_id"], r["msg_pos"]) for r in pieces.pieces(frame(spark, rows), lim).where("piece_no = 1").collect()}
    assert got == {(1, 2), (3, 1), (5, 1)}


# ------------------------------------------------------------------ 5
def test_scan_structure():
    text = "## Zu TOP 1: Räumung\n\nDie geän-\nderte Sanierung der Schul- kinder und\nOrts- und Wegebau in Sankt-Irm-\nlöben.\n\nSeite 3 von 9\nADK 4   05.06.2068\nweiter geht es mit Wohnhei¬\nmen und Bau\n- 4 -\nten."
    got, kinds = scans.structure(text)
    assert kinds == {"hyphen", "pageno", "header"}
    assert got == ["## Zu TOP 1: Räumung", "Die geänderte Sanierung der Schulkinder und Orts- und Wegebau in Sankt-Irm-löben.", "weiter geht es mit Wohnheimen und Bau ten."]
    assert scans.structure(None) == ([], set()) and scans.structure(" \n") == ([], set())
    assert scans.structure("Eine Zeile\numgebrochen ohne Schaden.")[1] == set()


def test_scan_repair(spark):
    base = "Der Ausschuss nimmt die Vorlage zur Kenntnis und bittet gemeinsam um einen Bericht"
    rows = [(i, base) for i in range(60)] + [(100, "Der Ausschuss n!mmt die Vor1age zur Kenntnis und bittet gcrneinsam um einen Bericlit"), (101, None), (102, "")]
    got = {r["rec_id"]: r for r in scans.repaired(frame(spark, rows, "rec_id bigint, text string")).collect()}
    assert got[100]["text"] == base and got[100]["kinds"] == ["ocr"]
    assert got[1]["kinds"] == [] and got[101]["text"] == "" and got[102]["text"] == ""


def test_scan_repair_of_frequent_odd_words(spark):
    base = "Der Ausschuss nimmt die Vorlage zur Kenntnis"
    rows = [(i, base) for i in range(40)] + [(100 + i, base.replace("Vorlage", "Vor1age")) for i in range(30)]
    got = {r["rec_id"]: r["text"] for r in scans.repaired(frame(spark, rows, "rec_id bigint, text string")).collect()}
    assert set(got.values()) == {base}


def wrapped(text, width, every=None, header=""):
    """Lines of at most ``width`` characters, with a header after every so many lines."""
    import textwrap

    lines = textwrap.wrap(text, width)
    return [x for i, line in enumerate(lines) for x in ([line, header] if every and i % every == every - 1 and i + 1 < len(lines) else [line])]


def test_headers_of_any_wording(spark):
    rnd = random.Random(22)
    vocab = "der die Wege Haus und beraten wird Mittel Antrag für Kinder sowie Planung über am See mit ohne Bau dem Kreis bei Fragen zur Lage".split()
    text = lambda: " ".join(rnd.choice(vocab) for _ in range(90)) + "."
    rows, want = [], {}
    for i, header in enumerate(["Kreistag Ostsee, Protokollauszug 14", "Kreistag Ostsee, Protokollauszug 15", "VORLÄUFIGE FASSUNG", "Stadtrat Weiler | Blatt 3"]):
        body = text()
        rows.append((i, "\n".join(wrapped(body, 60, 4, header))))
        want[i] = body
    # at a paragraph's end, known from the others; first line; misread; an unfilled heading and a list are none
    a, b = text(), text()
    rows.append((10, "\n".join([*wrapped(a, 60), "Kreistag Ostsee, Protokollauszug 9", *wrapped(b, 60)])))
    rows.append((11, "\n".join(["Krcistag Ostsee, Protoko1lauszug 7", *wrapped(a, 60)])))
    rows.append((12, "\n".join([*wrapped(a, 60), "", "Zur Sache", "", *wrapped(b, 60)])))
    rows.append((13, "\n".join([*wrapped(a[:-1] + " und zwar", 60), "- Haus", "- Wege", *wrapped(b, 60)])))
    rows.append((14, "7\n" + "\n".join(wrapped(a, 60))))
    got = {r["rec_id"]: r for r in scans.repaired(frame(spark, rows, "rec_id bigint, text string")).collect()}
    assert {i: got[i]["text"] for i in want} == want and all(got[i]["kinds"] == ["header"] for i in want)
    assert got[10]["kinds"] == ["header"] and "Ostsee" not in got[10]["text"]
    assert got[11]["kinds"] == ["header"] and got[12]["kinds"] == [] and "Zur Sache" in got[12]["text"] and got[13]["kinds"] == []
    assert got[14]["kinds"] == ["pageno"] and got[14]["text"] == a


def test_scan_repair_of_copies(spark):
    base = "Der Ausschuss nimmt die Vorlage zur Kenntnis und bittet gemeinsam um einen Bericht"
    rows = [(i, f"{base} {i}.") for i in range(40)] + [(100 + i, base.replace("Bericht", "Bericlit")) for i in range(60)]
    got = {r["rec_id"]: r["text"] for r in scans.repaired(frame(spark, rows, "rec_id bigint, text string")).collect()}
    assert all(got[100 + i] == base for i in range(60)) and got[7] == f"{base} 7."


def test_viterbi_prefers_neighbours():
    options = {"hauf": {"hauf": 0.0, "haut": 2.0, "häuf": 1.9}}
    assert scans.decode(["die", "hauf"], options, {}) == ["die", "haut"]
    assert scans.decode(["die", "hauf"], options, {("die", "häuf"): 3.0}) == ["die", "häuf"]


# ------------------------------------------------------------------ 6
def test_defects(spark):
    prompt = "Fasse zusammen.\n\nTranskript:\n" + " ".join(f"Die Zahl {i} liegt auf dem Tisch, es geht um {i * 7} Euro." for i in range(40)) + "\n\nZusammenfassung:"
    good = "## Zu TOP 1: X\n\nDer Ausschuss nimmt den Bericht zur Kenntnis und bittet darum, die Sanierung der Wege im Mai erneut zu beraten."
    cases = {
        1: (None, "empty"), 2: ("", "empty"), 3: ("[leer]", "empty"), 4: ("## Zu TOP 1: Räumung\n\n–", "empty"), 5: ("​", "empty"), 6: (prompt, "copy"), 7: (prompt[100:900], "copy"),
        8: ("Ich kann diesen Text leider nicht zusammenfassen.", "refusal"), 9: ("I'm sorry, but I can't help with that request.", "refusal"), 10: ("The committee discussed the funding of the halls and asked for a report on the roads.", "language"),
        11: ("De voorzitter stelt vast dat er geen vragen meer zijn over de hallen en het verslag.", "language"), 12: (good[:-20], "truncated"), 13: (good + " Frau Ast (SPV)", "truncated"), 14: (good, None),
        15: (good + " Zitiert wird: „According to the speaker, the halls would cost much.“", None), 16: (good + "\n\ngez. Schriftführung", None),
    }
    rows = [record(i, user=prompt, answer=a) for i, (a, _) in cases.items()] + [record(100 + i, user=prompt, answer=good + "\n\ngez. Schriftführung") for i in range(20)] + [record(1, user=prompt, answer=None), record(50, user=None, answer=None)]
    got = {r["rec_id"]: r["defect"] for r in defects.defects(frame(spark, rows)).collect()}
    assert got == {**{i: d for i, (_, d) in cases.items() if d}, 50: "empty"}


def test_refusals_of_any_length():
    minutes = "Die Ministerin führt aus, dass die Wege im Mai gebaut werden. " * 20
    assert defects.is_refusal("Vielen Dank für die Unterlagen. " + "Sie sind sehr umfangreich. " * 40 + "Leider kann ich diesen Text nicht zusammenfassen.")
    assert defects.is_refusal(minutes + "Mehr kann ich zu dieser Anfrage nicht erstellen.") and not defects.is_refusal(minutes)
    for s in ("Ich kann dem Antrag in dieser Form nicht zustimmen.", "Frau Ast sagt: „Ich kann diese Anfrage nicht beantworten.“", "Das Ministerium kann die Frage nicht beantworten.", "Ich möchte um eine Zusammenfassung bitten."):
        assert not defects.is_refusal(s)
    for s in ("Mi dispiace, non posso aiutare con questa richiesta.", "Lo siento, no puedo ayudar con esa solicitud.", "Jag kan tyvärr inte sammanfatta texten.", "Je ne peux pas résumer ce texte."):
        assert defects.is_refusal(s)


def test_languages_in_no_list():
    for s in (
        "Výbor projednal návrh na opravu mostů a rozhodl, že o něm bude dále jednat na příštím zasedání v květnu.", "Utskottet behandlade förslaget om renovering av broarna och beslutade att återkomma i ärendet under våren.",
        "A bizottság megvitatta a hidak felújításáról szóló javaslatot, és úgy döntött, hogy májusban újra tárgyalja.", "La commissione ha discusso la proposta e ha deciso di tornare sul tema nella prossima seduta di maggio.", "Комитет обсудил предложение о ремонте мостов и решил вернуться к нему в мае этого года.",
    ):
        assert not defects.is_german(s)
    for s in ("Vorlage vertagt.", "Abstimmung: 9 Ja, 0 Nein, 2 Enthaltungen. Beschluss einstimmig, Anhörung im Mai, Bericht im Juni.", "Der Ausschuss nimmt den Bericht zur Kenntnis.", "## The heading of a text"):
        assert defects.is_german(s)


def test_short_copies_and_abbreviations(spark):
    assert defects.copy_ratio("Wie hoch ist der Etat?", "Frage:\nwie hoch ist der Etat") == 0.0 and defects.copy_ratio("Wie hoch?", "Wie hoch ist der Etat?") == 1.0 and defects.copy_ratio("x", None) == 1.0
    good = "Der Ausschuss berät die Vorlage laut Abs. 3 und § 7 Abs. 4 sowie Abs. 9 und nimmt den Bericht zur Kenntnis"
    rows = [record(i, answer=f"{good} im Jahr {i}.") for i in range(5)] + [record(10, answer=f"{good}.") , record(11, answer="Der Ausschuss berät die Vorlage laut Abs.")]
    got = {r["rec_id"]: r["defect"] for r in defects.defects(frame(spark, rows)).collect()}
    assert got[11] == "truncated" and 10 not in got


def test_repeated_truncation_is_no_terminal(spark):
    rnd = random.Random(21)
    vocab = [f"wort{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    sentence = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    cut = f"{sentence(60)} und bittet um die Sanierungsarb"
    near = [" ".join(rnd.choice(vocab) if rnd.random() < 0.1 else w for w in cut.split()[:-1]) + " Sanierungsarb" for _ in range(30)]
    rows = [record(i, answer=cut) for i in range(20)] + [record(20 + i, answer=a) for i, a in enumerate(near)]
    rows += [record(100 + i, answer=f"{sentence(50)}.\n\nAbschrift an Kämmerei") for i in range(30)] + [record(200 + i, answer=f"{sentence(50)}.") for i in range(60)]
    got = {r["rec_id"]: r["defect"] for r in defects.defects(frame(spark, rows)).collect()}
    assert got == {i: "truncated" for i in range(50)}


# ------------------------------------------------------------------ 7
SEG = "seg_id bigint, stem string, pt int, ord int, start_s double, end_s double, speaker string, label string, text string"


def seg(o, speaker=None, label=None, text="ja", stem="s", pt=1, i=0, start=None):
    return (i or o, stem, pt, o, start, None, speaker, label, text)


def test_turns(spark):
    rows = [
        seg(0, "SPEAKER_07", "Anna Ast (SPV)", "[00:00:01.000 --> 00:00:02.000] Guten äh Tag"), seg(1, None, "AST", "und weiter"), seg(2, "speaker_03", None, "(lacht)"), seg(3, None, None, "spk7: mhm, ja"),
        seg(4, None, "Sprecherin 3:", "öhm ..."), seg(5, None, "Ast, Anna", None), seg(6, None, "S03", "nein"), seg(7, None, None, "so nicht [Beifall]"), seg(8, "SPEAKER 7", None, "gut"), seg(8, "SPEAKER 7", None, "gut", i=99), seg(9, None, "Unbekannte Person", "weiter"),
        seg(0, None, None, "erst", pt=2), seg(1, "SPEAKER_1", None, "dann", pt=2), seg(None, "SPEAKER_1", None, "ohne Platz", pt=2),
    ]
    got = {(r["pt"], r["first_ord"], r["last_ord"], r["speaker_no"], r["text"]) for r in turns.turns(frame(spark, rows, SEG)).collect()}
    assert got == {(1, 0, 3, 7, "Guten Tag und weiter ja"), (1, 6, 7, 3, "nein so nicht"), (1, 8, 9, 7, "gut weiter"), (2, 0, 0, None, "erst"), (2, 1, 1, 1, "dann")}
    assert turns.turns(frame(spark, [], SEG)).count() == 0


def test_turns_over_tasks(spark):
    rnd = random.Random(8)
    rows, want = [], []
    for p in range(3):
        now = None
        for o in range(400):
            no = rnd.choice([None, None, None, 1, 2])
            text = rnd.choice(["ja", "ja", "äh"])
            rows.append(seg(o, no and f"SPEAKER_{no}", None, text, pt=p, i=p * 1000 + o))
            if text == "äh":
                continue
            if no is None or no == now:
                if want and want[-1][0] == p:
                    want[-1][2] = o
                    continue
            now = no if no is not None else None if not want or want[-1][0] != p else now
            want.append([p, o, o, now])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = turns.turns(frame(spark, rows, SEG)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {(r["pt"], r["first_ord"], r["last_ord"], r["speaker_no"]) for r in got} == {tuple(x) for x in want}


def test_clock_over_tasks(spark):
    # a recorder that starts again at 0 after 300 segments; every tenth segment is out of order
    at = [(o if o < 300 else o - 300) * 2.0 - (5.0 if o % 10 == 9 else 0.0) for o in range(600)]
    rows = [(o, "s", 1, o, a, a + 1.5, f"SPEAKER_{o % 2}", None, "ja") for o, a in enumerate(at)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["first_ord"]: (r["start_s"], r["end_s"]) for r in turns.turns(frame(spark, rows, SEG)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    import numpy as np

    start = turns.clock(np.array(at))
    assert [got[o][0] for o in range(600)] == list(start) and min(np.diff(start)) >= 0
    assert [got[o][1] for o in range(600)] == [max(start[o], a + 1.5 + (at[299] if o >= 300 else 0.0)) for o, a in enumerate(at)]


def test_clock():
    import numpy as np

    nan = float("nan")
    assert list(turns.clock(np.array([1.0, nan, 3.0, 2.0, 100.0, 1.0, 5.0]))) == [1.0, 1.75, 2.5, 2.5, 100.0, 101.0, 105.0]
    assert np.isnan(turns.clock(np.array([nan, nan]))).all()
    assert list(turns.isotonic(np.array([3.0, 1.0, 2.0, 5.0]))) == [2.0, 2.0, 2.0, 5.0]


# ------------------------------------------------------------------ 8
def test_packing(spark):
    rnd = random.Random(9)
    items = [(i, rnd.choice([7, 50, 99, rnd.randint(0, 130), 250])) for i in range(2000)]
    rows = packing.packed(frame(spark, items, "doc_id bigint, tokens int"), 100).collect()
    full = Counter()
    for r in rows:
        full[r["container"]] += r["tokens"]
    assert max(full.values()) <= 100
    total = Counter()
    for r in rows:
        total[r["doc_id"]] += r["tokens"]
    assert total == Counter({i: n for i, n in items if n})
    assert all(len([r for r in rows if r["doc_id"] == i]) == 1 for i, n in items if 0 < n <= 100)
    assert len(full) <= -(-sum(n for _, n in items) // 100) * 1.35


def test_best_fill_against_brute_force():
    rnd = random.Random(10)
    for _ in range(50):
        counts = {rnd.randint(1, 30): rnd.randint(1, 3) for _ in range(5)}
        room = rnd.randint(1, 100)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        use = packing.best_fill(room, list(counts), counts)
        assert sum(n * k for n, k in use.items()) == max(s for s in sums if s <= room)
        assert all(k <= counts[n] for n, k in use.items())


def test_token_counts(spark):
    d = frame(spark, [(1, "Guten Tag"), (2, None), (3, ""), (1, "Guten Tag")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["tokens"] for r in packing.token_counts(d).collect()}
    assert got[3] == 0 and got[1] > 1 and set(got) == {1, 3}


def test_containers_hold_the_texts(spark):
    rnd = random.Random(23)
    words = ["Straße", "Übung", "zażółć", "日本語", "die", "Wege 12", "\n\n", "🙂", "x" * 30]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 5, 40, 300])))) for i in range(60)] + [(70, None), (71, ""), (0, "doppelt")]
    docs[-1] = docs[0]
    limits = spark.createDataFrame([("containers", "klein", 64, 0, "tokens"), ("containers", "groß", 512, 0, "tokens"), ("pieces", "per-top", 5, 1, "words")], "purpose string, strategy string, max_size int, overlap_size int, unit string")
    for strategy, size in (("klein", 64), ("groß", 512)):
        got = [r for r in packing.filled(frame(spark, docs, "doc_id bigint, text string"), limits).collect() if r["strategy"] == strategy]
        assert all(r["tokens"] <= size for r in got)
        of = {}
        for r in got:
            for p in r["parts"]:
                of.setdefault(p["doc_id"], []).append((p["piece"], p["text"]))
        assert {i: "".join(t for _, t in sorted(p)) for i, p in of.items()} == {i: t for i, t in docs if t}


# ------------------------------------------------------------------ 9
def test_leaks_against_brute_force(spark):
    rnd = random.Random(11)
    vocab = ["Straße", "Wege", "für", "Übung", "Haus", "grün", "die", "12", "Öl", "Maß"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(5, 40)))) for i in range(20)]
    docs = []
    for d in range(60):
        w = [rnd.choice(vocab) for _ in range(30)]
        p = rnd.choice(items)[1].split()
        k = rnd.randint(0, max(0, len(p) - 5))
        n = rnd.choice([12, 13, 14, 30])
        part = " ".join(p[k : k + n])
        part = rnd.choice([part, part.upper(), part.replace("ü", "ue").replace("ß", "ss").replace(" ", ",\n")])
        docs.append((d, " ".join(w[:10]) + " " + part + ". " + " ".join(w[10:])))
    docs += [(100, None), (101, ""), (0, docs[0][1])]

    def norm(t):
        t = t.lower().replace("ü", "ue").replace("ö", "oe").replace("ß", "ss")
        return "".join(c if c.isalnum() else " " for c in t).split()

    want = set()
    for d, t in docs:
        w = norm(t or "")
        grams = {tuple(w[i : i + 13]) for i in range(len(w) - 12)}
        for i, p in items:
            q = norm(p)
            if any(tuple(q[k : k + 13]) in grams for k in range(len(q) - 12)):
                want.add((d, i))
    dd, ii = frame(spark, docs, "doc_id bigint, text string"), frame(spark, items + [(99, None)], "item_id bigint, passage string")
    got = leaks.leaks(dd, ii).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(want) > 10
    text = dict(docs)
    for r in got:
        assert len(norm(text[r["doc_id"]][r["start"] : r["end"]])) == r["words"] >= 13
    assert leaks.leaks(dd, ii.limit(0)).count() == 0


def test_folding_keeps_the_number_of_words():
    for cp in [*range(0xD800), *range(0xE000, 0x30000)]:
        for t in (chr(cp), f"a{chr(cp)}b", f"a {chr(cp)}"):
            assert len(leaks._WORD.findall(t)) == len(leaks._WORD.findall(leaks.fold(t))), hex(cp)


def test_leaks_of_two_item_sets(spark):
    w = [f"wort{i}" for i in range(40)]
    docs = frame(spark, [(1, " ".join(w[:20])), (2, " ".join(w[20:]))], "doc_id bigint, text string").repartition(1)
    for part, want in ((w[2:18], {(1, 5)}), (w[22:38], {(2, 5)})) * 3:
        items = frame(spark, [(5, " ".join(part))], "item_id bigint, passage string")
        assert {(r["doc_id"], r["item_id"]) for r in leaks.leaks(docs, items).collect()} == want


# ------------------------------------------------------------------ 10
def test_encoding_round_trip(spark):
    words = ["für", "Straße", "Übung", "möchte", "Gebäude", "grün", "Fußweg", "Höhe", "Maß", "Türen", "schön", "Räume", "weiß", "Größe", "hält"]
    rnd = random.Random(12)
    clean = {i: " ".join(rnd.choice(words) for _ in range(30)) + " Ende" for i in range(80)}
    rows, want = list(clean.items()), {}
    for k, chain in enumerate([("utf-8", "latin-1"), ("utf-8", "cp1252"), ("utf-8", "cp850"), ("latin-1", "mac_roman"), ("latin-1", "cp1251"), ("utf-8", "cp1252", "utf-8", "cp1252")]):
        for j in range(3):
            t = clean[k * 3 + j]
            rows.append((200 + 10 * k + j, "Anfang für " + encoding.garble(t, chain)))
            want[200 + 10 * k + j] = (0, "Anfang für " + t)
    rows += [(900, encoding.garble(clean[0], ("utf-8", "latin-1")) + " � Stra�e"), (901, clean[1].replace("ü", "?")), (902, "São Paulo und Škoda, das Zeichen Ã vor ¼ Zoll. Ja? Nein"), (903, None), (904, ""), (905, "plain ascii"), (200, rows[80][1])]
    got = {r["doc_id"]: r for r in encoding.mended(frame(spark, rows, "doc_id bigint, text string")).collect()}
    assert set(got) == set(want) | {900, 901}
    assert {i: (got[i]["lossy"], got[i]["text"]) for i in want} == want
    assert got[900]["lossy"] == 1 and got[901]["lossy"] == 1
    assert encoding.mended(frame(spark, [], "doc_id bigint, text string")).count() == 0
