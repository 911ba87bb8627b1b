"""People, resolution, pairing, inventory, files, providers, stream and the build plan on small fixtures."""

from pyspark.sql import functions as F

from redewerk.operators import inventory, pairing, people, providers, quality, resolve
from redewerk.plans.build import Options, build
from redewerk.sources import files, sinks
from redewerk.streaming import arrivals


def one(df):
    return [tuple(r) for r in df.collect()]


def test_directory(spark):
    d = spark.createDataFrame([("s", "Abgeordneter Jan Ast (CDU)\nJan Peter Ast (CDU)\nUte Ast (SPD)\nEinzel (FDP)\nRita Moor (Antrag SPD)", "Bericht. Dr. Ben Berg (Minister der Justiz) sagt")], "stem string, cover string, body string")
    got = sorted(one(people.directory(people.mentions(d, ["stem"]), ["stem"]).select("surname", "full", "role", "n_same")))
    assert got == [("ast", "Jan Peter Ast", "CDU", 2), ("ast", "Ute Ast", "SPD", 2), ("berg", "Dr. Ben Berg", "Minister der Justiz", 1)]


def test_chairs(spark):
    d = spark.createDataFrame([("s", "Vorsitz:\nUte Moor (SPD)\nJan Ast (CDU)\nProtokoll: Eva Fink (SPD)", "")], "stem string, cover string, body string")
    who = people.directory(people.mentions(d, ["stem"]), ["stem"])
    assert sorted(one(people.chairs(d, who, ["stem"]).select("rank", "key"))) == [(1, "ute moor"), (2, "jan ast")]


def test_cascade(spark):
    who = spark.createDataFrame([("s", "ast", "jan ast", 1), ("s", "moor", "ute moor", 1), ("s", "fink", "eva fink", 1), ("s", "berg", "x berg", 2)], "stem string, surname string, key string, n_same int")
    t = [
        (1, "L0", "Frau Fink hat das Wort."), (2, "L1", "Mein Name ist Jan Ast, guten Tag."), (3, "L0", "Das Wort hat Herr Moor"), (4, "L2", "Danke."), (5, "L0", "Bitte, Frau Berg."), (6, "L3", "Ja."),
    ]
    t = spark.createDataFrame([("s", i, lab, x, 1) for i, lab, x in t], "stem string, turn_ix int, label string, text string, top int")
    chairs = spark.createDataFrame([("s", 1, "eva fink")], "stem string, rank int, key string")
    body = spark.createDataFrame([("s", "Nichts.")], "stem string, body string")
    got = {r["label"]: (r["key"], r["method"]) for r in resolve.resolved(t, who, chairs, body, ["stem"]).collect()}
    assert got["L1"] == ("jan ast", "self-intro") and got["L2"] == ("ute moor", "chair") and "L3" not in got
    assert got["L0"] == ("eva fink", "chair-vorsitz")


def test_vote_tie_has_no_winner(spark):
    v = spark.createDataFrame([("s", "A", "x", 2), ("s", "A", "y", 2), ("s", "B", "x", 3), ("s", "B", "y", 1), ("s", "C", "x", 1)], "stem string, label string, key string, votes int")
    assert sorted((r["label"], r["key"], r["conflict"]) for r in resolve.vote_winners(v, ["stem"]).collect()) == [("B", "x", True), ("C", "x", False)]


def test_exclusion_at_twelve(spark):
    t = spark.createDataFrame([("s", "L", "a. " * 12, 1), ("s", "L", "a. " * 13, 2), ("s", "L", "a. " * 13, None), ("s", "M", "a. " * 20, 3)], "stem string, label string, text string, top int")
    done = spark.createDataFrame([("s", "M", "k")], "stem string, label string, key string")
    assert one(resolve.excluded_items(t, done, ["stem"])) == [("s", 2)]


def test_fuzzy_pairs(spark):
    rows = lambda xs: spark.createDataFrame([("b", x, x) for x in xs], "block string, name string, key string")
    left, right = rows(["ard_1_", "ard_2_", "xyz"]), rows(["ard_11_", "ard_2_", "ard_1"])
    assert sorted(one(pairing.fuzzy_pairs(left, right).select("name", "partner"))) == [("ard_1_", "ard_1"), ("ard_2_", "ard_2_")]
    greedy = pairing.fuzzy_pairs(rows(["ard_1_"]), rows(["ard_11_"]), guard=False)
    assert one(greedy.select("partner")) == [("ard_11_",)]


def test_best_assignment_uses_each_once(spark):
    s = spark.createDataFrame([("s", "A", 1, "p", 90.0), ("s", "A", 1, "q", 80.0), ("s", "B", 2, "p", 99.0), ("s", "B", 2, "q", 76.0), ("s", "C", 3, "q", 99.0)], "stem string, label string, rank int, person string, score double")
    assert sorted(one(pairing.best_assignment(s, ["stem"], 75.0).select("label", "person"))) == [("A", "p"), ("B", "q")]


def test_drop_names(spark):
    names = ["3. XYZ vom 01.02.2021 Teil 2.mp3", "3. xyz am 01.02.2021-1.mp3", "3. XYZ vom 01.02.2021 (2).mp3", "3. XYZ vom 01.02.2021 .pdf", "kaputt.mp3"]
    d = inventory.drop_parts(spark.createDataFrame([(f"a/{n}", 5) for n in names], "path string, length bigint"))
    assert one(d.select("sitting", "abbr", "part", "dup", "ext"))[:4] == [(3, "XYZ", 2, None, "mp3"), (3, "XYZ", 1, None, "mp3"), (3, "XYZ", None, 2, "mp3"), (3, "XYZ", None, None, "pdf")]
    s = inventory.import_flags(inventory.drop_sessions(d)).collect()
    assert len(s) == 1 and s[0]["flags"] == "MULTIPART(3);DUP_AS_MULTIPART" and s[0]["audios"][0].endswith("(2).mp3")


def test_stems(spark):
    d = spark.createDataFrame([("A 7 (AS GIV, AAS)/7. WP/07.WP 12. Sitzung",), ("EK 82/Ohne Zahl",), ("A 1 (HA)/3. Sitzung",)], "raw_dir string")
    assert [r[0] for r in inventory.stem_fields(d).select("d_stem").collect()] == ["ASGIV_7_12", "EK82_x", "HA_3"]


def test_ledger_states(spark):
    sch = "stem string, sig string, first_seen string, last_seen string"
    old = spark.createDataFrame([("a", "1", "t0", "t1"), ("b", "1", "t0", "t1"), ("c", "1", "t0", "t1")], sch)
    new = spark.createDataFrame([("a", "1", "t2", "t2"), ("b", "2", "t2", "t2"), ("d", "1", "t2", "t2"), ("d", "9", "t3", "t3")], sch)
    got = {(r["stem"], r["state"]): (r["first_seen"], r["last_seen"]) for r in inventory.ledger_diff(old, new, ["sig"]).collect()}
    assert got == {("a", "UNCHANGED"): ("t0", "t2"), ("b", "CHANGED"): ("t0", "t2"), ("c", "MISSING"): ("t0", "t1"), ("d", "NEW"): ("t2", "t2"), ("d", "DUPLICATE"): ("t3", "t3")}
    assert "MISSING" not in {r["state"] for r in inventory.ledger_diff(old, new, ["sig"], prune=True).collect()}


def test_pick_protocol(spark):
    d = spark.createDataFrame([("s", "x/b Anlage.pdf"), ("s", "x/a.pdf"), ("s", "x/c Protokoll.PDF"), ("t", "x/z.pdf"), ("t", "x/y.pdf")], "stem string, path string")
    assert dict(one(inventory.picked_protocol(d, ["stem"]))) == {"s": "x/c Protokoll.PDF", "t": "x/y.pdf"}


def test_metrics(spark):
    t = "a\na\na\n\n[00:00:01 x] <SD-SPK> 12 : 3 : 0 1:2:3 ===== " + "x" * 31
    r = spark.createDataFrame([(t,), ("",)], "t string").select(*[c.alias(k) for k, c in quality.metrics(F.col("t")).items()]).collect()
    assert (r[0]["max_repeat"], r[0]["timestamp_leaks"], r[0]["tag_leaks"], r[0]["vote_triples"], r[0]["gibberish"]) == (3, 1, 1, 1, 2)
    assert r[1]["max_repeat"] == 0 and r[1]["words"] == 0 and r[1]["lines"] == 0


def test_files(spark, tmp_path):
    (tmp_path / "r/A (HA)/1. WP/3. Sitzung").mkdir(parents=True)
    (tmp_path / "r/A (HA)/1. WP/3. Sitzung/x.PDF").write_bytes(b"1")
    (tmp_path / "r/A (HA)/1. WP/3. Sitzung/x.mp3").write_bytes(b"12")
    found = files.listing(spark, str(tmp_path / "r"), [".pdf", ".mp3"])
    assert sorted(r["length"] for r in found.collect()) == [1, 2]
    (tmp_path / "m.tsv").write_text("example\tstem\nlang\tHA_1_3\nkurz\tHA_1_4\n")
    assert {r[0] for r in files.manifest(spark, str(tmp_path / "m.tsv"), ["X_1"]).collect()} == {"HA_1_3", "HA_1_4", "X_1"}
    (tmp_path / "l.txt").write_text("# x\n\n a.mp3 \n")
    assert one(files.path_list(spark, str(tmp_path / "l.txt"))) == [("a.mp3",)]
    (tmp_path / "led.json").write_text('{"version": 1, "sessions": {"HA_1": {"stem": "HA_1", "committee": "HA", "sitting": 1, "audio_src": ["a"]}}}')
    assert one(files.ledger(spark, str(tmp_path / "led.json")).select("stem", "sitting", "audio_src")) == [("HA_1", 1, ["a"])]
    (tmp_path / "bad.json").write_text("{kaputt")
    assert files.ledger(spark, str(tmp_path / "bad.json")).count() == 0
    (tmp_path / "ex.json").write_text('{"HA_1": [3, "document"]}')
    assert one(files.exclusions(spark, str(tmp_path / "ex.json"))) == [("HA_1", ["3", "document"])]


def test_front_matter(spark):
    d = spark.createDataFrame([("---\na: b: c\n  x: y\n---\nText",), ("---\na: b\nText",)], "t string")
    assert [r[0] for r in d.select(files.front_matter(F.col("t"))).collect()] == [{"a": "b: c"}, {}]


def test_parts_merge(spark):
    p = spark.createDataFrame([("s", "s.pt10.md", "---\na: b\n---\n<SD-SPK>SPEAKER_00</SD>"), ("s", "s.pt02.md", "zwei")], "stem string, path string, text string")
    assert one(files.merged_parts(p, ["stem"])) == [("s", "zwei\n\n<SD-SPK>P10_SPEAKER_00</SD>")]


def test_sinks(spark, tmp_path):
    rec = spark.createDataFrame([("train", [("user", "ä")], ("s", None))], "split string, messages array<struct<role: string, content: string>>, meta struct<stem: string, top: int>")
    sinks.write_jsonl(rec, str(tmp_path / "out"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "out/split=train")).collect()] == ['{"messages":[{"role":"user","content":"ä"}],"meta":{"stem":"s"}}']
    table = sinks.VersionedTable(spark, str(tmp_path / "t"))
    assert table.read("a int").count() == 0
    table.write(spark.range(3).select(F.col("id").cast("int").alias("a")))
    assert table.version() == 1 and table.read("a int").count() == 3
    assert one(sinks.write_files(spark.createDataFrame([("a.md", "ü")], "name string, text string"), str(tmp_path / "f"))) == [("a.md", 2)]
    assert (tmp_path / "f/a.md").read_text() == "ü"


def test_providers(spark):
    d = spark.createDataFrame([("a",), (None,)], "t string")
    assert [r["seq_tokens"] for r in providers.counted(d, "t").collect()] == [1, 0]
    bad = providers.applied(d, ["t"], lambda: None, lambda p, t: t.upper())
    assert [(r["value"], (r["error"] or "")[:14]) for r in bad.collect()] == [("A", ""), (None, "AttributeError")]
    assert providers.json_answer('x {"a": 1} y') == {"a": 1} and providers.json_answer("[1") == {}
    segs, on = providers.decoded_segments([("", 0.0), ("hallo", None), ("", 2.0), ("", 2.0), ("offen", None)])
    assert segs == [(0.0, 2.0, "hallo")] and on == 2.0
    s = spark.createDataFrame([("s", 1, "Haushalt", "Eins. Zwei. Drei.")], "stem string, top int, title string, text string")
    assert one(providers.summarised(s, "System")) == [("s", "## Zu TOP 1\n\nEins. Zwei.")]
    a = spark.createDataFrame([('x {"L": {"name": "N", "confidence": "Certain"}, "M": {"name": "O", "confidence": "low"}, "P": {"name": "null", "confidence": "certain"}, "Q": null}',), ("kaputt",), ("{}",), (None,)], "value string")
    assert one(providers.certain(a).select("label", "name")) == [("L", "N")]


def test_stream_counts_each_batch_once(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select 'a' as stem, timestamp_ntz'2036-01-02' as seen").write.parquet(src)
    table = sinks.VersionedTable(spark, str(tmp_path / "table"))
    run = lambda: arrivals.keep_ledger(arrivals.arrivals(spark, src, "stem string, seen timestamp_ntz"), table, str(tmp_path / "progress")).awaitTermination()
    run()
    run()
    spark.sql("select 'a' as stem, timestamp_ntz'2036-01-01' as seen").write.mode("append").parquet(src)
    run()
    r = table.read(arrivals.LEDGER).collect()
    assert [(x["stem"], str(x["first_seen"])[:10], str(x["last_seen"])[:10], x["n"]) for x in r] == [("a", "2036-01-01", "2036-01-02", 2)]


def test_build_plan(spark):
    words = " ".join(f"wort{i}" for i in range(40))
    t = spark.createDataFrame([("HA_1_1_Transkript", f"<SD-TOP>TOP 1</SD>\n<SD-SPK>A</SD>\n[00:00:01.000 --> 00:00:02.000] hallo\n<SD-TOP>TOP 2</SD>\n<SD-SPK>B</SD>\n[00:00:01.000 --> 00:00:02.000] welt"), ("HA_1_2_Transkript", "<SD-SPK>A</SD>\nohne"), ("HA_1_3_Transkript", "x")], "stem string, text string")
    m = spark.createDataFrame([("HA_1_1_Protokoll", f"## Beschlüsse und Festlegungen\n\n## Zu TOP 1:\n\n{words}\n\n## Zu TOP 2:\n\nkurz\n"), ("HA_1_2_Protokoll", f"## Beschlüsse und Festlegungen\n\n{words}"), ("HA_1_3_Protokoll", words)], "stem string, text string")
    man = spark.createDataFrame([("ha_1_3_",)], "stem string")
    b = build(t, m, man, spark.createDataFrame([], "stem string, top int"), Options(include_untagged=True))
    rec = {(r["stem"], r["top"]): r for r in b.records.collect()}
    assert set(rec) == {("HA_1_1_Transkript", 1), ("HA_1_2_Transkript", None)}
    assert "A: hallo" in rec["HA_1_1_Transkript", 1]["messages"][1]["content"]
    assert [(r["top"], r["reason"]) for r in b.rejects.collect()] == [("2", "short-target")]
    assert [r["stem"] for r in b.untagged.collect()] == ["HA_1_2_Transkript"]
    assert sum(r["records"] for r in b.summary.collect()) == 2
