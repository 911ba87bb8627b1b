"""The command line: what it writes and what it ends with."""

from redewerk.__main__ import run

WORDS = " ".join(f"wort{i}" for i in range(40))


def folder(tmp_path, name, texts):
    d = tmp_path / name
    d.mkdir()
    for n, text in texts.items():
        (d / n).write_text(text, encoding="utf-8")
    return str(d)


def test_build(spark, tmp_path):
    t = folder(tmp_path, "t", {"HA_1_1_Transkript.md": "<SD-TOP>TOP 1</SD>\n<SD-SPK>A</SD>\n[00:00:01.000 --> 00:00:02.000] hallo\n"})
    m = folder(tmp_path, "m", {"HA_1_1_Protokoll.md": f"## Beschlüsse und Festlegungen\n\n## Zu TOP 1: Wege\n\n{WORDS}\n"})
    args = ["build", "--transcripts", t, "--minutes", m, "--out", str(tmp_path / "o")]
    assert run(spark, args) == 0
    assert spark.read.json(str(tmp_path / "o/records")).count() == 1
    assert run(spark, args) == 1 and run(spark, [*args, "--overwrite"]) == 0
    assert run(spark, [*args, "--overwrite", "--min-tgt-tokens", "500"]) == 2
    assert run(spark, [*args, "--overwrite", "--holdout-stems", "ha_1_1"]) == 2


def test_wrong_use(spark, tmp_path):
    assert run(spark, ["build"]) == 1 and run(spark, ["nichts"]) == 1
    assert run(spark, ["clean", "--minutes", str(tmp_path / "fehlt"), "--out", str(tmp_path / "o")]) == 1


def test_clean(spark, tmp_path):
    m = folder(tmp_path, "m", {"a.md": "Deckblatt\n\n## Beschlüsse und Festlegungen\n\nKreistag Nordmoor\nText", "b.md": "ohne"})
    assert run(spark, ["clean", "--minutes", m, "--out", str(tmp_path / "o"), "--institutions", "Kreistag Nordmoor"]) == 2
    got = {r["stem"]: r["body"] for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got["a"].split() == ["##", "Beschlüsse", "und", "Festlegungen", "Text"] and got["b"] == ""
