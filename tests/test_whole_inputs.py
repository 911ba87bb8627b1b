"""Queries read all rows of their tables, not a part of them."""

import pytest

from redewerk import catalog

SEG = "seg_id bigint, stem string, pt int, ord int, start_s double, end_s double, speaker string, label string, text string"


@pytest.fixture
def at(spark, tmp_path):
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def test_summary_of_all_parts(spark, at):
    rows = [(i, s, pt, o, 0.0, 1.0, None, None, x) for i, (s, pt, o, x) in enumerate([("A", 2, 0, "Zwei."), ("A", 1, 1, "a."), ("A", 1, 0, "Eins"), ("B", 2, 0, "Nur zwei.")])]
    got = {r["stem"]: r["summary"] for r in catalog.queries()["summarise_stub"](spark, at("segments", rows, SEG)).collect()}
    assert set(got) == {"A", "B"} and "Nur zwei." in got["B"]
    assert "Eins a. Zwei." in got["A"]


def test_all_protocols_of_a_sitting(spark, at):
    from datetime import datetime

    from redewerk.plans import queries

    day = lambda d: datetime(2060, 1, d)
    rows = [(1, "Alpha spricht.", "S", "protocol", day(2)), (2, "Zeta spricht.", "S", "protocol", day(1)), (2, "Zeta spricht.", "S", "protocol", day(1)), (3, "Brief.", "S", "letter", day(1))]
    path = at("documents", rows, "doc_id bigint, text string, stem string, kind string, created_at timestamp")
    got = queries._protocols(lambda name: spark.read.parquet(f"{path}/{name}.parquet")).collect()
    assert [tuple(r) for r in got] == [("S", "Zeta spricht.\nAlpha spricht.")]


def test_overlap_with_a_huge_end(spark):
    from redewerk.operators import intervals

    seg = spark.createDataFrame([("s", 0, 0.0, 5.0), ("s", 1, 5.0, 1e12), ("s", 2, 200.0, 210.0), ("s", 3, 300.0, None)], "stem string, ord int, start double, end double")
    dia = spark.createDataFrame([("s", 1.0, 4.0, "A"), ("s", 100.0, 1e11, "B"), ("s", 205.0, 207.0, "C"), ("t", 0.0, 9.0, "D")], "stem string, start double, end double, speaker string")
    got = {r["ord"]: r["overlap_speaker"] for r in intervals.overlap_assigned(seg, dia, ["stem"]).collect()}
    assert got == {0: "A", 1: "B", 2: "B", 3: None}


def test_transcript_in_order_of_parts_whatever_their_numbers(spark, at):
    parts = [("A", 3000, 0, "drei"), ("A", 2147, 483648, "zwei"), ("A", 1, 7, "eins"), ("B", 2, 0, "zwei"), ("B", 1, 1500000, "eins"), ("B", 2147483647, 2147483647, "drei"), ("C", None, 0, "drei"), ("C", 1, None, "zwei"), ("C", 1, 0, "eins")]
    rows = [(i, s, pt, o, 0.0, 1.0, f"SPEAKER_{x}", None, x) for i, (s, pt, o, x) in enumerate(parts)]
    got = {r["stem"]: r["text"] for r in catalog.queries()["transcript_markdown"](spark, at("segments", rows, SEG)).collect()}
    blocks = [f"<SD-SPK>SPEAKER_{x}</SD>\n[00:00:00.000 --> 00:00:01.000] {x}" for x in ("eins", "zwei", "drei")]
    assert got == dict.fromkeys("ABC", "Kopf\n" + "\n\n".join(blocks) + "\n")
