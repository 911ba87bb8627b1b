"""Steps that ask a model: what of its answers counts, against small cases worked out by hand."""

from redewerk.operators import agenda, providers, resolve

PEOPLE = [("s", "berg", "Alma Berg", "alma berg", 1), ("s", "cramer", "Bodo Cramer", "bodo cramer", 1), ("s", "dahl", "Cilly Dahl", "cilly dahl", 1)]
WHO = "stem string, surname string, full string, key string, n_same int"
DONE = "stem string, label string, key string"


def test_snapped(spark):
    who, done = spark.createDataFrame(PEOPLE, WHO), spark.createDataFrame([("s", "L0", "alma berg")], DONE)
    named = spark.createDataFrame([("s", "L1", "Bodo Cramer"), ("s", "L2", "Dahl Cilly"), ("s", "L3", "Alma Berg"), ("s", "L4", "Egon Frey"), ("s", "L5", "Egon Frey"), ("t", "L1", "Neu Hier")], "stem string, label string, name string")
    old = {(r["stem"], r["label"]): r["key"] for r in resolve.snapped(named, who, done, ["stem"]).collect()}
    assert old == {("s", "L1"): "bodo cramer", ("s", "L2"): "cilly dahl"}
    new = {(r["stem"], r["label"]): r["key"] for r in resolve.snapped(named, who, done, ["stem"], new=True).collect()}
    assert new == {**old, ("s", "L4"): "egon frey", ("t", "L1"): "neu hier"}
    assert resolve.snapped(named.limit(0), who, done, ["stem"], new=True).count() == 0


def test_protocol_tier(spark):
    # item 1 asks for B and C, item 2 for D alone (B is fixed by then); A was resolved before; nobody is left for E
    turns = spark.createDataFrame(
        [("s", 0, "A", "eins", 1), ("s", 1, "B", "zwei", 1), ("s", 2, "C", "drei", 1), ("s", 3, "B", "vier", 2), ("s", 4, "D", "fünf", 2), ("s", 5, "E", None, 2), ("s", 6, "F", "vorher", None)], "stem string, turn_ix int, label string, text string, top int",
    )
    who, done = spark.createDataFrame([*PEOPLE, ("s", "ems", "Dora Ems", "dora ems", 1)], WHO), spark.createDataFrame([("s", "A", "alma berg")], DONE)
    minutes = spark.createDataFrame([("s", 1, "Es sprach jemand.")], "stem string, top int, section string")
    got = {r["label"]: (r["key"], r["method"], r["score"]) for r in resolve.protocol_tier(turns, minutes, who, done, ["stem"], providers.InOrder).collect()}
    assert got == {"B": ("bodo cramer", "llm", 1.0), "C": ("cilly dahl", "llm", 1.0), "D": ("dora ems", "llm", 1.0)}
    # no answers, no names
    assert resolve.protocol_tier(turns, minutes, who, done, ["stem"], lambda: providers.TableLlm({})).count() == 0


def test_retry_of_transient_errors_only(spark):
    d = spark.createDataFrame([(1,), (2,), (3,)], "n int").coalesce(1)

    class Shaky:
        def __init__(self):
            self.calls = {}

        def call(self, n):
            self.calls[n] = self.calls.get(n, 0) + 1
            if n == 1 and self.calls[n] < 3:
                raise TimeoutError("later")
            if n == 2:
                raise ValueError("never")
            return f"{n}:{self.calls[n]}"

    done = providers.applied(d, ["n"], Shaky, lambda p, n: p.call(n), transient=(TimeoutError,), wait_s=0.0)
    assert {r["n"]: (r["value"], r["error"]) for r in done.collect()} == {1: ("1:3", None), 2: (None, "ValueError: never"), 3: ("3:1", None)}
    assert providers.exit_code(done) == 2 and providers.exit_code(done.where("n = 3")) == 0


def test_answers_that_count():
    assert agenda.accepted({"TOP 1": "T6", "2": 4, "3": None, "x": 7, "5": 6, "6": 99}, [1, 2, 3, 5, 6], 0, 20, 0) == [(1, 6), (5, 6)]
    assert providers.context_window({"m": {"text_config": {"max_position_embeddings": 100}, "max_position_embeddings": 5}, "n": {"max_position_embeddings": 7}}, "m") == 100
    assert providers.context_window({"n": {"max_position_embeddings": 7}}, "n") == 7 and providers.context_window({}, "o") == 4096
    assert providers.prompt_room(1000, 200) == 800 and providers.prompt_room(300, 200) == 256


def test_close_cues(spark):
    said = ["Ich schließe damit den Tagesordnungspunkt.", "Damit ist der Antrag abgelehnt.", "Der Tagesordnungspunkt 4 ist geschlossen.", "Der Tagesordnungspunkt. Die Tür ist geschlossen.", "Wir reden weiter."]
    d = spark.createDataFrame([(x,) for x in said], "t string")
    from pyspark.sql import functions as F

    assert [r[0] for r in d.select(F.col("t").rlike(agenda.CLOSE_CUE)).collect()] == [True, True, True, False, False]
