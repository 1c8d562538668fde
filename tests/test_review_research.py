"""Suggestions, marked phrases, resumed plans and the ends of answers on small tables."""

import random

import pytest

from millrace.operators import research as N
from millrace.operators import review as V


def test_suggestions_by_field(spark):
    rows = [(1, "a", "Great question! In summary", "one — two — three"), (2, "a", "one — two — three", None), (3, "readability", "great question", "great question"), (4, None, None, "<DIV> great question, delve into")]
    got = {tuple(r) for r in V.suggestions(spark.createDataFrame(rows, "id long, source string, instruction string, response string")).collect()}
    assert got == {
        (1, "a", "instruction", "flattery_filler_opener", "flattery_filler_opener", "great question"), (1, "a", "instruction", "wrap_up_repeat", "wrap_up_repeat", "in summary"), (1, "a", "response", "em_dash_habit", "rhythm_trick", "2 em dashes"),
        (4, None, "response", "source_markup", "other", "<div"), (4, None, "response", "flattery_filler_opener", "flattery_filler_opener", "great question"), (4, None, "response", "empty_depth_words", "empty_depth_words", "delve into"),
    }


def test_phrase_marked_everywhere(spark):
    records = spark.createDataFrame([(1, "so it GOES on"), (2, "It goes. It Goes."), (3, "no"), (4, "x it goes"), (5, None)], "id long, response string")
    flags = spark.createDataFrame([(1, "n", [("instruction", "it goes", "other")]), (2, "n", [("response", "IT GOES", "other")]), (4, "n", None), (4, "m", None)], "id long, note string, spans array<struct<field:string,text:string,category:string>>")
    new, counts = V.marked(records, flags, "  It goes ", "rhythm_trick")
    assert {tuple(r) for r in new.collect()} == {(1, None, "response", "it GOES", "rhythm_trick"), (4, None, "response", "it goes", "rhythm_trick")} and tuple(counts.first()) == (3, 2)
    new, counts = V.marked(records, flags.limit(0), "no on", "other")
    assert new.collect() == [] and tuple(counts.first()) == (0, 0)
    with pytest.raises(ValueError, match="at least 4"):
        V.marked(records, flags, " no ", "other")


def test_remaining(spark):
    planned = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "key string, part int")
    assert {r.part for r in V.remaining(planned, spark.createDataFrame([("a",), ("a",), (None,)], "key string")).collect()} == {2, 3}


def test_moves_of_the_machine():
    move = N.next_state
    assert move(("researching", 1), "calls", False) == ("researching", 2) and move(("researching", 8), "calls", False) == ("answering", 1) and move(("researching", 1), "calls", True) == ("answering", 1)
    assert move(("researching", 1), "nothing", False) == ("answering", 1) and move(("researching", 8), "stuck", False) == ("answering without thinking", 1) and move(("researching", 1), "cut", False) == ("stopped", 0)
    assert move(("answering", 1), "stuck", False) == ("answering without thinking", 2) and move(("answering without thinking", 1), "stuck", False) == ("stopped", 0) and move(("answering", 3), "stuck", False) == ("stopped", 0)
    assert move(("answering without thinking", 2), "calls", False) == ("answering without thinking", 3) and move(("answering", 3), "nothing", False) == ("unanswered", 0) and move(("answered", 0), "stuck", True) == ("answered", 0)


def test_outcomes_match_a_walk(spark):
    rng = random.Random(7)
    rows, want = [], {}
    for answer in range(60):
        state, n, why = ("researching", 1), 0, None
        for seq in range(rng.randrange(1, 25)):
            content = rng.choice(["", "  \n", "short", "short", "x" * 1024, None])
            calls, stop, out = rng.choice([0, 1, 2, None]), rng.choice([None] * 6 + ["loop"]), rng.choice([False, False, True, None])
            new = rng.randrange(0, (calls or 0) + 1)
            rows.append((answer, seq, content, calls, new, stop, out))
            size = len((content or "").strip())
            turn = ("stuck" if not size else "cut") if stop else "nothing" if not size and not calls else "calls" if not size or (size < 1024 and calls and new) else "answer"
            if state[1]:
                state, n = N.next_state(state, turn, bool(out)), n + 1
                why = stop if state[0] == "stopped" else None
        want[answer] = (n, *state, why)
    df = spark.createDataFrame(rows, "answer long, seq int, content string, calls int, new_calls int, stop string, out_of_searches boolean").repartition(6)
    assert {r.answer: tuple(r)[1:] for r in N.outcomes(df).collect()} == want
    assert N.outcomes(df.limit(0)).collect() == []
