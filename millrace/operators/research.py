"""How answers with searches ended: rounds of a model as the moves of a small state machine.

A round's turn is read from what it wrote and called; the machine's moves are one table of next states by turn. Research takes at most
MAX_ROUNDS rounds and answering ANSWER_ROUNDS, so an answer is over after their sum: of each answer the first so many rounds are taken
(within tasks first) and folded, however long its log is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import fixed
from millrace.functions import text as T

TURNS = ["answer", "cut", "calls", "nothing", "stuck"]
_R, _A = fixed.MAX_ROUNDS, fixed.ANSWER_ROUNDS
#: States in order: research rounds, answering rounds with thinking and without, ends.
STATES = [("researching", k) for k in range(1, _R + 1)] + [("answering", k) for k in range(1, _A + 1)] + [("answering without thinking", k) for k in range(1, _A + 1)] + [(e, 0) for e in ("answered", "stopped", "unanswered")]
_AT = {s: k for k, s in enumerate(STATES)}


def next_state(state: tuple[str, int], turn: str, out_of_searches: bool) -> tuple[str, int]:
    name, k = state
    if not k:
        return state
    if turn in ("answer", "cut"):
        return ("answered" if turn == "answer" else "stopped"), 0
    if name == "researching":
        if turn == "calls" and k < _R and not out_of_searches:
            return name, k + 1
        return ("answering without thinking" if turn == "stuck" else "answering"), 1
    if turn == "stuck":
        return ("answering without thinking", k + 1) if name == "answering" and k < _A else ("stopped", 0)
    return (name, k + 1) if k < _A else ("unanswered", 0)


#: Next states by turn, without and with searches left, each a row of state numbers.
MOVES = [[[_AT[next_state(s, t, out)] for s in STATES] for out in (False, True)] for t in TURNS]


def turn_of(content: Column, calls: Column, new_calls: Column, stop: Column) -> Column:
    """The turn of a round: its text, how many calls it made, how many of them had not run before, and why the guard stopped it, if so."""
    size = F.octet_length(T.strip(F.coalesce(content, F.lit(""))))
    short = (size > 0) & (size < fixed.ANSWERED_BYTES)
    asked = F.coalesce(calls, F.lit(0)) > 0
    return (
        F.when(stop.isNotNull(), F.when(size == 0, "stuck").otherwise("cut"))
        .when((size == 0) & ~asked, "nothing")
        .when((size == 0) | (short & asked & (F.coalesce(new_calls, F.lit(0)) > 0)), "calls")
        .otherwise("answer")
    )


def outcomes(rounds: DataFrame) -> DataFrame:
    """answer, rounds (those that counted), state, round (0 if it is over), reason (of a stopped one) of each answer's rounds (answer, seq,
    content, calls, new_calls, stop, out_of_searches).

    Defined cases: null texts and counts are nothing, a null out_of_searches is false; rounds of one seq are ordered by their turn, then
    their reason; a null answer is an answer; an empty table gives no rows."""
    turn = turn_of(F.col("content"), F.col("calls"), F.col("new_calls"), F.col("stop"))
    rows = rounds.select("answer", "seq", turn.alias("turn"), "stop", F.coalesce("out_of_searches", F.lit(False)).alias("out"))
    place = F.row_number().over(Window.partitionBy("answer").orderBy("seq", "turn", "stop"))
    first = rows.withColumn("place", place).where(F.col("place") <= _R + _A)
    events = F.sort_array(F.collect_list(F.struct("place", "turn", "out", "stop")))
    moves = F.create_map(*[x for t, (no, yes) in zip(TURNS, MOVES) for x in (F.lit(t), F.array(F.array(*map(F.lit, no)), F.array(*map(F.lit, yes))))])
    start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("n"), F.lit(None).cast("string").alias("why"))
    over = _AT["answered", 0]

    def step(a: Column, e: Column) -> Column:
        s = F.get(F.get(moves[e["turn"]], e["out"].cast("int")), a["s"])
        return F.when(a["s"] >= over, a).otherwise(F.struct(s.alias("s"), (a["n"] + 1).alias("n"), F.when(s == over + 1, e["stop"]).alias("why")))

    ended = first.groupBy("answer").agg(F.aggregate(events, start, step).alias("a"))
    state = F.get(F.array(*[F.struct(F.lit(n).alias("state"), F.lit(k).alias("round")) for n, k in STATES]), F.col("a.s"))
    return ended.select("answer", F.col("a.n").alias("rounds"), state["state"].alias("state"), state["round"].alias("round"), F.col("a.why").alias("reason"))
