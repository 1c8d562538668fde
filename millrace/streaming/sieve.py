"""Streamed replies: tool calls written as text are taken out of them, and token counts are read, whatever the chunks are cut at.

A reply's state is the text that is held back: the tail that may yet become a tag, or the inside of an open block, MAX_HELD characters
at most; a block that grows beyond is no call, and its inside goes on as text. An ended or idle reply gives up what it held.
Texts in all cuts give the same: what is shown, put together, and the calls.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

MAX_HELD = 16 * 1024
#: Milliseconds of the stream's time after its last chunk at which a reply that never ended is ended.
IDLE_MS = 60_000
_OPEN, _CLOSE = "<tool_call", "</tool_call>"
_TAG = re.compile(re.escape(_OPEN) + r"[^>]{0,%d}>" % MAX_HELD, re.I)
_END = re.compile(re.escape(_CLOSE), re.I)
_PARAMETER = re.compile(r"<parameter=([^>]*)>(.*?)(?:</parameter>|\Z)", re.I | re.S)
_FUNCTION = re.compile(r"<function=([^>]*)>", re.I)
_COUNT = re.compile(r'"(?:(completion_tokens|output_tokens)|prompt_tokens|input_tokens)"\s*:\s*(\d+)')
#: Characters of a raw stream that are kept for the next chunk: a name, its colon and a number.
CARRY = 64


def call_of(block: str) -> tuple[str, str] | None:
    """(name, arguments as a JSON object) of a block: JSON, or tags of a function and its parameters."""
    block = block.strip()
    if block.startswith("{"):
        try:
            found = json.loads(block)
        except ValueError:
            return None
        name = found.get("name", found.get("tool"))
        held = next((found[k] for k in ("arguments", "parameters", "args") if k in found), {})
        if not isinstance(name, str) or not name.strip():
            return None
        return name.strip(), held if isinstance(held, str) else json.dumps(held, ensure_ascii=False)
    name = _FUNCTION.search(block)
    if not name or not name[1].strip():
        return None
    pairs = {k.strip(): v.strip() for k, v in _PARAMETER.findall(block) if k.strip()}
    return name[1].strip(), json.dumps(pairs, ensure_ascii=False)


def sift(held: str, is_open: bool, text: str, ended: bool) -> tuple[str, bool, list[tuple[str, str | None]]]:
    """What is held now, whether inside a block, and the pieces in order: (text, None) or (name, arguments)."""
    rest, out = held + text, []
    shown: list[str] = []

    def show() -> None:
        if shown:
            out.append(("".join(shown), None))
            shown.clear()

    while True:
        if is_open:
            end = _END.search(rest, 0, MAX_HELD + len(_CLOSE))
            if end:
                call = call_of(rest[: end.start()])
                if call:
                    show()
                    out.append(call)
                rest, is_open = rest[end.end() :], False
                continue
            if len(rest) >= MAX_HELD + len(_CLOSE):
                shown.append(rest[:MAX_HELD])
                rest, is_open = rest[MAX_HELD:], False
                continue
            if ended:
                call = call_of(rest)
                if call:
                    show()
                    out.append(call)
                else:
                    shown.append(rest)
                rest, is_open = "", False
            break
        tag = _TAG.search(rest)
        if tag:
            shown.append(rest[: tag.start()])
            rest, is_open = rest[tag.end() :], True
            continue
        at = len(rest) if ended else _tail(rest)
        if len(rest) - at > MAX_HELD + len(_OPEN):  # too long for a tag
            shown.append(rest[: at + len(_OPEN)])
            rest = rest[at + len(_OPEN) :]
            continue
        shown.append(rest[:at])
        rest = rest[at:]
        break
    shown[:] = [s for s in shown if s]
    show()
    return rest, is_open, out


def _tail(text: str) -> int:
    """Where the first tag begins that more text could complete."""
    low = text.lower()
    whole = low.find(_OPEN)
    if whole >= 0:
        return whole
    return next((len(text) - n for n in range(min(len(_OPEN) - 1, len(text)), 0, -1) if low.endswith(_OPEN[:n])), len(text))


def counted(carry: str, raw: str, ended: bool, most: tuple[int, int]) -> tuple[str, tuple[int, int]]:
    """What is kept for the next chunk, and the largest input and output token counts; a number at the very end may yet go on."""
    seen = carry + raw
    for m in _COUNT.finditer(seen):
        if ended or m.end() < len(seen):
            most = (most[0], max(most[1], int(m[2]))) if m[1] else (max(most[0], int(m[2])), most[1])
    return seen[-CARRY:], most


OUT = "reply long, number long, kind string, text string, name string, arguments string, input_tokens long, output_tokens long"


class Reply:
    """The state of one reply, and the rows that its chunks give."""

    def __init__(self, reply, held="", is_open=False, number=0, carry="", most=(0, 0)):
        self.reply, self.held, self.is_open, self.number, self.carry, self.most = reply, held, is_open, number, carry, most
        self.ended, self.rows = False, []

    def take(self, content: str, raw: str, ended: bool) -> None:
        self.held, self.is_open, pieces = sift(self.held, self.is_open, content, ended)
        self.carry, self.most = counted(self.carry, raw, ended, self.most)
        for said, arguments in pieces:
            self.rows.append((self.reply, self.number, "text", said, None, None, *self.most) if arguments is None else (self.reply, self.number, "call", None, said, arguments, *self.most))
            self.number += 1
        if ended:
            self.rows.append((self.reply, self.number, "end", None, None, None, *self.most))
            self.number, self.ended = self.number + 1, True

    def frame(self) -> pd.DataFrame:
        return pd.DataFrame(self.rows, columns=[c.split()[0] for c in OUT.split(", ")])


def _in_order(batches) -> list[tuple[int, str, str, bool]]:
    return sorted((int(s), c or "", r or "", bool(e)) for b in batches for s, c, r, e in zip(b["seq"], b["content"], b["raw"], b["ended"]))


class _Sieve(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("reply", "held string, open boolean, number long, carry string, input long, output long")

    def _reply(self, key) -> Reply:
        if not self.state.exists():
            return Reply(key[0])
        held, is_open, number, carry, read, written = self.state.get()
        return Reply(key[0], held, is_open, number, carry, (read, written))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        reply = self._reply(key)
        frames = list(rows)
        for _, content, raw, ended in _in_order(frames):
            reply.take(content, raw, ended)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if reply.ended:
            self.state.clear()
        else:
            self.state.update((reply.held, reply.is_open, reply.number, reply.carry, *reply.most))
            latest = max(int(t.timestamp() * 1000) for f in frames for t in f["ts"])
            self.handle.registerTimer(max(latest, timerValues.getCurrentWatermarkInMs()) + IDLE_MS)
        if reply.rows:
            yield reply.frame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.state.exists():
            reply = self._reply(key)
            reply.take("", "", True)
            self.state.clear()
            yield reply.frame()

    def close(self) -> None:
        pass


def sieved(chunks: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Pieces of text and calls of each reply in order, and an `end` with its token counts, of a stream of chunks (reply, seq, content, raw,
    ended, ts). raw: the chunk as it came, in which counts are read; ts: its time.

    The session's state store must be RocksDB's. A reply's chunks must come in order from batch to batch; those of one batch are put in
    order of seq. A null content or raw is empty. What comes after an end begins a reply anew."""
    rows = chunks.select("reply", "seq", "content", "raw", "ended", "ts").withWatermark("ts", delay).groupBy("reply")
    return rows.transformWithStateInPandas(_Sieve(), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def sieved_whole(chunks: DataFrame) -> DataFrame:
    """The same of a table of chunks; every reply has ended with its last chunk."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        reply = Reply(rows["reply"].iloc[0])
        for _, content, raw, _ in _in_order([rows]):
            reply.take(content, raw, False)
        reply.take("", "", True)
        return reply.frame()

    return chunks.select("reply", "seq", "content", "raw", "ended").groupBy("reply").applyInPandas(run, OUT)
