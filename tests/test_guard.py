"""The guard against loops, by its bounds."""

import random

import numpy as np

from millrace.functions import fixed
from millrace.operators import replies as R


def plain(chunks):
    """(seq, reason) of the first chunk that must stop, byte by byte."""
    said, blank, size, empty = {"content": b"", "reasoning": b""}, {"content": 0, "reasoning": 0}, 0, 0
    for seq, content, reasoning in chunks:
        now = {"content": content, "reasoning": reasoning}
        size += sum(len((t or "").encode()) for t in now.values())
        if any(t is not None for t in now.values()):
            empty = 0 if any(now.values()) else empty + 1
        if size > fixed.MAX_ROUND:
            return seq, "size"
        if empty >= fixed.MAX_EMPTY:
            return seq, "empty"
        for name, t in now.items():
            if t is None:
                continue
            for c in t:
                blank[name] = blank[name] + len(c.encode()) if c in " \n\t　" else 0
                if blank[name] >= fixed.MAX_BLANK:
                    return seq, "blank"
            said[name] += t.encode()
            for (low, high), copies in fixed.REPEATS:
                for w in range(low, high + 1):
                    if len(said[name]) >= w * copies and said[name][-w * copies :] == said[name][-w:] * copies:
                        return seq, "repeated"
    return None


def test_guard_matches_its_bounds(spark):
    rng = random.Random(11)
    unit = lambda n: "".join(rng.choice("abc é") for _ in range(n))
    replies = {}
    for k in range(40):
        kind, u = k % 8, unit(rng.choice([20, 33, 60, 300, 520, 700]))
        text = unit(200) + {0: u * 7, 1: u * 4, 2: " " * 1030, 3: "　" * 342, 4: "x", 5: u * 2, 6: unit(500), 7: u[:40] * 6}[kind] + unit(100)
        cuts = [text[i : i + 37] for i in range(0, len(text), 37)]
        replies[k] = [(i, c if i % 5 or kind == 4 else None, c if not i % 5 and kind != 4 else None) for i, c in enumerate(cuts)]
    replies[100] = [(i, "" if i else "a", None) for i in range(200)]
    replies[101] = [(i, None, None) for i in range(200)]
    replies[102] = [(i, unit(3000), None) for i in range(30)]
    replies[104] = [(0, "ab" + " " * 1_100 + "c", None)]
    replies[105] = [(0, "ab" + " " * 600, None), (1, " " * 600 + "c", " ")]
    replies[103] = [(i, "" if i % 2 else None, "b" if i == 50 else None) for i in range(400)]
    rows = [(k, *c) for k, chunks in replies.items() for c in chunks]
    rng.shuffle(rows)
    got = {r.reply: (r.seq, r.reason) for r in R.guard(spark.createDataFrame(rows, "reply long, seq long, content string, reasoning string")).collect()}
    want = {k: plain(c) for k, c in replies.items()}
    assert got == {k: v for k, v in want.items() if v} and {v[1] for v in got.values()} == {"size", "empty", "blank", "repeated"}


def test_ends_in_copies_of_long_texts():
    data = np.frombuffer(b"y" * 10 + b"abcdefghij" * 5_000, np.uint8)
    got = R.ends_in_copies(data, np.array([9, 10, 100, 250, 50_010]))
    assert got.tolist() == [False, False, False, True, True]  # 40 bytes are the least width that is a whole number of units
