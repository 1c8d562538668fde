"""Request-log streams: per-minute counts with a watermark, and the per-person sliding limiter."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.sources.readers import REQUEST


#: Milliseconds of the log's time without a request after which a person's state is dropped.
IDLE = 600_000


def log_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The log as a stream of files that are dropped whole, with the time of each record."""
    return spark.readStream.schema(REQUEST).json(folder).withColumns({"ts": F.timestamp_millis("at_ms"), "_timestamp": F.col("at_ms") * 1000})


def per_minute(rows: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Requests per minute and path; records repeated in all fields (a restart sends the log again) count once."""
    once = rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark()
    return once.groupBy(F.window("ts", "1 minute").alias("w"), "path").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("minute"), "path", "n")


def admit(starts: list[int], at: int, limit: int, span: int = 60_000) -> tuple[bool, int, list[int]]:
    """Admission of a request: a start exactly `span` old has expired; a refused request does not count. Retry in whole seconds, 1 at least."""
    starts = [s for s in starts if at - s < span]
    if len(starts) < limit:
        return True, 0, [*starts, at]
    return False, max(1, -(-(starts[0] + span - at) // 1000)), starts


def judged(starts: list[int], ends: list[int], at: int, takes: int, limit: int, parallel: int | None) -> tuple[str, int, list[int], list[int]]:
    """Verdict on a request (admitted, busy or spent), seconds to wait, and the state after it. Running requests are looked at first."""
    ends = [e for e in ends if e > at]
    if parallel is not None and len(ends) >= parallel:
        return "busy", 1, starts, ends
    fine, retry, starts = admit(starts, at, limit)
    return ("admitted", 0, starts, [*ends, at + takes]) if fine else ("spent", retry, starts, ends)


def limiter(rows: DataFrame, limit: int, parallel: int | None = None, exempt: tuple[str, ...] = ()) -> DataFrame:
    """who, at_ms, admitted, verdict, retry_s of each request of a stream. A person's state is the starts of the last minute and the
    ends of running requests; it goes when nothing came for IDLE. People in `exempt` are always admitted."""

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        starts, ends = map(list, state.get) if state.exists else ([], [])
        asked, out = sorted((int(a), 0 if pd.isna(t) else int(t)) for b in batches for a, t in zip(b["at_ms"], b["total_ms"])), []
        for at, takes in asked:
            verdict, retry = "admitted", 0
            if key[0] not in exempt:
                verdict, retry, starts, ends = judged(starts, ends, at, takes, limit, parallel)
            out.append((key[0], at, verdict == "admitted", verdict, retry))
        state.update((starts, ends))
        state.setTimeoutTimestamp(max(asked[-1][0] + IDLE, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=["who", "at_ms", "admitted", "verdict", "retry_s"])

    asked = rows.withWatermark("ts", "1 minute").select("who", "at_ms", "total_ms", "ts").groupBy("who")
    return asked.applyInPandasWithState(run, "who string, at_ms long, admitted boolean, verdict string, retry_s long", "starts array<long>, ends array<long>", "append", GroupStateTimeout.EventTimeTimeout)
