"""Logs that grow, as a stream: a Python data source whose offset is the byte read of each file.

    spark.dataSource.register(GrowingLog)
    spark.readStream.format("growing_log").option("path", "/shared/logs").load()

A batch reads the bytes written since the last one, cut into ranges of `splitBytes`, and complete lines only: what stands behind the
last line break waits for the next batch. A file that is shorter than what was read of it was rotated or emptied, and is read again from
its start. Offsets are in the query's checkpoint, so a restarted query goes on where it was.

`path` is a file or a folder (then all files in it, but hidden ones); a path that is missing has no lines yet. Driver and executors open
it through pyarrow, by path or by URI, so it must be one that all machines reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from millrace.sources.readers import REQUEST

_LOOK = 1 << 16
SPLIT_BYTES = 32 << 20


class Range(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


def _open(path: str):
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    return system, place


def sizes(path: str) -> dict[str, int]:
    """Bytes of each file, by its place in the file system."""
    from pyarrow import fs

    system, place = _open(path)
    info = system.get_file_info(place)
    found = system.get_file_info(fs.FileSelector(place)) if info.type == fs.FileType.Directory else [info]
    return {f.path: f.size for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))}


def complete(path: str, place: str, size: int, least: int = 0) -> int:
    """The byte behind the last line break before `size`; looked for from the end, no further than to `least`."""
    system, _ = _open(path)
    with system.open_input_file(place) as f:
        while size > least:
            at = max(least, size - _LOOK)
            f.seek(at)
            found = f.read(size - at).rfind(b"\n")
            if found >= 0:
                return at + found + 1
            size = at
    return least


def lines_of(path: str, place: str, first: int, last: int) -> Iterator[tuple[int, bytes]]:
    """(byte, line) of the lines that begin in [first, last); `first` of a range amid a file may be anywhere."""
    system, _ = _open(path)
    with system.open_input_file(place) as f:
        at = first
        if first:
            f.seek(first - 1)
            skipped = f.read(1) != b"\n"
        else:
            skipped = False
        f.seek(at)
        held = b""
        while at < last or held:
            more = f.read(_LOOK)
            rows = (held + more).split(b"\n")
            held = rows.pop()
            for row in rows:
                if skipped:
                    skipped = False
                elif at < last:
                    yield at, row
                else:
                    return
                at += len(row) + 1
            if not more:
                return


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, split: int):
        self.path, self.split, self.seen = path, split, {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        for place, size in sizes(self.path).items():
            before = self.seen.get(place, 0)
            self.seen[place] = complete(self.path, place, size, before if before <= size else 0)
        return dict(self.seen)

    def partitions(self, start: dict, end: dict) -> list[Range]:
        self.seen = {**end, **self.seen}
        out = []
        for place, last in sorted(end.items()):
            first = start.get(place, 0)
            first = first if first <= last else 0
            out += [Range(place, at, min(at + self.split, last)) for at in range(first, last, self.split)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, bytes]] = []

        def batch():
            at, lines = zip(*rows)
            return pa.record_batch({"path": pa.array([partition.path] * len(rows)), "at": pa.array(at, pa.int64()), "value": pa.array([x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines])})

        for row in lines_of(self.path, partition.path, partition.first, partition.last):
            rows.append(row)
            if len(rows) == 10_000:
                yield batch()
                rows = []
        if rows:
            yield batch()

    def commit(self, end: dict) -> None:
        """Nothing is kept but offsets, which Spark keeps."""


class GrowingLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growing_log"

    def schema(self) -> str:
        return "path string, at long, value string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def log_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(path, at, value) of the lines of growing logs, as a stream."""
    spark.dataSource.register(GrowingLog)
    return spark.readStream.format("growing_log").options(path=path, **options).load()


def log_records(lines: DataFrame) -> DataFrame:
    """The requests of log lines, each with `record`: the whole object with `_timestamp`, its time in microseconds (0 without one).

    Lines that hold no object are left out; fields that are not known stay in `record`."""
    whole = F.trim(F.col("value"))
    fine = lines.withColumn("v", F.try_parse_json(whole)).where(F.col("v").isNotNull() & F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")))
    fine = fine.select("path", "at", F.from_json(whole, REQUEST).alias("r"), whole.alias("whole"))
    stamp = F.coalesce(F.col("r.at_ms"), F.lit(0)) * 1000
    bare = F.regexp_replace("whole", r"\}\z", "")
    record = F.concat(bare, F.when(F.regexp_replace(bare, r"[{\s]", "") == "", "").otherwise(","), F.lit('"_timestamp":'), stamp.cast("string"), F.lit("}"))
    return fine.select("path", "at", "r.*", F.timestamp_millis("r.at_ms").alias("ts"), stamp.alias("_timestamp"), record.alias("record"))
