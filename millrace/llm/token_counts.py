"""Token counts by a map-side two-tier lookup of pre-token lengths (operator 12).

A merge makes a piece of the vocabulary, so where no piece holds a byte followed by another, no token spans a place where these two
meet between characters. Texts are cut at all such places; a text's count is the sum over its parts, the pre-tokens, exactly.

1. Each task adds up its pre-tokens and keeps the TABLE most frequent (their bytes and counts, a summary of bounded size); summaries
   are merged FAN at a time into one of TABLE entries, over all documents. No pre-token is shuffled but as part of a summary.
2. These TABLE pre-tokens are encoded once; hash and length go into an open-addressing table (12 bytes an entry, twice the entries)
   that is broadcast.
3. Texts are counted where they are read: pre-tokens are looked up in the table, misses in the worker's cache of CACHED lengths, and
   only what that does not know is encoded by the sentencepiece library. Which pre-tokens are in the table changes no count.

Hashes have 64 bits. Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows and rows with a null doc_id are
counted like any others; texts of any length are counted whole, a long one in parts of about CHUNK bytes; U+2581, which the
vocabulary writes for a space, is counted as one; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytesops as B
from .scratch import release, stored

U = np.uint64
LIMIT = 4096
TABLE = 32_768
FAN = 16
#: Lengths that a worker keeps; a full cache starts anew.
CACHED = 1_000_000
CHUNK = 1 << 20
SUMMARY = "place long, hashes binary, counts binary, sizes binary, data binary"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PreTokens:
    """Pre-tokens of a sentencepiece BPE model and their lengths in tokens; one per worker process and model."""

    _made: dict[str, PreTokens] = {}

    @classmethod
    def of(cls, model: str) -> PreTokens:
        if model not in cls._made:
            cls._made[model] = cls(model)
        return cls._made[model]

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        pairs = np.zeros((256, 256), bool)
        for i in range(self.library.get_piece_size()):
            if not (self.library.is_byte(i) or self.library.is_control(i) or self.library.is_unknown(i)):
                b = np.frombuffer(self.library.id_to_piece(i).replace("▁", " ").encode(), np.uint8)
                pairs[b[:-1], b[1:]] = True
        pairs[:, 0x80:0xC0] = True  # never inside a character
        #: Whether a byte and the one after it may be in one token.
        self.pairs = pairs.reshape(-1)
        # The library puts a space before every text; a pre-token is encoded behind a byte that nothing joins instead.
        self.guard = next(chr(b) for b in range(1, 0x20) if not pairs[b, :0x80].any() and not pairs[b, 0xC0:].any())
        self.guard_tokens = len(self.library.encode(self.guard))
        self.known: dict[int, int] = {}

    def starts(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Starts of all pre-tokens of rows of bytes."""
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.pairs[(data[:-1].astype(np.uint16) << 8) | data[1:]]
        cut[off[:-1][off[:-1] < off[1:]]] = True
        return np.flatnonzero(cut)

    def chunks(self, data: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cuts of one row's bytes into parts of whole pre-tokens, about CHUNK bytes each."""
        at = 0
        while at < len(data):
            to = at + CHUNK
            while to < len(data):
                look = data[to - 1 : to + 4096]
                found = np.flatnonzero(~self.pairs[(look[:-1].astype(np.uint16) << 8) | look[1:]])
                if len(found):
                    to += int(found[0])
                    break
                to += len(look) - 1 if len(look) > 1 else 1
            yield at, min(to, len(data))
            at = min(to, len(data))

    def lengths(self, parts: list[bytes]) -> list[int]:
        """Tokens of each pre-token, by the library."""
        return [len(x) - self.guard_tokens for x in self.library.encode([self.guard + p.decode("utf-8", "replace") for p in parts], num_threads=1)] if parts else []

    def cached(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray, data: np.ndarray) -> np.ndarray:
        """Tokens of pre-tokens, through the cache."""
        codes, distinct = pd.factorize(hashes)
        keys = distinct.tolist()
        if len(self.known) > CACHED:
            self.known.clear()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        if new:
            first = np.empty(len(keys), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            at, whole = first[new], data.tobytes()
            for i, n in zip(new, self.lengths([whole[a:b] for a, b in zip(start[at].tolist(), end[at].tolist())])):
                self.known[keys[i]] = n
        return np.fromiter((self.known[k] for k in keys), np.int64, len(keys))[codes]


def spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts as the model sees them: a space before each that is not empty, U+2581 as a space."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pc.any(pc.match_substring(column, "▁")).as_py():
        column = pc.replace_substring(column, "▁", " ")
    data, off = B.raw(column)
    sizes = np.diff(off)
    wide = off + np.concatenate([[0], np.cumsum(sizes > 0)])
    out = np.full(wide[-1], 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(wide[:-1] + 1 - off[:-1], sizes)] = data
    return out, wide


def spans(batches: Iterator[pa.RecordBatch], pre: PreTokens):
    """Slices with parts of their bytes: (batch, offsets of its rows, first byte of the part, bytes, starts, ends, hashes)."""
    for b in B.slices(batches):
        data, off = spaced(b.column("text"))
        for lo, hi in pre.chunks(data) if b.num_rows == 1 else [(0, len(data))]:
            part = data[lo:hi]
            start = pre.starts(part, off if b.num_rows > 1 else np.array([0, len(part)]))
            end = np.append(start[1:], len(part))[: len(start)]
            yield b, off, lo, part, start, end, B.span_hash(B.prefix_sums(part), start, end)


class Summary:
    """The most frequent of the byte strings that were added, with counts; holds a few times `keep` of them."""

    def __init__(self, keep: int = TABLE):
        self.keep, self.held, self.size = keep, [], 0

    def add(self, hashes, counts, sizes, data) -> None:
        self.held.append((hashes, counts, sizes, data))
        self.size += len(hashes)
        if self.size > 8 * self.keep:
            self.shrink()

    def shrink(self) -> None:
        hashes, counts, sizes, data = (np.concatenate(x) for x in zip(*self.held))
        codes, distinct = pd.factorize(hashes)
        first = np.empty(len(distinct), np.int64)
        first[codes[::-1]] = np.arange(len(codes))[::-1]
        sums = np.bincount(codes, counts, len(distinct)).astype(np.int64)
        best = np.lexsort((distinct, -sums))[: self.keep]
        at = first[best]
        starts = np.cumsum(sizes) - sizes
        self.held = [(distinct[best], sums[best], sizes[at], data[B.ranges(starts[at], sizes[at])])]
        self.size = len(best)

    def rows(self, place: int) -> pa.RecordBatch:
        self.shrink()
        hashes, counts, sizes, data = self.held[0]
        return pa.record_batch({"place": pa.array([place], pa.int64()), "hashes": B.blobs([hashes]), "counts": B.blobs([counts]), "sizes": B.blobs([sizes]), "data": B.blobs([data])})


def frequent(docs: DataFrame, model: str, keep: int = TABLE) -> DataFrame:
    """One row at most: the pre-tokens of all documents that are most frequent by the merged summaries of tasks."""

    def tally(batches):
        pre, found = PreTokens.of(model), Summary(keep)
        for _, _, _, part, start, end, hashes in spans(batches, pre):
            codes, distinct = pd.factorize(hashes)
            first = np.empty(len(distinct), np.int64)
            first[codes[::-1]] = np.arange(len(codes))[::-1]
            sizes = (end - start)[first]
            short = sizes <= 64  # longer ones are rare and would make summaries long
            found.add(distinct[short], np.bincount(codes, minlength=len(distinct))[short], sizes[short], part[B.ranges(start[first][short], sizes[short])])
        if found.held:
            yield found.rows(TaskContext.get().partitionId())
        B.give_back()

    def merge(table: pa.Table) -> pa.Table:
        found = Summary(keep)
        for b in table.to_batches(max_chunksize=1):
            found.add(*(np.frombuffer(b.column(c)[0].as_py(), t) for c, t in (("hashes", U), ("counts", np.int64), ("sizes", np.int64), ("data", np.uint8))))
        return pa.Table.from_batches([found.rows(table.column("place")[0].as_py() // FAN)])

    now = stored(docs.select("text").mapInArrow(tally, SUMMARY), "summaries")
    highest = now.agg(F.max("place")).first()[0] or 0
    while highest:  # one level of a tree with FAN branches a round
        then = stored(now.groupBy(F.floor(F.col("place") / FAN).alias("group")).applyInArrow(merge, SUMMARY), "summaries")
        release(now)
        now, highest = then, highest // FAN
    return now


class Lookup:
    """Open-addressing table of hashes and lengths; at most TABLE entries in four times as many places."""

    def __init__(self, hashes: np.ndarray, lengths: np.ndarray):
        size = 1 << max(4, int(4 * max(1, len(hashes)) - 1).bit_length())
        self.keys, self.values, self.mask = np.zeros(size, U), np.full(size, -1, np.int32), U(size - 1)
        self.steps = 0
        for h, n in zip(hashes.tolist(), lengths.tolist()):
            at, step = h & (size - 1), 0
            while self.values[at] >= 0:
                at, step = (at + 1) & (size - 1), step + 1
            self.keys[at], self.values[at] = h, n
            self.steps = max(self.steps, step)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        """Length of each, -1 for a miss."""
        at = (hashes & self.mask).astype(np.int64)
        out = np.where(self.keys[at] == hashes, self.values[at], -1).astype(np.int64)
        for step in range(1, self.steps + 1):
            left = np.flatnonzero(out < 0)
            place = (at[left] + step) & int(self.mask)
            hit = self.keys[place] == hashes[left]
            out[left[hit]] = self.values[place[hit]]
        return out


def lookup_table(docs: DataFrame, model: str, keep: int = TABLE) -> Lookup:
    """The table of the most frequent pre-tokens; what reaches the driver is their hashes and lengths, 12 bytes each."""

    def measured(batches):
        for b in batches:
            for r in b.to_pylist():
                ends = np.cumsum(np.frombuffer(r["sizes"], np.int64)).tolist()
                parts = [r["data"][i:j] for i, j in zip([0, *ends], ends)]
                yield pa.record_batch({"hashes": pa.array([r["hashes"]], pa.binary()), "lengths": B.blobs([np.array(PreTokens.of(model).lengths(parts), np.int32)])})

    found = frequent(docs, model, keep)
    rows = found.mapInArrow(measured, "hashes binary, lengths binary").collect()
    release(found)
    return Lookup(np.frombuffer(rows[0]["hashes"], U), np.frombuffer(rows[0]["lengths"], np.int32)) if rows else Lookup(np.zeros(0, U), np.zeros(0, np.int32))


def count_tokens(docs: DataFrame, model: str | None = None, limit: int = LIMIT, keep: int = TABLE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs."""
    model = model or default_model()
    docs = docs.select("doc_id", "text")
    table = docs.sparkSession.sparkContext.broadcast(lookup_table(docs, model, keep))

    def count(batches):
        pre, known = PreTokens.of(model), table.value
        whole, tokens = None, None

        def done():
            n = pc.fill_null(pc.binary_length(whole.column("text")), 0).cast(pa.int64())
            return pa.record_batch({"doc_id": whole.column("doc_id"), "n_bytes": n, "n_tokens": pa.array(tokens), "over_limit": pa.array(tokens > limit)})

        for b, off, lo, part, start, end, hashes in spans(batches, pre):
            if b is not whole:
                if whole is not None:
                    yield done()
                whole, tokens = b, np.zeros(b.num_rows, np.int64)
            lengths = known.get(hashes)
            miss = np.flatnonzero(lengths < 0)
            if len(miss):
                lengths[miss] = pre.cached(hashes[miss], start[miss], end[miss], part)
            sums = np.concatenate([[0], np.cumsum(lengths)])
            if b.num_rows == 1:
                tokens[0] += sums[-1]
            else:
                tokens += np.diff(sums[np.searchsorted(start, off)])
        if whole is not None:
            yield done()

    return docs.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
