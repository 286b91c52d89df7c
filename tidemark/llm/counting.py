"""How often hashes are used across the corpus, in tables of bounded size.

Tasks send their hashes by hash range, packed into arrays, so that a shuffle moves few rows. What comes back to
the driver, and goes to every task, is a bit table of fixed size that tells hashes used once from the others (with
false positives as it fills) and a list of the most frequent ones. Callers use both only where an
error costs time, never a result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.support import arrow_rows, column_bytes, give_back, stored

#: Uses from which a hash counts as frequent, at first; doubled until the list fits.
FREQUENT = 32
#: Most frequent hashes that are listed (9 bytes each), and bits of the table of repeated ones.
LISTED, TABLE_BITS = 1 << 20, 27
#: Hashes that a task gathers before it sends them.
_WAITING = 1 << 20


def pack(values: np.ndarray) -> bytes:
    """Sorted 32-bit values as 16-bit steps; 65535 means a step of that size goes on."""
    steps = np.diff(values.astype(np.int64), prepend=0)
    over = steps // 65535
    at = np.cumsum(over + 1) - 1
    out = np.full(int(at[-1]) + 1 if len(at) else 0, 65535, np.uint16)
    out[at] = steps % 65535
    return out.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint16)
    return np.cumsum(steps, dtype=np.int64)[steps != 65535].astype(np.uint32)


class Ranking:
    """How often shingles are used, as far as ranking needs it; the same bounded size for any input."""

    def __init__(self, ranges: int, slot_bits: int):
        self.ranges, self.slot_bits = ranges, slot_bits
        self.table = np.zeros((ranges << slot_bits) // 8, np.uint8)
        self.frequent, self.level = np.zeros(0, np.uint64), np.zeros(0, np.uint8)

    def split(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        high = tokens >> np.uint64(32)
        return (high * np.uint64(self.ranges)) >> np.uint64(32), tokens & np.uint64(0xFFFFFFFF)

    def repeated(self, tokens: np.ndarray) -> np.ndarray:
        part, low = self.split(tokens)
        slot = (part << np.uint64(self.slot_bits)) + (low >> np.uint64(32 - self.slot_bits))
        return (self.table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def ranks(self, tokens: np.ndarray) -> np.ndarray:
        """0: used once; 1: rare; more: frequent."""
        rank = self.repeated(tokens).astype(np.uint8)
        if len(self.frequent):
            part, low = self.split(tokens)
            key = (part << np.uint64(32)) + low
            at = np.minimum(np.searchsorted(self.frequent, key), len(self.frequent) - 1)
            hit = self.frequent[at] == key
            rank[hit] = self.level[at[hit]]
        return rank


def grouped(f):
    """``f(key, batches)`` with the annotations by which Spark hands a group over batch by batch."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(key, batches)

    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return run


def ranked(df: DataFrame, tokens: Callable[[pa.RecordBatch], Iterator[np.ndarray]], ranges: int, least: int = 2) -> Ranking:
    """The ranking of the hashes that ``tokens`` finds in batches; the table holds those used ``least`` times or more."""
    ranges = max(1, min(ranges, 1 << 16))
    slot_bits = min(32, max(3, TABLE_BITS - (ranges - 1).bit_length()))
    out = Ranking(ranges, slot_bits)
    split = Ranking(ranges, 3).split

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def packed():
            found = np.sort(np.concatenate(waiting))
            part, low = split(found)
            edges = np.searchsorted(part, np.arange(ranges + 1))
            low = low.astype(np.uint32)
            keep = [k for k in range(ranges) if edges[k + 1] > edges[k]]
            return arrow_rows(
                part=np.array(keep, np.int32), low=([pack(np.sort(low[edges[k] : edges[k + 1]])) for k in keep], pa.binary())
            )

        for batch in batches:
            for found in tokens(batch):
                waiting.append(found)
                size += len(found)
                if size > _WAITING:
                    yield packed()
                    waiting, size = [], 0
        if size:
            yield packed()
        waiting.clear()
        give_back()

    def count(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.sort(np.concatenate([unpack(v.as_py()) for b in batches for v in b.column(1)]))
        first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        n = np.diff(first, append=len(low))
        value = low[first]
        table = np.zeros(1 << slot_bits, bool)
        table[value[n >= least] >> np.uint32(32 - slot_bits)] = True
        often = n >= FREQUENT
        yield arrow_rows(
            part=([key[0].as_py()], pa.int32()), table=([np.packbits(table, bitorder="little").tobytes()], pa.binary()),
            value=([value[often].astype(np.uint32).tobytes()], pa.binary()), n=([n[often].astype(np.uint32).tobytes()], pa.binary()),
        )
        del low, value, table
        give_back()

    sent = df.mapInArrow(send, "part int, low binary")
    counted = stored(sent.groupBy("part").applyInArrow(grouped(count), "part int, table binary, value binary, n binary"), "counts")
    # The least doubling of FREQUENT whose list fits.
    limit, lists = FREQUENT, []
    for row in counted.toLocalIterator():
        size = len(row.table)
        out.table[row.part * size : (row.part + 1) * size] = np.frombuffer(row.table, np.uint8)
        value, n = np.frombuffer(row.value, np.uint32), np.frombuffer(row.n, np.uint32)
        lists.append(((np.uint64(row.part) << np.uint64(32)) + value[n >= limit].astype(np.uint64), n[n >= limit]))
        while sum(len(v) for v, _ in lists) > LISTED:
            limit *= 2
            lists = [(v[m >= limit], m[m >= limit]) for v, m in lists]
    if lists:
        values, n = np.concatenate([v for v, _ in lists]), np.concatenate([m for _, m in lists])
        order = np.argsort(values)
        out.frequent, out.level = values[order], np.log2(n[order]).astype(np.uint8)
    return out


def exchanged(rows: DataFrame) -> DataFrame:
    """Which hashes occur more than once anywhere: exact, by hash range.

    ``rows(part, chunk, asked, twice, told)``: sorted distinct 64-bit hashes that a chunk asks about, a byte for
    each that says whether the chunk has it more than once, and further hashes that the chunk has.
    Gives ``(part, chunk, bits)``: an answer for every hash asked.
    """

    def count(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, asked, twice, told = [], [], [], []
        for b in batches:
            name = b.schema.get_field_index
            chunks += b.column(name("chunk")).to_pylist()
            for out, column, kind in ((asked, "asked", np.uint64), (twice, "twice", np.uint8), (told, "told", np.uint64)):
                data, at = column_bytes(b.column(name(column)))
                out += [np.frombuffer(data[i:j].tobytes(), kind) for i, j in zip(at[:-1], at[1:], strict=True)]
        everything = np.sort(np.concatenate([*asked, *told, *[a[t > 0] for a, t in zip(asked, twice, strict=True)]]))
        again = everything[1:][everything[1:] == everything[:-1]]
        bits = []
        for a in asked:
            at = np.minimum(np.searchsorted(again, a), max(len(again) - 1, 0))
            bits.append(np.packbits(again[at] == a if len(again) else np.zeros(len(a), bool)).tobytes())
        yield arrow_rows(part=np.full(len(chunks), key[0].as_py(), np.int32), chunk=np.array(chunks, np.int64), bits=(bits, pa.binary()))

    return rows.groupBy("part").applyInArrow(grouped(count), "part int, chunk long, bits binary")
