"""What the text operators share: intermediate tables, shipping, and vectorised work on UTF-8 bytes.

Texts reach Python as Arrow columns. They are never turned into Python strings where it can be
avoided: a column is one byte array with offsets, and words, n-grams and hashes are computed over
it with numpy, in slices of whole documents of about ``SLICE`` bytes so that temporaries stay small.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles; a longer document is a slice of its own.
SLICE = 1 << 19

SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


# --- intermediate tables -------------------------------------------------------------------


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors share.

    Where that is unset, a temporary folder serves in local mode only; a cluster must set it.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there, and the
    optimizer sees the true size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Most buckets of a table; Spark's own limit is 100,000.
_BUCKETS = 1 << 16


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``stored``, in buckets by the hash of ``key``: joins by it leave these rows where they are and move the other side.

    There are as many buckets as shuffle partitions at least, or a join would shuffle these rows to that number. Spark buckets only tables with
    a name in the catalog; the name goes at once, the files stay with the others.
    """
    spark = df.sparkSession
    path, table = scratch_path(spark, name), f"`spark_catalog`.`default`.`tidemark_{uuid.uuid4().hex}`"
    buckets = min(max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions"))), _BUCKETS)
    df.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, key).saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application (as ``--py-files`` would)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "tidemark")):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on between tasks, and what it holds counts against its executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_name(column: str = "text"):
    """A name for a text: its hash and length. Equal texts share it; NULL has none."""
    return F.concat_ws(":", F.hex(F.xxhash64(column)), F.when(F.col(column).isNotNull(), F.octet_length(column)))


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of text in the whole table."""
    return int(docs.agg(F.sum(F.octet_length(column)).alias("n")).first().n or 0)


def remainder(column: str, modulus: int):
    """crc32 of the value as text, modulo ``modulus``: how labelled rows are split."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


# --- bytes ---------------------------------------------------------------------------------


def column_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and row offsets into them. NULL is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
        if isinstance(array, pa.ChunkedArray):
            array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], array.type)
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    large = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, offsets, data = array.buffers()
    kind = np.int64 if large else np.int32
    if offsets is None or len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE):
    """(first row, last row + 1, bytes, offsets from 0) of each slice of a batch."""
    data, offsets = column_bytes(batch.column(batch.schema.get_field_index(column)))
    for i, j in slices(offsets, limit):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def byte_table(outside: bytes) -> np.ndarray:
    """True for every byte that is not in ``outside``."""
    table = np.ones(256, bool)
    table[list(outside)] = False
    return table


NOT_SPACE = byte_table(SPACES)
#: 0-9, a-z and every byte of a code point above 0x7F.
WORD = byte_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased; other bytes as they are."""
    return _LOWER[data]


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of the table's bytes within a document, and each document's
    first run (one more entry than documents)."""
    inside = table[data]
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    before[cuts] = False
    after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets, side="left")


# --- hashes --------------------------------------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


#: The prime 2**31 - 1, and two bases in its field: sums modulo a power of two would have equal
#: hashes for long words of two letters, whatever the base.
_PRIME, _BITS31 = np.uint64((1 << 31) - 1), np.uint64(31)
_BASES = (1_527_834_371, 996_743_023)
#: A value below the prime for each byte.
_BYTES = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % (_PRIME - np.uint64(1))) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}
#: Longest byte array whose powers are kept.
_CACHED = 1 << 22
#: Entries that one step of the hashing works on.
_BLOCK = 1 << 14


def _folded(x: np.ndarray) -> np.ndarray:
    """The bits above the lowest 31 added to these, which keeps the value modulo the prime; ``x`` is used up."""
    high = x >> _BITS31
    x &= _PRIME
    x += high
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """64-bit values modulo the prime, exactly; ``x`` is used up."""
    x = _folded(_folded(x))
    # What is left is at most the prime and eight more.
    high = x + np.uint64(1)
    high >>= _BITS31
    x += high
    x &= _PRIME
    return x


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo the prime, in 32 bits each."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        have = np.ones(max(n, SLICE) + 1, np.uint32)
        done, step = 1, base
        while done < len(have):  # the first powers give as many more
            more = min(done, len(have) - done)
            for i in range(0, more, _BLOCK):
                part = have[i : min(i + _BLOCK, more)].astype(np.uint64)
                part *= np.uint64(step)
                have[done + i : done + i + len(part)] = _reduced(part)
            done, step = done + more, step * step % int(_PRIME)
        if n <= _CACHED:
            _powers[base] = have
    return have


class Rolling:
    """Polynomial hashes of any byte range: prefix sums in the field of 2**31 - 1, for two bases.

    Two different ranges of n bytes collide with a probability of about (n / 2**31)**2 over the bases. A byte takes eight
    bytes of sums, and sixteen of tables of powers, which are kept for texts of up to ``_CACHED`` bytes.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        tables = [(np.empty(n + 1, np.uint32), _power(base, n), _power(pow(base, -1, int(_PRIME)), n)) for base in _BASES]
        buffer, carry = np.empty(min(_BLOCK, n), np.uint64), [np.uint64(0)] * len(tables)
        for sums, _, _ in tables:
            sums[0] = 0
        for i in range(0, n, _BLOCK):  # blocks that stay in the processor's cache
            values = _BYTES[data[i : i + _BLOCK]]
            terms = buffer[: len(values)]
            for k, (sums, powers, _) in enumerate(tables):
                np.multiply(values, powers[i : i + len(values)], out=terms)
                _folded(terms)  # below 2**32
                terms[0] += carry[k]
                np.cumsum(terms, out=terms)
                # Below 2**31 + 2**16: ``ranges`` reduces what it takes from these.
                sums[i + 1 : i + 1 + len(values)] = _folded(terms)
                carry[k] = np.uint64(sums[i + len(values)])
        self.parts = [(sums, inverse) for sums, _, inverse in tables]

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        for i in range(0, len(starts), _BLOCK):
            s, e = starts[i : i + _BLOCK], ends[i : i + _BLOCK]
            both = []
            for sums, inverse in self.parts:
                h = sums[e].astype(np.uint64)
                h += _PRIME + _PRIME
                h -= sums[s]  # below 3 * 2**31, and the power below 2**31
                h *= inverse[s]
                both.append(_reduced(h))
            h = both[0] << _BITS31
            h |= both[1]
            h += (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            out[i : i + _BLOCK] = mix(h)
        return out


_FOLD = np.uint64(0xD6E8FEB86659FD93)


def fold(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k consecutive values."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    g = h[:n].copy()
    for j in range(1, k):
        g *= _FOLD
        g += h[j : j + n]
    return mix(g)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


def arrow_rows(**columns) -> pa.RecordBatch:
    """A record batch from numpy arrays, Arrow arrays or (values, type) pairs."""
    names, arrays = [], []
    for name, values in columns.items():
        names.append(name)
        if isinstance(values, tuple):
            arrays.append(pa.array(values[0], type=values[1]))
        else:
            arrays.append(values if isinstance(values, pa.Array) else pa.array(values))
    return pa.RecordBatch.from_arrays(arrays, names=names)
