"""Exact substring dedup: bytes covered by a string of ``LENGTH`` bytes that also starts elsewhere are cut.

Suffixes are compared by phrases, not by bytes. The least hash of every ``WINDOW`` byte positions (winnowing) cuts
documents into phrases wherever they stand, so equal strings of ``LENGTH`` bytes hold equal phrases between their first and
last cut. The steps:

1. A bounded bit table tells phrases used once from the others. Documents without a repeated phrase have nothing to
   cut and are finished in the next pass.
2. Shards. Each chunk of texts sorts the suffixes of its own phrase sequences and keeps the order, each suffix's
   first phrase and the place of the suffix before it (the Burrows-Wheeler transform with its last-to-first map).
3. Merge. Shards are never sorted together. Interleave refinement names, for all suffixes at once, the block of the merged
   order that their first h phrases put them in: the block at depth h + 1 of a suffix is named from its first phrase and the block at depth h
   of the suffix that follows, carried along the last-to-first map. After some depths the shards
   exchange which blocks hold more than one suffix anywhere; suffixes alone in their block leave. The depth at which a suffix
   leaves is its common prefix with the nearest other suffix.
4. Bytes. A window of ``LENGTH`` bytes inside a repeated interval is repeated for certain; one whose inner phrases are not a
   repeated interval is not. Only windows across the border of a repeated interval are left: their hashes are exchanged,
   with those windows from certain places that answer them.

Blocks are names, not positions: which block comes first does not matter to repeats, so no global order is made.

Chunks and hash ranges bound the memory of a task; a hash that many texts share is sent once per chunk. Texts
are written once, only those with a repeated phrase, in buckets by chunk, and never shuffled: what is found out about a chunk comes to them.

Cases: a NULL text is an empty one; texts shorter than ``LENGTH`` keep everything; matches never cross documents; a text
that repeats itself, overlaps included, is cut; repeated rows are each other's copies. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.counting import exchanged, ranked
from tidemark.llm.support import Rolling, arrow_rows, bucketed, column_bytes, distinct, mix, ship, slices, stored, text_bytes, text_slices

LENGTH, WINDOW, GRAM = 400, 128, 8
#: Depths after which shards exchange; beyond the last one, the bytes decide. Few suffixes get past the first.
DEPTHS = (4, 12, 32)
DEPTH = DEPTHS[-1]
CHUNK_BYTES, RANGE_BYTES = 3 << 20, 24 << 20
_SLICE = 1 << 19
#: Positions that one step of the winnowing works on.
_BLOCK = 1 << 13
#: No window nor the phrases around it reach further.
_REACH = LENGTH + 2 * (WINDOW + GRAM)


def least_places(data: np.ndarray) -> np.ndarray:
    """For every position the place of the least hash of the next WINDOW positions (the last of equals)."""
    n = len(data) - GRAM + 1
    if n < WINDOW:
        return np.zeros(0, np.int64)
    grams = np.lib.stride_tricks.sliding_window_view(data, GRAM)
    out = np.empty(n - WINDOW + 1, np.int64)
    for i in range(0, len(out), _BLOCK):  # blocks that stay in the processor's cache
        own = np.ascontiguousarray(grams[i : i + _BLOCK + WINDOW - 1]).view(np.uint64).ravel()
        key = mix(own)
        key &= np.uint64(0xFFFFFFFF00000000)
        key |= np.uint64(0xFFFFFFFF - i) - np.arange(len(key), dtype=np.uint64)
        width = 1
        while 2 * width <= WINDOW:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < WINDOW:
            key = np.minimum(key[: len(key) - (WINDOW - width)], key[WINDOW - width :])
        key &= np.uint64(0xFFFFFFFF)
        out[i : i + _BLOCK] = np.uint64(0xFFFFFFFF) - key
    return out


def window_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows inside documents whose least hash stands at the same place: the first of each run, and the place."""
    least = least_places(data)
    end = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    inside = np.flatnonzero(end - np.arange(len(least)) >= WINDOW + GRAM - 1)
    least = least[inside]
    new = np.ones(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    return inside[new], least[new]


def cuts(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts are cut: the places, and the documents' borders."""
    mark = np.zeros(offsets[-1] + 1, bool)
    mark[places] = True
    mark[offsets] = True
    return np.flatnonzero(mark)


class Phrases:
    """The phrases of a slice: starts, ends, hashes; ``follows`` tells that the one before ends where this starts.

    A document's phrases depend on its own text only.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.since, self.places = window_runs(data, offsets)
        at = cuts(self.places, offsets)
        self.starts, self.ends = at[:-1], at[1:]
        self.owner = np.searchsorted(offsets, self.starts, side="right") - 1
        self.hashes = Rolling(data).ranges(self.starts, self.ends)
        self.follows = self.starts != offsets[self.owner]


def suffix_order(symbols: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of phrase sequences in the order of their first DEPTH phrases, and each one's predecessor (-1: none)."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Phrases left in the sequence, so that a step never leaves it.
    ends = np.append(np.flatnonzero(~follows)[1:], n)
    left = np.repeat(ends, np.diff(np.append(np.flatnonzero(~follows), n))) - np.arange(n)
    _, rank = np.unique(symbols, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    step = 1
    while step < DEPTH:
        next_rank = np.zeros(n, np.int64)
        inside = left > step
        next_rank[inside] = rank[np.flatnonzero(inside) + step]
        _, rank = np.unique(rank * (n + 1) + next_rank, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        step *= 2
    order = np.argsort(rank, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(follows[order], place[order - 1], -1)
    return order, before


def block_names(symbols: np.ndarray, before: np.ndarray, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For depths 1 to ``depth``: each suffix's block, and whether it is that long. In suffix order."""
    block, long = mix(symbols.copy()), np.ones(len(symbols), bool)
    yield block, long
    for _ in range(depth - 1):
        carried, reached = np.zeros_like(block), np.zeros(len(block), bool)
        goes = np.flatnonzero((before >= 0) & long)
        to = before[goes]
        carried[to] = mix(symbols[to] * np.uint64(0x9E3779B97F4A7C15) + block[goes])
        reached[to] = True
        block, long = carried, reached
        yield block, long


def _array(row: pa.RecordBatch, name: str, k: int, kind) -> np.ndarray:
    return np.frombuffer(row.column(row.schema.get_field_index(name))[k].as_py() or b"", kind)


def _steps(ascending: np.ndarray) -> bytes:
    return np.diff(ascending, prepend=0).astype(np.int32).tobytes()


def shards(docs: DataFrame, used: object) -> DataFrame:
    """Rows of two kinds: finished documents (with ``n_bytes``), and chunks of the others with their sorted suffixes. ``chunk`` deals out both."""
    sent = docs.sparkSession.sparkContext.broadcast(used)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used, number = sent.value, TaskContext.get().partitionId() << 32
        ids, texts, found, size, kind = [], [], [], 0, None

        def chunk():
            nonlocal ids, texts, found, size, number
            offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
            symbols, follows, starts, ends, since, places = (np.concatenate(x) for x in zip(*found, strict=True))
            order, before = suffix_order(symbols, follows)
            row = arrow_rows(
                chunk=([number], pa.int64()), doc_id=pa.nulls(1, kind), n_bytes=([None], pa.int64()), sha=([None], pa.string()),
                ids=([ids], pa.list_(kind)), offsets=([offsets.astype(np.int64).tobytes()], pa.binary()), text=([b"".join(texts)], pa.binary()),
                symbols=([symbols[order].tobytes()], pa.binary()), before=([before.astype(np.int32).tobytes()], pa.binary()),
                starts=([starts[order].astype(np.int32).tobytes()], pa.binary()), ends=([ends[order].astype(np.int32).tobytes()], pa.binary()),
                since=([_steps(since)], pa.binary()), places=([_steps(places)], pa.binary()),
            )
            ids, texts, found, size, number = [], [], [], 0, number + 1
            return row

        for batch in batches:
            kind = batch.column(0).type
            names = batch.column(0).to_pylist()
            d_id, d_n, d_sha = [], [], []
            for i, j, data, offsets in text_slices(batch, "text", _SLICE):
                p = Phrases(data, offsets)
                again = used.repeated(p.hashes)
                live = np.zeros(j - i, bool)
                live[p.owner[again]] = True
                live &= np.diff(offsets) >= LENGTH
                joins = p.follows.copy()
                joins[1:] &= again[:-1]
                # The live documents move together, behind those of the slices before.
                own = np.where(live, np.diff(offsets), 0)
                moved = size + np.cumsum(own) - own - offsets[:-1]
                keep, by = again & live[p.owner], moved[p.owner]
                run = np.searchsorted(offsets, p.since, side="right") - 1
                kept, run_by = live[run], moved[run]
                found.append((
                    p.hashes[keep], joins[keep], (p.starts + by)[keep], (p.ends + by)[keep], (p.since + run_by)[kept], (p.places + run_by)[kept],
                ))
                for d in range(j - i):
                    raw = data[offsets[d] : offsets[d + 1]].tobytes()
                    if live[d]:
                        ids.append(names[i + d])
                        texts.append(raw)
                    else:
                        d_id.append(names[i + d])
                        d_n.append(len(raw))
                        d_sha.append(hashlib.sha256(raw).hexdigest())
                size += int(own.sum())
                if size >= CHUNK_BYTES:
                    yield chunk()
            n = len(d_id)
            nothing = lambda t: pa.nulls(n, t)
            yield arrow_rows(
                chunk=np.full(n, number, np.int64), doc_id=(d_id, kind), n_bytes=(d_n, pa.int64()), sha=(d_sha, pa.string()), ids=nothing(pa.list_(kind)),
                offsets=nothing(pa.binary()), text=nothing(pa.binary()), symbols=nothing(pa.binary()), before=nothing(pa.binary()),
                starts=nothing(pa.binary()), ends=nothing(pa.binary()), since=nothing(pa.binary()), places=nothing(pa.binary()),
            )
            number += 1
        if texts:
            yield chunk()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"chunk long, doc_id {kind}, n_bytes long, sha string, ids array<{kind}>, offsets binary, text binary, "
        "symbols binary, before binary, starts binary, ends binary, since binary, places binary",
    )


def _parts(values: np.ndarray, ranges: int) -> np.ndarray:
    """Where each hash range begins in sorted values, and the end."""
    part = ((values >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(ranges + 1))


def _asking(chunk: int, asked: np.ndarray, told: np.ndarray, ranges: int) -> pa.RecordBatch:
    """Exchange rows of a chunk: what it asks (with repeats) and what it tells."""
    asked = np.sort(asked)
    first = np.flatnonzero(np.concatenate(([True], asked[1:] != asked[:-1]))) if len(asked) else np.zeros(0, np.int64)
    twice = (np.diff(first, append=len(asked)) > 1).astype(np.uint8)
    asked, told = asked[first], distinct(told)
    a, t = _parts(asked, ranges), _parts(told, ranges)
    keep = [k for k in range(ranges) if a[k + 1] > a[k] or t[k + 1] > t[k]]
    cut = lambda v, at: ([v[at[k] : at[k + 1]].tobytes() for k in keep], pa.binary())
    return arrow_rows(part=np.array(keep, np.int32), chunk=np.full(len(keep), chunk, np.int64), asked=cut(asked, a), twice=cut(twice, a), told=cut(told, t))


_ASKING = "part int, chunk long, asked binary, twice binary, told binary"


def _gathered(answers: DataFrame) -> DataFrame:
    """The answers of a chunk in one row: bounded by the chunk's size."""
    return answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("part", "bits"))).alias("answers"))


def _beside(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """What was found out about chunks, beside them: the small side is shuffled and held, a bucket at a time."""
    return chunks.join(found.hint("shuffle_hash"), "chunk", "left")


def _answered(asked: np.ndarray, answers: list, ranges: int) -> np.ndarray:
    """The repeated ones among sorted distinct hashes."""
    at = _parts(asked, ranges)
    out = [np.zeros(0, np.uint64)]
    for x in answers or []:
        own = asked[at[x["part"]] : at[x["part"] + 1]]
        bits = np.unpackbits(np.frombuffer(x["bits"], np.uint8), count=len(own)).astype(bool)
        out.append(own[bits])
    return np.concatenate(out)


def common_prefixes(chunks: DataFrame, ranges: int) -> DataFrame:
    """``(chunk, lcp)``: for each suffix of a shard how many phrases it shares with another one, anywhere."""
    shard = chunks.select("chunk", "symbols", "before", "starts", "ends")
    lcp = None
    for depth, next_depth in zip((0, *DEPTHS), DEPTHS):
        rows = shard.withColumn("lcp", F.lit(None).cast("binary")) if lcp is None else _beside(shard, lcp)

        def blocks(batch, k, depth=depth, next_depth=next_depth):
            """Blocks at the next depths of the suffixes that still share all before; None where none is left."""
            symbols, before = _array(batch, "symbols", k, np.uint64), _array(batch, "before", k, np.int32)
            have = _array(batch, "lcp", k, np.uint8) if depth else np.zeros(len(symbols), np.uint8)
            starts, ends = _array(batch, "starts", k, np.int32), _array(batch, "ends", k, np.int32)
            open_ = have >= depth
            if depth:  # nothing beyond the reach of a window is asked for
                end = ends.astype(np.int64)
                for _ in range(depth - 1):
                    end = _carry(end, before)
                open_ &= end - starts < _REACH
            found = []
            for d, (block, long) in enumerate(block_names(symbols, before, next_depth)):
                if d >= depth:
                    found.append((block, long & open_))
            return have, found

        def send(batches: Iterator[pa.RecordBatch], blocks=blocks) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    _, found = blocks(batch, k)
                    asked = np.concatenate([b[ok] for b, ok in found])
                    if len(asked):
                        yield _asking(batch.column(0)[k].as_py(), asked, asked[:0], ranges)

        def learn(batches: Iterator[pa.RecordBatch], blocks=blocks) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    have, found = blocks(batch, k)
                    asked = distinct(np.concatenate([b[ok] for b, ok in found]))
                    again = _answered(asked, batch.column(batch.schema.get_field_index("answers"))[k].as_py(), ranges)
                    out, going, grown = have.copy(), np.ones(len(have), bool), 0
                    for block, ok in found:
                        at = np.minimum(np.searchsorted(again, block), max(len(again) - 1, 0))
                        going &= ok & (again[at] == block if len(again) else False)
                        out += going
                        grown += int(going.sum())
                    yield arrow_rows(chunk=([batch.column(0)[k].as_py()], pa.int64()), lcp=([out.tobytes()], pa.binary()), grown=([int(going.sum())], pa.int64()))

        answers = _gathered(exchanged(rows.mapInArrow(send, _ASKING)))
        table = stored(_beside(rows, answers).mapInArrow(learn, "chunk long, lcp binary, grown long"), "common-prefixes")
        lcp = table.select("chunk", "lcp")
        if not (table.agg(F.sum("grown")).first()[0] or 0):
            break
    return lcp


def _carry(end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The end of one phrase more for every suffix: that of the suffix which follows."""
    out = end.copy()
    goes = np.flatnonzero(before >= 0)
    out[before[goes]] = end[goes]
    return out


def borders(batch: pa.RecordBatch, k: int):
    """Slice by slice of a chunk: (first document, last + 1, bytes, offsets, certain windows, open windows, hashes of places)."""
    data, offsets = _array(batch, "text", k, np.uint8), _array(batch, "offsets", k, np.int64)
    starts, lcp = _array(batch, "starts", k, np.int32), _array(batch, "lcp", k, np.uint8)
    since, places = (np.cumsum(_array(batch, name, k, np.int32), dtype=np.int64) for name in ("since", "places"))
    shared = np.zeros(len(data) + 1, np.uint8)
    shared[starts] = lcp
    for i, j in slices(offsets, _SLICE):
        base = offsets[i]
        text, at = data[base : offsets[j]], offsets[i : j + 1] - base
        own = shared[base : base + len(text) + 1]
        size = np.diff(at)
        s = np.concatenate([np.arange(at[d], at[d + 1] - LENGTH + 1) for d in range(j - i) if size[d] >= LENGTH] or [np.zeros(0, np.int64)])
        if not len(s):
            yield i, j, text, at, s, s, Rolling(text)
            continue
        low, high = np.searchsorted(since, (base, offsets[j]))
        run, place = since[low:high] - base, places[low:high] - base
        least = np.zeros(len(text), np.int32)  # the place of every window inside a document
        least[run[0] :] = np.repeat(place, np.diff(run, append=len(text)))
        at_cut = cuts(place, at)
        number = np.zeros(len(text) + 2, np.int64)  # cuts before each position
        number[1 : len(text) + 2][at_cut] = 1
        number = np.cumsum(number)
        first, last = least[s], least[s + LENGTH - GRAM + 1 - WINDOW]
        inner = own[first].astype(np.int64)
        may = (inner >= number[last] - number[first]) | (inner >= DEPTH)
        s = s[may]
        # The cuts around the window: the last one at or before it, the first one at or after its end.
        low, high = number[s + 1] - 1, number[s + LENGTH]
        certain = own[at_cut[low]] >= high - low
        yield i, j, text, at, s[certain], s[~certain], Rolling(text)


def removed(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    ship(docs.sparkSession)
    ranges = max(1, -(-text_bytes(docs) // RANGE_BYTES))

    def phrases(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, _, data, at in text_slices(batch, "text", _SLICE):
            yield Phrases(data, at).hashes

    used = ranked(docs.select("text"), phrases, ranges)
    rows = bucketed(shards(docs, used), "shards", "chunk", ranges)
    chunks = rows.where("n_bytes IS NULL")
    lcp = common_prefixes(chunks, ranges)
    texts = _beside(chunks.select("chunk", "ids", "offsets", "text", "starts", "since", "places"), lcp)

    def questions(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for k in range(batch.num_rows):
            for *_, open_, h in borders(batch, k):
                yield h.ranges(open_, open_ + LENGTH)

    asked = ranked(texts, questions, ranges, least=1)
    sent = docs.sparkSession.sparkContext.broadcast(asked)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        for batch in batches:
            for k in range(batch.num_rows):
                ask, tell = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
                for *_, certain, open_, h in borders(batch, k):
                    ask.append(h.ranges(open_, open_ + LENGTH))
                    known = h.ranges(certain, certain + LENGTH)
                    tell.append(known[asked.repeated(known)])
                yield _asking(batch.column(0)[k].as_py(), np.concatenate(ask), np.concatenate(tell), ranges)

    answers = _gathered(exchanged(texts.mapInArrow(send, _ASKING)))
    joined = _beside(texts, answers)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found, asked = [], []
                for i, j, text, at, certain, open_, h in borders(batch, k):
                    found.append((i, j, text, at, certain.astype(np.int32), open_.astype(np.int32)))
                    asked.append(h.ranges(open_, open_ + LENGTH))
                again = _answered(distinct(np.concatenate([np.zeros(0, np.uint64), *asked])), batch.column(batch.schema.get_field_index("answers"))[k].as_py(), ranges)
                n, cut, runs, sha = [], [], [], []
                for (i, j, text, at, certain, open_), hashes in zip(found, asked, strict=True):
                    place = np.minimum(np.searchsorted(again, hashes), max(len(again) - 1, 0))
                    hit = np.concatenate((certain, open_[again[place] == hashes] if len(again) else open_[:0]))
                    edge = np.zeros(len(text) + 1, np.int64)
                    np.add.at(edge, hit, 1)
                    np.add.at(edge, hit + LENGTH, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    for d in range(j - i):
                        own = gone[at[d] : at[d + 1]]
                        n.append(len(own))
                        cut.append(int(own.sum()))
                        runs.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
                        sha.append(hashlib.sha256(text[at[d] : at[d + 1]][~own].tobytes()).hexdigest())
                ids = batch.column(batch.schema.get_field_index("ids"))[k].values
                yield arrow_rows(doc_id=ids, n_bytes=(n, pa.int64()), n_removed=(cut, pa.int64()), n_spans=(runs, pa.int64()), kept_sha256=(sha, pa.string()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = joined.mapInArrow(finish, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    zero = F.lit(0).cast("long")
    clean = rows.where("n_bytes IS NOT NULL").select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("sha").alias("kept_sha256"))
    return cut.unionAll(clean)
