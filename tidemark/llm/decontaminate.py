"""Benchmark decontamination by winnowing.

Words are hashed, every ``K`` consecutive words make a k-gram, and every ``W`` consecutive k-grams keep
the one with the least hash. ``K + W - 1 = 10``, so a window of ten words has exactly one kept
k-gram, and two equal windows keep the same: no shared span of ten words is missed. Windows of a document
whose kept k-gram is kept by a benchmark item are extended to the whole ten words and compared. Items of
fewer words are one window of their own length, looked up at that length.

The fingerprints of the benchmark, not of the documents, are what tasks receive: at most ``BLOCK``
windows at a time. A larger benchmark is worked through in blocks, each a pass over the
documents that adds to what earlier blocks found; the result is the same. Documents are never shuffled.

Cases: a NULL text or item has no words; items without words match nothing; equal items all count; repeated
documents get equal rows; an empty benchmark leaves every document clean. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.support import WORD, Rolling, arrow_rows, fold, give_back, lower, ship, spans, stored, text_name, text_slices

N, K = 10, 5
W = N - K + 1
#: Most benchmark windows that one pass holds in a task (about 40 bytes each).
BLOCK = 500_000
_BITS = 22


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = lower(data)
    starts, ends, first = spans(data, offsets, WORD)
    return Rolling(data).ranges(starts, ends), first


def kept(h: np.ndarray) -> np.ndarray:
    """For every window of N words the k-gram hash that winnowing keeps."""
    g = fold(h, K)
    n = len(g) - W + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    least = g[:n].copy()
    for j in range(1, W):
        np.minimum(least, g[j : j + n], out=least)
    return least


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows of the benchmark: item_id (as text), words, win, fingerprint."""
    ship(benchmark.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, j, data, offsets in text_slices(batch):
                h, first = word_hashes(data, offsets)
                for d in range(j - i):
                    own = h[first[d] : first[d + 1]]
                    if not len(own):
                        continue
                    n = min(N, len(own))
                    win, at = np.unique(fold(own, n), return_index=True)
                    mark = kept(own)[at] if n == N else win
                    yield arrow_rows(item_id=([ids[i + d]] * len(win), pa.string()), words=np.full(len(win), n, np.int32),
                                     win=win.view(np.int64), fingerprint=mark.view(np.int64))

    return benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(
        run, "item_id string, words int, win long, fingerprint long"
    )


class Index:
    """A block of benchmark windows, as sorted arrays."""

    def __init__(self, rows: pa.Table):
        names = rows.column("item_id").combine_chunks().dictionary_encode()
        names = names.combine_chunks() if isinstance(names, pa.ChunkedArray) else names
        self.items = names.dictionary.to_pylist()
        number = names.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        words, win, mark = (rows.column(c).to_numpy() for c in ("words", "win", "fingerprint"))
        self.by_words = {}
        for n in np.unique(words).tolist():
            own = words == n
            order = np.argsort(win[own].view(np.uint64), kind="stable")
            item = number[own]
            distinct, at = np.unique(win[own].view(np.uint64)[order], return_index=True)
            marks = np.unique(mark[own].view(np.uint64))
            sieve = np.zeros(1 << _BITS, bool)
            sieve[marks >> np.uint64(64 - _BITS)] = True
            self.by_words[n] = (distinct, np.append(at, len(item)), item[order], marks, sieve)

    def search(self, h: np.ndarray, first: np.ndarray):
        """Hits in a slice of documents: first word, number of words, and numbers of the items."""
        owner_end = np.repeat(first[1:], np.diff(first)) if len(h) else np.zeros(0, np.int64)
        found = []
        for n, (distinct, at, item, marks, sieve) in self.by_words.items():
            look = kept(h) if n == N else fold(h, n)
            place = np.flatnonzero(sieve[look >> np.uint64(64 - _BITS)])
            place = place[place + n <= owner_end[place]]
            place = place[member(look[place], marks)]
            if not len(place):
                continue
            win = fold_at(h, place, n)  # the hit, extended to the whole window
            ok = member(win, distinct)
            place, win = place[ok], np.searchsorted(distinct, win[ok])
            for p, w in zip(place.tolist(), win.tolist(), strict=True):
                found.append((p, n, item[at[w] : at[w + 1]]))
        return found


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def fold_at(h: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """``fold(h, n)[place]`` without the rest."""
    return fold(h[(place[:, None] + np.arange(n)).ravel()], n)[::n]


def scanner(docs: DataFrame, index: Index):
    """A function on batches of ``docs`` that adds this block's hits to n_words, hits (first word and words, flat) and
    items."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            n_words = np.zeros(batch.num_rows, np.int64)
            hits: dict[int, list] = defaultdict(list)
            items: dict[int, set] = defaultdict(set)
            for i, j, data, offsets in text_slices(batch, "__text"):
                h, first = word_hashes(data, offsets)
                n_words[i:j] = np.diff(first)
                for place, n, own in index.search(h, first):
                    d = int(np.searchsorted(first, place, side="right")) - 1
                    hits[i + d] += (int(place - first[d]), n)
                    items[i + d].update(index.items[k] for k in own.tolist() if k >= 0)
            columns = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            columns["__n_words"] = pa.array(n_words)
            for name, found, kind in (("__hits", hits, pa.int32()), ("__items", items, pa.string())):
                earlier = columns[name].to_pylist()
                for d, more in found.items():
                    earlier[d] = [*(earlier[d] or []), *more]
                columns[name] = pa.array(earlier, pa.list_(kind))
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        give_back()

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items (sorted ids as text), items_sha256, contaminated."""
    spark = docs.sparkSession
    windows = stored(item_windows(benchmark), "benchmark-windows")
    blocks = max(1, -(-windows.count() // block))
    state = docs.select(
        "doc_id", F.col("text").alias("__text"), F.lit(0).cast("long").alias("__n_words"),
        F.lit(None).cast("array<int>").alias("__hits"), F.lit(None).cast("array<string>").alias("__items"),
    )
    for b in range(blocks):
        part = windows.where(F.pmod(F.col("win"), F.lit(blocks)) == b)  # a window's rows are all in one block
        scan = scanner(state, Index(part.toArrow()))
        if b + 1 < blocks:
            state = stored(state.mapInArrow(scan, state.schema), "contamination")

    # The last block's scan and the sums are one function: a task has one worker, and texts do not come back from it.
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in scan(batches):
            n_words, all_hits, all_items = (batch.column(k).to_pylist() for k in ("__n_words", "__hits", "__items"))
            n_hit, lists = [], []
            for n, hits, items in zip(n_words, all_hits, all_items, strict=True):
                if not hits:
                    n_hit.append(0)
                    lists.append([])
                    continue
                pairs = np.array(hits, np.int64).reshape(-1, 2)
                edge = np.zeros(n + 1, np.int64)
                np.add.at(edge, pairs[:, 0], 1)
                np.add.at(edge, pairs[:, 0] + pairs[:, 1], -1)
                n_hit.append(int((np.cumsum(edge)[:n] > 0).sum()))
                lists.append(sorted(set(items or [])))
            yield arrow_rows(
                doc_id=batch.column("doc_id"), n_words=batch.column("__n_words"), n_hit=(n_hit, pa.int64()),
                n_items=([len(x) for x in lists], pa.int64()), items=(lists, pa.list_(pa.string())),
                items_sha256=([hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists], pa.string()),
                contaminated=([x > 0 for x in n_hit], pa.bool_()),
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return state.mapInArrow(
        run, f"doc_id {kind}, n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean"
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark window, with all their columns.

    What a text holds decides, so rows without an id, or that share one, are judged each by their own text.
    """
    named = docs.withColumn("__name", text_name())
    found = contamination(named.select(F.col("__name").alias("doc_id"), "text"), benchmark).where("contaminated")
    dropped = stored(found.select(F.col("doc_id").alias("__name")).distinct(), "contaminated")
    return named.join(dropped, "__name", "left_anti").select(*docs.columns)
