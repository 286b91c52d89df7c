"""Substring dedup with repeated-phrase automata: passages of ``N`` words that occur again anywhere go, all copies alike.

Words are runs of bytes other than ASCII blanks. A window is ``N`` consecutive words of one document; every word that a
window covers goes if the same words start at any other place, in the same document too.

1. Candidates: every window marks the least ``K``-word phrase in it (the first of equal ones). Windows in a row that mark the
   same place are one stretch. Equal windows mark equal phrases at equal distance, so only stretches
   whose phrase is marked at another place as well can hold a repeated window. Phrases are counted by hash with
   map-side combine, and joined back; the few very common ones are sent to where the stretches are.
2. Equal texts are one from here on; all windows of a text that has copies are repeated.
3. Shards: the words of each candidate stretch go to the shard of its phrase. A phrase with more than ``HOT`` stretches
   has shards of its own, by place; which of its windows occur in several of them is counted by window hash first.
4. Automata: a shard numbers its words exactly, confirms the windows that recur, compiles one Aho-Corasick automaton of them
   (pyahocorasick, over word numbers) and streams all its stretches through it, which locates every occurrence.
   A pattern that is located once and not reported by another shard is no repeat.
5. The located spans return to the documents by the text's name.

Texts are named by 64 bits of hash and their length; two different texts of one length would have to share a
hash to be confused. A shard holds at most about ``SHARD`` stretches of at most ``2 N`` words, whatever the input.

Cases: a NULL text is an empty one; texts of fewer than ``N`` words lose nothing; repeated rows are copies of one another;
a NULL doc_id passes through; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.counting import grouped
from tidemark.llm.support import NOT_SPACE, Rolling, arrow_rows, column_bytes, fold, ship, spans, stored, text_slices

N, K = 35, 6
#: Stretches of a phrase from which it has shards of its own, and stretches of a shard.
HOT, SHARD = 2_000, 2_000
#: Share of all stretches, as one in so many, from which a phrase counts as common.
_COMMON = 10_000


def least_phrases(h: np.ndarray, first: np.ndarray, n: int = N, k: int = K) -> tuple[np.ndarray, ...]:
    """Stretches of a slice: phrase hash, document, first window (word number in the document), windows."""
    g = fold(h, k)
    width = n - k + 1
    size = np.diff(first)
    if not len(size) or int(size.max(initial=0)) < n:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none
    # The least phrase of every window, by windows of doubling length; the first of equal ones.
    place, span = np.arange(len(g)), 1
    while span < width:
        step = min(span, width - span)
        a, b = place[: len(place) - step], place[step:]
        place = np.where(g[b] < g[a], b, a)
        span += step
    count = np.maximum(size - n + 1, 0)
    start = np.repeat(first[:-1] - np.cumsum(count) + count, count) + np.arange(count.sum())
    owner = np.repeat(np.arange(len(size)), count)
    marked = place[start]
    new = np.ones(len(start), bool)
    new[1:] = (marked[1:] != marked[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return g[marked[at]], owner[at], start[at] - first[owner[at]], np.diff(np.append(at, len(start)))


def named(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the name of the text: key and size."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return rows.withColumns({"key": F.xxhash64("text"), "size": F.octet_length("text")})


def stretches(rows: DataFrame) -> DataFrame:
    """Every stretch: phrase, key, size, start (first window), windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, size = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for i, _, data, offsets in text_slices(batch):
                starts, ends, first = spans(data, offsets, NOT_SPACE)
                phrase, owner, start, windows = least_phrases(Rolling(data).ranges(starts, ends), first)
                if len(phrase):
                    yield arrow_rows(phrase=phrase.view(np.int64), key=key[i + owner], size=size[i + owner],
                                     start=start.astype(np.int32), windows=windows.astype(np.int32))

    return rows.select("text", "key", "size").mapInArrow(run, "phrase long, key long, size int, start int, windows int")


def marks(rows: DataFrame, hot: int = HOT) -> tuple[DataFrame, int]:
    """Candidate stretches of each text, (key, size, spots), and the number of stretches.

    A spot is (start, windows, part, salt): where the stretch goes. Salt 0 is a shard of many phrases.
    """
    found = stored(stretches(rows), "stretches")
    place = F.xxhash64("key", "size", "start")
    # Copies of a text mark the same place of it: they alone make no phrase a candidate.
    uses = found.groupBy("phrase").agg(F.min(place).alias("one"), F.max(place).alias("other"), F.count(F.lit(1)).alias("uses"))
    uses = stored(uses.where("one <> other").select("phrase", "uses"), "phrases")
    spread = F.pmod(place, F.ceil(F.col("uses") / hot)) + 1
    spot = F.struct(
        "start", "windows", F.col("phrase").alias("part"), F.when(F.col("uses") > hot, spread).otherwise(F.lit(0)).cast("int").alias("salt")
    )
    # A phrase with more than a ten-thousandth of all stretches would make one task of the join: there are fewer than
    # ten thousand of them, and they are sent to the stretches instead.
    share = found.count() // _COMMON + 1
    common = F.broadcast(uses.where(F.col("uses") > share))
    rest = found.join(common.select("phrase"), "phrase", "left_anti").join(uses.where(F.col("uses") <= share), "phrase")
    joined = found.join(common, "phrase").unionByName(rest)
    marked = joined.groupBy("key", "size").agg(F.collect_set(spot).alias("spots"))
    marked = stored(marked, "marks")
    total = marked.agg(F.sum(F.size("spots")).alias("n")).first().n or 0
    return marked, total


def candidates(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """key, size, text, spots: one text of each name that has marks."""
    texts = rows.groupBy("key", "size").agg(F.first("text").alias("text"))
    return texts.join(marked, ["key", "size"]).select("key", "size", "text", "spots")


def regions(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """The words of every candidate stretch of texts with spots: part, salt, key, size, start, words."""
    for batch in batches:
        spots, at = batch.column(3).flatten(), batch.column(3).offsets.to_numpy()
        start, windows, part, salt = (c.to_numpy(zero_copy_only=False) for c in spots.flatten())
        at = at - at[0]
        key, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for i, j, data, offsets in text_slices(batch):
            begin, end, first = spans(data, offsets, NOT_SPACE)
            mine = np.arange(at[i], at[j])
            owner = np.repeat(np.arange(i, j), np.diff(at[i : j + 1]))
            word = first[owner - i] + start[mine]
            last = word + windows[mine] + N - 2
            raw = data.tobytes()
            text = [b" ".join(raw[a:e].split()) for a, e in zip(begin[word].tolist(), end[last].tolist(), strict=True)]
            shard = np.where(salt[mine] == 0, part[mine] % shards, part[mine])
            yield arrow_rows(part=shard, salt=salt[mine], key=key[owner], size=size[owner], start=start[mine], words=(text, pa.binary()))


_REGION = "part long, salt int, key long, size int, start int, words binary"


def window_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every window of the stretches, its stretch, its first word, and each stretch's first word."""
    starts, ends, first = spans(data, offsets, NOT_SPACE)
    g = fold(Rolling(data).ranges(starts, ends), N)
    count = np.diff(first) - N + 1
    at = np.repeat(first[:-1] - np.cumsum(count) + count, count) + np.arange(count.sum())
    return g[at], np.repeat(np.arange(len(count)), count), at, first


def across_shards(texts: DataFrame) -> DataFrame:
    """(part, salt, windows): of the phrases with several shards, the windows that occur again in another one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in regions(batches, 1):
            part, salt = (batch.column(c).to_numpy() for c in (0, 1))
            window, owner, _, _ = window_hashes(*column_bytes(batch.column(5)))
            order = np.lexsort((window, salt[owner], part[owner]))
            w, p, s = window[order], part[owner][order], salt[owner][order]
            new = np.ones(len(w), bool)
            new[1:] = (w[1:] != w[:-1]) | (p[1:] != p[:-1]) | (s[1:] != s[:-1])
            at = np.flatnonzero(new)
            yield arrow_rows(part=p[at], salt=s[at], window=w[at].view(np.int64))

    sent = texts.mapInArrow(run, "part long, salt int, window long")
    seen = stored(sent.groupBy("part", "salt", "window").agg(F.count(F.lit(1)).alias("n")).drop("n"), "windows")
    again = seen.groupBy("part", "window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return seen.join(again, ["part", "window"]).groupBy("part", "salt").agg(F.collect_list("window").alias("windows"))


def located(words: pa.Array, reported: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(stretch, first word, end) of the runs of repeated windows, by an automaton of the shard's repeated windows."""
    data, offsets = column_bytes(words)
    window, owner, at, first = window_hashes(data, offsets)
    _, where, counts = np.unique(window, return_index=True, return_counts=True)
    elsewhere = np.isin(window[where], reported)
    where, elsewhere = where[(counts > 1) | elsewhere], elsewhere[(counts > 1) | elsewhere]
    if not len(where):
        return
    # Word numbers are exact: equal numbers are equal words.
    starts, ends, _ = spans(data, offsets, NOT_SPACE)
    raw = data.tobytes()
    numbers: dict[bytes, int] = {}
    ids = [numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for pattern, word in enumerate(at[where].tolist()):
        automaton.add_word(tuple(ids[word : word + N]), pattern)
    automaton.make_automaton()
    hits_at, hits = [], []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        for end, pattern in automaton.iter(tuple(ids[a:b])):
            hits_at.append(a + end - N + 1)
            hits.append(pattern)
    place, pattern = np.array(hits_at, np.int64), np.array(hits, np.int64)
    uses = np.bincount(pattern, minlength=len(where))
    place = np.sort(place[(uses[pattern] > 1) | elsewhere[pattern]])
    owner = np.searchsorted(first, place, side="right") - 1
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] > place[:-1] + N) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(new)
    for a, b in zip(heads.tolist(), [*(heads[1:] - 1).tolist(), len(place) - 1], strict=True):
        o = int(owner[a])
        yield o, int(place[a] - first[o]), int(place[b] - first[o]) + N


def spans_of(found: DataFrame, reported: DataFrame) -> DataFrame:
    """(key, size, spans): the words of each text that repeated windows cover, as (first, end), from all shards."""

    def locate(found: pa.Table, reported: pa.Table) -> pa.Table:
        if not found.num_rows:
            return pa.table({"key": pa.array([], pa.int64()), "size": pa.array([], pa.int32()), "first": pa.array([], pa.int32()), "end": pa.array([], pa.int32())})
        others = [v for r in reported.column("windows").to_pylist() for v in r]
        spans_ = list(located(found.column("words").combine_chunks(), np.array(others, np.int64).view(np.uint64)))
        o = np.array([s[0] for s in spans_], np.int64)
        start = found.column("start").to_numpy()[o]
        return pa.table({
            "key": found.column("key").to_numpy()[o], "size": found.column("size").to_numpy()[o],
            "first": (start + np.array([s[1] for s in spans_], np.int64)).astype(np.int32),
            "end": (start + np.array([s[2] for s in spans_], np.int64)).astype(np.int32),
        })

    both = found.groupBy("part", "salt").cogroup(reported.groupBy("part", "salt"))
    hits = both.applyInArrow(locate, "key long, size int, first int, end int")
    return hits.groupBy("key", "size").agg(F.collect_list(F.struct("first", "end")).alias("spans"))


def without(rows: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (text) of ``rows(doc_id, text, copied, spans)``."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", "text", "copied", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copied, found = batch.column(2).to_pylist(), batch.column(3)
            n_words, n_removed, kept = [], [], []
            for i, j, data, offsets in text_slices(batch):
                starts, ends, first = spans(data, offsets, NOT_SPACE)
                raw = data.tobytes()
                for d in range(j - i):
                    a, b = int(first[d]), int(first[d + 1])
                    n_words.append(b - a)
                    cover = found[i + d].as_py()
                    if copied[i + d] and b - a >= N:
                        gone = np.ones(b - a, bool)
                    elif cover:
                        edge = np.zeros(b - a + 1, np.int64)
                        np.add.at(edge, [c["first"] for c in cover], 1)
                        np.add.at(edge, [c["end"] for c in cover], -1)
                        gone = np.cumsum(edge)[:-1] > 0
                    else:
                        n_removed.append(0)
                        kept.append(b" ".join(raw[offsets[d] : offsets[d + 1]].split()))
                        continue
                    n_removed.append(int(gone.sum()))
                    stay = np.flatnonzero(~gone) + a
                    kept.append(b" ".join([raw[s:e] for s, e in zip(starts[stay].tolist(), ends[stay].tolist(), strict=True)]))
            yield arrow_rows(
                doc_id=batch.column(0), n_words=(n_words, pa.int64()), n_removed=(n_removed, pa.int64()),
                kept_sha256=([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), kept=(kept, pa.binary()),
            )

    out = rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))


def drop_phrases(docs: DataFrame, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256, and the kept words joined by blanks."""
    ship(docs.sparkSession)
    rows = named(docs)
    marked, total = marks(rows, hot)
    shards = max(1, -(-total // shard))
    several = marked.withColumn("spots", F.filter("spots", lambda s: s["salt"] > 0)).where(F.size("spots") > 0)
    reported = stored(across_shards(candidates(rows, several)), "reported")
    cut = candidates(rows, marked).mapInArrow(lambda batches: regions(batches, shards), _REGION)
    found = stored(spans_of(cut, reported), "spans")
    copies = rows.select("key", "size").groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    names = stored(
        found.join(copies, ["key", "size"], "full").select("key", "size", F.col("n").isNotNull().alias("copied"), "spans"), "names"
    )
    return without(rows.join(names, ["key", "size"], "left").withColumn("copied", F.coalesce("copied", F.lit(False))))


def oracle_sql(n: int = N) -> str:
    return f"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
s AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + {n - 1}], ' ')) AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM d)
),
r AS (SELECT w FROM s GROUP BY w HAVING count(*) > 1),
h AS (SELECT doc_id, i FROM s SEMI JOIN r USING (w)),
p AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM d),
c AS (
  SELECT p.doc_id, p.i, p.word, max(CASE WHEN h.i IS NULL THEN 0 ELSE 1 END) OVER (
    PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM p LEFT JOIN h ON p.doc_id = h.doc_id AND p.i = h.i
),
k AS (
  SELECT doc_id, count(*) AS n_words, sum(gone)::BIGINT AS n_removed,
         string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept
  FROM c GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
