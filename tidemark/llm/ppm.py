"""Prediction by partial matching over bytes, pretrained on the corpus or adaptive within a document.

The model is a trie of byte contexts up to ``ORDER`` bytes with counts. A byte is coded at the longest context
that the training texts have; an unseen byte escapes to the next shorter one, where the bytes already seen in the
longer context are excluded. The escape has the weight of the number of distinct bytes there (method C). Below the
empty context every byte not excluded is equally likely. 0xFF, which UTF-8 never uses, ends a text,
and 0xFE fills the contexts of its first bytes.

With a trained trie the code length of a byte depends on its (ORDER + 1)-gram alone. So the trie's statistics are
tables: tasks count distinct grams, Spark adds them up, and a join and a window per order turn counts into the code
length of every distinct gram of the corpus, shorter contexts first. Scoring looks grams up: the most frequent
ones, at most ``HEAD``, are sent to all tasks; the rest of each document's grams (the rare ones, however many
there are) are joined through a shuffle and added. Word counts for the base score go the same way.

Cases: a NULL text is an empty one: one end. Repeated rows are scored each. Without training texts the model is
uniform and the base score 0. A NULL id is never held out. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from math import log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.support import NOT_SPACE, SLICE, Rolling, arrow_rows, lower, remainder, ship, spans, stored, text_slices

ORDER = 5
#: Most grams, and most words, that every task receives (16 bytes each).
HEAD = 1 << 20
PAD, STOP = 0xFE, 0xFF
SYMBOLS = 256
#: The end of a text among the words' hashes.
END_WORD = np.uint64(1)
_GRAM, _WORD = 0, 1


def grams(data: np.ndarray, offsets: np.ndarray, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte and end of a slice's documents, and where each document's begin."""
    m = len(offsets) - 1
    sizes = np.diff(offsets)
    text = np.full(len(data) + m * (order + 1), PAD, np.uint8)
    text[np.arange(len(data)) + np.repeat(np.arange(m) * (order + 1) + order, sizes)] = data
    ends = offsets[1:] + np.arange(1, m + 1) * (order + 1) - 1
    text[ends] = STOP
    n = len(text) - order
    gram = np.zeros(max(n, 0), np.uint64)
    for k in range(order + 1):
        gram = (gram << np.uint64(8)) | text[k : k + n]
    real = np.ones(len(gram), bool)
    for k in range(1, order + 1):  # windows that end in the next document's padding
        real[(ends[:-1] + k - order)] = False
    return gram[real], offsets + np.arange(m + 1)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and ends, and where each document's begin."""
    data = lower(data)
    starts, ends, first = spans(data, offsets, NOT_SPACE)
    h = Rolling(data).ranges(starts, ends)
    m = len(offsets) - 1
    out = np.full(len(h) + m, END_WORD, np.uint64)
    out[np.arange(len(h)) + np.repeat(np.arange(m), np.diff(first))] = h
    return out, first + np.arange(m + 1)


class Counter:
    """Distinct values and their numbers, merged now and then."""

    def __init__(self):
        self.values, self.counts, self.waiting, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

    def add(self, values: np.ndarray) -> None:
        values = np.sort(values)
        first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
        self.waiting.append((values[first], np.diff(first, append=len(values))))
        self.size += len(first)
        if self.size > max(1 << 20, len(self.values)):
            self.merge()

    def merge(self) -> None:
        values = np.concatenate([self.values, *[v for v, _ in self.waiting]])
        counts = np.concatenate([self.counts, *[c for _, c in self.waiting]])
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.zeros(0, np.int64)
        self.values, self.counts = values[first], np.add.reduceat(counts, first) if len(first) else counts
        self.waiting, self.size = [], 0


def counted(docs: DataFrame, order: int) -> DataFrame:
    """kind, key, n (training), for all grams of the corpus and all training words; ``docs(text, held_out)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = defaultdict(Counter)
        for batch in batches:
            held = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, offsets in text_slices(batch):
                out = held[i:j]
                g, at = grams(data, offsets, order)
                mask = np.repeat(out, np.diff(at))
                tables[_GRAM, False].add(g[~mask])
                tables[_GRAM, True].add(g[mask])
                w, at = words(data, offsets)
                tables[_WORD, False].add(w[~np.repeat(out, np.diff(at))])
        for (kind, out), table in tables.items():
            table.merge()
            for a in range(0, len(table.values), 1 << 18):
                v, c = table.values[a : a + (1 << 18)], table.counts[a : a + (1 << 18)]
                yield arrow_rows(kind=np.full(len(v), kind, np.int32), key=v.view(np.int64), n=np.zeros(len(v), np.int64) if out else c)

    sent = docs.select("text", "held_out").mapInArrow(run, "kind int, key long, n long")
    return sent.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def code_lengths(table: DataFrame, order: int) -> DataFrame:
    """``(g, score)``: log10 of the trie's probability of every gram's last byte; ``table(g, n)``."""
    levels = [table]
    for k in range(order - 1, -1, -1):
        mask = (1 << (8 * (k + 1))) - 1
        shorter = levels[0].groupBy(F.col("g").bitwiseAND(F.lit(mask)).alias("g")).agg(F.sum("n").alias("n"))
        levels.insert(0, stored(shorter, f"grams-{k}"))
    known = None  # of the order below: g, n, low, full, total, kinds
    for k, level in enumerate(levels):
        rows = level.withColumn("ctx", F.shiftright("g", 8)).withColumn("byte", F.col("g").bitwiseAND(F.lit(255)))
        seen = F.col("n") > 0
        if known is None:
            rows = rows.withColumns({"n_": F.lit(0).cast("long"), "low_": F.lit(0.0), "full_": F.lit(-log10(SYMBOLS)), "total_": F.lit(0).cast("long"), "kinds_": F.lit(0).cast("long")})
        else:
            below = known.select(F.col("g").alias("s"), *[F.col(c).alias(c + "_") for c in ("n", "low", "full", "total", "kinds")])
            mask = (1 << (8 * k)) - 1
            rows = rows.withColumn("s", F.col("g").bitwiseAND(F.lit(mask))).join(below, "s").drop("s")
        # At most 256 rows of a context; at order 0 there is one context, of at most 256 rows.
        same = Window.partitionBy("ctx")
        rows = rows.withColumns({
            "total": F.sum("n").over(same),
            "kinds": F.sum(F.when(seen, 1).otherwise(0)).over(same),
            "taken": F.sum(F.when(seen, F.col("n_")).otherwise(0)).over(same),
        })
        # One order down, without the bytes seen here.
        left, kinds_left = F.col("total_") - F.col("taken"), F.col("kinds_") - F.col("kinds")
        escape = F.when(kinds_left > 0, F.log10(kinds_left / (left + kinds_left))).otherwise(F.lit(0.0))
        low = (
            -F.log10(F.greatest(F.lit(SYMBOLS) - F.col("kinds"), F.lit(1))) if known is None
            else F.when(F.col("n_") > 0, F.log10(F.col("n_") / (left + kinds_left))).otherwise(escape + F.col("low_"))
        )
        rows = rows.withColumn("low", F.when(seen, F.lit(0.0)).otherwise(low))
        here = F.col("total") + F.col("kinds")
        full = (
            F.when(F.col("total") == 0, F.col("full_"))
            .when(seen, F.log10(F.col("n") / here))
            .otherwise(F.log10(F.col("kinds") / here) + F.col("low"))
        )
        known = stored(rows.withColumn("full", full).select("g", "n", "low", "full", "total", "kinds"), f"codes-{k}")
    return known.select("g", F.col("full").alias("score"))


def frequent(table: DataFrame, value: str, head: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys used most, at most ``head``, sorted, with their values."""
    sizes = table.groupBy(F.floor(F.log2(F.greatest("used", F.lit(1))) * 8).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    level, total = None, 0
    for row in sorted(sizes, key=lambda r: -r.level):
        total += row.n
        if total > head:
            break
        level = row.level
    if level is None:
        return np.zeros(0, np.uint64), np.zeros(0)
    rows = table.where(F.floor(F.log2(F.greatest("used", F.lit(1))) * 8).cast("int") >= level).select("key", value).toArrow()
    key, values = rows.column(0).to_numpy().view(np.uint64), rows.column(1).to_numpy()
    order = np.argsort(key)
    return key[order], values[order].astype(np.float64)


def look_up(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of keys (0 where unknown) and whether they are known."""
    if not len(known) or not len(keys):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    order = np.argsort(keys)
    first = np.flatnonzero(np.concatenate(([True], keys[order][1:] != keys[order][:-1])))
    own = keys[order[first]]
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    hit = known[at] == own
    size = np.diff(first, append=len(keys))
    out, found = np.empty(len(keys)), np.empty(len(keys), bool)
    out[order] = np.repeat(np.where(hit, values[at], 0.0), size)
    found[order] = np.repeat(hit, size)
    return out, found


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[at[1:]] - total[at[:-1]]


def scored(docs: DataFrame, modulus: int = 7, held: int = 2, order: int = ORDER, head: int = HEAD) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text", F.coalesce(remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"))
    counts = stored(counted(docs, order), "ppm-counts")
    lengths = code_lengths(counts.where(F.col("kind") == _GRAM).select(F.col("key").alias("g"), "n"), order)
    gram_table = counts.where(F.col("kind") == _GRAM).select("key", F.col("n").alias("used")).join(lengths.withColumnRenamed("g", "key"), "key")
    word_table = counts.where(F.col("kind") == _WORD).select("key", F.col("n").alias("used"), F.log10(F.col("n") + 1).alias("score"))
    table = stored(
        gram_table.select(F.lit(_GRAM).alias("kind"), "key", "used", "score").unionAll(word_table.select(F.lit(_WORD).alias("kind"), "key", "used", "score")),
        "ppm-model",
    )
    totals = table.where(F.col("kind") == _WORD).agg(F.sum("used").alias("n"), F.count(F.lit(1)).alias("v")).first()
    train_tokens, vocabulary = totals.n or 0, totals.v
    heads = [frequent(table.where(F.col("kind") == k), "score", head) for k in (_GRAM, _WORD)]
    sent = docs.sparkSession.sparkContext.broadcast(heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, row = sent.value, TaskContext.get().partitionId() << 40
        for batch in batches:
            n = batch.num_rows
            tokens, known, base, score = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            r_row, r_kind, r_key, r_n = [], [], [], []
            for i, j, data, offsets in text_slices(batch, "text", SLICE):
                for kind, (keys, at) in enumerate((grams(data, offsets, order), words(data, offsets))):
                    values, found = look_up(keys, *heads[kind])
                    sums = _sums(values, at)
                    if kind == _GRAM:
                        score[i:j] = sums
                    else:
                        base[i:j] = sums
                        tokens[i:j] = np.diff(at)
                        known[i:j] = _sums(found, at)
                    rest = np.flatnonzero(~found)
                    doc = np.searchsorted(at, rest, side="right") - 1
                    pairs = np.lexsort((keys[rest], doc))
                    d, k = doc[pairs], keys[rest][pairs]
                    first = np.flatnonzero(np.concatenate(([True], (d[1:] != d[:-1]) | (k[1:] != k[:-1])))) if len(d) else pairs
                    r_row.append(row + i + d[first])
                    r_kind.append(np.full(len(first), kind, np.int32))
                    r_key.append(k[first].view(np.int64))
                    r_n.append(np.diff(first, append=len(d)))
            rows, m = np.arange(row, row + n), sum(map(len, r_row))
            row += n
            ids, held = batch.column(0), batch.column(2)
            none = np.zeros(m)
            yield arrow_rows(
                row=np.concatenate([rows, *r_row]), kind=np.concatenate([np.full(n, -1, np.int32), *r_kind]),
                key=np.concatenate([np.zeros(n, np.int64), *r_key]), n=np.concatenate([tokens, *r_n]),
                doc_id=pa.concat_arrays([ids, pa.nulls(m, ids.type)]), held_out=pa.concat_arrays([held, pa.nulls(m, held.type)]),
                known=np.concatenate([known, none.astype(np.int64)]), base=np.concatenate([base, none]), score=np.concatenate([score, none]),
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    parts = stored(
        docs.mapInArrow(run, f"row long, kind int, key long, n long, doc_id {kind}, held_out boolean, known long, base double, score double"),
        "ppm-parts",
    )
    rest = (
        parts.where("kind >= 0").select("row", "kind", "key", "n").join(table.withColumnRenamed("score", "value"), ["kind", "key"])
        .groupBy("row").agg(
            F.sum(F.when(F.col("kind") == _GRAM, F.col("n") * F.col("value")).otherwise(0.0)).alias("gram_rest"),
            F.sum(F.when(F.col("kind") == _WORD, F.col("n") * F.col("value")).otherwise(0.0)).alias("word_rest"),
            F.sum(F.when(F.col("kind") == _WORD, F.col("n")).otherwise(0)).alias("known_rest"),
        )
    )
    log_all = log10(train_tokens + vocabulary + 1)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return parts.where("kind < 0").join(rest, "row", "left").select(
        "doc_id", "held_out", F.col("n").alias("n_tokens"), (F.col("known") + zero("known_rest")).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("word_rest") - F.col("n") * F.lit(log_all)).alias("base_score"),
        (F.col("score") + zero("gram_rest")).alias("score"),
    )


# --- adaptive ------------------------------------------------------------------------------


class Trie:
    """The same coder, learning from what it has coded: a small trie in one task."""

    def __init__(self, order: int = ORDER):
        self.order, self.counts = order, defaultdict(dict)

    def code(self, context: bytes, byte: int) -> float:
        """log10 of the probability of the byte after the context."""
        out, excluded = 0.0, set()
        for k in range(self.order, -1, -1):
            seen = self.counts.get(context[len(context) - k :])
            if not seen:
                continue
            free = {b: n for b, n in seen.items() if b not in excluded}
            if free:
                whole = sum(free.values()) + len(free)
                if byte in free:
                    return out + log10(free[byte] / whole)
                out += log10(len(free) / whole)
            excluded |= seen.keys()
        return out - log10(max(SYMBOLS - len(excluded), 1))

    def learn(self, context: bytes, byte: int) -> None:
        for k in range(self.order + 1):
            seen = self.counts[context[len(context) - k :]]
            seen[byte] = seen.get(byte, 0) + 1

    def text(self, raw: bytes, learning: bool) -> float:
        stream = bytes([PAD]) * self.order + raw + bytes([STOP])
        total = 0.0
        for i in range(self.order, len(stream)):
            context = stream[i - self.order : i]
            total += self.code(context, stream[i])
            if learning:
                self.learn(context, stream[i])
        return total


def adaptive(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id and score of texts by a trie that starts empty with each of them."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [Trie(order).text(data.tobytes(), True) for _, _, data, _ in text_slices(batch, "text", 1)]
            yield arrow_rows(doc_id=batch.column(0), score=(scores, pa.float64()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
