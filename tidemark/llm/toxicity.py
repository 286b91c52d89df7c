"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the vectors of its byte n-grams (3 to 5, with word borders) and of itself; a
span of ``SPAN`` words is the mean of its words; a softmax layer turns it into two probabilities.
Toxic words are a few in a long text, so a document's score is that of its worst span. Training
knows labels of documents only: after a first fit on all spans, the spans of toxic documents
that stand out are kept as examples, and the fit goes on with those and the clean documents'
spans. Misspellings that were never seen share n-grams with words that were.

Scoring is one pass without a shuffle. Since the layers are linear, the vectors are first folded
into one number per n-gram bucket; that array (``2**BITS`` floats) is what tasks receive.

Cases: a NULL text is an empty one; a text without words is scored by the bias alone. Repeated
documents get equal scores. Without labels of both kinds every document gets the share of the kind there is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.quality import gathered, sample
from tidemark.llm.support import SLICE, Rolling, arrow_rows, byte_table, give_back, lower, mix, remainder, ship, text_slices

BITS, DIM, SPAN = 17, 16, 4
#: Most labelled documents of each kind that the model is fitted on (the first by a hash of their id).
FIT_ROWS = 1000
#: Spans of clean documents used in each later round of the fit.
FIT_SPANS = 30_000

#: Letters, digits, bytes above 0x7F, and signs that stand for letters.
INSIDE = byte_table(bytes(b for b in range(128) if not chr(b).isalnum() and chr(b) not in "@$*"))


@dataclass
class Model:
    vectors: np.ndarray  # bucket x DIM
    layer: np.ndarray  # DIM x 2
    bias: np.ndarray  # 2

    def folded(self) -> tuple[np.ndarray, float]:
        """The difference of the two logits: one number per bucket, and a constant."""
        return (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def subwords(data: np.ndarray, offsets: np.ndarray):
    """Words of a slice and the buckets of their n-grams.

    Gives each document's first word, the number of words, and (word, bucket) pairs in no order.
    """
    n, m = len(data), len(offsets) - 1
    text = np.full(n + m + 1, 32, np.uint8)  # a blank before, between and after documents
    place = np.arange(n) + np.repeat(np.arange(1, m + 1), np.diff(offsets))
    text[place] = data
    text = lower(text)
    inside = INSIDE[text]
    text[~inside] = 32
    step = np.diff(inside.astype(np.int8))
    starts, ends = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
    first = np.searchsorted(starts, offsets + np.arange(m + 1), side="left")
    word_of = np.cumsum(np.concatenate(([0], step == 1))) - 1  # at a word's bytes: its number
    words, buckets = [np.arange(len(starts))], [(Rolling(text).ranges(starts, ends) >> np.uint64(64 - BITS)).astype(np.int32)]
    gram = text.astype(np.uint64)
    clear = inside.copy()  # no blank at positions 1 .. size - 2 of the window
    for size in range(2, 6):
        gram = (gram[:-1] << np.uint64(8)) | text[size - 1 :]
        if size > 3:
            clear = clear[:-1] & inside[size - 3 : len(clear) + size - 4]
        if size >= 3 and len(gram):
            # clear[i] speaks of positions i .. i + size - 3; a window begins one before.
            at = np.flatnonzero(clear[1 : len(gram) + 1])
            words.append(word_of[at + 1])
            buckets.append((mix(gram[at] + np.uint64(size << 56)) >> np.uint64(64 - BITS)).astype(np.int32))
    return first, len(starts), np.concatenate(words), np.concatenate(buckets)


def word_scores(folded: np.ndarray, words: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
    count = np.bincount(words, minlength=n)
    return np.bincount(words, weights=folded[buckets], minlength=n) / np.maximum(count, 1)


def worst_spans(scores: np.ndarray, first: np.ndarray, bias: float) -> np.ndarray:
    """Each document's largest span logit."""
    m = len(first) - 1
    out = np.full(m, bias)
    if not len(scores):
        return out
    number = np.arange(len(scores)) - np.repeat(first[:-1], np.diff(first))
    begins = np.flatnonzero(number % SPAN == 0)
    size = np.diff(np.append(begins, len(scores)))
    logits = np.add.reduceat(scores, begins) / size + bias
    owner = np.repeat(np.arange(m), np.diff(first))[begins]
    best = np.full(m, -np.inf)
    np.maximum.at(best, owner, logits)
    return np.where(np.isfinite(best), best, out)


def fit(texts: list[np.ndarray], labels: np.ndarray, rounds: int = 4) -> Model:
    """Adagrad on batches of spans; every round the toxic documents' examples are chosen anew."""
    rng = np.random.default_rng(11)
    # Distinct words, each with its buckets; documents as numbers of words.
    seen: dict[bytes, int] = {}
    docs = []
    for t in texts:
        clean = lower(t).copy()
        clean[~INSIDE[clean]] = 32
        docs.append(np.array([seen.setdefault(w, len(seen)) for w in clean.tobytes().split()], np.int32))
    joined = b"".join(w for w in seen)
    sizes = np.concatenate(([0], np.cumsum([len(w) for w in seen], dtype=np.int64))).astype(np.int64)
    _, n, words, buckets = subwords(np.frombuffer(joined, np.uint8), sizes)
    order = np.argsort(words, kind="stable")
    bag = buckets[order]
    bag_at = np.concatenate(([0], np.cumsum(np.bincount(words, minlength=n))))

    vectors = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    layer = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    g_vec, g_lay, g_bias = np.full(1 << BITS, 1e-6, np.float32), np.full((DIM, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)

    def cut(d):
        return [d[i : i + SPAN] for i in range(0, len(d), SPAN)]

    def epoch(items: list[np.ndarray], y: np.ndarray, rate: float):
        nonlocal bias
        for part in np.array_split(rng.permutation(len(items)), max(1, len(items) // 1024)):
            size = np.array([len(items[i]) for i in part])
            word, back = np.unique(np.concatenate([items[i] for i in part]), return_inverse=True)
            lens = bag_at[word + 1] - bag_at[word]
            take = np.repeat(bag_at[word] - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(lens.sum())
            b = bag[take]
            begin = np.concatenate(([0], np.cumsum(lens)[:-1]))
            word_vec = np.add.reduceat(vectors[b], begin, axis=0) / lens[:, None]
            at = np.concatenate(([0], np.cumsum(size)[:-1]))
            vec = np.add.reduceat(word_vec[back], at, axis=0) / size[:, None]
            logit = vec @ layer + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            target = y[part]
            weight = np.where(target == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
            delta = p
            delta[np.arange(len(part)), target] -= 1
            delta *= (weight / len(part))[:, None]
            d_layer, d_bias = vec.T @ delta, delta.sum(0)
            d_vec = (delta @ layer.T) / size[:, None]
            d_word = np.zeros((len(word), DIM), np.float32)
            np.add.at(d_word, back, np.repeat(d_vec, size, axis=0))
            d_sub = np.repeat(d_word / lens[:, None], lens, axis=0)
            order = np.argsort(b, kind="stable")
            runs = np.flatnonzero(np.concatenate(([True], b[order][1:] != b[order][:-1])))
            ids, grad = b[order][runs], np.add.reduceat(d_sub[order], runs, axis=0)
            g_vec[ids] += (grad * grad).mean(1)
            vectors[ids] -= rate * grad / np.sqrt(g_vec[ids])[:, None]
            g_lay[:] += d_layer * d_layer
            layer[:] -= rate * d_layer / np.sqrt(g_lay)
            g_bias[:] += d_bias * d_bias
            bias -= rate * d_bias / np.sqrt(g_bias)

    toxic = [cut(docs[i]) for i in np.flatnonzero(labels == 1) if len(docs[i])]
    clean = [s for i in np.flatnonzero(labels == 0) for s in cut(docs[i])]
    if not toxic or not clean:
        return Model(vectors, layer, bias)

    def logits(items):
        f, c = Model(vectors, layer, bias).folded()
        per = np.add.reduceat(f[bag], bag_at[:-1]) / np.diff(bag_at)
        size = np.array([len(s) for s in items])
        return np.add.reduceat(per[np.concatenate(items)], np.concatenate(([0], np.cumsum(size)[:-1]))) / size + c

    everything = [s for d in toxic for s in d]
    some = [clean[i] for i in rng.permutation(len(clean))[: len(everything)]]
    epoch(everything + some, np.concatenate((np.ones(len(everything), np.int64), np.zeros(len(some), np.int64))), 0.1)
    edges = np.concatenate(([0], np.cumsum([len(d) for d in toxic])))
    for r in range(rounds):
        got = logits(everything)
        picked = [int(edges[i] + np.argmax(got[edges[i] : edges[i + 1]])) for i in range(len(toxic))]
        if r:  # more than one span of a document may be plainly toxic
            picked = sorted({*picked, *np.flatnonzero(got > 2).tolist()})
        hard = np.argsort(-logits(clean))[: FIT_SPANS // 4]
        chosen = np.unique(np.concatenate((hard, rng.permutation(len(clean))[: FIT_SPANS * 3 // 4])))
        items = [everything[i] for i in picked] + [clean[i] for i in chosen]
        y = np.concatenate((np.ones(len(picked), np.int64), np.zeros(len(chosen), np.int64)))
        for _ in range(2):
            epoch(items, y, 0.1)
    # Place the border midway between the worst spans of clean documents and of toxic ones.
    clean_edges = np.cumsum([0] + [len(cut(docs[i])) for i in np.flatnonzero(labels == 0) if len(docs[i])])[:-1]
    worst_clean, worst_toxic = np.maximum.reduceat(logits(clean), clean_edges), np.maximum.reduceat(logits(everything), edges[:-1])
    low, high = np.quantile(worst_clean, 0.999), np.quantile(worst_toxic, 0.02)
    if high < low:  # they overlap: the least errors on either side, of both kinds alike
        grid = np.quantile(np.concatenate((worst_clean, worst_toxic)), np.linspace(0, 1, 400))
        low = high = min(grid, key=lambda g: (worst_toxic < g).mean() + (worst_clean >= g).mean())
    bias[1] -= low + (high - low) / 3
    return Model(vectors, layer, bias)


def train(docs: DataFrame, labels: DataFrame, where=None, rows: int = FIT_ROWS) -> Model:
    """Fit on labelled documents that meet ``where`` (a condition on doc_id)."""
    ship(docs.sparkSession)
    where = F.lit(True) if where is None else where

    def run(texts, y):
        if len(y) == 0 or y.min() == y.max():
            share = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
            bias = np.log(np.array([1 - share, share], np.float32))
            model = Model(np.zeros((1 << BITS, DIM), np.float32), np.zeros((DIM, 2), np.float32), bias)
        else:
            model = fit(texts, y)
        return {"vectors": model.vectors.tobytes(), "layer": model.layer.tobytes(), "bias": model.bias.tobytes()}

    got = {r.name: np.frombuffer(bytes(r.value), np.float32) for r in gathered(sample(docs, labels, "toxic", where, rows), run)}
    if not got:
        return Model(np.zeros((1 << BITS, DIM), np.float32), np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32))
    return Model(got["vectors"].reshape(-1, DIM), got["layer"].reshape(DIM, 2), got["bias"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model.folded())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded, bias = sent.value
        for batch in batches:
            out = np.empty(batch.num_rows)
            for i, j, data, offsets in text_slices(batch, "text", SLICE // 2):
                first, n, words, buckets = subwords(data, offsets)
                out[i:j] = worst_spans(word_scores(folded, words, buckets, n), first, bias)
            yield arrow_rows(doc_id=batch.column(0), score=1 / (1 + np.exp(-np.clip(out, -30, 30))))
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that the model does not reject, with all their columns, in one pass over the texts."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model.folded())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folded, bias = sent.value
        for batch in batches:
            good = np.empty(batch.num_rows, bool)
            for i, j, data, offsets in text_slices(batch, "text", SLICE // 2):
                first, n, words, buckets = subwords(data, offsets)
                good[i:j] = worst_spans(word_scores(folded, words, buckets, n), first, bias) < 0
            yield batch.filter(pa.array(good))
        give_back()

    return docs.mapInArrow(run, docs.schema)


def scored(docs: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0) -> DataFrame:
    """Scores of all documents by a model that has not seen the labels of the held-out ones."""
    out = remainder("doc_id", modulus) == held
    model = train(docs, labels, ~out)
    held_out = F.coalesce(out, F.lit(False))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
