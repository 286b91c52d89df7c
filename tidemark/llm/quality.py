"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of letters and digits, and runs of other visible bytes; features are hashed tokens
and pairs of neighbours (a token followed by itself is one feature, whatever the token). A document's value of a feature is its count over the square root of its
number of features, so a score is one sparse dot product. Scoring is a single pass over the texts
without a shuffle; the model is one array of ``2**bits`` weights, sent to every task.

Cases: a NULL text is an empty one; a text without tokens gets the model's bias. Repeated documents get
equal scores. Training needs labels of both kinds, else every score is the share of the kind there
is (0.5 without any). NULL ids or labels are not learned from. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.support import SLICE, NOT_SPACE, WORD, Rolling, arrow_rows, fold, give_back, lower, remainder, ship, text_slices

#: Most labelled documents of each kind that the model is fitted on (the first by a hash of their id).
FIT_ROWS = 4000
#: Longest sampled text, in bytes; a longer one is left out of the fit, not cut. Bounds the fit's memory.
FIT_BYTES = 200_000

#: Stands for every pair of two equal tokens, whichever they are.
SAME = np.uint64(0x5DEECE66D5DEECE6)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    bits: int


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the documents in a slice, document by document, and where each begins."""
    data = lower(data)
    n = len(data)
    kind = np.where(WORD[data], 2, NOT_SPACE[data].astype(np.int8))
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    change[offsets[(offsets > 0) & (offsets < n)]] = True
    edges = np.append(np.flatnonzero(change), n)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    token = kind[edges[:-1]] > 0
    starts, ends = edges[:-1][token], edges[1:][token]
    first = np.searchsorted(starts, offsets, side="left")
    h = Rolling(data).ranges(starts, ends)
    pairs = fold(h, 2)
    pairs[h[1:] == h[:-1]] = SAME
    out = np.empty(2 * len(h), np.uint64)
    out[0::2] = h
    out[1::2][: len(pairs)] = pairs
    # The pair that starts at a document's last token reaches into the next one: repeat the token instead.
    last = first[1:][first[1:] > first[:-1]] - 1
    out[1::2][last] = h[last]
    return (out >> np.uint64(64 - bits)).astype(np.int64), 2 * first


def fit(texts: list[np.ndarray], labels: np.ndarray, bits: int = 20, alpha: float = 0.3, beta: float = 1.0,
        l1: float = 0.02, l2: float = 0.05, passes: int = 3) -> Model:
    """Follow-the-regularised-leader (proximal, per-coordinate rates), one document at a time.

    Both kinds weigh the same in total, so that a score of one half separates them whatever their shares.
    """
    z, squares = np.zeros(1 << bits, np.float64), np.zeros(1 << bits, np.float64)
    bias_z = bias_n = 0.0
    rows = []
    for text in texts:
        f, _ = features(text, np.array([0, len(text)]), bits)
        index, count = np.unique(f, return_counts=True)
        rows.append((index, count / np.sqrt(max(1, len(f)))))
    share = max(1e-9, labels.mean()) if len(labels) else 0.5
    cost = np.where(labels == 1, 0.5 / share, 0.5 / max(1e-9, 1 - share))

    def leader(z_, n_):
        shrunk = np.sign(z_) * np.maximum(np.abs(z_) - l1, 0)
        return -shrunk / ((beta + np.sqrt(n_)) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(rows)):
            index, x = rows[i]
            w = leader(z[index], squares[index])
            b = -bias_z / ((beta + np.sqrt(bias_n)) / alpha + l2)
            p = 1 / (1 + np.exp(-np.clip(w @ x + b, -30, 30)))
            step = (p - labels[i]) * cost[i]
            g = step * x
            sigma = (np.sqrt(squares[index] + g * g) - np.sqrt(squares[index])) / alpha
            z[index] += g - sigma * w
            squares[index] += g * g
            sigma = (np.sqrt(bias_n + step * step) - np.sqrt(bias_n)) / alpha
            bias_z += step - sigma * b
            bias_n += step * step
    bias = -bias_z / ((beta + np.sqrt(bias_n)) / alpha + l2)
    return Model(leader(z, squares).astype(np.float32), float(bias), bits)


def sample(docs: DataFrame, labels: DataFrame, label: str, where, rows: int = FIT_ROWS) -> DataFrame:
    """At most ``rows`` labelled documents of each kind: (text, label). Ids are chosen before texts are
    looked up, so only their bounded list meets the documents."""
    usable = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & where
    )
    usable = usable.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = None
    for kind in (0, 1):
        some = usable.where(F.col("label") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = some if chosen is None else chosen.unionAll(some)
    texts = docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= FIT_BYTES)
    return texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")


def gathered(rows: DataFrame, train) -> list:
    """``train(texts, labels)`` in one task over a bounded sample; its (name, bytes) results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            ids = batch.column(0).to_pylist()
            marks = batch.column(2).to_pylist()
            for i, _, data, _ in text_slices(batch, "text", 1):
                found.append((ids[i], data.tobytes(), marks[i]))
        found.sort()  # the same model whatever order the rows come in
        texts = [np.frombuffer(t, np.uint8) for _, t, _ in found]
        for name, value in train(texts, np.array([m for _, _, m in found], np.float64)).items():
            yield arrow_rows(name=([name], pa.string()), value=([value], pa.binary()))
        del found, texts
        give_back()

    # An exchange between the scan of the documents and the one task that fits: only the sample moves.
    return rows.repartition(1).mapInArrow(run, "name string, value binary").collect()


def train(docs: DataFrame, labels: DataFrame, where=None, bits: int = 20, rows: int = FIT_ROWS) -> Model:
    """Fit on labelled documents that meet ``where`` (a condition on doc_id)."""
    ship(docs.sparkSession)
    where = F.lit(True) if where is None else where

    def run(texts, y):
        if len(y) == 0 or y.min() == y.max():
            share = float(y.mean()) if len(y) else 0.5
            bias = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
            model = Model(np.zeros(1 << bits, np.float32), bias, bits)
        else:
            model = fit(texts, y, bits)
        return {"weights": model.weights.tobytes(), "bias": np.float64(model.bias).tobytes()}

    got = {r.name: bytes(r.value) for r in gathered(sample(docs, labels, "quality", where, rows), run)}
    if not got:
        return Model(np.zeros(1 << bits, np.float32), 0.0, bits)
    return Model(np.frombuffer(got["weights"], np.float32), float(np.frombuffer(got["bias"], np.float64)[0]), bits)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            out = np.empty(batch.num_rows)
            for i, j, data, offsets in text_slices(batch, "text", SLICE):
                f, first = features(data, offsets, model.bits)
                sums = np.concatenate(([0.0], np.cumsum(model.weights[f], dtype=np.float64)))
                n = np.diff(first)
                logit = (sums[first[1:]] - sums[first[:-1]]) / np.sqrt(np.maximum(n, 1)) + model.bias
                out[i:j] = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            yield arrow_rows(doc_id=batch.column(0), score=out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def scored(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    """Scores of all documents by a model that has not seen the labels of the held-out ones."""
    out = remainder("doc_id", modulus) == held
    model = train(docs, labels, ~out)
    held_out = F.coalesce(out, F.lit(False))
    return score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
