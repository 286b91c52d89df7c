"""Ranked lexical search with the Best Position Algorithm over sharded impact lists.

Terms are runs of ASCII letters, digits and code points above 0x7F, A-Z lower-cased. What a term adds to a document's
score is an integer fixed by the corpus statistics (its impact), so every term's postings can be sorted by it once.

1. Statistics: one pass counts documents, terms and, for the terms of the queries, documents that hold them.
2. Index and search: each task turns its documents into shards of at most ``SHARD`` postings of query terms. A shard has
   an impact list per term and, for direct access, each document's places in all lists. A query goes down its lists
   in steps that double. Every document met is looked up in the other lists at once, and the places found there are
   marked as seen. A list's best position is the end of its gapless run of seen places; the sum of the impacts there
   bounds every unseen document. A query stops when that bound is strictly below its kth score, since a
   document with an equal score and a smaller id would still rank higher. A task's kth scores carry over from shard to shard.
3. Merge: at most ``k`` rows per task and query are ranked, in two steps, so that no query's rows meet in one task at once.

Queries are the side that is sent to tasks, in blocks of about ``BLOCK`` terms; a larger query set takes a pass over
the documents for each block. Documents are never shuffled. Terms are compared by 64-bit hashes.

Cases: NULL and empty texts and texts without terms are no documents of the statistics and rank nowhere; a query without
known terms has no rows; rows that repeat an item_id are one query with the terms of all of them; a NULL item_id
is a query of its own. Rows that repeat a doc_id are documents each; a NULL doc_id ranks after equal scores.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.support import WORD, Rolling, arrow_rows, lower, ship, spans, stored, text_slices

K = 50
#: Distinct (query, term) pairs that tasks are sent at a time.
BLOCK = 1_000_000
#: Postings of one shard.
SHARD = 2_000_000
_TERM = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = np.iinfo(np.int64).max  # stands for a NULL id: after all others


def query_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term)."""
    found = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"({_TERM})"), F.lit(1))
    return items.select("item_id", F.explode(found).alias("term")).distinct()


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a slice's terms and each document's first one."""
    data = lower(data)
    starts, ends, first = spans(data, offsets, WORD)
    return Rolling(data).ranges(starts, ends), first


class Queries:
    """A block of queries: the hashes of its distinct terms, sorted, and each query's term numbers."""

    def __init__(self, rows: list[tuple]):
        names = sorted({t for _, t in rows})
        raw = [t.encode() for t in names]
        ends = np.cumsum([len(t) for t in raw], dtype=np.int64)
        hashes = Rolling(np.frombuffer(b"".join(raw), np.uint8)).ranges(ends - np.array([len(t) for t in raw], np.int64), ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = {names[i]: n for n, i in enumerate(order.tolist())}
        terms: dict = {}
        for item, term in rows:
            terms.setdefault(item, []).append(number[term])
        self.items = list(terms)
        self.terms = [np.array(sorted(t), np.int64) for t in terms.values()]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers, -1 for words that no query asks for."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)


def postings(queries: Queries, batch: pa.RecordBatch):
    """Per slice: first row, terms of each document, and (row, term, occurrences) of the query terms."""
    for i, j, data, offsets in text_slices(batch):
        h, first = term_hashes(data, offsets)
        owner = np.repeat(np.arange(j - i), np.diff(first))
        term = queries.numbers(h)
        keep = term >= 0
        pair, tf = np.unique(owner[keep] * len(queries.hashes) + term[keep], return_counts=True)
        yield i, np.diff(first), pair // len(queries.hashes), pair % len(queries.hashes), tf


def statistics(docs: DataFrame, queries: Queries) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all terms, and the documents that hold each query term."""
    sent = docs.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        df, n_docs, n_terms = np.zeros(len(queries.hashes), np.int64), 0, 0
        for batch in batches:
            for _, sizes, _, term, _ in postings(queries, batch):
                df += np.bincount(term, minlength=len(df))
                n_docs, n_terms = n_docs + int((sizes > 0).sum()), n_terms + int(sizes.sum())
        held = np.flatnonzero(df)
        yield arrow_rows(term=np.concatenate(([-2, -1], held)), n=np.concatenate(([n_docs, n_terms], df[held])))

    sums = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    sent.unpersist()
    df, known = np.zeros(len(queries.hashes), np.int64), dict(zip(*(c.to_pylist() for c in sums.columns), strict=True))
    for term, n in known.items():
        if term >= 0:
            df[term] = n
    return known.get(-2, 0), known.get(-1, 0), df


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Top:
    """The best k (score, id) of one query so far."""

    __slots__ = ("ids", "k", "scores")

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids))
        best = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[best], ids[best]

    def kth(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 0


class Shard:
    """Impact lists of the query terms over some documents, and every document's places in them."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.ids = ids
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.at = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=n_terms))))
        # Direct access: a document's entries, as places in the lists.
        self.place = np.argsort(self.doc, kind="stable")
        self.term = term[order][self.place]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(ids)))))
        self.seen = np.zeros(len(doc), bool)
        self.met = np.zeros(len(ids), bool)
        self.asked = np.zeros(n_terms, bool)

    def look_up(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of documents, and the places in the asked lists that this showed."""
        size = self.first[docs + 1] - self.first[docs]
        entry = np.repeat(self.first[docs] - np.cumsum(size) + size, size) + np.arange(size.sum())
        owner = np.repeat(np.arange(len(docs)), size)
        ours = self.asked[self.term[entry]]
        place = self.place[entry[ours]]
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, owner[ours], self.impact[place])
        return scores, place

    def search(self, terms: np.ndarray, top: Top, step: int = 32) -> int:
        """Add this shard's best documents to ``top``; gives the list entries read in order."""
        terms = terms[self.at[terms + 1] > self.at[terms]]
        self.asked[terms] = True
        begin, end = self.at[terms], self.at[terms + 1]
        best = begin.copy()  # the first place of each list that has not been seen
        depth, marked, met = 0, [], []
        while True:
            lo, hi = np.minimum(begin + depth, end), np.minimum(begin + depth + step, end)
            size = hi - lo
            if not size.any():
                break
            read = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
            docs = np.unique(self.doc[read])
            docs = docs[~self.met[docs]]
            if len(docs):
                self.met[docs] = True
                met.append(docs)
                scores, place = self.look_up(docs)
                self.seen[place] = True
                marked.append(place)
                good = scores > max(top.kth() - 1, 0)
                top.add(scores[good], self.ids[docs[good]])
            depth, step = depth + step, step * 2
            bound = 0
            for i in range(len(terms)):
                b, e = int(best[i]), int(end[i])
                while b < e:
                    run = self.seen[b : min(b + step, e)]
                    gap = int(run.argmin())
                    if not run[gap]:
                        b += gap
                        break
                    b += len(run)
                best[i] = b
                if b < e:
                    bound += int(self.impact[max(b - 1, begin[i])])
            if bound < top.kth():
                break
        for place in marked:
            self.seen[place] = False
        for docs in met:
            self.met[docs] = False
        self.asked[terms] = False
        return int(np.minimum(end - begin, depth).sum())


def _block(docs: DataFrame, rows: list[tuple], k: int) -> DataFrame:
    """The best k of every task for each query of a block: item (number), doc_id, score."""
    spark = docs.sparkSession
    queries = Queries(rows)
    n_docs, n_terms, df = statistics(docs, queries)
    sent = spark.sparkContext.broadcast((queries, weights(n_docs, df)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weight = sent.value
        tops = [Top(k) for _ in queries.items]
        waiting: list[tuple] = []

        def flush():
            ids = np.concatenate([w[0] for w in waiting])
            base = np.cumsum([0] + [len(w[0]) for w in waiting])
            doc = np.concatenate([w[1] + b for w, b in zip(waiting, base, strict=False)])
            term, tf, n = (np.concatenate([w[c] for w in waiting]) for c in (2, 3, 4))
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            impact = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            shard = Shard(ids, doc, term, impact, len(weight))
            for terms, top in zip(queries.terms, tops, strict=True):
                shard.search(terms, top)
            waiting.clear()

        held = 0
        for batch in batches:
            ids = batch.column(0).fill_null(int(_LAST)).to_numpy(zero_copy_only=False)
            for i, sizes, row, term, tf in postings(queries, batch):
                waiting.append((ids[i : i + len(sizes)], row, term, tf, sizes[row]))
                held += len(row)
                if held >= SHARD:
                    flush()
                    held = 0
        if held:
            flush()
        sizes = [len(t.scores) for t in tops]
        if sum(sizes):
            ids = np.concatenate([t.ids for t in tops])
            yield arrow_rows(
                item=np.repeat(np.arange(len(tops)), sizes), doc_id=pa.array(ids, pa.int64(), mask=ids == _LAST),
                score=np.concatenate([t.scores for t in tops]),
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "item long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id and score of every item's ``k`` best documents with a score above 0."""
    spark = docs.sparkSession
    ship(spark)
    asked = stored(query_terms(items), "query-terms")
    blocks = max(1, -(-asked.count() // block))
    kind = items.schema["item_id"].dataType
    parts = []
    for b in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        rows = [tuple(r) for r in mine.orderBy("item_id", "term").collect()]
        if not rows:
            continue
        found = _block(docs, rows, k)
        names = spark.createDataFrame(list(enumerate(dict.fromkeys(r[0] for r in rows))), f"item long, item_id {kind.simpleString()}")
        best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        # First among the rows of some tasks, then among the best of those.
        found = found.withColumn("__some", F.spark_partition_id() % 64)
        near = F.row_number().over(Window.partitionBy("item", "__some").orderBy(*best))
        found = found.withColumn("__rank", near).where(F.col("__rank") <= k)
        rank = F.row_number().over(Window.partitionBy("item").orderBy(*best)).cast("int")
        found = found.withColumn("rank", rank).where(F.col("rank") <= k)
        parts.append(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    out = parts[0] if len(parts) == 1 else stored(parts[0], "ranked")
    for part in parts[1:]:
        out = out.unionAll(stored(part, "ranked"))
    return out


def oracle_sql(k: int = K) -> str:
    return f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}') AS ts FROM documents
),
s AS (SELECT count(*) FILTER (WHERE len(ts) > 0) AS nd, sum(len(ts))::BIGINT AS l FROM d),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM benchmark
),
p AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY doc_id, n, term
),
w AS (
  SELECT term, floor(1000 * ln((2 * any_value(nd) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM p, s GROUP BY term
),
r AS (
  SELECT q.item_id, p.doc_id, sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nd) // l))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), s GROUP BY q.item_id, p.doc_id
),
t AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM t WHERE rank <= {k}
"""
