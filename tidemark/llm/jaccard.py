"""Exact Jaccard links between documents' word n-gram sets, with a token-group matrix.

Documents with equal sets are one node. The steps:

1. Count shingles. Tasks send sorted 32-bit pieces of the shingle hashes by hash range; each range
   reports which slots are used twice or more (a bit table of fixed size) and its frequent slots. Both only
   rank shingles: once-used ones first, then rare ones, then frequent ones by frequency. Any fixed
   ranking gives exact results; this one makes frequent shingles matter only to documents made of them.
2. Prefixes. Two sets that link share one of the first ``n - ceil(0.8 n) + 1`` shingles in that ranking of the larger
   and one of the first ``n - ceil(8/9 n) + 1`` of the smaller (the larger asks, the smaller is indexed; equals may do
   either). A prefix shingle used once links nothing, so only sets with repeated shingles in their prefix go on. What a
   set shares with any other is at most its repeated shingles, which bounds the size of its partners (``reach``).
3. Groups. In each of ``ROUNDS`` rounds every set is compared with up to ``CHOICES`` indexed sets that share a prefix
   shingle and are not in its group yet: the one with the fewest shingles of its own, and the least by a hash. Linked sets
   form groups of similar documents; near copies of one text meet in the same few sets and need no comparison with each
   other. Large groups are kept in parts of ``PART`` sets of like size.
4. Token-group matrix. A part of a group stores the union of its members' shingles. Sets are queries to the other groups
   that index one of their prefix shingles: the overlap of the query with a part's union bounds that with any
   member, and only parts that reach the overlap that their least member would need are opened, member by member.
   Sets in the same group are already connected and are not compared pair by pair. Sets that share most of their
   shingles and yet do not link stay in groups of their own; that work can grow with the square of their number.

Links between groups and inside them give the components. Nothing grows on the driver but the two
bounded tables. Sets travel as arrays of 64-bit hashes, only for documents with candidates.

Cases: words are runs of bytes other than ASCII blanks, A-Z lower-cased; fewer than five words are one shingle;
a NULL, empty or blank text has no shingles and links with nothing, not even its like. Rows with the same
id and different texts are different sets under that id. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.counting import Ranking, grouped, ranked
from tidemark.llm.support import (
    NOT_SPACE, Rolling, arrow_rows, column_bytes, distinct, fold, give_back, lower, ship, spans, stored, text_bytes, text_name, text_slices,
)

N = 5
PERCENT = 80
PART = 32
ROUNDS, CHOICES = 2, 3
#: Bits of the table that tells texts in no group from the others, 64 in a row: at most 2**18 rows are sent to the tasks.
SLOTS = 1 << 24
#: Text bytes whose shingles one task counts.
RANGE_BYTES = 24 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document of a slice."""
    data = lower(data)
    starts, ends, first = spans(data, offsets, NOT_SPACE)
    h = Rolling(data).ranges(starts, ends)
    g = fold(h, N)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= N:
            out.append(distinct(g[a : b - N + 1]))
        elif b > a:
            out.append(fold(h[a:b], b - a) + np.uint64(b - a))
        else:
            out.append(h[:0])
    return out


def node_of(own: np.ndarray) -> bytes | None:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


# --- 1. counting ---------------------------------------------------------------------------


def ranking(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> Ranking:
    def tokens(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        seen = set()
        for _, _, data, offsets in text_slices(batch):
            found = [np.zeros(0, np.uint64)]
            for own in shingle_sets(data, offsets):
                node = node_of(own)
                if node and node not in seen:  # copies in a batch count once
                    seen.add(node)
                    found.append(own)
            yield np.concatenate(found)

    return ranked(docs.select("text"), tokens, -(-text_bytes(docs) // range_bytes))


# --- 2. prefixes ---------------------------------------------------------------------------


def needed(n: int, m: int, percent: int) -> int:
    """Common shingles from which sets of n and m shingles link."""
    return -(-percent * (n + m) // (100 + percent))


def prefix(own: np.ndarray, ranking: Ranking, percent: int) -> tuple[np.ndarray, int, int]:
    """The repeated shingles among the first ones that a linking set must share one of; how many of them
    suffice for partners that are no smaller; the size of the largest set that could link."""
    n = len(own)
    size = n - -(-n * percent // 100) + 1
    rank = ranking.ranks(own)
    once = int((rank == 0).sum())
    if once >= size:
        return own[:0], 0, 0
    chosen = np.argsort(rank, kind="stable")[:size]
    indexed = max(0, n - needed(n, n, percent) + 1 - once)
    return own[chosen[once:]], indexed, (n - once) * (100 + percent) // percent - n


def described(docs: DataFrame, sent: Broadcast, percent: int) -> DataFrame:
    """A row per document (doc_id, node, n) and a row per candidate node and batch (node, n, tokens, indexed, reach,
    shingles). ``sent`` is the ranking."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranking = sent.value
        for batch in batches:
            nodes, sizes, seen = [], [], set()
            c_node, c_size, c_tokens, c_indexed, c_reach, c_set = [], [], [], [], [], []
            for _, _, data, offsets in text_slices(batch):
                for own in shingle_sets(data, offsets):
                    node = node_of(own)
                    nodes.append(node)
                    sizes.append(len(own))
                    if node is None or node in seen:
                        continue
                    seen.add(node)
                    tokens, indexed, reach = prefix(own, ranking, percent)
                    if len(tokens):
                        c_node.append(node)
                        c_size.append(len(own))
                        c_tokens.append(tokens.view(np.int64))
                        c_indexed.append(indexed)
                        c_reach.append(reach)
                        c_set.append(own.tobytes())
            n, m = len(nodes), len(c_node)
            ids = batch.column(0)
            yield arrow_rows(
                document=pa.array([True] * n + [False] * m),
                doc_id=pa.concat_arrays([ids, pa.nulls(m, ids.type)]),
                node=(nodes + c_node, pa.binary()), n=(sizes + c_size, pa.int64()),
                tokens=([None] * n + c_tokens, pa.list_(pa.int64())), indexed=([None] * n + c_indexed, pa.int32()),
                reach=([None] * n + c_reach, pa.int64()), shingles=([None] * n + c_set, pa.binary()),
            )
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"document boolean, doc_id {kind}, node binary, n long, tokens array<long>, indexed int, reach long, shingles binary"
    )


# --- 3 and 4. comparing --------------------------------------------------------------------


def _overlaps(batch: pa.RecordBatch, left: str, right: str) -> np.ndarray:
    """Common shingles of two binary columns, row by row."""
    a, a_at = column_bytes(batch.column(batch.schema.get_field_index(left)))
    b, b_at = column_bytes(batch.column(batch.schema.get_field_index(right)))
    out = np.zeros(batch.num_rows, np.int64)
    for k in range(batch.num_rows):
        x = np.frombuffer(a[a_at[k] : a_at[k + 1]].tobytes(), np.uint64)
        y = np.frombuffer(b[b_at[k] : b_at[k + 1]].tobytes(), np.uint64)
        if len(x) > len(y):
            x, y = y, x
        if len(x):
            out[k] = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
    return out


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets reach the similarity."""
    near = f"100 * least(n, m) >= {percent} * greatest(n, m) AND m <= reach AND n <= reach_m"
    one = sets.select(F.col("node").alias("a"), "n", "reach", F.col("shingles").alias("s"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("reach").alias("reach_m"), F.col("shingles").alias("t"))
    rows = pairs.join(one.hint("merge"), "a").join(two.hint("merge"), "b").where(near).select("a", "b", "n", "m", "s", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = _overlaps(batch, "s", "t")
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            ok = pa.array(100 * both >= percent * (n + m - both))
            yield batch.select(["a", "b"]).filter(ok)
        give_back()

    return rows.mapInArrow(run, "a binary, b binary")


def placed(prefixes: DataFrame, groups: DataFrame) -> DataFrame:
    """``prefixes`` with the root of each node's group."""
    return prefixes.join(groups.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))


def stars(prefixes: DataFrame, turn: int) -> DataFrame:
    """Up to ``CHOICES`` sets of other groups that each set (of ``placed`` prefixes) is compared with: (a, b)."""
    names = [f"x{k}" for k in range(CHOICES)]

    def order(k: int):
        own = F.col("n") / F.col("reach") if k == 0 else F.lit(0.0)
        return F.struct(own.alias("own"), F.xxhash64("node", F.lit(turn * CHOICES + k)).alias("h"), F.col("node").alias("b"), F.col("root").alias("q"))

    lead = prefixes.where("indexed").groupBy("token").agg(*[F.min(order(k)).alias(x) for k, x in enumerate(names)])
    picked = prefixes.select("token", "node", "root").join(lead.hint("merge"), "token").groupBy("node").agg(
        *[F.min(F.when(F.col(f"{x}.q") != F.col("root"), F.col(x))).alias(x) for x in names]
    )
    return picked.select(F.col("node").alias("a"), F.explode(F.array(*[F.col(f"{x}.b") for x in names])).alias("b")).where("b IS NOT NULL").distinct()


def group_links(matrix: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between nodes of different groups, through the token-group matrix: ``placed`` prefixes."""
    targets = matrix.where("indexed").groupBy("token", F.col("root").alias("g")).agg(F.min("n").alias("least"))
    # Which groups a set asks: those that index one of its prefix shingles for a set that is no larger.
    several = targets.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi"))
    askers = matrix.join(several, "token").where("lo < hi OR lo <> root").select("token", F.col("node").alias("a"), "n", "root")
    asks = askers.join(targets, "token").where("g <> root AND (n > least OR n = least AND g < root)").select("a", "g").distinct()
    asks = stored(asks, "asks")
    # Part of a group that is asked: its indexed members' sets, those of like size together, in bounded portions.
    members = matrix.where("indexed").select("node", "root", "n", "reach").distinct()
    members = stored(members.join(asks.select(F.col("g").alias("root")).distinct(), "root"), "asked-members")
    counts = members.groupBy("root", "n").agg(F.count(F.lit(1)).alias("members"))
    members = members.join(counts, ["root", "n"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / PART)).cast("int")
    )
    members = members.join(sets.select("node", "shingles"), "node")
    members = stored(members.select("root", "part", "node", "n", "reach", "shingles"), "group-members")

    def unite(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        union, reach = np.zeros(0, np.uint64), 0
        for batch in batches:
            data, _ = column_bytes(batch.column(batch.schema.get_field_index("shingles")))
            union = distinct(np.concatenate((union, np.frombuffer(data.tobytes(), np.uint64))))
            reach = max(reach, batch.column(batch.schema.get_field_index("reach")).to_numpy().max())
        yield arrow_rows(root=([key[0].as_py()], pa.binary()), m=([key[1].as_py()], pa.int64()), part=([key[2].as_py()], pa.int32()),
                         reach_m=([int(reach)], pa.int64()), tokens=([union.tobytes()], pa.binary()))

    unions = members.groupBy("root", "n", "part").applyInArrow(
        grouped(unite), "root binary, m long, part int, reach_m long, tokens binary"
    )
    unions = stored(unions, "group-unions")
    queries = asks.join(sets.select(F.col("node").alias("a"), "n", "reach", F.col("shingles").alias("s")), "a")
    bounded = queries.join(unions.withColumnRenamed("root", "g"), "g").where(
        f"m <= n AND 100 * m >= {percent} * n AND m <= reach AND n <= reach_m"
    ).select("a", "n", "g", "m", "part", "s", "tokens")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, n, m = _overlaps(batch, "s", "tokens"), batch.column(1).to_numpy(), batch.column(3).to_numpy()
            ok = pa.array((100 + percent) * both >= percent * (n + m))
            yield batch.select(["a", "g", "m", "part"]).filter(ok)

    opened = stored(bounded.mapInArrow(bound, "a binary, g binary, m long, part int"), "opened-parts")
    inside = members.select(F.col("root").alias("g"), F.col("n").alias("m"), "part", F.col("node").alias("b"))
    return linked(opened.join(inside, ["g", "m", "part"]).select("a", "b"), sets, percent)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id (the least doc_id reachable by links)."""
    ship(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranking(docs))
    rows = stored(described(docs, sent, percent), "described")
    sent.destroy()  # nothing reads the ranking from here on
    nodes = rows.where("document").groupBy("node").agg(F.min("doc_id").alias("least"))
    candidates = rows.where("NOT document")
    first = [F.first(c).alias(c) for c in ("n", "reach", "shingles")]
    sets = stored(candidates.groupBy("node").agg(*first), "sets")
    tokens = candidates.select("node", "n", "reach", "indexed", F.posexplode("tokens").alias("at", "token")).select(
        "token", "node", "n", "reach", (F.col("at") < F.col("indexed")).alias("indexed")
    )
    # Copies in several batches are repeated rows here; a shingle counts if it is indexed and used by two sets.
    used = tokens.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.max("indexed").alias("any")).where("any AND lo < hi")
    prefixes = stored(tokens.join(used.select("token"), "token", "left_semi").distinct(), "prefixes")
    matrix, groups = prefixes.withColumn("root", F.col("node")), None
    for turn in range(ROUNDS):
        found = stored(linked(stars(matrix, turn), sets, percent), "star-links")
        if turn and not found.take(1):
            break
        # The groups so far stand for the links that made them.
        groups = components(found if groups is None else found.unionAll(groups))
        matrix = stored(placed(prefixes, groups), "token-group-matrix")
    across = stored(group_links(matrix, sets, percent), "group-links")
    roots = components(across.unionAll(groups)) if across.take(1) else groups
    # From nodes to documents: the least id of a component's nodes.
    members = nodes.where("node IS NOT NULL").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = stored(members, "members")
    least = members.groupBy("root").agg(F.min("least").alias("component"))
    named = members.join(least, "root").select("node", "component")
    return rows.where("document").join(named, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of every component of linked documents: that with the least doc_id (NULL last).

    Rows are told apart by their texts, whatever their ids; of rows that are equal in every column one stays. Documents
    without words link with nothing and stay, each of them.
    """
    named = docs.withColumn("__name", text_name())
    rows = near_duplicates(named.select(F.col("__name").alias("doc_id"), "text"), percent).where("n_shingles > 0")
    rows = stored(rows.select(F.col("doc_id").alias("__name"), F.col("component_id").alias("__group")), "components")
    several = rows.groupBy("__group").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("__group")
    found = stored(rows.join(several, "__group").distinct(), "near-duplicates")
    # Texts whose bit is not set are in no group and are not moved; the bits are a bounded table, as sent to the tasks.
    named = named.withColumn("__slot", F.pmod(F.xxhash64("__name"), F.lit(SLOTS)))
    bit = F.expr("shiftleft(1L, cast(__slot % 64 as int))")
    bits = found.withColumn("__slot", F.pmod(F.xxhash64("__name"), F.lit(SLOTS))).groupBy(F.expr("__slot div 64").alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    marked = named.withColumn("__word", F.expr("__slot div 64")).join(F.broadcast(bits), "__word", "left")
    marked = marked.withColumn("__maybe", F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False)))
    maybe = marked.where("__maybe").select(*docs.columns, "__name")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*docs.columns).alias("row"))
    grouped_rows = maybe.join(found, "__name").withColumn("__order", order)
    first = grouped_rows.groupBy("__group").agg(F.min("__order").alias("__first"))
    chosen = grouped_rows.join(first, "__group").where("__order = __first OR (__order.none AND __first.none AND __order.row = __first.row)")
    alone = marked.where("NOT __maybe").select(*docs.columns).unionAll(
        maybe.join(found.select("__name"), "__name", "left_anti").select(*docs.columns)
    )
    return alone.unionAll(chosen.select(*docs.columns).dropDuplicates())
