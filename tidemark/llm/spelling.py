"""Spelling variants: words one edit apart, by composing a vocabulary acceptor with a one-edit transducer and itself.

A word is a maximal run of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z lower-cased. Two words are near if one inserted,
deleted or replaced code point turns one into the other.

Counting is DataFrame functions with map-side combine. The pairs come from finite-state composition, by initial state:

* Of two near words the longer one has L code points. Either they agree in the first L div 2 of them or in
  the last L - L div 2. So each word is sent, for L its own length and one more, under the part that would be shared; the
  rest is the block that may differ. Words under one key form a partition: its initial state is the one
  after the shared part (read backwards where that is the end of the word), and its acceptor accepts the blocks.
* A partition of more than ``LARGE`` words, or with blocks of more than ``LONG`` code points, is split by the same argument
  on its block: half of it must be shared too, and joins the key. Blocks of one code point bound a partition by the
  alphabet, so every partition becomes small.
* Many partitions share a task and one minimised acceptor: equal states are one, whatever partition they
  come from. The composition walks pairs of states with no edit or one edit used; what a state or a pair of
  states accepts is worked out once and used wherever it is reached. Only the edit at the end of the common beginning
  counts, so each pair comes out once.

A word's form is the most frequent of its near words, if at least ``RATIO`` times as frequent. Counts grow along forms, so chains
are at most as long as the logarithm of the largest count; roots are found by halving the chains.

``typos`` is the contract's planted misspelling: it deletes one code point of every run whose hash with its document's id
97 divides. Cases: a NULL or empty text has no words; a NULL id counts as an empty one; repeated rows count
each; an empty table has no words; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.counting import grouped
from tidemark.llm.support import ship, stored

LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
#: Words of a partition and length of its blocks above which it is split, and rows of a task.
LARGE, LONG, TASK_ROWS = 2_000, 64, 40_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RUN = "([A-Za-zÀ-ÿ]+)"


def runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, word): every run of letters, A-Z lower-cased."""
    found = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(_RUN), F.lit(1))
    return docs.select("doc_id", F.explode(found).alias("word"))


def typos(words: DataFrame, every: int = 97) -> DataFrame:
    """The words after one code point of some has been deleted, as crc32 of ``<doc_id>:<word>`` decides."""
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))
    at = (F.col("__h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    hit = F.col("__h") % every == 0
    return words.withColumn("__h", F.crc32(name.cast("binary"))).select(F.when(hit, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


# --- partitions by initial state -----------------------------------------------------------


def whole(words: DataFrame) -> DataFrame:
    """Each word as a block of its own length and as the shorter partner of one more.

    ``pre`` and ``post`` code points are shared at either end, ``size`` is the longest block, ``differ`` lists (start,
    length) of pieces in which the words of a pair must not be equal, ``back`` says whether blocks are read backwards.
    """
    size = F.explode(F.array(F.length("word"), F.length("word") + 1))
    zero = F.lit(0)
    return words.select("word", "n", size.alias("size")).select(
        F.xxhash64("size").alias("key"), "word", "n", zero.alias("pre"), zero.alias("post"), "size",
        F.array().cast("array<struct<start:int,length:int>>").alias("differ"), F.lit(False).alias("back"),
    )


def split(rows: DataFrame) -> DataFrame:
    """Every block under its first half and under its second half."""
    half = F.floor(F.col("size") / 2).cast("int")
    rest = F.col("size") - half

    def side(back: bool, shared: Column, pre: Column, post: Column, size: Column, differ: Column) -> Column:
        key = F.xxhash64("key", F.lit(back), shared)
        return F.struct(key.alias("key"), pre.alias("pre"), post.alias("post"), size.alias("size"), differ.alias("differ"), F.lit(back).alias("back"))

    front = side(
        False, F.substring("word", F.col("pre") + 1, half), F.col("pre") + half, F.col("post"), rest, F.col("differ")
    )
    # Pairs that also agree in the first half are found there.
    piece = F.array(F.struct(F.col("pre").alias("start"), half.alias("length")))
    end = side(
        True, F.substring("word", F.length("word") - F.col("post") - rest + 1, rest), F.col("pre"), F.col("post") + rest, half,
        F.concat("differ", piece),
    )
    # A block of one code point has no first half to look for.
    sides = F.filter(F.array(front, end), lambda s: s["size"] > 0)
    return rows.select("word", "n", F.explode(sides).alias("s")).select("s.key", "word", "n", "s.pre", "s.post", "s.size", "s.differ", "s.back")


def partitions(words: DataFrame, large: int = LARGE) -> DataFrame:
    """Rows of partitions with two words or more, none with more than ``large`` unless its block is one code point."""
    rows, done = stored(split(whole(words)), "spelling-keys"), None
    while True:
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        rows = rows.join(sizes, "key")
        over = ((F.col("members") > large) & (F.col("size") > 1)) | (F.col("size") > LONG)
        ready = rows.where(~over).drop("members")
        done = ready if done is None else done.unionAll(ready)
        rows = stored(split(rows.where(over).drop("members")), "spelling-keys")
        if rows.isEmpty():
            return done.select("key", "word", "n", "pre", "post", "size", "differ", "back")


# --- composition ---------------------------------------------------------------------------


class Acceptor:
    """A minimised acyclic acceptor, and its composition with one edit and itself.

    States are numbers; equal states are made once. State 0 accepts nothing more than the empty string.
    """

    def __init__(self):
        self.states: list[tuple[bool, dict[str, int]]] = []
        self.register: dict[tuple, int] = {}
        self.words: dict[int, list[str]] = {}
        self.both: dict[tuple[int, int], list[str]] = {}
        self.near: dict[int, list[tuple[str, str]]] = {}

    def state(self, tails: list[str]) -> int:
        """The state that accepts exactly the given sorted distinct strings."""
        final, arcs, i = False, {}, 0
        if tails and not tails[0]:
            final, i = True, 1
        while i < len(tails):
            c, j = tails[i][0], i
            while j < len(tails) and tails[j][0] == c:
                j += 1
            if j == i + 1:
                arcs[c] = self.chain(tails[i][1:])
            else:
                arcs[c] = self.state([t[1:] for t in tails[i:j]])
            i = j
        return self.made(final, arcs)

    def chain(self, tail: str) -> int:
        at = self.made(True, {})
        for c in reversed(tail):
            at = self.made(False, {c: at})
        return at

    def made(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        have = self.register.get(key)
        if have is None:
            have = self.register[key] = len(self.states)
            self.states.append((final, arcs))
        return have

    def accepted(self, q: int) -> list[str]:
        out = self.words.get(q)
        if out is None:
            final, arcs = self.states[q]
            out = [""] if final else []
            for c, to in arcs.items():
                out += [c + s for s in self.accepted(to)]
            self.words[q] = out
        return out

    def common(self, p: int, q: int) -> list[str]:
        """Strings that both states accept: the edit has been used, labels must agree."""
        if p == q:
            return self.accepted(p)
        key = (p, q) if p < q else (q, p)
        out = self.both.get(key)
        if out is None:
            (f1, a1), (f2, a2) = self.states[p], self.states[q]
            out = [""] if f1 and f2 else []
            if len(a2) < len(a1):
                a1, a2 = a2, a1
            for c, to in a1.items():
                other = a2.get(c)
                if other is not None:
                    out += [c + s for s in self.common(to, other)]
            self.both[key] = out
        return out

    def pairs(self, q: int) -> list[tuple[str, str]]:
        """Pairs of accepted strings one edit apart, each once."""
        out = self.near.get(q)
        if out is None:
            out = []
            arcs = list(self.states[q][1].items())
            for i, (c, to) in enumerate(arcs):
                out += [(c + a, c + b) for a, b in self.pairs(to)]
                for d, other in arcs[i + 1 :]:
                    out += [(c + s, d + s) for s in self.common(to, other)]
                # One more code point; if what follows began with it too, the edit would come later.
                out += [(c + s, s) for s in self.common(to, q) if not s or s[0] != c]
            self.near[q] = out
        return out


def near_words(rows: list[tuple]) -> Iterator[tuple[str, str, int]]:
    """(word, near word, its count), both ways, from a task's rows (key, word, n, pre, post, size, differ, back)."""
    by_key: dict[tuple, dict[str, tuple[str, int]]] = defaultdict(dict)
    for key, word, n, pre, post, size, differ, back in rows:
        block = word[pre : len(word) - post]
        shared = (word[:pre], word[len(word) - post :])  # keys are hashes: what is shared is compared as well
        label = (key, shared, size, back, tuple((d["start"], d["length"]) for d in differ))
        by_key[label][block[::-1] if back else block] = (word, n)
    acceptor = Acceptor()
    for (_, _, size, _, differ), blocks in by_key.items():
        if len(blocks) < 2:
            continue
        for a, b in acceptor.pairs(acceptor.state(sorted(blocks))):
            if max(len(a), len(b)) != size:  # two shorter ones: found at their own length
                continue
            (u, m), (v, n) = blocks[a], blocks[b]
            if any(u[s : s + k] == v[s : s + k] for s, k in differ):
                continue
            yield u, v, n
            yield v, u, m


def near_pairs(words: DataFrame, large: int = LARGE) -> DataFrame:
    """(word, near, near_n) for every ordered pair of near words of ``words(word, n)``."""
    ship(words.sparkSession)
    rows = stored(partitions(words, large), "spelling-partitions")
    tasks = max(1, -(-rows.count() // TASK_ROWS))

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)]
        out: list[tuple] = []
        for pair in near_words(held):
            out.append(pair)
            if len(out) == 50_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    rows = rows.select(F.pmod("key", F.lit(tasks)).alias("task"), *rows.columns)
    return rows.groupBy("task").applyInArrow(grouped(run), "word string, near string, near_n long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    word, near, n = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())], names=["word", "near", "near_n"])


# --- forms and roots -----------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``forms(word, form)`` to (word, root): the last word that following forms leads to. Chains halve each round."""
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("__w"), F.col("root").alias("__r"))
        step = at.join(on, F.col("root") == F.col("__w"), "left")
        at = stored(step.select("word", F.coalesce("__r", "root").alias("root"), F.col("__r").isNotNull().alias("moved")), "spelling-roots")
        if at.where("moved").isEmpty():
            return at.drop("moved")
        at = at.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO, large: int = LARGE) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary ``words(word, n)``."""
    words = stored(words.select("word", "n"), "vocabulary")
    best = near_pairs(words, large).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    judged = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n")
    )
    takes = F.col("near_n") >= ratio * F.col("n")
    judged = stored(judged.select("word", "n", "n_near", F.when(takes, F.col("near")).alias("form"), F.when(takes, F.col("near_n")).alias("form_n")), "forms")
    ends = roots(judged.where("form IS NOT NULL"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """The variants of the words of ``docs``, with the contract's planted misspellings."""
    return variants(vocabulary(typos(runs(docs))))
