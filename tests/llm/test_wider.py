"""Spelling variants, phrase dedup and ranked search against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, difference
from tidemark.llm import phrases, search, spelling
from tidemark.llm.queries import ORACLE_SQL, QUERIES
from tidemark.llm.support import Rolling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def extra(df):
    """Columns that clash with the operators' own."""
    names = "word n near key size part salt start words spans copied item rank score __rank term".split()
    return df.withColumns({n: F.lit("x") for n in names})


def test_long_words_of_two_letters_differ():
    a, b = "a", "b"
    while len(a) < 4096:
        a, b = a + b, b + a
    data = np.frombuffer((a + b + "hello, hello").encode(), np.uint8)
    h = Rolling(data).ranges(np.array([0, 4096, 8192, 8199]), np.array([4096, 8192, 8197, 8204]))
    assert h[0] != h[1] and h[2] == h[3]


# --- spelling variants ---------------------------------------------------------------------


def brute_vocabulary(rows, planted=True):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if planted and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_variants(counts):
    near = defaultdict(set)
    holes = defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            cut = w[:i] + w[i + 1 :]
            holes[i, cut].add(w)
            if cut in counts:
                near[w].add(cut)
                near[cut].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return out


def as_set(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_variants(brute_vocabulary([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    got = QUERIES["op11_spelling_variants"](spark, "/root/testdata/sf0.01")
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert as_set(got) == want and sum(w[4] > 0 for w in want) > 100 and any(w[1] for w in want)


@pytest.mark.parametrize("large", [3, 10_000])
def test_variants_of_a_dense_vocabulary(spark, large):
    """Two letters only, so partitions are large and runs of equal letters abound; long words as well."""
    r = random.Random(5)
    words = {"".join(r.choice("ab") for _ in range(r.randint(5, 9))) for _ in range(300)}
    long = "xy" * 3000
    words |= {long, long[:-1], long[1:], "z" + long[1:], "a" * 200, "a" * 201, "a" * 202, "é" * 6, "éàéééé"}
    counts = {w: r.choice([3, 3, 4, 7, 20, 50, 400]) for w in sorted(words)}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), large=large)
    assert as_set(got) == brute_variants(counts)


def test_variant_cases(spark):
    rows = [(1, None), (2, ""), (None, "Wörter WöRTER Worter"), (None, "wörter wörter ×÷×÷× Zeile\nZeile"), (3, "zeile 'zeile' zeilen")] * 2
    docs = extra(frame(spark, rows))
    got = as_set(spelling.spelling_variants(docs))
    assert got == brute_variants(brute_vocabulary(rows)) and got
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


# --- phrase dedup --------------------------------------------------------------------------


def brute_phrases(rows, n=phrases.N):
    docs = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + n]) for w in docs for i in range(len(w) - n + 1))
    out = Counter()
    for (doc_id, _), w in zip(rows, docs, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i : i + n])] > 1:
                gone[i : i + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[doc_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def phrase_rows(df):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def passages(seed=1):
    """Texts that share passages of many lengths, at their ends and inside, with repeats in one text and copies."""
    r = random.Random(seed)
    fresh = lambda k: " ".join(r.choice(VOCABULARY) for _ in range(k))
    shared = [fresh(k) for k in (34, 35, 36, 51, 80, 300)]
    rows = [(i, None if i == 0 else "") for i in range(2)] + [(2, "one two"), (None, fresh(60)), (None, "a " * 200), (3, "b\tb " * 40)]
    for i in range(60):
        parts = [r.choice(shared) if r.random() < 0.5 else fresh(r.randint(1, 90)) for _ in range(r.randint(1, 5))]
        rows.append((10 + i, r.choice([" ", "\n", "  \t"]).join(parts)))
    rows += [(10 + i, t) for i, (_, t) in enumerate(rows[10:14])] + [(99, rows[20][1])] * 5
    rows += [(200 + i, fresh(3) + " " + shared[3] + " " + fresh(4)) for i in range(40)]  # one passage in many texts
    return rows


VOCABULARY = ["".join(random.Random(i).choice("abcdefghé,.") for _ in range(2 + i % 5)) for i in range(300)]


@pytest.mark.parametrize(("hot", "shard", "common"), [(phrases.HOT, phrases.SHARD, phrases._COMMON), (4, 16, 30)])
def test_phrases_match_brute_force(spark, monkeypatch, hot, shard, common):
    monkeypatch.setattr(phrases, "_COMMON", common)
    rows = passages()
    got = phrases.drop_phrases(extra(frame(spark, rows, 5)), hot, shard)
    want = brute_phrases(rows)
    assert phrase_rows(got) == want and sum(k[2] for k in want) > 1000
    assert {hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256 for r in got.collect()} == {True}


def test_phrase_cases(spark):
    docs = frame(spark, passages())
    assert phrases.drop_phrases(docs.limit(0)).count() == 0
    long = " ".join(VOCABULARY[(i * i) % 299] for i in range(60_000))  # periodic, very long
    rows = [(1, long), (2, "x" * 100_000), (3, None)]
    assert phrase_rows(phrases.drop_phrases(frame(spark, rows))) == brute_phrases(rows)


# --- ranked search -------------------------------------------------------------------------


def brute_search(rows, items, k=search.K):
    cut = lambda t: re.findall("[0-9a-z\u0080-\U0010ffff]+", (t or "").translate(LOW))
    docs = [(i, Counter(cut(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total, count = sum(n for _, _, n in docs), len(docs)
    df = Counter(t for _, c, _ in docs for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(cut(text))
    out = Counter()
    for item, terms in asked.items():
        scores = []
        for i, c, n in docs:
            m = 100 - 50 + (50 * n * count) // total
            s = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms if t in c
            )
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out.update((item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1))
    return out


def search_rows(df):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect())


def test_search_matches_brute_force(spark, monkeypatch):
    r = random.Random(8)
    rows = [(i, " ".join(r.choice(VOCABULARY[: r.choice([5, 40, 300])]) for _ in range(r.randint(1, 60)))) for i in range(400)]
    rows += [(0, None), (1, ""), (2, "--- !"), (None, rows[3][1]), (None, "Ünique TERM9"), (5, rows[5][1]), (5, rows[5][1]), (600, "abc " * 30_000)]
    items = [(i, " ".join(r.sample(VOCABULARY, r.randint(1, 30)))) for i in range(25)]
    items += [(None, "term9"), (3, "term9 more"), (100, None), (101, ""), (102, "absent-word"), (103, rows[7][1])]
    docs, asked = extra(frame(spark, rows, 4)), extra(spark.createDataFrame(items, "item_id long, text string"))
    want = brute_search(rows, items)
    monkeypatch.setattr(search, "SHARD", 500)
    assert search_rows(search.ranked_search(docs, asked)) == want
    assert search_rows(search.ranked_search(docs, asked, 3)) == brute_search(rows, items, 3)
    assert search_rows(search.ranked_search(docs, asked, block=60)) == want  # several blocks of queries
    assert search.ranked_search(docs.limit(0), asked).count() == 0 and search.ranked_search(docs, asked.limit(0)).count() == 0


def test_best_positions_stop_early_and_stay_exact():
    """Impacts that fall off: most of the lists stays unread, and ties at the end are kept by id."""
    r = np.random.default_rng(2)
    n, terms = 20_000, 3
    doc = np.concatenate([r.choice(n, 8_000, replace=False) for _ in range(terms)])
    term = np.repeat(np.arange(terms), 8_000)
    impact = np.floor(1000 / r.uniform(0.01, 1, len(doc))).astype(np.int64)
    shard = search.Shard(np.arange(n)[::-1].copy(), doc, term, impact, terms)
    top = search.Top(10)
    read = shard.search(np.arange(terms), top)
    scores = np.bincount(doc, impact, n).astype(np.int64)
    best = np.lexsort((np.arange(n)[::-1], -scores))[:10]
    assert top.ids.tolist() == (n - 1 - best).tolist() and top.scores.tolist() == scores[best].tolist()
    assert read < len(doc) / 4
    again = search.Top(10)
    shard.search(np.arange(terms), again)  # nothing is left over from a search
    assert again.ids.tolist() == top.ids.tolist()


@pytest.mark.parametrize("name", ["op12_phrase_dedup", "op13_ranked_search"])
def test_queries_match_sql(spark, name):
    assert difference(connect(SF), ORACLE_SQL[name], QUERIES[name](spark, SF)) is None
