"""The text operators against brute force, round trips and defined edge cases."""

import hashlib
import math
import random
import re
import tracemalloc
import uuid
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, fingerprint, jaccard, lines, packing, ppm, quality, repeats, support, toxicity, warc
from tidemark.llm.components import components
from tidemark.llm.counting import pack, unpack
from tidemark.llm.queries import QUERIES
from tidemark.llm.support import _BASES, _BYTES, Rolling, _reduced, mix

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
RNG = random.Random(3)
VOCABULARY = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


LONG = prose(20_000, 99)
TEXTS = [
    None, "", " ", "one two", prose(120, 1), prose(120, 1), prose(118, 1), prose(60, 2) + "\n" + prose(80, 3),
    prose(80, 3) + "\n" + prose(70, 4), "x" * 1500, "ab" * 700, LONG, LONG + " more", "日本語" * 300, "ÄÖ äö\u0085 ü" * 90,
    "don't\t we'll  <|endoftext|> 12ab ½", "same\nsame\n\nsame", prose(5, 5), prose(4, 6),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "a" if i % 3 else None, None if t is None else len(t)) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def extra(df):
    """Columns that clash with the operators' own, and a row that repeats."""
    more = df.withColumns({"n": F.lit(1), "node": F.lit("x"), "score": F.lit("s"), "held_out": F.lit(2), "chunk": F.lit(0), "row": F.lit(9), "part": F.lit(1)})
    return more.unionAll(more.where("doc_id = 4"))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


# --- line dedup ----------------------------------------------------------------------------


def test_lines_match_sql(spark):
    con = duckdb.connect()
    sf = "/root/testdata/sf0.01"
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(lines.oracle_sql()).df().set_index("doc_id").sort_index()
    got = QUERIES["op1_line_dedup"](spark, sf).toPandas().set_index("doc_id").sort_index()
    assert (got[want.columns] == want).all().all() and got.n_dropped.sum() > 0


def test_line_cases(docs):
    out = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in lines.drop_boilerplate(extra(docs), max_ratio=0.01, min_pages=2).collect()}
    assert (0, None, 0, 0) in out and (1, "", 1, 0) in out
    assert (7, TEXTS[7].split("\n")[0], 2, 1) in out and (16, TEXTS[16], 3 + 1, 0) in out
    assert lines.drop_boilerplate(docs.limit(0)).count() == 0


# --- suffix dedup --------------------------------------------------------------------------


def brute_repeats(texts, size=repeats.LENGTH):
    seen = Counter(t[s : s + size] for t in texts for s in range(len(t) - size + 1))
    for t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - size + 1):
            if seen[t[s : s + size]] > 1:
                gone[s : s + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        yield len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()


def test_repeats_match_brute_force(docs):
    texts = [(t or "").encode() for t in TEXTS] + [TEXTS[4].encode()]
    want = sorted(brute_repeats(texts))
    got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.removed(extra(docs)).collect())
    assert got == want and sum(w[1] for w in want) > 2 * len(LONG)
    assert repeats.removed(docs.limit(0)).count() == 0


@pytest.mark.parametrize("range_bytes", [repeats.RANGE_BYTES, 2000])  # as many buckets as shuffle partitions, and more
def test_repeats_store_texts_once_and_shuffle_none(spark, docs, monkeypatch, tmp_path, range_bytes):
    monkeypatch.setattr(repeats, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(support, "scratch_path", lambda spark, name: f"{tmp_path}/{name}-{uuid.uuid4().hex}")
    # The plan is there before it runs, and no join is small enough for a broadcast.
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = repeats.removed(docs)
        columns = []

        def walk(node):
            if "Exchange" in node.nodeName():
                columns.append([c.split("#")[0] for c in node.output().mkString(" ").split()])
            for k in range(node.children().size()):
                walk(node.children().apply(k))

        walk(out._jdf.queryExecution().executedPlan())
        assert columns and not [c for c in columns if "text" in c]
        got = sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(brute_repeats([(r.text or "").encode() for r in docs.collect()]))
    assert sum("text" in spark.read.parquet(str(p)).columns for p in tmp_path.iterdir()) == 1
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_phrases_of_a_document_are_its_own():
    rng = np.random.default_rng(4)
    texts = [rng.integers(97, 100 + 20 * (n % 2), n).astype(np.uint8) for n in (0, 1, 134, 135, 136, 0, 700, 2000, 5, 135, 0)]
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    p = repeats.Phrases(np.concatenate(texts), offsets)
    alone = [repeats.Phrases(t, np.array([0, len(t)])) for t in texts]
    assert p.hashes.tolist() == [h for a in alone for h in a.hashes.tolist()]
    assert p.starts.tolist() == [s + o for a, o in zip(alone, offsets) for s in a.starts.tolist()]
    assert p.follows.tolist() == [f for a in alone for f in a.follows.tolist()]
    assert p.since.tolist() == [s + o for a, o in zip(alone, offsets) for s in a.since.tolist()]
    assert p.places.tolist() == [s + o for a, o in zip(alone, offsets) for s in a.places.tolist()]


def test_winnowing_by_blocks_is_exact_and_small():
    rng = np.random.default_rng(3)
    reach = repeats.WINDOW + repeats.GRAM - 1
    for size in (0, reach - 1, reach, repeats._BLOCK + reach - 1, repeats._BLOCK + reach, 3 * repeats._BLOCK):
        data = rng.integers(0, 3, size).astype(np.uint8)
        grams = [mix(np.frombuffer(data[i : i + repeats.GRAM].tobytes(), np.uint64)) >> np.uint64(32) for i in range(size - repeats.GRAM + 1)]
        keys = [(int(g[0]), -i) for i, g in enumerate(grams)]
        want = [-min(keys[i : i + repeats.WINDOW])[1] for i in range(size - reach + 1)]
        assert repeats.least_places(data).tolist() == want
    data = rng.integers(0, 256, 1 << 19).astype(np.uint8)
    tracemalloc.start()
    repeats.least_places(data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * len(data)  # the places themselves, eight bytes each, and one block's temporaries


def test_hashes_of_ranges_are_exact():
    prime, size = (1 << 31) - 1, 40_000
    for data in (np.full(size, np.argmax(_BYTES), np.uint8), np.random.default_rng(4).integers(0, 256, size).astype(np.uint8)):
        starts, ends = np.array([0, 0, 5, 16_383, 16_384, 39_999, 7]), np.array([size, 1, 39_000, 16_385, 32_769, size, 7])
        for s, e, got in zip(starts.tolist(), ends.tolist(), Rolling(data).ranges(starts, ends).tolist(), strict=True):
            both = [sum(int(_BYTES[c]) * pow(base, k, prime) for k, c in enumerate(data[s:e].tolist())) % prime for base in _BASES]
            want = (both[0] << 31 | both[1]) + (e - s) * 0x9E3779B97F4A7C15
            assert got == int(mix(np.array([want & (1 << 64) - 1], np.uint64))[0])
    x = [0, prime, prime + 1, 2 * prime, (1 << 62) - 1, 1 << 63, (1 << 64) - 1]
    assert _reduced(np.array(x, np.uint64)).tolist() == [v % prime for v in x]


def test_blocks_follow_the_transform():
    symbols = np.array([5, 7, 5, 7, 9, 5, 7], np.uint64)
    follows = np.array([False, True, True, True, True, False, True])
    order, before = repeats.suffix_order(symbols, follows)
    (one, _), (two, long) = repeats.block_names(symbols[order], before, 2)
    by = defaultdict(list)
    for place, at in enumerate(order):
        if long[place]:
            by[two[place]].append(int(at))
    assert sorted(sorted(v) for v in by.values()) == [[0, 2, 5], [1], [3]]


# --- archives ------------------------------------------------------------------------------


def test_archive_round_trip(spark):
    pages = [(1, "http://a", "same"), (2, None, "same"), (3, "u\r\nv WARC/1.1", "WARC/1.1\r\n" * 9), (4, "x", None), (5, "y", ""),
             (6, "z", "é" * 50_000), (7, "q", "\r\n\r\n0\r\n\r\n"), (None, "n", "lonely"), (2, None, "same")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("status", F.lit(1))
    got = sorted(map(tuple, warc.round_trip(df, segment_bytes=1000).collect()), key=str)
    last = {}
    for p, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), p if p is not None else -1)
    want = []
    for p, _, h in pages:
        raw, keep = (h or "").encode(), last[h or ""]
        revisit = sum((x[2] or "") == (h or "") for x in pages) > 1 and p != keep
        want.append((p, len(raw), warc.digest(raw), "revisit" if revisit else "response", keep if revisit else None, "ok"))
    assert got == sorted(want, key=str)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_broken_segments_are_reported(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame([(1, "u", "abc" * 4000)], "page_id long, url string, html string"), path, segment_bytes=3000)
    records = warc.read_records(spark, path).cache()
    whole = warc.payloads(records).first()
    assert whole.status == "ok" and bytes(whole.payload) == b"abc" * 4000
    assert warc.payloads(records.where("segment <> 2")).first().status == "segment numbers"
    assert warc.payloads(records.withColumn("total", F.col("total") + 1)).first().status == "total length"
    payload = b"a" * 20_000 + b"WARC/1.1\r\n"
    assert warc.unchunked(warc.chunked(payload)) == payload and warc.MARK not in warc.chunked(payload)


# --- language model ------------------------------------------------------------------------


@pytest.mark.parametrize("head", [ppm.HEAD, 50])
def test_ppm_matches_the_trie(docs, head):
    small = docs.where("doc_id NOT IN (11, 12)")
    got = {r.doc_id: r for r in ppm.scored(extra(small), order=3, head=head).collect()}
    texts = {i: t for i, t in enumerate(TEXTS) if i not in (11, 12)}
    train = [i for i in [*texts, 4] if zlib.crc32(str(i).encode()) % 7 != 2]
    trie, counts = ppm.Trie(3), Counter()
    for i in train:
        stream = bytes([ppm.PAD]) * 3 + (texts[i] or "").encode() + bytes([ppm.STOP])
        for k in range(3, len(stream)):
            trie.learn(stream[k - 3 : k], stream[k])
        counts.update([*words(texts[i]), None])
    n, v = sum(counts.values()), len(counts)
    for i, t in texts.items():
        own = [*words(t), None]
        assert got[i].score == pytest.approx(trie.text((t or "").encode(), False), rel=1e-9)
        assert got[i].base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert got[i].held_out == (i not in train)
    assert ppm.scored(docs.limit(0)).count() == 0


def test_adaptive_learns_from_its_own_text(docs):
    got = {r.doc_id: r.score for r in ppm.adaptive(docs.where("doc_id IN (1, 9)")).collect()}
    assert got[1] == pytest.approx(-math.log10(256)) and got[9] > -100


# --- packing -------------------------------------------------------------------------------


def test_packing_is_a_partition_of_all_ids(docs):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(packing.default_vocabulary())
    rows = packing.packed(docs, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    for i, t in enumerate(TEXTS):
        want = [*exact.encode(t or "", add_special_tokens=False).ids, 1]
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert [x for p in pieces for x in p.ids] == want and {p.doc_tokens for p in pieces} == {len(want)}
        assert [p.start for p in pieces] == list(np.cumsum([0, *[p.length for p in pieces[:-1]]]))
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == list(np.cumsum([0, *[p.length for p in pieces[:-1]]]))
        size = sum(p.length for p in pieces)
        assert size <= 2048 and size & (size - 1) == 0
    assert packing.packed(docs.limit(0)).count() == 0 and packing.packed(extra(docs)).count() >= len(rows)


# --- decontamination -----------------------------------------------------------------------


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 40])
def test_contamination_matches_brute_force(spark, docs, block):
    items = [(0, prose(60, 2)), (1, " ".join(prose(120, 1).split()[5:30])), (2, "one TWO"), (3, None), (4, "..."), (5, prose(60, 2)), (6, prose(5, 5))]
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = pattern.findall((t or "").translate(LOW))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(str(i))
    got = {r.doc_id: r for r in decontaminate.contamination(extra(docs), spark.createDataFrame(items, "item_id long, text string"), block).collect()}
    for i, t in enumerate(TEXTS):
        w = pattern.findall((t or "").translate(LOW))
        hit, found = set(), set()
        for n in range(1, 11):
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        want = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert (got[i].n_words, got[i].n_hit, got[i].n_items, got[i].items_sha256, got[i].contaminated) == (len(w), len(hit), len(found), want, bool(hit))
    assert any(r.n_hit for r in got.values())


# --- fingerprints --------------------------------------------------------------------------


@pytest.mark.parametrize("size", [fingerprint.RANGE_BYTES, 4000])
def test_fingerprints(docs, size):
    got = {r.doc_id: r for r in fingerprint.compared(docs, size).collect()}
    for i, t in enumerate(TEXTS):
        t, after = t or "", TEXTS[i - 1 if i else len(TEXTS) - 1] or ""
        cut = len(t) // 3
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - cut] + after[:cut]).encode()).hexdigest()
        assert got[i].n_chars == len(t) and 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
    assert got[4].fingerprint == got[5].fingerprint and got[5].near_next == 1.0 and got[1].near_edited == 1.0
    assert got[12].near_next > 0.9 and got[8].near_next < 0.5 < got[6].near_next + 0.5
    assert fingerprint.compared(docs.limit(0)).count() == 0 and fingerprint.compared(docs.where("doc_id = 4")).first().near_next == 1.0


def test_moving_text_changes_the_fingerprint(spark):
    a, b = prose(150, 7), prose(150, 8)
    df = spark.createDataFrame([(a + " " + b, b + " " + a)], "x string, y string")
    near = fingerprint.with_fingerprints(df, {"p": "x", "q": "y"}).select(fingerprint.likeness("p", "q")).first()[0]
    assert near < 0.85  # the same words, moved: a set's likeness would be about 1


# --- near duplicates -----------------------------------------------------------------------


def brute_components(texts):
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in ((i, words(t)) for i, t in texts.items())}
    root = {i: i for i in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_components_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 3)
    r, texts = random.Random(4), {}
    for k in range(12):
        base = prose(r.choice([30, 60, 200]), 100 + k).split()
        for _ in range(8):
            own = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                own[r.randrange(len(own))] = "changed"
            texts[len(texts)] = " ".join([*own, *prose(r.choice([0, 0, 4]), r.random()).split()])
    texts |= {1000 + i: t for i, t in enumerate(TEXTS)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").withColumn("node", F.lit(1))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df).collect()}
    want = brute_components(texts)
    assert got == want and len({c for _, c in want.values()}) < len(want) - 30
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_group_matrix_alone_finds_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    base = prose(100, 50).split()
    texts = {k: " ".join([*base[:k], "x", *base[k + 1 :]]) for k in range(0, 100, 9)}
    got = jaccard.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in brute_components(texts).items()}


def test_long_chain_is_one_component(spark):
    chain = spark.range(40).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in components(chain).collect()} == {0}


def test_packed_steps():
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 32, 500, dtype=np.uint64)).astype(np.uint32)
    assert (unpack(pack(values)) == values).all() and len(unpack(pack(values[:0]))) == 0
    assert unpack(pack(np.array([0, 0, 65535, 131070], np.uint32))).tolist() == [0, 0, 65535, 131070]


# --- classifiers ---------------------------------------------------------------------------


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_held_out_labels(spark, docs, module, label):
    sf = "/root/testdata/sf0.1"
    table, marks = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    labelled = table.join(marks.select("doc_id"), "doc_id")
    got = module.scored(labelled, marks).join(marks, "doc_id").where("held_out")
    kinds = {r[label]: r.ok for r in got.groupBy(label).agg(F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("ok")).collect()}
    assert kinds[0] > 0.95 and kinds[1] > 0.95
    none = module.scored(extra(docs), marks.limit(0)).collect()
    assert len(none) == len(TEXTS) + 1 and {r.score for r in none} == {0.5}
    assert module.scored(docs.limit(0), marks.limit(0)).count() == 0


def test_misspellings_share_ngrams():
    r = random.Random(5)
    bad = ["wretchedly", "gruesome"]
    toxic = [" ".join([*prose(30, 200 + k).split(), r.choice(bad), *prose(10, 900 + k).split()]) for k in range(150)]
    clean = [prose(40, 2000 + k) for k in range(150)]
    model = toxicity.fit([np.frombuffer(t.encode(), np.uint8) for t in toxic + clean], np.array([1] * 150 + [0] * 150))
    folded, _ = model.folded()

    def word(w):
        _, n, ids, buckets = toxicity.subwords(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))
        return toxicity.word_scores(folded, ids, buckets, n)[0]

    usual = np.mean([word(w) for w in VOCABULARY])
    assert word("wretchedli") > usual and word("gruesomme") > usual and word("gruesome") > word("gruesomme")


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, SF)
        assert kept.columns == docs.columns, name
        ids = {r.doc_id for r in kept.collect()}
        if name == "near_duplicates":
            want = brute_components({r.doc_id: r.text for r in before.collect()})
            assert ids == {i for i, (_, c) in want.items() if c == i}
        if name == "line_dedup":
            assert ids == {r.doc_id for r in before.collect()}
        assert ids <= set(texts)
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ids
