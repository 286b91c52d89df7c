"""Cases that once went wrong: long words of two letters, texts at old borders, rows without ids, broken records."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, fingerprint, jaccard, lines, packing, ppm, warc
from tidemark.llm import components as parts
from tidemark.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def twins(size=2048):
    """Two words of two letters that differ in every place; sums of powers modulo 2**64 cannot tell them apart."""
    a, b = "a", "b"
    while len(a) < size:
        a, b = a + b, b + a
    return a, b


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], SCHEMA).repartition(3)


# --- one hash, five operators ----------------------------------------------------------------


def test_jaccard_does_not_link_different_long_words(spark):
    a, b = twins()
    docs = frame(spark, [(1, " ".join([a] * 9), "x"), (2, " ".join([b] * 9), "x"), (3, " ".join([a] * 10), "x")])
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_decontamination_tells_long_words_apart(spark):
    a, b = twins()
    docs = frame(spark, [(1, f"{a} one two three four five six seven eight nine", "x"), (2, f"{b} one two three four five six seven eight nine", "x")])
    items = spark.createDataFrame([(7, f"{a} one two three four five six seven eight nine")], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.items) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (10, ["7"]), 2: (0, [])}


def test_scoring_does_not_know_an_unseen_long_word(spark):
    a, b = twins()
    train = next(i for i in range(100) if __import__("zlib").crc32(str(i).encode()) % 7 != 2)
    held = next(i for i in range(100) if __import__("zlib").crc32(str(i).encode()) % 7 == 2)
    docs = frame(spark, [(train, f"{a} plain", "x"), (held, f"{b} plain", "x")])
    got = {r.doc_id: r.n_known for r in ppm.scored(docs).collect()}
    assert got == {train: 3, held: 2}  # the word and the end, not the twin


def test_packing_ids_of_long_words(spark):
    from tokenizers import Tokenizer

    a, b = twins()
    rows = [(1, f"{a} {b} {a}", "x"), (2, f"{b}{a}", "x"), (3, " ".join([b, a] * 3), "x")]
    exact = Tokenizer.from_file(packing.default_vocabulary())
    exact.encode_special_tokens = True
    got: dict = {}
    for r in packing.packed(frame(spark, rows), with_ids=True).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.ids))
    for i, text, _ in rows:
        ids = [x for _, part in sorted(got[i]) for x in part]
        assert ids == [*exact.encode(text, add_special_tokens=False).ids, packing.END]


# --- fingerprints at old borders -------------------------------------------------------------


def likeness(spark, a, b):
    rows = spark.createDataFrame([(a, b)], "a string, b string")
    both = fingerprint.with_fingerprints(rows, {"fa": "a", "fb": "b"})
    return both.select(fingerprint.likeness("fa", "fb").alias("x")).first().x


@pytest.mark.parametrize("size", [60, 380, 399, 400, 401, 420, 2000])
def test_no_length_changes_the_kind_of_fingerprint(spark, size):
    words = [hashlib.md5(str(i).encode()).hexdigest()[:6] for i in range(400)]
    text = " ".join(words)[:size].strip()
    assert likeness(spark, text, text[:-2]) > 0.5
    third = len(text) // 3
    assert likeness(spark, text, text[:-third]) > 0.2
    assert likeness(spark, text, " ".join(reversed(words))[:size]) < 0.3


def plain_fingerprint(pairs):
    """What is selected, in plain Python, from hashes of the k-mers in text order."""
    n, places = fingerprint.TUPLES * fingerprint.WIDTH, {}
    seen: dict = {}
    for at, h in enumerate(pairs):
        key = (h, seen.setdefault(h, 0))
        seen[h] += 1
        places[at] = key
    return n, places


def test_equal_kmers_are_numbered_and_order_counts(spark):
    assert plain_fingerprint(["x", "y", "x"])[1] == {0: ("x", 0), 1: ("y", 0), 2: ("x", 1)}
    words = [hashlib.md5(str(i).encode()).hexdigest()[:5] for i in range(120)]
    text = " ".join(words)
    assert likeness(spark, text, text) == 1.0
    assert likeness(spark, text, " ".join(words[60:] + words[:60])) < 0.9  # the same k-mers but one, in another order
    assert likeness(spark, text, text + " " + text) < 0.9  # repeats are k-mers of their own
    assert likeness(spark, "one", "one") == 1.0 and likeness(spark, "one", "two") == 0.0 and likeness(spark, "", "") == 1.0


# --- broken archives ---------------------------------------------------------------------------


def test_broken_records_come_back_with_a_status(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "hello"), (2, "v", "world")], "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "archive")
    warc.write_archives(pages, path)
    raw = "\r\n".join(r.value for r in spark.read.option("lineSep", "\r\n").text(path).collect()) + "\r\n"
    changed = [
        raw.replace("Content-Length: ", "Content-Length: x", 1),
        re.sub(r"Content-Length: \d+", "Content-Length: 99999999999999999999999", raw, count=1),
        raw.replace("WARC-Type: response", "WARC-Type: response\r\nWARC-Segment-Number: two", 1),
        re.sub(r"Content-Length: \d+", "Content-Length: -5", raw, count=1),
    ]
    for i, text in enumerate(changed):
        target = tmp_path / f"broken-{i}"
        target.mkdir()
        (target / "a.warc").write_bytes(text.encode())
        got = warc.read_records(spark, str(target)).collect()
        assert any(r.status != "ok" for r in got), i
        assert any(r.status == "ok" for r in got), i
    target = tmp_path / "bytes"
    target.mkdir()
    (target / "a.warc").write_bytes(raw.encode().replace(b"WARC-Target-URI: u", b"WARC-Target-URI: \xff\xfe", 1))
    assert warc.read_records(spark, str(target)).count() >= 2


# --- pipeline edges ------------------------------------------------------------------------------


def prose(seed, n=80):
    r = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in r.integers(0, 500, n))


def test_near_duplicates_by_row_and_not_by_id(spark):
    one, two = prose(1), prose(2)
    near = one + " w1"
    rows = [(1, one, "x"), (1, one, "x"), (1, one, "x"), (2, near, "x"), (None, one, "x"), (3, two, "x"), (3, prose(3), "x"),
            (None, prose(4), "x"), (None, prose(4), "x"), (5, None, "x"), (6, "", "x"), (7, "", "x"), (8, " ", "y")]
    docs = frame(spark, rows)
    got = jaccard.one_of_each(docs)
    assert got.columns == docs.columns
    kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got.collect())
    want = [(1, one), (3, two), (3, prose(3)), (None, prose(4)), (5, ""), (6, ""), (7, ""), (8, " ")]
    assert kept == sorted((i is None, i or 0, t) for i, t in want)


@pytest.mark.parametrize("block", [decontaminate.BLOCK, 1])
def test_decontamination_has_one_python_worker_a_task(spark, block):
    # Each step in Python takes a worker of its own, which lives on beside the others in its executor.
    item = "one two three four five six seven eight nine ten eleven"
    docs = frame(spark, [(1, f"before {item} after", "x"), (2, "none of it", "x"), (3, None, "x")])
    found = decontaminate.contamination(docs, spark.createDataFrame([(7, item)], "item_id long, text string"), block)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {r.doc_id: (r.n_words, r.n_hit, r.items) for r in found.collect()} == {1: (13, 11, ["7"]), 2: (3, 0, []), 3: (0, 0, [])}


def test_contaminated_rows_go_whatever_their_id(spark):
    bad, good = prose(5), prose(6)
    items = spark.createDataFrame([(1, bad)], "item_id long, text string")
    docs = frame(spark, [(None, bad, "x"), (None, bad, "x"), (4, bad + " more", "x"), (4, good, "x"), (None, good, "x"), (5, None, "x")])
    got = decontaminate.clean(docs.withColumn("n_hit", F.lit(9)), items)
    assert got.columns == [*docs.columns, "n_hit"]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got.collect()) == sorted(
        [(False, 4, good), (True, 0, good), (False, 5, "")]
    )


def test_cleaned_lines_keep_the_columns_of_the_user(spark):
    rows = [(i, f"own line {i}\nfooter", "host") for i in range(30)]
    docs = frame(spark, rows).withColumns({"n_dropped": F.lit(7), "n_lines": F.lit("mine")})
    got = lines.cleaned(docs)
    assert got.columns == docs.columns
    for r in got.collect():
        assert (r.text, r.n_dropped, r.n_lines, r.n_chars) == (f"own line {r.doc_id}", 7, "mine", len(r.text))


def test_stages_handle_an_empty_table(spark, tmp_path):
    docs = frame(spark, [(1, "x", "y")]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0, name


@pytest.mark.parametrize(("task_links", "most"), [(parts.TASK_LINKS, 6), (0, 20)])
def test_components_with_few_jobs(spark, monkeypatch, task_links, most):
    # The driver holds a thread for every exchange of the last minute and the plan of every job, and each exchange is a job here.
    monkeypatch.setattr(parts, "TASK_LINKS", task_links)
    r = np.random.default_rng(6)
    links = [(int(a), int(b)) for a, b in r.integers(0, 400, (260, 2))]  # trees, hubs, cycles and loops
    links += [(1000, k) for k in range(1001, 1100)] + [(k + 1, k) for k in range(2000, 2040)] + [(7, 7), (3000, 3000)]
    root = {x: x for link in links for x in link}
    for a, b in links * 60:
        root[a] = root[b] = min(root[a], root[b])
    frame_of = spark.createDataFrame(links, "a long, b long")
    context = spark.sparkContext
    context.setJobGroup("components", "")
    try:
        got = components(frame_of)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(context.statusTracker().getJobIdsForGroup("components"))
    assert sorted((x.node, x.root) for x in got.collect()) == sorted((n, m) for n, m in root.items() if n != m)
    assert jobs <= most
    # Groups that were found stand for the links that made them.
    tree = max(n for n in root if n < 400)
    more = components(got.toDF("a", "b").unionAll(spark.createDataFrame([(1050, 2039), (2000, tree)], "a long, b long")))
    low = {root[1050], root[2039], root[tree]}
    both = {n: min(low) if m in low else m for n, m in root.items()}
    assert sorted((x.node, x.root) for x in more.collect()) == sorted((n, m) for n, m in both.items() if n != m)
    assert components(frame_of.where("a = b")).count() == 0


def test_texts_in_no_group_are_not_moved(spark):
    rows = [(k, prose(k, 300), "x") for k in range(20)] + [(20 + k, prose(0, 300), "x") for k in range(3)]
    kept = jaccard.one_of_each(frame(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(20))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold") if spark.conf.get(k, None)}
    try:  # as if the groups were too many for a broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = jaccard.one_of_each(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "BroadcastHashJoin" in plan
        assert sorted(r.doc_id for r in jaccard.one_of_each(frame(spark, rows)).collect()) == list(range(20))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
