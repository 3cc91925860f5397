"""Line dedup, the Jaccard join, decontamination and the pipeline: against brute force on whole small tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare, connect
from clickloom.llm import decontaminate, jaccard_join, line_dedup, quality_rules
from clickloom.llm.registry import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- registry ---

def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert entry.queries()["pipeline"] is QUERIES["pipeline"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, sf, name):
    ok, note = compare(spark, connect(sf), name, QUERIES[name], ORACLES[name], sf)
    assert ok, note


# --- line dedup ---

def plain_dedup(docs, fewest):
    """Texts without the maximal repeated runs of enough characters, by comparing every pair of places."""
    seqs = [(d, t.split("\n")) for d, t in sorted({(d, t) for d, t in docs if t is not None}, key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]
    out = {}
    for x, (d, a) in enumerate(seqs):
        gone = [False] * len(a)
        for i in range(len(a)):
            best = 0
            for y in range(x + 1):
                b = seqs[y][1]
                for j in range(len(b) if y < x else i):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                        n += 1
                    best = max(best, n)
            if sum(map(len, a[i:i + best])) >= fewest:
                gone[i:i + best] = [True] * best
        out[d] = ("\n".join(line for line, g in zip(a, gone) if not g), sum(gone))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_equals_brute_force(spark, seed):
    r = random.Random(seed)
    kinds = ["a", "bb", "c" * 10, "", "e" * 7, "long line " * 3, "é" * 24][:3 + 2 * seed]
    docs = [(i, "\n".join(r.choice(kinds) for _ in range(r.randint(1, 18)))) for i in range(20)]
    docs += [(100 + i, docs[i][1]) for i in range(4)] + [(101, docs[1][1]), (200, None), (201, ""), (None, docs[0][1])]
    df = spark.createDataFrame([(d, t, 7, "x") for d, t in docs], "doc_id long, text string, n_lines long, doc string")
    rows = line_dedup.dedup_lines(df).collect()
    want = plain_dedup(docs, line_dedup.MIN_CHARS)
    assert len(rows) == len(docs)
    for r in rows:  # columns by position: the names clash
        assert r[2:4] == (7, "x")
        assert r[1] == (want[r[0]][0] if r[0] != 200 else None)
        assert r[5] == (want[r[0]][1] if r[0] != 200 else 0)
        assert sum(x.end - x.start for x in r[6]) == r[5]
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_runs_are_maximal_and_do_not_overlap(spark):
    a, b, c = "first line of some length", "x", "third line of some length"
    df = spark.createDataFrame([(1, f"{a}\n{b}\n{c}\nend"), (2, f"own\n{a}\n{b}\n{c}"), (3, f"{b}\nown two")],
                               "doc_id long, text string")
    got = {r.doc_id: (r.text, [tuple(x) for x in r.runs]) for r in line_dedup.dedup_lines(df).collect()}
    # the short line goes with the run around it, and stays where it stands alone
    assert got == {1: (f"{a}\n{b}\n{c}\nend", []), 2: ("own", [(1, 4)]), 3: (f"{b}\nown two", [])}


def test_line_dedup_runs_no_python(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "doc_id long, text string")
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- Jaccard join ---

def shingles(text, width=4):
    w = WORD.findall(lower(text))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < width else frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def plain_components(docs, percent=85, width=4):
    sets = [(d, shingles(t, width)) for d, t in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(sets):
        groups.setdefault(find(i), []).append(d)
    return {d: (len(s), min(groups[find(i)])) for i, (d, s) in enumerate(sets)}


def near_copies(seed, words=300):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    docs = []
    for size in (2, 3, 5, 9, 30, 60, 60, 120, 150):
        base = [r.choice(vocabulary) for _ in range(size)]
        for _ in range(r.choice([1, 3, 9])):
            text = list(base)
            for _ in range(r.randint(0, size // 25)):
                text[r.randrange(size)] = r.choice(vocabulary)
            docs.append(" ".join(text + [r.choice(vocabulary)] * (r.random() < 0.2)))
    docs += [None, "", " \n", "Ab c", "aB c", docs[-1], docs[-1].upper()]
    r.shuffle(docs)
    return list(enumerate(docs, 10))


@pytest.mark.parametrize("frequent_from", [jaccard_join.FREQUENT_FROM, 3])
def test_components_equal_brute_force(spark, monkeypatch, frequent_from):
    monkeypatch.setattr(jaccard_join, "FREQUENT_FROM", frequent_from)
    docs = near_copies(frequent_from)
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, k int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect()}
    assert got == plain_components(docs)


def test_one_large_group_of_near_copies_and_repeated_rows(spark):
    r = random.Random(8)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(150):
        text = list(base)
        for _ in range(r.randint(0, 2)):
            text[r.randrange(110, 120) if i % 2 else r.randrange(120)] = f"n{r.random()}"
        docs.append((i, " ".join(text)))
    docs += [(1000 + i, " ".join(f"o{i}x{k}" for k in range(20)) + " " + " ".join(base[:20])) for i in range(20)]
    docs += [(2000, None), (2001, docs[0][1])]
    df = spark.createDataFrame(docs + docs[:30], "doc_id long, text string")
    rows = jaccard_join.jaccard_components(df).collect()
    assert len(rows) == len(docs) + 30
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain_components(docs)
    # only stars are verified inside the group, not all of its pairs
    assert sum(r.n_links for r in rows if r.doc_id < 150) / 2 < 150 * 149 / 4


def test_one_of_each_component_stays(spark):
    docs = near_copies(5)
    df = spark.createDataFrame([(t, d, "v") for d, t in docs] + [("alone", None, "v")], "text string, doc_id long, component_id string")
    out = jaccard_join.keep_one_each(df)
    assert out.columns == df.columns
    want = {d for d, (_, c) in plain_components(docs).items() if c == d}
    assert {r.doc_id for r in out.collect()} == want | {None}
    assert jaccard_join.keep_one_each(df.limit(0)).count() == 0


def test_bitmaps_bound_the_difference():
    r = np.random.default_rng(4)
    for _ in range(50):
        a = np.unique(r.integers(-(1 << 62), 1 << 62, r.integers(1, 300)))
        b = np.unique(np.concatenate((r.permutation(a)[:len(a) * 9 // 10], r.integers(-(1 << 62), 1 << 62, 9))))
        x, y = jaccard_join.parity_bitmap(a), jaccard_join.parity_bitmap(b)
        if len(x) != len(y):
            x, y = (x, y) if len(x) > len(y) else (y, x)
            x = x[:len(x) // 2] ^ x[len(x) // 2:]
        distance = sum(int(v & ((1 << 64) - 1)).bit_count() for v in (x ^ y).tolist())
        assert distance <= len(np.setxor1d(a, b))


def test_word_hashes_tell_words_apart():
    words = sorted({f"ción{a}{b}" for a in "abcdefgh" for b in range(300)} | {"x" * n for n in range(1, 400)})
    hashes, n = jaccard_join.word_hashes([" ".join(words).encode(), None, b"", b"A a"])
    assert n.tolist() == [len(words), 0, 0, 2] and len(set(hashes.tolist())) == len(words) + 1


# --- decontamination ---

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_contamination(docs, items, window=13):
    out = []
    parts = [(str(i) if i is not None else "", ITEM_WORD.findall(lower(t))) for i, t in items]
    for d, t in docs:
        words, hit, found, longest = ITEM_WORD.findall(lower(t)), set(), set(), 0
        for name, item in parts:
            width = min(window, len(item))
            for j in range(len(item) - width + 1 if width else 0):
                for p in range(len(words) - width + 1):
                    if words[p:p + width] == item[j:j + width]:
                        hit |= set(range(p, p + width))
                        found.add(name)
                        n = width
                        while j + n < len(item) and p + n < len(words) and words[p + n] == item[j + n]:
                            n += 1
                        longest = max(longest, n)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((d, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words), longest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 200])
def test_contamination_equals_brute_force(spark, block_bytes):
    r = random.Random(3)
    pool = ["the", "of", "a", "B", "c9", "é", "Zu"]
    items = [(i, " ".join(r.choice(pool) for _ in range(r.choice([1, 4, 13, 14, 30])))) for i in range(12)]
    items += [(3, "repeated item id with words of its own"), (40, None), (41, "?!"), (None, items[0][1]), items[1]]
    docs = []
    for i in range(30):
        words = [r.choice(pool + [f"x{r.randint(0, 99)}"] * 3) for _ in range(r.choice([0, 5, 40, 200]))]
        for _, t in r.sample(items[:13], 2):
            words[r.randint(0, len(words)):0] = t.split()
        docs.append((i, r.choice([" ", "-", "\n"]).join(words)))
    docs += [(90, None), (91, ""), (92, items[4][1] * 3), (93, "x " * 5000 + items[5][1]), docs[0]]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, n_hit int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(df, bench, block_bytes=block_bytes)
    rows = sorted((tuple(x)[:7] for x in got.collect()), key=repr)
    assert rows == plain_contamination(docs, items)
    kept = decontaminate.remove_contaminated(df, bench, block_bytes=block_bytes)
    assert kept.columns == df.columns
    assert Counter(x.doc_id for x in kept.collect()) == Counter(x[0] for x in rows if not x[5])
    assert not any(x[5] for x in decontaminate.contamination(df, bench.limit(0)).collect())
    assert decontaminate.contamination(df.limit(0), bench).count() == 0


def test_suffix_array_sorts_suffixes():
    r = np.random.default_rng(1)
    ids = np.append(r.integers(0, 3, 400), 0)
    at = np.flatnonzero(ids)
    text = ids.tolist()
    suffix = {p: text[p:text.index(0, p)] for p in at.tolist()}
    assert decontaminate.suffix_array(ids, at).tolist() == sorted(at.tolist(), key=lambda p: (suffix[p], p))


# --- pipeline ---

def test_pipeline_equals_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    text = {d[0]: d[1] for d in docs}
    kept = [d[0] for d in docs if quality_rules.judge(quality_rules.measure([d[1].encode()]))["kept"][0]]
    left = plain_dedup([(d, text[d]) for d in kept], line_dedup.MIN_CHARS)
    left = [(d, t) for d, (t, gone) in left.items() if not gone or WORD.search(t)]
    first = {d for d, (_, c) in plain_components(left, 80, 5).items() if c == d}
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {x[0] for x in plain_contamination([x for x in left if x[0] in first], items) if not x[5]}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == clean
    assert all(r.lossless for r in got.values())


def test_every_stage_on_odd_rows(spark, sf):
    """Nulls, repeated rows and columns named like the operators' own, stage by stage, texts included."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()][:120]
    docs += [(9001, None), (9002, ""), docs[3], docs[3], (9003, docs[5][1]), (None, docs[7][1] + " and more words here"),
             (9004, "one two three " * 400)]
    rows = [(d, t, f"r{i}", 7) for i, (d, t) in enumerate(docs)]
    names = ["doc_id", "text", "_removed", "_lines"]
    table = spark.createDataFrame(rows, "doc_id long, text string, _removed string, _lines int")
    kept = [r for r in rows if quality_rules.judge(quality_rules.measure([(r[1] or "").encode()]))["kept"][0]]
    stage = dict(corpus_pipeline.STAGES)

    def run(name, frame):
        out = stage[name](spark, frame, sf)
        assert out.columns == names
        return sorted((tuple(r) for r in out.collect()), key=repr)

    assert run("quality rules", table) == sorted(kept, key=repr)
    table = spark.createDataFrame(kept, table.schema)
    order = {d: i for i, d in enumerate(sorted({r[0] for r in kept}, key=lambda d: (d is not None, d)))}
    texts = sorted({(order[r[0]], r[1]) for r in kept})
    left = {d: t for d, (t, gone) in plain_dedup(texts, line_dedup.MIN_CHARS).items() if not gone or WORD.search(t)}
    lined = [(r[0], left[order[r[0]]], *r[2:]) for r in kept if order[r[0]] in left]
    assert run("line dedup", table) == sorted(lined, key=repr)
    table = spark.createDataFrame(lined, table.schema)
    found = plain_components(sorted({(r[0], r[1]) for r in lined if r[0] is not None}), 80, 5)
    first = {d for d, (_, c) in found.items() if c == d}
    one = [r for r in run("n-gram Jaccard join", table) if r[0] is not None]
    assert one == sorted((r for r in lined if r[0] in first), key=repr)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {x[0] for x in plain_contamination(sorted({(r[0], r[1]) for r in one}), items) if not x[5]}
    assert run("benchmark decontamination", spark.createDataFrame(one, table.schema)) == sorted(
        (r for r in one if r[0] in clean), key=repr)


@pytest.fixture
def low_skew_limits(spark):
    limits = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1",
              "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12"}
    before = {k: spark.conf.get(k, None) for k in limits}
    for k, v in limits.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_line_is_split(spark, low_skew_limits):
    rng = random.Random(5)
    # every document holds the same line several times, in many map tasks
    rows = [(i, "\n".join(x for _ in range(12) for x in ("", f"{rng.random()} some text", f"line {rng.randint(0, 300)}"))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(24)
    scratch = line_dedup.Scratch(spark)
    segments = line_dedup._segments(line_dedup._lines(docs, "doc_id", "text"), scratch)
    segments.collect()
    assert "skew=true" in segments._jdf.queryExecution().executedPlan().toString()


def test_stages_keep_the_columns_and_take_empty_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == 0
