"""Spelling variants against brute force: counts, near words, forms and roots."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from clickloom.llm import queries, spelling_variants
from clickloom.llm.spelling_variants import Lists

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(rows, min_length=6, min_count=5, every=199):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{key}:{run}".encode())
            if key is not None and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def near(a, b):
    """Whether one edit makes one word the other."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    return a[1:] == b[1:] if len(a) == len(b) else a[1:] == b if len(a) > len(b) else a == b[1:]


def plain_variants(n, ratio=5):
    """Near words by all spellings with one place left out, then checked."""
    left = {}
    for w in n:
        for key in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            left.setdefault(key, []).append(w)
    mates = {w: set() for w in n}
    for group in left.values():
        for a in group:
            mates[a].update(b for b in group if near(a, b))
    form = {}
    for w, others in mates.items():
        if others:
            best = min(others, key=lambda o: (-n[o], o))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(mates[w]), n[form[w]] if w in form else None)
    return out


def collected(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


@given(st.lists(st.lists(st.text("ab", min_size=3, max_size=5), unique=True, min_size=1), min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_scans_find_every_pair_at_one_edit(lists):
    lists = [sorted(x) for x in lists]
    words = [w for x in lists for w in x]
    made = Lists(words, np.array([len(x) for x in lists]))
    for n in (3, 4, 5):
        asked = np.array([i for i, w in enumerate(words) if len(w) == n], np.int64)
        # a list holds words of one length and of one more
        fits = [w for w in words if len(w) in (n, n + 1)]
        if len(fits) < len(words):
            continue
        got = {(i, j) for i, j in zip(*(x.tolist() for x in made.scan(asked)))}
        first = np.cumsum([0, *map(len, lists)])
        want = {(i, j) for s, e in zip(first, first[1:]) for i in range(s, e) for j in range(s, e)
                if len(words[i]) == n and near(words[i], words[j])}
        assert got == want


@pytest.mark.parametrize("most", [4000, 3])
def test_variants_equal_brute_force(spark, most):
    rng = np.random.default_rng(5)
    words = {}
    for letters, size in (("ab", 6), ("abcé", 7), ("xyÿ", 9)):
        for _ in range(250):
            w = "".join(rng.choice(list(letters), size=rng.integers(size, size + 3)))
            words[w] = int(5 * 3 ** rng.integers(0, 7))
    words["w" * 5000], words["w" * 4999 + "v"] = 5, 400
    table = spark.createDataFrame([(w, n, 1) for w, n in words.items()], "word string, n long, near int")
    got = collected(spelling_variants.variants(table, most=most))
    assert got == plain_variants(words)
    assert any(got[w][1] not in (w, got[w][0]) for w in got)  # roots beyond the first form


def test_counts_of_odd_texts(spark):
    rows = [(1, "Straße STRASSE straße İstanbul naïveté×÷ CAFÉÉÉ ÉCOLES"), (2, None), (3, ""), (None, "Strasse strasse étudie"),
            (1, "Straße STRASSE straße"), (4, "x" * 30000 + " strasse_strasse-straße\nçççççç ﬁnally ŒUVRES"), (5, "abcdé" * 2000)]
    docs = spark.createDataFrame([(a, b, "w") for a, b in rows], "doc_id long, text string, word string")
    for every in (1, 2, 199):
        got = spelling_variants.word_counts(docs, min_count=1, slip_every=every)
        assert {r.word: r.n for r in got.collect()} == plain_counts(rows, 6, 1, every)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out = spelling_variants.variants(spelling_variants.word_counts(docs))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
    assert spelling_variants.variants(spelling_variants.word_counts(docs.limit(0))).count() == 0


def test_the_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert collected(queries.op11(spark, sf)) == plain_variants(plain_counts(rows))
