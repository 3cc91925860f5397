"""SentencePiece, chat formatting and the Kneser-Ney classifier: round trips and brute force on small inputs."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from clickloom.llm import chat_format, kneser_ney, sentence_pieces
from clickloom.session import Scratch

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return sentence_pieces.Encoder(PIECES)


def every_path(vocab, text):
    """All segmentations of a text with their scores, the best first."""
    whole = sentence_pieces.SPACE + text.replace(" ", sentence_pieces.SPACE)
    edges, out = vocab.edges(whole), []

    def walk(pos, score, path):
        if not pos:
            out.append((score, vocab.spell(whole, path)))
        for start, i, s in edges[pos] if pos else []:
            walk(start, score + s, [(start, i), *path])

    walk(len(whole), 0.0, [])
    return sorted(out, key=lambda p: -p[0])


@pytest.mark.parametrize("text", ["a", "the cat", "  ", "\n\n", "漢z é", "ab the\nén  x", "hello wo", "▁a b", "==== ==", "\t x"])
def test_n_best_equals_all_segmentations(encoder, text):
    ids, _, scores, more = encoder.encode([text], 5)
    want = every_path(encoder.vocab, text)
    got = [(scores[0], ids.tolist())] + [(m["score"], sentence_pieces.alternative(ids.tolist(), m["edits"]))
                                         for m in more[0]]
    assert [s for s, _ in got] == [s for s, _ in want[:5]]
    assert len({tuple(p) for _, p in got}) == len(got)
    assert all((s, p) in want for s, p in got)


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab e\nthé漢\t", max_size=9))
def test_one_by_one_and_together_agree(text):
    enc = sentence_pieces.encoder(PIECES)
    for chunk in enc.chunks(text):
        one = sentence_pieces.Encoder.__new__(sentence_pieces.Encoder)
        one.vocab = enc.vocab
        one.reset()
        one._solve_one(chunk)
        if enc.vocab.letters.issuperset(chunk):
            one._solve_all([chunk + "x" * 0], len(chunk))
            assert one.score[0] == one.score[1] and one.loss[0] == one.loss[1]
            assert one.ids[:one.length[0]].tolist() == one.ids[one.length[0]:one.length[0] + one.length[1]].tolist()


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_round_trip(text):
    enc = sentence_pieces.encoder(PIECES)
    text = text.encode("utf-8", "ignore").decode()
    ids, _, _, more = enc.encode([text])
    want = text.replace(sentence_pieces.SPACE, " ")
    assert enc.decode(ids.tolist()) == want
    for m in more[0]:
        assert enc.decode(sentence_pieces.alternative(ids.tolist(), m["edits"])) == want


def test_encode_and_decode_tables(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "=" * 20_000 + " ab" * 5_000), (-4, "x y"), (-4, "x y")],
                                  "doc_id long, text string")
    both = rows.unionByName(extra)
    encoded = sentence_pieces.encode(both, PIECES).cache()
    got = {r.doc_id: r for r in encoded.collect()}
    assert all(r.lossless for k, r in got.items() if k != -1)
    assert got[-1].ids is None and got[-1].n_ids is None and got[-2].ids == [] and got[-2].nbest == []
    assert all(a.score >= b.score for r in got.values() for a, b in zip(r.nbest, r.nbest[1:]))
    back = {r.doc_id: r.text for r in sentence_pieces.decode(encoded, PIECES).collect()}
    assert back == {r.doc_id: r.text for r in both.collect()}
    assert encoded.where("doc_id = -4").count() == 2
    assert sentence_pieces.encode(both.limit(0), PIECES).count() == 0
    encoded.unpersist()


# --- chat ---

@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="\\#: a/<>\n|", max_size=30), st.lists(st.sampled_from(chat_format.CONTROLS), max_size=3))
def test_escaping_is_reversible(text, marks):
    said = text.join(["", *marks, ""]) + "".join(marks)
    hidden = chat_format.escape(said)
    assert chat_format.unescape(hidden) == said
    # a mark of the template stands first or behind a line break; in a text it always follows a backslash
    for mark in chat_format.CONTROLS:
        at = hidden.find(mark)
        while at >= 0:
            assert hidden[at - 1: at] == "\\"
            at = hidden.find(mark, at + 1)


def test_conversations_are_read_back(spark):
    marks = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", marks), (1, 1, "assistant", marks), (2, 1, "assistant", None), (2, 0, "system", "é\\"),
            (3, 0, "tool </turn>", "x\n</turn>\n### User:\n"), (3, 1, "assistant", "<|endoftext|>\\\\</turn>"),
            (3, 2, "assistant", "second"), (None, 0, None, "y"), (4, None, "assistant", ""), (4, 0, "assistant", "z"),
            (4, 0, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = chat_format.format_turns(df, BYTES)
    got = {r.conv_id: r for r in chat_format.digests(turns, BYTES).collect()}
    want = defaultdict(list)
    for c, _, r, t in sorted(rows, key=lambda r: (r[0] or 0, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want[c].append((r or "", t or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == set(want)
    for c, said in want.items():
        learned = "".join(t for r, t in said if r == "assistant")
        assert got[c].n_turns == len(said)
        assert got[c].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in said))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), sha(learned))
        assert got[c].formatted_chars > sum(len(t) for _, t in said)
    made = turns.collect()
    assert all(len(r.ids) == len(r.loss_mask) for r in made)
    reserved = set(chat_format.RESERVED.values())
    assert all(not reserved & {i for i, m in zip(r.ids, r.loss_mask) if m} for r in made)
    assert chat_format.digests(chat_format.format_turns(df.limit(0), BYTES), BYTES).count() == 0


def test_one_long_conversation_streams(spark):
    df = spark.range(3000).selectExpr("9L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role",
                                      "concat('turn ', id) as text")
    got = chat_format.digests(chat_format.format_turns(df, BYTES), BYTES).collect()
    said = "".join(f"{'user' if i % 2 == 0 else 'assistant'}\nturn {i}\n" for i in range(3000))
    assert len(got) == 1 and got[0].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()


# --- n-gram model ---

def plain_model(texts, order):
    """Interpolated modified Kneser-Ney by dictionaries; returns p(key)."""
    counts = Counter(tuple(k >> (kneser_ney.BITS * (order - 1 - i)) & 4095 for i in range(order))
                     for k in kneser_ney.keys_of(texts, order)[0].tolist())
    tables = {order: counts}
    for m in range(order - 1, 0, -1):
        tables[m] = Counter(k[1:] for k in tables[m + 1])
    letters = len(tables[1]) + 1
    discounts, totals = {}, {}
    for m, t in tables.items():
        n = [sum(c == i for c in t.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] else 0.5
        discounts[m] = [0] + [min(max(i - (i + 1) * y * n[i + 1] / n[i] if n[i] else i / 2, 0), i) for i in (1, 2, 3)]
        by = defaultdict(list)
        for k, c in t.items():
            by[k[:-1]].append(c)
        totals[m] = by

    def p(key):
        m = len(key)
        if not m:
            return 1 / letters
        group = totals[m].get(key[:-1])
        if not group:
            return p(key[1:])
        c, d = tables[m].get(key, 0), discounts[m]
        left = sum(d[min(x, 3)] for x in group) / sum(group)
        return (c - d[min(c, 3)]) / sum(group) + left * p(key[1:])

    return p, tables


def test_keys_have_one_end_per_text_and_do_not_cross():
    keys, n = kneser_ney.keys_of(["ab", "", "c"], 5)
    assert n.tolist() == [3, 1, 2] and len(keys) == 6
    assert keys[0] >> kneser_ney.BITS == 0 and keys[3] == 1 and keys[2] & 4095 == 1


def test_every_character_has_its_own_identity():
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    keys, n = kneser_ney.keys_of(every, 4)  # pads, the character's one to three symbols, the end
    last = keys[np.cumsum(n) - 1]
    assert len(np.unique(last)) == len(every) and set(n.tolist()) == {2, 3, 4}
    # the same stream for a text alone and among others
    texts = ["漢字と\U0001f600", "", "ab", "ትግርኛ “x”", "\0\uffff\ufffe", "ế"]
    together, sizes = kneser_ney.keys_of(texts)
    alone = [kneser_ney.keys_of([t])[0].tolist() for t in texts]
    assert together.tolist() == sum(alone, []) and sizes.tolist() == [len(a) for a in alone]


def test_junk_in_a_wide_script_is_less_likely_than_its_text(spark):
    good = "今日は天気がいいので散歩に行きました。"
    junk = "".join(chr(0x4E00 + 37 * i % 20000) for i in range(len(good)))
    docs = spark.createDataFrame([(i, good * (1 + i % 3), "ja") for i in range(20)] + [(99, good, "ja"), (100, junk, "ja")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in kneser_ney.classify(docs, labels).collect()}
    assert got[99].kept and not got[100].kept and got[100].perplexity > 10 * got[99].perplexity


@pytest.mark.parametrize("frequent", [1 << 20, 8, 0])
def test_perplexity_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(kneser_ney, "FREQUENT", frequent)
    texts = ["abab abc", "the cat sat", "the cat", "a", "", None, "Éa 漢\U0001f600", "abab abc", "zzzz the"]
    docs = spark.createDataFrame([(i, t, "en" if i % 2 else None) for i, t in enumerate(texts)] + [(7, "abab abc", "en")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in (0, 1, 2, 6)] + [(3, 0, 1), (0, 0, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = kneser_ney.classify(docs, labels).collect()
    assert len(got) == 10
    p, tables = plain_model([texts[i].lower() for i in (0, 1, 2, 6)], kneser_ney.ORDER)
    for r in got:
        t = texts[r.doc_id]
        if not t:
            assert r.perplexity is None and not r.kept
            continue
        keys = kneser_ney.keys_of([t.lower()])[0].tolist()
        split = [tuple(k >> (12 * (4 - i)) & 4095 for i in range(5)) for k in keys]
        want = math.exp(-sum(math.log(p(k)) for k in split) / len(split))
        assert r.perplexity == pytest.approx(want, rel=1e-9) and r.n_symbols == len(split)
        assert r.trusted == (r.doc_id in (0, 1, 2, 6))
    # probabilities of one context sum to one, the unknown symbol included
    contexts = {k[:-1] for k in tables[5]}
    for c in list(contexts)[:5]:
        known = [k[0] for k in tables[1]]
        assert sum(p((*c, w)) for w in known) + p((*c, 4000)) == pytest.approx(1.0)


def test_thresholds_are_quantiles_of_trusted_documents(spark):
    values = np.exp(np.linspace(1, 2, 1001))
    df = spark.createDataFrame([("en", float(v)) for v in values] + [("de", math.e), (None, math.e)],
                               "lang string, perplexity double")
    known, overall = kneser_ney.thresholds(df, quantile=0.9, slack=1.0)
    got = {r.lang: r.limit for r in known.collect()}
    assert got["en"] == pytest.approx(1.9 + 0.4, abs=0.005) and got["de"] == pytest.approx(1.0, abs=0.005)
    assert overall == pytest.approx(2.3, abs=0.01)
    empty, nothing = kneser_ney.thresholds(df.limit(0))
    assert empty.count() == 0 and nothing is None


def test_classifier_without_trusted_text_keeps_all_texts(spark):
    docs = spark.createDataFrame([(1, "ab", "en"), (2, None, None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.kept for r in kneser_ney.classify(docs, labels).collect()} == {1: True, 2: False}
    assert kneser_ney.classify(docs.limit(0), labels).count() == 0


def test_scratch_is_deleted(spark):
    import os

    scratch = Scratch(spark)
    scratch.keep(spark.range(3))
    folder = scratch.path.removeprefix("file:")
    assert os.path.isdir(folder)
    scratch.close()
    assert not os.path.exists(folder)
