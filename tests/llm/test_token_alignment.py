"""Cross-tokenizer alignment against the libraries and brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clickloom.llm import queries, token_alignment
from clickloom.llm.token_alignment import Aligned, ByteTokens, shared_cuts, vocabularies

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n", "a", "Été ½ x", "<|endoftext|> and <s> </s> <unk> <0x41>", "▁ lower eighth block", "=" * 5000,
       " " * 3000 + "x", "　日本語のテキスト。中文文本，没有空格。", "a\x00b\r\n\t", "é \U0001f600\U0001f468‍\U0001f469",
       "word " * 4000, "x" * 1023 + "y 1" * 400]


def letter_bytes():
    from tokenizers.pre_tokenizers import ByteLevel

    shown = [b for b in range(256) if chr(b).isprintable() and b not in (32, 127, 173) and not 127 <= b <= 160]
    letters = {chr(b): b for b in shown}
    letters |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    assert set(letters) == set(ByteLevel.alphabet())
    return letters


@pytest.fixture(scope="module")
def plain():
    """Brute force over all texts of a table."""
    library = Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = letter_bytes()

    def tokens(text):
        a = library.encode(" " + text, add_special_tokens=False)
        b = pieces.encode(text)
        a_bytes = [bytes(letters[c] for c in t) for t in a.tokens]
        names = [pieces.id_to_piece(i) for i in b]
        b_bytes = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in zip(b, names)]
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            return None
        return list(zip(a.ids, a_bytes)), list(zip(b, b_bytes))

    def spans(side):
        at = 0
        for i, x in side:
            yield i, at, at + len(x)
            at += len(x)

    def run(texts):
        made, held = [], Counter()
        for text in texts:
            both = tokens(text) if text else None
            if both is None:
                made.append(None)
                continue
            a, b = (list(spans(s)) for s in both)
            cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
            links, j = [], 0
            for i, s, e in a:
                while j and b[j][1] > s:
                    j -= 1
                while b[j][2] <= s:
                    j += 1
                while j < len(b) and b[j][1] < e:
                    links.append((i, b[j][0]))
                    j += 1
                j -= 1
            groups, x, y = [], 0, 0
            for cut in cuts:
                left, right = [], []
                while x < len(a) and a[x][2] <= cut:
                    left.append(str(a[x][0]))
                    x += 1
                while y < len(b) and b[y][2] <= cut:
                    right.append(str(b[y][0]))
                    y += 1
                groups.append(f"{','.join(left)}|{','.join(right)}")
            made.append((a, b, groups, links))
            held.update(set(links))
        most = defaultdict(int)
        for (i, _), n in held.items():
            most[i] = max(most[i], n)
        out = []
        for m in made:
            if m is None:
                out.append((0, 0, 0, 0, 0, 0, ""))
                continue
            a, b, groups, links = m
            out.append((len(a), len(b), len(groups), len(links), sum(held[p] == most[p[0]] for p in links),
                        sum(held[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest()))
        return out

    return run


def test_the_fast_encoder_is_the_library():
    made = ByteTokens(BYTES)
    assert made.fast is not None
    rng = random.Random(3)
    parts = ["'s", "'LL", " ", "  ", "\n", "\t ", " ", "Abc", "é", "é", "12", "١", "½", "!?", "<|endoftext|>",
             "\U0001f600", "中文", "\x00", "​", "_"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 12)))
        assert made.fast.encode_ordinary(text) == made.library.encode(text, add_special_tokens=False).ids, text


@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.sets(st.integers(1, 59)))
@settings(max_examples=300, deadline=None)
def test_shared_cuts_are_the_common_ends(a, b, breaks):
    # every interval ends at an end of both sides
    ends = sorted(breaks | {60})
    a, b = (np.array(sorted(x | set(ends))) for x in (a, b))
    at = [np.concatenate([[0], np.searchsorted(x, ends) + 1]) for x in (a, b)]
    got = shared_cuts(a, b, at[0][:-1], at[0][1:] - 1, at[1][:-1], at[1][1:] - 1)
    want = sorted((set(a.tolist()) & set(b.tolist())) - set(ends))
    assert a[got[0]].tolist() == want and b[got[1]].tolist() == want


def test_a_long_interval_without_cuts_is_one_leaf():
    a, b = np.arange(1, 200_000, 2), np.arange(2, 200_000, 2)
    one = lambda x: np.array([x])
    got = shared_cuts(a, b, one(0), one(len(a)), one(0), one(len(b)))
    assert len(got[0]) == len(got[1]) == 0


@pytest.mark.parametrize("frequent", [1 << 17, 3])
def test_odd_texts_equal_brute_force(spark, plain, frequent):
    texts = [*ODD, "Été ½ x", "the cat sat", "the cat sat on the mat", "the dog"]
    rows = [(i if i % 5 else None, t, "z", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, n_a int")
    got = token_alignment.alignment_counts(docs, BYTES, PIECES, carry=["doc_id", "n_a"], frequent=frequent)
    assert got.columns == ["doc_id", "n_a", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r[1]: tuple(r[2:]) for r in got.collect()}
    assert got == dict(enumerate(plain(texts)))
    assert got[0] == got[1] == (0, 0, 0, 0, 0, 0, "") and got[7][0] == 0  # U+2581 comes back as a space


def test_bytes_that_are_no_text_have_no_tokens():
    made = Aligned(vocabularies(BYTES, PIECES), [b"\xff\xfe", b"ok"])
    assert made.count(0).tolist()[0] == 0 and made.digests()[0] == ""


def test_groups_as_arrays(spark):
    text = "unbelievable tokenizers disagree"
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    row, none = token_alignment.align(docs, BYTES, PIECES).orderBy("doc_id").collect()
    known = vocabularies(BYTES, PIECES)
    at, seen = [0, 0], b""
    for ends in zip(row.a_ends, row.b_ends):
        parts = [b"".join(known.sides[s].bytes[i] for i in row["ab"[s]][at[s]:ends[s]]) for s in (0, 1)]
        assert parts[0] == parts[1] != b""
        seen, at = seen + parts[0], ends
    assert seen.decode() == " " + text and not none.a and not none.a_ends


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.alignment_counts(docs, BYTES, PIECES).count() == 0


def test_the_query_equals_brute_force(spark, sf, plain):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r[0]: tuple(r[1:]) for r in queries.op12(spark, sf).collect()}
    assert got == dict(zip(texts, plain(texts.values())))
