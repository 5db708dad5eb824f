"""Token files and packing: exact round trips against the tokenizers library."""

import re
import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loadsmith.llm import _tokens, packing, token_files
from loadsmith.llm._tokens import SegmentEncoder, text_batches, tokenizer_path

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = ["", " ", "\n\n", "a", "It's  THE end.\r\n\tx ", "İ̸ Σς é é ", " 　﻿", "\x1c\x85\xa0x", "<|endoftext|> b",
       "word " * 30_000, "x" * 5_000, "中文ه😀 'll 12345", "中文 漢字。 한국어 Слово ёж ΣΟΦΟΣ σοφος ª²½ Ǆ‒—“quoted”…", "a\u00a0b a\u2009b \x0b\x0c", "I'LL you're 's's"]
SCHEMA = "doc_id long, text string, ids int, start string"
ROWS = [(i, t, 1, "s") for i, t in enumerate(ODD)] + [(None, "no id", 2, "s"), (3, "a", 3, None), (3, "a", 3, None), (99, None, 4, "x")]


@pytest.fixture(scope="module", params=FILES)
def enc(request):
    return SegmentEncoder(tokenizer_path(request.param), pieces=50)


def library(enc, texts):
    return [np.asarray(e.ids, "<u4").tobytes() for e in enc.tok.encode_batch(texts, add_special_tokens=False)]


def test_odd_texts_encode_as_the_library_does(enc):
    assert enc.rule
    assert enc.encode(ODD) == library(enc, ODD)
    assert enc.encode(ODD) == library(enc, ODD)         # now from a cache that had to forget


def test_known_characters_are_alike_everywhere():
    """Lower case stays among them and needs no context; composing changes none; classes are as in Unicode."""
    letter, mark = re.compile(f"[{_tokens.LETTERS}]").fullmatch, re.compile(f"[{_tokens.MARKS}]").fullmatch
    for c in map(chr, (*range(0xD800), *range(0xE000, 0x11000))):
        if letter(c):
            assert unicodedata.category(c)[0] == "L" and letter(c.lower()) and unicodedata.is_normalized("NFC", c)
        if mark(c):
            assert unicodedata.category(c)[0] not in "LNZM" and not c.isspace() and c.lower() == c
            assert unicodedata.is_normalized("NFC", c)


FRESH: dict = {}


def fresh_library(file, texts):
    """By the contract: the file as it is, no flag changed, nothing added at the ends."""
    if file not in FRESH:
        FRESH[file] = Tokenizer.from_file(tokenizer_path(file))
    tok = FRESH[file]
    return [np.asarray(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "in<|endoftext|>side", "one\n<|startoftext|>\ntwo", "<|EndOfText|> x",
           "<|endoftext|><|endoftext|>", " <|endoftext|>", "<|endoftext", "|>", "It's <|endoftext|>'s É\u0301", "plain words",
           "<|endoftext|>\u0338 <|startoftext|>\u00e9", "<|endo\u0130ftext|>"]


@pytest.mark.parametrize("file", FILES)
def test_special_tokens_in_a_text_have_their_own_ids(file):
    e = SegmentEncoder(tokenizer_path(file))
    assert e.rule
    assert e.encode(SPECIAL + ODD) == fresh_library(file, SPECIAL + ODD)
    assert e.encode(SPECIAL) == fresh_library(file, SPECIAL)
    assert np.frombuffer(e.encode([SPECIAL[0]])[0], "<u4").tolist() == {
        FILES[0]: [320, 49407, 321], FILES[1]: [64, 220, 50256, 275]}[file]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n.,Nédn|<>"), max_size=8), min_size=1, max_size=4), st.sampled_from(SPECIAL))
def test_special_tokens_between_any_texts(parts, special):
    texts = [special.join(parts), *parts]
    for f in FILES:
        if f not in ENCODERS:
            ENCODERS[f] = SegmentEncoder(tokenizer_path(f), pieces=200)
        assert ENCODERS[f].encode(texts) == fresh_library(f, texts)


def test_special_tokens_in_token_files_and_packing(spark, scratch):
    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string")
    path = token_files.write_token_files(docs, f"{scratch}/t", tokenizer_path(FILES[0]), 2)
    got = {r.doc: bytes(r.ids) for r in token_files.read_token_files(spark, path).collect()}
    end = [np.asarray([x], "<u4").tobytes() for x in (2, 1)]
    assert got == {i: x + end[0] for i, x in enumerate(fresh_library(FILES[0], SPECIAL))}
    packed = {}
    for r in sorted(packing.pack(docs, tokenizer_path(FILES[1]), 1).collect(), key=lambda r: r.start):
        packed[r.doc_id] = packed.get(r.doc_id, b"") + bytes(r.ids)
    assert packed == {i: x + end[1] for i, x in enumerate(fresh_library(FILES[1], SPECIAL))}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list(" \n\t'sdtreNÉéİΣς.,|̸́\xa0\x1c")), st.characters(codec="utf-8")),
                        max_size=30), max_size=4))
def test_any_text_encodes_as_the_library_does(texts):
    for f in FILES:
        e = ENCODERS.get(f) or ENCODERS.setdefault(f, SegmentEncoder(tokenizer_path(f), pieces=200))
        assert e.encode(texts) == library(e, texts)


ENCODERS: dict = {}


def test_text_batches_cover_everything_once():
    texts = ["a" * n for n in (0, 5, 100, 3, 0, 50)]
    ranges = list(text_batches(texts, 60))
    assert [i for a, b in ranges for i in range(a, b)] == list(range(6))
    assert list(text_batches([])) == []


def expected_docs(rows, file, end):
    e = SegmentEncoder(tokenizer_path(file))
    return [(r[0], x + np.asarray([end], "<u4").tobytes()) for r, x in zip(rows, library(e, [r[1] or "" for r in rows]), strict=True)]


def test_token_files_round_trip(spark, scratch):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    path = token_files.write_token_files(docs, f"{scratch}/t", tokenizer_path(FILES[0]), 2)
    got = token_files.read_token_files(spark, path).collect()
    want = expected_docs(ROWS, FILES[0], 2)
    key = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r.doc, bytes(r.ids)) for r in got), key=key) == sorted(want, key=key)
    got.sort(key=lambda r: r.start)
    ids = [r.doc for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()
    one = token_files.read_token_files(spark, path, doc_ids=[4]).collect()
    assert [(r.doc, bytes(r.ids)) for r in one] == [x for x in want if x[0] == 4]
    assert one[0].start == next(r.start for r in got if r.doc == 4)
    assert token_files.read_token_files(spark, path, doc_ids=[1234]).count() == 0


def test_token_files_with_a_trained_dictionary(spark, scratch):
    rows = [(i, " ".join(f"word{(i * j) % 97}" for j in range(200))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = token_files.write_token_files(docs, f"{scratch}/t", tokenizer_path(FILES[0]), 2)
    assert len(bytes(spark.read.parquet(f"{path}/dictionary").first()["bytes"])) > 0
    got = {r.doc: bytes(r.ids) for r in token_files.read_token_files(spark, path).collect()}
    assert got == dict(expected_docs(rows, FILES[0], 2))
    block = bytes(spark.read.parquet(f"{path}/blocks").first()["block"])
    with pytest.raises(ValueError):
        token_files.open_block(block, b"\0" * 32)


# Ids whose hash alone falls under a share of 20 in 400 rows.
ONES = [15, 16]


@pytest.mark.parametrize("text", ["'the same text'", "concat('text number ', id)"])
def test_dictionary_sample_is_bounded_for_one_id(spark, monkeypatch, text):
    """Most rows have one id; the driver takes neither all of them nor a row twice."""
    taken = []
    monkeypatch.setattr(token_files, "SAMPLE_DOCS", 20)
    monkeypatch.setattr(SegmentEncoder, "encode", lambda self, texts: taken.extend(texts) or [b"\1\0\0\0" * 50 for _ in texts])
    for one in ONES:
        docs = spark.range(400).selectExpr(f"cast({one if one is not None else 'null'} as long) as doc_id", f"{text} as text")
        before = len(taken)
        token_files.train_dictionary(docs, tokenizer_path(FILES[0]), 2, id_col="doc_id", text_col="text")
        assert len(taken) - before <= 40 and len(set(taken[before:])) == len(taken[before:])


def test_empty_table_of_tokens(spark, scratch):
    docs = spark.createDataFrame([], SCHEMA)
    path = token_files.write_token_files(docs, f"{scratch}/t", tokenizer_path(FILES[0]), 2)
    assert token_files.read_token_files(spark, path).count() == 0
    assert packing.pack(docs, tokenizer_path(FILES[1]), 1).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9000), max_size=60))
def test_packed_lengths_hold_every_token_once(lengths):
    sequences = packing.pack_lengths(lengths)
    seen = sorted((d, a, n) for s in sequences for d, a, n in s)
    assert all(n > 0 for *_, n in seen)
    at = {}
    for d, a, n in seen:
        assert at.get(d, 0) == a
        at[d] = a + n
    assert at == {d: n for d, n in enumerate(lengths) if n}
    totals = [sum(n for *_, n in s) for s in sequences]
    assert all(t <= 2048 and t & (t - 1) == 0 for t in totals)


def test_short_tiers_fill_long_gaps():
    sequences = packing.pack_lengths([1500, 300, 200, 48, 700, 200, 100])
    assert [sorted(n for *_, n in s) for s in sequences if sum(n for *_, n in s) == 2048] == [[48, 200, 300, 1500]]
    with pytest.raises(ValueError):
        packing.pack_lengths([1], window=2048, tiers=(300, 2048))


def test_step_groups_are_balanced():
    sizes = [2048] * 30 + [1024] * 21 + [256] * 9
    of = packing.step_groups(sizes, 16_384)
    loads = [sum(s for s, g in zip(sizes, of, strict=True) if g == k) for k in range(max(of) + 1)]
    assert max(loads) - min(loads) <= 2048


def test_pack_documents(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = packing.pack(docs, tokenizer_path(FILES[1]), 1, group_tokens=3_000).collect()
    want = expected_docs(ROWS, FILES[1], 1)
    whole = {}
    for r in got:
        assert r.length == len(r.ids) // 4
        whole.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    by_key = {}
    for d, x in want:
        by_key.setdefault((d, len(x) // 4), []).append(x)
    assert whole.keys() == by_key.keys()
    for key, texts in by_key.items():
        assert sum(r.length for r in whole[key]) == len(texts) * key[1]
        assert all(any(x[4 * r.start:4 * (r.start + r.length)] == bytes(r.ids) for x in texts) for r in whole[key])
    for s in {r.sequence_id for r in got}:
        pieces = sorted((r.offset, r.length, r.tier) for r in got if r.sequence_id == s)
        at = 0
        for offset, length, tier in pieces:
            assert offset == at
            at += length
        assert at == tier and tier & (tier - 1) == 0


def test_query_columns(spark):
    from loadsmith.llm.queries import QUERIES

    rows = QUERIES["op10_packing"](spark, "/root/testdata/sf0.001")
    assert rows.columns[:7] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    want = expected_docs([(d.doc_id, d.text) for d in docs], FILES[0], 2)
    got = QUERIES["op1_token_files"](spark, "/root/testdata/sf0.001").orderBy("doc_id").collect()
    start = 0
    for (doc, ids), r in zip(want, got, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
