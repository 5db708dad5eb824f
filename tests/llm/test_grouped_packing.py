"""Best-fit packing by linear grouping: exact pieces, sound sequences, few of them."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from loadsmith.llm import grouped_packing as gp
from loadsmith.llm._tokens import tokenizer_path

FILE = "word_bpe_49k.json"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=80), st.sampled_from([1, 3, 12]), st.sampled_from([2, 4, 6]))
def test_every_length_is_packed_once(lengths, sizes, parts):
    sequences = gp.pack_lengths(lengths, 100, sizes, parts)
    assert sorted(i for s in sequences for i in s) == list(range(len(lengths)))
    assert all(s and sum(lengths[i] for i in s) <= 100 for s in sequences)


@pytest.mark.parametrize("seed", range(3))
def test_few_sequences(seed):
    """Within one percent (and one sequence) of the bound that no packing can beat."""
    rnd = random.Random(seed)
    lengths = [min(4095, int(rnd.lognormvariate(6, 1.2)) + 1) for _ in range(4_000)]
    bound = -(-sum(lengths) // 4096)
    assert len(gp.pack_lengths(lengths)) <= 1.01 * bound + 1


def test_pairs_that_fit_exactly_meet():
    """Lengths of a few sizes: the configurations find the perfect packing (1000 sequences)."""
    lengths = [2500] * 500 + [1596] * 500 + [1366] * 500 + [1365] * 1000
    random.Random(1).shuffle(lengths)
    assert len(gp.pack_lengths(lengths, sizes=5)) == 1000


def test_linear_program_against_all_choices():
    sizes, window = [3, 4, 5], 10
    config = gp.configurations(sizes, window)
    assert {tuple(c) for c in config.astype(int).tolist()} == {
        (a, b, c) for a in range(4) for b in range(3) for c in range(3) if 0 < 3 * a + 4 * b + 5 * c <= 10}
    demand = np.array([30.0, 30, 30])
    used = gp.fewest(config, demand)
    assert np.allclose(sum(t * config[i] for i, t in used), demand)
    # 360 units of length need 36 sequences of ten, and (3, 3, 4) with (5, 5) leave no room.
    assert sum(t for _, t in used) == pytest.approx(37.5)


def test_pack_documents(spark, monkeypatch):
    rows = [(i, f"some words of text number {i} " * (i * 7 % 40), "x", 1) for i in range(120)]
    rows += [(None, "no id", "x", 2), (5, "twice", None, 3), (5, "twice", None, 3), (200, None, "x", 4), (201, "", "x", 5),
             (202, "very long " * 9_000, "x", 6), (203, "a " * 4095, "x", 7), (204, "a " * 4096, "x", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, piece int").repartition(4)
    monkeypatch.setattr(gp, "GROUP_PIECES", 60)
    got = gp.pack_best_fit(docs, tokenizer_path(FILE), 1).collect()
    tok = Tokenizer.from_file(tokenizer_path(FILE))
    want = []
    for doc, text, *_ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = np.asarray(ids[at:at + 4096], "<u4").tobytes()
            want.append((doc, piece, at, len(part) // 4, zlib.crc32(part), len(ids), part))
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.doc_tokens, bytes(r.ids)) for r in got), key=key) == sorted(want, key=key)
    by: dict = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 4096
    bare = gp.pack_best_fit(docs, tokenizer_path(FILE), 1, with_ids=False)
    assert bare.where("ids is not null").count() == 0 and bare.count() == len(want)
    assert gp.pack_best_fit(docs.where("false"), tokenizer_path(FILE), 1).count() == 0


def test_query(spark):
    from loadsmith.llm.queries import QUERIES

    got = QUERIES["op12_grouped_packing"](spark, "/root/testdata/sf0.001").collect()
    assert list(got[0].asDict())[:8] == ["doc_id", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    total = sum(r.length for r in got)
    assert len({r.sequence_id for r in got}) <= 1.02 * -(-total // 4096) + 2
