"""Conversation trie and filter audit against plain restatements."""

import collections
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadsmith.llm import conversation_trie as trie
from loadsmith.llm import filter_audit

TRIE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_trie(conversations):
    """Rows of the trie of {conv: [(role, text), ...]}, by nested loops."""
    members = collections.defaultdict(list)
    for c, turns in sorted(conversations.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, convs in members.items():
        kids = [k for k in members if len(k) == len(node) + 1 and k[:len(node)] == node]
        below = [k for k in members if k[:len(node)] == node]
        leaves = sum(1 for k in below if not any(x[:len(k)] == k for x in members if len(x) == len(k) + 1))
        saved = sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k)
        ends = ",".join(str(c) for c in convs if len(conversations[c]) == len(node))
        out.append((convs[0], len(node), members[node[:-1]][0] if node else None, len(convs), len(kids), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def plain_rebuilt(rows):
    turns = collections.defaultdict(list)
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append(((turn is not None, turn or 0, md5(role), md5(text)), (role, text)))
    turns = {c: [x for _, x in sorted(v)] for c, v in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = turns.get(c - c % 100, [])[:h] + own[h:]
    return out


def spark_trie(spark, rows, schema="conv_id long, turn long, role string, text string", **options):
    df = spark.createDataFrame(rows, schema).repartition(3)
    turns = trie.ordered_turns(df)
    conv = F.col("conv")
    turns, convs = trie.rebuilt(turns, heads=F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(6)),
                                base=conv - F.pmod(conv, F.lit(100)), most=5)
    found = trie.prefix_trie(turns, convs, **options).select(*TRIE_COLUMNS).collect()
    return sorted((tuple(r) for r in found), key=str)


def conversations(seed, n=60, words="abcd"):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-120, 420), n):
        for turn in range(rnd.randint(1, 7)):
            rows.append((c, rnd.choice([turn, turn, None]), rnd.choice(["user", "bot", None]), rnd.choice([*words, "é😀", None, ""])))
    return rows


@pytest.mark.parametrize("chunk,final", [(trie.CHUNK, trie.FINAL), (3, 2)])
def test_trie_is_as_by_hand(spark, chunk, final):
    """Nulls, ties, absent and short bases, turnless conversations, negative ids; small chunks toss coins."""
    rows = conversations(5) + [(700, 1, "user", "a"), (701, 1, "user", "a"), (None, 0, "user", "z"), (700, 1, "user", "a")]
    assert spark_trie(spark, rows, chunk=chunk, final=final) == plain_trie(plain_rebuilt(rows))


def test_long_conversation_and_clashing_columns(spark, monkeypatch):
    """A conversation of many blocks, its near copies, and columns named like the operator's own."""
    monkeypatch.setattr(trie, "BLOCK", 4)
    monkeypatch.setattr(trie, "BLOB_IDS", 2)
    long = [("user", f"t{i % 5}") for i in range(30)]
    rows = [(c, i, r, t) for c in range(100, 107) for i, (r, t) in enumerate(long[:30 - c % 3])]
    rows = [(*r, 1, 2, "x", 3) for r in rows + conversations(9, 20)]
    schema = "conv_id long, turn long, role string, text string, conv long, pos long, digest string, depth int"
    assert spark_trie(spark, rows, schema, chunk=8, final=4) == plain_trie(plain_rebuilt(rows))


def test_many_ends_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOB_IDS", 7)
    rows = [(c, 0, "user", "same") for c in range(300)]
    assert spark_trie(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_empty_trie(spark):
    assert spark_trie(spark, []) == [] and spark_trie(spark, [(None, 1, "a", "b")]) == []


def test_list_ranks(spark):
    order = list(range(200))
    random.Random(3).shuffle(order)
    weight = {e: e % 4 for e in order}
    rows = [(e, n, weight[e]) for e, n in zip(order, [*order[1:], None], strict=True)]
    want, at = {}, 0
    for e in order:
        want[e], at = at, at + weight[e]
    df = spark.createDataFrame(rows, "id long, next long, w long")
    for final in (1_000, 5):
        assert {r.id: r.rank for r in trie.list_ranks(df, final).collect()} == want


def test_chains():
    arcs, following = np.array([4, 7, 1, 9, 2]), np.array([7, 100, 4, -1, 9])
    head, place, last = trie.chains(arcs, following)
    assert head.tolist() == [1, 1, 1, 2, 2] and place.tolist() == [1, 2, 0, 1, 0]
    assert last.tolist() == [False, True, False, True, False]


def test_groups_over_many_tasks(spark):
    """Ranks in a group that fills most of a table, and numbers over all rows."""
    rows = [(1 if i % 10 else i, (i * 37) % 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "g long, v long").repartition(7)
    got = trie.ranked(trie.globally_sorted(df, "g", "v"), "g", "rank").collect()
    by = collections.defaultdict(list)
    for g, v in rows:
        by[g].append(v)
    assert sorted((r.g, r.v, r["rank"]) for r in got) == sorted((g, v, i + 1) for g, vs in by.items() for i, v in enumerate(sorted(vs)))
    got = trie.numbered(trie.globally_sorted(df, "g", "v"), "n").collect()
    assert [(r.g, r.v) for r in sorted(got, key=lambda r: r.n)] == sorted(rows) and sorted(r.n for r in got) == list(range(1000))


def plain_audit(docs, labels):
    first = {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(d, first.get(text or "", d))
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    parts = collections.defaultdict(list)
    for d, text, lang in docs:
        t = text or ""
        words = [w for w in t.translate({ord(c): " " for c in "\t\n\x0b\x0c\r"}).split(" ") if w]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": d is not None and t in first and first[t] < d}
        parts[lang or ""].append((d, {f for f, v in fails.items() if v}))
    out = []
    for part, rows in parts.items():
        shapley, made = collections.Counter(), []
        for order in map("".join, itertools.permutations("ABCDE")):
            alive = dict(enumerate(rows))
            for step, f in enumerate(order, 1):
                gone = {i for i, (_, fails) in alive.items() if f in fails}
                lost = [alive[i][0] for i in gone]
                redundant = sum(1 for i, (_, fails) in enumerate(rows) if f in fails and i not in alive)
                alive = {i: r for i, r in alive.items() if i not in gone}
                shapley[f] += len(gone)
                made.append((f, (part, order, step, len(alive), len(gone), redundant, sum(fails == {f} for _, fails in rows),
                                 sum(d in good for d in lost if d is not None), sum(d in toxic for d in lost if d is not None))))
        out += [(*row, shapley[f]) for f, row in made]
    return sorted(out)


def test_audit_is_as_by_hand(spark):
    plain = " ".join(f"w{i}" for i in range(250))
    texts = [plain, plain, plain + " #", "short", "short", None, "", "UP " * 300, "same word here " * 120, plain.upper(), "a\x0bb\tc\n" * 90,
             " ".join(f"é{i}" for i in range(200)), "X" + "y" * 33, "XX" + "y" * 64]
    docs = [(i, t, ["en", "de", None, ""][i % 4]) for i, t in enumerate(texts)]
    docs += [(None, plain, "en"), (None, plain, "en"), (0, plain, "en"), (3, "short", "en"), (50, plain, "de"), (51, "", "fr")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(12)] + [(0, 1, 1), (None, 1, 1), (50, None, 1), (99, 1, 1), (3, 0, 0)]
    rows = [(*d, 1, 2, "m") for d in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, mask int, part int, n string").repartition(3)
    lab = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, good string")
    got = filter_audit.audit(df, lab)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(docs, labels)
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    assert filter_audit.audit(df.where("false"), lab).count() == 0
    assert sorted(tuple(r) for r in filter_audit.audit(df, lab.where("false")).collect()) == plain_audit(docs, [])
