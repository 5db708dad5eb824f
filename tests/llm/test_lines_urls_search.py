"""Line rules, line dedup, SimHash, top-k and URL filters against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadsmith.llm import components, line_dedup, line_rules, simhash_dedup, topk, url_filters

LONG = " ".join(f"w{i}" for i in range(60))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# ---------------------------------------------------------------- line rules

def verdicts(rows, **limits):
    """rows: (doc, text, host); exact copies of a text count as one document of a host."""
    least, share = limits.get("least_docs", 20), limits.get("share", 0.01)
    norm = lambda line: " ".join(words(line.lower()))
    holders, docs = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        docs[host or ""].add(text)
        for line in (text or "").split("\n"):
            if words(line):
                holders[host or "", norm(line)].add(text)
    often = {k for k, v in holders.items() if len(v) > max(least, share * len(docs[k[0]]))}
    out = []
    for doc, text, host in rows:
        w, lines = words(text or ""), [x for x in (text or "").split("\n") if words(x)]
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(3)}
        gone = [x for x in lines if (host or "", norm(x)) in often]
        left = len(w) - sum(len(words(x)) for x in gone)
        base = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        out.append((doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)),
                    len(covered), base, not base and not (gone and (left < 20 or left < 0.3 * len(w))), left, len(gone)))
    return out


def rule_rows():
    rows = [(i, f"Shared  HEADER line\n{LONG} {i}\nshared header LINE", "a") for i in range(8)]
    rows += [(10 + i, f"{LONG} {i % 2}", "b") for i in range(6)]                 # copies: two documents
    rows += [(20, None, "a"), (21, "", "a"), (22, "a b c a b c a b c " * 9, None), (23, "\n\n \t\n", None),
             (24, "shared header line\n" * 20, "a"), (None, f"{LONG}\u000b# $5 <b>", ""), (3, rows[3][1], "a"),
             (25, "é ñ " * 20_000, "c"), (26, "Shared header line\n" + " ".join(f"x{i}" for i in range(50)), "b")]
    return rows


def test_line_rules_against_plain_python(spark):
    rows = rule_rows()
    docs = spark.createDataFrame([(*r, 1, True) for r in rows], "doc_id long, text string, source string, n_words int, kept boolean").repartition(4)
    got, often = line_rules.judged(docs, least_docs=3)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "left_words", "removed_lines"]
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(verdicts(rows, least_docs=3), key=str)
    assert often.count() == 1
    assert line_rules.judged(docs.where("false"))[0].count() == 0
    kept = line_rules.clean_documents(docs, least_docs=3)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[1] == f"{LONG} 1" and texts[10] == f"{LONG} 0" and texts[26].startswith("Shared header line\n")
    assert kept.count() == sum(v[7] for v in verdicts(rows, least_docs=3))


@settings(max_examples=25, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab \n", max_size=60), min_size=1, max_size=8))
def test_repeated_windows(spark, texts):
    rows = list(enumerate(texts))
    got = spark.createDataFrame(rows, "i int, t string").select("i", line_rules.repeated_window_words(line_rules.words_of(F.col("t"))).alias("n"))
    assert sorted(map(tuple, got.collect())) == [(i, v[5]) for i, v in enumerate(verdicts([(i, t, "") for i, t in rows]))]


def test_line_rules_run_no_python(spark):
    from tests.conftest import plan_text

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert not re.search("Python|Pandas|Arrow", plan_text(line_rules.judged(docs)[0]))


# ---------------------------------------------------------------- line dedup

def test_boundaries_resist_shifts():
    """Chunks of an edited text are those of the plain one, but near the edits; and several lines long."""
    lines = [f"line number {i} of the passage, which has words" for i in range(400)]
    raw = "\n".join(lines).encode()
    plain = {raw[a:a + n] for a, n in line_dedup.chunks(raw)}
    assert 15 <= len(plain) <= 120
    for moved in (["something new in front", *lines], [*lines[:100], "inserted here", *lines[100:]], [*lines[:200], *lines[205:]],
                  ["", *lines[:300], " ", *lines[300:], "the end"]):
        raw = "\n".join(moved).encode()
        new = [raw[a:a + n] for a, n in line_dedup.chunks(raw)]
        assert len(set(new) - plain) <= 3 and len(plain - set(new)) <= 4


def test_chunks_are_apart_and_may_be_removed():
    rng = np.random.default_rng(1)
    for _ in range(50):
        raw = "\n".join(" ".join(["w"] * rng.integers(0, 12)) + str(rng.integers(0, 9)) * rng.integers(0, 2) for _ in range(60)).encode()
        spans = line_dedup.chunks(raw)
        assert all(a + n < b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
        for a, n in spans:
            part = raw[a:a + n]
            filled = [x for x in part.split(b"\n") if x.split()]
            assert (a == 0 or raw[a - 1:a] == b"\n") and raw[a + n:a + n + 1] in (b"", b"\n") and part.split(b"\n")[0].split()
            assert len(part.split()) >= 50 or len(filled) > 1 and len(part.split()) >= 10
    assert line_dedup.chunks(b"") == line_dedup.chunks(b"\n \n") == []


@pytest.mark.parametrize("bits", [1 << 15, 1 << 20])
def test_full_filters_change_nothing(spark, monkeypatch, bits):
    """Filters too small to tell anything apart only send more to the comparison."""
    monkeypatch.setattr(line_dedup, "LEAST_BITS", bits)
    monkeypatch.setattr(line_dedup, "FILTER_BITS", bits)
    passage = [f"passage line {i} with some words" for i in range(60)]
    rows = [(i, "\n".join([f"own {i} line", *passage[i % 7:50 + i % 9], f"more {i}"])) for i in range(40)]
    rows += [(100 + i, f"text {i} has only\nlines of its own {i * i}\nand number {i}") for i in range(600)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(map(tuple, got.collect())) == sorted(without_repeated_runs(rows))


def test_line_dedup_against_plain_python(spark):
    passage = "\n".join(f"passage line {i} with some words" for i in range(40))
    rows = [(i, f"intro {i}\n{passage}\noutro {i}" if i % 3 else f"intro {i}\n{LONG}\nmore {i}") for i in range(12)]
    rows += [(50, None), (51, ""), (52, "one short line"), (53, "one short line"), (54, LONG), (None, f"late\n{LONG}\né"),
             (55, "\n".join([LONG] * 3)), (56, "y z " * 30_000), (4, rows[4][1])]
    docs = spark.createDataFrame([(*r, "s", 5) for r in rows], "doc_id long, text string, cuts string, removed int").repartition(4)
    got = line_dedup.dedup_lines(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(without_repeated_runs(rows), key=str)
    assert line_dedup.dedup_lines(docs.where("false")).count() == 0


def without_repeated_runs(rows):
    """Brute force over all runs of lines of 50 words, or of two lines with words and ten words: every
    later one goes, then what is left without a word beside a removed line."""
    texts = sorted({r for r in rows if r[1] is not None}, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    seen, out = {}, {}
    for doc, text in texts:
        lines = text.split("\n")
        n = [len(x.encode().split()) for x in lines]
        gone = set()
        for a, b in ((a, b) for a in range(len(lines)) for b in range(a + 1, len(lines) + 1) if n[a] and n[b - 1]):
            if sum(n[a:b]) >= 50 or sum(map(bool, n[a:b])) > 1 and sum(n[a:b]) >= 10:
                first = seen.setdefault("\n".join(lines[a:b]), (doc, text, a, b))
                if first[:2] != (doc, text) or a >= first[3]:
                    gone.update(range(a, b))
        left, piece = [], []
        for i in range(len(lines) + 1):
            if i < len(lines) and i not in gone:
                piece.append(i)
            else:
                left += piece if not gone or any(n[k] for k in piece) else []
                piece = []
        out[doc, text] = "\n".join(lines[i] for i in left)
    return [(doc, text if text is None else out[doc, text]) for doc, text in rows]


def test_shared_passages_of_any_length_go_whole(spark):
    """Between different neighbours, over 50 words, in 1 to 40 lines."""
    rows = []
    for n in (1, 2, 3, 4, 5, 6, 12, 40):
        for k in range(6):
            passage = "\n".join(" ".join(f"p{n}x{k}w{i}x{j}" for j in range(60 // n + 1)) for i in range(n))
            rows += [(100 * n + 10 * k + c, f"intro {n} {k} {c}\n{passage}\noutro {n} {k} {c}") for c in range(2)]
    got = dict(map(tuple, line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == dict(without_repeated_runs(rows))
    assert {got[100 * n + 10 * k + 1] for n in (1, 2, 3, 4, 5, 6, 12, 40) for k in range(6)} \
        == {f"intro {n} {k} 1\noutro {n} {k} 1" for n in (1, 2, 3, 4, 5, 6, 12, 40) for k in range(6)}


def test_line_dedup_against_all_runs(spark):
    rng = np.random.default_rng(3)
    pool = ["", "", " \t", "\u000b", "a", "one two", "x y z", "four words in it", "six words are in this line",
            "é ñ ü ö ä\u00a0b c d", "ten words or so are in this line of the text", LONG, LONG + " more"]
    rows = []
    for i in range(150):
        lines = [pool[k] for k in rng.integers(0, len(pool), rng.integers(0, 9))]
        if i % 3 == 0:
            lines[len(lines) // 2:len(lines) // 2] = [f"own line {i}"]
        rows.append((int(rng.integers(0, 120)) if i % 10 else None, "\n".join(lines)))
    rows += [(200, None), (201, "a b c d e f\n" * 5), (202, "\n\n" + "a b c d e f\n" * 5 + "\n"), rows[4]]
    # places in one document of different texts are ordered by a hash: ids with one text only
    one = {d: t for d, t in rows}
    rows = [(d, t) for d, t in rows if one[d] == t]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = line_dedup.dedup_lines(docs, removed_col="n").collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(without_repeated_runs(rows), key=str)
    assert {r.n > 0 for r in got if r.doc_id == 202} == {True} and all(r.text == t for r, t in ((r, one[r.doc_id]) for r in got) if r.n == 0)


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text):
    w = [x for x in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if x]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(fps, radius=4):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aBcÉ \t\n\u000b ", max_size=80))
def test_fingerprint(text):
    assert simhash_dedup.fingerprint(text.encode()) == plain_fingerprint(text)


def test_simhash_against_plain_python(spark):
    rng = np.random.default_rng(1)
    base = [" ".join(rng.choice([f"w{k}" for k in range(500)], 150)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t + " tail") for i, t in enumerate(base[:25])] + [(200 + i, t) for i, t in enumerate(base[:10])]
    rows += [(300, None), (301, ""), (302, "  \n"), (303, "a b"), (304, "A  B"), (None, base[3]), (None, "alone in the world"), (5, base[5]),
             (305, "x " * 40_000)]
    docs = spark.createDataFrame([(*r, "f") for r in rows], "doc_id long, text string, fp string").repartition(5)
    got = simhash_dedup.near_duplicates(docs).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    classes = defaultdict(list)
    for (doc, _), c in zip(rows, plain_classes(fps), strict=True):
        classes[c].append(doc)
    want = [(doc, f"{fp:016x}", min((d for d in classes[c] if d is not None), default=None))
            for (doc, _), fp, c in zip(rows, fps, plain_classes(fps), strict=True)]
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == sorted(want, key=str)
    kept = simhash_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({c for *_, c in want}, key=str)
    assert simhash_dedup.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("tile", [16, 64])
def test_large_buckets_are_cut_into_tiles(spark, monkeypatch, tile):
    """All fingerprints agree in most bits, so every bucket is far beyond a tile."""
    monkeypatch.setattr(simhash_dedup, "TILE", tile)
    monkeypatch.setattr(simhash_dedup, "SUB_TILE", 8)
    rng = np.random.default_rng(2)
    fps = sorted({int(sum(1 << int(b) for b in rng.choice(24, rng.integers(0, 12), replace=False))) for _ in range(300)})
    nodes = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = dict(map(tuple, components.components(simhash_dedup.links(nodes)).collect()))
    want = plain_classes(fps)
    assert [found.get(f, f) for f in fps] == [fps[c] for c in want]


def test_blocks_grow_with_the_input():
    assert simhash_dedup.blocks_for(1000, 4) == 5 < simhash_dedup.blocks_for(1 << 34, 4)
    for blocks in (5, 6, 7):
        masks = simhash_dedup.block_masks(blocks, 4)
        for bits in ([0, 20, 40, 63], [1, 2, 3, 4]):
            differ = sum(1 << b for b in bits)
            assert any(not (m & ((1 << 64) - 1)) & differ for m in masks)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, edges):
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    root = {n: n for e in edges for n in e}
    for a, b in edges:
        low, high = sorted((root[a], root[b]))
        root = {n: low if r == high else r for n, r in root.items()}
    assert got == {n: r for n, r in root.items() if n != r}


def test_a_long_chain_is_one_component(spark):
    n = 300
    edges = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components.components(edges).collect()} == {0}


# ---------------------------------------------------------------- top-k

def plain_top_k(rows, k):
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    q = [(i, [int(np.floor(1024 * np.float64(x))) for x in v]) for i, v in usable]
    out = []
    for at, (i, v) in enumerate(q):
        if i % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for n, (j, w) in enumerate(q) if n != at)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return out


@pytest.mark.parametrize("shard_rows", [7, 10_000])
def test_top_k_against_plain_python(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6))]) for i in range(120)]
    rows += [(200, [0.0] * 6), (201, None), (202, [float("nan")] * 6), (203, [float("inf")] + [0.0] * 5), (204, [None] + [1.0] * 5),
             (None, [1.0] * 6), (10, rows[10][1]), (205, rows[20][1]), (210, []), (206, [2.0, -1.0]), (220, [1.0] * 9)]
    vectors = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int").repartition(3)
    got = topk.top_k(vectors, F.col("vec_id") % 10 == 0, 5, shard_rows=shard_rows)
    assert sorted(map(tuple, got.collect())) == sorted(plain_top_k(rows, 5))
    assert topk.top_k(vectors.where("false"), F.col("vec_id") % 10 == 0, 5).count() == 0
    few = topk.top_k(vectors.where("vec_id in (0, 1)"), F.col("vec_id") % 10 == 0, 5)
    assert few.count() == 1


def test_max_score_skips_and_stays_exact():
    rng = np.random.default_rng(4)
    v = np.floor(1024 * rng.normal(size=(3000, 16)) * np.linspace(3, 0.05, 16)).astype(int)
    s = topk.Shard(np.arange(3000), np.arange(3000), v.tolist())
    for q in (0, 17, 2999):
        at, score = s.search(v[q], q, 10)
        want = v @ v[q]
        want[q] = -10 ** 15
        order = np.lexsort((np.arange(3000), -want))[:10]
        assert s.ids[at].tolist() == order.tolist() and score.tolist() == want[order].tolist()


# ---------------------------------------------------------------- URLs

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.org", "/x", "block"), ("b.a.org", "/", "allow"), ("org", "/x1y", "allow")]


def plain_verdict(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate({i: i + 32 for i in range(65, 91)}), m[2]) if m else ("", "")
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]), default=("", "", "allow"))
    return host, path, best[0] + best[1] or None, best[2]


URLS = ["http://example.net/en/1?x=/de/", "https://WWW.Example.NET/EN/", "http://net", "http://net/", "http://mynet/", "a://b.a.org/x1y/z",
        "ftp://c.b.a.org/x1yz", "http://a.org/x#y", "http://org/fr", "http://org/fr/", "http://É.org/fr/é", "nothing", "", "://", ":///en/",
        "http://example.com?/de/", "http://example.com/de//", "http://x.net/" + "seg/" * 300, "http://a..net/", "http://u@x.net:80/", "x://y://net/"]


def test_urls_against_plain_python(spark):
    rows = [(i, u, "r") for i, u in enumerate(URLS)] + [(90, None, "r"), (None, URLS[0], None), (0, URLS[0], "r"), (0, URLS[0], "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string").withColumn("verdict", F.lit(1))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    want = sorted(((r[0], *plain_verdict(r[1])) for r in rows), key=str)
    names = ["page_id", "url_host", "url_path", "url_rule", "url_verdict"]
    got = url_filters.judge_urls(pages, rules)
    assert got.columns[:4] == pages.columns
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == want
    assert url_filters.judge_urls(pages.where("false"), rules).count() == 0
    assert {r.url_verdict for r in url_filters.judge_urls(pages, rules.where("false")).collect()} == {"allow"}
    with pytest.raises(ValueError):
        url_filters.judge_urls(pages, spark.createDataFrame([("a", "/", "maybe")], "host string, path string, verdict string"))


def test_urls_with_shuffled_rules(spark, monkeypatch):
    monkeypatch.setattr(url_filters, "BROADCAST_ROWS", 0)
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_filters.judge_urls(pages, rules).select("page_id", "url_host", "url_path", "url_rule", "url_verdict")
    assert sorted(map(tuple, got.collect())) == [(i, *plain_verdict(u)) for i, u in enumerate(URLS)]


def test_url_columns_may_have_any_name(spark):
    rows = [("http://a.net/x", "r", "v", 1, "u"), ("https://example.net/en/1", "r", "v", 2, "u"), (None, "r", "v", 3, "u")]
    pages = spark.createDataFrame(rows, "url string, url_rule string, _verdict string, c0 int, the_url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow")], "host string, path string, verdict string")
    got = url_filters.judge_urls(pages, rules).collect()
    assert sorted((r.c0, r._verdict, r.the_url, r.url_rule, r.url_verdict) for r in got) == [
        (1, "v", "u", "net/", "block"), (2, "v", "u", "example.net/en/", "allow"), (3, "v", "u", None, "allow")]


@pytest.mark.parametrize("middle", ["/" * 100_000, "/a" * 50_000, "." * 100_000])
def test_very_long_urls(spark, middle):
    """Slashes and dots without end: the expressions are as many and as long as the rules allow."""
    url = f"http://{'w.' * 20_000}example.net/en{middle}" if middle[0] == "/" else f"http://x{middle}net/en/"
    pages = spark.createDataFrame([(url,), ("http://other.org/",)], "url string")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("net", "/e", "allow")],
                                  "host string, path string, verdict string")
    got = {len(r.url) > 100: (r.url_rule, r.url_verdict) for r in url_filters.judge_urls(pages, rules).collect()}
    assert got == {True: ("example.net/en/", "allow") if middle[0] == "/" else ("net/e", "allow"), False: (None, "allow")}


def test_kept_documents_may_have_any_columns(spark):
    text = " ".join("plain" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(70))
    rows = [(1, text, "a", 5, "h", 1, "x"), (2, "short", "a", 6, "h", 2, "y"), (None, text + " more", None, 7, "h", 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _hashes int, _doc string, c0 int, passed_id string")
    got = line_rules.clean_documents(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.where("doc_id is not null").collect()) == [rows[0]] and got.count() == 2
