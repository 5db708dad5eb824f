"""Sentence pieces against a plain dynamic program; classifiers on held-out rows."""

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadsmith.llm import compression_quality, language_id
from loadsmith.llm._tokens import tokenizer_path
from loadsmith.llm.sentence_pieces import MARK, PieceModel, decode_pieces, encode_pieces

SF = "/root/testdata/sf0.01"
PATH = tokenizer_path("piece_bpe_32k.model")
ODD = ["", " ", "  two  spaces ", "line\n\nbreak\tx", "ΣÉé 中文 😀 ﷽\x00", "word " * 20_000, "x" * 3_000, "the hested thing"]


@pytest.fixture(scope="module")
def model():
    return PieceModel(PATH)


def best_score(model, text):
    """The largest score of any segmentation, by trying every piece at every place."""
    table = {p: s for p, (_, s, _) in model.automaton.items()}
    longest = max(map(len, table))
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - longest), end):
            piece = text[start:end]
            if piece in table:
                best[end] = max(best[end], best[start] + table[piece])
        if text[end - 1] not in table:
            best[end] = max(best[end], best[end - 1] + model.unknown_score)
    return best[-1]


def score_of(model, ids, text):
    scores = {i: s for _, (_, s, i) in model.automaton.items()}
    total, at = 0.0, 0
    while at < len(ids):
        if ids[at] in scores:
            total += scores[ids[at]]
            at += 1
        else:                                       # the bytes of one unknown character
            first = model.value[ids[at]]
            total += model.unknown_score
            at += 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
    return total


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(list(" theringsdoaé\n.,!?;:)")), st.characters(codec="utf-8")), max_size=30))
def test_viterbi_is_optimal_and_round_trips(text):
    m = MODELS.get(0) or MODELS.setdefault(0, PieceModel(PATH))
    marked = (MARK + text.replace(" ", MARK)) if text else ""
    ids = np.frombuffer(m.encode([text])[0], "<u4").tolist()
    assert score_of(m, ids, marked) == pytest.approx(best_score(m, marked))
    assert m.decode([m.encode([text])[0]]) == [text.replace(MARK, " ")]
    assert m.segment(marked) == ids                 # cutting at words changes nothing


MODELS: dict = {}


def test_pieces_of_odd_rows(spark):
    rows = [(i, t, "z") for i, t in enumerate(ODD)] + [(None, None, None), (2, ODD[2], "z"), (2, ODD[2], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece_ids string")
    got = decode_pieces(encode_pieces(docs, PATH), PATH).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.decoded) for r in got) == \
        sorted((r[0] is None, r[0], r[1] or "") for r in rows)
    assert encode_pieces(docs.where("doc_id > 1000"), PATH).count() == 0


def test_model_that_rewrites_text_is_refused(scratch):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.remove_extra_whitespaces = True
    with open(f"{scratch}/m", "wb") as f:
        f.write(proto.SerializeToString())
    with pytest.raises(ValueError):
        PieceModel(f"{scratch}/m")


def test_quality_on_held_out_rows(spark):
    from loadsmith.llm.queries import QUERIES

    rows = QUERIES["op2_compression_quality"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 50 and sum(r.predicted == r.quality for r in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def quality_rows(n, long=0):
    """(doc, text, label): even ids are good; ``long`` adds words to the good ones."""
    rng = np.random.default_rng(5)
    words = [[f"{x}{k}" for k in range(60)] for x in ("bad", "good")]
    return [(i, " ".join(rng.choice(words[1 - i % 2] if rng.random() < 0.8 else words[i % 2], 120 + (1 - i % 2) * long)), 1 - i % 2)
            for i in range(n)]


def test_labels_that_teach_nothing_move_no_score(spark):
    """Those held out, and those of no document."""
    rows = quality_rows(120)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    known = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    learn = F.col("id") < 80
    model = compression_quality.fit_quality(docs, known.where("doc_id < 80"), learn=learn)
    assert model.good and model.bad
    strangers = spark.range(1000, 1900).selectExpr("id as doc_id", "1 as quality")
    flipped = known.selectExpr("doc_id", "if(doc_id < 80, quality, 1) as quality")
    for labels in (known, flipped, known.union(strangers)):
        assert compression_quality.fit_quality(docs, labels, learn=learn) == model


def test_a_label_of_long_texts_only_is_learned(spark):
    rows = quality_rows(120, long=4_000)
    assert min(len(t) for _, t, y in rows if y) > compression_quality.SAMPLE_CHARS > max(len(t) for _, t, y in rows if not y)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = compression_quality.fit_quality(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"))
    fresh = spark.createDataFrame([(0, quality_rows(2)[0][1]), (1, rows[1][1]), (2, rows[0][1])], "doc_id long, text string")
    by = {r.doc_id: r.score for r in compression_quality.score_quality(fresh, model).collect()}
    assert by[0] >= 0.5 and by[2] >= 0.5 > by[1]            # what the query predicts by


def test_quality_of_odd_rows(spark):
    good = [(i, f"The quiet river number {i} ran past the old mill and the green hills of the north. " * 3) for i in range(60)]
    bad = [(100 + i, f"BUY!! NOW!! {i} CHEAP!! $$$ CLICK!! " * 6) for i in range(60)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in good + bad] + [(0, 0), (None, 1), (1, None)],
                                   "doc_id long, quality int")
    model = compression_quality.fit_quality(docs, labels)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, good[3][1]), (None, good[3][1]), (4, bad[5][1]), (5, "BUY!! " * 50_000)],
                                "doc_id long, text string").withColumn("score", F.lit("mine"))
    got = compression_quality.score_quality(odd, model).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.score)
    assert by[1] == by[2] and len(by[None]) == 2 and min(by[None]) > 0.5 > by[4][0]
    assert compression_quality.score_quality(odd.where("false"), model).count() == 0
    for part, value in ((labels.where("quality = 1"), 1.0), (labels.where("false"), 0.5)):
        flat = compression_quality.fit_quality(docs, part)
        assert compression_quality.score_quality(odd, flat).first().score == pytest.approx(value)


def test_curve_is_monotone_and_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=4000)
    y = rng.random(4000) < 1 / (1 + np.exp(-(2 * x + 0.5)))
    slope, intercept = compression_quality.fit_curve(x, y, np.ones(4000))
    assert slope == pytest.approx(2, abs=0.25) and intercept == pytest.approx(0.5, abs=0.15)


def test_language_on_held_out_rows(spark):
    from loadsmith.llm.queries import QUERIES

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_language_id"](spark, SF).join(docs, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def language_model():
    return language_id.LanguageModel(("de", "en"), {"de": {"und": 50, "das": 40, "größe": 5}, "en": {"and": 50, "the": 60, "thing": 5}})


def test_backoff_is_word_then_shorter_grams():
    s = language_model().scorer()
    assert s.predict("the and")[0] == "en" and s.predict("und das")[0] == "de"
    # unseen: the longest n-grams that are known decide
    four = [v for g in language_id.grams("things", 4) if (v := s.tables[3].get(g)) is not None]
    assert np.allclose(s.word("things"), np.mean(four, axis=0))
    assert s.predict("things")[0] == "en" and s.predict("ößx")[0] == "de"
    assert np.allclose(s.word("qq"), 0)


def test_language_model_is_as_restated(spark):
    """Fit and scores by a plain restatement: every word of the labelled rows counts, rare ones too."""
    words = {"en": ["river", "stone", "the", "and", "house"], "de": ["fluss", "stein", "und", "das", "haus"], "fr": ["fleuve", "pierre", "et", "la", "maison"]}
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(words[lang], 30)) + f" rare{lang}{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}", lang)
            for i, lang in enumerate(["en", "de", "fr"] * 60)]
    docs = spark.createDataFrame([*rows, (None, "never seen", "en"), (500, "nor this", None)], "doc_id long, text string, lang string")
    model = language_id.fit_languages(docs)
    langs = sorted(words)
    counts = {lang: {} for lang in langs}
    for _, text, lang in rows:
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            counts[lang][w] = counts[lang].get(w, 0) + 1
    assert model.languages == tuple(langs) and model.words == counts
    tables = []
    for size in range(5):                           # 0: whole words
        table = {}
        for j, lang in enumerate(langs):
            for w, n in counts[lang].items():
                for g in [w] if not size else [f"<{w}>"[i:i + size] for i in range(len(w) + 3 - size)] if size > 1 else list(w):
                    table.setdefault(g, [0, 0, 0])[j] += n
        total = np.sum(list(table.values()), 0)
        tables.append({g: np.log((np.array(n) + 0.5) / (total + 0.5 * len(table))) for g, n in table.items()})

    def score(word):
        if word in tables[0]:
            return tables[0][word]
        for size in (4, 3, 2, 1):
            found = [tables[size][g] for g in language_id.grams(word, size) if g in tables[size]]
            if found:
                return np.mean(found, 0)
        return np.zeros(3)

    texts = ["the river and the house", "rareenak stones housed", "das fleuvex xyz", "une maison", "q", "pierres " * 50]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in language_id.predict_languages(asked, model).collect():
        of = texts[r.doc_id].split()
        mean = np.mean([score(w) for w in of], 0)
        odds = np.exp((mean - mean.max()) * min(len(of), 30))
        assert r.lang_pred == langs[int(np.argmax(mean))] and r.score == pytest.approx(odds.max() / odds.sum())


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 3)
    docs = spark.range(8).selectExpr("id as doc_id", "'some text' as text", "concat('l', id) as lang")
    with pytest.raises(ValueError):
        language_id.fit_languages(docs)


def test_quality_score_is_as_restated(spark):
    """Chunks of 1 KB, both dictionaries, the difference over all bytes, the logistic curve."""
    import zstandard

    rows = quality_rows(120)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    model = compression_quality.fit_quality(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"))

    def size(raw, content):
        shared = zstandard.ZstdCompressionDict(content)
        shared.precompute_compress(level=3)
        make = zstandard.ZstdCompressor(dict_data=shared, write_checksum=False, write_content_size=False, write_dict_id=False)
        return sum(len(make.compress(raw[i:i + 1024])) for i in range(0, len(raw), 1024))

    for r in compression_quality.score_quality(docs, model).collect():
        raw = rows[r.doc_id][1].encode()
        difference = (size(raw, model.bad) - size(raw, model.good)) / len(raw)
        assert r.size_difference == pytest.approx(difference)
        assert r.score == pytest.approx(1 / (1 + np.exp(-(model.slope * difference + model.intercept))))


def test_language_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "12 34 ²½ !!", "c"), (4, "the thing " * 40_000, "d"), (None, "und das", "e"), (5, "das²und", "f")]
    docs = spark.createDataFrame(rows + [rows[4]], "doc_id long, text string, score string").withColumn("lang_pred", F.lit(7))
    got = [(r.doc_id, r.lang_pred) for r in language_id.predict_languages(docs, language_model()).collect()]
    assert sorted(got, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "de"), (None, "de"), (5, "de")], key=str)
    kept = language_id.keep_identified(docs, language_model())
    assert kept.columns == docs.columns and kept.count() == 4
    empty = language_id.fit_languages(docs.where("false").withColumn("lang", F.lit("x")))
    assert {r.lang_pred for r in language_id.predict_languages(docs, empty).collect()} == {"und"}


def test_numerals_are_no_letters():
    assert language_model().scorer().predict("½²") == ("und", 0.0)
