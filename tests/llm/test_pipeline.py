"""The pipeline's stages: what each keeps, on its own input."""

import inspect

from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_run_one_after_another(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, last = docs.columns, None
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]
        stage(spark, docs, SF).write.parquet(f"{scratch}/{i}")
        last, docs = docs, spark.read.parquet(f"{scratch}/{i}")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
            assert 0 < docs.count() <= last.count()
    # every document of the stage before is packed, whole
    packed = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("of"))
    assert packed.count() == last.count() and packed.where("n != of").count() == 0
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == docs.columns and run.agg(F.sum("length")).first() == docs.agg(F.sum("length")).first()


def test_run_leaves_one_scratch_table(spark, scratch):
    import os

    from loadsmith.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    run = corpus_pipeline.run(spark, SF)
    left = set(os.listdir(folder)) - before
    assert [x.split("-")[1:3] for x in left] == [["near", "duplicates"]]
    run.write.parquet(f"{scratch}/run")
    assert set(os.listdir(folder)) - before == left
    assert spark.read.parquet(f"{scratch}/run").count() > 0


def test_stages_take_odd_tables(spark, scratch):
    text = " ".join("plain" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(70))     # no word twice
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0),
            (None, text + " more", "en", None, 7), (4, text.replace("plain", "simple"), None, "a", 1), (5, text, "en", "b", 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score string, fp int")
    for docs in (docs, docs.where("false")):
        empty = docs.count() == 0
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = f"{scratch}/{empty}{i}"
            stage(spark, docs, SF).write.parquet(out)
            docs = spark.read.parquet(out)
        assert (docs.count() == 0) == empty


def test_near_duplicates_leave_one_of_each_group(spark):
    text = " ".join(f"token{i}" for i in range(300))
    rows = [(i, text + (" end" if i % 2 else ""), "en", "s", 1) for i in range(6)] + [(9, text.replace("token", "other"), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["near-duplicates"](spark, docs, SF)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 9]


def test_planted_copies_leave_one_document(spark, scratch):
    """Of exact copies, stages 3 and 4 keep one document with text, whatever their lines' lengths are."""
    def text(g):
        return "\n".join(" ".join(f"g{g}l{i}w{j}" for j in range(5 + (g + i) % 9)) for i in range(2 + g)) + "\n\n" * (g % 2)
    texts = {g: text(g) for g in range(8, 20)}
    rows = [(100 * c + g, t, "en", "s", len(t)) for g, t in texts.items() for c in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    for i, name in enumerate(("line dedup", "near-duplicates")):
        dict(corpus_pipeline.STAGES)[name](spark, docs, SF).write.parquet(f"{scratch}/{i}")
        docs = spark.read.parquet(f"{scratch}/{i}")
    assert {r.doc_id: r.text for r in docs.where("n_chars > 0").collect()} == texts
