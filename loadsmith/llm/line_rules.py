"""Quality rules with cross-document line frequency, in DataFrame operations only.

Base rules count words, symbols, repeated lines and repeated three-word windows of each
whole text.  Then lines are normalised (lower case, white space runs to one space) and
hashed; for each host the distinct documents that hold a line are counted, where exact
copies of a text are one document.  A line in more than ``max(LEAST_DOCS, SHARE * documents
of the host)`` of them is boilerplate: it is removed, and a document that keeps fewer than
``LEFT_WORDS`` words or less than ``LEFT_SHARE`` of them is depleted and rejected.

A line's documents are counted after repeats inside a text and copies of a text are gone,
with map-side sums, so a line that a third of all rows share costs one row per task.

Defined results: null text has no words and fails the base rules; a null host is the
empty host; rows equal in id and text get the same verdict; other columns of ``docs`` may have
any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_DOCS = 20
SHARE = 0.01
LEFT_WORDS = 20
LEFT_SHARE = 0.3
MIN_WORDS = 50
REPEAT_PERCENT = 50
# What parts words, and what counts as a symbol.
SPACES = " \t\n\u000b\u000c\r"
SYMBOLS = "#*$%&|<>"


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), lambda w: w != "")


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeated_window_words(words: Column) -> Column:
    """How many words stand in a three-word window that occurs twice or more."""
    def covered(places: Column) -> Column:
        # Each window covers three words, less what the one before has covered.
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(places, start, lambda a, p: F.struct(
            p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])

    def places(hashes: Column) -> Column:
        at = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = _with(at, lambda s: F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                                             | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def count(hashes: Column) -> Column:
        return F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), F.lit(0).cast("long")).otherwise(covered(places(hashes)))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    return _with(words, lambda w: F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(_with(windows(w), count)))


def _normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.translate(line, SPACES, " " * len(SPACES))), "  +", " "))


def judged(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
           least_docs: int = LEAST_DOCS, share: float = SHARE, left_words: int = LEFT_WORDS,
           left_share: float = LEFT_SHARE) -> tuple[DataFrame, DataFrame]:
    """Verdicts (id, text_hash, the counts, base_failed, left_words, removed_lines, kept) of every
    row, and the boilerplate lines (host, h1, h2, n)."""
    key, raw = F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`")
    text = F.coalesce(raw, F.lit(""))
    src = docs.select(key, F.xxhash64(raw).alias("text_hash"), F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit("")).alias("host"),
                      text.alias("body"))
    counted = src.select(
        "doc", "text_hash", "host",
        F.length(F.translate("body", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _with(F.filter(F.split("body", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0),
              lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _with(words_of(F.col("body")), lambda w: F.struct(F.size(w).cast("long").alias("n"),
                                                           repeated_window_words(w).alias("r"))).alias("w"))
    counted = counted.select("doc", "text_hash", "host", F.col("w.n").alias("n_words"), "word_chars", "n_symbols",
                             "n_dup_lines", F.col("w.r").alias("n_repeat_words"))
    # Every line with a word: its hash, its words, how often the text has it.
    lines = src.select("doc", "text_hash", "host", F.explode(F.split("body", "\n")).alias("line"))
    lines = lines.where(F.length(F.translate("line", SPACES, "")) > 0).select(
        "doc", "text_hash", "host", _normal(F.col("line")).alias("normal"))
    lines = lines.select("doc", "text_hash", "host", F.xxhash64("host", "normal").alias("h1"),
                         F.xxhash64("normal", "host", F.lit(7)).alias("h2"),
                         (F.length("normal") - F.length(F.translate("normal", " ", "")) + 1).alias("words"))
    holders = lines.select("host", "h1", "h2", "text_hash").distinct().groupBy("host", "h1", "h2").agg(F.count("*").alias("n"))
    hosts = src.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("docs"))
    often = holders.where(F.col("n") > least_docs).join(hosts, "host") \
        .where(F.col("n") > F.greatest(F.lit(float(least_docs)), F.lit(share) * F.col("docs"))).select("host", "h1", "h2", "n")
    # Rows equal in id, text and host meet here; each line of theirs counts once a row below.
    rows = src.groupBy("doc", "text_hash", "host").agg(F.count("*").alias("rows"))
    hit = lines.join(often.select("h1", "h2"), ["h1", "h2"]) \
        .groupBy("doc", "text_hash", "host").agg(F.sum("words").alias("words"), F.count("*").alias("lines"),
                                                 F.collect_set(F.struct("h1", "h2")).alias("hashes"))
    hit = hit.join(rows, (hit.doc.eqNullSafe(rows.doc)) & (hit.text_hash == rows.text_hash) & (hit.host == rows.host)).select(
        hit.doc.alias("_doc"), hit.text_hash.alias("_hash"), hit.host.alias("_host"),
        (hit.words / rows.rows).cast("long").alias("gone"), (hit.lines / rows.rows).cast("long").alias("removed_lines"), "hashes")
    out = counted.join(hit, counted.doc.eqNullSafe(F.col("_doc")) & (counted.text_hash == F.col("_hash"))
                       & (counted.host == F.col("_host")), "left")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("gone", F.lit(0))
    depleted = F.col("gone").isNotNull() & ((left < left_words) | (left < F.lit(left_share) * F.col("n_words")))
    verdicts = out.select(F.col("doc").alias(id_col), "text_hash", F.col("host").alias("host_name"), "n_words", "word_chars",
                          "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), left.alias("left_words"),
                          F.coalesce("removed_lines", F.lit(0)).cast("long").alias("removed_lines"), "hashes",
                          (~base & ~depleted).alias("kept"))
    return verdicts, often


def clean_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    **limits) -> DataFrame:
    """The documents that pass, all columns, without their boilerplate lines."""
    verdicts, _ = judged(docs, id_col=id_col, text_col=text_col, host_col=host_col, **limits)
    passed = verdicts.where("kept").groupBy(F.col(id_col).alias("passed_id"), F.col("text_hash").alias("passed_hash"),
                                            F.col("host_name").alias("passed_host")).agg(F.first("hashes").alias("boilerplate"))
    # Numbered columns, so that no name of the documents clashes with these.
    at = {name: F.col(f"c{i}") for i, name in enumerate(docs.columns)}
    raw, host = at[text_col], F.coalesce(at[host_col].cast("string"), F.lit(""))
    joined = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).join(
        passed, at[id_col].eqNullSafe(F.col("passed_id")) & (F.xxhash64(raw) == F.col("passed_hash")) & (host == F.col("passed_host")))

    def stays(line: Column) -> Column:
        return _with(_normal(line), lambda x: ~F.array_contains(F.col("boilerplate"), F.struct(
            F.xxhash64(host, x).alias("h1"), F.xxhash64(x, host, F.lit(7)).alias("h2"))))

    text = F.when(F.col("boilerplate").isNull(), raw).otherwise(F.array_join(F.filter(F.split(raw, "\n"), stays), "\n"))
    return joined.select(*[(text if name == text_col else column).alias(name) for name, column in at.items()])
