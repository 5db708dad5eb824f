"""What each of several filters removes, redundantly or alone, under every order of application.

A document's verdicts by the filters are a bit mask, so all that an audit needs of a part of
the documents is one cell for each mask: how many documents have it, and how many of these
are good or toxic.  A cell folds, in Spark's higher-order functions, across the constant
array of all filter orders: for each order it is carried from step to step, and each step
gives a struct of what happens to the cell there.  The cells of a part, at most one a mask,
are merged by elementwise sums of these arrays.

The filters here (words are maximal runs ``[^\\x20\\x09-\\x0D]+``, case-sensitive):

    A  under 200 words
    B  100 * distinct words < 50 * words
    C  100 * characters [A-Z] > 3 * code points
    D  holds one of ``#$%&*|``
    E  the same text as a document with a smaller id, anywhere in the table

Texts are read once, by Arrow batches that give a mask and a SHA-256, which are stored in the
shared folder.  The smallest id of
each digest is a map-side minimum; only digests that occur under two ids are joined back, so
a text that a third of all documents share is a skewed join side with one row opposite.

Defined results: null text counts as empty; a null part is the empty string; a null id is
never smaller nor larger than another; repeated rows count each; a document has a label if
any row of its id in the labels says so; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadsmith.scratch import materialize

# The filters and their limits.
FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 3
SYMBOLS = b"#$%&*|"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
COPY = FILTERS.index("E")
# What a step counts, and the values a cell carries in.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_mask(text: bytes, code_points: int) -> int:
    """Bits of the filters that look at the text alone (bytes.split parts at ASCII white space)."""
    words = text.split()
    n = len(words)
    return ((n < MIN_WORDS)
            | (100 * len(set(words)) < DISTINCT_PERCENT * n) << 1
            | (100 * (len(text) - len(text.translate(None, _UPPER))) > UPPER_PERCENT * code_points) << 2
            | (len(text) != len(text.translate(None, SYMBOLS))) << 3)


def _mask_batches(batches: Iterator) -> Iterator:
    import hashlib

    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        text = batch.column("text")
        points = pc.utf8_length(text).to_pylist()
        masks, digests = [], []
        for value, n in zip(text, points, strict=True):
            raw = value.as_buffer()
            raw = raw.to_pybytes() if raw is not None else b""
            masks.append(text_mask(raw, n))
            digests.append(hashlib.sha256(raw).digest())
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("part"), pa.array(masks, pa.int32()),
                                          pa.array(digests, pa.binary())], names=["doc", "part", "mask", "digest"])


def masks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc, part, mask) of every row, the copy filter included."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"),
                      F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    # Stored without the texts: the minimum and the join below read some 40 bytes a row.
    seen = materialize(src.mapInArrow(_mask_batches, "doc long, part string, mask int, digest binary"), "masks")
    # Digests under two ids or more; a digest of one id has no later copy.
    first = seen.where("doc is not null").groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last")) \
        .where("first < last").select(F.col("digest").alias("known"), "first")
    copy = F.coalesce(F.col("doc") > F.col("first"), F.lit(False)).cast("int")
    return seen.join(first, F.col("digest") == F.col("known"), "left") \
        .select("doc", "part", F.col("mask").bitwiseOR(copy * (1 << COPY)).alias("mask"))


def cells(marked: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """(part, mask, n, good, toxic): the documents of each mask, and how many have the labels."""
    key = F.col(f"`{id_col}`").cast("long").alias("of")

    def says(column: str) -> Column:
        return F.coalesce(F.max((F.col(f"`{column}`") == 1).cast("int")), F.lit(0))

    known = labels.where(F.col(f"`{id_col}`").isNotNull()).groupBy(key).agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    # Rows of one id, part and mask are counted before the join, so one id's rows (null too) are few.
    rows = marked.groupBy("doc", "part", "mask").agg(F.count("*").alias("n"))
    return rows.join(known, F.col("doc") == F.col("of"), "left") \
        .select("part", "mask", "n", *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]) \
        .groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def orders(filters: str = FILTERS) -> list[str]:
    return ["".join(o) for o in itertools.permutations(filters)]


def fold_cells(found: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order and step from the cells of each part."""
    every = orders(filters)
    steps = F.array(*[F.array(*[F.lit(filters.index(f)) for f in order]) for order in every])
    alone = F.array(*[F.lit(1 << f) for f in range(len(filters))])     # masks of one filter
    zero = F.lit(0).cast("long")

    def step(state: Column, f: Column) -> Column:
        fails = F.getbit(F.col("mask"), f) == 1
        alive = state["alive"]
        gone = alive & fails
        counts = {"kept": F.when(alive & ~fails, F.col("n")), "removed": F.when(gone, F.col("n")),
                  "redundant": F.when(~alive & fails, F.col("n")),
                  "unique_fails": F.when(F.col("mask") == F.get(alone, f), F.col("n")),
                  "good_lost": F.when(gone, F.col("good")), "toxic_lost": F.when(gone, F.col("toxic"))}
        made = F.struct(*[F.coalesce(counts[c], zero).alias(c) for c in COUNTS])
        return F.struct((alive & ~fails).alias("alive"), F.concat(state["steps"], F.array(made)).alias("steps"))

    shape = "array<struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(shape).alias("steps"))
    # Each order folds the cell through its steps: in all, orders * filters structs.
    folded = F.flatten(F.transform(steps, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))
    nothing = F.array_repeat(F.struct(*[zero.alias(c) for c in COUNTS]), len(every) * len(filters))
    per_part = found.select("part", folded.alias("steps")).groupBy("part").agg(F.collect_list("steps").alias("cells"))
    merged = per_part.select("part", F.aggregate("cells", nothing, lambda a, b: F.zip_with(
        a, b, lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS]))).alias("steps"))
    at = F.posexplode("steps").alias("at", "s")
    names = F.array(*[F.lit(o) for o in every])
    order, number = F.get(names, F.floor(F.col("at") / len(filters)).cast("int")), F.col("at") % len(filters) + 1
    # Of a filter's removals over all orders: each is at one step of each order.
    flat = F.flatten(steps)
    total = F.transform(F.sequence(F.lit(0), F.lit(len(filters) - 1)), lambda f: F.aggregate(
        F.zip_with(flat, F.col("steps"), lambda g, s: F.when(g == f, s["removed"]).otherwise(zero)), zero, lambda a, b: a + b))
    out = merged.select("part", total.alias("totals"), at)
    return out.select("part", order.alias("filter_order"), number.cast("int").alias("step"), *[F.col("s")[c].alias(c) for c in COUNTS],
                      F.get("totals", F.get(flat, F.col("at"))).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """(part, filter_order, step, counts, shapley): 600 rows for each part of ``docs``."""
    return fold_cells(cells(masks(docs, id_col=id_col, text_col=text_col, part_col=part_col), labels, id_col=id_col))
