"""Removal of runs of lines that occurred before, anywhere in the documents.

A run of lines may go if it has ``LONG_LINE`` words, or two lines with words and
``FEWEST_WORDS`` words: a shared short line alone is left to the line-frequency rules.
Every such run that also stands at an earlier place (smallest document id, then position)
is removed, whatever its neighbours are.

Content-defined chunks find the long ones.  A rolling hash over the hashes of the last
``ROLL`` lines closes a chunk of lines where it is divisible by ``DIVISOR``, so an inserted
line moves boundaries near it only, and copies of a passage are cut at the same lines.  Every
chunk that may be removed is counted over all documents; one that has an earlier occurrence is
compared with it byte by byte and removed.

Chunks alone would miss what repeats without a whole chunk: a passage of two lines, and the
lines between a passage's ends and its first and last boundary.  So outside the removed chunks
each line with words also gives two windows: the shortest run that may be removed and begins
there, and the shortest that ends there.  Any longer run is covered by the windows inside it, so
a repeated run goes whole exactly if the repeated chunks and windows go.  Windows are counted
and compared as chunks are; one that overlaps its own first occurrence stays.

The jobs: hashes of all chunks and windows, of which one filter takes those that occur twice
and another the first places of all chunks; a second pass that gives the bytes of what the
first filter lets through, and no windows inside a chunk that is no first occurrence;
comparison in a join; one join that takes the removed ranges back to the documents.  The
filters are Bloom filters of one hash, ``FILTER_ROOM`` bits for each entry up to
``FILTER_BITS``; a fuller one lets more through to the exact comparison.  A passage shared by
a third of all documents is one pre-aggregated group and a skewed join side with a single
row opposite.

Defined results: null text stays null; lines without words that are left between removed
runs, or beside one at an end of the text, go with them; a text of removed runs only
becomes empty (the row stays); rows equal in id and text are one document and get the
same text; a null id comes after all others; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadsmith.scratch import materialize

LONG_LINE = 50
FEWEST_WORDS = 10
# Lines that the rolling hash covers; of its values one in DIVISOR closes a chunk.
ROLL = 2
DIVISOR = 8
# Bits of a filter: so many for each entry, within these bounds (128 KB to 64 MB); Spark's bitmaps hold 32768 each.
FILTER_ROOM = 16
LEAST_BITS, FILTER_BITS = 1 << 20, 1 << 29
BITMAP = 1 << 15

RUNS = "doc long, text_hash long, start long, size long, h1 long, h2 long, chunk boolean"


def _lines(raw: bytes) -> tuple[list[int], list[int], list[int]]:
    """Starts, ends and numbers of words of the lines with words."""
    starts, ends, words = [], [], []
    at = 0
    for line in raw.split(b"\n"):
        if n := len(line.split()):
            starts.append(at)
            ends.append(at + len(line))
            words.append(n)
        at += len(line) + 1
    return starts, ends, words


def _enough(words: int, lines: int) -> bool:
    return words >= LONG_LINE or lines > 1 and words >= FEWEST_WORDS


def chunks(raw: bytes) -> list[tuple[int, int]]:
    """(start, size) in bytes of the content-defined chunks of lines that may be removed, ascending."""
    return _chunks(raw, *_lines(raw))


def _chunks(raw: bytes, starts: list[int], ends: list[int], words: list[int]) -> list[tuple[int, int]]:
    from xxhash import xxh3_64_intdigest

    if not starts:
        return []
    hashes = np.fromiter((xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts, ends, strict=True)), "<u8", len(starts))
    rolling = hashes.copy()
    for back in range(1, ROLL):                     # a polynomial over the last ROLL line hashes, modulo 2^64
        rolling[back:] += hashes[:-back] * np.uint64(pow(0x9E3779B97F4A7C15, back, 1 << 64))
    closed = ((rolling >> np.uint64(32)) % np.uint64(DIVISOR) == 0)
    closed[-1] = True
    out, first = [], 0
    total = np.concatenate(([0], np.cumsum(words)))
    for last in np.flatnonzero(closed).tolist():
        if _enough(int(total[last + 1] - total[first]), last + 1 - first):
            out.append((starts[first], ends[last] - starts[first]))
        first = last + 1
    return out


def windows(raw: bytes) -> list[tuple[int, int]]:
    """(start, size) in bytes of the shortest runs that may be removed, ascending."""
    return _windows(*_lines(raw))


def _windows(starts: list[int], ends: list[int], words: list[int]) -> list[tuple[int, int]]:
    out = set()
    end = total = 0
    for i, n in enumerate(words):                   # the shortest from line i on
        while end < len(words) and not _enough(total, end - i):
            total += words[end]
            end += 1
        if not _enough(total, end - i):
            break
        out.add((starts[i], ends[end - 1] - starts[i]))
        total -= n
    first = total = 0
    for j, n in enumerate(words):                   # the shortest up to line j
        total += n
        while _enough(total - words[first], j - first):
            total -= words[first]
            first += 1
        if _enough(total, j - first + 1):
            out.add((starts[first], ends[j] - starts[first]))
    return sorted(out)


def _outside(spans: list[tuple[int, int]], covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that lie in none of ``covered``; both ascend."""
    out, k = [], 0
    for start, size in spans:
        while k < len(covered) and sum(covered[k]) < start + size:
            k += 1
        if k == len(covered) or covered[k][0] > start:
            out.append((start, size))
    return out


def _hashes(parts: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_128_digest

    return np.frombuffer(b"".join(map(xxh3_128_digest, parts)), "<i8").reshape(-1, 2)


def _run_task(filters):
    """Hashes of the chunks and windows; with filters, what they let through, with its bytes.

    ``filters``: a broadcast pair of bitmaps, of the runs that occur twice and of the places of
    first chunks.  A chunk that is surely no first one is to be removed, and windows inside it
    tell nothing; of the others the windows are given, and the chunk itself only as a model.
    """
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        known = [np.frombuffer(m, "u1") for m in filters.value] if filters is not None else None
        names = ["doc", "text_hash", "start", "size", "h1", "h2", "chunk"] + ["bytes"] * (known is not None)
        kinds = [pa.int64()] * 6 + [pa.bool_()] + [pa.binary()] * (known is not None)

        def has(which: int, keys: np.ndarray) -> np.ndarray:
            bit = keys & (8 * len(known[which]) - 1)
            return known[which][bit >> 3] >> (bit & 7) & 1 == 1

        for batch in batches:
            rows: list[list] = [[] for _ in names]
            held = 0

            def made():
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds, strict=True)], names=names)

            for doc, text_hash, raw in zip(batch.column("doc").to_pylist(), batch.column("text_hash").to_pylist(),
                                           (v.as_py() for v in batch.column("raw")), strict=True):
                lines = _lines(raw)
                whole, short = _chunks(raw, *lines), _windows(*lines)
                parts = [raw[start:start + size] for start, size in whole]
                hashes = _hashes(parts)
                removable = [True] * len(whole)
                if known is not None and whole:
                    twice = has(0, hashes[:, 0])
                    first = has(1, _place_key(hashes[:, 0], np.array([s for s, _ in whole]), doc, text_hash))
                    short = _outside(short, [x for x, f in zip(whole, first.tolist(), strict=True) if not f])
                    take = np.flatnonzero(twice).tolist()
                    whole, parts, hashes = [whole[i] for i in take], [parts[i] for i in take], hashes[take]
                    removable = (~first[take]).tolist()
                more = [raw[start:start + size] for start, size in short]
                more_hashes = _hashes(more)
                if known is not None and short:
                    take = np.flatnonzero(has(0, more_hashes[:, 0])).tolist()
                    short, more, more_hashes = [short[i] for i in take], [more[i] for i in take], more_hashes[take]
                kind = removable + [known is not None] * len(short)
                for span, part, pair, flag in zip(whole + short, parts + more, hashes.tolist() + more_hashes.tolist(), kind, strict=True):
                    held += 48 + (len(part) if known is not None else 0)
                    for col, v in zip(rows, (doc, text_hash, *span, *pair, flag, part), strict=False):
                        col.append(v)
                    if held > 16_000_000:
                        yield made()
                        rows, held = [[] for _ in names], 0
            if rows[0]:
                yield made()

    return run


def _place_key(h1: np.ndarray, start: np.ndarray, doc: int | None, text_hash: int) -> np.ndarray:
    return h1 ^ (start << 7) ^ np.int64(text_hash) ^ np.int64(-1 if doc is None else doc)


def _filter_of(keys: DataFrame, entries: int) -> bytes:
    """A bit for each value of ``key`` modulo a power of two that fits ``entries``: at most FILTER_BITS / 8 bytes."""
    bits = min(FILTER_BITS, max(LEAST_BITS, 1 << (FILTER_ROOM * entries).bit_length()))
    bit = F.pmod("key", F.lit(bits))
    maps = keys.select(F.floor(bit / BITMAP).alias("part"), F.pmod(bit, F.lit(BITMAP)).alias("bit")) \
        .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = bytearray(bits // 8)
    for r in maps.collect():
        out[r.part * BITMAP // 8:(r.part + 1) * BITMAP // 8] = r.bits
    return bytes(out)


def repeated_ranges(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, text_hash, start, size) of every removed chunk and window, proven equal to its first occurrence.

    They may overlap; sorted by start and size, their ends ascend too."""
    text = F.col(f"`{text_col}`")
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(text).alias("text_hash"),
                      text.cast("binary").alias("raw")).where("raw is not null")
    hashes = src.mapInArrow(_run_task(None), RUNS)
    # Repeated rows are one document: their runs count once.
    once = materialize(hashes.groupBy("h1", "h2", "size").agg(
        F.min(_place()).alias("first"), (F.min(_place()) != F.max(_place())).alias("again"), F.max("chunk").alias("chunk"))
        .where("again or chunk"), "runs")
    counts = once.agg(F.count_if("again"), F.count_if("chunk")).first()
    place = F.col("h1").bitwiseXOR(F.shiftleft("first.start", 7)).bitwiseXOR(F.col("first.text_hash")) \
        .bitwiseXOR(F.when(F.col("first.none"), F.lit(-1)).otherwise(F.col("first.doc")).cast("long"))
    filters = docs.sparkSession.sparkContext.broadcast((
        _filter_of(once.where("again").select(F.col("h1").alias("key")), counts[0]),
        _filter_of(once.where("chunk").select(place.alias("key")), counts[1])))
    found = materialize(src.mapInArrow(_run_task(filters), RUNS + ", bytes binary"), "repeated")
    firsts = found.groupBy("h1", "h2", "size").agg(
        F.min(_place()).alias("first"), F.max(_place()).alias("last"), F.min_by("bytes", _place()).alias("model")) \
        .where("first != last").select("h1", "h2", "size", "first", "model")
    # In the first occurrence's own document only what lies behind it: "a a a" holds "a a" once.
    apart = ~(_place().dropFields("start") == F.col("first").dropFields("start")) \
        | (F.col("start") > F.col("first.start") + F.col("size"))
    return found.where("chunk").join(firsts, ["h1", "h2", "size"]).where((F.col("bytes") == F.col("model")) & apart) \
        .select("doc", "text_hash", "start", "size").distinct()


def _place() -> Column:
    """Where a run stands; the smallest is its first occurrence."""
    return F.struct(F.col("doc").isNull().alias("none"), F.coalesce("doc", F.lit(0)).alias("doc"), "text_hash", "start")


# The text without the removed ranges: the pieces between them that hold a word, joined by line ends again.
_CUT = """
  array_join(filter(transform(
    filter(zip_with(concat(array(-1L), transform(cuts, c -> c.start + c.size)),
                    concat(transform(cuts, c -> c.start), array(octet_length(the_text) + 1L)),
                    (e, s) -> struct(e + 2 as a, s - e - 2 as n)), p -> p.n >= 0),
    p -> decode(substring(raw, cast(p.a as int), cast(p.n as int)), 'UTF-8')),
    t -> t rlike '[^ \\\\t\\\\n\\\\u000B\\\\f\\\\r]'), '\n')
"""
# How many runs the ranges make: a run begins where a line lies between a range and the one before.
_RUNS = """
  size(filter(zip_with(transform(cuts, c -> c.start),
                       concat(array(-2L), transform(slice(cuts, 1, size(cuts) - 1), c -> c.start + c.size)),
                       (s, e) -> s > e + 1), x -> x))
"""


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                removed_col: str | None = None) -> DataFrame:
    """``docs`` with the repeated runs cut out of the text; ``removed_col`` adds how many."""
    cuts = repeated_ranges(docs, id_col=id_col, text_col=text_col)
    cuts = cuts.groupBy("doc", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "size"))).alias("cuts")) \
        .select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash"), "cuts")
    cuts = materialize(cuts, "cuts")
    same = docs[id_col].cast("long").eqNullSafe(cuts["_doc"]) & (F.xxhash64(docs[text_col]) == cuts["_hash"])
    # Always by a shuffle: what is cut grows with the documents, so no size of it is broadcast.
    joined = docs.join(cuts.hint("merge"), same, "left")
    names = docs.columns
    cut = F.expr(f"transform(array(cast(the_text as binary)), raw -> {_CUT})[0]")
    held = joined.select(F.struct(*[docs[c] for c in names]).alias("row"), docs[text_col].alias("the_text"), cuts["cuts"].alias("cuts"))
    text = F.when(F.col("cuts").isNull(), F.col("the_text")).otherwise(cut)
    extra = [F.when(F.col("cuts").isNull(), 0).otherwise(F.expr(_RUNS)).alias(removed_col)] if removed_col else []
    return held.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in names], *extra)
