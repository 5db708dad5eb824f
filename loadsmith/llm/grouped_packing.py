"""Best-fit packing of tokenized documents by linear grouping.

Documents are not cut unless they are longer than a sequence; such a one gives whole
sequences, and its last piece is packed like a short document.  Pieces are dealt by chance
to bins of work of about ``GROUP_TOKENS`` tokens, and each is packed on its own:

* the large lengths (over ``window / LARGE_PARTS``) are sorted and cut into ``SIZES`` groups of
  equal cardinality, and each is rounded up to the largest of its group: few sizes remain;
* a configuration is a set of rounded sizes that fits into a sequence.  The linear program of
  the fewest configurations that cover all groups is solved by the simplex method, where the
  best next configuration is found among all of them (few sizes, few to a sequence);
* each configuration is used a whole number of times (rounded down), and actual documents take
  the places of the rounded sizes, the largest first;
* large documents that are left, then the small ones, go by decreasing length into the
  sequence with the least room that holds them, else into a new one.

Tokenizing streams through the input partitions and writes the pieces to the shared folder;
only their lengths (and, if wanted, ids) are shuffled.  The number of work bins comes from the
number of tokens, so results do not depend on how the input is partitioned, nor does a bin
grow with the data.

Defined results: null text counts as empty; every document ends with ``end_id``, so an empty
one is a piece of one token; repeated rows are packed each on their own; a null id stays
null; an empty table gives no pieces.
"""

from __future__ import annotations

import itertools
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadsmith.scratch import materialize

WINDOW = 4096
# Lengths above a LARGE_PARTS-th of the window are grouped into SIZES groups.
LARGE_PARTS = 4
SIZES = 12
# Tokens and pieces that one task packs (about 2,000 sequences).
GROUP_TOKENS = 8_000_000
GROUP_PIECES = 100_000
# Sequence ids: the work bin above, the count within it below.
BIN_BITS = 32

PIECES = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])
PLACED = T.StructType([*PIECES.fields[:6], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
                       PIECES.fields[6]])


def linear_groups(lengths: np.ndarray, sizes: int = SIZES) -> list[np.ndarray]:
    """Positions of ``lengths`` in at most ``sizes`` groups of equal cardinality, by increasing length."""
    order = np.argsort(lengths, kind="stable")
    return [g for g in np.array_split(order, min(sizes, len(order))) if len(g)] if len(order) else []


def configurations(sizes: list[int], window: int) -> np.ndarray:
    """All sets of rounded sizes that fit into ``window``: one row each, how often each size is taken."""
    found = []
    for n in range(1, window // min(sizes) + 1):
        for pick in itertools.combinations_with_replacement(range(len(sizes)), n):
            if sum(sizes[i] for i in pick) <= window:
                found.append(np.bincount(pick, minlength=len(sizes)))
    return np.array(found, float)


def fewest(config: np.ndarray, demand: np.ndarray) -> list[tuple[int, float]]:
    """(configuration, how often) of the linear program: fewest in all that cover ``demand`` exactly.

    Simplex with the basis' inverse; it begins with each size by itself, as often as it fits.
    """
    k = len(demand)
    single = [int(np.argmax(np.where((config > 0).sum(1) == 1, config[:, i], 0))) for i in range(k)]
    basis = list(single)
    inverse = np.diag(1 / config[single, range(k)])
    amount = inverse @ demand
    for _ in range(200 * k):
        gain = config @ inverse.sum(0)                  # what a configuration saves, at the basis' prices
        best = int(np.argmax(gain))
        if gain[best] <= 1 + 1e-9:
            break
        step = inverse @ config[best]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, amount / step, np.inf)
        out = int(np.argmin(ratio))
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
        amount = np.maximum(amount - step * ratio[out], 0)
        amount[out] = ratio[out]
        basis[out] = best
    return list(zip(basis, amount.tolist(), strict=True))


def pack_lengths(lengths: list[int], window: int = WINDOW, sizes: int = SIZES, large_parts: int = LARGE_PARTS) -> list[list[int]]:
    """Sequences, each a list of positions of ``lengths`` (from 1 to ``window``) whose sum fits the window."""
    size = np.asarray(lengths, np.int64)
    large = np.flatnonzero(size * large_parts > window)
    groups = [large[g] for g in linear_groups(size[large], sizes)]
    sequences: list[list[int]] = []
    left: list[int] = []
    if groups:
        rounded = [int(size[g[-1]]) for g in groups]
        config = configurations(rounded, window)
        pools = [g.tolist() for g in groups]                        # the largest is taken first
        for which, times in fewest(config, np.array([len(g) for g in groups], float)):
            for _ in range(int(times + 1e-6)):
                taken = [(i, int(n)) for i, n in enumerate(config[which]) if n]
                if any(len(pools[i]) < n for i, n in taken):
                    break
                sequences.append([pools[i].pop() for i, n in taken for _ in range(n)])
        left = [i for pool in pools for i in pool]
    rooms = sorted((window - int(size[s].sum()), at) for at, s in enumerate(sequences))
    small = np.flatnonzero(size * large_parts <= window).tolist()
    for i in sorted(left, key=lambda x: -size[x]) + sorted(small, key=lambda x: -size[x]):
        n = int(size[i])
        at = bisect_left(rooms, (n,))                               # the least room that holds it
        if at < len(rooms):
            room, s = rooms.pop(at)
            sequences[s].append(i)
        else:
            room, s = window, len(sequences)
            sequences.append([i])
        if room > n:
            insort(rooms, (room - n, s))
    return sequences


def _piece_task(tokenizer: str, end_id: int, window: int, with_ids: bool):
    def run(batches: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa

        from loadsmith.llm._tokens import encoder, text_batches

        tokenize = encoder(tokenizer)
        end = np.asarray([end_id], "<u4").tobytes()
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys = batch.column("doc").to_pylist()
            for a, b in text_batches(texts):
                cols: list[list] = [[] for _ in kinds]
                for key, x in zip(keys[a:b], tokenize.encode(texts[a:b]), strict=True):
                    ids, n = x + end, len(x) // 4 + 1
                    for piece, at in enumerate(range(0, n, window)):
                        part = ids[4 * at:4 * (at + window)]
                        row = (key, piece, at, len(part) // 4, zlib.crc32(part), n, part if with_ids else None)
                        for col, v in zip(cols, row, strict=True):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=PIECES.names)
        tokenize.clear()

    return run


def _pack_group(window: int, sizes: int, large_parts: int):
    def run(key, table):
        import pyarrow as pa

        lengths = table.column("length").to_pylist()
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        base = key[0].as_py() << BIN_BITS
        for s, members in enumerate(pack_lengths(lengths, window, sizes, large_parts)):
            sequence[members] = base + s
            offset[members] = np.concatenate(([0], np.cumsum([lengths[i] for i in members])[:-1]))
        columns = {**{c: table.column(c) for c in PIECES.names}, "sequence_id": pa.array(sequence), "offset": pa.array(offset)}
        return pa.table([columns[c] for c in PLACED.names], names=PLACED.names)

    return run


def pack_best_fit(docs: DataFrame, tokenizer: str, end_id: int, *, id_col: str = "doc_id", text_col: str = "text",
                  window: int = WINDOW, sizes: int = SIZES, large_parts: int = LARGE_PARTS,
                  group_tokens: int = GROUP_TOKENS, with_ids: bool = True) -> DataFrame:
    """One row per piece: the document's id, ``piece`` (from 0), ``start`` and ``length`` in its ids,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset`` there, and ``ids`` (little-endian
    unsigned 32-bit; null with ``with_ids=False``, which spares their shuffle)."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text"))
    pieces = src.mapInArrow(_piece_task(tokenizer, end_id, window, with_ids), PIECES)
    pieces = materialize(pieces, "pieces").withColumn("row", F.monotonically_increasing_id())
    short = pieces.where(F.col("length") < window)
    tokens, count = short.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    bins = max(1, -(-tokens // group_tokens), -(-count // GROUP_PIECES))
    # Row numbers are hashed: neither one id nor one input partition can fill a bin of work.
    packed = short.withColumn("bin", F.pmod(F.xxhash64("row"), F.lit(bins))).groupBy("bin") \
        .applyInArrow(_pack_group(window, sizes, large_parts), PLACED)
    # A full piece is a sequence of its own, in bin numbers beyond the others.
    full = pieces.where(F.col("length") == window).select(
        *PIECES.names[:6], (F.col("row") + (F.lit(bins).cast("long") * (1 << BIN_BITS))).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), "ids")
    return packed.unionByName(full).withColumnRenamed("doc", id_col)
